"""Readers: landing files and declared source tables."""

from ordermart.sources.landing import DEFAULT_SOURCE, LANDING_OPTIONS, malformed_rows, read_landing
from ordermart.sources.tables import read_source

__all__ = ["DEFAULT_SOURCE", "LANDING_OPTIONS", "malformed_rows", "read_landing", "read_source"]
