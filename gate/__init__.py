"""Registered queries and their SQL counterparts over the given tables."""
