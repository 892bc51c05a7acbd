"""Scalar expressions shared by the operators; all of them run as built-in functions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermart.schemas import NULL_TOKENS

DATE_FORMATS = ("yyyy-MM-dd",)


def missing_to_null(text: Column) -> Column:
    """NULL for the texts a CSV uses for a missing value."""
    return F.when(~text.isin(NULL_TOKENS), text)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def clean_text(text: Column) -> Column:
    return F.trim(text)


def clean_name(text: Column) -> Column:
    return F.initcap(F.trim(text))


def clean_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def strict_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date in one of the given formats, else NULL; padding and short fields do not parse."""
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in formats])


def as_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal, rounded half up; NULL where the text is no number or does not fit."""
    return text.try_cast(f"decimal({precision},{scale})")


def date_key(day: Column) -> Column:
    """Date as the integer YYYYMMDD."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def row_hash(columns: Iterable[str]) -> Column:
    """md5 of the values joined by ``|``; a missing value counts as the text ``nan``."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("nan")) for name in columns]
    return F.md5(F.concat_ws("|", *texts))


def in_values(code: Column, values: Sequence[str]) -> Column:
    """Membership that is FALSE, not NULL, for a missing value."""
    return F.coalesce(code.isin(list(values)), F.lit(False))
