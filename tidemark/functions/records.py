"""Expressions over JSON, bytes, structs and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8(body: Column) -> Column:
    return F.decode(body, "UTF-8")


def to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def field_or(value: Column, default: str = "") -> Column:
    """Nested lookup with a default where any level is missing."""
    return F.coalesce(value, F.lit(default))


def number(text: Column) -> Column:
    """Tolerant text to double: bad text gives NULL instead of an error."""
    return text.try_cast("double")


def any_shape(text: Column) -> Column:
    """JSON text of unknown shape as a variant; NULL where it is no JSON."""
    return F.try_parse_json(text)
