"""Parsing and printing of the four timestamp shapes seen in logs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted shapes.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})\z"
OFFSET_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{4})\z"
ZULU_OFFSET_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{4})\z"
PLAIN_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?\z"

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _shaped(col: Column, pattern: str) -> Column:
    return F.when(col.rlike(pattern), col.try_cast("timestamp"))


def rfc3339(col: Column) -> Column:
    return _shaped(col, RFC3339)


def plain_time(col: Column) -> Column:
    return _shaped(col, PLAIN_TIME)


def offset_time(col: Column, zulu: bool = False) -> Column:
    """``…+0000`` times; with ``zulu`` a literal Z is accepted too."""
    return _shaped(col, ZULU_OFFSET_TIME if zulu else OFFSET_TIME)


def rfc3339_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts, MICROS), F.lit("Z"))


def offset_text(ts: Column) -> Column:
    """Six fraction digits and a numeric offset."""
    return F.concat(F.date_format(ts, MICROS), F.lit("+0000"))
