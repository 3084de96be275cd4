"""Dimension lookups whose physical form depends on a measured size.

A dimension is broadcast only after its bytes were summed and found below a limit.
Above it the lookup is a shuffle join, asked for by a hint: Spark's own estimate of a
dimension made from small files may be far too low, and would broadcast it. Both sides are
salted, so that a key held by a large share of the rows is spread over some tasks; AQE splits
what is still too big. Rows whose key is null never match, so they get salts of their own over
a much wider range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_BYTES = 64 << 20
SALTS = 32
# each salt is one more copy of the dimension that a lookup shuffles
KEY_SALTS = 4
NULL_SALTS = 1 << 20


def measured_bytes(df: DataFrame) -> int:
    """Total printed size of a frame: one distributed aggregate, one number back."""
    row = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()
    return row["b"] or 0


@dataclass(frozen=True)
class Lookup:
    """A frame with one row per ``key`` and the chosen way to join it."""

    df: DataFrame
    key: str
    small: bool


def as_lookup(df: DataFrame, key: str, max_bytes: int = BROADCAST_BYTES) -> Lookup:
    return Lookup(df, key, measured_bytes(df) <= max_bytes)


def small_enough(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when it was measured to be small, else unchanged."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def attach(events: DataFrame, lookup: Lookup, on: Column, out: str, spread: list[str]) -> DataFrame:
    """Left join: adds the matching dimension row as struct column ``out`` (null: no hit).

    ``spread`` names columns that vary within a hot key; they feed the salt.
    """
    fields = [c for c in lookup.df.columns if c != lookup.key]
    dim = lookup.df.select(F.col(lookup.key).alias("__key"), F.struct(*fields).alias(out))
    probe = events.withColumn("__probe", on)
    if lookup.small:
        joined = probe.join(F.broadcast(dim), F.col("__probe") == F.col("__key"), "left")
        return joined.drop("__probe", "__key")
    mixed = F.xxhash64(*spread)
    salt = F.when(F.col("__probe").isNull(), F.pmod(mixed, F.lit(NULL_SALTS))).otherwise(
        F.pmod(mixed, F.lit(KEY_SALTS))
    )
    probe = probe.withColumn("__salt", salt)
    dim = dim.withColumn("__dsalt", F.explode(F.expr(f"sequence(0L, {KEY_SALTS - 1}L)")))
    # keys are unique, so a task's share of the dimension stays small; the events need no sort
    joined = probe.join(
        dim.hint("shuffle_hash"), (F.col("__probe") == F.col("__key")) & (F.col("__salt") == F.col("__dsalt")), "left"
    )
    return joined.drop("__probe", "__key", "__salt", "__dsalt")
