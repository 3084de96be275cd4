"""Numbers and aliases handed out on a stream.

A registry's manifest keeps the next free number. A batch takes the range that starts there, and the manifest of its
version names where the range ended, so both are committed at once. A replayed batch starts from the same manifest and
ranks its new keys in the same order: it gives them the same numbers again, without a gap and without using one twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logspark.functions.ranks import global_rank
from logspark.operators.indicators import BUCKET_ROWS
from logspark.schemas import INDICATOR
from logspark.streaming.registry import Registry

NEXT = "next"
INDICATOR_STATE = f"item STRING, {INDICATOR}"
ALIAS_STATE = "name STRING, rename STRING, number BIGINT, place BIGINT, first_seen TIMESTAMP, last_seen TIMESTAMP"


def register_indicators(registry: Registry, new: DataFrame, batch_id: int, seq: str = "seq") -> DataFrame:
    """Apply a batch of valid indicators (type, value, ``seq``, added) to a registry of ``INDICATOR_STATE``.

    A known indicator keeps its row. New ones get the next ids in order of ``seq``, are enabled, and take the time of
    their first report.
    """
    item = F.concat_ws("\0", "type", "value").alias("item")
    first = new.groupBy("type", "value").agg(F.min(seq).alias("seq"), F.min("added").alias("added"))

    def combine(previous: DataFrame, batch: DataFrame, numbers: dict) -> DataFrame:
        fresh = batch.join(previous.select("item"), "item", "left_anti")
        order = [F.col("seq"), F.col("item")]
        ranked = global_rank(fresh, F.expr(f"seq div {BUCKET_ROWS}"), order, "rank")
        added = ranked.select(
            "item", (F.col("rank") + numbers.get(NEXT, 0)).alias("id"), F.lit(True).alias("enabled"), "value", "type", "added"
        )
        return previous.unionByName(added)

    def numbers(rows: DataFrame, before: dict) -> dict:
        return _next(rows.agg(F.max("id") + 1).first()[0], before)

    return registry.update(first.select(item, "*"), batch_id, combine, numbers)


def _next(end: int | None, before: dict) -> dict:
    return before | {NEXT: max(end or 0, before.get(NEXT, 0))}


def ranked_pool(pool: DataFrame, salt: str = "") -> DataFrame:
    """(place, alias): each alias of a pool (``name``) once, in the order in which they are handed out."""
    names = pool.select("name").distinct()
    mixed = F.xxhash64("name", F.lit(salt))
    ranked = global_rank(names, F.pmod(mixed, F.lit(4096)), [mixed, F.col("name")], "place")
    return ranked.select("place", F.col("name").alias("alias"))


def assign_aliases(registry: Registry, pool: DataFrame, names: DataFrame, batch_id: int) -> DataFrame:
    """Give the names of a batch (name, seen) their aliases in a registry of ``ALIAS_STATE``.

    ``pool`` is a written ``ranked_pool``. A known name keeps its alias and gets a later ``last_seen``. A name that is
    an alias in use stands for itself and is left out. A new name takes the next place of the pool that is no known
    name. When the pool is used up the batch fails.
    """
    asked = names.filter(F.col("name").isNotNull()).groupBy("name").agg(F.min("seen").alias("first"), F.max("seen").alias("last"))

    def combine(previous: DataFrame, batch: DataFrame, numbers: dict) -> DataFrame:
        taken = numbers.get(NEXT, 0)
        again = previous.join(batch.select("name", "last"), "name", "left")
        again = again.withColumn("last_seen", F.greatest("last_seen", "last")).select(*previous.columns)
        fresh = batch.join(previous.select("name"), "name", "left_anti")
        in_use = pool.filter(F.col("place") < taken).select(F.col("alias").alias("name"))
        fresh = fresh.join(in_use, "name", "left_anti")
        mixed = F.xxhash64("name")
        fresh = global_rank(fresh, F.pmod(mixed, F.lit(4096)), [mixed, F.col("name")], "number")
        known = registry.rows(registry.manifest(registry.number(batch_id))).select("name").unionByName(batch.select("name"))
        # places are dense and each known name is at most one of them, so this many hold a free one for every new name
        reach = taken + batch.count() + known.count()
        free = pool.filter((F.col("place") >= taken) & (F.col("place") < reach))
        free = free.join(known.withColumnRenamed("name", "alias"), "alias", "left_anti")
        free = global_rank(free, F.expr(f"place div {BUCKET_ROWS}"), [F.col("place")], "number")
        pairs = fresh.join(free, "number", "left")
        added = pairs.select(
            "name",
            F.coalesce("alias", F.raise_error(F.lit("the pool of aliases is used up"))).alias("rename"),
            "number",
            "place",
            F.col("first").alias("first_seen"),
            F.col("last").alias("last_seen"),
        )
        return again.unionByName(added)

    def numbers(rows: DataFrame, before: dict) -> dict:
        return _next(rows.agg(F.max("place") + 1).first()[0], before)

    return registry.update(asked, batch_id, combine, numbers)
