"""Signature-id to technique mapping of alerts, and the ids that lack one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logspark.functions.joins import as_lookup, attach


def join_sid_map(alerts: DataFrame, sid_map: DataFrame, spread: list[str]) -> DataFrame:
    """Add struct ``mapping`` (tactic, id, name, msg) and flag ``mapped`` to rows with ``sid``."""
    lookup = as_lookup(sid_map.select(F.col("sid").cast("bigint").alias("key"), "tactic", "id", "name", "msg"), "key")
    out = attach(alerts, lookup, F.col("sid"), "mapping", spread)
    return out.withColumn("mapped", F.col("mapping").isNotNull())


def missing_sids(alerts: DataFrame, sid_map: DataFrame) -> DataFrame:
    """(sid, msg) of alerts without a mapping; ids are reduced before the anti join."""
    seen = alerts.filter(F.col("sid").isNotNull()).groupBy("sid").agg(F.min("msg").alias("msg"))
    return seen.join(sid_map.select(F.col("sid").cast("bigint").alias("sid")), "sid", "left_anti")


def sid_answers(joined: DataFrame) -> DataFrame:
    """(sid, msg, present): each id that alerts carried, and whether no mapping answered to it."""
    seen = joined.filter(F.col("sid").isNotNull())
    return seen.groupBy("sid").agg(F.min("msg").alias("msg"), F.bool_and(~F.col("mapped")).alias("present"))


def sid_counts(joined: DataFrame) -> DataFrame:
    return joined.agg(F.count_if("mapped").alias("matches"), F.count_if(~F.col("mapped")).alias("misses"))
