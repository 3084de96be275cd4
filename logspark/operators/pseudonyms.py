"""Stable one-to-one renaming of machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.functions.joins import small_enough
from logspark.functions.ranks import global_rank

BUCKETS = 4096


def _ranked(names: DataFrame, col: str, salt: str) -> DataFrame:
    """Rank names by a hash of the name: same input, same ranks, in any run."""
    mixed = F.xxhash64(F.col(col), F.lit(salt))
    bucket = F.pmod(mixed, F.lit(BUCKETS))
    return global_rank(names, bucket, [mixed, F.col(col)], "rank")


def pseudonymize(
    df: DataFrame,
    col: str,
    pool: DataFrame,
    prior: DataFrame,
    now: Column | None = None,
    salt: str = "",
    check_pool: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Return (names, registry).

    ``names`` has one row per distinct input name: ``name, rename, hit``. ``registry`` is the new
    state ``name, rename, first_seen, last_seen``: prior rows plus one row per new name. A known
    name keeps its alias, an alias maps to itself, and a new name takes an unused pool entry
    (``pool``: one column ``name``). With ``check_pool`` an exhausted pool raises.
    """
    now = F.current_timestamp() if now is None else now
    asked = df.select(F.col(col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    # both sides of a pair answer to the same alias
    answers = prior.select("name", "rename").unionByName(prior.select(F.col("rename").alias("name"), "rename"))
    answers = answers.groupBy("name").agg(F.min("rename").alias("rename"))
    known = asked.join(small_enough(answers), "name", "left")
    fresh = known.filter(F.col("rename").isNull()).select("name")
    used = answers.select("name")
    free = pool.select("name").distinct().join(used, "name", "left_anti")
    new_ranked = _ranked(fresh, "name", salt)
    free_ranked = _ranked(free, "name", salt + "pool").withColumnRenamed("name", "rename")
    pairs = new_ranked.join(free_ranked, "rank", "left").select("name", "rename")
    if check_pool and not pairs.filter(F.col("rename").isNull()).isEmpty():
        raise ValueError("rename pool is empty")
    names = (
        known.filter(F.col("rename").isNotNull())
        .withColumn("hit", F.lit(True))
        .unionByName(pairs.withColumn("hit", F.lit(False)))
    )
    touched = names.filter("hit").select("rename").distinct().withColumn("__hit", F.lit(True))
    kept = prior.join(touched, "rename", "left").select(
        "name",
        "rename",
        "first_seen",
        F.when(F.col("__hit"), now).otherwise(F.col("last_seen")).alias("last_seen"),
    )
    added = pairs.select("name", "rename", now.alias("first_seen"), now.alias("last_seen"))
    return names, kept.unionByName(added)


def name_counts(names: DataFrame) -> DataFrame:
    return names.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"))
