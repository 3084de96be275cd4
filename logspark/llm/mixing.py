"""Mix sources to target weights: capped water-filling, then whole and fractional repetitions of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from logspark.llm.common import apart, saved, word_count

BUCKETS = 4096
HASH_DIGITS = 15
RUN = 10_000
ADDED = ("__size", "__source_size", "__target", "__repeats")


def fill_targets(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to a table of (source, source_size, weight).

    ``share`` times all sizes is spread by weight. A source above ``max_epochs`` times its size is clamped there
    and the excess goes to the others by weight, until none is above. In the order of size over weight the clamped
    sources come first, so the end of the process is found without rounds: source i is clamped if what is left
    after clamping all before it would still lift it to its cap. Zero weights and sizes get 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    order = Window.partitionBy("__all").orderBy(F.col("__ratio"), F.col("__tie").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy("__all")
    ranked = (
        sources.withColumn("__all", F.lit(0))
        .withColumn("__cap", cap)
        .withColumn("__ratio", F.when(F.col("weight") > 0, F.col("__cap") / F.col("weight")).otherwise(F.lit(float("inf"))))
        .withColumn("__tie", F.col("source"))
        .withColumn("__budget", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("__spent", F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
        .withColumn("__weights", F.sum("weight").over(after))
    )
    level = F.when(F.col("__weights") > 0, (F.col("__budget") - F.col("__spent")) / F.col("__weights")).otherwise(F.lit(0.0))
    clamped = ranked.withColumn("__level", level).withColumn("__over", F.col("__level") >= F.col("__ratio"))
    final = F.min(F.when(~F.col("__over"), F.struct("__ratio", "__tie", "__level"))).over(whole)["__level"]
    target = F.when(F.col("__over"), F.col("__cap")).otherwise(F.least(F.col("__cap"), F.col("weight") * final))
    filled = clamped.withColumn("target", F.when(F.col("weight") > 0, target).otherwise(F.lit(0.0)))
    return filled.drop("__all", "__cap", "__ratio", "__tie", "__budget", "__spent", "__weights", "__level", "__over")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Add ``weight``: the given weights in turn, sources in code-point order, null last."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))


def seeded_hash(seed: int, *columns: str) -> Column:
    """60 bits of an MD5 over the seed and the columns; any SQL engine can repeat it. Null counts as empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def mix(
    docs: DataFrame,
    size: Callable[[Column], Column] = word_count,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """``docs`` plus size, source_size, target and repeats (how often the mix takes the document), as ``__``-columns.

    A source with target t and size s takes every document floor(t/s) times, and once more those that come first in
    a seeded order, until the rest of the target is met as nearly as whole documents allow. The order is by hash;
    documents are summed in hash buckets first, so only the bucket in which the target falls is sorted.
    Null sources are a source; null, empty texts have size 0 and are taken with the whole rounds only. The order is by
    id, source and text, so rows that share an id (or have none) are told apart. Of rows that are equal in all three as
    many are taken as bring the sum nearest to the rest; which of them does not matter. No rows: no rows.
    """
    docs, new, old = apart(docs, ADDED)
    id_col, source_col = new[id_col], new[source_col]
    own = docs.withColumn("__size", size(F.col(new[text_col]))).withColumn("__hash", seeded_hash(seed, id_col, source_col, new[text_col]))
    own = own.withColumn("__bucket", F.pmod(F.col("__hash"), F.lit(BUCKETS)).cast("int"))
    slim = saved(own.select(F.col(source_col).alias("source"), "__bucket", "__hash", "__size"), "mixing-sizes")
    sums = slim.groupBy("source", "__bucket").agg(F.sum("__size").alias("n"))
    sources = sums.groupBy("source").agg(F.sum("n").alias("source_size"))
    targets = fill_targets(cyclic_weights(sources, weights), share, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.withColumn("whole", F.floor(rate).cast("bigint")).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )
    # the bucket in which each source's rest ends, and what the buckets before it hold
    order = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        sums.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
        .join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("n")))
        .select("s", F.col("__bucket").alias("edge"), "before", "rest")
    )
    # inside that bucket: the hash at which the sum reaches the rest, and what is still missing there
    inside = slim.join(edges, F.col("source").eqNullSafe(F.col("s")) & (F.col("__bucket") == F.col("edge")))
    inside = inside.groupBy("s", "__hash").agg(
        F.sum("__size").alias("n"), F.count(F.lit(1)).alias("rows"), F.first("before").alias("before"), F.first("rest").alias("rest")
    )
    upto = Window.partitionBy("s").orderBy("__hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = (
        inside.withColumn("sum", F.col("before") + F.sum("n").over(upto))
        .where(F.col("sum") >= F.col("rest"))
        .groupBy("s")
        .agg(F.min(F.struct("__hash", "rows", (F.col("rest") - F.col("sum") + F.col("n")).alias("missing"))).alias("at"))
        .select("s", F.col("at.__hash").alias("last"), F.col("at.rows").alias("rows"), F.col("at.missing").alias("missing"))
    )
    cuts = (
        plan.select(F.col("source").alias("__source"), "source_size", "target", "whole", "rest")
        .join(edges.select(F.col("s").alias("e"), "edge"), F.col("__source").eqNullSafe(F.col("e")), "left")
        .join(best, F.col("__source").eqNullSafe(F.col("s")), "left")
        .select("__source", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), "whole", "rest", "edge", "last", "rows", "missing")
    )
    at_last = F.coalesce((F.col("__bucket") == F.col("edge")) & (F.col("__hash") == F.col("last")), F.lit(False))
    taken = F.when(F.col("rest") <= 0, F.lit(0)).otherwise(
        F.when(F.col("edge").isNull() | (F.col("__bucket") < F.col("edge")), 1)
        .when((F.col("__bucket") == F.col("edge")) & (F.col("__hash") < F.col("last")), 1)
        .when(at_last & (F.col("missing") * 2 > F.col("__size")), 1)
        .otherwise(0)
    )
    # written, so that Spark knows its size and broadcasts it only where it is small
    cuts = saved(cuts, "mixing-cuts")
    mixed = own.join(cuts, F.col(source_col).eqNullSafe(F.col("__source")))
    mixed = mixed.withColumn("__repeats", F.col("whole") + F.coalesce(taken, F.lit(0)))
    out = mixed.select(*docs.columns, *ADDED)
    if not cuts.where("rows > 1 AND rest > 0").isEmpty():
        # several rows stand where the rest ends
        several = at_last & (F.col("rows") > 1)
        out = mixed.where(~several).select(*docs.columns, *ADDED).unionByName(shared_end(mixed.where(several), docs.columns))
    return out.toDF(*old, *ADDED)


def shared_end(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one order: as many of them taken once more as bring their sum nearest to what is ``missing``.

    Rows that agree in all columns are counted before they are shuffled, and written out again in runs of RUN, so no
    task holds a large group. Columns must be of types that can be grouped.
    """
    kept = [*columns, "__size", "__source_size", "__target", "whole", "missing", "__source", "__hash"]
    counted = rows.select(*kept).groupBy(*kept).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("__source", "__hash").orderBy(*[F.col(c).asc_nulls_last() for c in columns])
    before = F.coalesce(F.sum(F.col("n") * F.col("__size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    exact = F.when(F.col("__size") > 0, F.ceil((F.col("missing") - before) / F.col("__size") - F.lit(0.5))).otherwise(F.lit(0))
    counted = counted.withColumn("__k", F.least(F.greatest(exact, F.lit(0)), F.col("n")))
    runs = counted.withColumn("__first", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"), F.lit(RUN).cast("bigint"))))
    runs = runs.hint("rebalance")
    each = runs.withColumn("__nth", F.explode(F.sequence("__first", F.least(F.col("__first") + (RUN - 1), F.col("n")))))
    repeats = F.col("whole") + F.when(F.col("__nth") <= F.col("__k"), 1).otherwise(0)
    return each.withColumn("__repeats", repeats).select(*columns, *ADDED)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of ``mix``'s result as often as it is taken, without the ``__``-columns."""
    plain = [c for c in mixed.columns if c not in ADDED]
    often = mixed.where("__repeats > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__repeats").cast("int"))))
    return often.select(*plain)
