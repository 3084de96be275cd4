"""Dense global row numbers without sending all rows to one task.

Rows are grouped in buckets that follow the wanted order. Only the per-bucket counts
(one row per bucket) are summed up in sequence; rows are numbered inside their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_offsets(counts: DataFrame, by: list[str], bucket: str, n: str, out: str) -> DataFrame:
    """Rows before each bucket, per group ``by``. One row per bucket, so the window is small."""
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    w = w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)).cast("bigint"))


def global_rank(df: DataFrame, bucket: Column, order: list[Column], out: str) -> DataFrame:
    """Add ``out`` = 0, 1, 2, … following (bucket, order).

    ``bucket`` must be monotone in the wanted order and hold a bounded number of rows each.
    """
    tagged = df.withColumn("__bucket", bucket)
    counts = tagged.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = running_offsets(counts, [], "__bucket", "__n", "__base").select("__bucket", "__base")
    w = Window.partitionBy("__bucket").orderBy(*order)
    numbered = tagged.withColumn("__rn", F.row_number().over(w).cast("bigint"))
    return (
        numbered.join(offsets, "__bucket")
        .withColumn(out, F.col("__base") + F.col("__rn") - 1)
        .drop("__bucket", "__rn", "__base")
    )
