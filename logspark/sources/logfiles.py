"""Log directories: lines with file offsets, line ranges and file statistics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logspark.functions.ranks import running_offsets
from logspark.session import scratch_path

# Rows of the block table that are broadcast: about 100 MB.
MAX_BLOCKS = 4_000_000


def splits_are_fixed(spark: SparkSession) -> bool:
    """Whether files are split alike at every scan, however many executors are alive at the moment."""
    named = ("spark.sql.files.minPartitionNum", "spark.sql.leafNodeDefaultParallelism")
    context = spark.sparkContext
    return (
        any(spark.conf.get(name, None) for name in named)
        or context.getConf().contains("spark.default.parallelism")
        or context.master.startswith("local[")
    )


def read_logs(spark: SparkSession, path: str, kind: str | None = None, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Every line below a folder (plain or gzip): value, path, offset (0-based), kind.

    Line numbers need no sort and no shuffle of lines. Spark reads a file in blocks, each block by one task in order,
    and ``monotonically_increasing_id`` counts up inside a task. A first scan writes a table with one row per block: a
    numeric key, the block's first id, and the lines in earlier blocks of its file. The second scan looks each line's
    block up in it. The table has 24 bytes for each 128 MiB of text, or for each file if files are small; it is
    broadcast up to ``max_blocks`` rows. Beyond, which takes very many small files, lines are counted in their task,
    batch by batch, and only blocks that are not the first of their file are looked up.

    Both scans must split the files alike. Where the session does not fix the splits, the lines and their ids are
    written once below the shared folder and read from there; the session's settings stay as they are.
    """
    block = F.xxhash64("path", "__start")
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__start"))
        .select("value", "path", "__start", F.monotonically_increasing_id().alias("__id"))
    )
    if not splits_are_fixed(spark):
        lines = _written(lines, "lines")
    counted = lines.groupBy("path", "__start").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    placed = running_offsets(counted, ["path"], "__start", "__n", "__base")
    blocks = _written(placed.select(block.alias("__block"), "__first", "__base"), "blocks")
    if blocks.count() <= max_blocks:
        numbered = lines.withColumn("__block", block).join(F.broadcast(blocks), "__block")
        offset = F.col("__base") + F.col("__id") - F.col("__first")
    else:
        later = blocks.where("__base > 0").drop("__first")
        numbered = counted_lines(lines).withColumn("__block", block).join(F.broadcast(later), "__block", "left")
        offset = F.coalesce("__base", F.lit(0)) + F.col("__at")
    return numbered.select("value", "path", offset.alias("offset"), F.lit(kind).cast("string").alias("kind"))


def _written(df: DataFrame, label: str) -> DataFrame:
    held = scratch_path(df.sparkSession, label)
    df.write.parquet(held)
    return df.sparkSession.read.schema(df.schema).parquet(held)


def counted_lines(lines: DataFrame) -> DataFrame:
    """Add ``__at``, a line's number within its block; the lines of a block follow each other in one task."""

    def run(batches):
        last, done = None, 0
        for batch in batches:
            starts, paths = batch["__start"].to_pylist(), batch["path"].to_pylist()
            at = []
            for here in zip(paths, starts):
                done = done + 1 if here == last else 0
                last = here
                at.append(done)
            yield pa.RecordBatch.from_arrays([batch["value"], batch["path"], batch["__start"], pa.array(at, pa.int64())], names)

    names = ["value", "path", "__start", "__at"]
    return lines.select(*names[:3]).mapInArrow(run, "value string, path string, __start bigint, __at bigint")


def slice_lines(df: DataFrame, begin: int, end: int = 0) -> DataFrame:
    """Lines ``begin``..``end``, both included; an end of 0 or less means to the end of the file."""
    test = F.col("offset") >= begin
    return df.filter(test & (F.col("offset") <= end) if end > 0 else test)


def get_line(df: DataFrame, num: int) -> DataFrame:
    return df.filter(F.col("offset") == num)


def file_stats(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Per file: first and last line, line count, offsets and the time span.

    ``ts`` reads the time of a line; it is applied to the two edge lines only. A span that runs
    backwards or has no time sets ``_error``.
    """
    edges = df.groupBy("path").agg(
        F.min_by("value", "offset").alias("first_line"),
        F.max_by("value", "offset").alias("last_line"),
        F.count(F.lit(1)).alias("lines"),
    )
    out = edges.withColumn("beginning", F.lit(0).cast("bigint")).withColumn("end", F.col("lines"))
    if ts is None:
        return out
    both = out.withColumn("__edge", F.explode(F.array(F.lit("first"), F.lit("last"))))
    both = both.withColumn("value", F.when(F.col("__edge") == "first", F.col("first_line")).otherwise(F.col("last_line")))
    both = both.withColumn("__ts", ts)
    span = both.groupBy(*out.columns).agg(
        F.max(F.when(F.col("__edge") == "first", F.col("__ts"))).alias("first_ts"),
        F.max(F.when(F.col("__edge") == "last", F.col("__ts"))).alias("last_ts"),
    )
    error = F.when(F.col("first_ts").isNull() | F.col("last_ts").isNull(), F.lit("no time")).when(
        F.col("last_ts") < F.col("first_ts"), F.lit("end before beginning")
    )
    return span.withColumn("_error", error)
