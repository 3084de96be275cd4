"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logspark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write once below the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame, added: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str], list[str]]:
    """``df`` with columns c0, c1 …, the new name of each, and the old names, for operators that add columns of their own.

    A column with the name of one of ``added``, which the operator returns, is left out: the operator's takes its place.
    """
    old = [c for c in df.columns if c not in added]
    new = {c: f"c{i}" for i, c in enumerate(old)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in new.items()]), new, old


def word_count(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each; a longer text stays alone."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch[column]).to_pylist()):
            n = n or 0
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
