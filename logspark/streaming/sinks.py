"""Archives, files, queues and machine facts written from a stream.

Every micro-batch has a folder of its own below the target, named by its number; a replay writes the same folder again.
Spark marks a folder that is done, so readers take the marked ones: what a crash left half written is not seen, and is
replaced when the batch runs again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logspark.operators.inventory import latest_by
from logspark.operators.views import inventory_facts
from logspark.sinks.outputs import batch_folder
from logspark.streaming.jobs import run_batches
from logspark.streaming.registry import Registry, last_wins

BATCH = re.compile(r"batch=(\d+)")
FACT_STATE = "fqdn STRING, pythonversion STRING, updated TIMESTAMP, year INT"

Write = Callable[[DataFrame, int], None]


def start_sinks(stream: DataFrame, writes: list[Write], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Give each micro-batch to several ``write(rows, batch_id)``, e.g. ``partial(archive, path=…)`` by keyword.

    The batch is kept while they run, so its source is read once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for write in writes:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return run_batches(stream, each, checkpoint, once)


def finished_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the batches below ``path`` that were written to the end, in order of their numbers."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = []
    for status in files.listStatus(root):
        part = BATCH.fullmatch(status.getPath().getName())
        if part and files.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
            found.append((int(part[1]), f"{path}/{part[0]}"))
    return [folder for _, folder in sorted(found)]


def read_finished(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame:
    """Rows of all finished batches; partition folders below a batch are columns as ever."""
    folders = finished_batches(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    rows = [spark.read.format(fmt).schema(schema).load(folder) for folder in folders]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def write_facts(history_path: str, latest: Registry) -> Write:
    """Machine facts into a yearly history, by batch, and the newest row per machine into ``latest`` (``FACT_STATE``)."""

    def write(facts: DataFrame, batch_id: int) -> None:
        rows = inventory_facts(facts).select("fqdn", "pythonversion", "updated", "year")
        folder, mode = batch_folder(history_path, batch_id)
        rows.write.mode(mode).partitionBy("year").parquet(folder)
        latest.update(latest_by(rows, "fqdn", "updated"), batch_id, last_wins("fqdn", "updated"))

    return write
