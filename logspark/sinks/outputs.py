"""Topic routing, archives, per-kind files, dated indexes and JSON snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

# Limits of one bulk request to an index.
BULK_ACTIONS = 1000
BULK_BYTES = 2 << 20

# Fixed value: key of the message that lists unmapped signatures.
MISSING_SIDS_KEY = "meerkat_missing_sid_map"

ROWS_PER_FILE = 5_000_000


def route_preprocess(df: DataFrame, base: str) -> DataFrame:
    return df.withColumn("topic", F.concat(F.lit(f"{base}-"), F.col("kind")))


def route_topics(
    df: DataFrame,
    base: str,
    emit_topic: str,
    emit: Column,
    split: bool = False,
    time: str = "event_time",
) -> DataFrame:
    """Output rows (topic, key, value, timestamp) of enriched events.

    Every event goes to the generic topic without a key; an event with an attack block is also sent
    to the fast-track topic, keyed by its kind. Both copies come from one pass.
    """
    generic = F.concat(F.lit(f"{base}-"), F.col("kind")) if split else F.lit(base)
    plain = F.struct(generic.alias("topic"), F.lit(None).cast("string").alias("key"))
    fast = F.struct(F.lit(emit_topic).alias("topic"), F.col("kind").alias("key"))
    routes = F.when(emit, F.array(fast, plain)).otherwise(F.array(plain))
    return df.withColumn("__r", F.explode(routes)).select(
        "__r.topic", "__r.key", "value", F.col(time).alias("timestamp")
    )


def missing_sid_message(missing: DataFrame, topic: str) -> DataFrame:
    """One message for the views' topic: the list of unmapped signatures, by sid. Signatures are few: they are kinds of
    alerts, not alerts. No unmapped signature: no message."""
    blank = [F.lit("").alias(name) for name in ("id", "name", "tactic")]
    entry = F.struct("sid", "msg", *blank)
    listed = missing.agg(F.array_sort(F.collect_list(entry)).alias("list")).where(F.size("list") > 0)
    return listed.select(F.lit(topic).alias("topic"), F.lit(MISSING_SIDS_KEY).alias("key"), F.to_json("list").alias("value"))


def write_topic(df: DataFrame, brokers: str, checkpoint: str | None = None, options: dict[str, str] | None = None):
    """Send (topic, key, value) rows to a broker; needs the connector package."""
    rows = df.select("topic", "key", "value")
    if df.isStreaming:
        return (
            rows.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("checkpointLocation", checkpoint)
            .options(**(options or {}))
            .start()
        )
    rows.write.format("kafka").option("kafka.bootstrap.servers", brokers).options(**(options or {})).save()
    return None


def file_to_topic(lines: DataFrame, topic: str, key: str) -> DataFrame:
    """Lines of a file as messages with one fixed key."""
    return lines.select(F.lit(topic).alias("topic"), F.lit(key).alias("key"), "value")


def batch_folder(path: str, batch_id: int | None) -> tuple[str, str]:
    """Where and how to write: appended, or for a micro-batch into a folder of its own, so that a replay replaces it."""
    return (path, "append") if batch_id is None else (f"{path}/batch={batch_id}", "overwrite")


def archive_columns(df: DataFrame, seconds: int, now: Column, source: str = "topic") -> DataFrame:
    """Add ``source`` (spaces removed) and ``bucket`` (start of the rotation interval)."""
    floor = F.timestamp_seconds(F.call_function("div", F.unix_seconds(now), F.lit(seconds).cast("bigint")) * seconds)
    return df.withColumn("source", F.replace(F.col(source), F.lit(" "), F.lit(""))).withColumn(
        "bucket", F.date_format(floor, "yyyyMMddHHmmss")
    )


def archive(
    df: DataFrame,
    path: str,
    seconds: int = 3600,
    now: Column | None = None,
    source: str = "topic",
    order: str | None = "offset",
    rows_per_file: int = ROWS_PER_FILE,
    batch_id: int | None = None,
) -> None:
    """Gzip text under source=…/bucket=…, one line per row; of a micro-batch, below batch=… and replacing its first try."""
    path, mode = batch_folder(path, batch_id)
    now = F.current_timestamp() if now is None else now
    rows = archive_columns(df, seconds, now, source)
    # AQE merges small (source, bucket) groups into a task and cuts big ones over several
    rows = rows.hint("rebalance", "source", "bucket")
    keys = ["source", "bucket"] + ([order] if order in rows.columns else [])
    (
        rows.sortWithinPartitions(*keys)
        .select("source", "bucket", "value")
        .write.mode(mode)
        .partitionBy("source", "bucket")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .text(path)
    )


def write_files(
    df: DataFrame, combined: str | None = None, per_kind: str | None = None, gzip: bool = True, batch_id: int | None = None
) -> None:
    """One combined text folder and/or one folder per kind; trailing newlines are stripped."""
    rows = df.select("kind", F.regexp_replace("value", r"\n+$", "").alias("value"))
    codec = "gzip" if gzip else "none"
    if combined:
        folder, mode = batch_folder(combined, batch_id)
        rows.select("value").write.mode(mode).option("compression", codec).text(folder)
    if per_kind:
        folder, mode = batch_folder(per_kind, batch_id)
        rows.hint("rebalance", "kind").write.mode(mode).partitionBy("kind").option("compression", codec).text(folder)


def index_name(prefix: str, topic: Column, ts: Column, now: Column) -> Column:
    """``prefix-topic-YYYY.MM.DD``; spaces go, dots and underscores become dashes."""
    clean = F.translate(F.replace(topic, F.lit(" "), F.lit("")), "._", "--")
    return F.concat_ws("-", F.lit(prefix), clean, F.date_format(F.coalesce(ts, now), "yyyy.MM.dd"))


def bulks(rows: Iterable, size: Callable[[object], int]) -> Iterable[list]:
    """Group an iterator into bulk requests by the two limits."""
    batch: list = []
    total = 0
    for row in rows:
        n = size(row)
        if batch and (len(batch) >= BULK_ACTIONS or total + n > BULK_BYTES):
            yield batch
            batch, total = [], 0
        batch.append(row)
        total += n
    if batch:
        yield batch


def write_index(df: DataFrame, send: Callable[[list], None]) -> None:
    """Hand (index, value) rows to ``send`` in bulks, from the tasks that hold them."""

    def run(rows: Iterable) -> None:
        for batch in bulks(rows, lambda r: len(r["value"] or "")):
            send(batch)

    df.select("index", "value").foreachPartition(run)


def append_queue(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Raw JSON of selected events, appended to a Parquet queue."""
    folder, mode = batch_folder(path, batch_id)
    df.select("value").write.mode(mode).parquet(folder)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON snapshot in a new folder."""
    df.write.mode("errorifexists").json(path)
