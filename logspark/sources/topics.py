"""Event topics: reading, kind assignment and keyed peeking."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logspark.fixed import KINDS, PARSERS
from logspark.schemas import ENVELOPE

# Start mode -> startingOffsets. A checkpoint, when there is one, always takes precedence.
START_MODES = {"earliest": "earliest", "latest": "latest", "commit": "latest"}


def read_events(
    spark: SparkSession,
    source: str,
    mode: str = "latest",
    topics: list[str] | None = None,
    streaming: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Envelope rows from a broker list or from a folder.

    ``source`` is either ``kafka:host:port,…`` (needs the connector package) or a folder of
    Parquet or JSON files with the envelope columns. ``mode`` is earliest, latest or commit;
    commit continues from the query's checkpoint, which replaces committed group offsets.
    """
    if mode not in START_MODES:
        raise ValueError(f"unknown start mode {mode!r}")
    reader = spark.readStream if streaming else spark.read
    if source.startswith("kafka:"):
        if not topics:
            raise ValueError("a broker source needs topics")
        start = START_MODES[mode] if streaming else "earliest"
        raw = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", source.removeprefix("kafka:"))
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", start)
            .options(**(options or {}))
            .load()
        )
        return raw.select(
            F.col("value").cast("string"), F.col("key").cast("string"), "topic", "partition", "offset", "timestamp"
        )
    fmt = "json" if (options or {}).get("format") == "json" else "parquet"
    extra = {k: v for k, v in (options or {}).items() if k != "format"}
    rows = reader.format(fmt).schema(ENVELOPE).options(**extra).load(source)
    return rows.filter(F.col("topic").isin(topics)) if topics else rows


def parse_topic_map(items: list[str]) -> dict[str, str]:
    """``["topic:kind", …]`` -> mapping. Both parts must be set and the kind must be known."""
    if not items:
        raise ValueError("empty topic map")
    out = {}
    for item in items:
        parts = item.split(":")
        if len(parts) != 2:
            raise ValueError(f"{item!r}: should split to 2 substrings")
        topic, kind = parts
        if not topic:
            raise ValueError(f"{item!r}: empty topic")
        if not kind:
            raise ValueError(f"{item!r}: empty event type")
        if kind not in KINDS:
            raise ValueError(f"{item!r}: unknown event type {kind}")
        out[topic] = kind
    return out


def parser_name(name: str) -> str:
    return name if name in PARSERS else PARSERS[-1]


def _mapped(key: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def with_kind(df: DataFrame, mapping: dict[str, str], parsers: dict[str, str] | None = None) -> DataFrame:
    """Add ``kind`` from the topic; an unmapped topic sets ``_error``. Optionally add ``parser``."""
    out = df.withColumn("kind", _mapped(F.col("topic"), mapping))
    out = out.withColumn("_error", F.when(F.col("kind").isNull(), F.lit("invalid kind")))
    if parsers is not None:
        named = {topic: parser_name(p) for topic, p in parsers.items()}
        chosen = _mapped(F.col("topic"), named) if named else F.lit(None).cast("string")
        out = out.withColumn("parser", F.coalesce(chosen, F.lit(PARSERS[-1])))
    return out


def clean_path(path: str) -> str:
    """Drop doubled and trailing slashes and resolve dots, as configured folders may be sloppy."""
    return posixpath.normpath(path)


def with_dir_kind(df: DataFrame, mapping: dict[str, str], path: str = "path") -> DataFrame:
    """Add ``kind`` from the folder a file lies in; folders outside the map set ``_error``."""
    folder = F.regexp_replace(F.regexp_replace(F.col(path), r"^file:/+", "/"), r"/+[^/]*$", "")
    folder = F.regexp_replace(folder, "/{2,}", "/")
    cleaned = {clean_path(k): v for k, v in mapping.items()}
    out = df.withColumn("kind", _mapped(folder, cleaned))
    return out.withColumn("_error", F.when(F.col("kind").isNull(), F.lit("invalid kind")))


def peek_topic(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows of one key (or all) with a ``kafka`` object added to their JSON.

    Text that is no JSON is returned as it is; ``consumed`` is false for it.
    """
    rows = df if key is None else df.filter(F.col("key") == key)
    parsed = F.from_json(F.when(F.startswith(F.ltrim("value"), F.lit("{")), F.col("value")), "map<string,variant>")
    rows = rows.withColumn("__o", F.when(F.expr("try_parse_json(value)").isNotNull(), parsed))
    note = F.to_json(
        F.struct(F.unix_millis("timestamp").alias("timestamp"), "partition", "offset", "key"),
        {"ignoreNullFields": "false"},
    )
    wrapped = F.from_json(F.concat(F.lit('{"kafka":'), note, F.lit("}")), "map<string,variant>")
    noted = F.map_concat(F.map_filter("__o", lambda k, v: k != "kafka"), wrapped)
    return rows.select(
        *df.columns,
        F.when(F.col("__o").isNotNull(), F.to_json(noted)).otherwise(F.col("value")).alias("line"),
        F.col("__o").isNotNull().alias("consumed"),
    )
