"""The batch operators as continuous queries.

Parsing jobs are stateless, so they run on a stream as they are. Enrichment needs the newest asset
registry, which changes while the query runs: both feeds are read in one query and each micro-batch
first applies its asset rows, then enriches its events against the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.functions.joins import Lookup
from logspark.operators.enrich import enrich, host_answers
from logspark.operators.inventory import asset_index, index_lookup, latest_by
from logspark.operators.rules import Rule
from logspark.operators.sidmap import join_sid_map, sid_answers
from logspark.schemas import RECORD
from logspark.sources.dimensions import parse_assets
from logspark.sources.topics import with_kind
from logspark.streaming.registry import Registry, first_wins, last_wins, retractable

INDEX_SCHEMA = f"key STRING, {RECORD}"
MISSING_HOSTS = "host STRING"
MISSING_SIDS = "sid BIGINT, msg STRING"
ARRIVAL = "STRUCT<timestamp: TIMESTAMP, topic: STRING, partition: INT, offset: BIGINT>"
SID_MAP_STATE = f"sid BIGINT, tactic STRING, id STRING, name STRING, msg STRING, seq {ARRIVAL}"


def run_batches(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start a foreachBatch query; ``once`` drains what is there and stops."""
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def start_enrich(
    stream: DataFrame,
    registry: Registry,
    asset_topic: str,
    topic_map: dict[str, str],
    techniques: Lookup,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    rules: list[Rule] | None = None,
    once: bool = False,
    missing: Registry | None = None,
) -> StreamingQuery:
    """Enrich a stream of envelopes that carries events and asset records.

    ``sink(enriched, batch_id)`` must be idempotent per batch id (e.g. write to a folder named by
    it), as a micro-batch may run twice after a failure. ``missing`` (``MISSING_HOSTS``) is the set of hosts that
    nothing answers to: a host enters it when it is missed, and leaves it when a later batch finds it.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        assets = parse_assets(batch.filter(F.col("topic") == asset_topic))
        # offsets of different partitions do not compare, so the time of the message comes first
        records = assets.filter(F.col("_error").isNull()).withColumn("seq", F.struct("timestamp", "topic", "partition", "offset"))
        index = registry.update(asset_index(records, "seq"), batch_id, first_wins)
        events = with_kind(batch.filter(F.col("topic") != asset_topic), topic_map).drop("_error")
        enriched = enrich(events, index_lookup(index), techniques, rules)
        if missing is not None:
            enriched = enriched.persist()
        try:
            sink(enriched, batch_id)
            if missing is not None:
                missing.update(host_answers(enriched), batch_id, retractable)
        finally:
            enriched.unpersist()

    return run_batches(stream, each, checkpoint, once)


def start_sid_map(
    stream: DataFrame,
    mappings: Registry,
    missing: Registry,
    map_topic: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Keep the newest mapping per signature id and the set of ids that alerts carry and no mapping answers to.

    ``stream`` has envelopes: mapping rows as JSON on ``map_topic``, alerts on the others. ``mappings`` holds
    ``SID_MAP_STATE``, ``missing`` ``MISSING_SIDS``. An id whose mapping arrives later leaves the set: at the next
    alert that carries it, or at once, as the mappings of a batch count as asked for.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        fresh = sid_map_messages(batch.filter(F.col("topic") == map_topic))
        mappings.update(latest_by(fresh, "sid", "seq"), batch_id, last_wins("sid", "seq"))
        alerts = alert_sids(batch.filter(F.col("topic") != map_topic))
        asked = alerts.select("sid").unionByName(fresh.select("sid")).distinct()
        known = mappings.touching(asked)
        joined = join_sid_map(alerts.unionByName(fresh.select("sid", "msg")), known, ["sid", "msg"])
        missing.update(sid_answers(joined), batch_id, retractable)

    return run_batches(stream, each, checkpoint, once)


def sid_map_messages(rows: DataFrame) -> DataFrame:
    """Mapping rows of their topic, with their place in the order of arrival; broken ones are left out."""
    fields = F.from_json("value", "sid BIGINT, tactic STRING, id STRING, name STRING, msg STRING")
    seq = F.struct("timestamp", "topic", "partition", "offset").alias("seq")
    return rows.select(fields.alias("m"), seq).select("m.*", "seq").filter(F.col("sid").isNotNull())


def alert_sids(rows: DataFrame) -> DataFrame:
    """(sid, msg) of events that carry a signature id."""
    sid = F.get_json_object("value", "$.alert.signature_id").try_cast("bigint")
    found = rows.select(sid.alias("sid"), F.get_json_object("value", "$.alert.signature").alias("msg"))
    return found.filter(F.col("sid").isNotNull())


def start_parse(
    stream: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Run a stateless job on a stream into Parquet, exactly once."""
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return (
        job(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
