"""The published views as one continuous job.

Asset records, signature mappings, the list of unmapped signatures and indicators arrive on topics of one stream. Each
micro-batch gives every view its own rows; a view without rows is not touched. Which version of each view belongs
together is one small registry of its own, written last: readers never see half of a batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.operators.indicators import validate_iocs
from logspark.operators.inventory import latest_by
from logspark.schemas import RECORD, RECORD_COLUMNS
from logspark.sinks.outputs import MISSING_SIDS_KEY
from logspark.sources.dimensions import parse_assets
from logspark.streaming.allocate import INDICATOR_STATE, register_indicators
from logspark.streaming.jobs import ARRIVAL, SID_MAP_STATE, run_batches, sid_map_messages
from logspark.streaming.registry import Registry, last_wins

ASSET_STATE = f"address STRING, {RECORD}, seq {ARRIVAL}"
LIST_STATE = f"name STRING, list STRING, seq {ARRIVAL}"
POINTER_STATE = "view STRING, version BIGINT, changed BIGINT"


@dataclass
class Views:
    """The registries behind the views, below one folder, and the pointer that publishes them."""

    spark: SparkSession
    path: str
    parts: dict[str, Registry] = field(init=False)
    pointer: Registry = field(init=False)

    def __post_init__(self) -> None:
        schemas = {"assets": ASSET_STATE, "sid_map": SID_MAP_STATE, "missing": LIST_STATE, "indicators": INDICATOR_STATE}
        self.parts = {name: Registry(self.spark, f"{self.path}/{name}", schema) for name, schema in schemas.items()}
        self.pointer = Registry(self.spark, f"{self.path}/published", POINTER_STATE, buckets=1)

    def published(self) -> dict[str, tuple[int, int]]:
        """Version of each published view and the number of its rows that changed last."""
        return {r["view"]: (r["version"], r["changed"]) for r in self.pointer.read().collect()}

    def read(self, view: str) -> DataFrame:
        """Rows of a view as last published: records, mappings, unmapped signatures (sid, msg) or indicators."""
        part = self.parts[view]
        version = self.published().get(view, (0, 0))[0]
        rows = part.read(before=version + 1)
        if view == "assets":
            return rows.select(*RECORD_COLUMNS)
        if view == "missing":
            entries = F.explode(F.from_json("list", "array<struct<sid: bigint, msg: string>>")).alias("e")
            return rows.select(entries).select("e.*")
        return rows.drop("seq", "item")

    def publish(self, batch_id: int) -> None:
        """Point to the newest version of each view that changed in content. Views of which nothing changed stay."""
        before = self.published()
        rows = []
        for view, part in self.parts.items():
            version, was = part.newest(), before.get(view, (0, 0))[0]
            if version > was:
                changed = part.difference(was, ["seq"]).count()
                if changed:
                    rows.append((view, version, changed))
        if rows:
            self.pointer.update(self.spark.createDataFrame(rows, POINTER_STATE), batch_id, _replaced)


def _replaced(previous: DataFrame, batch: DataFrame) -> DataFrame:
    return previous.join(batch.select("view"), "view", "left_anti").unionByName(batch)


def start_views(
    stream: DataFrame,
    views: Views,
    asset_topic: str,
    map_topic: str,
    list_topic: str,
    indicator_topic: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Keep the views up to date from a stream of envelopes.

    The last record of an address and the last mapping of an id count, in order of arrival; the list of unmapped
    signatures is replaced as a whole; indicators get their ids from committed ranges. Broken messages change nothing.
    """
    seq = F.struct("timestamp", "topic", "partition", "offset").alias("seq")

    def each(batch: DataFrame, batch_id: int) -> None:
        of = lambda topic: batch.filter(F.col("topic") == topic)
        records = parse_assets(of(asset_topic)).filter("_error IS NULL AND addr IS NOT NULL")
        records = records.select(F.col("addr").alias("address"), *RECORD_COLUMNS, seq)
        views.parts["assets"].update(latest_by(records, "address", "seq"), batch_id, last_wins("address", "seq"))

        mappings = latest_by(sid_map_messages(of(map_topic)), "sid", "seq")
        views.parts["sid_map"].update(mappings, batch_id, last_wins("sid", "seq"))

        entries = F.from_json("value", "array<struct<sid: bigint, msg: string>>")
        lists = of(list_topic).filter((F.col("key") == MISSING_SIDS_KEY) & (F.size(entries) > 0))
        lists = lists.select(F.col("key").alias("name"), F.col("value").alias("list"), seq)
        views.parts["missing"].update(latest_by(lists, "name", "seq"), batch_id, last_wins("name", "seq"))

        asked = of(indicator_topic).select(F.from_json("value", "type STRING, value STRING").alias("i"), "offset", "timestamp")
        asked = asked.select("i.*", F.col("offset").alias("seq"), F.col("timestamp").alias("added"))
        valid = validate_iocs(asked).filter("_error IS NULL")
        register_indicators(views.parts["indicators"], valid.drop("_error"), batch_id)
        views.publish(batch_id)

    return run_batches(stream, each, checkpoint, once)
