"""Published views of the dimensions: JSON, CSV and tagger text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import SID_MAP_COLUMNS, TAGGER_HEADER
from logspark.operators.inventory import latest_by
from logspark.schemas import RECORD_COLUMNS
from logspark.sinks.outputs import batch_folder


def asset_json(records: DataFrame) -> DataFrame:
    return records.select(F.to_json(F.struct(*RECORD_COLUMNS)).alias("value"))


def tagger_lines(records: DataFrame) -> DataFrame:
    """``addr;0=fqdn;1=pretty;2=team;3=os;4=network`` per record."""
    parts = [F.col("addr")] + [
        F.concat(F.lit(f"{i}="), F.coalesce(name, F.lit("")))
        for i, name in enumerate(("fqdn", "pretty", "team", "os", "network_name"))
    ]
    return records.select(F.concat_ws(";", *parts).alias("value"))


def tagger_text(records: DataFrame) -> DataFrame:
    """Header lines, then the records; ``part`` keeps the header first."""
    spark = records.sparkSession
    header = spark.createDataFrame([(0, i, line) for i, line in enumerate(TAGGER_HEADER)], "part INT, pos INT, value STRING")
    body = tagger_lines(records).select(F.lit(1).alias("part"), F.lit(0).alias("pos"), "value")
    return header.unionByName(body).orderBy("part", "pos", "value")


def latest_sid_map(updates: DataFrame, order: str, previous: DataFrame | None = None) -> DataFrame:
    """Newest row per sid. An empty update keeps the previous view."""
    view = latest_by(updates.select(*SID_MAP_COLUMNS, order), "sid", order).select(*SID_MAP_COLUMNS)
    if previous is not None and view.isEmpty():
        return previous.select(*SID_MAP_COLUMNS)
    return view


def replace_missing_sids(updates: DataFrame, previous: DataFrame) -> DataFrame:
    """The list of unmapped ids is replaced as a whole, unless the update is empty. Both have sid and msg."""
    return previous if updates.isEmpty() else updates


def sid_map_csv(view: DataFrame) -> DataFrame:
    """CSV text column per row, quoted only where needed."""

    def cell(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.rlike(r'[",\r\n]|^\s'), quoted).otherwise(text)

    return view.select("sid", F.concat_ws(",", *[cell(c) for c in SID_MAP_COLUMNS]).alias("line"))


def sid_key_values(view: DataFrame) -> DataFrame:
    """sid -> the whole row as JSON."""
    return view.select("sid", F.to_json(F.struct("*")).alias("value"))


def field_tags(assets: DataFrame, prefix: str, ip: str = "ip", order: str = "seq") -> DataFrame:
    """``ip;prefix.key=value;…`` per address, skipping empty values; the last row of an address wins."""
    names = [c for c in assets.columns if c not in (ip, order)]
    rows = latest_by(assets.filter(F.col(ip).isNotNull()), ip, order)
    pairs = [
        F.when(F.coalesce(F.col(n).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{prefix}.{n}="), F.col(n).cast("string")))
        for n in names
    ]
    return rows.select(F.col(ip).alias("ip"), F.concat(F.col(ip), F.lit(";"), F.concat_ws(";", *pairs)).alias("tagger"))


def inventory_facts(facts: DataFrame) -> DataFrame:
    """Usable facts: rows with data and a version; the version list is joined by dots."""
    usable = facts.filter(F.col("fqdn").isNotNull() & F.col("pythonversion").isNotNull())
    version = F.array_join(F.col("pythonversion").cast("array<string>"), ".")
    return usable.withColumn("pythonversion", version).withColumn("year", F.year("updated"))


def dual_write(
    facts: DataFrame, history_path: str, latest_path: str, previous: DataFrame | None = None, run: int | None = None
) -> None:
    """Append usable facts to the yearly history and write the newest row per machine.

    ``run`` numbers the run: its rows lie in a folder of their own, and a second try of the run replaces them and its
    ``latest_path``. Without it rows are appended, and a second try would add them again.

    ``latest_path`` must be a new folder. ``previous`` is the view of the run before: the new facts are merged into
    it, so the history is not read, and machines that sent nothing stay. Without it the view is taken over the whole
    history, as the first run and a repair need.
    """
    rows = inventory_facts(facts)
    folder, mode = batch_folder(history_path, run)
    rows.write.mode(mode).partitionBy("year").parquet(folder)
    if previous is None:
        known = facts.sparkSession.read.schema(rows.schema).parquet(history_path)
    else:
        known = previous.select(*rows.columns).unionByName(rows)
    latest_by(known, "fqdn", "updated").write.mode("errorifexists" if run is None else "overwrite").parquet(latest_path)
