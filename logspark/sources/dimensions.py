"""Dimension files: techniques, signature mappings, networks, inventory and asset feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logspark.functions.dynamic import parse_object
from logspark.functions.ip import canon_ip, cidr_address
from logspark.schemas import INVENTORY, NETWORKS, RECORD, SID_MAP, STIX_BUNDLE, VCENTER


def load_techniques(spark: SparkSession, path: str) -> DataFrame:
    """ID, Name, URL, Phases of every live attack pattern in STIX bundles; last one wins per id.

    A bundle is one JSON document. Several bundle files count in the order of their names.
    """
    bundle = spark.read.schema(STIX_BUNDLE).option("multiLine", True).json(path)
    return techniques_of(bundle.select("objects", F.col("_metadata.file_path").alias("doc")))


def techniques_of(bundle: DataFrame) -> DataFrame:
    objects = bundle.select("doc", F.posexplode("objects").alias("pos", "o"))
    live = objects.filter((F.col("o.type") == "attack-pattern") & ~F.coalesce("o.revoked", F.lit(False)))
    phases = F.transform(
        F.filter("o.kill_chain_phases", lambda p: p["kill_chain_name"] == "mitre-attack"), lambda p: p["phase_name"]
    )
    phases = F.when(F.size("o.kill_chain_phases") > 0, phases)
    refs = live.select(
        "doc", "pos", F.col("o.name").alias("Name"), phases.alias("Phases"), F.posexplode("o.external_references").alias("rpos", "r")
    ).filter(F.col("r.source_name") == "mitre-attack")
    row = F.struct("Name", F.col("r.url").alias("URL"), "Phases")
    last = refs.groupBy(F.col("r.external_id").alias("ID")).agg(F.max_by(row, F.struct("doc", "pos", "rpos")).alias("t"))
    return last.select("ID", "t.*")


def load_sid_map(spark: SparkSession, path: str) -> DataFrame:
    """sid, tactic, id, name, msg by position after a header line; a bad sid fails the load."""
    return (
        spark.read.schema(SID_MAP)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .csv(path)
    )


# column name in the export -> our name
NETWORK_COLUMNS = {
    "Name": "name",
    "Abbreviation": "abbreviation",
    "VLAN/Portgroup": "vlan",
    "IPv4": "ipv4",
    "IPv6": "ipv6",
    "Description": "description",
    "WHOIS": "whois",
    "Team": "team",
}


def load_networks(spark: SparkSession, path: str) -> DataFrame:
    """One row per id of a column-oriented export; up to two backslashes in a CIDR are dropped."""
    doc = spark.read.schema(NETWORKS).option("multiLine", True).json(path)
    return networks_of(doc)


def networks_of(doc: DataFrame) -> DataFrame:
    rows = doc.select(F.explode(F.map_keys("Name")).alias("__id"), "*")
    picked = []
    for source, name in NETWORK_COLUMNS.items():
        value = F.try_element_at(F.col(f"`{source}`"), F.col("__id"))
        if name in ("ipv4", "ipv6"):
            value = F.regexp_replace(F.regexp_replace(value, r"^([^\\]*)\\", "$1"), r"^([^\\]*)\\", "$1")
        picked.append(value.alias(name))
    return rows.select(F.col("__id").cast("int").alias("id"), *picked)


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """Target rows of an inventory export ``{"result": […]}``."""
    return spark.read.schema(INVENTORY).option("multiLine", True).json(path).select(F.explode("result").alias("t")).select("t.*")


def _checked(df: DataFrame, schema: str, address: Column, error_text: str) -> DataFrame:
    out = df.withColumn("__o", F.from_json(F.when(parse_object("value").isNotNull(), F.col("value")), schema))
    bad = F.when(F.col("__o").isNull(), F.lit("not a JSON object")).when(address, F.lit(error_text))
    return out.select(*df.columns, "__o.*", bad.alias("_error"))


def parse_assets(df: DataFrame) -> DataFrame:
    """Inventory records from JSON rows; malformed rows get ``_error``. Addresses become canonical."""
    o = F.col("__o")
    bad_ip = (o["addr"].isNotNull()) & (o["addr"] != "") & canon_ip(o["addr"]).isNull()
    out = _checked(df, RECORD, bad_ip, "bad address")
    return out.withColumn("addr", canon_ip(F.col("addr")))


def parse_vcenter(df: DataFrame) -> DataFrame:
    """VM report rows; a missing or malformed CIDR is a reject."""
    o = F.col("__o")
    return _checked(df, VCENTER, o["ip"].isNull() | cidr_address(o["ip"]).isNull(), "bad or missing ip")


