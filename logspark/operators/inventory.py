"""Asset inventory: flattening, lookup keys, registries and the merge with VM reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import DEFENDED_TEAM
from logspark.functions.ip import canon_ip, cidr_address
from logspark.functions.joins import Lookup, as_lookup, attach, small_enough
from logspark.schemas import RECORD_COLUMNS

OS_TAG = r"^os_"


def os_tag(tags: Column, last: bool = False) -> Column:
    """First ``os_`` tag, ``unk`` without one and empty without any tags.

    With ``last``: the last such tag, empty without one (the form the flatten step uses).
    """
    found = F.filter(tags, lambda t: t.rlike(OS_TAG))
    if last:
        return F.coalesce(F.get(found, F.size(found) - 1), F.lit(""))
    return F.when(F.coalesce(F.size(tags), F.lit(0)) < 1, F.lit("")).otherwise(
        F.coalesce(F.get(found, F.lit(0)), F.lit("unk"))
    )


def flatten_targets(targets: DataFrame, aliases: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """Target x instance x interface x address -> one record each, plus ``vm_name``.

    ``aliases`` (name, rename) fills ``pretty``. ``arrival`` is the record's place inside its target. An address that is not CIDR text gets
    ``_error`` rather than stopping the run.
    """
    now = F.current_timestamp() if now is None else now
    rows = (
        targets.select("*", F.posexplode("instances").alias("__i", "i"))
        .select("*", F.posexplode("i.interfaces").alias("__f", "f"))
        .select("*", F.posexplode("f.addresses").alias("__a", "a"))
    )
    flat = rows.select(
        F.col("i.id").alias("ansible_name"),
        F.col("i.hostname").alias("host_name"),
        F.col("i.vm_name").alias("vm_name"),
        F.col("i.domain").alias("domain"),
        "role",
        cidr_address(F.col("a.address")).alias("addr"),
        F.col("team_name").alias("team"),
        os_tag(F.coalesce("tags", F.array().cast("array<string>")), last=True).alias("os"),
        F.col("f.network_id").alias("network_name"),
        now.alias("updated"),
        F.col("i.fqdn").alias("fqdn"),
        F.struct("__i", "__f", "__a").alias("arrival"),
    )
    if aliases is None:
        flat = flat.withColumn("pretty", F.lit(None).cast("string"))
    else:
        names = small_enough(aliases.select(F.col("name").alias("vm_name"), F.col("rename").alias("pretty")))
        flat = flat.join(names, "vm_name", "left")
    return flat.select(
        *RECORD_COLUMNS,
        "vm_name",
        "arrival",
        F.when(F.col("addr").isNull(), F.lit("address is not CIDR text")).alias("_error"),
    )


def targets_missing_instances(targets: DataFrame) -> DataFrame:
    return targets.filter(F.coalesce(F.size("instances"), F.lit(0)) < 1)


def asset_keys(records: DataFrame) -> DataFrame:
    """One row per lookup key of each record. The full name counts only with a domain."""
    keys = F.array(
        F.col("host_name"),
        F.col("ansible_name"),
        F.col("pretty"),
        F.col("addr"),
        F.when(F.col("domain") != "", F.col("fqdn")),
    )
    keys = F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "")))
    return records.withColumn("key", F.explode(keys))


def asset_index(records: DataFrame, seq: str = "seq") -> DataFrame:
    """key -> record; the record with the lowest ``seq`` (a number or a struct) keeps a contested key.

    Between equal ``seq`` the record whose other columns are smallest keeps it.

    An aggregate rather than a window: rows of a popular key are reduced before the shuffle.
    """
    keyed = asset_keys(records)
    fields = [c for c in keyed.columns if c != "key"]
    place = F.struct(F.col(seq).alias("s"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(fields) if c != seq])
    first = keyed.groupBy("key").agg(F.min_by(F.struct(*fields), place).alias("r"))
    return first.select("key", "r.*")


def index_counts(records: DataFrame, index: DataFrame) -> DataFrame:
    """pickups: records read; updates: keys that were new."""
    return records.agg(F.count(F.lit(1)).alias("pickups")).select(
        "pickups", index.agg(F.count(F.lit(1))).scalar().alias("updates")
    )


def latest_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the highest ``order``; between ties the last arrival, where the rows have an
    ``arrival``, and then the row whose other columns are greatest, so the answer never depends on the row order."""
    fields = [c for c in df.columns if c != key]
    ties = [c for c in ("arrival",) if c in fields] + [c for c in fields if c not in (order, "arrival")]
    place = F.struct(F.col(order).alias("o"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(ties)])
    newest = df.groupBy(key).agg(F.max_by(F.struct(*fields), place).alias("r"))
    return newest.select(key, "r.*")


def fqdn(host: Column, domain: Column) -> Column:
    return F.when(F.coalesce(domain, F.lit("")) != "", F.concat(host, F.lit("."), domain)).otherwise(host)


def three_way_index(assets: DataFrame, order: str = "updated") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Latest asset per address, per full name and per short name."""
    named = assets.withColumn("fqdn", fqdn(F.col("Host"), F.col("Domain")))
    return latest_by(named, "IP", order), latest_by(named, "fqdn", order), latest_by(named, "Host", order)


def lookup_asset(probes: DataFrame, assets: DataFrame, host: str = "host", order: str = "updated") -> DataFrame:
    """Left lookup of hosts: address first, then full name, then short name. Adds struct ``asset``.

    A probe that is an address is looked up in its canonical form.
    """
    by_ip, by_fqdn, by_host = three_way_index(assets, order)
    spread = [c for c in probes.columns]
    full = by_fqdn.withColumnRenamed("fqdn", "key").select("key", F.struct(*_asset_columns(by_fqdn)).alias("a"))
    short = by_host.withColumnRenamed("Host", "key").select(
        "key", F.struct(*_asset_columns(by_host.withColumnRenamed("Host", "key"), {"Host": "key"})).alias("a")
    )
    address = by_ip.withColumnRenamed("IP", "key").select(
        "key", F.struct(*_asset_columns(by_ip.withColumnRenamed("IP", "key"), {"IP": "key"})).alias("a")
    )
    out = attach(probes, as_lookup(address.where("key IS NOT NULL"), "key"), canon_ip(F.col(host)), "__ip", spread)
    out = attach(out, as_lookup(full, "key"), F.col(host), "__full", spread)
    out = attach(out, as_lookup(short, "key"), F.col(host), "__short", spread)
    return out.withColumn("asset", F.coalesce("__ip.a", "__full.a", "__short.a")).drop("__ip", "__full", "__short")


def _asset_columns(df: DataFrame, renamed: dict[str, str] | None = None) -> list[Column]:
    return [
        F.col((renamed or {}).get(name, name)).alias(name)
        for name in ("Host", "Alias", "OS", "IP", "Zone", "Team", "Domain", "VM", "Role", "is_asset")
    ]


def missing_hosts_of(probes: DataFrame, assets: DataFrame, host: str = "host") -> DataFrame:
    """Distinct hosts known neither by full nor by short name."""
    asked = probes.select(F.col(host).alias("host")).distinct()
    names = assets.select(F.col("Host").alias("host")).union(
        assets.select(fqdn(F.col("Host"), F.col("Domain")).alias("host"))
    )
    return asked.join(names.distinct(), "host", "left_anti")


def asset_struct(prefix: str = "") -> Column:
    """Record columns -> asset struct."""

    def col(name: str) -> Column:
        return F.col(prefix + name)

    return F.struct(
        col("host_name").alias("Host"),
        col("pretty").alias("Alias"),
        col("os").alias("OS"),
        col("addr").alias("IP"),
        col("network_name").alias("Zone"),
        col("team").alias("Team"),
        col("domain").alias("Domain"),
        col("ansible_name").alias("VM"),
        col("role").alias("Role"),
        F.coalesce(col("team") == DEFENDED_TEAM, F.lit(False)).alias("is_asset"),
    )


def to_asset(records: DataFrame) -> DataFrame:
    carried = [c for c in records.columns if c not in RECORD_COLUMNS]
    return records.select(*carried, asset_struct().alias("__a")).select(*carried, "__a.*")


def raw_to_asset(raw: DataFrame) -> DataFrame:
    """Plain asset rows (hostname, pretty, role, os, ip, zone, team, domain, vm): always assets."""
    return raw.select(
        F.col("hostname").alias("Host"),
        F.col("pretty").alias("Alias"),
        F.col("os").alias("OS"),
        canon_ip(F.col("ip")).alias("IP"),
        F.col("zone").alias("Zone"),
        F.col("team").alias("Team"),
        F.col("domain").alias("Domain"),
        F.col("vm").alias("VM"),
        F.col("role").alias("Role"),
        F.lit(True).alias("is_asset"),
    )


def strip_key(col: Column, cutset: str, mode: str = "cutset") -> Column:
    """Drop leading characters that are in ``cutset``; ``mode="prefix"`` drops it as a whole."""
    if mode == "cutset":
        return F.ltrim(col, F.lit(cutset))
    if mode != "prefix":
        raise ValueError(f"unknown mode {mode!r}")
    return F.when(F.startswith(col, F.lit(cutset)), F.substr(col, F.lit(len(cutset) + 1))).otherwise(col)


def merge_assets(
    records: DataFrame, vcenter: DataFrame, cutset: str = "", mode: str = "cutset", order: str = "updated"
) -> DataFrame:
    """All records, plus a copy with fresh address and time for every matching VM row.

    Output is keyed by address (``key``), with ``origin`` telling the two kinds apart. The record
    side is reduced to its latest row per key first, so each VM row matches at most one record.
    """
    passed = records.select(*RECORD_COLUMNS, F.col("addr").alias("key"), F.lit("inventory").alias("origin"))
    arrival = ["arrival"] if "arrival" in records.columns else []
    known = latest_by(
        records.select(*RECORD_COLUMNS, *arrival, strip_key(F.col("ansible_name"), cutset, mode).alias("lookup")),
        "lookup",
        order,
    )
    seen = vcenter.filter(F.col("ip").isNotNull()).select(
        strip_key(F.col("name"), cutset, mode).alias("lookup"), cidr_address(F.col("ip")).alias("__ip"), "ts"
    )
    hit = seen.filter(F.col("__ip").isNotNull()).join(small_enough(known), "lookup")
    fresh = {"addr": F.col("__ip"), "updated": F.col("ts")}
    copies = hit.select(
        *[fresh.get(name, F.col(name)).alias(name) for name in RECORD_COLUMNS],
        F.col("__ip").alias("key"),
        F.lit("vcenter").alias("origin"),
    )
    return passed.unionByName(copies)


def bad_lookups(records: DataFrame, vcenter: DataFrame, cutset: str = "", mode: str = "cutset") -> DataFrame:
    """Lookup keys of VM rows that no record answers to; ``empty_key`` flags blank ones."""
    asked = vcenter.select(strip_key(F.col("name"), cutset, mode).alias("lookup")).distinct()
    known = records.select(strip_key(F.col("ansible_name"), cutset, mode).alias("lookup")).distinct()
    return asked.join(known, "lookup", "left_anti").withColumn(
        "empty_key", F.coalesce(F.col("lookup") == "", F.lit(True))
    )


def merge_counts(
    records: DataFrame, vcenter: DataFrame, merged: DataFrame, cutset: str = "", mode: str = "cutset"
) -> DataFrame:
    """Totals the merge reports, as one row. A lookup is missed where no record answers to its key; a known VM without
    an address is none."""
    known = records.select(strip_key(F.col("ansible_name"), cutset, mode).alias("lookup")).distinct()
    asked = vcenter.select(strip_key(F.col("name"), cutset, mode).alias("lookup"))
    missed = asked.groupBy("lookup").agg(F.count(F.lit(1)).alias("n")).join(known, "lookup", "left_anti")
    found = merged.agg(F.count_if(F.col("origin") == "vcenter").alias("found"), F.count(F.lit(1)).alias("sent"))
    return found.select(
        records.agg(F.count(F.lit(1))).scalar().alias("total_inventory"),
        vcenter.agg(F.count(F.lit(1))).scalar().alias("total_vcenter"),
        F.col("found").alias("new_assets_found"),
        F.col("sent").alias("new_assets_sent"),
        missed.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar().alias("missed_lookups"),
    )


def updated_within(records: DataFrame, seconds: int, now: Column) -> DataFrame:
    """Records younger than a limit (strictly)."""
    age = F.unix_micros(now) - F.unix_micros("updated")
    return records.filter(age < F.lit(seconds * 1_000_000))


def index_lookup(index: DataFrame) -> Lookup:
    """The asset registry as a lookup from key to asset struct fields."""
    return as_lookup(index.select("key", asset_struct().alias("a")).select("key", "a.*"), "key")
