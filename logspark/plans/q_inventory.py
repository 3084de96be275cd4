"""Queries of the inventory and dimension jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from logspark.operators import inventory as inv, networks as net, pseudonyms as ps
from logspark.plans import render
from logspark.plans.catalog import EV, RECORDS, ip_sql, query
from logspark.plans.render import text
from logspark.sources import dimensions as dim


def now_at():
    return F.timestamp_seconds(F.lit(1704153600))

R = "WITH " + RECORDS
VC = f"""vc AS (
    SELECT 1706745600+s_suppkey AS ts, 'vm_'||s_suppkey AS name, {ip_sql('s_suppkey', '11')} AS ip FROM supplier WHERE s_suppkey%3<>0
    UNION ALL SELECT 1706745600+c_custkey, CASE WHEN c_custkey%50=0 THEN 'm_v' ELSE 'vm_c'||(c_custkey//3) END,
      CASE WHEN c_custkey%9<>0 THEN {ip_sql('c_custkey', '12')} END FROM customer),
  lk AS (SELECT *, ltrim(name, 'vm_') AS lookup FROM vc)"""


@query("d1_flatten", "WITH " + RECORDS + """SELECT 'vm_'||s AS ansible_name, host_name, domain, 'role-'||(s%3) AS role, addr, team, os, net AS network_name, pretty, rejected FROM (
    SELECT s, host_name, domain, CASE WHEN s%2=0 THEN 'blue' ELSE 'red' END AS team, 'net-'||n AS net, 'alias-'||s AS pretty,
      CASE WHEN s%11=0 THEN '' WHEN s%3=0 THEN 'os_windows' WHEN s%3=1 THEN 'os_linux' ELSE '' END AS os,
      CASE WHEN v=4 THEN CASE WHEN s%13<>0 THEN """ + ip_sql("s") + """ END ELSE 'fd00::'||CASE WHEN s%65536=0 THEN '' ELSE format('{:x}', s%65536) END END AS addr,
      v=4 AND s%13=0 AS rejected FROM base, (VALUES (4),(6)) t(v) WHERE s%7<>0)""")
def d1(spark, sf):
    targets = render.target_rows(spark, sf)
    aliases = render.table(spark, sf, "supplier").select(
        F.concat(F.lit("name-"), text(F.col("s_suppkey"))).alias("name"), F.concat(F.lit("alias-"), text(F.col("s_suppkey"))).alias("rename")
    )
    f = inv.flatten_targets(targets, aliases)
    return f.select("ansible_name", "host_name", "domain", "role", "addr", "team", "os", "network_name", "pretty",
                    F.col("_error").isNotNull().alias("rejected"))


@query("d2_os_tag", "SELECT 't'||s_suppkey AS id, CASE WHEN s_suppkey%11=0 THEN '' WHEN s_suppkey%3=2 THEN 'unk' ELSE 'os_linux' END AS os FROM supplier")
def d2(spark, sf):
    return render.target_rows(spark, sf).select("id", inv.os_tag(F.col("tags")).alias("os"))


@query("d3_no_instances", "SELECT 't'||s_suppkey AS id FROM supplier WHERE s_suppkey%7=0")
def d3(spark, sf):
    return inv.targets_missing_instances(render.target_rows(spark, sf)).select("id")


@query("d4_pseudonymize", """SELECT count(*) AS names, count(*) AS aliases, CAST(sum(CASE WHEN s_suppkey%4=0 THEN 1 ELSE 0 END) AS BIGINT) AS hits,
      CAST(sum(CASE WHEN s_suppkey%4=0 THEN 1 ELSE 0 END) AS BIGINT) AS kept, count(*) AS registry, CAST(0 AS BIGINT) AS outside FROM supplier""")
def d4(spark, sf):
    s = F.col("s_suppkey")
    names = render.table(spark, sf, "supplier").select(F.concat(F.lit("name-"), text(s)).alias("vm"), s)
    seen = F.timestamp_seconds(F.lit(1600000000))
    prior = names.filter(s % 4 == 0).select(F.col("vm").alias("name"), F.concat(F.lit("pool-"), text(s * 4)).alias("rename"),
                                            seen.alias("first_seen"), seen.alias("last_seen"))
    pool = render.table(spark, sf, "part").select(F.concat(F.lit("pool-"), text(F.col("p_partkey"))).alias("name"))
    out, registry = ps.pseudonymize(names, "vm", pool, prior, now=now_at())
    kept = out.join(prior.select("name", F.col("rename").alias("old")), "name", "left")
    outside = out.join(pool.select(F.col("name").alias("rename")), "rename", "left_anti").agg(F.count(F.lit(1))).scalar()
    return kept.agg(
        F.count(F.lit(1)).alias("names"), F.countDistinct("rename").alias("aliases"), F.count_if("hit").alias("hits"),
        F.count_if(F.col("old") == F.col("rename")).alias("kept"),
    ).select("*", registry.agg(F.count(F.lit(1))).scalar().alias("registry"), outside.alias("outside"))


@query("d5_asset_keys", R + "SELECT seq, key FROM keyed")
def d5(spark, sf):
    return inv.asset_keys(render.records(spark, sf)).select("seq", "key")


@query("d6_asset_index", R + "SELECT key, host_name, addr, team, seq FROM idx")
def d6(spark, sf):
    return inv.asset_index(render.records(spark, sf)).select("key", "host_name", "addr", "team", "seq")


@query("d7_latest", R + "SELECT host_name, addr, team FROM rec QUALIFY row_number() OVER (PARTITION BY host_name ORDER BY updated DESC)=1")
def d7(spark, sf):
    return inv.latest_by(render.records(spark, sf), "host_name", "updated").select("host_name", "addr", "team")


def _assets(spark, sf):
    r = render.records(spark, sf)
    return inv.to_asset(r.withColumn("changed", F.col("updated"))).withColumnRenamed("changed", "updated")


PROBES = EV + ", " + RECORDS + """, probes AS (SELECT event_id, CASE WHEN k%3=0 AND uid%5<>0 AND s_nationkey IS NOT NULL THEN host||'.n'||s_nationkey||'.example' ELSE host END AS host
    FROM ev LEFT JOIN supplier ON s_suppkey=uid),
  newest AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY host_name ORDER BY updated DESC)=1)"""


def _probes(spark, sf):
    ev = render.base_events(spark, sf)
    s = render.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("uid"), "s_nationkey")
    j = ev.join(s, "uid", "left")
    full = F.concat(F.col("host"), F.lit(".n"), text(F.col("s_nationkey")), F.lit(".example"))
    return j.select("event_id", F.when((F.col("k") % 3 == 0) & (F.col("uid") % 5 != 0) & F.col("s_nationkey").isNotNull(), full).otherwise(F.col("host")).alias("host"))


@query("d8_lookup_asset", PROBES + "SELECT event_id, n.addr AS addr, n.team AS team FROM probes p LEFT JOIN newest n ON n.fqdn=p.host OR n.host_name=p.host")
def d8(spark, sf):
    out = inv.lookup_asset(_probes(spark, sf), _assets(spark, sf))
    return out.select("event_id", F.col("asset.IP").alias("addr"), F.col("asset.Team").alias("team"))


@query("d8_missing_hosts", PROBES + "SELECT DISTINCT host FROM probes WHERE host NOT IN (SELECT fqdn FROM rec) AND host NOT IN (SELECT host_name FROM rec)")
def d8_missing(spark, sf):
    return inv.missing_hosts_of(_probes(spark, sf), _assets(spark, sf))


@query("d9_to_asset", R + "SELECT seq, host_name AS host, pretty AS alias, network_name AS zone, ansible_name AS vm, team='blue' AS is_asset FROM rec")
def d9(spark, sf):
    a = inv.to_asset(render.records(spark, sf))
    return a.select("seq", F.col("Host").alias("host"), F.col("Alias").alias("alias"), F.col("Zone").alias("zone"), F.col("VM").alias("vm"), "is_asset")


@query("d9_raw_asset", R + "SELECT s, host_name AS host, pretty AS alias, addr AS ip, network_name AS zone, domain, ansible_name AS vm, true AS is_asset FROM rec WHERE seq < 1000000000")
def d9_raw(spark, sf):
    """Plain asset rows; their addresses become canonical."""
    r = render.records(spark, sf).filter("seq < 1000000000")
    raw = r.select(
        F.col("host_name").alias("hostname"), "pretty", "role", "os", F.concat(F.lit("::ffff:"), "addr").alias("ip"),
        F.col("network_name").alias("zone"), "team", "domain", F.col("ansible_name").alias("vm"),
    )
    a = inv.raw_to_asset(raw)
    s = F.regexp_extract("Host", r"(\d+)$", 1).cast("bigint").alias("s")
    return a.select(s, F.col("Host").alias("host"), F.col("Alias").alias("alias"), F.col("IP").alias("ip"), F.col("Zone").alias("zone"),
                    F.col("Domain").alias("domain"), F.col("VM").alias("vm"), "is_asset")


@query("d6_counts", R + "SELECT (SELECT count(*) FROM rec) AS pickups, (SELECT count(*) FROM idx) AS updates")
def d6_counts(spark, sf):
    records = render.records(spark, sf)
    return inv.index_counts(records, inv.asset_index(records))


@query("d4_counts", "SELECT CAST(sum(CASE WHEN s_suppkey%4=0 THEN 1 ELSE 0 END) AS BIGINT) AS hits, CAST(sum(CASE WHEN s_suppkey%4<>0 THEN 1 ELSE 0 END) AS BIGINT) AS misses FROM supplier")
def d4_counts(spark, sf):
    s = F.col("s_suppkey")
    names = render.table(spark, sf, "supplier").select(F.concat(F.lit("name-"), text(s)).alias("vm"), s)
    seen = F.timestamp_seconds(F.lit(1600000000))
    prior = names.filter(s % 4 == 0).select(F.col("vm").alias("name"), F.concat(F.lit("pool-"), text(s * 4)).alias("rename"),
                                            seen.alias("first_seen"), seen.alias("last_seen"))
    pool = render.table(spark, sf, "part").select(F.concat(F.lit("pool-"), text(F.col("p_partkey"))).alias("name"))
    return ps.name_counts(ps.pseudonymize(names, "vm", pool, prior, now=now_at())[0])


@query("d10_merge_assets", R + f""", {VC}, known AS (SELECT *, ltrim(ansible_name, 'vm_') AS lookup FROM rec QUALIFY row_number() OVER (PARTITION BY ansible_name ORDER BY updated DESC)=1)
    SELECT addr AS key, host_name, addr, team, updated, 'inventory' AS origin FROM rec
    UNION ALL SELECT ip, host_name, ip, team, ts, 'vcenter' FROM lk JOIN known USING (lookup) WHERE ip IS NOT NULL""")
def d10(spark, sf):
    m = inv.merge_assets(render.records(spark, sf), render.vcenter_rows(spark, sf), "vm_")
    return m.select("key", "host_name", "addr", "team", F.unix_seconds("updated").alias("updated"), "origin")


@query("d10_merge_counts", R + f""", {VC}, known AS (SELECT DISTINCT ltrim(ansible_name, 'vm_') AS lookup FROM rec), f AS (SELECT count(*) AS n FROM lk JOIN known USING (lookup) WHERE ip IS NOT NULL)
    SELECT (SELECT count(*) FROM rec) AS total_inventory, (SELECT count(*) FROM vc) AS total_vcenter, n AS new_assets_found,
      n + (SELECT count(*) FROM rec) AS new_assets_sent, (SELECT count(*) FROM lk WHERE lookup NOT IN (SELECT lookup FROM known)) AS missed_lookups FROM f""")
def d10_counts(spark, sf):
    r, v = render.records(spark, sf), render.vcenter_rows(spark, sf)
    return inv.merge_counts(r, v, inv.merge_assets(r, v, "vm_"), "vm_")


@query("d10_merge_two_addresses", R + f""", {VC}, flat AS (SELECT s, host_name, v, CASE WHEN v=4 THEN CASE WHEN s%13<>0 THEN {ip_sql("s")} END
      ELSE 'fd00::'||CASE WHEN s%65536=0 THEN '' ELSE format('{{:x}}', s%65536) END END AS addr FROM base, (VALUES (4),(6)) t(v) WHERE s%7<>0),
    known AS (SELECT ltrim('vm_'||s, 'vm_') AS lookup, host_name FROM flat WHERE addr IS NOT NULL AND v=6)
    SELECT addr AS key, host_name, addr, 'inventory' AS origin FROM flat WHERE addr IS NOT NULL
    UNION ALL SELECT ip, host_name, ip, 'vcenter' FROM lk JOIN known USING (lookup) WHERE ip IS NOT NULL""")
def d10_two(spark, sf):
    """All records carry one time and each machine has two: the last arrival must win, whatever the order of rows."""
    flat = inv.flatten_targets(render.target_rows(spark, sf), now=now_at()).filter("_error IS NULL")
    m = inv.merge_assets(flat.repartition(5, "addr"), render.vcenter_rows(spark, sf), "vm_")
    return m.select("key", "host_name", "addr", "origin")


@query("d8_lookup_address", PROBES + "SELECT event_id, n.host_name AS host, n.team FROM (SELECT event_id, uip AS ip FROM ev WHERE k%2=0 UNION ALL SELECT event_id, host FROM ev WHERE k%2=1) p LEFT JOIN (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY addr ORDER BY updated DESC)=1) a ON a.addr=p.ip LEFT JOIN newest h ON h.host_name=p.ip LEFT JOIN rec n ON n.seq=coalesce(a.seq, h.seq)")
def d8_address(spark, sf):
    ev = render.base_events(spark, sf)
    probes = ev.select("event_id", F.when(F.col("k") % 2 == 0, F.col("uip")).otherwise(F.col("host")).alias("host"))
    out = inv.lookup_asset(probes, _assets(spark, sf))
    return out.select("event_id", F.col("asset.Host").alias("host"), F.col("asset.Team").alias("team"))


@query("d11_bad_lookups", R + f", {VC} SELECT DISTINCT lookup, lookup='' AS empty_key FROM lk WHERE lookup NOT IN (SELECT ltrim(ansible_name, 'vm_') FROM rec)")
def d11(spark, sf):
    return inv.bad_lookups(render.records(spark, sf), render.vcenter_rows(spark, sf), "vm_")


@query("d12_recent", R + "SELECT seq FROM rec WHERE 1704153600 - updated < 86390")
def d12(spark, sf):
    return inv.updated_within(render.records(spark, sf), 86390, now_at()).select("seq")


NETS = "nets AS (SELECT n_nationkey AS id, n_name AS name, n_nationkey*16 AS lo, n_nationkey*16+15 AS hi, 28 AS prefix FROM nation UNION ALL SELECT 100, 'wide', 0, 255, 24)"


@query("d13_tag_network", EV + f", {NETS} SELECT event_id, CAST(id AS BIGINT) AS network_id, name AS network FROM ev JOIN nets ON uid%16777216 BETWEEN lo AND hi")
def d13(spark, sf):
    seg = net.network_segments(render.networks(spark, sf))
    t = net.tag_network(render.base_events(spark, sf).select("event_id", F.col("uip").alias("ip")), seg)
    return t.select("event_id", F.col("network_id").cast("bigint").alias("network_id"), "network")


@query("d13_longest", EV + f", {NETS} SELECT event_id, name AS network FROM ev JOIN nets ON uid%16777216 BETWEEN lo AND hi QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY prefix DESC)=1")
def d13_longest(spark, sf):
    seg = net.network_segments(render.networks(spark, sf))
    t = net.tag_network(render.base_events(spark, sf).select("event_id", F.col("uip").alias("ip")), seg, longest=True)
    return t.select("event_id", "network")


@query("s7_techniques", "SELECT 'T1'||lpad(CAST(p_partkey%1000 AS VARCHAR),3,'0') AS id, p_name AS name, 'https://example.org/T1'||lpad(CAST(p_partkey%1000 AS VARCHAR),3,'0') AS url, CASE WHEN p_size%3<>0 THEN lower(p_type) END AS phases FROM part WHERE p_size%7<>0 AND p_size%5<>0 QUALIFY row_number() OVER (PARTITION BY p_partkey%1000 ORDER BY p_partkey DESC)=1")
def s7(spark, sf):
    t = dim.load_techniques(spark, render.stix_file(spark, sf))
    return t.select(F.col("ID").alias("id"), F.col("Name").alias("name"), F.col("URL").alias("url"), F.array_join("Phases", ",").alias("phases"))


@query("s8_sid_map", "SELECT p_partkey AS sid, lower(p_type) AS tactic, 'T1'||lpad(CAST(p_partkey%1000 AS VARCHAR),3,'0') AS id, p_name AS name, 'msg \"'||p_brand||'\", '||p_size AS msg FROM part")
def s8(spark, sf):
    path = render.scratch_path(spark, "sidmap")
    render.sid_map_rows(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return dim.load_sid_map(spark, path).withColumn("sid", F.col("sid").cast("bigint"))


@query("s9_networks", "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, 'VLAN-'||(n_nationkey+100) AS vlan, " + ip_sql("n_nationkey*16") + "||'/28' AS ipv4, 'fd00:'||format('{:x}', n_nationkey+16)||'::/32' AS ipv6, CASE WHEN n_nationkey%2=0 THEN 'blue' ELSE 'red' END AS team FROM nation")
def s9(spark, sf):
    n = dim.load_networks(spark, render.networks_file(spark, sf))
    return n.select(F.col("id").cast("bigint").alias("id"), "name", "vlan", "ipv4", "ipv6", "team")


@query("s10_targets", "SELECT 't'||s_suppkey AS id, 'role-'||(s_suppkey%3) AS role, CASE WHEN s_suppkey%2=0 THEN 'blue' ELSE 'red' END AS team, CASE WHEN s_suppkey%7=0 THEN NULL ELSE 'host-'||s_suppkey END AS host FROM supplier")
def s10(spark, sf):
    t = dim.load_targets(spark, render.targets_file(spark, sf))
    return t.select("id", "role", F.col("team_name").alias("team"), F.get("instances.hostname", F.lit(0)).alias("host"))


@query("s11_parse_assets", R + "SELECT seq, CASE WHEN s%6<>5 THEN host_name END AS host_name, CASE WHEN s%6 NOT IN (4,5) THEN addr END AS addr, s%6 IN (4,5) AS rejected FROM rec")
def s11(spark, sf):
    r = render.records(spark, sf)
    s = F.regexp_extract("host_name", r"(\d+)$", 1).cast("bigint")
    r = r.withColumn("s", s).withColumn("addr", F.when(s % 6 == 4, "nowhere").otherwise(F.col("addr")))
    body = F.to_json(F.struct("host_name", "ansible_name", "addr", "team"))
    rows = r.select("seq", F.when(F.col("s") % 6 == 5, F.lit("{oops")).otherwise(body).alias("value"))
    return dim.parse_assets(rows).select("seq", "host_name", "addr", F.col("_error").isNotNull().alias("rejected"))


@query("s11_parse_vcenter", "WITH " + VC + " SELECT name, ip, ip IS NULL AS rejected FROM vc")
def s11_vcenter(spark, sf):
    rows = render.vcenter_rows(spark, sf).drop("n").select(F.to_json(F.struct("*")).alias("value"))
    p = dim.parse_vcenter(rows)
    return p.select("name", F.substring_index("ip", "/", 1).alias("ip"), F.col("_error").isNotNull().alias("rejected"))
