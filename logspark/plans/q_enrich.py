"""Queries of the enrichment jobs, the flagship among them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from logspark.operators import enrich as en, sidmap
from logspark.operators.decode import decode
from logspark.operators.inventory import asset_index, index_lookup
from logspark.operators.rules import load_rules, match_rules, tag_techniques
from logspark.plans import render
from logspark.plans.catalog import EV, EVE_ALERT, EVE_TECH, RECORDS, TECH, TECH_ID, WIN_TECH, query

# Detection rules of the registered queries.
RULE_ROWS = [
    ("r01", "web get", "suricata", ["attack.t1003", "attack.execution"], "exists({keywords}, w -> contains(w, 'GET'))"),
    ("r02", "category two", "suricata", ["attack.t1001", "attack.t1003"], "{alert.category} = 'Category 2'"),
    ("r03", "odd process", "windows", ["attack.t1009"], "{process.name} LIKE 'proc1%' AND {#winlog.event_id} > 4600"),
    ("r04", "command five", "snoopy", ["attack.t1002"], "{cmd} LIKE '%cmd5%'"),
    ("r05", "sysmon only", "sysmon", [], "{winlog.task} = 'Task 1'"),
]


def rules_table(spark) -> DataFrame:
    return spark.createDataFrame(RULE_ROWS, "rule_id STRING, title STRING, kind STRING, tags ARRAY<STRING>, condition STRING")


def _decoded(spark, sf):
    return decode(render.json_events(spark, sf))


def _index(spark, sf):
    return asset_index(render.records(spark, sf))


def _enriched(spark, sf, rules=True):
    tech = render.techniques(spark, sf)
    found = load_rules(rules_table(spark), tech) if rules else None
    return en.enrich(
        render.json_events(spark, sf), index_lookup(_index(spark, sf)), en.technique_lookup(tech), found
    )


J = f"""{EV}, {RECORDS}, {TECH},
  facts AS (SELECT *, CASE WHEN kind='syslog' AND k%4=0 THEN uip END AS ip,
      kind='suricata' OR (kind='snoopy' AND k%2=0 AND k%4<>0) AS has_src,
      (kind='suricata' AND k%17<>0) OR (kind='snoopy' AND k%2=0 AND k%4<>0) AS has_dest,
      CASE WHEN kind='suricata' THEN uip WHEN kind='snoopy' THEN kip END AS src_ip,
      CASE WHEN kind='suricata' THEN kip WHEN kind='snoopy' THEN uip END AS dest_ip,
      CASE WHEN {EVE_TECH} OR {WIN_TECH} THEN {TECH_ID} END AS own
    FROM ev),
  joined AS (SELECT f.*, coalesce(a.host_name, h.host_name) AS hit_host, coalesce(a.team, h.team) AS team, coalesce(a.pretty, h.pretty) AS pretty,
      coalesce(s.team='blue', false) AS src_blue, coalesce(d.team='blue', false) AS dest_blue, s.host_name AS src_host, d.host_name AS dest_host,
      t.name AS tname
    FROM facts f LEFT JOIN idx a ON a.key=f.ip LEFT JOIN idx h ON h.key=f.host
      LEFT JOIN idx s ON s.key=f.src_ip AND f.has_src LEFT JOIN idx d ON d.key=f.dest_ip AND f.has_dest
      LEFT JOIN tech t ON t.id=f.own),
  res AS (SELECT *, CASE WHEN NOT has_src AND NOT has_dest THEN 1 WHEN NOT has_src OR NOT has_dest THEN 0
      WHEN src_blue AND NOT dest_blue THEN 4 WHEN NOT src_blue AND dest_blue THEN 3 WHEN src_blue AND dest_blue THEN 2 ELSE 0 END AS code,
      kind='suricata' AND k%4=0 AS r01, {EVE_ALERT} AND k%4=2 AS r02,
      (kind='windows' AND k%8=1 AND k>0) AS r03, kind='snoopy' AND k%10=5 AS r04 FROM joined)
"""
LABEL = "CASE code WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Local' WHEN 2 THEN 'Lateral' WHEN 3 THEN 'Inbound' WHEN 4 THEN 'Outbound' END"
NAMED = f"""{J}, known AS (SELECT id, name FROM tech),
  listed AS (
    SELECT event_id, 0 AS pos, own AS id, coalesce(tname, CASE WHEN kind='suricata' THEN '' ELSE 'Tech '||k END) AS name FROM res WHERE own IS NOT NULL
    UNION ALL SELECT event_id, 1, id, name FROM res, known WHERE r01 AND id='T1003'
    UNION ALL SELECT event_id, 2, id, name FROM res, known WHERE r02 AND id='T1001'
    UNION ALL SELECT event_id, 3, id, name FROM res, known WHERE r02 AND id='T1003'
    UNION ALL SELECT event_id, 4, id, name FROM res, known WHERE r03 AND id='T1009'
    UNION ALL SELECT event_id, 5, id, name FROM res, known WHERE r04 AND id='T1002'),
  firsts AS (SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY event_id, id ORDER BY pos) = 1),
  attack AS (SELECT event_id, string_agg(id, ',' ORDER BY pos) AS ids, string_agg(name, '|' ORDER BY pos) AS names,
      arg_min(id, pos) AS head FROM firsts GROUP BY 1)
"""


@query(
    "alerts_by_technique",
    J + f"""SELECT own AS technique, tname AS technique_name, {LABEL} AS direction, count(*) AS alerts
    FROM res WHERE kind='suricata' AND own IS NOT NULL GROUP BY 1, 2, 3""",
)
def alerts_by_technique(spark, sf):
    rows = render.json_events(spark, sf).filter("kind = 'suricata'")
    tech = en.technique_lookup(render.techniques(spark, sf))
    e = en.enrich(rows, index_lookup(_index(spark, sf)), tech)
    t = F.get("GameMeta.MitreAttack.Techniques", F.lit(0))
    e = e.select(t["ID"].alias("technique"), F.nullif(t["Name"], F.lit("")).alias("technique_name"),
                 F.col("GameMeta.DirectionString").alias("direction"))
    return e.filter(F.col("technique").isNotNull()).groupBy("technique", "technique_name", "direction").agg(
        F.count(F.lit(1)).alias("alerts")
    )


@query("e1_blank_asset", J + """SELECT event_id, host, ip, has_src, has_dest, CASE WHEN has_src THEN src_ip END AS src_ip,
      CASE WHEN has_dest THEN dest_ip END AS dest_ip FROM facts""")
def e1(spark, sf):
    b = en.blank_asset(_decoded(spark, sf))
    return b.select(F.col("offset").alias("event_id"), "host", "ip", "has_src", "has_dest", "src_ip", "dest_ip")


@query("e2_self_lookup", J + """SELECT event_id, coalesce(hit_host, host) AS host, coalesce(team, '') AS team, coalesce(pretty, '') AS alias,
      coalesce(team='blue', false) AS is_asset, hit_host IS NULL AS missed FROM joined""")
def e2(spark, sf):
    b = en.join_assets(en.blank_asset(_decoded(spark, sf)), index_lookup(_index(spark, sf)))
    a = F.col("asset")
    return b.select(F.col("offset").alias("event_id"), a["Host"].alias("host"), a["Team"].alias("team"),
                    a["Alias"].alias("alias"), a["is_asset"].alias("is_asset"), F.col("host_missed").alias("missed"))


@query("e3_endpoint_lookup", J + """SELECT event_id, CASE WHEN has_src THEN coalesce(src_host, '') END AS src_host,
      CASE WHEN has_dest THEN coalesce(dest_host, '') END AS dest_host FROM joined""")
def e3(spark, sf):
    b = en.join_endpoints(en.blank_asset(_decoded(spark, sf)), index_lookup(_index(spark, sf)))
    return b.select(F.col("offset").alias("event_id"), F.col("src.Host").alias("src_host"), F.col("dest.Host").alias("dest_host"))


@query("e3_shuffled_lookup", J + """SELECT event_id, CASE WHEN has_src THEN coalesce(src_host, '') END AS src_host,
      CASE WHEN has_dest THEN coalesce(dest_host, '') END AS dest_host FROM joined""")
def e3_shuffled(spark, sf):
    """The same lookups in the form used when the registry is too big to broadcast."""


    big = replace(index_lookup(_index(spark, sf)), small=False)
    b = en.join_endpoints(en.blank_asset(_decoded(spark, sf)), big)
    return b.select(F.col("offset").alias("event_id"), F.col("src.Host").alias("src_host"), F.col("dest.Host").alias("dest_host"))


@query("e4_missing_hosts", J + "SELECT DISTINCT host FROM facts WHERE (ip IS NULL OR ip NOT IN (SELECT key FROM idx)) AND host NOT IN (SELECT key FROM idx)")
def e4(spark, sf):
    return en.missing_hosts(en.blank_asset(_decoded(spark, sf)), _index(spark, sf))


@query("e5_rules", J + """SELECT event_id, CASE WHEN r01 AND r02 THEN 'r01,r02' WHEN r01 THEN 'r01' WHEN r02 THEN 'r02' WHEN r03 THEN 'r03'
        WHEN r04 THEN 'r04' END AS matched,
      CASE WHEN kind='syslog' THEN 'no-ruleset' WHEN r01 OR r02 OR r03 OR r04 THEN 'match' ELSE 'miss' END AS state FROM res""")
def e5(spark, sf):
    m = match_rules(_decoded(spark, sf), load_rules(rules_table(spark)))
    ids = F.array_join(F.transform("sigma_results", lambda r: r["rule_id"]), ",")
    return m.select(F.col("offset").alias("event_id"), ids.alias("matched"), F.col("sigma_state").alias("state"))


def many_rules(n: int) -> list[tuple]:
    """Rules of all shapes: an equality, a number, a list, substrings of a field and of the keywords, and, for one in
    a hundred, an alternative, which has no anchor. Rule ``i`` of shape ``i % 6`` names values from its own number."""
    shapes = {
        0: ("suricata", "{{alert.signature}} = 'SIG {i}' AND {{#alert.signature_id}} > 2000"),
        1: ("snoopy", "{{cmd}} LIKE '%cmd{d} -a {i}%' AND {{username}} = 'root'"),
        2: ("windows", "{{#winlog.event_id}} = {w} AND {{process.name}} LIKE 'proc%'"),
        3: ("suricata", "exists({{keywords}}, x -> contains(x, 'GET /{i}')) AND ({{host}} LIKE 'host-%')"),
        4: ("windows", "{{winlog.user.name}} IN ('user{i}', 'user{j}') AND NOT {{winlog.task}} = 'Task 3'"),
        5: ("snoopy", "{{cmd}} LIKE '%-a {i}%' OR {{login}} = 'user{i}'"),
    }
    out = []
    for i in range(n):
        kind, text = shapes[i % 6 if i % 100 == 5 or i % 6 != 5 else 1]
        condition = text.format(i=i, j=i + 1, d=i % 10, w=4600 + i % 1000)
        out.append((f"m{i:05d}", f"rule {i}", kind, [], condition))
    return out


MANY = 2000
MANY_SQL = EV + f""", n AS (SELECT i, CASE WHEN i%100=5 OR i%6<>5 THEN i%6 ELSE 1 END AS shape FROM range({MANY}) r(i)),
  hits AS (
    SELECT event_id, i FROM ev JOIN n ON shape=0 AND {EVE_ALERT} AND k=i AND k>0
    UNION ALL SELECT event_id, i FROM ev JOIN n ON shape=1 AND kind='snoopy' AND k%10=i%10 AND starts_with(CAST(event_id AS VARCHAR), CAST(i AS VARCHAR))
    UNION ALL SELECT event_id, i FROM ev JOIN n ON shape=2 AND kind='windows' AND k=i%1000
    UNION ALL SELECT event_id, i FROM ev JOIN n ON shape=3 AND kind='suricata' AND k%4=0 AND starts_with(CAST(k AS VARCHAR), CAST(i AS VARCHAR))
    UNION ALL SELECT event_id, i FROM ev JOIN n ON shape=4 AND kind IN ('windows','sysmon') AND uid IN (i, i+1) AND k%6<>3
    UNION ALL SELECT event_id, i FROM ev JOIN n ON shape=5 AND kind='snoopy' AND (uid=i OR starts_with(CAST(event_id AS VARCHAR), CAST(i AS VARCHAR))))
"""


@query("e5_rules_indexed", MANY_SQL + """SELECT event_id, count(i) AS n, coalesce(string_agg('m'||lpad(CAST(i AS VARCHAR), 5, '0'), ',' ORDER BY i), '') AS matched,
      CASE WHEN kind='syslog' THEN 'no-ruleset' WHEN count(i)>0 THEN 'match' ELSE 'miss' END AS state
    FROM ev LEFT JOIN hits USING (event_id) GROUP BY event_id, kind""")
def e5_indexed(spark, sf):
    """Two thousand rules, found by their anchors."""
    table = spark.createDataFrame(many_rules(MANY), rules_table(spark).schema)
    m = match_rules(_decoded(spark, sf), load_rules(table))
    ids = F.coalesce(F.array_join(F.transform("sigma_results", lambda r: r["rule_id"]), ","), F.lit(""))
    n = F.coalesce(F.size("sigma_results"), F.lit(0)).cast("bigint")
    return m.select(F.col("offset").alias("event_id"), n.alias("n"), ids.alias("matched"), F.col("sigma_state").alias("state"))


@query("e5_rules_sysmon", EV + "SELECT event_id, k%6=1 AS matched FROM ev WHERE kind='sysmon'")
def e5_sysmon(spark, sf):
    rows = render.json_events(spark, sf).filter("kind = 'sysmon'")
    m = match_rules(decode(rows), load_rules(rules_table(spark)), sysmon_rules=True)
    hit = F.coalesce(F.exists("sigma_results", lambda r: r["rule_id"] == "r05"), F.lit(False))
    return m.select(F.col("offset").alias("event_id"), hit.alias("matched"))


@query("e6_event_technique", J + "SELECT event_id, own AS technique, CASE WHEN own IS NOT NULL THEN CASE WHEN kind='suricata' THEN '' ELSE 'Tech '||k END END AS name FROM facts")
def e6(spark, sf):
    d = _decoded(spark, sf).withColumn("t", en.event_technique())
    return d.select(F.col("offset").alias("event_id"), F.col("t.ID").alias("technique"), F.col("t.Name").alias("name"))


@query("e7_fill_techniques", J + """SELECT event_id, own AS technique,
      CASE WHEN own IS NOT NULL THEN coalesce(tname, CASE WHEN kind='suricata' THEN '' ELSE 'Tech '||k END) END AS name FROM joined""")
def e7(spark, sf):
    d = _decoded(spark, sf).withColumn("technique", en.event_technique())
    f = en.fill_techniques(d, en.technique_lookup(render.techniques(spark, sf)))
    return f.select(F.col("offset").alias("event_id"), F.col("technique.ID").alias("technique"), F.col("technique.Name").alias("name"))


@query("e8_tag_techniques", "WITH " + TECH + """, tags(rule_id, pos, id) AS (VALUES ('r01',0,'T1003'),('r02',0,'T1001'),('r02',1,'T1003'),('r03',0,'T1009'),('r04',0,'T1002'))
    SELECT rule_id, string_agg(tech.id||'='||name, ',' ORDER BY pos) AS techniques FROM tags JOIN tech USING (id) GROUP BY 1""")
def e8(spark, sf):
    t = tag_techniques(rules_table(spark), render.techniques(spark, sf))
    return t.select("rule_id", F.array_join(F.transform("techniques", lambda x: F.concat(x["ID"], F.lit("="), x["Name"])), ",").alias("techniques"))


@query("e9_finalize_attack", NAMED + """SELECT event_id, coalesce(ids, '') AS ids, coalesce(names, '') AS names, coalesce(head, '') AS head
    FROM res LEFT JOIN attack USING (event_id) WHERE kind IN ('syslog','snoopy') OR ids IS NOT NULL""")
def e9(spark, sf):
    e = _enriched(spark, sf)
    m = F.col("GameMeta.MitreAttack")
    return e.filter(en.emit()).select(
        F.col("offset").alias("event_id"),
        F.array_join(F.transform(m["Techniques"], lambda t: t["ID"]), ",").alias("ids"),
        F.coalesce(F.array_join(m["Items"], "|"), F.lit("")).alias("names"), m["ID"].alias("head"),
    )


@query("e10_direction", J + f"SELECT event_id, CAST(code AS BIGINT) AS code, {LABEL} AS direction FROM res")
def e10(spark, sf):
    b = en.join_endpoints(en.blank_asset(_decoded(spark, sf)), index_lookup(_index(spark, sf)))
    d = en.direction(b)
    return d.select(F.col("offset").alias("event_id"), F.col("directionality").cast("bigint").alias("code"), "direction")


@query("e11_enrich", NAMED + f"""SELECT event_id, CASE WHEN kind='sysmon' THEN 'windows' ELSE kind END AS event_type,
      coalesce(hit_host, host) AS host, coalesce(team, '') AS team, {LABEL} AS direction, ids,
      CASE WHEN r01 AND r02 THEN 2 WHEN r01 OR r02 OR r03 OR r04 THEN 1 ELSE 0 END::BIGINT AS n_results,
      src_host, dest_host FROM res LEFT JOIN attack USING (event_id)""")
def e11(spark, sf):
    e = _enriched(spark, sf)
    g = F.col("GameMeta")
    ids = F.array_join(F.transform(g["MitreAttack"]["Techniques"], lambda t: t["ID"]), ",")
    return e.select(
        F.col("offset").alias("event_id"), g["EventType"].alias("event_type"), g["Host"].alias("host"), g["Team"].alias("team"),
        g["DirectionString"].alias("direction"), F.nullif(ids, F.lit("")).alias("ids"),
        F.coalesce(F.size(g["SigmaResults"]), F.lit(0)).cast("bigint").alias("n_results"),
        F.nullif(g["Src"]["Host"], F.lit("")).alias("src_host"), F.nullif(g["Dest"]["Host"], F.lit("")).alias("dest_host"),
    )


@query("e12_output", J + f"""SELECT event_id, {LABEL} AS direction, coalesce(hit_host, host) AS host,
      CASE WHEN kind='suricata' THEN uip WHEN kind='syslog' THEN 'event '||event_id||' value '||k WHEN kind='snoopy' THEN ' cmd'||(k%10)||' -a '||event_id
        ELSE 'Task '||(k%6) END AS original FROM res""")
def e12(spark, sf):
    # printed twice: a second run replaces the block of the first
    o = en.to_output(en.to_output(_enriched(spark, sf)))
    j = lambda p: F.get_json_object("value", p)
    original = F.when(F.col("kind") == "suricata", j("$.src_ip")).when(F.col("kind") == "syslog", j("$.syslog_message")).when(
        F.col("kind") == "snoopy", j("$.cmd")).otherwise(j("$.winlog.task"))
    return o.select(F.col("offset").alias("event_id"), j("$.GameMeta.DirectionString").alias("direction"),
                    j("$.GameMeta.Host").alias("host"), original.alias("original"))


DYNAMIC = "kind IN ('suricata','windows','sysmon')"


@query("e12_blocks", J + f"""SELECT event_id, {LABEL} AS direction, CASE WHEN k%3=0 THEN 'last' END AS after, CASE WHEN k%3=1 THEN '{{{{"GameMeta":{{{{}}}},"a":1}}}}' END AS nested,
      true AS valid, 'Alias,DirectionString,Directionality,Domain,EventData,EventType,Host,IP,MitreAttack,OS,Role,SigmaResults,Src,Dest,Team,VM,Zone,is_asset' AS names FROM res WHERE {DYNAMIC}""".replace("{{", "{").replace("}}", "}"))
def e12_blocks(spark, sf):
    """Blocks of an earlier run in the middle of an event, inside another object and alone; nulls stay in the output."""
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    events = render.table(spark, sf, "events").select(F.col("event_id").alias("offset"), k.alias("k"))
    rows = _enriched(spark, sf).filter(DYNAMIC).join(events, "offset")
    body = F.regexp_replace("value", r"\s*\}\s*$", "")
    middle = F.concat(body, F.lit(',"GameMeta":{"x":1},"after":"last"}'))
    nested = F.concat(body, F.lit(',"nested":{"a":1,"GameMeta":{}}}'))
    value = F.when(F.col("k") % 3 == 0, middle).when(F.col("k") % 3 == 1, nested).otherwise(F.lit('{"GameMeta":{"x":1}}'))
    o = en.to_output(rows.withColumn("value", value))
    j = lambda p: F.get_json_object("value", p)
    names = F.json_object_keys(j("$.GameMeta"))
    order = "Alias,DirectionString,Directionality,Domain,EventData,EventType,Host,IP,MitreAttack,OS,Role,SigmaResults,Src,Dest,Team,VM,Zone,is_asset"
    listed = F.array_join(F.filter(F.array(*[F.lit(n) for n in order.split(",")]), lambda n: F.array_contains(names, n)), ",")
    valid = F.expr("try_parse_json(value)").isNotNull() & ~F.contains("value", F.lit('"x":1'))
    return o.select(F.col("offset").alias("event_id"), j("$.GameMeta.DirectionString").alias("direction"), j("$.after").alias("after"),
                    j("$.nested").alias("nested"), valid.alias("valid"), listed.alias("names"))


@query("e13_emit", NAMED + """SELECT kind, count(*) AS events, CAST(sum(CASE WHEN kind IN ('syslog','snoopy') OR ids IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS emitted,
      CAST(sum(CASE WHEN ids IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS with_technique FROM res LEFT JOIN attack USING (event_id) GROUP BY 1""")
def e13(spark, sf):
    e = _enriched(spark, sf)
    return e.groupBy("kind").agg(F.count(F.lit(1)).alias("events"), F.count_if(en.emit()).alias("emitted"),
                                 F.count_if(en.emit(require_technique=True)).alias("with_technique"))


def _alerts(spark, sf):
    d = render.json_events(spark, sf).filter("kind = 'suricata'")
    sid = F.get_json_object("value", "$.alert.signature_id").cast("bigint")
    return d.select("topic", "partition", "offset", sid.alias("sid"), F.get_json_object("value", "$.alert.signature").alias("msg")).filter("sid is not null")


def _sids(spark, sf):
    """Mappings for two of three signatures that the alerts may carry."""
    rows = render.sid_map_rows(spark, sf).withColumn("sid", (F.col("sid") % 1000).cast("int")).filter("sid % 3 <> 0")
    return rows.withColumn("sid", F.col("sid") + 2000).dropDuplicates(["sid"])


SIDS = "sids AS (SELECT DISTINCT 2000 + p_partkey%1000 AS sid FROM part WHERE p_partkey%1000%3<>0)"


@query("e14_join_sid_map", EV + f", {SIDS} SELECT CAST(sum(CASE WHEN s.sid IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS matches, CAST(sum(CASE WHEN s.sid IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS misses FROM ev LEFT JOIN sids s ON s.sid=2000+k WHERE {EVE_ALERT}")
def e14(spark, sf):
    return sidmap.sid_counts(sidmap.join_sid_map(_alerts(spark, sf), _sids(spark, sf), en.SPREAD))


@query("e14_missing_sids", EV + f", {SIDS} SELECT DISTINCT 2000+k AS sid, 'SIG '||k AS msg FROM ev WHERE {EVE_ALERT} AND 2000+k NOT IN (SELECT sid FROM sids)")
def e14_missing(spark, sf):
    return sidmap.missing_sids(_alerts(spark, sf), _sids(spark, sf))


@query("e15_parse_errors", J + """SELECT kind, count(*) AS events, CAST(sum(CASE WHEN k%7=3 THEN 1 ELSE 0 END) AS BIGINT) AS parse_errors FROM res GROUP BY 1""")
def e15_errors(spark, sf):
    tech = render.techniques(spark, sf)
    broken = F.when(F.col("offset").isNotNull() & (F.get_json_object("props", "$.k").cast("bigint") % 7 == 3), F.lit("{oops"))
    props = render.table(spark, sf, "events").select(F.col("event_id").alias("offset"), "props")
    rows = render.json_events(spark, sf).join(props, "offset").withColumn("value", F.coalesce(broken, F.col("value"))).drop("props")
    e = en.enrich(rows, index_lookup(_index(spark, sf)), en.technique_lookup(tech), load_rules(rules_table(spark), tech))
    return en.enrich_metrics(e).select("kind", "events", "parse_errors")


@query("e15_metrics", J + """SELECT kind, count(*) AS events, CAST(0 AS BIGINT) AS parse_errors,
      CAST(sum(CASE WHEN kind<>'syslog' AND (r01 OR r02 OR r03 OR r04) THEN 1 ELSE 0 END) AS BIGINT) AS sigma_matches,
      CAST(sum(CASE WHEN kind<>'syslog' AND NOT (r01 OR r02 OR r03 OR r04) THEN 1 ELSE 0 END) AS BIGINT) AS sigma_misses,
      CAST(sum(CASE WHEN kind='syslog' THEN 1 ELSE 0 END) AS BIGINT) AS sigma_no_ruleset,
      CAST(sum(CASE WHEN kind='suricata' AND k%13=0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_timestamp FROM res GROUP BY 1""")
def e15(spark, sf):
    return en.enrich_metrics(_enriched(spark, sf))
