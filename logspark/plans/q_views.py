"""Queries of the indicator lists and published views."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from logspark import fixed
from logspark.operators import indicators as ioc, views
from logspark.plans import render
from logspark.plans.catalog import RECORDS, ip_sql, query
from logspark.plans.render import text


def now_at():
    return F.timestamp_seconds(F.lit(1704153600))

I = f"""WITH ind AS (SELECT c_custkey AS seq, CASE c_custkey%8 WHEN 0 THEN 'src_ip' WHEN 1 THEN 'dest_ip' WHEN 2 THEN 'tls.ja3.hash' WHEN 3 THEN 'tls.ja3s.hash'
      WHEN 4 THEN 'tls.sni' WHEN 5 THEN 'http.hostname' WHEN 6 THEN 'bogus' ELSE '' END AS type,
    CASE WHEN c_custkey%8<2 THEN CASE WHEN c_custkey%24=0 THEN 'not-ip' ELSE {ip_sql('(c_custkey%500)')} END
      WHEN c_custkey%8<4 THEN md5(CAST(c_custkey%300 AS VARCHAR)) WHEN c_custkey%40=4 THEN '' ELSE 'evil'||(c_custkey%300)||'.example' END AS value FROM customer),
  val AS (SELECT *, CASE WHEN type='' THEN 'missing IoC type' WHEN value='' THEN 'missing IoC value' WHEN value='not-ip' AND type='src_ip' THEN 'invalid IP addr'
      WHEN type='bogus' THEN 'unsupported item type' END AS error FROM ind),
  prior AS (SELECT s_suppkey AS id, s_suppkey%3<>0 AS enabled, {ip_sql('s_suppkey')} AS value, 'src_ip' AS type FROM supplier),
  fresh AS (SELECT type, value, min(seq) AS seq FROM val WHERE error IS NULL AND (type, value) NOT IN (SELECT (type, value) FROM prior) GROUP BY 1, 2),
  reg AS (SELECT id, enabled, value, type FROM prior UNION ALL
    SELECT (SELECT max(id)+1 FROM prior) + row_number() OVER (ORDER BY seq) - 1, true, value, type FROM fresh)
"""


def _valid(spark, sf):
    v = ioc.validate_iocs(render.indicator_rows(spark, sf))
    return v.filter(F.col("_error").isNull()).drop("_error")


def _registry(spark, sf):
    return ioc.register_iocs(_valid(spark, sf), render.prior_indicators(spark, sf), now_at())


@query("i1_validate", I + "SELECT seq, error FROM val")
def i1(spark, sf):
    return ioc.validate_iocs(render.indicator_rows(spark, sf)).select("seq", F.col("_error").alias("error"))


@query("i2_register", I + "SELECT id, enabled, value, type FROM reg")
def i2(spark, sf):
    return _registry(spark, sf)[0].select("id", "enabled", "value", "type")


@query("i2_answers", I + "SELECT seq, id FROM val JOIN reg USING (type, value) WHERE error IS NULL")
def i2_answers(spark, sf):
    return _registry(spark, sf)[1].select("seq", "id")


CHG = I + ", chg AS (SELECT c_custkey%700 AS id, c_custkey%2=0 AS flag, c_custkey AS seq FROM customer), last AS (SELECT id, arg_max(flag, seq) AS flag FROM chg GROUP BY 1) "


def _changes(spark, sf):
    c = F.col("c_custkey")
    return render.table(spark, sf, "customer").select((c % 700).alias("id"), (c % 2 == 0).alias("enabled"), c.alias("seq"))


@query("i3_set_enabled", CHG + "SELECT id, coalesce(flag, enabled) AS enabled FROM prior LEFT JOIN last USING (id)")
def i3(spark, sf):
    return ioc.set_enabled(render.prior_indicators(spark, sf), _changes(spark, sf))[0].select("id", "enabled")


@query("i3_unknown_ids", CHG + "SELECT id FROM last WHERE id NOT IN (SELECT id FROM prior)")
def i3_unknown(spark, sf):
    return ioc.set_enabled(render.prior_indicators(spark, sf), _changes(spark, sf))[1]


@query("i4_listing", I + "SELECT id, type, value, CAST(list_position(['" + "','".join(fixed.INDICATOR_TYPES) + "'], type) AS BIGINT) AS type_rank FROM reg")
def i4(spark, sf):
    return ioc.list_iocs(_registry(spark, sf)[0]).select("id", "type", "value", F.col("type_rank").cast("bigint").alias("type_rank"))


@query("i4_counts", I + "SELECT count(*) AS total, max(id)+1 AS next_id FROM reg")
def i4_counts(spark, sf):
    return ioc.ioc_counts(_registry(spark, sf)[0])


def _tpl(template: str, args: list[str]) -> str:
    """SQL text that fills a template's placeholders in order."""
    parts = re.split(r"%[sd]", template)
    out = "'" + parts[0].replace("'", "''") + "'"
    for arg, part in zip(args, parts[1:]):
        out += f"||{arg}||'" + part.replace("'", "''") + "'"
    return out


def _rule_sql(template: str, value_first: bool, offset: int = 0) -> str:
    three = ["value", "value", "type"] if value_first else ["type", "value", "value"]
    return _tpl(template, three + [f"(id+{fixed.RULE_SID_OFFSET + offset})", "'3'", f"'{fixed.RULE_METADATA}'"])


@query("i5_rules", I + f"""SELECT id, 0::BIGINT AS line_no, CASE WHEN enabled THEN '' ELSE '# ' END || CASE type WHEN 'src_ip' THEN {_rule_sql(fixed.RULE_SRC_IP, True)}
      WHEN 'dest_ip' THEN {_rule_sql(fixed.RULE_DEST_IP, True)} WHEN 'tls.ja3.hash' THEN {_rule_sql(fixed.RULE_JA3, False)}
      WHEN 'tls.ja3s.hash' THEN {_rule_sql(fixed.RULE_JA3S, False)} WHEN 'tls.sni' THEN {_rule_sql(fixed.RULE_TLS_SNI, False)}
      ELSE {_rule_sql(fixed.RULE_HTTP_HOST, False)} END AS rule FROM reg
    UNION ALL SELECT id, 1, CASE WHEN enabled THEN '' ELSE '# ' END || {_rule_sql(fixed.RULE_JA3_INBOUND, False, fixed.RULE_SECOND_SID_OFFSET)} FROM reg WHERE type='tls.ja3.hash'""")
def i5(spark, sf):
    return ioc.ioc_rules(_registry(spark, sf)[0]).select("id", F.col("line_no").cast("bigint").alias("line_no"), "rule")


@query("i6_asset_json", "WITH " + RECORDS + "SELECT host_name, addr, team FROM rec")
def i6_json(spark, sf):
    j = views.asset_json(render.records(spark, sf))
    return j.select(*[F.get_json_object("value", f"$.{n}").alias(n) for n in ("host_name", "addr", "team")])


HEAD = ", ".join(f"('{line}')" for line in fixed.TAGGER_HEADER)


@query("i6_tagger_text", "WITH " + RECORDS + f"SELECT addr||';0='||fqdn||';1='||pretty||';2='||team||';3='||os||';4='||network_name AS value FROM rec UNION ALL SELECT * FROM (VALUES {HEAD}) t(v)")
def i6_text(spark, sf):
    return views.tagger_text(render.records(spark, sf)).select("value")


SIDS = "WITH upd AS (SELECT p_partkey%700 AS sid, lower(p_type) AS tactic, 'T1'||lpad(CAST(p_partkey%1000 AS VARCHAR),3,'0') AS id, p_name AS name, 'msg \"'||p_brand||'\", '||p_size AS msg, p_partkey AS seq FROM part), view AS (SELECT * FROM upd QUALIFY row_number() OVER (PARTITION BY sid ORDER BY seq DESC)=1) "


def _sid_view(spark, sf):
    rows = render.sid_map_rows(spark, sf).withColumn("seq", F.col("sid")).withColumn("sid", F.col("sid") % 700)
    return views.latest_sid_map(rows, "seq")


@query("i7_sid_map_csv", SIDS + "SELECT CAST(sid AS BIGINT) AS sid, sid||','||tactic||','||id||','||name||',\"'||replace(msg, '\"', '\"\"')||'\"' AS line FROM view")
def i7(spark, sf):
    return views.sid_map_csv(_sid_view(spark, sf)).withColumn("sid", F.col("sid").cast("bigint"))


@query("i7_updates", SIDS + """, third AS (SELECT * FROM upd WHERE seq%3=0 QUALIFY row_number() OVER (PARTITION BY sid ORDER BY seq DESC)=1)
    SELECT 'kept' AS kind, CAST(sid AS BIGINT) AS sid, name FROM view UNION ALL SELECT 'replaced', CAST(sid AS BIGINT), name FROM third
    UNION ALL SELECT 'missing kept', CAST(seq AS BIGINT), msg FROM upd WHERE seq%5=0 UNION ALL SELECT 'missing replaced', CAST(seq AS BIGINT), msg FROM upd WHERE seq%7=0""")
def i7_updates(spark, sf):
    """An empty update keeps the view and the list of unmapped ids; any other replaces them as a whole."""
    rows = render.sid_map_rows(spark, sf).withColumn("seq", F.col("sid"))
    mapped = rows.withColumn("sid", F.col("sid") % 700)
    view = views.latest_sid_map(mapped, "seq")
    old, new, none = (rows.filter(c).select("sid", "msg") for c in (F.col("seq") % 5 == 0, F.col("seq") % 7 == 0, F.lit(False)))
    parts = [
        ("kept", views.latest_sid_map(mapped.filter(F.lit(False)), "seq", view), "name"),
        ("replaced", views.latest_sid_map(mapped.filter(F.col("seq") % 3 == 0), "seq", view), "name"),
        ("missing kept", views.replace_missing_sids(none, old), "msg"),
        ("missing replaced", views.replace_missing_sids(new, old), "msg"),
    ]
    out = [df.select(F.lit(kind).alias("kind"), F.col("sid").cast("bigint").alias("sid"), F.col(c).alias("name")) for kind, df, c in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("i9_sid_key_values", SIDS + "SELECT CAST(sid AS BIGINT) AS sid, name, msg FROM view")
def i9(spark, sf):
    kv = views.sid_key_values(_sid_view(spark, sf))
    return kv.select(F.col("sid").cast("bigint").alias("sid"), *[F.get_json_object("value", f"$.{n}").alias(n) for n in ("name", "msg")])


@query("i8_field_tags", f"""WITH c AS (SELECT *, c_custkey%400 AS g FROM customer QUALIFY row_number() OVER (PARTITION BY c_custkey%400 ORDER BY c_custkey DESC)=1)
    SELECT {ip_sql('g')} AS ip, {ip_sql('g')}||';t.name='||c_name||CASE WHEN c_nationkey%3<>0 THEN ';t.zone=z'||c_nationkey ELSE '' END||';t.segment='||c_mktsegment AS tagger FROM c""")
def i8(spark, sf):
    c = F.col("c_custkey")
    rows = render.table(spark, sf, "customer").select(
        render.ip_of(c % 400).alias("ip"), F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 3 != 0, F.concat(F.lit("z"), text(F.col("c_nationkey")))).otherwise("").alias("zone"),
        F.col("c_mktsegment").alias("segment"), c.alias("seq"),
    )
    return views.field_tags(rows, "t")


FACTS = """WITH f AS (SELECT 'm'||(c_custkey%200) AS fqdn, CASE WHEN c_custkey%9<>0 THEN '3.'||(c_custkey%12)||'.1' END AS version, year(make_timestamp(CAST((1546300800 + c_custkey*40000)*1000000 AS BIGINT))) AS year, c_custkey AS n FROM customer),
  g AS (SELECT * FROM f WHERE version IS NOT NULL) """


@query("i10_dual_write", FACTS + "SELECT 'history' AS kind, CAST(year AS VARCHAR) AS key, count(*) AS n, '' AS version FROM g GROUP BY 2 UNION ALL SELECT 'latest', fqdn, 1, version FROM g QUALIFY row_number() OVER (PARTITION BY fqdn ORDER BY n DESC)=1")
def i10(spark, sf):
    c = F.col("c_custkey")
    version = F.when(c % 9 != 0, F.array(F.lit(3).cast("bigint"), c % 12, F.lit(1).cast("bigint")))
    facts = render.table(spark, sf, "customer").select(
        F.concat(F.lit("m"), text(c % 200)).alias("fqdn"), version.alias("pythonversion"),
        F.timestamp_seconds(F.lit(1546300800) + c * 40000).alias("updated"),
    )
    history, first, latest = (render.scratch_path(spark, n) for n in ("history", "latest", "latest"))
    # two runs: the view is first taken over the history, then the second run's facts are merged into it
    early = F.col("updated") < F.timestamp_seconds(F.lit(1546300800 + 500 * 40000))
    views.dual_write(facts.filter(~early), history, first, run=1)
    for _ in range(2):  # the second run is tried again
        views.dual_write(facts.filter(early), history, latest, previous=spark.read.parquet(first), run=2)
    h = spark.read.parquet(history).groupBy(text(F.col("year")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    one = spark.read.parquet(latest)
    return h.select(F.lit("history").alias("kind"), "key", "n", F.lit("").alias("version")).unionByName(
        one.select(F.lit("latest").alias("kind"), F.col("fqdn").alias("key"), F.lit(1).cast("bigint").alias("n"), F.col("pythonversion").alias("version"))
    )
