"""Queries of the sinks: what would be written, or what was written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from logspark.operators.decode import sysmon_process_network
from logspark.operators.enrich import emit, to_output
from logspark.operators.sidmap import missing_sids
from logspark.plans import render
from logspark.plans.catalog import EV, RECORDS, query
from logspark.plans.q_enrich import NAMED, _alerts, _enriched, _sids
from logspark.sinks import outputs as out
from logspark.sources.logfiles import read_logs


def now_at():
    return F.timestamp_seconds(F.lit(1704153600))



@query("k1_route", NAMED + """, e AS (SELECT event_id, kind, kind IN ('syslog','snoopy') OR ids IS NOT NULL AS emit FROM res LEFT JOIN attack USING (event_id))
    SELECT 'events-'||kind AS topic, CAST(NULL AS VARCHAR) AS key, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM e GROUP BY 1, kind UNION ALL SELECT 'fast', kind, count(*), CAST(sum(event_id) AS BIGINT) FROM e WHERE emit GROUP BY kind""")
def k1(spark, sf):
    rows = to_output(_enriched(spark, sf)).withColumn("value", F.concat(F.col("offset").cast("string"), F.lit(" "), F.col("value")))
    r = out.route_topics(rows, "events", "fast", emit(), split=True)
    ids = F.sum(F.substring_index("value", " ", 1).cast("bigint"))
    return r.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"), ids.alias("ids"))


@query("k1_missing_sids", EV + """, sids AS (SELECT DISTINCT 2000 + p_partkey%1000 AS sid FROM part WHERE p_partkey%1000%3<>0),
    missing AS (SELECT DISTINCT 2000+k AS sid, 'SIG '||k AS msg FROM ev WHERE (kind='suricata' AND k%5<>0) AND 2000+k NOT IN (SELECT sid FROM sids))
    SELECT 'oracle' AS topic, 'meerkat_missing_sid_map' AS key, '['||string_agg('{"sid":'||sid||',"msg":"'||msg||'","id":"","name":"","tactic":""}', ',' ORDER BY sid)||']' AS value FROM missing""")
def k1_missing(spark, sf):
    return out.missing_sid_message(missing_sids(_alerts(spark, sf), _sids(spark, sf)), "oracle")


@query("k1_route_preprocess", EV + "SELECT 'clean-'||kind AS topic, count(*) AS n FROM ev GROUP BY kind")
def k1_pre(spark, sf):
    return out.route_preprocess(render.json_events(spark, sf), "clean").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("k2_archive", EV + "SELECT 'raw-'||kind AS source, strftime(ts, '%Y%m%d')||'000000' AS bucket, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM ev GROUP BY 1, 2")
def k2(spark, sf):
    path = render.scratch_path(spark, "archive")
    rows = render.json_events(spark, sf).select(
        F.concat(F.lit("raw -"), "kind").alias("topic"), F.to_json(F.struct("offset")).alias("value"), "offset", "timestamp"
    )
    out.archive(rows, path, seconds=86400, now=F.col("timestamp"))
    back = spark.read.schema("value STRING, source STRING, bucket STRING").text(path)
    return back.groupBy("source", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("value", "$.offset").cast("bigint")).alias("ids")
    )


@query("k3_files", EV + "SELECT 'all' AS part, count(*) AS n FROM ev UNION ALL SELECT kind, count(*) FROM ev GROUP BY 1")
def k3(spark, sf):
    one, many = render.scratch_path(spark, "combined"), render.scratch_path(spark, "kinds")
    rows = render.json_events(spark, sf).withColumn("value", F.concat("value", F.lit("\n\n")))
    out.write_files(rows, one, many)
    total = spark.read.text(one).agg(F.lit("all").alias("part"), F.count(F.lit(1)).alias("n"))
    kinds = spark.read.schema("value STRING, kind STRING").text(many).groupBy(F.col("kind").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return total.unionByName(kinds)


@query("k4_index", EV + "SELECT 'logs-raw-'||kind||'-x-'||CASE WHEN k%13=0 THEN '2024.01.02' ELSE strftime(ts, '%Y.%m.%d') END AS index_name, count(*) AS n FROM ev GROUP BY 1")
def k4(spark, sf):
    ev = render.base_events(spark, sf)
    ts = F.when(F.col("k") % 13 != 0, F.col("ts"))
    name = out.index_name("logs", F.concat(F.lit("raw."), F.col("kind"), F.lit(" _x")), ts, now_at())
    return ev.groupBy(name.alias("index_name")).agg(F.count(F.lit(1)).alias("n"))


@query("k5_queue", EV + "SELECT kind, 'Task '||(k%6) AS task, count(*) AS n FROM ev WHERE kind='sysmon' AND k%4 IN (0,1) GROUP BY 1, 2")
def k5(spark, sf):
    path = render.scratch_path(spark, "queue")
    out.append_queue(sysmon_process_network(render.json_events(spark, sf)), path)
    task = F.get_json_object("value", "$.winlog.task").alias("task")
    return spark.read.parquet(path).groupBy(F.lit("sysmon").alias("kind"), task).agg(F.count(F.lit(1)).alias("n"))


@query("k6_snapshot", "WITH " + RECORDS + "SELECT seq, host_name, addr FROM rec")
def k6(spark, sf):
    path = render.scratch_path(spark, "snapshot")
    out.write_snapshot(render.records(spark, sf), path)
    return spark.read.schema("seq BIGINT, host_name STRING, addr STRING").json(path)


@query("k7_file_to_topic", "SELECT 'replay' AS topic, 'k' AS key, count(*) AS n FROM events")
def k7(spark, sf):
    rows = out.file_to_topic(read_logs(spark, render.log_folder(spark, sf)), "replay", "k")
    return rows.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"))


@query("k5_queue_replayed", EV + "SELECT 'Task '||(k%6) AS task, count(*) AS n FROM ev WHERE kind='sysmon' AND k%4 IN (0,1) GROUP BY 1")
def k5_replayed(spark, sf):
    """Two micro-batches, the second written twice, as after a crash: no line is doubled."""
    path = render.scratch_path(spark, "queue")
    rows = sysmon_process_network(render.json_events(spark, sf))
    for batch_id, odd in ((0, 0), (1, 1), (1, 1)):
        out.append_queue(rows.filter(F.col("offset") % 2 == odd), path, batch_id)
    task = F.get_json_object("value", "$.winlog.task").alias("task")
    return spark.read.parquet(path).groupBy(task).agg(F.count(F.lit(1)).alias("n"))
