"""Queries of the topic and log-directory sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from logspark.plans import render
from logspark.plans.catalog import EV, query
from logspark.plans.render import LINES_PER_FILE as N
from logspark.sources import logfiles as lf, topics as tp

FILES = EV + f", lines AS (SELECT *, event_id//{N} AS file, row_number() OVER (PARTITION BY event_id//{N} ORDER BY event_id) - 1 AS off FROM ev)"


def _logs(spark, sf):
    return lf.read_logs(spark, render.log_folder(spark, sf), "suricata")


def _id():
    return F.get_json_object("value", "$.event_id").cast("bigint")


@query("s1_read_events", "SELECT event_id % 4 AS part, count(*) AS n FROM events GROUP BY 1")
def s1(spark, sf):
    path = render.scratch_path(spark, "topic")
    render.raw_lines(spark, sf).write.parquet(path)
    rows = tp.read_events(spark, path, "earliest", streaming=False)
    return rows.groupBy(F.col("partition").cast("bigint").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("s2_read_logs", FILES + "SELECT CAST(file AS VARCHAR) AS file, off AS offset_no, CASE WHEN k%25<>24 AND k%10<>9 THEN event_id END AS event_id FROM lines")
def s2(spark, sf):
    good = F.when(~F.contains("value", F.lit("\\")), _id())
    return _logs(spark, sf).select(render.file_of(F.col("path")).alias("file"), F.col("offset").alias("offset_no"), good.alias("event_id"))


@query("s3_slice_lines", FILES + "SELECT CAST(file AS VARCHAR) AS file, off AS offset_no FROM lines WHERE off BETWEEN 10 AND 500")
def s3(spark, sf):
    rows = lf.slice_lines(_logs(spark, sf), 10, 500)
    return rows.select(render.file_of(F.col("path")).alias("file"), F.col("offset").alias("offset_no"))


@query("s3_get_line", FILES + "SELECT CAST(file AS VARCHAR) AS file, off AS offset_no FROM lines WHERE off = 7")
def s3_line(spark, sf):
    return lf.get_line(_logs(spark, sf), 7).select(render.file_of(F.col("path")).alias("file"), F.col("offset").alias("offset_no"))


@query("s4_file_stats", FILES + """, edge AS (SELECT file, count(*) AS lines, arg_min(k, off) AS ka, arg_max(k, off) AS kb, arg_min(ts, off) AS ta, arg_max(ts, off) AS tb FROM lines GROUP BY 1)
    SELECT CAST(file AS VARCHAR) AS file, lines, lines AS end_no, CASE WHEN ka%25<>24 AND ka%10<>9 AND ka%13<>0 THEN epoch_us(ta) END AS first_us,
      CASE WHEN kb%25<>24 AND kb%10<>9 AND kb%13<>0 THEN epoch_us(tb) END AS last_us FROM edge""")
def s4(spark, sf):
    ts = F.when(
        F.expr("try_parse_json(value)").isNotNull(), F.get_json_object("value", "$.@timestamp").try_cast("timestamp")
    )
    st = lf.file_stats(_logs(spark, sf), ts)
    return st.select(render.file_of(F.col("path")).alias("file"), "lines", F.col("end").alias("end_no"),
                     F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"))


@query("s5_with_kind", EV + "SELECT CASE WHEN kind<>'sysmon' THEN kind END AS kind, CASE kind WHEN 'syslog' THEN 'rfc5424' ELSE 'json-peek' END AS parser, kind='sysmon' AS rejected, count(*) AS n FROM ev GROUP BY 1,2,3")
def s5(spark, sf):
    mapping = tp.parse_topic_map([m for m in render.TOPIC_MAP if "sysmon" not in m])
    k = tp.with_kind(render.raw_lines(spark, sf), mapping, {"raw-syslog": "rfc5424", "raw-snoopy": "other"})
    return k.groupBy("kind", "parser", F.col("_error").isNotNull().alias("rejected")).agg(F.count(F.lit(1)).alias("n"))


@query("s6_dir_kind", EV + "SELECT CASE WHEN kind IN ('syslog','snoopy') THEN kind END AS kind, count(*) AS n FROM ev GROUP BY 1")
def s6(spark, sf):
    rows = render.raw_lines(spark, sf).withColumn("path", F.concat(F.lit("file:///logs/"), "topic", F.lit("/x.log.gz")))
    k = tp.with_dir_kind(rows, {"/logs//raw-syslog/": "syslog", "/logs/./raw-snoopy": "snoopy"})
    return k.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("s12_peek_topic", EV + "SELECT event_id, kind IN ('windows','sysmon') AS consumed, CASE WHEN kind IN ('windows','sysmon') THEN event_id END AS koffset, CASE WHEN kind IN ('windows','sysmon') THEN '3' END AS kkey FROM ev WHERE uid%7=3")
def s12(spark, sf):
    p = tp.peek_topic(render.raw_lines(spark, sf), "3")
    j = lambda path: F.when(F.col("consumed"), F.get_json_object("line", path))
    return p.select(F.col("offset").alias("event_id"), "consumed", j("$.kafka.offset").cast("bigint").alias("koffset"), j("$.kafka.key").alias("kkey"))
