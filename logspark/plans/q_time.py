"""Queries of the time and replay operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from logspark.operators import timeline as tl
from logspark.plans import render
from logspark.plans.catalog import EV, query
from logspark.plans.render import LINES_PER_FILE as N

def period():
    return F.lit("2024-01-05 06:00:00").cast("timestamp"), F.lit("2024-01-20 18:30:00").cast("timestamp")


BS, ES = "TIMESTAMP '2024-01-05 06:00:00'", "TIMESTAMP '2024-01-20 18:30:00'"
HOUR = 3_600_000_000
RB, RE = "TIMESTAMP '1997-01-01 00:00:00'", "TIMESTAMP '1997-06-01 00:00:00'"


@query("t1_locate_bin", EV + f"SELECT CAST(ceil((epoch_us({ES})-epoch_us({BS}))/{7 * HOUR}.0) AS BIGINT) - CAST(trunc((epoch_us({ES})-epoch_us(ts))/{7 * HOUR}.0) AS BIGINT) - 1 AS bin, count(*) AS n FROM ev GROUP BY 1")
def t1(spark, sf):
    ev = render.base_events(spark, sf)
    return ev.groupBy(tl.locate_bin(F.col("ts"), *period(), 7 * HOUR).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("t2_bounds", f"SELECT o_orderkey, epoch_us(b) AS bound_us FROM orders, unnest(generate_series(o_orderdate, o_orderdate + to_days(CAST(o_orderkey%5 AS INTEGER)), INTERVAL 36 HOUR)) u(b)")
def t2(spark, sf):
    o = render.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("b"))
    o = o.withColumn("e", F.expr("b + make_interval(0,0,0,o_orderkey % 5)"))
    return tl.bin_bounds(o, "b", "e", 36 * HOUR).select("o_orderkey", F.unix_micros("bound").alias("bound_us"))


ORD = f"""WITH o AS (SELECT o_orderkey, o_orderdate AS ab, o_orderdate + to_days(CAST(o_orderkey%300 AS INTEGER)) AS ae, {RB} AS rb, {RE} AS re FROM orders),
  c AS (SELECT *, ab>rb AND ab<re AND ae>rb AND ae<re AS fully, ab<re AND ab>rb AND ae>re AS head, ae>rb AND ab<re AND ab<rb AS tail,
    rb>ab AND rb<ae AND re>ab AND re<ae AS contains FROM o)
"""


def _orders(spark, sf):
    o = render.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ab"))
    o = o.withColumn("ae", F.expr("ab + make_interval(0,0,0,cast(o_orderkey % 300 as int))"))
    return o, (F.col("ab"), F.col("ae"), F.lit("1997-01-01").cast("timestamp"), F.lit("1997-06-01").cast("timestamp"))


@query("t3_in_range", ORD + "SELECT o_orderkey, fully, head, tail, contains, fully OR head OR tail OR contains AS in_range FROM c")
def t3(spark, sf):
    o, a = _orders(spark, sf)
    return o.select("o_orderkey", tl.fully_in_range(*a).alias("fully"), tl.head_in_range(*a).alias("head"), tl.tail_in_range(*a).alias("tail"),
                    tl.contains_range(*a).alias("contains"), tl.interval_in_range(*a).alias("in_range"))


@query("t4_parse_interval", EV + "SELECT event_id, CASE WHEN k%10<>9 AND k%4<>3 THEN CAST(k AS BIGINT)*1000000 END AS period_us, CASE WHEN k%10=9 THEN 'bad beginning' WHEN k%4=3 AND k>0 THEN 'end before beginning' END AS error FROM ev")
def t4(spark, sf):
    ev = render.base_events(spark, sf)
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    k = F.col("k")
    end = F.expr("date_trunc('second', ts) + make_interval(0,0,0,0,0,0,cast(if(k % 4 = 3, -k, k) as decimal(18,6)))")
    rows = ev.select("event_id", F.when(k % 10 == 9, "soon").otherwise(fmt(F.col("ts"))).alias("a"), fmt(end).alias("b"))
    p = tl.parse_interval(rows, "a", "b")
    return p.select("event_id", "period_us", F.col("_error").alias("error"))


@query("t5_partial", ORD + "SELECT CASE WHEN contains THEN 'middle' WHEN head THEN 'head' WHEN tail THEN 'tail' ELSE 'complete' END AS partial, count(*) AS n FROM c GROUP BY 1")
def t5(spark, sf):
    o, a = _orders(spark, sf)
    return o.groupBy(tl.classify_partial(*a).alias("partial")).agg(F.count(F.lit(1)).alias("n"))


SEEK = EV + f""", f AS (SELECT event_id//{N} AS path, min(ts) AS a, max(ts) AS b, count(*) AS lines,
      min(CASE WHEN k%25<>24 AND k%13<>0 AND ts>{BS} THEN event_id%{N} END) AS s, min(CASE WHEN k%25<>24 AND k%13<>0 AND ts>{ES} THEN event_id%{N} END) AS e FROM ev GROUP BY 1),
  p AS (SELECT *, CASE WHEN {BS}>a AND {BS}<b AND {ES}>a AND {ES}<b THEN 'middle' WHEN a<{ES} AND a>{BS} AND b>{ES} THEN 'head'
      WHEN b>{BS} AND a<{ES} AND a<{BS} THEN 'tail' ELSE 'complete' END AS partial FROM f)
"""


def _seek(spark, sf):
    timed = tl.timed_lines(render.time_lines(spark, sf))
    return timed, tl.seek(timed, render.file_table(spark, sf), *period())


@query("t6_seek", SEEK + "SELECT CAST(path AS VARCHAR) AS path, partial, CASE WHEN partial IN ('tail','middle') THEN coalesce(s, 0) ELSE 0 END AS beginning, CASE WHEN partial IN ('head','middle') THEN coalesce(e, lines) ELSE lines END AS end_no FROM p")
def t6(spark, sf):
    return _seek(spark, sf)[1].withColumnRenamed("end", "end_no")


@query("t6_seek_zones", SEEK + "SELECT CAST(path AS VARCHAR) AS path, partial, CASE WHEN partial IN ('tail','middle') THEN coalesce(s, 0) ELSE 0 END AS beginning, CASE WHEN partial IN ('head','middle') THEN coalesce(e, lines) ELSE lines END AS end_no FROM p")
def t6_zones(spark, sf):
    """The same from zones of fifty lines, of which at most two a file are read."""
    folder = render.scratch_path(spark, "zones")
    tl.write_zones(tl.timed_lines(render.time_lines(spark, sf)), folder, 50)
    return tl.seek_zones(folder, render.file_table(spark, sf), *period()).withColumnRenamed("end", "end_no")


GAPS = EV + f"""SELECT event_id, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE epoch_us(t) - epoch_us(lag(t) OVER w) END AS gap_us
    FROM (SELECT *, CASE WHEN k%13<>0 THEN ts END AS t FROM ev WHERE k%25<>24) WINDOW w AS (PARTITION BY event_id//{N} ORDER BY event_id)"""


@query("t7_gaps", GAPS)
def t7(spark, sf):
    # short ranges, so that many range edges are crossed
    return tl.replay_gaps(tl.timed_lines(render.time_lines(spark, sf)), range_lines=100).select("event_id", "gap_us")


@query("t8_file_gaps", EV + f", f AS (SELECT event_id//{N} AS path, min(ts) AS a, max(ts) AS b FROM ev GROUP BY 1) SELECT CAST(path AS VARCHAR) AS path, epoch_us(a) - epoch_us(lag(b) OVER (PARTITION BY path%2 ORDER BY a)) AS gap_us FROM f")
def t8(spark, sf):
    return tl.file_gaps(render.file_table(spark, sf)).select("path", "gap_us")


@query("t9_start_gap", EV + f", f AS (SELECT event_id//{N} AS path, min(ts) AS a FROM ev GROUP BY 1), g AS (SELECT path%2 AS dir, arg_min(path, a) AS path FROM f GROUP BY 1) SELECT CAST(dir AS VARCHAR) AS dir, CAST(path AS VARCHAR) AS path, CASE WHEN k%13<>0 THEN epoch_us(ts) - epoch_us({BS}) END AS gap_us FROM g JOIN ev ON event_id = path*{N} + 1 WHERE k%25<>24")
def t9(spark, sf):
    timed = tl.timed_lines(render.time_lines(spark, sf)).filter(F.col("_error").isNull())
    files = render.file_table(spark, sf).withColumn("beginning", F.lit(1)).withColumn("enabled", F.lit(True))
    return tl.start_gap(timed, files, period()[0]).select("dir", "path", "gap_us")
