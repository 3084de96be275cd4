"""Streaming queries: the same operators fed batch by batch, compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from logspark.operators.enrich import technique_lookup
from logspark.operators.inventory import asset_index
from logspark.sinks.outputs import MISSING_SIDS_KEY, append_queue, archive, write_files
from logspark.operators.indicators import validate_iocs
from logspark.operators.normalize import preprocess
from logspark.plans import render
from logspark.plans.catalog import EV, EVE_ALERT, RECORDS, query
from logspark.plans.q_enrich import J, LABEL
from logspark.plans.q_views import I
from logspark.plans.render import text
from logspark.schemas import ENVELOPE, RECORD_COLUMNS
from logspark.sources.topics import parse_topic_map, read_events, with_kind
from logspark.streaming.allocate import ALIAS_STATE, INDICATOR_STATE, assign_aliases, ranked_pool, register_indicators
from logspark.streaming.jobs import (
    INDEX_SCHEMA,
    MISSING_HOSTS,
    MISSING_SIDS,
    SID_MAP_STATE,
    run_batches,
    start_enrich,
    start_parse,
    start_sid_map,
)
from logspark.streaming.registry import Registry, first_wins
from logspark.streaming.sinks import FACT_STATE, read_finished, start_sinks, write_facts
from logspark.streaming.views import Views, start_views

COLUMNS = [part.split()[0] for part in ENVELOPE.split(", ")]


def _write_halves(rows, path):
    """Add rows to a folder in files for two micro-batches; the options to read them by.

    Each half is as many files as there are tasks, as a file of one row group is one task, however many rows it has.
    """
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    rows.select(*COLUMNS).repartition(2 * tasks, "offset").write.mode("append").parquet(path)
    return {"maxFilesPerTrigger": str(tasks)}


def _asset_messages(spark, sf):
    r = render.records(spark, sf)
    body = F.to_json(F.struct(*[c for c in RECORD_COLUMNS if c != "updated"]))
    return r.select(
        body.alias("value"), F.col("addr").alias("key"), F.lit("assets").alias("topic"), F.lit(0).alias("partition"),
        F.col("seq").alias("offset"), F.col("updated").alias("timestamp"),
    )


@query("stream_enrich", J + f"SELECT event_id, coalesce(hit_host, host) AS host, {LABEL} AS direction FROM res")
def stream_enrich(spark, sf):
    """Assets arrive in the first micro-batch, events in the two after it."""
    source = render.scratch_path(spark, "in")
    _asset_messages(spark, sf).select(*COLUMNS).write.parquet(source)
    work, target = render.scratch_path(spark, "work"), render.scratch_path(spark, "out")

    def sink(enriched, batch_id):
        g = F.col("GameMeta")
        rows = enriched.select(F.col("offset").alias("event_id"), g["Host"].alias("host"), g["DirectionString"].alias("direction"))
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    def run(options=None):
        stream = read_events(spark, source, "earliest", options=options)
        registry = Registry(spark, f"{work}/registry", INDEX_SCHEMA)
        topics = parse_topic_map(render.TOPIC_MAP)
        tech = technique_lookup(render.techniques(spark, sf))
        start_enrich(stream, registry, "assets", topics, tech, sink, f"{work}/checkpoint", once=True).awaitTermination()

    run()
    run(_write_halves(render.json_events(spark, sf), source))
    return spark.read.parquet(target).select("event_id", "host", "direction")


@query("stream_registry", "WITH " + RECORDS + "SELECT key, host_name, addr, team FROM idx")
def stream_registry(spark, sf):
    """First-wins registry over several micro-batches of records."""
    source, work = render.scratch_path(spark, "in"), render.scratch_path(spark, "work")
    registry = Registry(spark, f"{work}/registry", INDEX_SCHEMA)
    rows = render.records(spark, sf)
    late = F.col("seq") >= 1_000_000_000

    def each(batch, batch_id):
        registry.update(asset_index(batch), batch_id, first_wins)

    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        run_batches(stream, each, f"{work}/checkpoint", once=True).awaitTermination()
    return registry.read().select("key", "host_name", "addr", "team")


@query("stream_preprocess", EV + """SELECT kind, count(*) AS n FROM ev WHERE kind='windows' OR (kind<>'sysmon' AND k%10<>9 AND (kind<>'syslog' OR k%20 NOT IN (3,13))) GROUP BY 1""")
def stream_preprocess(spark, sf):
    source, work = render.scratch_path(spark, "in"), render.scratch_path(spark, "work")
    options = _write_halves(render.raw_lines(spark, sf), source)
    topics = parse_topic_map(render.TOPIC_MAP)
    job = lambda df: preprocess(with_kind(df, topics).drop("_error"))
    stream = read_events(spark, source, "earliest", options=options)
    start_parse(stream, job, f"{work}/out", f"{work}/checkpoint", once=True).awaitTermination()
    done = spark.read.parquet(f"{work}/out")
    return done.filter(F.col("_error").isNull()).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _in_batches(spark, parts, start, checkpoint):
    """Feed each part as a micro-batch of its own to ``start(stream)``, which drains what is there.

    A part is as many files as it has tasks; without a limit on files all that is there makes one batch.
    The commit of the second batch is lost, as in a crash just before it: the next start runs this batch again.
    """
    source = render.scratch_path(spark, "in")
    for i, part in enumerate(parts):
        part.select(*COLUMNS).write.mode("append").parquet(source)
        start(read_events(spark, source, "earliest")).awaitTermination()
        if i == 1:
            commit = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/1")
            files = commit.getFileSystem(spark._jsc.hadoopConfiguration())
            if not files.delete(commit, False):
                raise RuntimeError("the second batch has no commit")


# Half of the inventory is known from the first batch on, the rest from the third.
MISSING_SQL = f"""{EV}, {RECORDS},
  keys AS (SELECT DISTINCT key, CASE WHEN s%2=0 THEN 0 ELSE 2 END AS since FROM keyed),
  known AS (SELECT key, min(since) AS since FROM keys GROUP BY 1),
  asked AS (
    SELECT host, event_id%3 AS b, CASE WHEN kind='syslog' AND k%4=0 THEN uip END AS ip FROM ev),
  looked AS (
    SELECT DISTINCT a.host, a.b, h.key IS NULL AS missed FROM asked a
    LEFT JOIN known i ON i.key=a.ip AND i.since<=a.b LEFT JOIN known h ON h.key=a.host AND h.since<=a.b WHERE i.key IS NULL)
"""


@query("stream_missing_hosts", MISSING_SQL + "SELECT host FROM looked QUALIFY row_number() OVER (PARTITION BY host ORDER BY b DESC)=1 AND missed")
def stream_missing_hosts(spark, sf):
    """Hosts enter the set when they are missed and leave it when a later batch finds them; the second batch runs twice."""
    work = render.scratch_path(spark, "work")
    registry, missing = Registry(spark, f"{work}/registry", INDEX_SCHEMA), Registry(spark, f"{work}/missing", MISSING_HOSTS)
    topics, tech = parse_topic_map(render.TOPIC_MAP), technique_lookup(render.techniques(spark, sf))
    assets, events = _asset_messages(spark, sf), render.json_events(spark, sf)
    odd = F.get_json_object("value", "$.role").isNotNull() & (F.regexp_extract(F.get_json_object("value", "$.host_name"), r"(\d+)$", 1).cast("bigint") % 2 == 1)
    early, late, none = assets.filter(~odd), assets.filter(odd), assets.filter(F.lit(False))
    parts = [
        a.select(*COLUMNS).unionByName(events.filter(F.col("offset") % 3 == i).select(*COLUMNS)) for i, a in enumerate((early, none, late))
    ]

    def start(stream):
        def sink(enriched, batch_id):
            enriched.write.format("noop").mode("overwrite").save()

        return start_enrich(stream, registry, "assets", topics, tech, sink, f"{work}/checkpoint", once=True, missing=missing)

    _in_batches(spark, parts, start, f"{work}/checkpoint")
    return missing.read()


SID_SQL = EV + f""", maps AS (SELECT DISTINCT 2000+p_partkey%1000 AS sid, CASE WHEN p_partkey%1000%3=1 THEN 0 ELSE 2 END AS since FROM part WHERE p_partkey%1000%3<>0),
  asked AS (SELECT DISTINCT 2000+k AS sid, 'SIG '||k AS msg, event_id%3 AS b FROM ev WHERE {EVE_ALERT})
"""


@query("stream_missing_sids", SID_SQL + "SELECT DISTINCT sid, msg FROM asked WHERE sid NOT IN (SELECT sid FROM maps)")
def stream_missing_sids(spark, sf):
    """Ids that alerts carry and no mapping answers to: one mapped later leaves the set."""
    work = render.scratch_path(spark, "work")
    mappings, missing = Registry(spark, f"{work}/maps", SID_MAP_STATE), Registry(spark, f"{work}/missing", MISSING_SIDS)
    rows = render.sid_map_rows(spark, sf).withColumn("place", F.col("sid").cast("bigint")).withColumn("sid", F.col("sid") % 1000)
    body = F.to_json(F.struct((F.col("sid") + 2000).alias("sid"), "tactic", "id", "name", "msg"))
    messages = rows.select(
        body.alias("value"), text(F.col("sid")).alias("key"), F.lit("maps").alias("topic"), F.lit(0).alias("partition"),
        F.col("place").alias("offset"), F.timestamp_seconds("place").alias("timestamp"), "sid",
    )
    alerts = render.json_events(spark, sf).filter("kind = 'suricata'")
    groups = [F.col("sid") % 3 == 1, F.lit(False), F.col("sid") % 3 == 2]
    parts = [
        messages.filter(c).select(*COLUMNS).unionByName(alerts.filter(F.col("offset") % 3 == i).select(*COLUMNS))
        for i, c in enumerate(groups)
    ]
    _in_batches(spark, parts, lambda s: start_sid_map(s, mappings, missing, "maps", f"{work}/checkpoint", once=True), f"{work}/checkpoint")
    return missing.read()


VIEWS_SQL = I + f""", {RECORDS},
  held AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY addr ORDER BY updated DESC, seq DESC)=1),
  maps AS (SELECT CAST(p_partkey%700 AS BIGINT) AS sid, p_name AS name FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey%700 ORDER BY p_partkey DESC)=1),
  taken AS (SELECT type, value, min(seq) AS seq, min(seq%3) AS b FROM val WHERE error IS NULL GROUP BY 1, 2),
  placed AS (SELECT type, value, b, min(v.seq) AS seq FROM taken JOIN val v USING (type, value) WHERE v.seq%3=b AND error IS NULL GROUP BY 1, 2, 3)
SELECT 'asset' AS kind, addr AS key, host_name||' '||team AS value FROM held
UNION ALL SELECT 'mapping', CAST(sid AS VARCHAR), name FROM maps
UNION ALL SELECT 'missing', CAST(p_partkey AS VARCHAR), p_name FROM part WHERE p_partkey%50=2
UNION ALL SELECT 'indicator', CAST(row_number() OVER (ORDER BY b, seq) - 1 AS VARCHAR), type||' '||value FROM placed
"""


@query("stream_views", VIEWS_SQL)
def stream_views(spark, sf):
    """All views from one stream in three batches, as last published."""
    work = render.scratch_path(spark, "work")
    views = Views(spark, work)
    stamp = F.timestamp_seconds("offset").alias("timestamp")
    envelope = lambda value, key, topic, offset: [
        value.alias("value"), key.alias("key"), F.lit(topic).alias("topic"), F.lit(0).alias("partition"), offset.alias("offset")]
    assets = _asset_messages(spark, sf)
    maps = render.sid_map_rows(spark, sf).withColumn("place", F.col("sid").cast("bigint"))
    body = F.to_json(F.struct((F.col("sid") % 700).alias("sid"), "tactic", "id", "name", "msg"))
    mapped = maps.select(*envelope(body, text(F.col("sid")), "maps", F.col("place"))).select("*", stamp)
    asked = render.indicator_rows(spark, sf)
    asked = asked.select(*envelope(F.to_json(F.struct("type", "value")), F.lit(""), "asked", F.col("seq"))).select("*", stamp)
    parts = []
    for i in range(3):
        listed = maps.filter(F.col("sid") % 50 == i).agg(F.to_json(F.collect_list(F.struct("sid", F.col("name").alias("msg")))).alias("value"))
        listed = listed.select(*envelope(F.col("value"), F.lit(MISSING_SIDS_KEY), "oracle", F.lit(i).cast("bigint"))).select("*", stamp)
        turn = lambda df: df.filter(F.col("offset") % 3 == i).select(*COLUMNS)  # noqa: E731, B023
        parts.append(turn(assets).unionByName(turn(mapped)).unionByName(turn(asked)).unionByName(listed.select(*COLUMNS)))
    start = lambda s: start_views(s, views, "assets", "maps", "oracle", "asked", f"{work}/checkpoint", once=True)
    _in_batches(spark, parts, start, f"{work}/checkpoint")
    shown = [
        ("asset", views.read("assets"), F.col("addr"), F.concat_ws(" ", "host_name", "team")),
        ("mapping", views.read("sid_map"), text(F.col("sid")), F.col("name")),
        ("missing", views.read("missing"), text(F.col("sid")), F.col("msg")),
        ("indicator", views.read("indicators"), text(F.col("id")), F.concat_ws(" ", "type", "value")),
    ]
    out = [df.select(F.lit(kind).alias("kind"), key.alias("key"), value.alias("value")) for kind, df, key, value in shown]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("stream_indicator_ids", VIEWS_SQL.split("SELECT 'asset'")[0] + "SELECT type, value, CAST(row_number() OVER (ORDER BY b, seq) - 1 AS BIGINT) AS id FROM placed")
def stream_indicator_ids(spark, sf):
    """Ids by committed ranges over three batches; each batch is applied twice, as after a crash before its commit."""
    registry = Registry(spark, render.scratch_path(spark, "indicators"), INDICATOR_STATE)
    rows = validate_iocs(render.indicator_rows(spark, sf)).filter("_error IS NULL").withColumn("added", F.timestamp_seconds("seq"))
    for batch in (0, 1, 1, 2, 2):
        register_indicators(registry, rows.filter(F.col("seq") % 3 == batch), batch)
    return registry.read().select("type", "value", "id")


@query("stream_aliases", """SELECT count(*) AS names, count(*) AS aliases, 0::BIGINT AS outside, 0::BIGINT AS moved, max(s_suppkey) AS last FROM supplier""")
def stream_aliases(spark, sf):
    """Aliases over three batches, each applied twice: one alias a name, none used twice, none changed later."""
    work = render.scratch_path(spark, "aliases")
    registry = Registry(spark, f"{work}/names", ALIAS_STATE)
    ranked_pool(render.table(spark, sf, "part").select(F.concat(F.lit("pool-"), text(F.col("p_partkey"))).alias("name"))).write.parquet(f"{work}/pool")
    pool = spark.read.parquet(f"{work}/pool")
    s = F.col("s_suppkey")
    names = render.table(spark, sf, "supplier").select(F.concat(F.lit("name-"), text(s)).alias("name"), F.timestamp_seconds(s).alias("seen"), s.alias("s"))
    halves = [F.col("s") % 2 == 0, F.col("s") % 3 == 0, F.lit(True)]
    first = None
    for batch, which in enumerate(halves):
        for _ in range(2):
            assign_aliases(registry, pool, names.filter(which), batch)
        if first is None:
            registry.read().select("name", F.col("rename").alias("old")).write.parquet(f"{work}/first")
            first = spark.read.parquet(f"{work}/first")
    found = registry.read().join(first, "name", "left")
    outside = registry.read().join(pool, F.col("rename") == F.col("alias"), "left_anti").agg(F.count(F.lit(1))).scalar()
    return found.agg(
        F.count(F.lit(1)).alias("names"), F.countDistinct("rename").alias("aliases"),
        F.count_if(F.col("old") != F.col("rename")).alias("moved"), F.max(F.unix_seconds("last_seen")).alias("last"),
    ).select("names", "aliases", outside.alias("outside"), "moved", "last")


@query("stream_sinks", EV + """SELECT 'archive' AS part, 'raw-'||kind AS name, event_id FROM ev UNION ALL SELECT 'all', '', event_id FROM ev
    UNION ALL SELECT 'kind', kind, event_id FROM ev UNION ALL SELECT 'queue', '', event_id FROM ev WHERE kind='sysmon'""")
def stream_sinks(spark, sf):
    """One stream into an archive, files per kind and a queue; each event is in each of them once."""
    work = render.scratch_path(spark, "sinks")
    events = render.json_events(spark, sf).withColumn("value", text(F.col("offset")))
    writes = [
        lambda rows, n: archive(rows, f"{work}/archive", now=F.timestamp_seconds(F.lit(1704153600)), batch_id=n),
        lambda rows, n: write_files(_with_kind(rows), f"{work}/all", f"{work}/kinds", batch_id=n),
        lambda rows, n: append_queue(_with_kind(rows).filter("kind = 'sysmon'"), f"{work}/queue", n),
    ]
    parts = [events.filter(F.col("offset") % 3 == i) for i in range(3)]
    _in_batches(spark, parts, lambda s: start_sinks(s, writes, f"{work}/checkpoint", once=True), f"{work}/checkpoint")
    shown = [
        ("archive", "source", read_finished(spark, f"{work}/archive", "text", "value STRING, source STRING, bucket STRING")),
        ("all", None, read_finished(spark, f"{work}/all", "text", "value STRING")),
        ("kind", "kind", read_finished(spark, f"{work}/kinds", "text", "value STRING, kind STRING")),
        ("queue", None, read_finished(spark, f"{work}/queue", "parquet", "value STRING")),
    ]
    out = None
    for part, name, rows in shown:
        own = rows.select(F.lit(part).alias("part"), (F.col(name) if name else F.lit("")).alias("name"), F.col("value").cast("bigint").alias("event_id"))
        out = own if out is None else out.unionByName(own)
    return out


def _with_kind(rows):
    return rows.withColumn("kind", F.substr("topic", F.lit(5)))


@query("stream_facts", """WITH f AS (SELECT 'm'||(c_custkey%200) AS fqdn, '3.'||(c_custkey%12)||'.1' AS version, c_custkey AS seen FROM customer WHERE c_custkey%9<>0)
    SELECT 'history' AS kind, fqdn, version, CAST(seen AS BIGINT) AS seen FROM f UNION ALL SELECT 'latest', fqdn, version, CAST(seen AS BIGINT) FROM f QUALIFY row_number() OVER (PARTITION BY fqdn ORDER BY seen DESC)=1""")
def stream_facts(spark, sf):
    """Machine facts into the history and the latest view by batches, the second one twice."""
    work = render.scratch_path(spark, "facts")
    latest = Registry(spark, f"{work}/latest", FACT_STATE)
    c = F.col("c_custkey")
    version = F.when(c % 9 != 0, F.array(F.lit(3).cast("bigint"), c % 12, F.lit(1).cast("bigint")))
    facts = render.table(spark, sf, "customer").select(
        F.concat(F.lit("m"), text(c % 200)).alias("fqdn"), version.alias("pythonversion"), F.timestamp_seconds(c).alias("updated"), c.alias("n"))
    write = write_facts(f"{work}/history", latest)
    for batch in (0, 1, 1, 2):
        write(facts.filter(F.col("n") % 3 == batch).drop("n"), batch)
    history = read_finished(spark, f"{work}/history", "parquet", "fqdn STRING, pythonversion STRING, updated TIMESTAMP, year INT")
    shape = lambda df, kind: df.select(
        F.lit(kind).alias("kind"), "fqdn", F.col("pythonversion").alias("version"), F.unix_seconds("updated").alias("seen"))
    return shape(history, "history").unionByName(shape(latest.read(), "latest"))
