"""Registries on a stream: partial rewrites, replays, sets, committed ranges and published versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from logspark.session import scratch_path
from logspark.streaming.allocate import ALIAS_STATE, INDICATOR_STATE, NEXT, assign_aliases, ranked_pool, register_indicators
from logspark.streaming.registry import Registry, first_wins, last_wins, retractable
from logspark.operators.timeline import seek, seek_zones, write_zones
from logspark.sinks.outputs import append_queue
from logspark.streaming.sinks import finished_batches, read_finished
from logspark.streaming.views import Views

STATE = "key string, v bigint"


def _rows(spark, *rows, schema=STATE):
    return spark.createDataFrame(list(rows), schema)


def _registry(spark, schema=STATE, **more):
    return Registry(spark, scratch_path(spark, "registry"), schema, **more)


def _all(registry):
    return sorted((tuple(r) for r in registry.read().collect()), key=repr)


def test_one_key_of_many_rewrites_one_bucket(spark):
    registry = _registry(spark)
    many = spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    registry.update(many, 0, first_wins)
    before = registry.manifest()
    registry.update(_rows(spark, ("new", 7)), 1, first_wins)
    after = registry.manifest()
    moved = [b for b in after.folders if after.folders[b] != before.folders[b]]
    assert len(before.folders) == registry.buckets and len(moved) == 1
    assert registry.read().count() == 200_001
    assert registry.touching(_rows(spark, ("new", 0))).count() < 200_001 // 32
    assert [tuple(r) for r in registry.difference(1).collect()] == [("new", 7)]


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, monkeypatch):
    registry = _registry(spark, buckets=4)
    registry.update(_rows(spark, ("a", 1), ("b", 1)), 0, last_wins("key", "v"))
    monkeypatch.setattr(Registry, "_commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        registry.update(_rows(spark, ("a", 2)), 1, last_wins("key", "v"))
    assert _all(registry) == [("a", 1), ("b", 1)]
    monkeypatch.undo()
    for _ in range(2):  # tried again, and replayed
        registry.update(_rows(spark, ("a", 2)), 1, last_wins("key", "v"))
        assert _all(registry) == [("a", 2), ("b", 1)] and registry.newest() == 2


def test_empty_batches_and_null_keys(spark):
    registry = _registry(spark)
    assert _all(registry) == [] and registry.newest() == 0
    registry.update(_rows(spark), 0, first_wins)
    assert _all(registry) == [] and registry.newest() == 0
    registry.update(_rows(spark, (None, 1)), 1, last_wins("key", "v"))
    registry.update(_rows(spark, (None, 3), ("a", None)), 2, last_wins("key", "v"))
    assert _all(registry) == [("a", None), (None, 3)]


def test_keys_enter_and_leave_a_set(spark):
    missing = _registry(spark, "host string")
    answers = "host string, present boolean"
    steps = [[("a", True), ("b", True), ("c", False)], [("a", False)], [("b", False), ("a", True)], [("a", True)]]
    want = [{"a", "b"}, {"b"}, {"a"}, {"a"}]
    for batch, (rows, left) in enumerate(zip(steps, want)):
        for _ in range(2):
            missing.update(_rows(spark, *rows, schema=answers), batch, retractable)
            assert {r["host"] for r in missing.read().collect()} == left
    missing.update(_rows(spark, ("a", False), schema=answers), 9, retractable)
    assert missing.read().count() == 0 and missing.manifest().folders == {}


def test_ids_have_no_gap_and_no_repeat_under_replays(spark):
    registry = _registry(spark, INDICATOR_STATE, buckets=4)
    new = "type string, value string, seq bigint, added timestamp"

    def batch(*rows):
        return spark.createDataFrame([(t, v, s, None) for t, v, s in rows], new)

    first = batch(("src_ip", "1", 5), ("src_ip", "2", 4), ("src_ip", "1", 3))
    second = batch(("src_ip", "2", 9), ("dest_ip", "1", 7), ("x", "0", 8), ("y", "0", 8))
    for number, rows in ((0, first), (0, first), (1, second), (1, second), (2, first)):
        register_indicators(registry, rows, number)
    found = {(r["type"], r["value"]): r["id"] for r in registry.read().collect()}
    assert found == {("src_ip", "1"): 0, ("src_ip", "2"): 1, ("dest_ip", "1"): 2, ("x", "0"): 3, ("y", "0"): 4}
    assert registry.manifest().meta == {NEXT: 5}


def test_aliases_are_unused_names_and_stay(spark):
    registry = _registry(spark, ALIAS_STATE, buckets=4)
    path = scratch_path(spark, "pool")
    ranked_pool(_rows(spark, *[(f"p{i}",) for i in range(6)], schema="name string")).write.parquet(path)
    pool = spark.read.parquet(path)
    order = [r["alias"] for r in pool.orderBy("place").collect()]
    seen = "name string, seen timestamp"
    named = lambda *names: spark.createDataFrame([(n, None) for n in names], seen)
    # a name that stands in the pool is never given to another
    for number, rows in enumerate([named("a", "b", None), named("b", order[2], "c"), named(order[0], "c")]):
        for _ in range(2):
            assign_aliases(registry, pool, rows, number)
    found = {r["name"]: r["rename"] for r in registry.read().collect()}
    # order[0] is an alias in use by then and stands for itself
    assert set(found) == {"a", "b", "c", order[2]} and {found["a"], found["b"]} == {order[0], order[1]}
    assert {found["c"], found[order[2]]} == {order[3], order[4]}
    with pytest.raises(Exception, match="used up"):
        assign_aliases(registry, pool, named("d", "e"), 3)
    assert registry.read().count() == 4


def test_views_are_published_together_and_only_when_they_change(spark):
    views = Views(spark, scratch_path(spark, "views"))
    seq = "struct<timestamp: timestamp, topic: string, partition: int, offset: bigint>"
    state = f"name string, list string, seq {seq}"
    row = lambda text, n: spark.createDataFrame([("k", text, (None, "t", 0, n))], state)
    assert views.published() == {} and views.read("missing").count() == 0
    views.parts["missing"].update(row('[{"sid":1,"msg":"a"}]', 1), 0, last_wins("name", "seq"))
    assert views.read("missing").count() == 0  # written, not published yet
    views.publish(0)
    assert [tuple(r) for r in views.read("missing").collect()] == [(1, "a")] and views.published() == {"missing": (1, 1)}
    # the same list again, later: a new version of the registry, nothing to publish
    views.parts["missing"].update(row('[{"sid":1,"msg":"a"}]', 2), 1, last_wins("name", "seq"))
    views.publish(1)
    assert views.published() == {"missing": (1, 1)}


def test_a_half_written_batch_is_not_read_until_it_is_done(spark):
    path = scratch_path(spark, "queue")
    assert finished_batches(spark, path) == []
    rows = spark.createDataFrame([("a",), ("b",)], "value string")
    for batch in (10, 9):
        append_queue(rows, path, batch)
    hadoop = spark._jvm.org.apache.hadoop.fs
    mark = hadoop.Path(f"{path}/batch=10/_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)  # as if the job had died before its end
    assert [f.rsplit("=", 1)[1] for f in finished_batches(spark, path)] == ["9"]
    assert read_finished(spark, path, "parquet", "value string").count() == 2
    append_queue(rows, path, 10)
    assert [f.rsplit("=", 1)[1] for f in finished_batches(spark, path)] == ["9", "10"]


def test_seek_reads_few_zones(spark):
    lines = spark.range(20_000).select(
        F.concat(F.lit("f"), F.expr("id div 5000")).alias("path"), (F.col("id") % 5000).alias("offset"), F.timestamp_seconds("id").alias("ts")
    )
    folder = scratch_path(spark, "zones")
    write_zones(lines, folder, 100)
    files = lines.groupBy("path").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("lines"))
    begin, end = (F.timestamp_seconds(F.lit(n)) for n in (6_250, 12_777))
    found = seek_zones(folder, files, begin, end)
    assert sorted(found.collect()) == sorted(seek(lines, files, begin, end).collect())
    nodes = [found._jdf.queryExecution().executedPlan()]
    read = 0
    while nodes:
        node = nodes.pop()
        children = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        nodes += children or [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().startswith("Scan parquet") and "offset" in node.toString():
            read += node.metrics().apply("numOutputRows").value()
    # four files of fifty zones: one or two zones of each
    assert 0 < read <= 800


def test_a_part_of_a_stream_is_written_by_all_its_tasks(spark):
    from logspark.plans.q_streams import _in_batches
    from logspark.streaming.jobs import run_batches

    n = F.col("id")
    rows = spark.range(0, 40, 1, 4).select(
        n.cast("string").alias("value"), F.lit("k").alias("key"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        n.alias("offset"), F.timestamp_seconds(n).alias("timestamp"),
    )
    seen, checkpoint = [], scratch_path(spark, "checkpoint")

    def each(batch, batch_id):
        seen.append((batch_id, batch.count(), batch.select(F.spark_partition_id()).distinct().count() > 1))

    _in_batches(spark, [rows, rows, rows], lambda s: run_batches(s, each, checkpoint, once=True), checkpoint)
    # the second batch runs again, each part is one batch, read by several tasks
    assert seen == [(0, 40, True), (1, 40, True), (1, 40, True), (2, 40, True)]


def test_zones_of_many_files_lie_in_few_folders(spark, tmp_path, monkeypatch):
    import os

    from logspark.operators import timeline

    monkeypatch.setattr(timeline, "ZONE_SLOTS", 16)
    lines = spark.range(2000).select(
        F.concat(F.lit("f"), F.expr("id div 10")).alias("path"), (F.col("id") % 10).alias("offset"), F.timestamp_seconds("id").alias("ts")
    )
    folder = str(tmp_path / "zones")
    write_zones(lines, folder, 5)
    assert sum(n.startswith(("zone=", "slot=")) for n in os.listdir(f"{folder}/lines")) <= 16  # of four hundred zones
    files = lines.groupBy("path").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("lines"))
    begin, end = (F.timestamp_seconds(F.lit(n)) for n in (153, 1_457))
    assert sorted(seek_zones(folder, files, begin, end).collect()) == sorted(seek(lines, files, begin, end).collect())


def test_a_batch_ranks_only_the_places_that_it_may_need(spark, monkeypatch):
    from logspark.streaming import allocate

    path = scratch_path(spark, "pool")
    # names of the first batch are aliases of the pool, so their places are passed over
    ranked_pool(spark.range(5000).select(F.concat(F.lit("a"), "id").alias("name"))).write.parquet(path)
    pool = spark.read.parquet(path)
    ranked, sizes = allocate.global_rank, []

    def counted(df, bucket, order, out):
        sizes.append(df.count())
        return ranked(df, bucket, order, out)

    monkeypatch.setattr(allocate, "global_rank", counted)
    registry = _registry(spark, ALIAS_STATE)
    first = pool.filter("place < 40").select(F.col("alias").alias("name"), F.timestamp_seconds("place").alias("seen"))
    new = spark.range(30).select(F.concat(F.lit("n"), "id").alias("name"), F.timestamp_seconds("id").alias("seen"))
    assign_aliases(registry, pool, first, 0)
    assign_aliases(registry, pool, new, 1)
    assert max(sizes) <= 120
    assert sorted(r["place"] for r in registry.read().collect()) == list(range(40, 110))


def test_batches_of_events_are_enriched_by_all_tasks(spark, monkeypatch):
    from logspark.plans import q_streams

    tasks, start = [], q_streams.start_enrich

    def watched(stream, registry, assets, topics, techniques, sink, checkpoint, once):
        def each(enriched, batch_id):
            tasks.append(enriched.select(F.spark_partition_id()).distinct().count())
            sink(enriched, batch_id)

        return start(stream, registry, assets, topics, techniques, each, checkpoint, once=once)

    monkeypatch.setattr(q_streams, "start_enrich", watched)
    rows = q_streams.stream_enrich(spark, "/root/testdata/sf0.001")
    # one batch of assets, which holds no events, and two of events
    assert tasks == [0, 4, 4] and rows.count() == rows.select("event_id").distinct().count() == 1000
