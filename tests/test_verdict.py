"""Orders, replays and sizes that the registered queries do not show."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from logspark.functions.ip import canon_ip
from logspark.operators.decode import decode
from logspark.operators.inventory import asset_index, latest_by
from logspark.operators.rules import Rule, match_rules
from logspark.session import scratch_path
from logspark.sinks.outputs import BULK_ACTIONS, append_queue, bulks, write_index
from logspark.streaming.registry import KEPT, Registry, first_wins


def test_ties_do_not_depend_on_the_row_order(spark):
    rows = [("k", 1, "b"), ("k", 1, "c"), ("k", 1, "a"), ("l", 2, None)]
    want = None
    for turn in (rows, rows[::-1], rows[1:] + rows[:1]):
        frame = spark.createDataFrame(turn, "key string, updated int, v string").repartition(3)
        got = sorted(tuple(r) for r in latest_by(frame, "key", "updated").collect())
        want = want or got
        assert got == want == [("k", 1, "c"), ("l", 2, None)]


def test_arrival_decides_between_equal_times(spark):
    rows = [("k", 1, "z", 0), ("k", 1, "a", 1)]
    frame = spark.createDataFrame(rows, "key string, updated int, v string, arrival int")
    assert latest_by(frame, "key", "updated").first()["v"] == "a"


def test_a_line_break_is_no_part_of_an_address(spark):
    rows = spark.createDataFrame([("10.0.0.1\n",), ("::1\n",), ("10.0.0.1",)], "a string")
    assert [r[0] for r in rows.select(canon_ip(F.col("a"))).collect()] == [None, None, "10.0.0.1"]


RECORDS = "host_name string, ansible_name string, pretty string, addr string, domain string, fqdn string, seq bigint"


def _records(spark, *names):
    rows = [(n, None, None, f"10.0.0.{i}", "", None, i) for i, n in enumerate(names)]
    return asset_index(spark.createDataFrame(rows, RECORDS)).select("key", "host_name", "seq")


def test_registry_goes_on_above_older_runs_and_keeps_a_few_versions(spark):
    path = scratch_path(spark, "registry")
    registry = Registry(spark, path, "key string, host_name string, seq bigint")
    context = spark.sparkContext
    try:
        for run in ("one", "two"):  # a new checkpoint starts at batch 0 again
            context.setLocalProperty("sql.streaming.queryId", run)
            for batch in range(3):
                registry.update(_records(spark, f"{run}-{batch}"), batch, first_wins)
            before = registry.read().count()
            registry.update(_records(spark, f"{run}-2"), 2, first_wins)  # a replay
            assert registry.read().count() == before
            registry.update(_records(spark).limit(0), 3, first_wins)
        hosts = {r["host_name"] for r in registry.read().collect()}
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)
    assert {f"{run}-{batch}" for run in ("one", "two") for batch in range(3)} <= hosts
    assert len([v for v in registry._versions() if v[3]]) == KEPT


def test_a_replayed_batch_replaces_its_lines(spark):
    path = scratch_path(spark, "queue")
    rows = spark.createDataFrame([("a",), ("b",)], "value string")
    for batch in (0, 1, 1):
        append_queue(rows, path, batch)
    assert spark.read.parquet(path).count() == 4


def test_bulk_writer_sends_every_row_within_the_limits(spark):
    path = scratch_path(spark, "bulk")
    spark.range(2500).select(F.lit("i").alias("index"), F.col("id").cast("string").alias("value")).coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path)
    total, largest = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def send(batch):
        total.add(len(batch))
        largest.add(int(len(batch) > BULK_ACTIONS))

    write_index(rows, send)
    assert total.value == 2500 and largest.value == 0
    assert [len(b) for b in bulks(range(5), lambda _: 1 << 20)] == [2, 2, 1]


def test_thousands_of_rules_are_planned_fast_and_all_tried(spark):
    events = spark.createDataFrame(
        [("suricata", '{"event_type":"alert","alert":{"category":"c2999"}}'), ("suricata", '{"alert":{"category":"none"}}')],
        "kind string, value string",
    )
    rules = [Rule(f"r{i:04d}", "t", "suricata", ("attack.t1",), f"{{alert.category}} = 'c{i}'") for i in range(3000)]
    decoded = decode(events)
    start = time.perf_counter()
    matched = match_rules(decoded, rules)
    planned = time.perf_counter() - start
    found = [[x["rule_id"] for x in r["sigma_results"] or ()] for r in matched.collect()]
    assert found == [["r2999"], []]
    assert planned < 3


def test_line_numbers_where_splits_are_not_fixed(spark, tmp_path, monkeypatch):
    """The lines are then written once; numbers are the same and the session's settings stay."""
    from logspark.sources import logfiles

    for name in ("a", "b"):
        (tmp_path / f"{name}.log").write_text("".join(f"{name}{i}\n" for i in range(500)))
    before = dict(spark.conf.getAll)
    rows = lambda: sorted(map(tuple, logfiles.read_logs(spark, str(tmp_path)).select("value", "path", "offset").collect()))
    expected = rows()
    monkeypatch.setattr(logfiles, "splits_are_fixed", lambda _: False)
    assert rows() == expected and len(expected) == 1000
    assert all(value[1:] == str(offset) for value, _, offset in expected)
    after = dict(spark.conf.getAll)
    assert {k: v for k, v in after.items() if k.startswith("spark.sql")} == {k: v for k, v in before.items() if k.startswith("spark.sql")}


def test_merged_view_equals_that_over_the_history(spark, tmp_path):
    from logspark.operators import views

    facts = spark.createDataFrame(
        [("m1", [3, 1], "2024-01-01"), ("m2", [3, 2], "2024-01-02"), ("m1", [3, 9], "2024-02-01"), (None, [1], "2024-01-01")],
        "fqdn string, pythonversion array<bigint>, updated string",
    ).withColumn("updated", F.col("updated").cast("timestamp"))
    first, second = facts.filter("fqdn = 'm2'"), facts.filter("fqdn IS NULL OR fqdn = 'm1'")
    paths = [str(tmp_path / n) for n in ("history", "one", "two", "whole")]
    views.dual_write(first, paths[0], paths[1])
    views.dual_write(second, paths[0], paths[2], previous=spark.read.parquet(paths[1]))
    views.dual_write(facts.limit(0), paths[0], paths[3])
    got, whole = (sorted(map(tuple, spark.read.parquet(p).select("fqdn", "pythonversion").collect())) for p in paths[2:])
    assert got == whole == [("m1", "3.9"), ("m2", "3.2")]
