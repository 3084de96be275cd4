"""Addresses, lookups, ranks and intervals against plain Python."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from logspark.functions.ip import address_halves, canon_ip, masked
from logspark.functions.joins import Lookup, as_lookup, attach
from logspark.functions.ranks import global_rank
from logspark.operators import timeline as tl


def expected_ip(text):
    if "%" in text:
        return None
    try:
        addr = ipaddress.ip_address(text)
    except ValueError:
        return None
    if addr.version == 6 and addr.ipv4_mapped:
        return str(addr.ipv4_mapped)
    return str(addr)


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def halves(n, version):
    return (signed(n >> 64), signed(n & (2**64 - 1))) if version == 6 else (0, n)


def test_canonical_addresses_and_masks(spark):
    rng = random.Random(7)
    cases = ["1.2.3.4", "01.2.3.4", "256.1.1.1", "::", "fe80::1%eth0", "::ffff:1.2.3.4", "1:2:3:4:5:6:7::", "1::2::3",
             ":::", "1:2:3", "1:0:0:2:0:0:0:3", "0:0:1:0:0:0:1:1", "1:2:3:4:5:6:1.2.3.4", "", "x", "12345::", "1:"]
    for _ in range(400):
        groups = [rng.choice(["0", "0", "0", "00", "1", "Ab", "ffff"]) for _ in range(8)]
        text = ":".join(groups)
        if rng.random() < 0.4:
            i = rng.randrange(8)
            text = ":".join(groups[:i]) + "::" + ":".join(groups[rng.randrange(i, 9):])
        cases.append(text)
    df = spark.createDataFrame([(c,) for c in cases], "t STRING").select("t", canon_ip(F.col("t")).alias("c"))
    df = df.withColumn("h", address_halves(F.col("c"))).withColumn("m", masked(F.col("h"), F.lit(20)))
    for row in df.collect():
        want = expected_ip(row.t)
        assert row.c == want, row.t
        if want:
            addr = ipaddress.ip_address(want)
            base = ipaddress.ip_network(f"{want}/20", strict=False).network_address
            assert (row.h.hi, row.h.lo) == halves(int(addr), addr.version)
            assert (row.m.hi, row.m.lo) == halves(int(base), addr.version)


def test_shuffled_lookup_equals_broadcast_on_a_hot_key(spark):
    # a third of the rows share one key, another third has none
    events = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3)], "key STRING, v INT")
    small = as_lookup(dim, "key")
    assert small.small and not as_lookup(dim, "key", max_bytes=1).small
    rows = [
        sorted((r.id, r.hit.v if r.hit else None) for r in attach(events, lk, F.col("k"), "hit", ["id"]).collect())
        for lk in (small, Lookup(dim, "key", False))
    ]
    assert rows[0] == rows[1] and len(rows[0]) == 3000


def test_shuffled_lookup_is_never_broadcast_by_an_estimate(spark):
    # a few rows, which Spark would broadcast by itself
    dim = spark.range(3).select(F.col("id").cast("string").alias("key"), "id")
    events = spark.range(10).select("id", F.col("id").cast("string").alias("k"))
    plan = attach(events, Lookup(dim, "key", False), F.col("k"), "hit", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("n"))
    ranked = global_rank(df, F.expr("n div 100"), [F.col("n")], "rank").orderBy("n").collect()
    assert [r["rank"] for r in ranked] == list(range(1000))


# Pairs of intervals and whether the second one overlaps the first.
INTERVALS = [
    ("2019-07-19 06:01:43", "2019-07-19 07:01:43", False),
    ("2019-07-19 07:01:43", "2019-07-19 08:01:43", True),
    ("2019-07-19 08:01:43", "2019-07-19 09:01:43", True),
    ("2019-07-19 09:01:43", "2019-07-19 10:01:43", True),
    ("2019-07-19 10:01:43", "2019-07-19 11:01:43", True),
    ("2019-07-19 11:01:43", "2019-07-19 12:01:43", False),
    ("2019-07-19 12:01:43", "2019-07-19 13:01:43", False),
    ("2019-07-19 07:30:53", "2019-07-19 10:15:10", False),
    ("2019-07-19 07:00:00", "2019-07-19 11:00:00", True),
]


def test_interval_table(spark):
    df = spark.createDataFrame(INTERVALS, "a STRING, b STRING, want BOOLEAN")
    ts = lambda x: x.cast("timestamp")
    got = df.select(
        "want",
        tl.interval_in_range(
            ts(F.col("a")), ts(F.col("b")), ts(F.lit("2019-07-19 07:30:53")), ts(F.lit("2019-07-19 10:15:10"))
        ).alias("got"),
    ).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_gaps_do_not_depend_on_the_range_size(spark):
    # one file holds nearly all lines; some have no time
    lines = spark.range(2000).select(
        F.when(F.col("id") < 1900, "big").otherwise("small").alias("path"), F.col("id").alias("offset"),
        F.when(F.col("id") % 11 != 0, F.timestamp_seconds(F.col("id") * F.col("id"))).alias("ts"),
    )
    results = [
        sorted((r.offset, r.gap_us) for r in tl.replay_gaps(lines, n).select("offset", "gap_us").collect()) for n in (7, 10_000)
    ]
    assert results[0] == results[1]


def test_a_file_of_one_row_group_is_rendered_by_many_tasks(spark):
    from logspark.plans import render

    assert spark.read.parquet("/root/testdata/sf0.1/events.parquet").rdd.getNumPartitions() == 1
    assert render.json_events(spark, "/root/testdata/sf0.1").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize(
    ("value", "text"),
    [('"x"', "x"), ('""', ""), ('"5"', "5"), (r'"\u0000é"', "\0é"), ('"2024-01-01"', "2024-01-01"), ("5", None), ("1.5", None), ("1e300", None),
     ("12345678901234567890123", None), ("true", None), ("null", None), ("[1]", None), ('["x"]', None), ('{"b":"c"}', None), ("{}", None)],
)
def test_only_a_json_string_is_text(spark, value, text):
    from logspark.functions.dynamic import dot_string, parse_object

    rows = spark.createDataFrame([(f'{{"a":{value}}}',)], "raw string").select(parse_object("raw").alias("v"))
    # a walk that meets the value on its way answers with it, unless it is strict
    found = rows.select(dot_string("v", "a").alias("a"), dot_string("v", "a.x").alias("b"), dot_string("v", "a.x", strict=True).alias("c")).first()
    assert tuple(found) == (text, text, None)
