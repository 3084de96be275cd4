"""Segments found by halving a list of intervals, against a test of every segment."""

from __future__ import annotations

import ipaddress
import random

from pyspark.sql import functions as F

from logspark.operators.networks import network_segments, tag_network

NAMES = "id int, name string, vlan string, ipv4 string, ipv6 string"


def _networks(rng):
    rows = [(0, "all", "v", "0.0.0.0/0", "::/0"), (1, "one", "v", "255.255.255.255/32", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff/128")]
    for i in range(2, 60):
        four, six = rng.randrange(8, 31), rng.randrange(16, 128)
        a = ipaddress.ip_network((rng.choice([10 << 24, 11 << 24]) + rng.randrange(1 << 12), four), strict=False)
        b = ipaddress.ip_network(((0xFD << 120) + rng.randrange(1 << 20), six), strict=False)
        rows.append((i, f"n{i}", f"v{i % 5}", str(a), str(b) if i % 3 else None))
    return rows + [(60, "again", "w", rows[5][3], rows[5][4])]


def test_halving_equals_a_test_of_every_segment(spark):
    rng = random.Random(6)
    networks = _networks(rng)
    segments = network_segments(spark.createDataFrame(networks, NAMES))
    four = [str(ipaddress.ip_address(rng.choice([10 << 24, 11 << 24]) + rng.randrange(1 << 13))) for _ in range(150)]
    six = [str(ipaddress.ip_address((0xFD << 120) + rng.randrange(1 << 21))) for _ in range(150)]
    asked = four + six + ["255.255.255.255", "0.0.0.0", "::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "no", "", None, four[0]]
    df = spark.createDataFrame(list(enumerate(asked)), "n int, ip string").repartition(3)
    nets = [(i, ipaddress.ip_network(c)) for i, _, _, *both in networks for c in both if c]
    want = set()
    for n, a in enumerate(asked):
        try:
            address = ipaddress.ip_address(a or "")
        except ValueError:
            continue
        want |= {(n, i) for i, net in nets if net.version == address.version and address in net}
    for limit in (1000, 10):  # the second is the join
        found = tag_network(df, segments, max_segments=limit).select("n", "network_id").collect()
        assert {tuple(r) for r in found} == want and len(found) == len(want)
        best = {r["n"]: (r["prefix"], r["network_id"]) for r in tag_network(df, segments, longest=True, max_segments=limit).collect()}
        size = {(i, net.version): net.prefixlen for i, net in nets}
        version = {n: ipaddress.ip_address(asked[n]).version for n, _ in want}
        assert best == {n: max(((size[i, version[n]], i) for m, i in want if m == n), key=lambda x: (x[0], -x[1])) for n in version}


def test_no_exchange_of_events(spark):
    segments = network_segments(spark.createDataFrame(_networks(random.Random(1)), NAMES))
    df = spark.range(100).select(F.concat(F.lit("10.0.0."), "id").alias("ip"))
    for longest in (False, True):
        plan = tag_network(df, segments, longest=longest)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_empty_tables(spark):
    segments = network_segments(spark.createDataFrame(_networks(random.Random(1)), NAMES))
    some = spark.createDataFrame([("10.0.0.1",)], "ip string")
    assert tag_network(some, segments.limit(0)).count() == 0
    assert tag_network(some.limit(0), segments, longest=True).count() == 0
