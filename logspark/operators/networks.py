"""Which network segments an address belongs to.

A range test would be a nested-loop join. Segments are nested or apart, so they cut the address space into disjoint
intervals, each with the segments around it; a segment table of the usual size becomes one sorted list of interval
starts, in which an address is found by halving, inside its own row: no join and no shuffle. A table of more than
``MAX_SEGMENTS`` is joined instead: each network is keyed by (family, prefix, base) and each address is probed once per
prefix length that occurs, so the join is an equi join; at most 162 prefix lengths exist.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, functions as F

from logspark.functions.binding import with_fields
from logspark.functions.ip import address_halves, canon_ip, cidr_address, cidr_prefix, masked
from logspark.functions.joins import BROADCAST_BYTES, SALTS, as_lookup, attach, measured_bytes


MAX_SEGMENTS = 50_000
HALF = (1 << 64) - 1


def network_segments(networks: DataFrame) -> DataFrame:
    """One row per CIDR of each network: id, name, vlan, family, prefix, hi, lo."""
    both = networks.withColumn("cidr", F.explode(F.array_compact(F.array("ipv4", "ipv6"))))
    out = with_fields(both, [cidr_prefix(F.col("cidr")).alias("prefix"), cidr_address(F.col("cidr")).alias("addr")])
    out = with_fields(out.filter(F.col("addr").isNotNull()), [address_halves(F.col("addr")).alias("h")])
    out = with_fields(out, [masked(F.col("h"), F.col("prefix")).alias("n")])
    return out.select("id", "name", "vlan", "cidr", "n.family", "prefix", "n.hi", "n.lo")


def address_key(halves: Column) -> Column:
    """Text that orders addresses as numbers, IPv4 before IPv6."""
    digits = [F.lpad(F.hex(halves[part]), 16, "0") for part in ("hi", "lo")]
    return F.concat(halves["family"].cast("string"), *digits)


def flatten(segments: list[Row]) -> tuple[list[str], list[list[int]]]:
    """(starts, owners): disjoint intervals in order, each up to the next start, and the positions of the segments
    around it, the most specific one last; of equal segments that with the smallest id."""
    def key(family: int, number: int) -> str:
        return f"{family}{number:032X}" if number >> 128 == 0 else f"{family + 1}"

    bounds: dict[str, tuple[list[int], list[int]]] = {"": ([], [])}
    for i, s in enumerate(segments):
        base = (s["hi"] & HALF) << 64 | s["lo"] & HALF
        size = 1 << ((32 if s["family"] == 4 else 128) - s["prefix"])
        bounds.setdefault(key(s["family"], base), ([], []))[0].append(i)
        bounds.setdefault(key(s["family"], base + size), ([], []))[1].append(i)
    starts, owners = [], []
    held: list[int] = []
    rank = lambda i: (segments[i]["prefix"], -segments[i]["id"])
    for start in sorted(bounds):
        begun, over = bounds[start]
        held = sorted([i for i in held if i not in over] + begun, key=rank)
        starts.append(start)
        owners.append(held)
    return starts, owners


def tag_network(
    df: DataFrame,
    segments: DataFrame,
    col: str = "ip",
    longest: bool = False,
    max_bytes: int = BROADCAST_BYTES,
    max_segments: int = MAX_SEGMENTS,
) -> DataFrame:
    """One row per (input row, containing segment); rows in no segment are left out.

    ``longest`` keeps only the most specific segment of each address. With more than ``max_segments`` it is found once
    per distinct address and then looked up, so a busy address is never gathered in one group.
    """
    known = segments.limit(max_segments + 1).collect()
    if len(known) <= max_segments:
        return _halve(df, known, segments.schema["id"].dataType.simpleString(), col, longest)
    if longest:
        hits = _probe(df.select(col).distinct(), segments, col, max_bytes)
        best = hits.groupBy(col).agg(
            F.min_by(F.struct("family", "prefix", "network_id", "network", "vlan"), F.struct(-F.col("prefix"), "network_id")).alias("n")
        )
        best = best.select(F.col(col).alias("key"), "n.*")
        found = attach(df, as_lookup(best, "key", max_bytes), F.col(col), "__n", df.columns)
        return found.filter(F.col("__n").isNotNull()).select(*df.columns, "__n.*")
    return _probe(df, segments, col, max_bytes)


def _halve(df: DataFrame, segments: list[Row], id_type: str, col: str, longest: bool) -> DataFrame:
    """The interval of each address, by halving the list of starts; lists and names are constants of the plan."""
    starts, owners = flatten(segments)
    if longest:
        owners = [o[-1:] for o in owners]
    names = [[s["family"], s["prefix"], s["id"], s["name"], s["vlan"]] for s in segments]
    columns = ("family", "prefix", "network_id", "network", "vlan")
    kind = f"array<struct<family: int, prefix: int, network_id: {id_type}, network: string, vlan: string>>"
    table = F.from_json(F.lit(json.dumps([dict(zip(columns, n)) for n in names])), kind)
    around = F.from_json(F.lit(json.dumps(owners)), "array<array<int>>")
    listed = F.split(F.lit(",".join(starts)), ",")
    steps = [F.lit(1 << k) for k in reversed(range(len(starts).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(listed, at + step) <= F.col("__key"), at + step).otherwise(at)

    rows = with_fields(df, [canon_ip(F.col(col)).alias("__ip")])
    rows = with_fields(rows.filter(F.col("__ip").isNotNull()), [address_key(address_halves(F.col("__ip"))).alias("__key")], df.columns)
    rows = with_fields(rows, [F.aggregate(F.array(*steps), F.lit(0), further).alias("__at")], df.columns)
    rows = rows.select(*df.columns, F.explode(F.get(around, F.col("__at"))).alias("__segment"))
    return rows.select(*df.columns, F.get(table, F.col("__segment")).alias("__n")).select(*df.columns, "__n.*")


def _probe(df: DataFrame, segments: DataFrame, col: str, max_bytes: int) -> DataFrame:
    lengths = [(r["family"], r["prefix"]) for r in segments.select("family", "prefix").distinct().collect()]
    by_family = {f: sorted(p for g, p in lengths if g == f) for f in (4, 6)}
    rows = with_fields(df, [canon_ip(F.col(col)).alias("__ip")])
    rows = with_fields(rows.filter(F.col("__ip").isNotNull()), [address_halves(F.col("__ip")).alias("__h")])
    v4, v6 = (F.array(*[F.lit(p) for p in by_family[f]]).cast("array<int>") for f in (4, 6))
    rows = rows.withColumn("__prefix", F.explode(F.when(F.col("__h.family") == 4, v4).otherwise(v6)))
    rows = with_fields(rows, [masked(F.col("__h"), F.col("__prefix")).alias("__n")])
    on = ["family", "prefix", "hi", "lo"]
    rows = rows.select(
        *df.columns,
        F.col("__n.family").alias("family"),
        F.col("__prefix").alias("prefix"),
        F.col("__n.hi").alias("hi"),
        F.col("__n.lo").alias("lo"),
    )
    named = segments.select(*on, F.col("id").alias("network_id"), F.col("name").alias("network"), "vlan")
    if measured_bytes(named) <= max_bytes:
        hit = rows.join(F.broadcast(named), on)
    else:
        # a busy segment is spread over many tasks; the segment table is repeated per salt
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        named = named.withColumn("__salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
        hit = rows.join(named, on + ["__salt"]).drop("__salt")
    return hit.select(*df.columns, "family", "prefix", "network_id", "network", "vlan")
