"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from logspark.llm.common import apart, saved

VNODES = 64
RING = 1 << 32
CELL_ROWS = 4096


@dataclass(frozen=True)
class Ring:
    """Virtual nodes in clockwise order: ``points[i]`` on the ring belongs to ``owners[i]``."""

    points: list[int]
    owners: list[int]
    shards: int


def make_ring(shards: int, vnodes: int = VNODES, seed: int = 0) -> Ring:
    spots = sorted(
        (xxhash.xxh64_intdigest(f"{s}/{v}", seed) % RING, s) for s in range(shards) for v in range(vnodes)
    )
    return Ring([p for p, _ in spots], [s for _, s in spots], shards)


def capacities(total: int, shards: int, balance: float) -> list[int]:
    """Rows a shard may hold: ``balance`` times the mean; at 1.0 exactly the rows that there are, at most one apart."""
    if balance <= 1.0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [-int(-balance * total // shards)] * shards


def flow(ring: Ring, loads: list[int], caps: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, first, last, shard): rows ``first`` to before ``last`` of an arc go to ``shard``.

    ``loads[i]`` rows fall on the arc that ends at virtual node i. In each round every arc offers what it has left to
    the next node clockwise; a shard takes offers in ring order until it is full. After one turn nothing is left.
    The work depends on the number of virtual nodes alone, not on the rows.
    """
    n, room = len(loads), list(caps)
    done = [0] * n
    pieces = []
    for step in range(n):
        left = [i for i in range(n) if done[i] < loads[i]]
        if not left:
            break
        for i in left:
            shard = ring.owners[(i + step) % n]
            take = min(loads[i] - done[i], room[shard])
            if take:
                pieces.append((i, done[i], done[i] + take, shard))
                done[i] += take
                room[shard] -= take
    return pieces


def place(keys: DataFrame, key: str, shards: int, balance: float = 1.0, vnodes: int = VNODES, seed: int = 0) -> DataFrame:
    """``keys`` plus shard and slot (0, 1, 2 … in each shard).

    A key's place on the ring is the hash of ``key`` as text (null: of the empty text). Keys that find their shard full
    continue clockwise; an arc's keys are served in ring order, ties by the hash of the whole row, and rows that are
    equal in every column are interchangeable. With ``balance`` 1.0 the shards' counts are at most one apart;
    with 1 + e no shard is above (1 + e) times the mean and fewer keys move when shards are added.
    Only one count per arc reaches the driver: ``shards * vnodes`` numbers. Ranks within an arc come from cells of about
    ``CELL_ROWS`` rows, so no task sorts a whole arc. No rows: no rows.
    """
    keys, new, old = apart(keys, ("shard", "slot"))
    key = new[key]
    ring = make_ring(shards, vnodes, seed)
    spark = keys.sparkSession
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    spot = F.pmod(F.xxhash64(F.lit(seed), name), F.lit(RING))
    total = keys.count()
    cell = max(1, RING * CELL_ROWS // max(total, 1))
    points = F.array(*[F.lit(p).cast("bigint") for p in ring.points])
    # the arc of a spot: how many virtual nodes lie before it, by halving; behind the last one it wraps around
    low = F.lit(0)
    step = 1 << (len(ring.points) - 1).bit_length()
    placed = keys.withColumn("__spot", spot).withColumn("__tie", F.xxhash64(*keys.columns)).withColumn("__nodes", points)
    placed = placed.withColumn("__arc", low)
    while step:
        probe = F.col("__arc") + F.lit(step)
        inside = (probe <= len(ring.points)) & (F.get("__nodes", F.least(probe, F.lit(len(ring.points))) - 1) < F.col("__spot"))
        placed = placed.withColumn("__arc", F.when(inside, probe).otherwise(F.col("__arc")))
        step //= 2
    wrapped = F.col("__arc") == len(ring.points)
    # behind the last node the spots come before those at the start of the ring
    placed = placed.withColumn("__pos", F.when(wrapped, F.col("__spot") - F.lit(RING)).otherwise(F.col("__spot")))
    placed = placed.withColumn("__arc", F.when(wrapped, 0).otherwise(F.col("__arc"))).drop("__nodes")
    placed = saved(placed.withColumn("__cell", F.floor(F.col("__pos") / F.lit(cell))), "ring")
    cells = placed.groupBy("__arc", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__arc").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    counts = {r["__arc"]: r["n"] for r in cells.groupBy("__arc").agg(F.sum("__n").alias("n")).collect()}
    loads = [counts.get(i, 0) for i in range(len(ring.points))]
    pieces = flow(ring, loads, capacities(total, shards, balance))
    used: dict[int, int] = {}
    rows = []
    for arc, first, last, shard in sorted(pieces):
        rows.append((arc, first, last, shard, used.get(shard, 0)))
        used[shard] = used.get(shard, 0) + last - first
    spans = spark.createDataFrame(rows, "arc int, first bigint, last bigint, shard int, base bigint")
    spans = spans.groupBy("arc").agg(F.collect_list(F.struct("last", "first", "shard", "base")).alias("spans"))
    within = Window.partitionBy("__arc", "__cell").orderBy("__pos", "__tie")
    ranked = (
        placed.withColumn("__rank", F.row_number().over(within) - 1)
        .join(offsets, ["__arc", "__cell"])
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
        .join(F.broadcast(spans), F.col("__arc") == F.col("arc"))
        .withColumn("__span", F.array_min(F.filter("spans", lambda s: s["last"] > F.col("__rank"))))
    )
    return ranked.select(
        *keys.columns,
        F.col("__span.shard").alias("shard"),
        (F.col("__span.base") + F.col("__rank") - F.col("__span.first")).alias("slot"),
    ).toDF(*old, "shard", "slot")
