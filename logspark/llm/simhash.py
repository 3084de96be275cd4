"""Near-duplicate groups by SimHash fingerprints and covering locality-sensitive hashing.

Fingerprints within ``RADIUS`` bits are linked, without a miss. Every bit position carries a non-zero vector of
RADIUS + 1 bits, and for each non-zero v one table looks at the positions whose vector is not orthogonal to v (over
GF(2)). The vectors of at most RADIUS differing positions do not span the space, so some v is orthogonal to all of
them, and in that table the two fingerprints agree on every position it looks at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from logspark.llm.common import apart, saved, text_bytes
from logspark.llm.components import components

RADIUS = 2
SHINGLE = 3
SEED = 42
BLOCK = 1 << 20
# buckets up to this many fingerprints compare their pairs; larger ones meet at common neighbours instead
SMALL_BUCKET = 32


def blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words of a text in blocks of about ``size`` bytes, cut at white space; ASCII letters in lower case."""
    start = 0
    while start < len(data):
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end].lower().split()
        start = end


def fingerprint(data: bytes) -> int:
    """SimHash over word shingles, repeats included; 0 for a text without words."""
    seen, ones = 0, np.zeros(64, np.int64)
    tail: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    for words in blocks(data):
        tail += words
        if len(tail) < SHINGLE:
            continue
        text = b" ".join(tail)
        ends = np.cumsum([len(w) + 1 for w in tail])
        starts = np.concatenate(([0], ends[: -SHINGLE])).tolist()
        stops = (ends[SHINGLE - 1 :] - 1).tolist()
        hashes = np.array([digest(text[s:e], SEED) for s, e in zip(starts, stops)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        seen += len(hashes)
        tail = tail[-(SHINGLE - 1) :]
    if not seen:
        return digest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * ones > seen, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row per input row; fp is the 64-bit fingerprint as a signed long. Null text: 0."""

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(x) for x in text_bytes(batch["text"])], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(prints)], ["id", "fp"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, fp bigint")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One bit mask per table: 2^(radius+1) - 1 of them, each looking at about half of the 64 bits."""
    kinds = (1 << (radius + 1)) - 1
    vectors = [1 + i % kinds for i in range(64)]
    parity = lambda x: bin(x).count("1") & 1
    return [sum(1 << i for i, m in enumerate(vectors) if parity(m & v)) for v in range(1, kinds + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame) -> DataFrame:
    """(a, b) with a < b: enough pairs at RADIUS or fewer bits to connect all that are that close.

    ``prints`` holds distinct ``fp``. In a large bucket each fingerprint goes to itself and to every one-bit
    neighbour that keeps the bucket's bits; two fingerprints two bits apart meet in one of these points. All that
    meet at a point are within two bits of each other, at most 65, so each links to the smallest there only.
    """
    if RADIUS != 2:
        raise ValueError("the points of large buckets are made for a radius of 2")
    masks = [signed(m) for m in covering_masks()]
    frees = [[signed(1 << i) for i in range(64) if not m >> i & 1] for m in covering_masks()]
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("mask")) for t, m in enumerate(masks)])
    keyed = prints.select("fp", F.inline(tables)).select("t", "fp", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = keyed.join(sizes, ["t", "key"])
    small = (
        crowded.where(F.col("n") <= SMALL_BUCKET)
        .groupBy("t", "key")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        .select(F.explode("fps").alias("a"), "fps")
        .select("a", F.explode(F.filter("fps", lambda b: (b > F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= RADIUS))).alias("b"))
    )
    flips = F.element_at(F.array(*[F.array(F.lit(0), *map(F.lit, f)).cast("array<bigint>") for f in frees]), F.col("t") + 1)
    point = Window.partitionBy("t", "point")
    large = (
        crowded.where(F.col("n") > SMALL_BUCKET)
        .select("t", "fp", F.explode(flips).alias("flip"))
        .select("t", F.col("fp").alias("b"), F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
        .withColumn("a", F.min("b").over(point))
        .where("a < b")
        .select("a", "b")
    )
    return small.union(large).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id reachable over links, itself included.

    Equal fingerprints are one node of the graph, so thousands of copies cost one node. Texts without words have
    fingerprint 0 and are linked like any other. A null id has a row too and is smallest only where a component has
    no other id. Rows that repeat an id each have a row. No rows: no rows. Other columns are not read.
    """
    prints = saved(fingerprints(docs, id_col, text_col), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = saved(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows with a null or repeated id apart by their text; in order by id, nulls last."""
    mark = F.xxhash64(F.col(text_col).cast("string"))
    return F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), mark.alias("mark"))


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The first row of each group; ``groups`` has the row_key of each row as id, and its group's smallest as component_id."""
    first = groups.where(F.col("id") == F.col("component_id")).groupBy("id").agg(F.count(F.lit(1)).alias("__n"))
    first = saved(first.select(F.col("id.id").alias("__id"), F.col("id.mark").alias("__mark"), "__n"), "near-first")
    mark = F.xxhash64(F.col(text_col).cast("string"))
    kept = docs.hint("merge").join(first, F.col(id_col).eqNullSafe(F.col("__id")) & (mark == F.col("__mark")))
    # the key is made anew, so that each task drops most repetitions before they are dealt out
    again = kept.where("__n > 1").withColumn("__key", F.struct("__id", "__mark")).dropDuplicates(["__key"])
    return kept.where("__n = 1").select(*docs.columns).union(again.select(*docs.columns))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, all columns unchanged: that with the smallest id, nulls last, then by the hash of the text.

    Of rows that repeat id and text one stays. A null or repeated id stands for no group: each group keeps a row.
    """
    docs, new, old = apart(docs)
    id_col, text_col = new[id_col], new[text_col]
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    return keep_first(docs, near_groups(keyed, "key", "text"), id_col, text_col).toDF(*old)
