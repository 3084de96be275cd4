"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of like length form blocks. A block keeps one bitmap over its documents for each signature bit: bit r of
document d is set if a (term, level) of d has r among its PROBES bits; level k of a term is there if the document has
it STEPS[k] times or more. The bitmaps of a query term's bits, ANDed, name all documents that have it, and some that
don't, so the levels reached give an upper bound of its frequency; weighted sums over the terms give upper bounds of
scores. Every document whose bound reaches the score of the last place so far is scored exactly from its own words.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Row, Window, functions as F

from logspark.llm.common import saved, slices

PROBES = 8
STEPS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 1024, 8192)
BLOCK_DOCS = 512
LEAST_DOCS = 64
# what a task gathers before it sorts documents by length and cuts blocks
ENTRIES = 1 << 20
RAW = 16 << 20
SLICE = 4 << 20
HASHES = 1 << 20
# items that are looked for in one pass over the index
ITEMS = 1000
# of so many blocks one is searched first, for the score that the last place has at least
SEED_SHARE = 16

_PARTS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_GAMMA, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(_PARTS).split()


def rows_of(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The PROBES bitmaps of each hashed term at a level, one row a term."""
    h = (hashes + np.uint64(level * _GAMMA % (1 << 64))) * _MIX
    h ^= h >> np.uint64(29)
    first, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return ((first[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(width)).astype(np.int64)


class Gathered:
    """Distinct texts of a task, until they are cut into blocks."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: list[list] = []
        self.lengths: list[int] = []
        self.terms: list[tuple[np.ndarray, np.ndarray]] = []
        self.entries: list[int] = []
        self.raw = self.held = 0

    def add(self, doc_id, text: bytes, hash_of) -> None:
        at = self.known.get(text)
        if at is not None:
            self.ids[at].append(doc_id)
            return
        words = terms_of(text)
        if not words:
            return
        counts = Counter(words)
        hashes = np.fromiter(map(hash_of, counts), np.uint64, len(counts))
        times = np.fromiter(counts.values(), np.int64, len(counts))
        self.known[text] = len(self.ids)
        self.ids.append([doc_id])
        self.lengths.append(len(words))
        self.terms.append((hashes, times))
        self.entries.append(int(np.searchsorted(STEPS, times, "right").sum()))
        self.raw += len(text)
        self.held += self.entries[-1]

    def full(self) -> bool:
        return self.raw > RAW or self.held > ENTRIES

    def blocks(self) -> Iterator[dict]:
        """The documents by number of entries, in blocks in which it at most doubles (or of LEAST_DOCS)."""
        order = sorted(range(len(self.ids)), key=self.entries.__getitem__)
        texts = list(self.known)
        start = 0
        for i in range(1, len(order) + 1):
            n = i - start
            if i < len(order) and n < BLOCK_DOCS and (n < LEAST_DOCS or self.entries[order[i]] <= 2 * self.entries[order[start]]):
                continue
            yield self.block(order[start:i], texts)
            start = i

    def block(self, docs: list[int], texts: list[bytes]) -> dict:
        width = max(64, math.ceil(self.entries[docs[-1]] * PROBES / math.log(2)))
        bits = np.zeros((width, (len(docs) + 7) // 8), np.uint8)
        for d, doc in enumerate(docs):
            hashes, times = self.terms[doc]
            for level, least in enumerate(STEPS):
                if level:
                    hashes, times = hashes[times >= least], times[times >= least]
                if not len(hashes):
                    break
                bits[rows_of(hashes, level, width).ravel(), d >> 3] |= np.uint8(128 >> (d & 7))
        packer = zstandard.ZstdCompressor(level=1)
        sizes = [len(self.ids[doc]) for doc in docs]
        return {
            "key": xxhash.xxh64_intdigest(texts[docs[0]]) >> 1,
            "ids": [x for doc in docs for x in self.ids[doc]],
            "copies": sizes,
            "lengths": [self.lengths[doc] for doc in docs],
            "most": [int(self.terms[doc][1].max()) for doc in docs],
            "texts": [packer.compress(texts[doc]) for doc in docs],
            "width": width,
            "bits": bits.tobytes(),
            "n_docs": sum(sizes),
            "n_terms": sum(n * self.lengths[doc] for n, doc in zip(sizes, docs)),
        }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a block: ids, lengths and packed texts of its distinct documents, and their signatures by bit.

    Within a block equal texts are one document with several ids. Texts without a term are not indexed.
    """
    taken = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.octet_length("text") > 0)
    kind = taken.schema["id"].dataType.simpleString()
    lists = f"ids array<{kind}>, copies array<bigint>, lengths array<bigint>, most array<bigint>, texts array<binary>"
    schema = f"key bigint, {lists}, width bigint, bits binary, n_docs bigint, n_terms bigint"

    def run(batches):
        hashes: dict[bytes, int] = {}

        def hash_of(term: bytes) -> int:
            h = hashes.get(term)
            if h is None:
                if len(hashes) >= HASHES:
                    hashes.clear()
                h = hashes[term] = xxhash.xxh64_intdigest(term)
            return h

        held, kinds = Gathered(), None

        def emit():
            for block in held.blocks():
                yield pa.RecordBatch.from_pylist([block], kinds)

        for batch in slices(batches, "text", SLICE):
            if kinds is None:
                longs, plain = pa.list_(pa.int64()), pa.int64()
                kinds = pa.schema(
                    {"key": plain, "ids": pa.list_(batch.schema.field("id").type), "copies": longs, "lengths": longs, "most": longs}
                    | {"texts": pa.list_(pa.binary()), "width": plain, "bits": pa.binary(), "n_docs": plain, "n_terms": plain}
                )
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"].cast(pa.binary())):
                held.add(doc_id, text.as_buffer().to_pybytes(), hash_of)
                if held.full():
                    yield from emit()
                    held = Gathered()
        if held.ids:
            yield from emit()

    return taken.mapInArrow(run, schema)


def frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """How many documents hold each of ``terms``, from the words of all of them; one number a term reaches the driver."""
    wanted = index.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches):
        number = wanted.value
        counts = np.zeros(len(number), np.int64)
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for copies, texts in zip(batch["copies"].to_pylist(), batch["texts"]):
                for n, packed in zip(copies, texts.values):
                    own = set(terms_of(opener.decompress(packed.as_buffer().to_pybytes())))
                    counts[[number[t] for t in own if t in number]] += n
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])

    parts = index.select("copies", "texts").mapInArrow(run, "term bigint, n bigint")
    return {terms[r["term"]]: r["n"] for r in parts.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}


class Queries:
    """The items of one pass: their terms' hashes and weights, and what the last place must reach at least."""

    def __init__(self, items: list[list[bytes]], df: dict[bytes, int], n_docs: int, n_terms: int, limit: int) -> None:
        terms = list(dict.fromkeys(t for own in items for t in own))
        number = {t: i for i, t in enumerate(terms)}
        self.items, self.n_docs, self.n_terms, self.limit = items, n_docs, n_terms, limit
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in terms], np.uint64)
        self.weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in terms}
        self.weights = np.array([self.weight[t] for t in terms], float)
        self.own = [np.array([number[t] for t in own], np.int64) for own in items]
        self.least = np.ones(len(items), np.int64)

    def length_part(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 50 + 50 * lengths * self.n_docs // self.n_terms

    def bounds(self, bits: np.ndarray, m: np.ndarray, most: np.ndarray) -> np.ndarray:
        """What no document of the block can exceed, for each item."""
        width, size = len(bits), len(m)
        # the highest level that each term may have reached in each document, from 1; 0: it is not there
        level = np.zeros((len(self.hashes), size), np.int8)
        at, present = np.arange(len(self.hashes)), None
        for k in range(len(STEPS)):
            here = np.bitwise_and.reduce(bits[rows_of(self.hashes[at], k, width)], axis=1)
            present = here if present is None else here & present
            some = present.any(axis=1)
            at, present = at[some], present[some]
            if not len(at):
                break
            level[at] += np.unpackbits(present, axis=1, count=size).view(np.int8)
        caps = np.minimum(np.array([*(s - 1 for s in STEPS[1:]), 1 << 40])[:, None], most)
        values = np.zeros((len(STEPS) + 1, size))
        values[1:] = 1_000_000_000 * caps // (1000 * caps + 20 * m)
        part = values[level, np.arange(size)]
        return np.stack([self.weights[own] @ part[own] for own in self.own])

    def score(self, item: int, counts: Counter, m: int) -> int:
        return sum(self.weight[t] * (1_000_000_000 * tf // (1000 * tf + 20 * m)) for t in self.items[item] if (tf := counts.get(t)))


class Best:
    """The best documents of a task for each item: highest scores, then smallest ids, null last."""

    def __init__(self, queries: Queries) -> None:
        self.limit = queries.limit
        self.rows: list[list[tuple]] = [[] for _ in queries.items]
        self.least = queries.least.copy()

    def add(self, item: int, score: int, ids: list) -> None:
        if score < self.least[item]:
            return
        mine = self.rows[item]
        order = lambda x: (x is None, x if x is not None else 0)
        mine += [(-score, *order(x)) for x in heapq.nsmallest(self.limit, ids, key=order)]
        if len(mine) >= 2 * self.limit:
            self.cut(item)

    def cut(self, item: int) -> None:
        self.rows[item] = heapq.nsmallest(self.limit, self.rows[item])
        if len(self.rows[item]) == self.limit:
            self.least[item] = max(self.least[item], -self.rows[item][-1][0])


def top_of(index: DataFrame, queries: Queries) -> DataFrame:
    """(item, id, score) of each task's best documents for each item, of those that reach ``queries.least``."""
    shared = index.sparkSession.sparkContext.broadcast(queries)
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        queries = shared.value
        best, opener, id_type = Best(queries), zstandard.ZstdDecompressor(), None
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for b in range(batch.num_rows):
                cell = lambda name: batch[name][b]
                lengths, most, copies = (np.array(cell(c).as_py()) for c in ("lengths", "most", "copies"))
                bits = np.frombuffer(cell("bits").as_buffer(), np.uint8).reshape(cell("width").as_py(), -1)
                m = queries.length_part(lengths)
                bounds = queries.bounds(bits, m, most)
                ids, ends = cell("ids").as_py(), np.cumsum(copies)
                texts, opened = cell("texts").values, {}

                def judge(item: int, d: int) -> None:
                    counts = opened.get(d)
                    if counts is None:
                        counts = opened[d] = Counter(terms_of(opener.decompress(texts[d].as_buffer().to_pybytes())))
                    best.add(item, queries.score(item, counts, int(m[d])), ids[ends[d] - copies[d] : ends[d]])

                for item, bound in enumerate(bounds):
                    first = np.argpartition(-bound, queries.limit)[: queries.limit] if len(bound) > queries.limit else np.arange(len(bound))
                    first = first[bound[first] >= best.least[item]]
                    for d in first.tolist():
                        judge(item, d)
                    best.cut(item)
                    rest = bound >= best.least[item]
                    rest[first] = False
                    for d in np.flatnonzero(rest).tolist():
                        judge(item, d)
                    best.cut(item)
        rows = [(i, None if null else x, -score) for i, mine in enumerate(best.rows) for score, null, x in mine]
        if rows:
            items, found, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(found, id_type), pa.array(scores, pa.int64())], ["item", "id", "score"]
            )

    return index.select("ids", "copies", "lengths", "most", "texts", "width", "bits").mapInArrow(run, f"item bigint, id {kind}, score bigint")


def search_block(index: DataFrame, items: list[list[bytes]], sums: Row, limit: int) -> DataFrame:
    """(item, rank, id, score) of one pass. A share of the blocks is searched first: the score of its last place is
    reached by the last place of all, so the pass over all blocks looks at, and sends, little more than that."""
    terms = list(dict.fromkeys(t for own in items for t in own))
    queries = Queries(items, frequencies(index, terms), sums["docs"], sums["terms"], limit)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    seed = ranked(top_of(index.where(F.col("key") % SEED_SHARE == 0), queries)).where(F.col("rank") == limit)
    for row in seed.select("item", "score").toLocalIterator():
        queries.least[row["item"]] = row["score"]
    return ranked(top_of(index, queries))


def search(
    docs: DataFrame,
    items: DataFrame,
    limit: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``limit`` best documents of each row of ``items``, with a score above 0.

    Rows of either table that repeat count as often as they occur; an item twice gives its ranks twice. Ties go to the
    smaller id, null last. Null texts, and items without a term, find nothing. No rows in either table: no rows.
    ITEMS rows of ``items`` are looked for at a time, each time in all of the index.
    """
    spark = docs.sparkSession
    index = saved(build_index(docs, id_col, text_col), "lexical-index")
    sums = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    picked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    out_type = f"item_id {picked.schema['item_id'].dataType.simpleString()}, rank int, doc_id {index.schema['ids'].dataType.elementType.simpleString()}, score bigint"
    found: list[DataFrame] = []
    block: list[Row] = []

    def look() -> None:
        numbers = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"item bigint, {out_type.split(', ')[0]}")
        terms = [list(dict.fromkeys(terms_of((r["text"] or "").encode()))) for r in block]
        best = search_block(index, terms, sums, limit)
        named = best.join(F.broadcast(numbers), "item")
        found.append(saved(named.select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score"), "lexical-found"))
        block.clear()

    if sums["docs"]:
        for row in picked.toLocalIterator():
            block.append(row)
            if len(block) == ITEMS:
                look()
        if block:
            look()
    if not found:
        return spark.createDataFrame([], out_type)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
