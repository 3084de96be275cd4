"""Quality rules by n-gram perplexity: a modified Kneser-Ney model over UTF-8 bytes, counted by Spark.

An n-gram of ``ORDER`` bytes is one integer, its context the integer without the last byte, its shorter form the
integer without the first. The finished model keeps every n-gram by itself. Tasks get it whole up to HELD_GRAMS n-grams of
the highest order; of a larger one they get the most frequent, and what they do not find is scored by joins with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from logspark.llm.common import apart, saved, slices

ORDER = 5
# n-grams of the highest order that the broadcast model may have, and the bits of the index over an order's hashes
HELD_GRAMS = 1 << 21
INDEX_BITS = 20
MIX = 0x9E3779B97F4A7C15
MICRO = 1_000_000
# an unseen byte
UNKNOWN = int(np.log(1 / 256) * MICRO)
SLICE = 2 << 20
MERGE = 1 << 21
MIN_WORDS = 50
# bands: this many times the scaled median deviation around a language's median, no narrower than the floor
SPREAD = 8.0
MAD_SCALE = 1.4826
LEAST_SPREAD = 0.02
# a language of fewer distinct texts, or whose own band is at the floor, takes at least the spread of all languages
FEW_TEXTS = 50
BINS = 2000
SYMBOLS = "#*$%&|<>"
# the model learns from texts with at most this share of symbols; else it would learn to expect them
LEARN_SYMBOLS = 0.01
# marks that a task remembers, so that it sends a text that it meets again only once
REMEMBERED = 100_000


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each behind ORDER - 1 zero bytes; and where each text starts, plus the end."""
    texts = column.cast(pa.binary())
    lengths = np.array([n or 0 for n in pa.compute.binary_length(texts).to_pylist()], np.int64)
    pad = ORDER - 1
    starts = np.concatenate(([0], np.cumsum(lengths + pad))) + pad
    data = np.zeros(starts[-1] - pad, np.uint8)
    for i, text in enumerate(texts):
        if lengths[i]:
            data[starts[i] : starts[i] + lengths[i]] = np.frombuffer(text.as_buffer(), np.uint8)
    return data, np.stack([starts[:-1], starts[:-1] + lengths], 1)


def grams_of(data: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte from the ORDER-th on."""
    n = len(data) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    grams = data[:n].astype(np.int64)
    for k in range(1, ORDER):
        grams <<= 8
        grams |= data[k : k + n]
    return grams


def hashed(grams: np.ndarray) -> np.ndarray:
    return (grams.astype(np.uint64) * np.uint64(MIX) >> np.uint64(64 - INDEX_BITS)).astype(np.int64)


def inner(spans: np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions inside the spans."""
    edge = np.zeros(size + 1, np.int8)
    full = spans[spans[:, 1] > spans[:, 0]]
    edge[full[:, 0]] += 1
    edge[full[:, 1]] -= 1
    return np.cumsum(edge[:-1]).astype(bool)


def plain(data: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Mask of the texts that the model learns from."""
    signs = np.zeros(256, np.int64)
    signs[list(SYMBOLS.encode())] = 1
    sums = np.concatenate(([0], np.cumsum(signs[data])))
    return sums[spans[:, 1]] - sums[spans[:, 0]] <= LEARN_SYMBOLS * (spans[:, 1] - spans[:, 0])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of ``distinct_texts``, about SLICE bytes at a time."""
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        texts, size = [], 0
        for packed in batch["packed"]:
            texts.append(opener.decompress(packed.as_buffer().to_pybytes()))
            size += len(texts[-1])
            if size > SLICE:
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])
                texts, size = [], 0
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])


def count_grams(docs: DataFrame, text_col: str | None) -> DataFrame:
    """(gram, n) over all texts with few symbols; each task adds up what it has before it is shuffled.

    No ``text_col``: ``docs`` are ``distinct_texts``, unpacked in the same worker.
    """

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            keys = np.concatenate([k for k, _ in held])
            counts = np.concatenate([c for _, c in held])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[first], np.add.reduceat(counts, first)

        def emit(keys, counts):
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 100_000]), pa.array(counts[i : i + 100_000])], ["gram", "n"])

        for batch in slices(batches, "text", SLICE) if text_col else unpacked(batches):
            data, spans = padded(batch["text"])
            grams = grams_of(data)[inner(spans[plain(data, spans)], len(data))[ORDER - 1 :]]
            if not len(grams):
                continue
            grams.sort()
            first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
            held.append((grams[first], np.diff(np.append(first, len(grams)))))
            size += len(first)
            if size > MERGE:
                held = [merged()]
                size = len(held[0][0])
                if size > MERGE // 2:
                    yield from emit(*held[0])
                    held, size = [], 0
        if held:
            yield from emit(*merged())

    taken = docs.select(F.col(text_col).cast("string").alias("text")) if text_col else docs
    parts = taken.mapInArrow(run, "gram bigint, n bigint")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> list[DataFrame]:
    """Per order 1 … ORDER: (gram, n, p, back). ``back`` is what is left for shorter forms behind this gram as a context.

    The highest order uses counts, the others the number of different bytes before a gram. Discounts are the modified
    ones for counts 1, 2 and 3 or more, from the counts of counts of each order; where these are too few, 0.5, 1, 1.5.
    """
    grams = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        mask = (1 << 8 * k) - 1
        shorter = grams[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"))
        grams[k] = saved(shorter.agg(F.count(F.lit(1)).alias("n")), f"kn-count{k}")
    lower = None
    tables: list[DataFrame] = []
    for k in range(1, ORDER + 1):
        tally = {r["n"]: r["c"] for r in grams[k].where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
        n1, n2, n3, n4 = (tally.get(i, 0) for i in (1, 2, 3, 4))
        discounts = [0.5, 1.0, 1.5]
        if n1 and n2 and n3 and n4:
            y = n1 / (n1 + 2 * n2)
            found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            if all(0 < d < i + 1 for i, d in enumerate(found)):
                discounts = found
        less = F.when(F.col("n") == 1, discounts[0]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[2])
        context = F.shiftright("gram", 8)
        sums = grams[k].groupBy(context.alias("context")).agg(F.sum("n").alias("whole"), F.sum(less).alias("held"))
        rows = grams[k].withColumn("context", context).withColumn("left", F.col("n") - less)
        rows = rows.join(sums, "context").withColumn("share", F.col("held") / F.col("whole"))
        if lower is None:
            rows = rows.withColumn("q", F.lit(1 / 256))
        else:
            mask = (1 << 8 * (k - 1)) - 1
            below = lower.select(F.col("gram").alias("short"), F.col("p").alias("q"))
            rows = rows.withColumn("short", F.col("gram").bitwiseAND(F.lit(mask))).join(below, "short")
        probs = rows.select("gram", "n", (F.col("left") / F.col("whole") + F.col("share") * F.col("q")).alias("p"))
        lower = saved(probs, f"kn-order{k}")
        tables.append(lower)
        if k > 1:
            backs = sums.select(F.col("context").alias("gram"), (F.col("held") / F.col("whole")).alias("back"))
            tables[k - 2] = tables[k - 2].join(backs, "gram", "left")
    tables[-1] = tables[-1].withColumn("back", F.lit(None).cast("double"))
    return tables


@dataclass
class Model:
    """N-grams of each order by their hashes, with log probability and log backoff, both in millionths.

    ``whole``: all n-grams. Else only some of the highest order, and no shorter ones.
    """

    keys: list[np.ndarray]
    probs: list[np.ndarray]
    backs: list[np.ndarray]
    whole: bool

    def opened(self) -> Model:
        """With an index of where each hash begins."""
        edges = np.arange((1 << INDEX_BITS) + 1)
        self.begins = [np.searchsorted(hashed(keys), edges).astype(np.int32) for keys in self.keys]
        return self

    def find(self, order: int, grams: np.ndarray) -> np.ndarray:
        """Where each n-gram stands among those of its order; -1: nowhere."""
        keys, begins = self.keys[order - 1], self.begins[order - 1]
        h = hashed(grams)
        out = np.full(len(grams), -1, np.int32)
        spot, end = begins[h], begins[h + 1]
        left = np.flatnonzero(spot < end)
        spot, end, wanted = spot[left], end[left], grams[left]
        while len(left):
            hit = keys[spot] == wanted
            out[left[hit]] = spot[hit]
            more = ~hit & (spot + 1 < end)
            left, spot, end, wanted = left[more], spot[more] + 1, end[more], wanted[more]
        return out

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of each gram, in millionths."""
        out = np.zeros(len(grams), np.int64)
        rest = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            part = grams[rest] & ((1 << 8 * k) - 1)
            spot = self.find(k, part)
            hit = spot >= 0
            out[rest[hit]] += self.probs[k - 1][spot[hit]]
            rest, part = rest[~hit], part[~hit]
            if not len(rest):
                return out
            if k > 1:
                spot = self.find(k - 1, part >> 8)
                out[rest] += np.where(spot >= 0, self.backs[k - 2][spot], 0) if len(self.backs[k - 2]) else 0
        out[rest] += UNKNOWN
        return out


def distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(packed): each text once, compressed, so that a repeated one teaches no more than any other."""

    def pack(batches):
        packer, seen = zstandard.ZstdCompressor(level=1), set()
        for batch in slices(batches, "text", SLICE):
            marks, packed = [], []
            for mark, text in zip(batch["mark"].to_pylist(), batch["text"].cast(pa.binary())):
                if mark in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(mark)
                marks.append(mark)
                packed.append(packer.compress(text.as_buffer().to_pybytes()))
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(packed, pa.binary())], ["mark", "packed"])

    text = F.col(text_col).cast("string")
    known = docs.select(F.xxhash64(text).alias("mark"), text.alias("text")).where(F.octet_length("text") > 0)
    once = known.mapInArrow(pack, "mark bigint, packed binary").groupBy("mark").agg(F.first("packed").alias("packed"))
    return once.select("packed")


def learnt(docs: DataFrame, text_col: str = "text") -> tuple[Broadcast, list[DataFrame]]:
    """Count all distinct texts; the model for the tasks, and the tables (gram, n, p, b) per order that it comes from.

    At most HELD_GRAMS n-grams an order, of 16 bytes, reach the driver. Of a larger model these are the most frequent of
    the highest order, as many powers of two of their counts as fit.
    """
    spark = docs.sparkSession
    counts = saved(count_grams(distinct_texts(docs, text_col), None), "kn-grams")
    micro = lambda c: F.round(F.log(c) * MICRO).cast("int")
    tables = []
    for k, rows in enumerate(kneser_ney(counts), 1):
        logs = rows.select("gram", "n", micro("p").alias("p"), F.coalesce(micro("back"), F.lit(0)).alias("b"))
        tables.append(saved(logs, f"kn-logs{k}"))
    power = F.floor(F.log2("n"))
    sizes = tables[-1].groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("power")).collect()
    whole = sum(r["c"] for r in sizes) <= HELD_GRAMS
    held = tables
    if not whole:
        room, least = HELD_GRAMS, 64
        for r in sizes:
            room -= r["c"]
            if room < 0:
                break
            least = r["power"]
        held = [*(t.limit(0) for t in tables[:-1]), tables[-1].where(power >= least)]
    keys, probs, backs = [], [], []
    for rows in held:
        table = rows.select("gram", "p", "b").toArrow()
        grams = table["gram"].to_numpy()
        order = np.argsort(hashed(grams), kind="stable")
        keys.append(grams[order])
        probs.append(table["p"].to_numpy()[order])
        backs.append(table["b"].to_numpy()[order])
    return spark.sparkContext.broadcast((keys, probs, backs, whole)), tables


def train(docs: DataFrame, text_col: str = "text") -> Broadcast:
    return learnt(docs, text_col)[0]


def chances(grams: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(gram, micro) of distinct n-grams of the highest order: what ``Model.score`` gives with all n-grams, by joins."""
    out, rest = None, grams.select("gram", F.lit(0).cast("bigint").alias("sum"))
    for k in range(ORDER, 0, -1):
        part = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        own = tables[k - 1].select(F.col("gram").alias("__own"), "p")
        met = saved(rest.withColumn("__part", part).join(own, F.col("__part") == F.col("__own"), "left"), f"kn-met{k}")
        done = met.where("p IS NOT NULL").select("gram", (F.col("sum") + F.col("p")).alias("micro"))
        out = done if out is None else out.union(done)
        rest = met.where("p IS NULL").select("gram", "sum", "__part")
        if k > 1:
            context = tables[k - 2].select(F.col("gram").alias("__context"), "b")
            rest = rest.join(context, F.shiftright("__part", 8) == F.col("__context"), "left")
            rest = rest.select("gram", (F.col("sum") + F.coalesce("b", F.lit(0))).alias("sum"))
    return out.union(rest.select("gram", (F.col("sum") + UNKNOWN).alias("micro")))


def open_sums(docs: DataFrame, model: Broadcast, tables: list[DataFrame]) -> DataFrame:
    """(mark, rest): per distinct text of (mark, text) the sum over the n-grams that the tasks' model does not hold."""

    def run(batches):
        opened = Model(*model.value).opened()
        for batch in slices(batches, "text", SLICE):
            data, spans = padded(batch["text"])
            grams = grams_of(data)
            first = np.maximum(spans[:, 0] - ORDER + 1, 0)
            for mark, a, n in zip(batch["mark"], first.tolist(), (spans[:, 1] - spans[:, 0]).tolist()):
                own = grams[a : a + n]
                found, times = np.unique(own[opened.find(ORDER, own) < 0], return_counts=True)
                if len(found):
                    marks = pa.array(np.full(len(found), mark.as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays([marks, pa.array(found), pa.array(times)], ["mark", "gram", "n"])

    parts = docs.select("mark", "text").mapInArrow(run, "mark bigint, gram bigint, n bigint")
    # rows that repeat a text give the same parts
    parts = saved(parts.distinct(), "kn-open")
    worth = saved(chances(parts.select("gram").distinct(), tables), "kn-chances")
    return parts.join(worth, "gram").groupBy("mark").agg(F.sum(F.col("n") * F.col("micro")).alias("rest"))


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = data.split()
    n = len(words)
    chars = len(data) - sum(data.count(bytes([c])) for c in b" \t\n\r\x0b\x0c") if n else 0
    if n and not data.isascii():
        raw = np.frombuffer(data, np.uint8)
        chars -= int(np.count_nonzero((raw & 0xC0) == 0x80))
    symbols = sum(data.count(c.encode()) for c in SYMBOLS)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= 3:
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        windows = (h[:-2] * np.uint64(MIX) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
        order = np.sort(windows)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            at = np.flatnonzero(np.isin(windows, twice))
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[at + k] = True
            repeated = int(np.count_nonzero(covered))
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(batch: pa.RecordBatch, column: str, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: the five measures, the bytes, and the sum of their log probabilities as far as the model holds them."""
    texts = batch[column].cast(pa.binary())
    base = np.array([base_counts(x or b"") for x in texts.to_pylist()], np.int64).reshape(-1, 5)
    data, spans = padded(texts)
    grams = grams_of(data)
    scores = model.score(grams) if model.whole else known(grams, model)
    sums = np.concatenate(([0], np.cumsum(scores)))
    first, last = np.maximum(spans - ORDER + 1, 0).T
    length = spans[:, 1] - spans[:, 0]
    last = np.where(length > 0, last, first)
    return base, length, sums[last] - sums[first]


def known(grams: np.ndarray, model: Model) -> np.ndarray:
    spot = model.find(ORDER, grams)
    return np.where(spot >= 0, model.probs[-1][spot], 0).astype(np.int64) if len(model.probs[-1]) else np.zeros(len(grams), np.int64)


def bands(scores: DataFrame, lang_col: str) -> DataFrame:
    """(lang, low, high): the perplexity bins that a language keeps, from the histogram of all its distinct texts.

    ``scores`` has ``mark``, a hash of the text: copies of a text count once.
    """

    def median(hist: DataFrame, value: str, name: str, half: str) -> DataFrame:
        order = Window.partitionBy("lang").orderBy(value)
        whole = Window.partitionBy("lang")
        steps = hist.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(whole))
        return steps.where(half).groupBy("lang").agg(F.min(value).alias(name), F.max("all").alias("texts"))

    known = scores.where("bin >= 0").select(F.col(lang_col).alias("lang"), "bin", "mark").distinct()
    hist = saved(known.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n")), "kn-bins")
    middle = median(hist, "bin", "middle", "upto * 2 >= all").select(F.col("lang").alias("l"), "middle")
    away = hist.join(middle, F.col("lang").eqNullSafe(F.col("l"))).withColumn("off", F.abs(F.col("bin") - F.col("middle")))
    away = away.groupBy("lang", "off").agg(F.sum("n").alias("n"))
    # the upper median: of two texts, both are inside
    spread = median(away, "off", "mad", "upto * 2 > all")
    pooled = away.groupBy("off").agg(F.sum("n").alias("n")).withColumn("lang", F.lit("all"))
    pooled = median(pooled, "off", "shared", "upto * 2 > all").select("shared")
    floor = F.lit(LEAST_SPREAD * BINS)
    own, shared = (F.col(c) * F.lit(SPREAD * MAD_SCALE) for c in ("mad", "shared"))
    width = F.when((F.col("texts") < FEW_TEXTS) | (own < floor), F.greatest(floor, own, shared)).otherwise(own)
    both = spread.join(middle, F.col("lang").eqNullSafe(F.col("l"))).crossJoin(pooled)
    return both.select("lang", (F.col("middle") - width).alias("low"), (F.col("middle") + width).alias("high"))


def judged(docs: DataFrame, model: Broadcast, text_col: str, keep_columns: list[str], rest: DataFrame | None = None) -> DataFrame:
    """``keep_columns`` plus ``__bin`` and a ``__``-column per measure, for every row.

    ``__bin`` is the log of the perplexity in steps of 1 / BINS (-1: no bytes). ``rest`` are the sums by ``mark``, one of
    ``keep_columns``, that the model leaves open.
    """
    taken = docs.select(*keep_columns, F.col(text_col).cast("string").alias("__text"))

    def run(batches):
        opened = Model(*model.value).opened()
        for batch in slices(batches, "__text", SLICE):
            base, length, total = measured(batch, "__text", opened)
            plain = [batch[i] for i in range(batch.num_columns - 1)]
            extra = [pa.array(base[:, i]) for i in range(5)] + [pa.array(length), pa.array(total)]
            names = [*batch.schema.names[:-1], *[f"__{m}" for m in MEASURES], "__length", "__total"]
            yield pa.RecordBatch.from_arrays([*plain, *extra], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[:-1])
    scored = taken.mapInArrow(run, fields + "".join(f", __{m} bigint" for m in MEASURES) + ", __length bigint, __total bigint")
    if rest is not None:
        own = rest.select(F.col("mark").alias("__mark"), "rest")
        scored = scored.join(own, F.col("mark") == F.col("__mark"), "left")
        scored = scored.withColumn("__total", F.col("__total") + F.coalesce("rest", F.lit(0))).drop("__mark", "rest")
    steps = F.call_function("div", F.col("__total") * -BINS, F.col("__length") * MICRO)
    return scored.withColumn("__bin", F.when(F.col("__length") > 0, steps).otherwise(-1)).drop("__length", "__total")


def verdicts(scored: DataFrame, limits: DataFrame, lang_col: str) -> DataFrame:
    """Add ``__base_failed`` and ``__kept``. A text without bytes, like any of under MIN_WORDS words, fails."""
    failed = (F.col("__n_words") < MIN_WORDS) | (F.col("__n_repeat_words") * 100 > F.col("__n_words") * 50)
    limits = limits.select(F.col("lang").alias("__lang"), F.col("low").alias("__low"), F.col("high").alias("__high"))
    joined = scored.withColumn("__base_failed", failed).join(limits, F.col(lang_col).eqNullSafe(F.col("__lang")), "left")
    inside = F.coalesce(F.col("__bin").between(F.col("__low"), F.col("__high")), F.lit(False))
    return joined.withColumn("__kept", ~F.col("__base_failed") & inside).drop("__lang", "__low", "__high")


def scored_texts(docs: DataFrame, keep_columns: list[str]) -> tuple[DataFrame, DataFrame, Broadcast, DataFrame | None]:
    """Of (…, lang, text): ``keep_columns``, mark and scores of all rows; the bands; the model; the sums that it leaves open."""
    model, tables = learnt(docs, "text")
    own = docs.withColumn("mark", text_mark("text"))
    rest = None if model.value[-1] else saved(open_sums(own.where(F.octet_length("text") > 0), model, tables), "kn-rest")
    scored = saved(judged(own, model, "text", [*keep_columns, "mark"], rest), "kn-scores")
    limits = saved(bands(scored.withColumnRenamed("__bin", "bin"), "lang"), "kn-bands")
    return scored, limits, model, rest


def text_mark(text_col: str):
    return F.xxhash64(F.col(text_col).cast("string"))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang, the measures, perplexity bin, base_failed, kept): one row per input row.

    The model learns from all distinct texts with few symbols; median and spread come from all distinct texts. Null text is an empty one; null lang is a language. No rows: no rows.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
    scored, limits, _, _ = scored_texts(own, ["doc_id", "lang"])
    return verdicts(scored.drop("mark"), limits, "lang")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, all columns unchanged.

    Rows are scored once for the bands and once more as they pass, so no text is stored, nor shuffled unless the tasks'
    model leaves n-grams open.
    """
    docs, new, old = apart(docs)
    text_col, lang_col = new[text_col], new[lang_col]
    own = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
    _, limits, model, rest = scored_texts(own, ["lang"])
    marked = docs.withColumn("mark", text_mark(text_col))
    kept = verdicts(judged(marked, model, text_col, marked.columns, rest), limits, lang_col).where("__kept")
    return kept.select(*docs.columns).toDF(*old)
