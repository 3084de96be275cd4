"""Language-model scores from a hidden Markov model over words.

Words fall into at most CLASSES classes: the most frequent have a class each, the others share classes by their ending.
A state emits a class, a class its words in proportion to their counts. So transition and emission tables have a fixed
size, while the counts of words stay a distributed table that grows with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from logspark.llm.common import saved, slices, text_bytes

STATES = 8
OWN = 8192
ENDINGS = 4096
CLASSES = OWN + ENDINGS
ENDING_BYTES = 3
# counts of the most frequent words travel to every task: at most this many, 12 bytes each
FREQUENT = 1 << 18
END = b"\n"  # cannot be a word
ALPHA = 0.1
# the start tells states apart by so much; the rounds over the corpus do the rest
SPREAD, STAY = 0.9, 30.0
ROUNDS = 4
SLICE = 4 << 20
TRAIN_TOKENS = 1 << 20
# words that a task remembers before it starts anew
WORDS = 1 << 19
SCORE_TOKENS = 1 << 22


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def ending(word: bytes) -> int:
    return OWN + xxhash.xxh32_intdigest(word[-ENDING_BYTES:]) % ENDINGS


def tokens(data: bytes) -> list[bytes]:
    """Words in lower case (A-Z only), then the end token."""
    return [*data.lower().split(), END]


def held_out(id_col: str) -> Column:
    """Documents that the model does not learn from; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def count_words(docs: DataFrame) -> DataFrame:
    """(h, c, cls): count of each distinct token over all training texts, added up in the task before the shuffle."""

    def emit(held: Counter):
        words = list(held)
        for i in range(0, len(words), 100_000):
            part = words[i : i + 100_000]
            columns = [
                pa.array(np.fromiter(map(word_hash, part), np.int64, len(part))),
                pa.array([held[w] for w in part], pa.int64()),
                pa.array([ending(w) for w in part], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["h", "c", "cls"])

    def run(batches):
        held: Counter = Counter()
        for batch in slices(batches, "text", SLICE):
            for text in text_bytes(batch["text"]):
                held.update(tokens(text))
            if len(held) > 400_000:
                yield from emit(held)
                held = Counter()
        yield from emit(held)

    parts = docs.mapInArrow(run, "h bigint, c bigint, cls int")
    return parts.groupBy("h").agg(F.sum("c").alias("c"), F.min("cls").alias("cls"))


def most_frequent(counts: DataFrame) -> pa.Table:
    """Words above the lowest count that at most FREQUENT words reach, the most frequent first.

    The limit comes from a histogram over the logarithm of counts, so no task and no driver sorts all words.
    """
    level = F.floor(F.log2("c") * 16).cast("int")
    hist = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    lowest, words = 1 << 30, 0
    for row in sorted(hist, key=lambda r: -r["level"]):
        words += row["n"]
        if words > FREQUENT:
            break
        lowest = row["level"]
    return counts.where(level >= lowest).select("h", "c").toArrow().sort_by([("c", "descending"), ("h", "ascending")])


class Vocabulary(dict):
    """A number for each word that a task meets, with its class, and its log10 weight if frequent, else its hash.

    A new word only gets its number at first; ``settle`` works out the rest for all new words at once.
    """

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> None:
        super().__init__()
        order = np.argsort(hashes)
        self.top = (hashes[order], np.log10(counts[order] + ALPHA), classes[order])
        self.new: list[bytes] = []
        self.endings: dict[bytes, int] = {}
        self.logs, self.classes, self.rare = np.zeros(0), np.zeros(0, np.uint16), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at

    def settle(self) -> None:
        if not self.new:
            return
        hashes = np.fromiter(map(word_hash, self.new), np.int64, len(self.new))
        for last in {w[-ENDING_BYTES:] for w in self.new} - self.endings.keys():
            self.endings[last] = ending(last)
        classes = np.fromiter((self.endings[w[-ENDING_BYTES:]] for w in self.new), np.int64, len(self.new))
        top_hashes, top_logs, top_classes = self.top
        spot = np.minimum(np.searchsorted(top_hashes, hashes), max(len(top_hashes) - 1, 0))
        known = top_hashes[spot] == hashes if len(top_hashes) else np.zeros(len(hashes), bool)
        at = spot[known]
        logs = np.zeros(len(hashes))
        logs[known] = top_logs[at]
        classes[known] = np.where(top_classes[at] >= 0, top_classes[at], classes[known])
        self.logs = np.concatenate((self.logs, logs))
        self.classes = np.concatenate((self.classes, classes.astype(np.uint16)))
        self.rare = np.concatenate((self.rare, np.where(known, 0, hashes)))
        self.new.clear()


def encode(docs: DataFrame, frequent, class_logs) -> DataFrame:
    """One row per document, written once: its classes in two bytes each, sums over frequent words, and the rare words left.

    ``frequent`` holds hashes, counts and classes (-1: by ending); ``class_logs`` the log10 weight of each class.
    """

    def run(batches):
        logs, known = class_logs.value, Vocabulary(*frequent.value)
        base = TaskContext.get().partitionId() << 33
        row = 0
        for batch in slices(batches, "text", SLICE):
            if len(known) > WORDS:
                known = Vocabulary(*frequent.value)
            texts = [tokens(text) for text in text_bytes(batch["text"])]
            lengths = np.array([len(t) for t in texts])
            ends = np.cumsum(lengths)
            starts = ends - lengths
            at = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.int64, ends[-1])
            del texts
            known.settle()
            sequence, hashes = known.classes[at], known.rare[at]
            rare = hashes != 0
            # each rare word of a document once, with how often it has it
            place = np.repeat(np.arange(len(lengths)), lengths)[rare] * len(known) + at[rare]
            place, times = np.unique(place, return_counts=True)
            doc, word = np.divmod(place, len(known))
            cuts = pa.array(np.searchsorted(doc, np.arange(len(lengths) + 1)).astype(np.int32))
            columns = {
                "uid": pa.array(base + row + np.arange(len(lengths))),
                "n_tokens": pa.array(lengths.astype(np.int64)),
                "n_known": pa.array(np.add.reduceat(~rare, starts, dtype=np.int64)),
                "words_log": pa.array(np.add.reduceat(known.logs[at], starts)),
                "class_log": pa.array(np.add.reduceat(logs[sequence], starts)),
                "classes": pa.array([sequence[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                "rare": pa.ListArray.from_arrays(cuts, pa.array(known.rare[word])),
                "times": pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
            }
            row += len(lengths)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], *columns.values()], ["doc_id", "held_out", *columns])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, uid bigint, n_tokens bigint, n_known bigint, words_log double, class_log double, "
        "classes binary, rare array<bigint>, times array<int>"
    )
    return saved(docs.select("doc_id", "held_out", "text").mapInArrow(run, schema), "hmm-encoded")


def expected_counts(sequences: list[np.ndarray], start, moves, emits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected starts, transitions and emissions of many whole sequences, by scaled forward-backward.

    Sequences are sorted by length, so those that go on at a step are the first ones of the step before; all positions
    lie step by step in one array, and a step is a slice of it.
    """
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    lengths = np.array([len(sequences[i]) for i in order])
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    ends = np.cumsum(active)
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    flat = np.concatenate([sequences[i] for i in order])
    grid = np.empty(len(flat), np.uint16)
    for t, n, end in zip(range(steps), active.tolist(), ends.tolist()):
        grid[end - n : end] = flat[begins[:n] + t]
    k = len(start)
    ahead_of, back = np.ascontiguousarray(moves.T.astype(np.float32)), moves.astype(np.float32)
    # a row for each state: sums over states then run along whole rows
    seen = np.take(emits.astype(np.float32), grid, axis=1)
    alphas, scales = np.empty_like(seen), np.empty(len(grid), np.float32)
    alpha = np.broadcast_to(start.astype(np.float32)[:, None], (k, active[0]))
    for t, n, end in zip(range(steps), active.tolist(), ends.tolist()):
        here = slice(end - n, end)
        alpha = (ahead_of @ alpha[:, :n] if t else alpha) * seen[:, here]
        scale = alpha.sum(0)
        alpha /= scale
        alphas[:, here], scales[here] = alpha, scale
    seen /= scales
    pairs = np.zeros((k, k))
    beta = np.ones((k, active[-1]), np.float32)
    for t in range(steps - 1, -1, -1):
        n, end = int(active[t]), int(ends[t])
        if beta.shape[1] < n:  # sequences that end here
            beta = np.concatenate((beta, np.ones((k, n - beta.shape[1]), np.float32)), axis=1)
        here = slice(end - n, end)
        if t:
            ahead = seen[:, here] * beta
            before = end - n - int(active[t - 1])
            pairs += alphas[:, before : before + n] @ ahead.T
        alphas[:, here] *= beta  # what was seen there, from here on
        if t:
            beta = back @ ahead
    weights = np.stack([np.bincount(grid, row, minlength=emits.shape[1]) for row in alphas])
    return alphas[:, : active[0]].sum(1, dtype=np.float64), moves * pairs, weights


def log_likelihoods(sequences: list[np.ndarray], start, moves, emits) -> np.ndarray:
    """Exact log10 probability of each whole sequence, by scaled forward recursion."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    lengths = np.array([len(sequences[i]) for i in order])
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
    flat = np.concatenate([sequences[i] for i in order])
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    by_class = np.ascontiguousarray(emits.T)
    total = np.zeros(len(order))
    alpha = None
    for t, n in enumerate(active):
        seen = by_class[flat[begins[:n] + t]]
        alpha = (start if alpha is None else alpha[:n] @ moves) * seen
        scale = alpha.sum(1)
        total[:n] += np.log10(scale)
        alpha = alpha / scale[:, None]
    out = np.empty(len(order))
    out[order] = total
    return out


def smoothed(start, moves, emits, prior) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities from expected counts; each class keeps a share of its overall frequency in every state."""
    start, moves = start + 1.0, moves + 1.0
    emits = emits + 100.0 * prior
    return start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(1, keepdims=True)


def grouped(parts: Iterable[np.ndarray], limit: int) -> Iterator[list[np.ndarray]]:
    """Lists of sequences of about ``limit`` tokens."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def seeded_start(prior: np.ndarray):
    """The model before the first round: every state sees the classes as often as the corpus has them, slightly changed
    at random, and rather stays than moves."""
    rng = np.random.default_rng(7)
    emits = prior * rng.uniform(1 - SPREAD, 1 + SPREAD, (STATES, CLASSES))
    return smoothed(np.ones(STATES), rng.uniform(0.5, 1.5, (STATES, STATES)) + STAY * np.eye(STATES), 1e5 * emits, prior)


def baum_welch_round(encoded: DataFrame, model, prior: np.ndarray):
    """One round over all training documents, each whole: each task sends its expected counts, Spark adds them up.

    Counts travel in millionths, as integers, so the sums do not depend on the order of tasks.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        sums = None
        texts = (np.frombuffer(data, np.uint16) for batch in batches for data in batch["classes"].to_pylist())
        for part in grouped(texts, TRAIN_TOKENS):
            got = expected_counts(part, *shared.value)
            sums = got if sums is None else [a + b for a, b in zip(sums, got)]
        if sums is not None:
            whole = np.round(np.concatenate((sums[2].T, sums[1], sums[0][None])) * 1e6).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(whole), dtype=np.int32)), *map(pa.array, whole.T)], names)

    names = ["row", *[f"s{i}" for i in range(STATES)]]
    parts = encoded.where("NOT held_out").select("classes").mapInArrow(run, "row int" + "".join(f", {n} bigint" for n in names[1:]))
    sums = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names[1:]]).orderBy("row").toArrow()
    if not sums.num_rows:
        return model
    table = np.stack([sums[n].to_numpy() for n in names[1:]], 1) / 1e6
    return smoothed(table[-1], table[CLASSES:-1], table[:CLASSES].T, prior)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): a row per input row, repeats included.

    ``score`` is the log10 probability of the whole text under the model, ``base_score`` under smoothed word counts.
    Null and empty texts are the end token alone. Without any training document all words are unknown. No rows: no rows.
    Counts of all but the most frequent words are joined by word; those of the frequent ones, a third of all rows or
    more, are known to every task, so no task gets a hot word's rows.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    counts = saved(count_words(own.where("NOT held_out").select("text")), "hmm-counts")
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = whole["n"], whole["v"]
    top = most_frequent(counts)
    ranked = np.where(np.arange(top.num_rows) < OWN, np.arange(top.num_rows), -1)
    own_hashes = spark.createDataFrame([(int(h),) for h in top["h"].to_numpy()[:OWN]], "h bigint")
    rest = counts.join(F.broadcast(own_hashes), "h", "left_anti")
    shared_classes = rest.groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    class_counts, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    class_counts[: min(OWN, top.num_rows)] = top["c"].to_numpy()[:OWN]
    for r in shared_classes:
        class_counts[r["cls"]], class_words[r["cls"]] = r["c"], r["v"]
    # log10 of what a word's (count + ALPHA) is divided by inside its class; a class of one word gives it all
    class_logs = np.log10(np.where(np.arange(CLASSES) < OWN, class_counts + ALPHA, class_counts + ALPHA * (class_words + 1)))
    prior = class_counts + 1.0 * (np.arange(CLASSES) >= OWN)
    prior = prior / prior.sum()
    context = spark.sparkContext
    frequent = context.broadcast((top["h"].to_numpy(), top["c"].to_numpy(), ranked))
    encoded = encode(own, frequent, context.broadcast(class_logs))
    model = seeded_start(prior)
    for _ in range(ROUNDS):
        model = baum_welch_round(encoded, model, prior)
    final = context.broadcast(model)

    def forward(batches):
        for batch in batches:
            logs = []
            parts = [np.frombuffer(x, np.uint16) for x in batch["classes"].to_pylist()]
            for part in grouped(parts, SCORE_TOKENS):
                logs.append(log_likelihoods(part, *final.value))
            yield pa.RecordBatch.from_arrays([batch["uid"], pa.array(np.concatenate(logs))], ["uid", "path_log"])

    paths = encoded.select("uid", "classes").mapInArrow(forward, "uid bigint, path_log double")
    rare = encoded.select("uid", F.inline(F.arrays_zip("rare", "times"))).withColumnRenamed("rare", "h")
    missing = float(np.log10(ALPHA))
    rare = (
        rare.join(counts.select("h", "c"), "h", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.coalesce(F.log10(F.col("c") + ALPHA), F.lit(missing))).alias("rare_log"),
        )
    )
    joined = encoded.drop("classes", "rare", "times").join(paths, "uid").join(rare, "uid", "left")
    words = F.col("words_log") + F.coalesce("rare_log", F.lit(0.0))
    share = float(np.log10(n + ALPHA * (v + 1)))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (words - F.col("n_tokens") * F.lit(share)).alias("base_score"),
        (words - F.col("class_log") + F.col("path_log")).alias("score"),
    )
