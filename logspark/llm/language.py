"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else parts words. The n-grams of 1 to ORDER characters within a word, its two edges
counted as characters, fall into BUCKETS slots. Spark adds up the slots of all training texts; the log probabilities
of a slot in each language are one small matrix, which is broadcast, and a batch of texts is scored in numpy by
adding up the rows of its n-grams. Log probabilities are whole millionths, so sums do not depend on their order.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from logspark.llm.common import slices

ORDER = 3
# a prime, so that the remainder mixes all characters of an n-gram
BUCKETS = 131_071
FACTORS = (1, 1_000_003, 998_244_353)
MICRO = 1_000_000
SMOOTHING = 1.0
SLICE = 1 << 20
UNDETERMINED = "und"
# the matrix grows with the labels, which are languages; more of them than this is a wrong column, and an error
MAX_LANGS = 500


class Folding:
    """Code points to the lower-case letter, or 0 for what is not a letter; filled as characters are met."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, -1, np.int64)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        folded = self.table[points]
        new = np.unique(points[folded < 0])
        if len(new):
            self.table[new] = [self.fold(chr(c)) for c in new.tolist()]
            folded = self.table[points]
        return folded

    @staticmethod
    def fold(char: str) -> int:
        if unicodedata.category(char)[0] != "L":
            return 0
        low = char.lower()
        return ord(low) if len(low) == 1 else ord(char)


def joined(texts: list[str], fold: Folding) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of all texts, each behind an edge, one more at the end; and where each text's edge is."""
    points = np.frombuffer(("\0" + "".join(t + "\0" for t in texts)).encode("utf-32-le", "replace"), np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])[:-1])).astype(np.int64)
    return fold(points), starts


def grams_of(folded: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The slot of the n-gram that starts at each character but the last, and whether it is one: within a word."""
    size = len(folded) - 1
    part = np.zeros(size + order, np.int64)
    part[: size + 1] = folded
    value = np.full(size, order, np.int64)
    valid = part[:size] > 0 if order == 1 else (part[:size] > 0) | (part[1 : size + 1] > 0)
    for k in range(order):
        value += part[k : k + size] * FACTORS[k]
        if 0 < k < order - 1:
            valid &= part[k : k + size] > 0
    # an n-gram may end at the last edge, not behind it
    valid[size - order + 2 :] = False
    return value % BUCKETS, valid


def texts_of(column: pa.Array) -> list[str]:
    return [(x.decode("utf-8", "replace") if x else "") for x in column.cast(pa.binary()).to_pylist()]


def is_held_out(id_col: str) -> Column:
    """Whether a document is not learnt from; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def slot_counts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, slot, n) over all of ``docs``; slot -1 counts the documents. A task adds up before anything is shuffled."""

    def run(batches):
        fold, sums, seen = Folding(), {}, {}
        for batch in slices(batches, "text", SLICE):
            texts = texts_of(batch["text"])
            groups: dict[str, list[str]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), texts):
                groups.setdefault(lang, []).append(text)
            for lang, own in groups.items():
                counts = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                seen[lang] = seen.get(lang, 0) + len(own)
                folded, _ = joined(own, fold)
                for order in range(1, ORDER + 1):
                    slot, valid = grams_of(folded, order)
                    counts += np.bincount(slot[valid], minlength=BUCKETS)
        for lang, counts in sums.items():
            full = np.flatnonzero(counts)
            slots = np.concatenate(([-1], full))
            n = np.concatenate(([seen[lang]], counts[full]))
            for i in range(0, len(slots), 10_000):
                part = slice(i, i + 10_000)
                langs = pa.array([lang] * len(slots[part]), pa.string())
                yield pa.RecordBatch.from_arrays([langs, pa.array(slots[part]), pa.array(n[part])], ["lang", "slot", "n"])

    taken = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = taken.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "lang string, slot bigint, n bigint")
    return parts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Broadcast:
    """Broadcast (languages in order, log priors, matrix of log probabilities by slot and language), all in millionths.

    Learns from all rows with text and lang. At most BUCKETS + 1 numbers a language come to the driver.
    """
    counts = slot_counts(docs, lang_col, text_col).toArrow()
    names = counts["lang"].to_pylist()
    langs = sorted(set(names), key=lambda s: s.encode())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"{len(langs)} different values of {lang_col}; languages are at most {MAX_LANGS}")
    where = {lang: i for i, lang in enumerate(langs)}
    row = np.array([where[x] for x in names], np.int64)
    slot, n = counts["slot"].to_numpy(), counts["n"].to_numpy()
    grid, texts = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    head = slot < 0
    texts[row[head]] = n[head]
    grid[slot[~head], row[~head]] = n[~head]
    micro = lambda x: np.round(np.log(x) * MICRO)
    matrix = micro((grid + SMOOTHING) / (grid.sum(0) + SMOOTHING * BUCKETS)).astype(np.int32)
    priors = micro(texts / max(texts.sum(), 1)).astype(np.int64)
    return docs.sparkSession.sparkContext.broadcast((langs, priors, matrix))


def predict(docs: DataFrame, model: Broadcast, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score``, the probability of that language among the learnt ones.

    A text that is null or has no letters, or a model of no texts, gives ``und`` and 0. Of equal languages the first by
    code point is taken. Rows that repeat get the same result. Columns of these names give way. No rows: no rows.
    """
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    names = [f"c{i}" for i in range(len(others))]
    taken = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(others, names)], F.col(f"`{text_col}`").cast("string").alias("text"))
    kinds = dict(taken.dtypes)

    def run(batches):
        langs, priors, matrix = model.value
        fold = Folding()
        for batch in slices(batches, "text", SLICE):
            folded, starts = joined(texts_of(batch["text"]), fold)
            sums, grams = np.zeros((len(starts), len(langs)), np.int64), np.zeros(len(starts), np.int64)
            for order in range(1, ORDER + 1) if langs else ():
                slot, valid = grams_of(folded, order)
                rows = matrix[slot]
                rows[~valid] = 0
                sums += np.add.reduceat(rows, starts, axis=0, dtype=np.int64)
                if order == 1:
                    grams = np.add.reduceat(valid, starts, dtype=np.int64)
            known = grams > 0
            total = sums + priors
            best = total.argmax(1) if langs else np.zeros(len(starts), np.int64)
            gaps = (total - total.max(1, keepdims=True)) / MICRO if langs else np.zeros((len(starts), 1))
            score = np.where(known, 1 / np.exp(gaps).sum(1), 0.0)
            found = [langs[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
            kept = [batch[i] for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    fields = "".join(f"`{c}` {kinds[c]}, " for c in names)
    out = taken.mapInArrow(run, f"{fields}lang_pred string, score double")
    return out.toDF(*others, "lang_pred", "score")
