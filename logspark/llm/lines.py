"""Line dedup by pairwise alignment: documents that share a rare line are aligned, and the later one gives up what is common."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import WORD, apart, saved

# a line of fewer words is too common to tell that two documents overlap; it can still be part of an aligned block
ANCHOR_WORDS = 5
# aligned blocks of fewer words stay
BLOCK_WORDS = 50


def patience(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (i, j) of equal lines in both orders: lines that are unique on both sides, in their longest common order,
    split the texts; between two such anchors, equal lines are taken from both ends, and the rest is split again."""
    pairs: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        left, right = single(a, a0, a1), single(b, b0, b1)
        both = [(i, right[x]) for x, i in left.items() if x in right]
        anchors = longest_rising(both)
        if not anchors:
            continue
        at_a, at_b = a0, b0
        for i, j in anchors:
            pairs.append((i, j))
            work.append((at_a, i, at_b, j))
            at_a, at_b = i + 1, j + 1
        work.append((at_a, a1, at_b, b1))
    return pairs


def leftovers(a: np.ndarray, b: np.ndarray, anchor: np.ndarray, done: np.ndarray) -> None:
    """Mark in ``done`` the lines of ``b`` that an alignment has left out though they stand in ``a`` in the same run.

    A block that has changed places, and one that ``a`` holds more than once, is no part of the alignment. Each anchor
    line left takes the place in ``a`` from which most lines agree, those before it included.
    """
    left = np.flatnonzero(~done & anchor)
    left = left[np.isin(b[left], a)]
    if not len(left):
        return
    order = np.argsort(a, kind="stable")
    ordered = a[order]
    for j in left.tolist():
        if done[j]:
            continue
        spots = order[np.searchsorted(ordered, b[j], "left") : np.searchsorted(ordered, b[j], "right")]
        n = 1
        while j + n < len(b):
            longer = spots[spots + n < len(a)]
            longer = longer[a[longer + n] == b[j + n]]
            if not len(longer):
                break
            spots, n = longer, n + 1
        i, before = int(spots[0]), 0
        while before < min(i, j) and a[i - before - 1] == b[j - before - 1]:
            before += 1
        done[j - before : j + n] = True


def single(lines: np.ndarray, start: int, stop: int) -> dict[int, int]:
    """Lines that occur once in the range, and where; in order."""
    found: dict[int, int] = {}
    for i in range(start, stop):
        x = int(lines[i])
        found[x] = -1 if x in found else i
    return {x: i for x, i in found.items() if i >= 0}


def longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence with rising second part, by patience sorting; the first parts rise already."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[pile], at[pile] = j, k
    out = []
    k = at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, hashes, words): per document the hash and the number of words of each line, written once.

    Rows that repeat id and text are one document.
    """
    key = F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"))
    split = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n")
    lines = docs.select(key.alias("key"), split.alias("lines"))
    hashes = F.transform("lines", lambda x: F.xxhash64(x))
    words = F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD)))
    return saved(lines.select("key", hashes.alias("hashes"), words.alias("words")).dropDuplicates(["key"]), "lines")


def overlaps(lines: DataFrame) -> DataFrame:
    """(later, first): each document with the first document of every anchor line that it shares, and of every two
    anchor lines that follow each other in both.

    At most two pairs a line, however many documents share it, so pairs grow with the lines alone. Every shared line is
    in some pair of its document; the second kind finds the document that has a block whole where its lines first came
    in several.
    """
    known = F.filter(F.arrays_zip("hashes", "words"), lambda x: x["words"] >= ANCHOR_WORDS)
    lone = F.transform(known, lambda x: x["hashes"])
    both = F.transform("lone", lambda x, i: F.when(i > 0, F.xxhash64(x, F.get("lone", i - 1))))
    anchors = lines.select("key", lone.alias("lone"))
    anchors = anchors.select("key", F.explode(F.concat("lone", F.array_compact(both))).alias("h"))
    first = anchors.groupBy("h").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last")
    pairs = anchors.join(first.select("h", "first"), "h").where("first <> key")
    return pairs.select(F.col("key").alias("later"), "first").distinct()


def covered(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(later, spots): the line numbers of a document that are aligned with an earlier one."""
    ours = lines.select(F.col("key").alias("later"), F.col("hashes").alias("b"), F.col("words").alias("n"))
    theirs = lines.select(F.col("key").alias("first"), F.col("hashes").alias("a"))
    both = pairs.join(ours, "later").join(theirs, "first").select("later", "a", "b", "n")

    def align(batches):
        for batch in batches:
            spots = []
            for a, b, n in zip(batch["a"], batch["b"], batch["n"]):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                done = np.zeros(len(b), bool)
                done[[j for _, j in patience(a, b)]] = True
                leftovers(a, b, n.values.to_numpy() >= ANCHOR_WORDS, done)
                spots.append(np.flatnonzero(done).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch["later"], pa.array(spots, pa.list_(pa.int32()))], ["later", "spots"])

    aligned = both.mapInArrow(align, f"later {lines.schema['key'].dataType.simpleString()}, spots array<int>")
    return aligned.groupBy("later").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spots")))).alias("spots"))


def common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, spots): the lines to delete. Aligned lines that follow each other are a block; it goes if it has at least
    BLOCK_WORDS words. Blocks may be covered by several earlier documents together."""
    lines = line_table(docs, id_col, text_col)
    spots = covered(lines, overlaps(lines))

    def blocks(batches):
        for batch in batches:
            out = []
            for found, words in zip(batch["spots"], batch["words"]):
                at = found.values.to_numpy()
                n = words.values.to_numpy()
                sizes = n[at]
                starts = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1))) if len(at) else np.zeros(0, np.int64)
                sums = np.add.reduceat(sizes, starts) if len(at) else sizes
                lengths = np.diff(np.append(starts, len(at)))
                out.append(at[np.repeat(sums >= BLOCK_WORDS, lengths)].tolist() if len(at) else [])
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(out, pa.list_(pa.int32()))], ["key", "spots"])

    joined = spots.join(lines.select("key", "words"), F.col("later") == F.col("key")).select("key", "spots", "words")
    kind = lines.schema["key"].dataType.simpleString()
    return joined.mapInArrow(blocks, f"key {kind}, spots array<int>").where(F.size("spots") > 0)


def cut_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus __deleted (numbers of the lines that go) and __left (the text without them).

    Documents are earlier by smaller id, nulls last, then by the hash of the text. Nothing to delete: the text as it is,
    null included. A text all of whose lines go becomes empty. Rows that repeat id and text are one document and treated
    alike. No rows: no rows.
    """
    docs, new, old = apart(docs, ("__deleted", "__left"))
    id_col, text_col = new[id_col], new[text_col]
    spots = saved(common_lines(docs, id_col, text_col), "lines-deleted")
    gone = spots.select(
        F.col("key.id").alias("__id"), F.col("key.mark").alias("__mark"), F.col("spots").alias("__deleted")
    )
    # always a merge join: the plan, and what is shuffled, is then the same at every size
    marked = docs.hint("merge").join(
        gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__mark")), "left"
    )
    split = F.split(text_col, "\n")
    # the numbers of the lines that stay, by one look at each, however many go
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__deleted"))
    marked = marked.withColumn("__lines", F.when(F.col("__deleted").isNotNull(), split))
    left = F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n")
    left = F.when(F.col("__deleted").isNull(), F.col(text_col)).otherwise(left).alias("__left")
    return marked.select(*docs.columns, "__deleted", left).toDF(*old, "__deleted", "__left")
