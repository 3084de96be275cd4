"""Stretches of a text in which the same words come round again and again, and the text with one round of each left.

A run is a stretch of consecutive words with a smallest period ``q`` (words q apart are equal), at least
max(MIN_LENGTH, MIN_ROUNDS * q) long, which no neighbouring word continues. Each word of a run occurs in it MIN_ROUNDS
times or more, so a word that is rarer than this within a segment belongs to no run there and splits the segment.
This goes on until no segment changes; short segments go. Most prose is gone by then.

What is left is scanned lag by lag. At lag q the equal words of a run are at least 2q in a row, so two neighbouring
multiples of q are among them: looking at the multiples of each lag, m log m places in all, finds every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import apart, slices

MIN_LENGTH = 24
MIN_ROUNDS = 3
SLICE = 4 << 20
# grid places looked at in one go
PLACES = 1 << 16

Run = tuple[int, int, int]


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal words the same one."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of what is left once rare words have split the text to stability, in order."""
    done: list[tuple[int, int]] = []
    at = np.arange(len(ids))
    part = np.zeros(len(ids), np.int64)
    base = int(ids.max()) + 1 if len(ids) else 1
    while len(at) >= MIN_LENGTH:
        _, spot, count = np.unique(part * base + ids[at], return_inverse=True, return_counts=True)
        rare = count[spot] < MIN_ROUNDS
        stable = np.bincount(part, rare, part[-1] + 1) == 0
        if stable.any():
            for k in np.flatnonzero(stable):
                lo, hi = np.searchsorted(part, (k, k + 1))
                done.append((int(at[lo]), int(at[hi - 1]) + 1))
        left = ~rare & ~stable[part]
        at, part = at[left], part[left]
        if not len(at):
            break
        new = np.concatenate(([False], (np.diff(at) != 1) | (np.diff(part) != 0)))
        part = np.cumsum(new)
        long = np.bincount(part) >= MIN_LENGTH
        keep = long[part]
        at, part = at[keep], (np.cumsum(long) - 1)[part[keep]]
    return sorted(done)


def equal_for(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries of two arrays of one length are equal; what is compared doubles from step to step."""
    done, step = 0, 32
    while done < len(a):
        differ = a[done : done + step] != b[done : done + step]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done += step
        step *= 2
    return len(a)


def places(m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) for every multiple of each lag with two more behind it, about PLACES at a time, lags in order."""
    most = m // MIN_ROUNDS
    first = 1
    while first <= most:
        count, last = 0, first
        while last <= most and (not count or count + m // last <= PLACES):
            count += m // last
            last += 1
        lags = np.arange(first, last)
        each = (m - 1) // lags - 1
        lag = np.repeat(lags, each)
        ends = np.cumsum(each)
        yield (np.arange(len(lag)) - np.repeat(ends - each, each)) * lag, lag
        first = last


def scan(ids: np.ndarray) -> list[Run]:
    """(start, length, period) of the runs of one segment."""
    m = len(ids)
    found: list[Run] = []
    # the furthest end of the runs found so far that cover a word
    reach = np.zeros(m, np.int64)
    for place, lag in places(m):
        hit = (ids[place] == ids[place + lag]) & (ids[place + lag] == ids[place + 2 * lag])
        hit &= reach[place] <= place + 2 * lag
        at, by = place[hit].tolist(), lag[hit].tolist()
        past, of = 0, 0
        for i, q in zip(at, by):
            # a run of a shorter period that covers all three places holds this one; so does the last of this lag
            if q == of and i < past or reach[i] > i + 2 * q:
                continue
            right = equal_for(ids[i : m - q], ids[i + q :])
            if right <= q:
                continue
            left = equal_for(ids[:i][::-1], ids[q : i + q][::-1])
            start, length = i - left, left + right + q
            past, of = i + right, q
            if length >= max(MIN_LENGTH, MIN_ROUNDS * q):
                found.append((start, length, q))
                np.maximum(reach[start : start + length], start + length, out=reach[start : start + length])
    return found


def runs_of(words: list[bytes]) -> list[Run]:
    """(start, length, period) of all runs, by start, then period."""
    if len(words) < MIN_LENGTH:
        return []
    ids = numbered(words)
    return sorted((lo + s, n, q) for lo, hi in segments(ids) for s, n, q in scan(ids[lo:hi]))


def strongest(runs: list[Run]) -> Run | None:
    """The run with most rounds, fractions compared exactly; the first and shorter-periodic of equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those behind the first round of any run, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0))


RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, plus ``runs`` (array), ``best`` (the strongest, or null) and ``collapsed``.

    One row per input row, rows that repeat included; each text is looked at alone and whole, whatever its length. A
    null, empty or blank text has no runs, and the empty text is left of it. Columns of ``docs`` with one of the three
    names give way to them. No rows: no rows.
    """
    picked, new, old = apart(docs, ("runs", "best", "collapsed"))
    others = [new[c] for c in old if c != text_col]
    taken = picked.select(*others, F.col(new[text_col]).cast("string").alias("text"))
    kinds = dict(taken.dtypes)

    def run(batches):
        for batch in slices(batches, "text", SLICE):
            runs, best, left = [], [], []
            for text in batch["text"].cast(pa.binary()):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                found = runs_of(words)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                top = strongest(found)
                best.append(dict(zip(("start", "length", "period"), top)) if top else None)
                left.append(collapsed(words, found))
            kept = [batch[i] for i in range(batch.num_columns - 1)]
            made = [pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*others, "runs", "best", "collapsed"])

    fields = [f"`{c}` {kinds[c]}" for c in others]
    out = taken.mapInArrow(run, ", ".join([*fields, f"runs array<{RUN}>", f"best {RUN}", "collapsed string"]))
    return out.select(*[F.col(new[c]).alias(c) for c in old if c != text_col], "runs", "best", "collapsed")
