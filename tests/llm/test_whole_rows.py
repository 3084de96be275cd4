"""Rows that share a key, a null id or a text are each judged and returned."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from logspark.llm import near_copies, perplexity, simhash, warc
from logspark.session import scratch_path
from test_operators import docs_of, first_of_groups, words_of


def test_equal_records_of_one_bundle_are_all_read(spark):
    rows = [(1, "u", "page"), (1, "u", "page"), (None, "v", None), (None, "w", None), (None, "x", ""), (2, "u", "other")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    path = scratch_path(spark, "test-warc-equal")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).select("page_id", "url").collect()
    assert Counter(map(tuple, got)) == Counter((i, url) for i, url, _ in rows)


def test_copies_of_a_text_do_not_move_the_band_of_their_language(spark):
    texts = [" ".join(w + "ing" for w in words_of(i, 60 + i).split()) for i in range(60)]
    once = [(i, t) for i, t in enumerate(texts)]
    copied = once + [(1000 + i, texts[0]) for i in range(100)]
    two = [(5000, texts[1].replace("w1", "x1"), "xx", "s"), (5001, texts[2].replace("w", "é"), "xx", "s")]
    kept = {r["doc_id"] for r in perplexity.assess(docs_of(spark, copied + two)).where("__kept").collect()}
    assert kept == {i for i, *_ in copied + two}


def test_near_copies_are_the_groups_of_all_pairs_at_the_level(spark, monkeypatch):
    import corpus_pipeline

    rng, rows = random.Random(4), []
    for g in range(12):
        base = words_of(g, 150, 5000).split()
        for edits in (0, 1, 2, 3, 4, 6, 9):
            words = list(base)
            for k in range(edits):
                words[rng.randrange(150)] = f"new{g}-{edits}-{k}"
            rows.append((len(rows), " ".join(words)))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if x == high else x for x in group]
    want = [i for i in range(len(rows)) if group[i] == i]
    docs = docs_of(spark, rows)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == want
    monkeypatch.setattr(near_copies, "SMALL_BUCKET", 1)
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == want


def test_each_near_duplicate_group_keeps_a_row_whatever_its_id(spark):
    a, b, c, d = (words_of(seed, 80) for seed in (1, 2, 3, 4))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (8, c), (None, d)]
    for operator in (simhash, near_copies):
        kept = operator.keep_one(docs_of(spark, rows)).collect()
        assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(None, a), (None, b), (7, c), (7, d)])


@pytest.mark.parametrize("copies", [300, 90])
def test_crowded_bands_lose_no_link(spark, copies):
    """Copies of one text with more and more edits: some link only through others, some not at all."""
    rng = random.Random(copies)
    base = words_of(50, 200, 5000).split()
    texts = []
    for i in range(copies):
        words = list(base)
        for k in range(rng.choice([0, 1, 2, 4, 6, 8, 10, 12])):
            words[rng.randrange(200)] = f"new{i}-{k}"
        texts.append(" ".join(words))
    want = first_of_groups(texts)
    assert 5 < len(want) < copies - 5
    docs = docs_of(spark, list(enumerate(texts)))
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == want


def test_members_outside_the_largest_group_meet_by_rare_shingles(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SMALL_BUCKET", 2)
    texts = [words_of(s, 120, 5000).rsplit(" ", k)[0] for s in range(4) for k in range(1, 8)]
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs_of(spark, list(enumerate(texts)))).collect()) == first_of_groups(texts)


def test_equal_signatures_alone_make_no_near_copies(spark):
    """A short text made of the shingles that give a long one its signature, joined so that none is smaller."""
    a = words_of(9, 3000, 4000).split()
    windows = list(near_copies.shingles(" ".join(a).encode()))[0]
    values = windows[:, None] * near_copies.FACTORS + near_copies.TERMS
    least, rng = values.min(0), random.Random(3)
    small = lambda words: any(
        ((x[:, None] * near_copies.FACTORS + near_copies.TERMS) < least).any() for x in near_copies.shingles(" ".join(words).encode())
    )
    b: list[str] = []
    for i in sorted(set(values.argmin(0).tolist())):
        part = a[i : i + 5]
        while small(b[-4:] + part):
            part = [f"x{rng.randrange(10**9)}", *a[i : i + 5]]
        b += part
    texts = [" ".join(a), " ".join(b)]
    assert first_of_groups(texts) == [0, 1]
    docs = docs_of(spark, list(enumerate(texts)))
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == [0, 1]
