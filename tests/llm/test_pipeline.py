"""Each stage of the corpus pipeline on the smallest documents, against plain versions of its decision."""

from __future__ import annotations

import os
from collections import Counter

import pytest

import corpus_pipeline
from logspark.llm import perplexity
from logspark.llm.common import saved
from test_operators import first_of_groups, slow_targets

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def steps(spark):
    """The documents, and what each stage makes of what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def plain_base_failed(text: str) -> bool:
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return len(words) < 50 or 100 * len(repeated) > 50 * len(words)


def test_stages_return_the_columns_of_documents(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "to_pieces"]
    assert all(step.schema == steps[0].schema for step in steps[1:-1])


def test_quality_keeps_what_the_operator_keeps(steps):
    before = steps[0].collect()
    verdict = {r["doc_id"]: r["kept"] for r in perplexity.assess(steps[0]).select("doc_id", "__kept").toDF("doc_id", "kept").collect()}
    kept = steps[1].collect()
    assert sorted(kept) == sorted(r for r in before if verdict[r["doc_id"]])
    assert kept and not any(plain_base_failed(r["text"]) for r in kept)
    fair = [r for r in before if not plain_base_failed(r["text"])]
    assert len(kept) >= 0.7 * len(fair)


def test_line_dedup_cuts_only_lines_of_earlier_documents(steps):
    before = sorted(steps[1].collect(), key=lambda r: r["doc_id"])
    after = {r["doc_id"]: r for r in steps[2].collect()}
    seen: set[str] = set()
    changed = 0
    for r in before:
        lines = r["text"].split("\n")
        left = after.get(r["doc_id"])
        kept = left["text"].split("\n") if left else []
        gone = Counter(lines) - Counter(kept)
        rest = iter(lines)
        assert all(x in rest for x in kept)
        assert set(gone) <= seen | {""}
        if left and not gone:
            assert left == r
        elif left:
            changed += 1
            assert left["n_chars"] == len(left["text"])
        seen.update(lines)
    assert changed


def test_near_dedup_keeps_the_first_of_each_group_of_all_pairs(steps):
    """Every pair of texts compared by its sets of five-word shingles, at the stage's real parameters."""
    rows = sorted(steps[2].collect(), key=lambda r: r["doc_id"])
    want = first_of_groups([r["text"] for r in rows])
    assert sorted(steps[3].collect()) == [rows[i] for i in want]


def test_mix_meets_the_targets(steps):
    rows, mixed = steps[3].collect(), steps[4].collect()
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in rows}
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s))
    whole = {s: sum(size[r["doc_id"]] for r in rows if r["source"] == s) for s in sources}
    want = slow_targets({s: (whole[s], (3, 1, 2)[i % 3]) for i, s in enumerate(sources)}, 1.5, 2.0)
    often = Counter(mixed)
    assert set(often) <= set(rows) and max(often.values()) <= 2
    for s in sources:
        taken = sum(size[r["doc_id"]] * n for r, n in often.items() if r["source"] == s)
        assert abs(taken - want[s]) <= max(size[r["doc_id"]] for r in rows if r["source"] == s)


def test_pieces_are_lossless_and_equal_for_repetitions(steps):
    mixed, cut = Counter(r["doc_id"] for r in steps[4].collect()), steps[5].collect()
    assert Counter(r["doc_id"] for r in cut) == mixed
    assert all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in cut)
    forms: dict = {}
    for r in cut:
        assert forms.setdefault(r["doc_id"], r["ids"]) == r["ids"]
