"""Periodic runs, language identification and ranked search against plain versions, and on odd inputs."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from compare import check, duck
from logspark.llm import language, lexical, periodic, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, runs string, score string, `item` string"


def docs_of(spark, rows):
    """Documents from (doc_id, text[, lang]), with columns of names that the operators use or return."""
    return spark.createDataFrame([(*r, *(("en",) if len(r) == 2 else ()), "x", "y", "z") for r in rows], SCHEMA)


@pytest.mark.parametrize("name", ["op11_periodic", "op12_language", "op13_lexical"])
def test_queries_equal_their_sql(spark, name):
    assert check(spark, duck(SMALL), name, queries.QUERIES[name], queries.ORACLES[name], SMALL) is None


# Periodic runs


def slow_runs(words):
    """Every lag over the whole text."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def repeating(rng, n, vocabulary):
    words = [b"%d" % rng.randrange(vocabulary) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 3:
            p, a = rng.randrange(1, max(2, n // 3)), rng.randrange(n)
            for i in range(a, rng.randrange(a, n + 1)):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_a_scan_of_every_lag(monkeypatch):
    rng, seen = random.Random(3), 0
    for round_ in range(3000):
        monkeypatch.setattr(periodic, "PLACES", rng.choice([1, 50, 1 << 16]))
        words = repeating(rng, rng.randrange(170), rng.choice([1, 2, 3, 5, 9, 40]))
        want = slow_runs(words)
        seen += len(want)
        assert periodic.runs_of(words) == want
    assert seen > 500


def test_segments_hold_every_run_and_only_frequent_words():
    rng = random.Random(4)
    for _ in range(300):
        words = repeating(rng, 400, 60)
        parts = periodic.segments(periodic.numbered(words))
        assert all(b - a >= 24 and min(Counter(words[a:b]).values()) >= 3 for a, b in parts)
        assert all(any(a <= s and s + n <= b for a, b in parts) for s, n, _ in slow_runs(words))


def test_the_strongest_run_is_compared_exactly():
    assert periodic.strongest([(0, 300, 100), (500, 24, 8), (900, 30, 10)]) == (0, 300, 100)
    assert periodic.strongest([(0, 30, 10), (40, 25, 8)]) == (40, 25, 8)
    assert periodic.strongest([]) is None


def test_long_uniform_texts_take_little_time():
    words = [b"a", b"b", b"c"] * 60_000
    assert periodic.runs_of(words) == [(0, 180_000, 3)]
    assert periodic.collapsed(words, [(0, 180_000, 3)]) == b"a b c"


def test_odd_texts_have_no_runs_and_lose_nothing(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (5, "a b"), (5, "a b"), (6, "x" * 100_000), (7, "la " * 30), (8, "é  ü\t" * 12)]
    found = periodic.find_runs(docs_of(spark, rows)).orderBy("doc_id", "collapsed").collect()
    assert [(r["doc_id"], len(r["runs"]), r["collapsed"]) for r in found] == [
        (None, 0, "a b"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (5, 0, "a b"), (5, 0, "a b"), (6, 0, "x" * 100_000), (7, 1, "la"), (8, 1, "é ü")
    ]
    assert found[-1]["best"].asDict() == {"start": 0, "length": 24, "period": 2} and found[0]["best"] is None
    assert set(found[0].asDict()) == {"doc_id", "lang", "score", "item", "runs", "best", "collapsed"}
    assert periodic.find_runs(docs_of(spark, [])).count() == 0


# Language


def slow_slots(text):
    folded = [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 0 for c in text]
    edged = [0, *folded, 0]
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(edged) - n + 1):
            gram = edged[i : i + n]
            if any(gram) if n < 3 else gram[1]:
                out[(n + sum(c * f for c, f in zip(gram, language.FACTORS))) % language.BUCKETS] += 1
    return out


def test_predictions_equal_a_plain_naive_bayes(spark):
    taught = [(1, "the cat and the hat", "en"), (2, "der Hund und die Katze", "de"), (3, "le chat et l'été", "fr"), (4, None, "xx"), (5, "?", None)]
    asked = [(10, "The dog"), (11, "ÉTÉ, chat!"), (12, "und"), (13, "1234"), (14, None), (15, ""), (16, "漢字"), (16, "漢字"), (None, "a" * 50_000)]
    model = language.train(docs_of(spark, taught))
    found = {(r["doc_id"]): (r["lang_pred"], r["score"]) for r in language.predict(docs_of(spark, asked), model).collect()}
    counts = {lang: slow_slots(text) for _, text, lang in taught[:3]}
    for doc_id, text in asked:
        own = slow_slots(text or "")
        if not any(c.isalpha() for c in text or ""):
            assert found[doc_id] == ("und", 0.0)
            continue
        sums = {}
        for lang, c in counts.items():
            whole = sum(c.values()) + language.BUCKETS
            sums[lang] = (round(math.log(1 / 3) * 1e6) + sum(n * round(math.log((c[s] + 1) / whole) * 1e6) for s, n in own.items())) / 1e6
        best = max(sorted(sums), key=sums.get)
        score = 1 / sum(math.exp(v - sums[best]) for v in sums.values())
        assert found[doc_id][0] == best and abs(found[doc_id][1] - score) < 1e-9


def test_batches_and_copies_do_not_change_a_prediction(spark, monkeypatch):
    docs = docs_of(spark, [(i, f"wort{i % 7} und so weiter {i}", "de" if i % 2 else "en") for i in range(300)])
    model = language.train(docs)
    whole = language.predict(docs, model).orderBy("doc_id").collect()
    monkeypatch.setattr(language, "SLICE", 64)
    assert language.predict(docs.repartition(5), model).orderBy("doc_id").select(*whole[0].asDict()).collect() == whole


def test_a_model_of_nothing_says_und(spark):
    model = language.train(docs_of(spark, []))
    assert language.predict(docs_of(spark, [(1, "words")]), model).select("lang_pred", "score").collect() == [("und", 0.0)]
    assert language.predict(docs_of(spark, []), model).count() == 0


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGS", 2)
    with pytest.raises(ValueError, match="3 different"):
        language.train(docs_of(spark, [(i, "text", str(i)) for i in range(3)]))


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op12_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in found)
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.99 * len(found)


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def slow_search(docs, items, limit):
    counts = [(i, Counter(slow_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(slow_terms(text)) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if null else doc, -s) for k, (s, null, doc) in enumerate(sorted(scored)[:limit])]
    return sorted(out, key=repr)


def searched(spark, docs, items, limit, parts=3):
    right = spark.createDataFrame(items, "item_id bigint, text string").withColumn("score", F.lit("x"))
    left = docs_of(spark, docs).repartition(parts)
    found = lexical.search(left, right, limit)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def collection(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 500}" for _ in range(5000)] + ["É", "Ab", "ab", "x-y", "été"]
    docs = [(i, " ".join(rng.choices(words, k=int(rng.paretovariate(0.7)) % 300))) for i in range(n)]
    docs += [(None, docs[0][1]), (None, None), (7, docs[7][1]), (n, ""), (n + 1, "--"), (n + 2, "w1 " * 20_000 + "w2")]
    items = [(i, " ".join(rng.choices(words, k=25))) for i in range(30)] + [(3, docs[5][1]), (3, docs[5][1]), (None, "w1 W1"), (50, None), (51, ".")]
    return docs, items


@pytest.mark.parametrize("limit", [1, 10, 10_000])
def test_ranks_equal_scores_of_all_documents(spark, monkeypatch, limit):
    for name, value in (("ITEMS", 20), ("ENTRIES", 3000), ("LEAST_DOCS", 5), ("BLOCK_DOCS", 20), ("SEED_SHARE", 3), ("SLICE", 5000)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = collection(limit, 400)
    assert searched(spark, docs, items, limit) == slow_search(docs, items, limit)


def test_a_third_of_copies_and_ties_go_to_small_ids(spark):
    docs, items = collection(9, 200)
    docs += [(1000 + i, "w3 w4 w5 ab") for i in range(150)]
    items += [(90, "w3 w4 ab"), (91, "w5")]
    assert searched(spark, docs, items, 50) == slow_search(docs, items, 50)


def test_bounds_are_never_below_scores_and_spare_most_documents():
    docs, items = collection(11, 300)
    held = lexical.Gathered()
    hash_of = lambda t: lexical.xxhash.xxh64_intdigest(t)
    for doc, text in docs:
        held.add(doc, (text or "").encode(), hash_of)
    blocks = list(held.blocks())
    n_docs, n_terms = sum(b["n_docs"] for b in blocks), sum(b["n_terms"] for b in blocks)
    df = Counter(t for text in list(held.known) for t in set(lexical.terms_of(text)))
    q = lexical.Queries([list(dict.fromkeys(lexical.terms_of((t or "").encode()))) for _, t in items], df, n_docs, n_terms, 10)
    opener, tight, n = lexical.zstandard.ZstdDecompressor(), 0, 0
    for b in blocks:
        m = q.length_part(lexical.np.array(b["lengths"]))
        bits = lexical.np.frombuffer(b["bits"], lexical.np.uint8).reshape(b["width"], -1)
        bounds = q.bounds(bits, m, lexical.np.array(b["most"]))
        for d, packed in enumerate(b["texts"]):
            counts = Counter(lexical.terms_of(opener.decompress(packed)))
            for i in range(len(items)):
                score = q.score(i, counts, int(m[d]))
                assert bounds[i, d] >= score
                n, tight = n + 1, tight + (bounds[i, d] <= 1.25 * score)
    assert tight > 0.8 * n


def test_empty_tables_find_nothing(spark):
    assert searched(spark, [], [(1, "a")], 5) == []
    assert searched(spark, [(1, "a b")], [], 5) == []
    assert searched(spark, [(1, None), (2, " ")], [(1, "a")], 5) == []
    # a term of every document weighs nothing
    assert searched(spark, [(1, "a b"), (2, "a c")], [(1, "a")], 5, 1) == slow_search([(1, "a b"), (2, "a c")], [(1, "a")], 5)


def test_slow_parts_agree_on_terms():
    text = "Ab-ÉX 9é\x7fz\tÀ"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == slow_terms(text)
