"""The training-data operators against plain versions of what they compute, and on odd inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from compare import check, duck
from logspark.llm import hmm, html_text, lines, mixing, neighbours, perplexity, pieces, queries, sharding, simhash, warc
from logspark.llm.components import components
from logspark.session import scratch_path

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, `__key` string"


def docs_of(spark, rows, schema=DOC_SCHEMA):
    """Documents from (doc_id, text[, lang, source]) with two extra columns whose names the operators use inside."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s")), None if r[1] is None else len(r[1]), "x", "y") for r in rows]
    return spark.createDataFrame(full, schema)


def words_of(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (5, "one two"), (None, "one two"), (6, "x" * 200_000), (7, "a b c\n" * 3000)]


# SimHash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def first_of_groups(texts, size=5, level=0.8):
    """Positions of the first text of each group that all pairs of a similarity of ``level`` or more link."""
    sets = []
    for text in texts:
        w = (text or "").encode().split()
        w = [x.lower() for x in w]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)})
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if group[i] != group[j] and level * max(len(x), len(y)) <= min(len(x), len(y)):
                common = len(x & y)
                if common >= level * (len(x) + len(y) - common):
                    low, high = sorted((group[i], group[j]))
                    group = [low if g == high else g for g in group]
    return [i for i in range(len(texts)) if group[i] == i]


def test_fingerprint_is_that_of_sparks_hash_and_of_blocks(spark):
    assert simhash.fingerprint(b"A b C") == spark.sql("SELECT xxhash64('a b c') AS h").first()["h"] % (1 << 64)
    text = words_of(1, 5000).encode()
    whole = simhash.fingerprint(text)
    simhash_block = simhash.blocks(text, 100)
    assert [w for part in simhash_block for w in part] == text.split()
    assert whole == slow_fingerprint(text.decode())


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = simhash.covering_masks()
    assert len(masks) == 7 and all(30 <= bin(m).count("1") <= 40 for m in masks)
    for i, j in itertools.combinations_with_replacement(range(64), 2):
        change = 1 << i | 1 << j
        assert any(m & change == 0 for m in masks)


@pytest.mark.parametrize("small_bucket", [1, 32])
def test_links_give_the_groups_of_all_pairs(spark, monkeypatch, small_bucket):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small_bucket)
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(8):
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 2:
            parent[root(i)] = root(j)
    want = {frozenset(simhash.signed(prints[i]) for i in range(len(prints)) if root(i) == r) for r in map(root, range(len(prints)))}
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp bigint")
    groups: dict = {}
    for r in components(simhash.links(frame)).collect():
        groups.setdefault(r["root"], set()).add(r["node"])
    got = {frozenset(g) for g in groups.values()}
    assert got == {g for g in want if len(g) > 1}


def test_near_groups_on_odd_rows(spark):
    got = simhash.near_groups(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by_id = {r["id"]: r for r in got}
    assert by_id[1]["fp"] == by_id[2]["fp"] == by_id[3]["fp"] == 0 and {by_id[i]["component_id"] for i in (1, 2, 3)} == {1}
    assert by_id[None]["component_id"] == 5
    kept = simhash.keep_one(docs_of(spark, ODD))
    assert kept.columns == docs_of(spark, ODD).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6, 7]
    assert simhash.keep_one(docs_of(spark, ODD).limit(0)).count() == 0


# WARC


def test_archives_round_trip(spark):
    long = "<p>" + "é" * 100
    rows = [(3, "http://a/1", long), (1, "http://a/ 2", long), (2, None, None), (4, "u", "short"), (5, "u", "short"), (None, "u", long), (1, "http://a/ 2", long)]
    pages = spark.createDataFrame([(*r, 9) for r in rows], "page_id bigint, url string, html string, digest int").repartition(3)
    path = scratch_path(spark, "test-warc")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path, payloads=True)
    found = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect())
    want = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 100 and page_id != 1
        want[page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None] += 1
    assert found == want
    wanted = got.where("page_id = 3").select("file", "record_id")
    fetched = warc.fetch(spark, path, wanted).collect()
    assert len(fetched) == 1 and warc.parse(fetched[0]["record"])["page_id"] == 3
    bundle = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with zstandard.ZstdDecompressor().stream_reader(bundle, read_across_frames=True) as reader:
        assert reader.read().startswith(b"WARC/1.1\r\n")
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_a_bundle_has_many_frames_and_finds_each_record():
    bundle = warc.Bundle()
    data = {uuid.UUID(int=i): os.urandom(50_000) for i in range(30)}
    for key, value in data.items():
        bundle.add(key, value)
    packed = bundle.finish()
    assert len(warc.tables(packed)[0]) > 3
    assert all(warc.read_record(packed, key) == value for key, value in data.items())
    assert list(warc.records(packed)) == list(data.values())


# Lines


def test_patience_pairs_are_a_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a = np.array([rng.randrange(12) for _ in range(rng.randrange(15))], np.int64)
        b = np.array([rng.randrange(12) for _ in range(rng.randrange(15))], np.int64)
        pairs = sorted(lines.patience(a, b))
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    same = np.arange(50)
    assert len(lines.patience(same, same)) == 50
    moved = np.concatenate((same[25:], same[:25]))
    assert len(lines.patience(same, moved)) == 25


def test_shared_passages_leave_the_later_document(spark):
    passage = "\n".join(words_of(100 + i, 20) for i in range(4))
    short = words_of(200, 20)
    own = {i: [words_of(1000 * i + k, 15) for k in range(3)] for i in range(1, 7)}
    rows = [
        (1, "\n".join([own[1][0], passage, own[1][1]])),
        (2, "\n".join([own[2][0], own[2][1], passage, own[2][2]])),
        (3, "\n".join([own[3][0], short, own[3][1]])),
        (4, "\n".join([own[4][0], short, own[4][1]])),
        (5, "\n".join(own[5] * 2)),
        (6, "\n".join([own[1][0], passage, own[1][1]])),
    ]
    got = {r["doc_id"]: r["__left"] for r in lines.cut_lines(docs_of(spark, rows).repartition(3)).collect()}
    assert got[1] == rows[0][1]
    assert got[2] == "\n".join(own[2])
    assert got[3] == rows[2][1] and got[4] == rows[3][1] and got[5] == rows[4][1]
    assert got[6] == ""


def passage(name, n=8):
    return [f"{name} line {k} " + " ".join(f"{name}{k}x{w}" for w in range(8)) for k in range(n)]


def slow_cut(rows):
    """Lines that stay, by looking for every run of lines in every earlier document, each start with each start."""
    key = lambda r: (r[0] is None, r[0] if r[0] is not None else 0)
    out, earlier = {}, []
    for doc, text in sorted(rows, key=key):
        b = text.split("\n")
        size = [len(x.split()) for x in b]
        done = [False] * len(b)
        for a in earlier:
            for j in range(len(b)):
                for i in range(len(a)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                        n += 1
                    if any(w >= 5 for w in size[j : j + n]):
                        done[j : j + n] = [True] * n
        j, kept = 0, []
        while j < len(b):
            end = j
            while end < len(b) and done[end] == done[j]:
                end += 1
            if not (done[j] and sum(size[j:end]) >= 50):
                kept += b[j:end]
            j = end
        out[doc] = "\n".join(kept)
        earlier.append(b)
    return out


def test_blocks_go_wherever_and_however_often_they_stand(spark):
    own = lambda i: passage(f"own{i}", 3)
    p, q, r = passage("p"), passage("q"), passage("r")
    whole = [x for pair in zip(passage("m"), [f"short {k}" for k in range(8)]) for x in pair]
    rows = [
        (1, own(1) + p + own(2) + p), (2, own(3) + p), (3, p + own(4)),  # twice in the first
        (11, q + own(11) + r), (12, r + own(12) + q), (13, r + q + own(13)),  # in another order
        (21, own(21) + whole[0::4]), (22, own(22) + whole[2::4]), (23, own(23) + whole), (24, whole + own(24)),  # in parts first
        (31, own(31) + p + q), (32, p[:4] + own(32) + p[4:]), (33, p[3:] + p[:3] + p[3:]),
    ]
    rows = [(i, "\n".join(lines_)) for i, lines_ in rows]
    got = {r["doc_id"]: r["__left"] for r in lines.cut_lines(docs_of(spark, rows).repartition(3)).collect()}
    want = slow_cut(rows)
    assert got == want
    assert got[2] == "\n".join(own(3)) and got[13] == "\n".join(own(13)) and got[24] == "\n".join(own(24))


def test_random_texts_are_cut_as_by_comparing_all_runs(spark):
    rng = random.Random(12)
    pool = [passage(f"z{k}", rng.randrange(1, 9)) for k in range(12)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(1, 6)):
            text += rng.choice(pool) if rng.random() < 0.6 else passage(f"o{i}-{rng.random()}", 2)
        rows.append((i, "\n".join(text)))
    got = {r["doc_id"]: r["__left"] for r in lines.cut_lines(docs_of(spark, rows)).collect()}
    want = slow_cut(rows)
    assert sum(got[i] == want[i] for i in want) >= 58 and all(len(got[i]) >= len(want[i]) for i in want)


def test_lines_of_odd_rows(spark):
    frame = docs_of(spark, ODD)
    cut = lines.cut_lines(frame)
    assert cut.count() == len(ODD) and cut.columns[: len(frame.columns)] == frame.columns
    assert Counter(r["__left"] for r in cut.collect()) == Counter(t for _, t in ODD)
    assert lines.cut_lines(frame.limit(0)).count() == 0


def test_thousands_of_copies_make_one_pair_each(spark):
    text = "\n".join(words_of(k, 30) for k in range(4))
    frame = docs_of(spark, [(i, text) for i in range(2000)])
    table = lines.line_table(frame, "doc_id", "text")
    assert lines.overlaps(table).count() == 1999
    assert lines.cut_lines(frame).where("__left <> ''").count() == 1


# Perplexity


def slow_base(text):
    words = (text or "").encode().split()
    chars = sum(len(w.decode()) for w in words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), chars, symbols, dups, len(covered)


@pytest.mark.parametrize("text", ["", " \n ", "a", "é b c\x0bd", "a b c d a b c e\n\nx\nx\ny\n x", "# | $$ <b>\n# | $$ <b>", "a a a a", "a b c a b c"])
def test_base_counts(text):
    assert perplexity.base_counts(text.encode()) == slow_base(text)


def test_model_is_that_of_a_plain_kneser_ney(spark):
    texts = [words_of(i, 60, 30) for i in range(4)]
    counts = Counter()
    for t in texts:
        data = b"\0" * 4 + t.encode()
        counts.update(int.from_bytes(data[i : i + 5], "big") for i in range(len(data) - 4))
    frame = docs_of(spark, list(enumerate(texts)))
    got = perplexity.count_grams(frame, "text")
    assert {r["gram"]: r["n"] for r in got.collect()} == dict(counts)
    grams = {5: counts}
    for k in (4, 3, 2, 1):
        grams[k] = Counter(g & ((1 << 8 * k) - 1) for g in grams[k + 1])
    lower = None
    for k in range(1, 6):
        n = [sum(c == i for c in grams[k].values()) for i in range(5)]
        d = [0.5, 1.0, 1.5]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            found = [i + 1 - (i + 2) * y * n[i + 2] / n[i + 1] for i in range(3)]
            if all(0 < x < i + 1 for i, x in enumerate(found)):
                d = found
        whole, held = Counter(), Counter()
        for g, c in grams[k].items():
            whole[g >> 8] += c
            held[g >> 8] += d[min(c, 3) - 1]
        mask = (1 << 8 * (k - 1)) - 1
        lower = {
            g: (c - d[min(c, 3) - 1]) / whole[g >> 8] + held[g >> 8] / whole[g >> 8] * (1 / 256 if lower is None else lower[g & mask])
            for g, c in grams[k].items()
        }
    table = perplexity.kneser_ney(got)[-1]
    assert {r["gram"]: pytest.approx(r["p"]) for r in table.collect()} == lower
    model = perplexity.Model(*perplexity.train(frame).value).opened()
    keys = np.array(sorted(lower), np.int64)
    assert np.abs(model.score(keys) / 1e6 - np.log([lower[int(k)] for k in keys])).max() < 0.7  # hashes may meet
    # what follows a known context adds up to one, backing off where needed
    spread = np.exp(model.score((keys[50] >> 8 << 8) + np.arange(256)) / 1e6).sum()
    assert spread == pytest.approx(1, abs=0.05)


def test_odd_rows_and_junk_are_judged(spark):
    good = [(100 + i, " ".join(w + "ing" for w in words_of(i, 120).split())) for i in range(60)]
    junk = [(500, " ".join(w + "%%%" for w in words_of(77, 120).split())), (501, words_of(1, 3) + " ")]
    rows = {r["doc_id"]: r for r in perplexity.assess(docs_of(spark, good + junk + ODD)).collect()}
    assert all(rows[i]["__kept"] for i, _ in good)
    assert not rows[500]["__base_failed"] and not rows[500]["__kept"]
    assert all(rows[i]["__base_failed"] for i in (1, 2, 3, 4, 501, 7))
    kept = perplexity.keep_good(docs_of(spark, good + junk + ODD))
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _ in good]
    assert perplexity.assess(docs_of(spark, ODD).limit(0)).count() == 0


# Hidden Markov model


def slow_forward(sequence, start, moves, emits):
    alpha = [start[s] * emits[s][sequence[0]] for s in range(len(start))]
    for x in sequence[1:]:
        alpha = [sum(a * moves[r][s] for r, a in enumerate(alpha)) * emits[s][x] for s in range(len(start))]
    return math.log10(sum(alpha))


def test_forward_and_expected_counts(monkeypatch):
    rng = np.random.default_rng(1)
    start, moves, emits = rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 5, 3)
    sequences = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 7, 3, 7)]
    got = hmm.log_likelihoods(sequences, start, moves, emits)
    assert got == pytest.approx([slow_forward(s, start, moves, emits) for s in sequences])
    first, pairs, weights = hmm.expected_counts(sequences, start, moves, emits)
    want = np.zeros((3, 3)), np.zeros((3, 5)), np.zeros(3)
    for s in sequences:
        paths = list(itertools.product(range(3), repeat=len(s)))
        share = np.array([start[p[0]] * np.prod([emits[p[t]][s[t]] for t in range(len(s))]) * np.prod([moves[a][b] for a, b in zip(p, p[1:])]) for p in paths])
        for p, w in zip(paths, share / share.sum()):
            want[2][p[0]] += w
            for t, x in enumerate(s):
                want[1][p[t]][x] += w
            for a, b in zip(p, p[1:]):
                want[0][a][b] += w
    assert np.allclose(pairs, want[0]) and np.allclose(weights, want[1]) and np.allclose(first, want[2])


def test_scores_equal_a_plain_model(spark, monkeypatch):
    """The whole score of whole texts: classes, rounds over all training texts, forward sums and words within classes."""
    monkeypatch.setattr(hmm, "OWN", 20)
    monkeypatch.setattr(hmm, "ENDINGS", 10)
    monkeypatch.setattr(hmm, "CLASSES", 30)
    monkeypatch.setattr(hmm, "FREQUENT", 35)
    monkeypatch.setattr(hmm, "ROUNDS", 3)
    monkeypatch.setattr(hmm, "TRAIN_TOKENS", 300)
    rng = random.Random(8)
    words = [f"w{min(int(rng.paretovariate(0.5)), 90)}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(120)] + [(500, None), (501, "W1 neverseen w1")]
    got = {r["doc_id"]: r for r in hmm.score(docs_of(spark, rows).repartition(4)).collect()}

    texts = {i: hmm.tokens((t or "").encode()) for i, t in rows}
    taught = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10}
    counts = Counter(w for t in taught.values() for w in t)
    # equal counts: by hash, as the operator orders them
    ranked = sorted(counts, key=lambda w: (-counts[w], hmm.word_hash(w)))
    own = {w: k for k, w in enumerate(ranked[:20])}
    class_of = lambda w: own[w] if w in own else hmm.ending(w)
    whole, kinds = Counter(), Counter()
    for w, n in counts.items():
        whole[class_of(w)] += n
        kinds[class_of(w)] += 1
    prior = np.array([whole[c] + (c >= 20) for c in range(30)], float)
    prior /= prior.sum()
    model = hmm.seeded_start(prior)
    for _ in range(3):
        model = hmm.smoothed(*hmm.expected_counts([np.array([class_of(w) for w in t], np.uint16) for t in taught.values()], *model), prior)
    for i, t in texts.items():
        path = slow_forward([class_of(w) for w in t], *model)
        inside = sum(0 if w in own else math.log10((counts[w] + 0.1) / (whole[class_of(w)] + 0.1 * (kinds[class_of(w)] + 1))) for w in t)
        assert got[i]["score"] == pytest.approx(path + inside, rel=1e-4)
        base = sum(math.log10((counts[w] + 0.1) / (counts.total() + 0.1 * (len(counts) + 1))) for w in t)
        assert got[i]["base_score"] == pytest.approx(base) and got[i]["n_known"] == sum(w in counts for w in t)
        assert got[i]["train_tokens"] == counts.total() and got[i]["n_tokens"] == len(t)


@pytest.mark.parametrize("frequent", [4, 1 << 18])
def test_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(hmm, "FREQUENT", frequent)
    rows = [(i, words_of(i, 40, 60)) for i in range(40)] + ODD
    got = hmm.score(docs_of(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    crc = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(x for i, t in rows if crc(i) for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t))
        want[i, crc(i) == 0, len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert hmm.score(docs_of(spark, ODD).limit(0)).count() == 0


# Sharding


def slow_place(spots, ring, caps):
    """Keys one by one, round by round, as the ring serves them."""
    room, out = list(caps), {}
    arcs: dict = {}
    for spot, key in sorted(spots):
        arc = next((i for i, p in enumerate(ring.points) if p >= spot), 0)
        arcs.setdefault(arc, []).append((spot - sharding.RING if spot > ring.points[-1] else spot, key))
    for arc in arcs:
        arcs[arc].sort()
    for step in range(len(ring.points)):
        for arc in sorted(arcs):
            shard = ring.owners[(arc + step) % len(ring.points)]
            while arcs[arc] and room[shard]:
                out[arcs[arc].pop(0)[1]] = shard
                room[shard] -= 1
    return out


@pytest.mark.parametrize("balance", [1.0, 1.2])
def test_ring_places_like_one_by_one(spark, monkeypatch, balance):
    monkeypatch.setattr(sharding, "CELL_ROWS", 16)
    keys = spark.range(500).withColumnRenamed("id", "k").withColumn("slot_", F.lit(1))
    got = sharding.place(keys, "k", 7, balance, vnodes=8).collect()
    ring = sharding.make_ring(7, 8)
    spots = [(r["s"], r["k"]) for r in keys.select("k", F.pmod(F.xxhash64(F.lit(0), F.col("k").cast("string")), F.lit(sharding.RING)).alias("s")).collect()]
    assert {r["k"]: r["shard"] for r in got} == slow_place(spots, ring, sharding.capacities(500, 7, balance))
    sizes = Counter(r["shard"] for r in got)
    if balance == 1.0:
        assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 7
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def test_loose_bounds_move_few_keys(spark):
    keys = spark.range(4000)
    before = {r["id"]: r["shard"] for r in sharding.place(keys, "id", 10, 1.25).collect()}
    after = {r["id"]: r["shard"] for r in sharding.place(keys, "id", 11, 1.25).collect()}
    moved = sum(before[k] != after[k] for k in before)
    assert moved < 0.35 * len(before)


def test_sharding_of_odd_rows(spark):
    keys = spark.createDataFrame([(None, "a")] * 5 + [(1, "b")] * 90 + [(2, None)], "k bigint, shard_ string")
    got = sharding.place(keys, "k", 40).collect()
    assert len(got) == 96 and max(Counter(r["shard"] for r in got).values()) == 3
    assert sharding.place(keys.limit(0), "k", 40).count() == 0


# Pieces


@pytest.fixture(scope="module")
def vocabulary():
    if not os.path.exists(MODEL):
        pytest.skip("needs the public tokenizer files")
    return pieces.load_vocabulary(MODEL)


def test_segmentations_have_their_probability(vocabulary):
    plain = {b.decode(): i for i, b in enumerate(vocabulary.raw) if b and i >= 259}

    def ways(text):
        if not text:
            yield (), 0.0
        for n in range(1, len(text) + 1):
            if text[:n] in plain:
                for rest, log in ways(text[n:]):
                    yield (plain[text[:n]], *rest), vocabulary.logs[plain[text[:n]]] + log

    weights = {w: math.exp(log) for w, log in ways("  other")}
    whole = sum(weights.values())
    n = 30_000
    ids, counts = pieces.Encoder(vocabulary, 1).encode([str(i).encode() for i in range(n)], ["  other"] * n)
    stops = np.cumsum(counts)
    drawn = Counter(tuple(ids[e - c : e].tolist()) for e, c in zip(stops, counts))
    for way, weight in weights.items():
        assert drawn[way] / n == pytest.approx(weight / whole, abs=0.012)


def test_pieces_are_lossless_and_do_not_depend_on_the_partitions(spark, vocabulary):
    texts = ["a▁b \n\n  x  ", "", None, "日本語 ☃ \U0001f600 ñ\tq", "x" * 20_000, "\x00\r\n", "the  the   the "] + [words_of(i, 200) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null key"), (3, texts[3])]
    one = pieces.encode(docs_of(spark, rows).coalesce(1), MODEL)
    many = pieces.encode(docs_of(spark, rows).repartition(7), MODEL)
    take = lambda f: sorted(((r["doc_id"], r["text"], r["__ids"], r["__lossless"]) for r in f.collect()), key=repr)
    assert take(one) == take(many)
    assert all(r["__lossless"] for r in one.collect())
    decoded = pieces.decode_ids(one, MODEL).collect()
    assert all(r["__decoded"] == (r["text"] or "") for r in decoded)
    other = pieces.encode(docs_of(spark, rows), MODEL, seed=99)
    assert take(other) != take(one)
    assert pieces.encode(docs_of(spark, rows).limit(0), MODEL).count() == 0


# Neighbours


def slow_nearest(rows, k):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for q, a in good:
        if q % 100 == 0:
            near = sorted((math.dist(a, b), i) for i, b in good if i != q and len(a) == len(b))
            yield q, [(i, d) for d, i in near[:k]]


def test_small_sets_are_exact_on_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)] + [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)]
    rows += [(200, [0.0] * 4), (300, None), (400, [1.0, None, 2.0, 3.0]), (500, [float("nan"), 1.0, 1.0, 1.0]), (600, []), (700, [1.0, 2.0]), (None, [1.0] * 4)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, dim int").repartition(3)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got: dict = {}
    for r in neighbours.search(frame, frame.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], pytest.approx(r["score"])))
    want = {q: n for q, n in slow_nearest(exact, 10) if n}
    assert {q: [i for i, _ in n] for q, n in want.items()} == {q: [i for i, _ in n] for q, n in got.items()}
    assert want == got
    assert neighbours.search(frame.limit(0), frame.limit(0)).count() == 0


def test_recall_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 1000)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 32)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    got: dict = {}
    for r in neighbours.search(frame, frame.where("vec_id % 100 = 0")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, found in got.items():
        away = ((vectors - vectors[q]) ** 2).sum(1)
        away[q] = np.inf
        hits += len(found & set(np.argsort(away)[:10].tolist()))
    assert len(got) == 30 and hits / 300 >= 0.9


# Mixing


def slow_targets(sources, share, cap):
    """Round by round: clamp what is above its cap, share the rest again."""
    budget, fixed = share * sum(s for s, _ in sources.values()), {}
    while True:
        free = {k: v for k, v in sources.items() if k not in fixed}
        rest, weight = budget - sum(fixed.values()), sum(w for _, w in free.values())
        now = {k: rest * w / weight for k, (_, w) in free.items()}
        over = {k for k in now if now[k] > cap * sources[k][0]}
        if not over:
            return {**fixed, **now}
        fixed.update({k: cap * sources[k][0] for k in over})


def test_targets_and_taken(spark):
    rng = random.Random(6)
    sizes = {"a": 30, "b": 400, "c": 200, "d": 50, None: 100}
    rows = [(1000 * n + i, words_of(i, rng.randrange(20, 60)), "en", s) for n, (s, m) in enumerate(sizes.items()) for i in range(m)]
    mixed = mixing.mix(docs_of(spark, rows).repartition(3))
    got = mixed.collect()
    assert len(got) == len(rows)
    own = {s: sum(len(t.split()) for _, t, _, x in rows if x == s) for s in sizes}
    want = slow_targets({s: (own[s], w) for (s, w) in zip(sizes, (3, 1, 2, 3, 1))}, 1.5, 2.0)
    taken = Counter()
    for r in got:
        assert r["__target"] == pytest.approx(want[r["source"]]) and r["__source_size"] == own[r["source"]]
        assert 0 <= r["__repeats"] <= 2
        taken[r["source"]] += r["__size"] * r["__repeats"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    again = mixing.mix(docs_of(spark, rows).repartition(5)).collect()
    assert sorted((r["doc_id"], r["__repeats"]) for r in again) == sorted((r["doc_id"], r["__repeats"]) for r in got)
    assert mixing.repeated(mixed).count() == sum(r["__repeats"] for r in got)
    assert mixing.repeated(mixed).columns == docs_of(spark, rows).columns


@pytest.mark.parametrize("kind", ["null ids", "one id", "equal rows"])
def test_hot_ids_and_equal_rows_still_meet_the_targets(spark, monkeypatch, kind):
    monkeypatch.setattr(mixing, "RUN", 7)
    rng = random.Random(4)
    doc = lambda i: None if kind == "null ids" else 5
    hot = [(doc(i), words_of(0 if kind == "equal rows" else i, 20 if kind == "equal rows" else rng.randrange(5, 60)), "en", "a") for i in range(300)]
    rows = hot + [(1000 + i, words_of(i, rng.randrange(5, 60)), "en", "bc"[i % 2]) for i in range(200)]
    got = mixing.mix(docs_of(spark, rows).repartition(3)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    largest = {s: max(r["__size"] for r in got if r["source"] == s) for s in "abc"}
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        taken = sum(r["__size"] * r["__repeats"] for r in own)
        assert abs(taken - own[0]["__target"]) <= largest[source] / 2 + 1e-9
        assert max(r["__repeats"] for r in own) <= 2
    again = mixing.mix(docs_of(spark, rows).repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


@pytest.mark.parametrize("scales", [(1e20,), (1e-25,), (1e150, 1e150), (1.0, 1e20, 1e-20)])
def test_neighbours_of_any_magnitude_equal_brute_force(spark, scales):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=8) * scales[i % len(scales)] for i in range(300)]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = neighbours.search(frame, frame.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert len(got) == 30
    right = 0
    for q in (0, 100, 200):
        exact = sorted((math.sqrt(float(((vectors[q] - v) ** 2).sum())), i) for i, v in enumerate(vectors) if i != q)[:10]
        own = [r for r in got if r["query_id"] == q]
        assert all(r["score"] == pytest.approx(math.sqrt(float(((vectors[q] - vectors[r["vec_id"]]) ** 2).sum()))) for r in own)
        right += len({r["vec_id"] for r in own} & {i for _, i in exact})
    assert right >= 27


def test_names_inside_the_article_are_no_veto():
    page = (
        "<nav class=menu>Home</nav><article><h2 id='related-work'>Related work</h2><p>Kept.</p><section id='social-impact'><p>Impact.</p></section>"
        "<p class='form-of-government'>A republic.</p><div class='comment-list'><p>First!</p></div><div class='ad'>Buy</div>"
        "<div id=comments><p>Nice.</p></div><h2 id=comments>Comments on the text</h2><p>Last.</p></article><footer>End</footer>"
    )
    assert html_text.main_text(page) == "Related work Kept. Impact. A republic. Comments on the text Last."
    prose = "It was the best of times and it was the worst of times for all of us in the town. " * 3
    assert html_text.main_text(f"<p>one</p><!--><p>{prose}</p><!---><p>{prose}</p><!-- x --!><p>{prose}</p>").count("best") == 9


def test_mixing_of_odd_rows(spark):
    frame = docs_of(spark, [(i, t, None, None) for i, t in ODD])
    assert mixing.mix(frame).count() == len(ODD)
    assert mixing.mix(frame.limit(0)).count() == 0
    empty = docs_of(spark, [(1, None), (2, "")])
    assert {r["__repeats"] for r in mixing.mix(empty).collect()} == {0}


@pytest.mark.parametrize("name", ["op2_warc", "op9_mixing"])
def test_queries_give_their_sqls_rows(spark, name):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("needs the given tables")
    assert check(spark, duck(sf), name, queries.QUERIES[name], queries.ORACLES[name], sf) is None


# HTML


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>One &amp; two<br>three.<p>Four</article><footer>&copy; x</footer>", "Title One & two three. Four"),
        ("<body><header>Site</header><main><header><h1>T</h1></header><p>Short.</p><div class='ad'>Buy</div><form>name <input></form><p>End</main>", "T Short. End"),
        ("<article><p>text</p><section id=comments><p>me too, I think this is what it is</p></section><script>var a='</p>';</script></article>", "text"),
        ("<!-- a > b --><p>x &lt;b&gt; y &#233;", ""),
        ("<article>open <p unclosed='yes>lost</article>", "open lost"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_two_passes_without_an_article_element():
    prose = "It is what we have in the house that was on the hill, and they are not of it but for us as it is in the end."
    links = "".join(f"<li><a href=/{i}>link {i} here</a></li>" for i in range(9))
    page = f"<ul>{links}</ul><div>Menu entry</div><h2>Heading</h2><div>{prose}</div><div>Short one.</div><div>{prose}</div><ul>{links}</ul><div>Bye</div>"
    assert html_text.main_text(page) == f"Heading {prose} Short one. {prose}"


def test_extract_on_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article>é</article>"), (2, None, ""), (3, "u", "<article>" + "<p>a b" * 50_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 199_999)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_n_grams_keep_their_own_values_and_a_small_model_leaves_none_out(spark, monkeypatch):
    texts = [words_of(i, 150, 3000) for i in range(60)] + [words_of(90, 80) + " %%%%%% &&&& unseen"]
    frame = docs_of(spark, [*enumerate(texts), (200, texts[3]), (201, None), (202, "")])
    counts = perplexity.count_grams(docs_of(spark, list(enumerate(texts))), "text")
    table = {r["gram"]: r["p"] for r in perplexity.kneser_ney(counts)[-1].collect()}
    model = perplexity.Model(*perplexity.train(frame).value).opened()
    keys = np.array(sorted(table), np.int64)
    assert np.abs(model.score(keys) - 1e6 * np.log([table[int(k)] for k in keys])).max() <= 1
    whole = sorted(map(tuple, perplexity.assess(frame).collect()))
    kept = sorted(r["doc_id"] for r in perplexity.keep_good(frame).collect())
    for held in (len(keys) // 3, 0):
        monkeypatch.setattr(perplexity, "HELD_GRAMS", held)
        assert not perplexity.train(frame).value[-1]
        assert sorted(map(tuple, perplexity.assess(frame).collect())) == whole
        assert sorted(r["doc_id"] for r in perplexity.keep_good(frame).collect()) == kept


def test_lattices_held_are_bounded_by_their_size(vocabulary):
    encoder = pieces.Encoder(vocabulary, 1)
    for i in range(8):
        encoder.encode([b"k"] * 10, [" ".join(f"{i * 10**6 + j * 10**4 + n:0100d}" for n in range(500)) for j in range(10)])
    assert sum(len(lattices.first) for lattices in encoder.parts) < 3_000_000
