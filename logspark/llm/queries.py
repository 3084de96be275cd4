"""Registered queries of the training-data operators; each runs over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from logspark.llm import (
    hmm,
    html_text,
    language,
    lexical,
    lines,
    mixing,
    neighbours,
    periodic,
    perplexity,
    pieces,
    sharding,
    simhash,
    warc,
)
from logspark.llm.common import WORD, table

SHARDS = 40
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return groups.select(F.col("id").alias("doc_id"), fingerprint, "component_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.cut_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_deleted = F.coalesce(F.size("__deleted"), F.lit(0)).cast("bigint").alias("n_deleted")
    return cut.select("doc_id", n_deleted, F.col("__deleted").alias("deleted_lines"), F.col("__left").alias("text"))


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.assess(table(spark, sf_dir, "documents"))
    measures = [F.col(f"__{m}").alias(m) for m in perplexity.MEASURES]
    verdict = [F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept")]
    log_perplexity = (F.col("__bin") / perplexity.BINS).alias("log_perplexity")
    return judged.select("doc_id", *measures, *verdict, "lang", log_perplexity)


def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    placed = sharding.place(slim, "doc_id", SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = pieces.encode(docs, PIECE_MODEL)
    return cut.select(
        "doc_id",
        F.col("__ids").alias("ids"),
        F.size("__ids").cast("bigint").alias("n_pieces"),
        F.col("__lossless").alias("lossless"),
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(rows, rows.where("vec_id % 100 = 0"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__repeats")).cast("bigint").alias("taken"),
    )


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents, by the hash of the id, the words from one on repeat a stretch of words.

    A document without an id keeps its text.
    """
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    chosen = F.col("h") % 10 == 0
    docs = docs.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words"))
    docs = docs.withColumn("g", F.expr("h div 10")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    again = "array_join(transform(sequence(0, n - 1), i -> words[IF(i < a, i, a + (i - a) % p)]), ' ')"
    return docs.select("doc_id", F.expr(f"CASE WHEN n > 0 THEN {again} ELSE text END").alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    line = "concat(r.start, ',', r.length, ',', r.period, '\n')"
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join(transform(runs, r -> {line}), '')").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.is_held_out("doc_id")))
    found = language.predict(docs.select("doc_id", language.is_held_out("doc_id").alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


OPERATORS = (
    op1_simhash,
    op2_warc,
    op3_lines,
    op4_perplexity,
    op5_hmm,
    op6_sharding,
    op7_pieces,
    op8_neighbours,
    op9_mixing,
    op10_html,
    op11_periodic,
    op12_language,
    op13_lexical,
    pipeline,
)
QUERIES = {f.__name__: f for f in OPERATORS}

# The archives' rows from the pages alone. An id is the start of a SHA-256 over page and payload.
OP2_SQL = r"""
WITH own AS (
    SELECT page_id, url, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes FROM pages
), typed AS (
    SELECT *, CASE WHEN bytes >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM own
), named AS (
    SELECT *, first IS NOT NULL AND page_id IS DISTINCT FROM first AS revisit,
        substr(sha256(coalesce(CAST(page_id AS VARCHAR), 'None') || '/' || digest), 1, 32) AS id
    FROM typed
)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
    CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN revisit THEN first END AS refers_to, url,
    'urn:uuid:' || substr(id, 1, 8) || '-' || substr(id, 9, 4) || '-' || substr(id, 13, 4) || '-' || substr(id, 17, 4)
        || '-' || substr(id, 21, 12) AS record_id
FROM named
"""

# Targets by the level at which capped shares use up the budget; then, in the seeded order, the prefix whose sum comes
# nearest to what whole rounds leave of the target (the shorter one of two).
OP9_SQL = r"""
WITH own AS (
    SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        CAST('0x' || substr(md5('17/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || coalesce(source, '') || '/' || coalesce(text, '')), 1, 15)
            AS BIGINT) AS h
    FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size,
        [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM own GROUP BY source
), ranked AS (
    SELECT *, source_size * 2.0::DOUBLE AS cap, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS i FROM sources
), levels AS (
    SELECT a.i, a.cap, a.weight,
        ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE - coalesce((SELECT sum(b.cap) FROM ranked b WHERE b.i < a.i), 0))
            / (SELECT sum(b.weight) FROM ranked b WHERE b.i >= a.i) AS level
    FROM ranked a
), final AS (
    SELECT min_by(level, i) AS level FROM levels WHERE level * weight < cap
), targets AS (
    SELECT source, source_size, least(cap, coalesce(weight * level, cap)) AS target FROM ranked LEFT JOIN final ON true
), plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), sums AS (
    SELECT own.*, CAST(source_size AS BIGINT) AS source_size, target, whole, target - whole * source_size AS rest,
        sum(size) OVER (PARTITION BY own.source ORDER BY h % 4096, h, rid ROWS UNBOUNDED PRECEDING) AS upto
    FROM own JOIN plan ON own.source IS NOT DISTINCT FROM plan.source
), nearest AS (
    SELECT source, min_by(upto, (abs(upto - rest), upto)) AS best
    FROM (SELECT source, upto, rest FROM sums UNION ALL SELECT DISTINCT source, 0, rest FROM sums) GROUP BY source
)
SELECT doc_id, size, source_size, target,
    CAST(size * (whole + CASE WHEN upto <= best THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sums JOIN nearest ON sums.source IS NOT DISTINCT FROM nearest.source
"""

# CRC-32 of the decimal doc_id, bit by bit, as DuckDB has no function for it.
CRC_SQL = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda x, e: xor(xor(x, e) >> 1, 3988292384::BIGINT * (xor(x, e) & 1)))"""

# Every lag of which a multiple starts eight words that the lag repeats is scanned over the whole text.
OP11_SQL = rf"""
WITH own AS (
    SELECT row_number() OVER () AS rid, doc_id, xor({CRC_SQL}, 4294967295::BIGINT) AS h,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), planned AS (
    SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM own
), texts AS (
    SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n),
        lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w FROM planned
), words AS MATERIALIZED (
    SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS word FROM texts
), eights AS MATERIALIZED (
    SELECT rid, n, i, hash(list(word) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) AS e FROM words
), grid AS (
    SELECT rid, q, unnest(range(0, n - q, q)) AS i FROM (SELECT rid, n, unnest(range(1, n // 3 + 1)) AS q FROM texts WHERE n >= 24)
), lags AS MATERIALIZED (
    SELECT DISTINCT grid.rid, q FROM grid JOIN eights x ON x.rid = grid.rid AND x.i = grid.i
    JOIN eights y ON y.rid = grid.rid AND y.i = grid.i + q AND y.e = x.e
), same AS (
    SELECT x.rid, q, x.i, x.i - row_number() OVER (PARTITION BY x.rid, q ORDER BY x.i) AS island
    FROM lags JOIN words x USING (rid) JOIN words y ON y.rid = x.rid AND y.i = x.i + q AND y.word = x.word
), runs AS MATERIALIZED (
    SELECT rid, start, length, min(q) AS q
    FROM (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY rid, q, island)
    WHERE length >= greatest(24, 3 * q) GROUP BY rid, start, length
), dropped AS (
    SELECT DISTINCT rid, unnest(range(start + q, start + length)) AS i FROM runs
), lefts AS (
    SELECT rid, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (rid, i) GROUP BY rid
), listed AS (
    SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS t FROM runs GROUP BY rid
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length / q::DOUBLE DESC, start, q) = 1
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
    sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(lefts.t, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN lefts USING (rid)
"""

# Naive Bayes over the same slots, each character n-gram written out.
OP12_SQL = rf"""
WITH own AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, text IS NOT NULL AS known,
        coalesce(xor({CRC_SQL}, 4294967295::BIGINT) % 3 = 1, false) AS held_out,
        ' ' || regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]', ' ', 'g') || ' ' AS t FROM documents
), chars AS (
    SELECT rid, list_transform(string_split(t, ''), lambda c: CASE WHEN c = ' ' THEN 0::BIGINT ELSE ord(c)::BIGINT END) AS c FROM own
), chars3 AS MATERIALIZED (
    SELECT rid, i, c[i] AS x, c[i + 1] AS y, c[i + 2] AS z FROM (SELECT rid, c, unnest(range(1, len(c))) AS i FROM chars)
), grams AS MATERIALIZED (
    SELECT rid, slot, count(*) AS n FROM (
        SELECT rid, 1 AS o, (1 + x) % 131071 AS slot FROM chars3 WHERE x > 0
        UNION ALL SELECT rid, 2, (2 + x + 1000003 * y) % 131071 FROM chars3 WHERE x > 0 OR y > 0
        UNION ALL SELECT rid, 3, (3 + x + 1000003 * y + 998244353 * z) % 131071 FROM chars3 WHERE y > 0 AND z IS NOT NULL
    ) GROUP BY rid, slot
), taught AS (
    SELECT lang, slot, sum(n) AS n FROM grams JOIN own USING (rid) WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL
), langs AS (
    SELECT lang, round(ln(texts / sum(texts) OVER ()) * 1000000)::BIGINT AS prior, coalesce(total, 0)::DOUBLE + 131071 AS whole
    FROM (SELECT lang, count(*)::DOUBLE AS texts FROM own WHERE NOT held_out AND known AND lang IS NOT NULL GROUP BY lang)
    LEFT JOIN (SELECT lang, sum(n) AS total FROM taught GROUP BY lang) USING (lang)
), sums AS (
    SELECT rid, langs.lang, prior + sum(grams.n * round(ln((coalesce(taught.n, 0)::DOUBLE + 1) / whole) * 1000000)::BIGINT)::BIGINT AS s
    FROM grams CROSS JOIN langs LEFT JOIN taught ON taught.lang = langs.lang AND taught.slot = grams.slot GROUP BY rid, langs.lang, prior
), ranked AS (
    SELECT rid, lang, 1 / sum(exp((s - top) / 1000000.0::DOUBLE)) OVER (PARTITION BY rid) AS score, s
    FROM (SELECT *, max(s) OVER (PARTITION BY rid) AS top FROM sums)
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY s DESC, lang) = 1
)
SELECT doc_id, held_out, coalesce(ranked.lang, 'und') AS lang_pred, coalesce(round(score, 6), 0) AS score
FROM own LEFT JOIN ranked USING (rid)
"""

OP13_SQL = r"""
WITH own AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), items AS (
    SELECT row_number() OVER () AS iid, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark
), sums AS (
    SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM own WHERE len(t) > 0
), counts AS MATERIALIZED (
    SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM own) WHERE term IN (SELECT term FROM items) GROUP BY rid, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, sums GROUP BY term, docs
), scores AS (
    SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(t) * docs) // terms))))::BIGINT AS score
    FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN own USING (rid), sums GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM (SELECT iid, item_id, rid, doc_id, score FROM scores WHERE score > 0)
QUALIFY rank <= 50
"""

ORACLES: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op9_mixing": OP9_SQL,
    "op11_periodic": OP11_SQL,
    "op12_language": OP12_SQL,
    "op13_lexical": OP13_SQL,
}
