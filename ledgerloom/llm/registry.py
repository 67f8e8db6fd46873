"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    byte_bpe, decontamination, embedding_dedup, fill_in_middle, importance, language_id,
    license_scan, lm_scoring, quality_rules, secret_scan, simhash, suffix_sort, word_windows,
)
from ledgerloom.session import share_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        share_package(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _joined_spans(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


@query
def op1_simhash(spark, folder):
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op2_secrets(spark, folder):
    found = secret_scan.scan_secrets(documents(spark, folder))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *[of_kind(kind).cast("bigint").alias(f"n_{kind}") for kind in secret_scan.KINDS],
        sha256(_joined_spans(base)).alias("base_sha256"),
        _joined_spans(F.col("spans")).alias("spans"),
    )


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def _removed(spans: str) -> Column:
    """Number of units in the spans."""
    lengths = F.transform(spans, lambda s: s["end"] - s["start"])
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, n: total + n)


@query
def op3_word_windows(spark, folder):
    cut = word_windows.remove_repeated_words(documents(spark, folder))
    return cut.select(
        "doc_id", "n_words", _removed("spans").alias("n_removed"),
        sha256(F.col("kept_text")).alias("kept_sha256"),
    )


ORACLES["op3_word_windows"] = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS i FROM doc
), windows AS (
    SELECT doc_id, i, array_to_string(w[i + 1 : i + 20], ' ') AS words FROM starts
), again AS (
    SELECT doc_id, i FROM windows
    QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1
), covered AS (
    SELECT doc_id, list(DISTINCT p) AS places
    FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM again) GROUP BY doc_id
), word AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM doc
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
    FROM word LEFT JOIN covered USING (doc_id)
    WHERE places IS NULL OR NOT list_contains(places, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op4_language(spark, folder):
    docs = documents(spark, folder)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    model = language_id.train(docs, where=remainder(3) != 1)
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "language.*"
    )


@query
def op5_licenses(spark, folder):
    found = license_scan.scan_licenses(documents(spark, folder))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return found.select("doc_id", "license", "coverage", F.array_join(spans, ",").alias("spans"))


@query
def op6_quality(spark, folder):
    judged = quality_rules.judge(documents(spark, folder))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.array_join("outliers", ",").alias("outliers"),
    )


# Buckets and fences by the rule of ``quality_rules``, written out in SQL.
ORACLES["op6_quality"] = r"""
WITH word AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), line AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM word
), lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), starts AS (
    SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS i FROM word
), windows AS (
    SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS words FROM starts
), again AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id
), counted AS (
    SELECT doc_id, lang, source, len(w) AS n_words,
        coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM word LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
), value AS (
    SELECT doc_id, (length(bin(n_words)) + 1) // 2 AS k, lang, source, base_failed, unnest([
        {'f': 'word_length', 'c': word_chars::DOUBLE, 'w': n_words, 'u': 0},
        {'f': 'symbol_share', 'c': n_symbols::DOUBLE, 'w': word_chars, 'u': 1},
        {'f': 'dup_line_share', 'c': n_dup_lines::DOUBLE, 'w': n_lines, 'u': 1},
        {'f': 'repeat_share', 'c': n_repeat_words::DOUBLE, 'w': n_words, 'u': 10}
    ], recursive := true)
    FROM judged
), bucket AS (
    SELECT f, k, lang, source, ceil(ln(greatest(coalesce(c / nullif(w, 0), 0), 1e-6::DOUBLE))
        / ln(1.01::DOUBLE / 0.99::DOUBLE))::INTEGER AS b
    FROM value WHERE NOT base_failed
), ranked AS (
    SELECT g, f, k, lang, source, count(*) AS n, list(b ORDER BY b) AS bs FROM (
        SELECT 3 AS g, f, k, lang, source, b FROM bucket
        UNION ALL SELECT 2, f, k, lang, NULL, b FROM bucket
        UNION ALL SELECT 1, f, k, NULL, NULL, b FROM bucket
        UNION ALL SELECT 0, f, NULL, NULL, NULL, b FROM bucket)
    GROUP BY g, f, k, lang, source
), quantile AS (
    SELECT g, f, k, lang, source, n,
        [CASE WHEN e.b <= ceil(ln(1e-6::DOUBLE) / ln(1.01::DOUBLE / 0.99::DOUBLE)) THEN 0
              WHEN e.side = 0 THEN pow(1.01::DOUBLE / 0.99::DOUBLE, e.b) * (2 / (1 + 1.01::DOUBLE / 0.99::DOUBLE))
              WHEN e.side < 0 THEN pow(1.01::DOUBLE / 0.99::DOUBLE, e.b - 1)
              ELSE pow(1.01::DOUBLE / 0.99::DOUBLE, e.b) END
         FOR e IN [{'b': bs[ceil(0.1::DOUBLE * n)::INTEGER], 'side': -1},
                   {'b': bs[ceil(0.5::DOUBLE * n)::INTEGER], 'side': 0},
                   {'b': bs[ceil(0.9::DOUBLE * n)::INTEGER], 'side': 1}]] AS q
    FROM ranked
), fence AS (
    SELECT p.f, p.k, p.lang, p.source,
        CASE WHEN p.n >= 200 THEN p.q WHEN l.n >= 200 THEN l.q WHEN c.n >= 200 THEN c.q ELSE a.q END AS q
    FROM quantile p
    JOIN quantile l ON l.g = 2 AND l.f = p.f AND l.k = p.k AND l.lang IS NOT DISTINCT FROM p.lang
    JOIN quantile c ON c.g = 1 AND c.f = p.f AND c.k = p.k
    JOIN quantile a ON a.g = 0 AND a.f = p.f
    WHERE p.g = 3
), outlier AS (
    SELECT doc_id, string_agg(v.f, ',' ORDER BY
        list_position(['word_length', 'symbol_share', 'dup_line_share', 'repeat_share'], v.f)) AS outliers
    FROM value v JOIN fence ON fence.f = v.f AND fence.k = v.k
        AND fence.lang IS NOT DISTINCT FROM v.lang AND fence.source IS NOT DISTINCT FROM v.source
    WHERE coalesce((c + u) / nullif(w, 0), 0) < q[1] - 3 * (q[2] - q[1])
        OR coalesce((c - u) / nullif(w, 0), 0) > q[3] + 3 * (q[3] - q[2])
    GROUP BY doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines,
    n_repeat_words, base_failed, NOT base_failed AND outliers IS NULL AS kept,
    coalesce(outliers, '') AS outliers
FROM judged LEFT JOIN outlier USING (doc_id)
"""


@query
def op7_decontamination(spark, folder):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    leaks = decontamination.find_leaks(documents(spark, folder), benchmark)
    return leaks.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"), "contaminated",
    )


ORACLES["op7_decontamination"] = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_start AS (
    SELECT item_id, w, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM item WHERE len(w) > 0
), item_window AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n,
        array_to_string(w[i + 1 : i + least(10, len(w))], ' ') AS words
    FROM item_start
), sizes AS (
    SELECT DISTINCT n FROM item_window
), doc_start AS (
    SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM doc, sizes WHERE len(w) >= n
), doc_window AS (
    SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS words FROM doc_start
), hit AS (
    SELECT doc_id, n, i, item_id FROM doc_window JOIN item_window USING (n, words)
), place AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN place USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op8_lm_scoring(spark, folder):
    scored = lm_scoring.score(documents(spark, folder), learn=remainder(10) != 0)
    held_out = F.coalesce(remainder(10) == 0, F.lit(False))
    return scored.withColumn("held_out", held_out)


def token_digests(docs: DataFrame) -> DataFrame:
    """Token ids and decoded bytes of every document, as counts and digests."""
    ranks = public_tokenizers.path(RANKS)
    encoded = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, decode=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_byte_bpe(spark, folder):
    return token_digests(documents(spark, folder))


@query
def op10_suffix_sort(spark, folder):
    cut = suffix_sort.remove_repeated_bytes(documents(spark, folder))
    return cut.select(
        "doc_id", "n_bytes", _removed("spans").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLES["op10_suffix_sort"] = """
WITH doc AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
    SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM doc
), windows AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS bytes FROM starts
), again AS (
    SELECT doc_id, i FROM windows
    QUALIFY row_number() OVER (PARTITION BY bytes ORDER BY doc_id, i) > 1
), edges AS (
    SELECT doc_id, i, i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 AS far FROM again
), runs AS (
    SELECT doc_id, i, sum(CASE WHEN far IS DISTINCT FROM false THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY i) AS run
    FROM edges
), spans AS (
    SELECT doc_id, run, min(i) AS low, max(i) + 100 AS high FROM runs GROUP BY doc_id, run
), cuts AS (
    SELECT doc_id, low, high, lead(low) OVER (PARTITION BY doc_id ORDER BY low) AS next FROM spans
), kept AS (
    SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed,
        substr(any_value(h), 1, 2 * min(low)) || string_agg(
            substr(h, 2 * high + 1, 2 * (coalesce(next, len(h) // 2) - high)), '' ORDER BY low) AS h
    FROM cuts JOIN doc USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(doc.h) // 2 AS BIGINT) AS n_bytes,
    CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept.h, doc.h))) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


@query
def op12_fill_in_middle(spark, folder):
    cut = fill_in_middle.transform(documents(spark, folder))
    rebuilt = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha256(F.col("output")).alias("output_sha256"), sha256(rebuilt).alias("restored_sha256"),
    )


ORACLES["op12_fill_in_middle"] = """
WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), draw AS (
    SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
            WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM doc
), part AS (
    SELECT *, substr(text, 1, least(c1, c2)) AS prefix, substr(text, greatest(c1, c2) + 1) AS suffix,
        substr(text, least(c1, c2) + 1, abs(c1 - c2)) AS middle
    FROM draw
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM part
"""


# The crc32 of buckets is no function of the SQL; see the tests.
@query
def op11_importance_resampling(spark, folder):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    drawn = importance.resample(documents(spark, folder), benchmark)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_embedding_dedup(spark, folder):
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


ORACLES["op13_embedding_dedup"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e, list_sum([x::DOUBLE * x FOR x IN embedding]) AS square
    FROM embeddings
), able AS (
    SELECT vec_id, label, e FROM v
    WHERE label IS NOT NULL AND square > 0 AND isfinite(square) AND list_count(e) = len(e)
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM able a JOIN able b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), class AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counted AS (
    SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN class USING (vec_id) LEFT JOIN counted USING (vec_id)
"""
