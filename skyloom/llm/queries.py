"""The registered queries of the operators: whole tables in, whole results out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, hard_negatives, html_text, line_dedup, minhash, mixing, pii, quality, substring, token_files
from . import vector_dedup, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The key of the registered query; a deployment passes its own secret.
PII_KEY = "registered-query-key"


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymize(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", "text", *[count(k) for k in pii.KINDS])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(files)


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode_decode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return out.select(
        "doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.quality(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.placed(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "places")


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_dedup(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector has the label after its own, so that labels don't follow the vectors alone."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.hard_negatives(rows, lambda i: i % 50 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_files": op3_token_files,
    "op4_substring": op4_substring,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_pii": op6_pii,
    "op7_quality": op7_quality,
    "op8_minhash": op8_minhash,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLE_SQL: dict[str, str] = {
    "op11_embedding_dedup": f"""
        WITH RECURSIVE v AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
          WHERE label IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS MATERIALIZED (
          SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
          WHERE list_inner_product(x.e, y.e) / sqrt(list_inner_product(x.e, x.e) * list_inner_product(y.e, y.e)) >= 0.93),
        r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
        SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN c ON c.a = vec_id""",
    "op12_hard_negatives": f"""
        WITH v AS MATERIALIZED (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
          FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
        s AS MATERIALIZED (
          SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.e, r.e)::BIGINT AS score
          FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
        p AS (
          SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
        QUALIFY row_number() OVER w <= 3""",
    "op9_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)""",
    "op7_quality": rf"""
        WITH d AS (
          SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words,
                 list_filter(string_split(coalesce(text, ''), chr(10)),
                             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
          FROM documents),
        g AS (
          SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) > 2)),
        r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
        c AS (
          SELECT doc_id, sum(least(3, i - coalesce(before, i - 3))) AS n_repeat_words
          FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r) GROUP BY doc_id),
        f AS (
          SELECT d.doc_id, source, len(words) AS n_words, len(lines) AS n_lines,
                 CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                 len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                 len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                 CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
          FROM d LEFT JOIN c USING (doc_id)),
        v AS (
          SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                 n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 150 * n_words
                 OR 100 * n_dup_lines > 60 * n_lines OR word_chars < 2 * n_words OR word_chars > 14 * n_words AS failed
          FROM f),
        h AS (SELECT source, count(*) AS n, sum(failed::INT) AS k FROM v GROUP BY source),
        s AS (SELECT sum(k) / sum(n) AS m, var_samp(k / n) AS v FROM h),
        w AS (
          SELECT h.source, (k + a * m) / (n + a) > 0.6 AS rejected
          FROM h, (SELECT m, least(1e4, greatest(1.0, coalesce(m * (1 - m) / nullif(v, 0) - 1, 1e4))) AS a FROM s))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT rejected AS kept
        FROM v JOIN w ON v.source IS NOT DISTINCT FROM w.source""",
    "op2_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
        k AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        m AS (SELECT l.*, k.last IS NOT NULL AND doc_id < k.last AS gone FROM l LEFT JOIN k USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op4_substring": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
        g AS (SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS k
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) > 19)),
        r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
        c AS (SELECT p.doc_id, p.i, word, count(r.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) > 0 AS gone
              FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND r.i = p.i)
        SELECT d.doc_id, count(c.i) AS n_words, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY c.i) FILTER (NOT gone), '')) AS kept_sha256
        FROM d LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id""",
}
