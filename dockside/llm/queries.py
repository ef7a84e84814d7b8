"""One query per operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockside.llm import (
    arrow_files,
    counts,
    near_copies,
    packing,
    piece_transducer,
    quality_model,
    quality_rules,
    secrets_scan,
    simhash_links,
    token_alignment,
    topk,
    toxicity,
    whitening,
)
from dockside.llm.common import read_table
from dockside.session import scratch_path, tune

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its place in a sequence of at most 2048 tokens; a missing text is empty."""
    return packing.pack_documents(read_table(tune(spark), sf_dir, "documents"), BYTE_VOCABULARY)


def predicted(scores: DataFrame, limit: float) -> DataFrame:
    return scores.withColumn("predicted", (F.col("score") >= limit).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document, learnt from labels outside the held-out fold; a missing text is empty."""
    tune(spark)
    return predicted(toxicity.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")), 0.7)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, as counts and spans; a missing text holds none."""
    return secrets_scan.scanned(read_table(tune(spark), sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from labels outside the held-out fold; a missing text is empty."""
    tune(spark)
    scores = quality_model.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return predicted(scores, 0.3)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies of every document; texts without words are linked with nothing."""
    documents = read_table(tune(spark), sf_dir, "documents")
    groups = near_copies.near_copy_groups(documents, near_copies.Likeness(words=4))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return groups.withColumn("kept", kept)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the word vocabulary, from a cache that starts empty; a missing text has none."""
    documents = read_table(tune(spark), sf_dir, "documents")
    found = counts.token_counts(documents, WORD_VOCABULARY, scratch_path(spark, "token-cache"))
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and the text that they decode to; a missing text is empty."""
    return piece_transducer.round_trips(read_table(tune(spark), sf_dir, "documents"), PIECE_MODEL)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every hundredth vector; vectors that are missing or not finite take no part."""
    vectors = read_table(tune(spark), sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op9_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files; a missing text is its end id alone."""
    documents = read_table(tune(spark), sf_dir, "documents")
    manifest = arrow_files.write_sequences(documents, scratch_path(spark, "sequences"), WORD_VOCABULARY)
    return arrow_files.read_documents(manifest)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; a missing text has no words and fails."""
    rows = quality_rules.line_rules(read_table(tune(spark), sf_dir, "documents"))
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_removed")
    return rows.select("doc_id", *[F.col(f"{quality_rules.RULES}.{c}").alias(c) for c in shown])


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document, by SimHash at three bits."""
    return simhash_links.simhash_groups(read_table(tune(spark), sf_dir, "documents"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of every document's tokens by the byte-level vocabulary and the piece model."""
    return token_alignment.token_alignment(read_table(tune(spark), sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first eight components of all vectors, in units of their spread."""
    return whitening.whitened(read_table(tune(spark), sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_toxicity,
        op3_secret_scans,
        op4_quality_classifier,
        op5_minhash_near_dedup,
        op6_token_counts,
        op7_sentencepiece,
        op8_exact_top_k,
        op9_arrow_token_files,
        op10_quality_rules,
        op11_simhash_near_dedup,
        op12_cross_tokenizer_alignment,
        op13_embedding_whitening,
    )
}

ORACLE = {
    "op5_minhash_near_dedup": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, regexp_extract_all(
                translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), each AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle
            FROM docs
        ), sizes AS (
            SELECT doc_id, COUNT(*) AS n FROM each GROUP BY doc_id
        ), shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS n
            FROM each x JOIN each y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
        ), links AS (
            SELECT a, b FROM shared s JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * s.n >= 80 * (p.n + q.n - s.n)
        ), reached(a, b) AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
        ), least AS (
            SELECT a AS doc_id, MIN(b) AS b FROM reached GROUP BY a
        )
        SELECT doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles,
               CAST(LEAST(doc_id, COALESCE(b, doc_id)) AS BIGINT) AS component_id, doc_id <= COALESCE(b, doc_id) AS kept
        FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
    """,
    "op10_quality_rules": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text, COALESCE(CAST(source AS VARCHAR), '') AS host
            FROM documents
        ), cut AS (
            SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM docs
        ), word AS (
            SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM cut
        ), three AS (
            SELECT r, i, w, lead(w) OVER following AS x, lead(w, 2) OVER following AS y
            FROM word WINDOW following AS (PARTITION BY r ORDER BY i)
        ), again AS (
            SELECT r, i FROM three WHERE y IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, w, x, y) > 1
        ), repeated AS (
            SELECT r, SUM(gap) AS n
            FROM (SELECT r, LEAST(3, COALESCE(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3)) AS gap FROM again)
            GROUP BY r
        ), line AS (
            SELECT r, host, text, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n,
                   trim(regexp_replace(translate(lower(raw), '123456789' || chr(9) || chr(11) || chr(12) || chr(13),
                                                 '000000000    '), '  +', ' ', 'g'), ' ') AS plain
            FROM (SELECT r, host, text, unnest(lines) AS raw FROM cut)
        ), hosts AS (
            SELECT host, COUNT(DISTINCT text) AS documents FROM docs GROUP BY host
        ), frequent AS (
            SELECT l.host, l.plain FROM line l JOIN hosts h ON h.host = l.host
            GROUP BY l.host, l.plain, h.documents
            HAVING COUNT(DISTINCT l.text) > GREATEST(20, h.documents * 0.005)
        ), removed AS (
            SELECT r, SUM(n) AS n FROM line SEMI JOIN frequent USING (host, plain) GROUP BY r
        ), base AS (
            SELECT c.doc_id, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(COALESCE(p.n, 0) AS BIGINT) AS n_repeat_words, CAST(COALESCE(g.n, 0) AS BIGINT) AS words_removed
            FROM cut c LEFT JOIN repeated p ON p.r = c.r LEFT JOIN removed g ON g.r = c.r
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
               AND n_words - words_removed >= 0.5 * n_words AS kept
        FROM base
    """,
    "op8_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
}
