"""The registered queries of this subpackage and their SQL, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    bpe,
    exact,
    extract,
    jaccard,
    lines,
    mixing,
    near,
    quality,
    repeats,
    spelling,
    unigram,
    urls,
    whitening,
)
from touchline.llm.common import table


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicated_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256")
    )


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


URL_RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extracted(table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_url_filters": op4_url_filters,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_rules": op6_quality_rules,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_html_text": op9_html_text,
    "op10_token_counts": op10_token_counts,
    "op11_spelling_groups": op11_spelling_groups,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
        ), worded AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq,
                   row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS k
            FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ), pairs AS (
            SELECT a.doc_id, a.pos AS s, b.pos AS e,
                   row_number() OVER (PARTITION BY a.line, b.line ORDER BY a.doc_id, a.pos) AS k
            FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.seq = a.seq + 1
        ), removed AS (
            SELECT doc_id, pos FROM worded WHERE k > 1
            UNION
            SELECT doc_id, unnest(range(s, e + 1)) AS pos FROM pairs WHERE k > 1
        ), marked AS (
            SELECT l.*, r.pos IS NOT NULL AS gone,
                   lag(r.pos IS NOT NULL, 1, false) OVER (
                       PARTITION BY l.doc_id ORDER BY l.pos) AS before
            FROM l LEFT JOIN removed r ON l.doc_id = r.doc_id AND l.pos = r.pos
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
               count(*) FILTER (gone AND NOT before) AS n_runs,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op6_quality_rules": r"""
        WITH t AS (
            SELECT doc_id, source AS host, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), windows AS (
            SELECT doc_id, i, list_slice(words, i, i + 4) AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM t)
        ), repeated AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS k FROM windows)
            WHERE k > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id
        ), measured AS (
            SELECT t.doc_id, host, len(words)::BIGINT AS n_words,
                   coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT
                       AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   coalesce(n, 0)::BIGINT AS n_repeat_words
            FROM t LEFT JOIN covered USING (doc_id)
        ), judged AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
            FROM measured
        ), counts AS (
            SELECT host, count(*) AS n, sum(base_failed::BIGINT) AS f FROM judged GROUP BY host
        ), moments AS (
            SELECT sum(f) / sum(n) AS m, sum(n * (f / n) * (f / n)) / sum(n) AS m2 FROM counts
        ), prior AS (
            SELECT m, greatest(CASE WHEN m2 - m * m > 1e-12 THEN m * (1 - m) / (m2 - m * m) - 1
                                    ELSE 20.0 END, 1.0) AS s
            FROM moments
        ), hosts AS (
            SELECT host AS verdict_host, (f + m * s) / (n + s) >= 0.5 AS rejected
            FROM counts, prior
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT rejected AS kept
        FROM judged JOIN hosts ON host IS NOT DISTINCT FROM verdict_host
    """,
    "op8_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents
        ), w AS (
            SELECT *, first_value(doc_id) OVER (
                       PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY content) AS group_size
            FROM t
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
               sha256(content) AS text_sha256
        FROM w
    """,
    "op12_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda w: w <> '') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id,
                   unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                               ELSE list_transform(range(1, len(w) - 3),
                                                   lambda k: array_to_string(w[k:k + 4], ' ')) END) AS s
            FROM words WHERE len(w) > 0
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
            GROUP BY x.doc_id, y.doc_id
        ), links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * k >= 80 * (p.n + q.n - k)
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id,
               c.component_id = d.doc_id AS kept
        FROM documents d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) c ON c.a = d.doc_id
    """,
}
