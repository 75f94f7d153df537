"""The registered queries of this package: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import chat_digests, format_chats
from .common import table
from .exact_dedup import exact_dedup
from .filter_audit import filter_audit
from .licenses import scan_licenses
from .mixing import mix
from .neighbours import nearest
from .packing import pack, tokenizer_path
from .quality import quality
from .secrets import scan_secrets
from .simhash import simhash_dedup
from .source_audit import source_divergence
from .suffix_dedup import suffix_dedup
from .token_counts import token_counts, unigram_vocabulary

#: DuckDB SQL of those queries that SQL can express.
ORACLE: dict[str, str] = {}


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the bytes left after removing 50-byte strings that start in an earlier document."""
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the words that the mix of sources takes."""
    return mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its secrets; owner-specific ones add live spans (owner: source, repository: document)."""
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_candidates", "n_live")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the license phrases and templates found."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the SimHash fingerprint and the component of near duplicates."""
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the quality counts and the verdict."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: A conversation whose texts hold control strings of common templates.
CONTROL_CHAT = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation what its formatted text says when it is read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(CONTROL_CHAT, "conv_id long, turn long, role string, text string"))
    return chat_digests(format_chats(rows))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece its place in the packed sequences."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the class of equal texts."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the pieces of a unigram vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), unigram_vocabulary(tokenizer_path("piece_bpe_32k.model")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language, order of five filters and step what the step keeps and removes."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source of a language its distance to the other sources and the terms it has more of."""
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE["op9_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents),
     c AS (SELECT s, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY s)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t.s) AS text_sha256
FROM t JOIN c ON t.s = c.s
"""

ORACLE["op11_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS s, coalesce(lang, '') AS part FROM documents),
     w AS (SELECT *, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY s) AS least FROM t),
     l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
     f AS (SELECT part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
                  CASE WHEN len(words) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * list_unique(words) < 80 * len(words) THEN 'B' ELSE '' END
                  || CASE WHEN 100 * length(regexp_replace(s, '[^A-Z]', '', 'g')) > 10 * length(s) THEN 'C' ELSE '' END
                  || CASE WHEN regexp_matches(s, '[#$%&*|]') THEN 'D' ELSE '' END
                  || CASE WHEN w.doc_id > least THEN 'E' ELSE '' END AS fails
           FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
     c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
     o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
           FROM (SELECT unnest(string_split('ABCDE', '')) AS x) a, (SELECT unnest(string_split('ABCDE', '')) AS x) b,
                (SELECT unnest(string_split('ABCDE', '')) AS x) c, (SELECT unnest(string_split('ABCDE', '')) AS x) d,
                (SELECT unnest(string_split('ABCDE', '')) AS x) e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     k AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
     j AS (SELECT c.*, filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier FROM c, k),
     p AS (SELECT *, contains(fails, letter) AS here, translate(earlier, fails, '') <> earlier AS before FROM j),
     r AS (SELECT part, filter_order, step, letter,
                  coalesce(sum(n) FILTER (NOT here AND NOT before), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT before), 0) AS removed,
                  coalesce(sum(n) FILTER (here AND before), 0) AS redundant, coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
                  coalesce(sum(good) FILTER (here AND NOT before), 0) AS good_lost,
                  coalesce(sum(toxic) FILTER (here AND NOT before), 0) AS toxic_lost
           FROM p GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM r
"""

ORACLE["op13_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
     kept AS (SELECT lang, term, count(*) AS n FROM d GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
     v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
     g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
     n AS (SELECT lang, source, term, count(*) AS n FROM d SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
     c AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0)::HUGEINT AS n, kept.n::HUGEINT AS whole
           FROM g JOIN kept ON g.lang = kept.lang
           LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
     s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source)::HUGEINT AS own FROM c),
     p AS (SELECT s.lang, source, term, n, 1 + (1000000000 * (n + 5)) // (own + 5 * v) AS p,
                  1 + (1000000000 * (whole + 5)) // (total + 5 * v) AS q FROM s JOIN v ON s.lang = v.lang),
     far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
     words AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
                FROM (SELECT * FROM pairs UNION ALL SELECT * FROM words))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

QUERIES = {q.__name__: q for q in (
    op1_suffix_dedup, op2_mixing, op3_secrets, op4_licenses, op5_simhash, op6_quality, op7_chat, op8_packing,
    op9_exact_dedup, op10_token_counts, op11_filter_audit, op12_neighbours, op13_source_divergence)}
