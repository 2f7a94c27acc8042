"""The registered queries of this subpackage: each operator over its whole table.

SQL is given where it can express the result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bpe, chat, fim, fingerprint, jaccard, minhash, negatives, packing, secrets, substring, topk, toxicity, warc
from tablewright.session import fresh_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql:
            SQL[function.__name__] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), path)
    return packed.selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query()
def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


# What a turn's text adds to its escaped form, and the turn's length in the template.
_CHAT_SQL = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')
), n AS (
    SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
        sum(14 + length(role) + length(replace(replace(replace(text, '\\', '\\\\'), '##', '#\\#'), '</turn>', '<\\/turn>'))) OVER w AS upto
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(upto) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""


@query(_CHAT_SQL)
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    return chat.digests(conversations.unionByName(probe))


@query()
def op9_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_neighbours(_table(spark, sf_dir, "documents"))


@query(
    """
SELECT page_id, octet_length(p)::BIGINT AS payload_bytes, upper(d) AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM (
    SELECT *, min(page_id) OVER (PARTITION BY p) AS first,
        list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1) FOR i IN range(32)], 'string_agg', '') AS d
    FROM (SELECT page_id, encode(coalesce(html, '')) AS p, sha1(coalesce(html, '')) AS h FROM pages)
)
"""
)
def op4_warc_boundary_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, {"payload_bytes": F.octet_length, "payload_digest": warc.base32_sha1})
    return warc.page_digests(records)


@query()
def op10_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "severity", "grade", "is_toxic")


@query(
    """
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
    FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
)
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 50 = 0"), k=5, scale=256)


@query()
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(_table(spark, sf_dir, "documents"))


@query()
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


@query(
    """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
    SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
        ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d
), c AS (
    SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
        array_to_string(u[b + 1:n], '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_table(spark, sf_dir, "documents"))


@query(
    """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.e, v.e)::BIGINT AS score
    FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id AND len(a.e) = len(v.e)
), p AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same
), n AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND p.place <= 5 AND NOT s.same
        AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return negatives.hard_negatives(rows, lambda vec_id: vec_id % 100 == 0, positives=5, k=5, low=80, high=100, scale=256)


@query(
    """
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), g AS (
    SELECT DISTINCT r, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS gram
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT r, count(*) AS n FROM g GROUP BY r
), o AS (
    SELECT a.r AS u, b.r AS v, count(*) AS shared FROM g AS a JOIN g AS b ON a.gram = b.gram AND a.r <> b.r GROUP BY a.r, b.r
), l AS (
    SELECT u, v FROM o JOIN n AS a ON a.r = u JOIN n AS b ON b.r = v WHERE 100 * shared >= 90 * (a.n + b.n - shared)
), c AS (
    SELECT r AS node, r AS other FROM d UNION SELECT c.node, l.v FROM c JOIN l ON c.other = l.u
), m AS (
    SELECT node, min(doc_id) AS component_id FROM c JOIN d ON d.r = c.other GROUP BY node
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, (SELECT count(*) FROM l WHERE l.u = d.r)::BIGINT AS n_links
FROM d JOIN m ON m.node = d.r LEFT JOIN n ON n.r = d.r
"""
)
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"), percent=90, width=3)
