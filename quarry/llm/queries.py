"""The registered queries of this subpackage: each applies one operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.shared import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(
    "op1_exact_dedup",
    """
    WITH n AS (
      SELECT doc_id, length(coalesce(text, '')) AS chars,
             regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
      FROM documents),
    g AS (
      SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id
      FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
    """,
)
def op1(spark, sf_dir):
    from quarry.llm.exact_dedup import exact_dedup

    return exact_dedup(documents(spark, sf_dir))


@query("op2_token_counts")
def op2(spark, sf_dir):
    from quarry.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))


@query("op5_best_fit_packing")
def op5(spark, sf_dir):
    from quarry.llm.packing import pack_documents

    return pack_documents(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))


@query("op7_bpe_roundtrip")
def op7(spark, sf_dir):
    from quarry.llm.bpe_roundtrip import encode_documents

    return encode_documents(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"), keep_ids=False)


@query("op10_sharding")
def op10(spark, sf_dir):
    from quarry.llm.sharding import shard_documents

    return shard_documents(documents(spark, sf_dir))


@query("op9_near_dedup")
def op9(spark, sf_dir):
    from quarry.llm.near_dedup import near_dedup

    return near_dedup(documents(spark, sf_dir))


@query(
    "op8_exact_topk",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS (
      SELECT a.vec_id AS query_id, b.vec_id,
             CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 20
    """,
)
def op8(spark, sf_dir):
    from quarry.llm.topk import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op3_quality")
def op3(spark, sf_dir):
    from quarry.llm.quality import score_quality

    return score_quality(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op4_toxicity")
def op4(spark, sf_dir):
    from quarry.llm.toxicity import score_toxicity

    return score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op6_html_main_text")
def op6(spark, sf_dir):
    from quarry.llm.html_text import extract_main_text

    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query(
    "op11_warc",
    """
    WITH p AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead FROM pages)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
             ((CAST('0x' || substr(h, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
           CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> lead THEN lead END AS refers_to
    FROM p
    """,
)
def op11(spark, sf_dir):
    from quarry.llm.warc import archive_pages
    from quarry.session import scratch_path

    rows = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_path(spark, "web-archive"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op12_whitening")
def op12(spark, sf_dir):
    from quarry.llm.whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query(
    "op13_lexical_search",
    """
    WITH d AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM documents),
    i AS (
      SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM benchmark),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
    len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
    st AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM len),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
          FROM tf, st GROUP BY term, n_docs),
    s AS (
      SELECT i.item_id, tf.doc_id,
             CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * len.n * st.n_docs) // st.n_terms)))) AS BIGINT) AS score
      FROM i JOIN tf USING (term) JOIN w USING (term) JOIN len ON len.doc_id = tf.doc_id, st
      GROUP BY i.item_id, tf.doc_id)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    WHERE rank <= 10
    """,
)
def op13(spark, sf_dir):
    from quarry.llm.lexical import ranked_search

    return ranked_search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), documents(spark, sf_dir))
