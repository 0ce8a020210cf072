"""The bronze and silver-trigger jobs on archives built from ``documents`` and loose objects
written from ``pages`` (S4, S7, S9, K6, K7, K9, K11, X10, A3, R2-R4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import jobs
from quarry import schemas as S
from quarry.functions import keys as K
from quarry.operators import bronze, landing
from quarry.operators import tables as tbl
from quarry.plans.bronze_queries import DOCS_PER_ARCHIVE, build_archives
from quarry.plans.landing_queries import ACCOUNT
from quarry.plans.registry import register
from quarry.plans.standins import table
from quarry.session import listing_by_the_core, scratch_path

BUCKET = f"imgp-dev-landing-acme-{ACCOUNT}"
DAY = "2024-06-01"
PREFIX = f"partner=acme/dataset=%s/ingest_date={DAY}/"
DOCUMENT = S.struct(
    ("drop_id", S.S),
    ("dataset", S.S),
    ("file_count", S.L),
    ("total_bytes", S.L),
    ("files", S.T.ArrayType(S.struct(("key", S.S), ("size_bytes", S.L), ("crc32", S.L), ("content_type", S.S)))),
)


def _register(spark: SparkSession, layout: jobs.Layout, keys: DataFrame) -> None:
    """Object-created events of ``keys`` (src_key), registered as drops."""
    detail = F.struct(
        F.struct(F.lit(BUCKET).alias("name")).alias("bucket"),
        F.struct(F.col("src_key").alias("key"), F.lit(1).cast("long").alias("size"), F.md5("src_key").alias("etag")).alias("object"),
    )
    jobs.register_events(spark, layout, keys.select(detail.alias("detail"), F.lit(f"{DAY}T10:00:00Z").alias("time")))


def _unpacked(spark: SparkSession, sf_dir: str) -> jobs.Layout:
    layout = jobs.Layout(scratch_path(spark, "bronze-chain"))
    build_archives(spark, sf_dir, f"{layout.landing}/{BUCKET}/drops")
    block = F.floor(F.col("doc_id") / DOCS_PER_ARCHIVE).cast("string")
    archives = table(spark, sf_dir, "documents").select(F.concat(F.lit("drops/docs-"), block, F.lit(".zip")).alias("src_key")).distinct()
    _register(spark, layout, archives)
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    return layout


SQL_ENTRIES = f"""
entry AS (
  SELECT 'docs-' || CAST(doc_id // {DOCS_PER_ARCHIVE} AS VARCHAR) AS dataset, doc_id,
         source || '/' || lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS path, strlen(text) AS bytes
  FROM documents)
"""


@register(
    "bronze_manifest_documents",
    "S4 S7 K6 K7 X10 X12 A3",
    f"""WITH {SQL_ENTRIES}
SELECT dataset, CAST(row_number() OVER (PARTITION BY dataset ORDER BY doc_id) - 1 AS INTEGER) AS pos,
       '{PREFIX.replace("%s", "' || dataset || '")}' || path AS key, CAST(bytes AS BIGINT) AS size_bytes,
       'text/plain' AS content_type, TRUE AS crc_matches,
       count(*) OVER (PARTITION BY dataset) AS file_count,
       CAST(sum(bytes) OVER (PARTITION BY dataset) AS BIGINT) AS total_bytes
FROM entry""",
)
def bronze_manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest documents that the bronze job writes, read back with their ordered files; the
    listed CRCs are compared with those of the documents."""
    layout = _unpacked(spark, sf_dir)
    with listing_by_the_core(spark):  # the documents alone are listed, not the objects beside them
        docs = spark.read.schema(DOCUMENT).option("multiLine", True).option("recursiveFileLookup", True).json(K.manifest_glob(layout.bronze))
    files = docs.select("dataset", "file_count", "total_bytes", F.posexplode("files").alias("pos", "f")).select(
        "dataset", "pos", "f.key", "f.size_bytes", "f.content_type", "f.crc32", "file_count", "total_bytes"
    )
    text = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("_doc"), F.crc32(F.col("text").cast("binary")).alias("_crc")
    )
    of_doc = files.withColumn("_doc", F.regexp_extract("key", r"doc_(\d+)\.txt$", 1))
    return of_doc.join(text, "_doc", "left").select(
        "dataset", "pos", "key", "size_bytes", "content_type", F.col("crc32").eqNullSafe(F.col("_crc")).alias("crc_matches"), "file_count", "total_bytes"
    )


@register(
    "loose_objects_copied",
    "S6 K9 K11 R3",
    f"""
SELECT 'drops/page-' || CAST(page_id AS VARCHAR) || '.png' AS src_key,
       CASE WHEN page_id % 10 = 0 THEN 'FAILED' ELSE 'DONE' END AS status,
       CASE WHEN page_id % 10 <> 0 THEN '{PREFIX.replace("%s", "loose")}page-' || CAST(page_id AS VARCHAR) || '.png' END AS bronze_key,
       page_id % 10 = 0 AS has_error,
       CASE WHEN page_id % 10 <> 0 THEN sha256(html) END AS sha256
FROM pages""",
)
def loose_objects_copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose objects copied to bronze with the outcome of each drop; every tenth object is announced
    but never lands, and its drop is FAILED.  Copied content is read back and hashed."""
    layout = jobs.Layout(scratch_path(spark, "loose-chain"))
    pages = table(spark, sf_dir, "pages").select("page_id", "html", F.concat(F.lit("drops/page-"), F.col("page_id"), F.lit(".png")).alias("src_key"))
    landed = pages.where(F.col("page_id") % 10 != 0).select(F.col("src_key").alias("key"), F.col("html").cast("binary").alias("content"))
    bronze.write_objects(landed, f"{layout.landing}/{BUCKET}").count()
    _register(spark, layout, pages.select("src_key"))
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    led = tbl.read_table(spark, layout.ledger, jobs.ledger_stream.LEDGER_TABLE).select("drop_id", "src_key")
    status = landing.latest_status(tbl.read_table(spark, layout.ledger_status, jobs.STATUS_EVENTS))
    outcome = led.join(status, "drop_id").select("src_key", "status", "bronze_key", F.col("error").isNotNull().alias("has_error"))
    stored = bronze.read_objects(outcome.where("bronze_key is not null").select(F.col("bronze_key").alias("key")), layout.bronze)
    hashed = stored.select(F.col("key").alias("bronze_key"), F.sha2("content", 256).alias("sha256"))
    return outcome.join(hashed, "bronze_key", "left").select("src_key", "status", "bronze_key", "has_error", "sha256")


@register(
    "manifest_stream_trigger",
    "S9 R2 R4 A4 F11",
    f"""WITH {SQL_ENTRIES}
SELECT DISTINCT 'silver#{PREFIX.replace("%s", "' || dataset || '")}manifest.json' AS drop_id, 'NOOP' AS status FROM entry""",
)
def manifest_stream_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream over manifests ledgers every manifest once and routes it: archives of text
    files need no silver job.  It runs twice; the second run finds nothing new."""
    from quarry.streaming import manifests

    layout = _unpacked(spark, sf_dir)
    for _ in range(2):
        manifests.start_silver_stream(spark, layout, scratch_path(spark, "silver-ckpt")).awaitTermination()
    return tbl.read_table(spark, layout.silver_ledger, manifests.LEDGER_TABLE).select("drop_id", "status")
