"""Queries that write and read back tables and documents (S1, S3, S4, S5, K2, K3, K5,
K7, K12, S11, J6, A3, F8, F9, X15, X18).

Writes go to a fresh folder below the session's shared checkpoint folder; nothing is
written near the input tables.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import annotations as ann_ops
from quarry.operators import gold
from quarry.operators import manifest as man_ops
from quarry.operators import tables as tbl
from quarry.plans import standins as si
from quarry.plans.registry import register
from quarry.plans.standins import table
from quarry.session import scratch_path
from quarry.sources import documents

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# ---------------------------------------------------------------------------------------
# S3 / F1: a silver table partitioned by slice, scanned for one slice (partition pruning).
def _orders_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.lit(si.PARTNER).alias("partner"),
        F.lower("o_orderpriority").alias("dataset"),
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("ingest_date"),
        F.col("o_orderstatus").alias("split"),
        F.col("o_orderkey").alias("image_id"),
        F.col("o_custkey").alias("width"),
    )


SLICE = {"partner": si.PARTNER, "dataset": "1-urgent", "ingest_date": "1997-01-01", "split": "F"}


@register(
    "scan_silver_slice",
    "S3 F1",
    f"""
SELECT * FROM (
  SELECT '{si.PARTNER}' AS partner, lower(o_orderpriority) AS dataset,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS ingest_date, o_orderstatus AS split,
         o_orderkey AS image_id, o_custkey AS width
  FROM orders)
WHERE partner = '{SLICE["partner"]}' AND dataset = '{SLICE["dataset"]}'
  AND ingest_date = DATE '{SLICE["ingest_date"]}' AND split = '{SLICE["split"]}'
""",
)
def scan_silver_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver-images")
    tbl.stage(_orders_silver(spark, sf_dir), path, S.SLICE_PARTITION)
    schema = S.struct(
        ("image_id", S.L), ("width", S.L), ("partner", S.S), ("dataset", S.S), ("ingest_date", S.DT), ("split", S.S)
    )
    return gold.scan_slice(tbl.read_table(spark, path, schema), **SLICE)


# ---------------------------------------------------------------------------------------
# Annotations staged under partner=/dataset=/ingest_date=/split= folders, read back
# from the root with partition discovery (explicit types), one ingest date.
def _staged_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.lit(si.PARTNER).alias("partner"),
        F.concat(F.lit("flag-"), F.lower("l_returnflag")).alias("dataset"),
        F.to_date(F.date_trunc("year", "l_shipdate")).alias("ingest_date"),
        F.col("l_linestatus").alias("split"),
        F.col("l_orderkey").alias("image_id"),
        F.col("l_partkey").alias("category_id"),
        F.col("l_extendedprice").alias("area"),
    )


@register(
    "scan_staged_partition",
    "S1 S2 K5",
    f"""
SELECT '{si.PARTNER}' AS partner, 'flag-' || lower(l_returnflag) AS dataset,
       CAST(date_trunc('year', l_shipdate) AS DATE) AS ingest_date, l_linestatus AS split,
       l_orderkey AS image_id, l_partkey AS category_id, l_extendedprice AS area
FROM lineitem
""",
)
def scan_staged_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "staging-annotations")
    tbl.stage(_staged_annotations(spark, sf_dir), path, S.SLICE_PARTITION)
    schema = S.struct(
        ("image_id", S.L),
        ("category_id", S.L),
        ("area", S.D),
        ("partner", S.S),
        ("dataset", S.S),
        ("ingest_date", S.DT),
        ("split", S.S),
    )
    return tbl.read_table(spark, path, schema)


# ---------------------------------------------------------------------------------------
# Upsert on event_id.  Target: events before Jan 21; staged: events from Jan 15
# with value + 1 (overlap updates, the rest inserts).  Partitioned by day.
TARGET_END = _dt.datetime(2024, 1, 21)
STAGED_START = _dt.datetime(2024, 1, 15)
EVENT_SCHEMA = S.struct(
    ("event_id", S.L), ("ts", S.T.TimestampNTZType()), ("user_id", S.L), ("event_type", S.S), ("value", S.D), ("day", S.DT)
)


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "ts", "user_id", "event_type", "value", F.to_date("ts").alias("day"))


@register(
    "upsert_merge",
    "K2 J4",
    f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts >= TIMESTAMP '{STAGED_START}' THEN value + 1 ELSE value END AS value,
       CAST(ts AS DATE) AS day
FROM events
""",
)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    path = scratch_path(spark, "silver-events")
    tbl.create(spark, ev.where(F.col("ts") < F.lit(TARGET_END)), path, ["day"], "events")
    staged = ev.where(F.col("ts") >= F.lit(STAGED_START)).withColumn("value", F.col("value") + 1)
    tbl.upsert_into(spark, staged, path, "event_id", ["day"], "events", EVENT_SCHEMA)
    return tbl.read_table(spark, path, EVENT_SCHEMA)


# K3: replace days 10-12 with only their purchases (value doubled); other days untouched.
REPLACE_DAYS = (_dt.date(2024, 1, 10), _dt.date(2024, 1, 12))


@register(
    "overwrite_partitions",
    "K3",
    f"""
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) NOT BETWEEN DATE '{REPLACE_DAYS[0]}' AND DATE '{REPLACE_DAYS[1]}'
UNION ALL
SELECT event_id, ts, user_id, event_type, value * 2 AS value, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{REPLACE_DAYS[0]}' AND DATE '{REPLACE_DAYS[1]}' AND event_type = 'purchase'
""",
)
def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    path = scratch_path(spark, "silver-events")
    tbl.create(spark, ev, path, ["day"], "events")
    days = F.col("day").between(F.lit(REPLACE_DAYS[0]), F.lit(REPLACE_DAYS[1]))
    repl = ev.where(days & (F.col("event_type") == "purchase")).withColumn("value", F.col("value") * 2)
    tbl.overwrite_partitions(spark, repl, path, ["day"], "events")
    return tbl.read_table(spark, path, EVENT_SCHEMA)


# The same on the session catalog: a table is created, seen to exist, has days overwritten; another is replaced.
@register(
    "catalog_tables",
    "S10 K1 K3 K4 (session catalog)",
    f"""
SELECT 'overwritten' AS kind, event_id, value, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) NOT BETWEEN DATE '{REPLACE_DAYS[0]}' AND DATE '{REPLACE_DAYS[1]}'
UNION ALL
SELECT 'overwritten', event_id, value * 2, CAST(ts AS DATE) FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{REPLACE_DAYS[0]}' AND DATE '{REPLACE_DAYS[1]}' AND event_type = 'purchase'
UNION ALL
SELECT 'replaced', event_id, value, CAST(ts AS DATE) FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT 'existed before: false, after: true', count(*), NULL, NULL FROM events
""",
)
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir).select("event_id", "event_type", "value", "day")
    kept, renewed = (f"quarry_events_{uuid.uuid4().hex[:12]}" for _ in range(2))
    before = tbl.table_exists(spark, kept)
    for name in (kept, renewed):
        tbl.create_table(ev, name, ["day"])
    after = tbl.table_exists(spark, kept)
    days = F.col("day").between(F.lit(REPLACE_DAYS[0]), F.lit(REPLACE_DAYS[1]))
    purchases = ev.where(F.col("event_type") == "purchase")
    tbl.overwrite_table_partitions(spark, purchases.where(days).withColumn("value", F.col("value") * 2), kept)
    tbl.replace_table(purchases, renewed, ["day"])
    seen = f"existed before: {str(before).lower()}, after: {str(after).lower()}"
    told = ev.agg(F.count(F.lit(1)).alias("event_id")).select(
        F.lit(seen).alias("kind"), "event_id", F.lit(None).cast("double").alias("value"), F.lit(None).cast("date").alias("day")
    )
    rows = [spark.table(n).select(F.lit(k).alias("kind"), "event_id", "value", "day") for n, k in ((kept, "overwritten"), (renewed, "replaced"))]
    return rows[0].unionByName(rows[1]).unionByName(told)


# Three commits on an events table (create days 1-10, merge days 8-19, overwrite days
# 20-30); the version log counts them and the rows each wrote.
@register(
    "table_version_counts",
    "S11 K12",
    """
SELECT 'events' AS table_name, CAST(3 AS BIGINT) AS n_versions,
       CAST((SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-11')
          + (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-20')
          + (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20') AS BIGINT) AS rows_written
""",
)
def table_version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    path = scratch_path(spark, "silver-events")
    ts = F.col("ts")
    tbl.create(spark, ev.where(ts < F.lit(_dt.datetime(2024, 1, 11))), path, ["day"], "events")
    staged = ev.where((ts >= F.lit(_dt.datetime(2024, 1, 8))) & (ts < F.lit(_dt.datetime(2024, 1, 20))))
    tbl.upsert_into(spark, staged, path, "event_id", ["day"], "events", EVENT_SCHEMA)
    tbl.overwrite_partitions(spark, ev.where(ts >= F.lit(_dt.datetime(2024, 1, 20))), path, ["day"], "events")
    return tbl.version_counts(tbl.read_versions(spark, path))


@register(
    "table_audit_counts",
    "K12 A5",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLE_NAMES),
)
def table_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tbl.audit_counts({t: table(spark, sf_dir, t) for t in TABLE_NAMES})


# ---------------------------------------------------------------------------------------
# Manifests from events: a drop is (user, day); its files are the user's events that day.
def _event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "user_id",
        F.to_date("ts").alias("day"),
        F.col("event_id").alias("pos"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string"), F.lit(".jpg")).alias(
            "key"
        ),
        F.round(F.col("value") * 100).cast("long").alias("size_bytes"),
        F.crc32(F.col("props")).alias("crc32"),
    )


SQL_EVENT_FILES = """
ef AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id AS pos,
              'u' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) || '.jpg' AS key,
              CAST(round(value * 100) AS BIGINT) AS size_bytes
       FROM events)
"""


@register(
    "manifest_build",
    "A3",
    f"""WITH {SQL_EVENT_FILES}
SELECT user_id, day, count(*) AS file_count, CAST(sum(size_bytes) AS BIGINT) AS total_bytes FROM ef GROUP BY user_id, day""",
)
def manifest_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return man_ops.header(_event_files(spark, sf_dir), ["user_id", "day"])


@register(
    "manifest_explode",
    "S4 K7 X18",
    f"WITH {SQL_EVENT_FILES} SELECT user_id, day, key, size_bytes FROM ef",
)
def manifest_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files -> bounded manifest pages -> JSON documents on storage -> read back with the
    page schema -> one row per listed file."""
    pages = man_ops.pages(_event_files(spark, sf_dir), ["user_id", "day"])
    path = scratch_path(spark, "manifests")
    pages.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    schema = S.struct(("user_id", S.L), ("day", S.DT), ("page", S.L), ("files", S.T.ArrayType(S.MANIFEST_FILE)))
    docs = documents.read_json_docs(spark, path, schema, multi_line=False)
    return man_ops.explode_files(docs, ["user_id", "day"]).select("user_id", "day", "key", "size_bytes")


@register(
    "manifest_json",
    "K7 X18",
    """
SELECT 'conv#' || CAST(conv_id AS VARCHAR) AS drop_id, turn // 1000 AS page,
       count(*) AS page_file_count, CAST(sum(strlen(text)) AS BIGINT) AS page_bytes
FROM conversations GROUP BY conv_id, turn // 1000
""",
)
def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation a manifest of its turns, written as JSON and parsed back."""
    c = table(spark, sf_dir, "conversations")
    files = c.select(
        F.concat(F.lit("conv#"), F.col("conv_id").cast("string")).alias("drop_id"),
        F.col("turn").alias("pos"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("/turn_"), F.col("turn").cast("string")).alias("key"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        F.crc32(F.col("text").cast("binary")).alias("crc32"),
    )
    pages = man_ops.pages(files, ["drop_id"])
    path = scratch_path(spark, "manifest-json")
    pages.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    schema = S.struct(("drop_id", S.S), ("page", S.L), ("page_file_count", S.L), ("page_bytes", S.L))
    return documents.read_json_docs(spark, path, schema, multi_line=False)


@register(
    "manifest_missing_objects",
    "J6",
    """
SELECT DISTINCT l_orderkey AS image_id, 'missing' AS kind FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT o_orderkey AS image_id, 'unlisted' AS kind FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""",
)
def manifest_missing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed keys (annotated images) without a stored object, and stored objects
    (images) no annotation lists."""
    listed = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image_id"))
    objects = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    missing = man_ops.missing_objects(listed, objects, "image_id").distinct().withColumn("kind", F.lit("missing"))
    unlisted = man_ops.unlisted_objects(listed, objects, "image_id").withColumn("kind", F.lit("unlisted"))
    return missing.unionByName(unlisted)


# ---------------------------------------------------------------------------------------
# Conversations as caption documents (bounded pages of turns), written as JSON,
# read back with the captions schema and flattened with the delivery's base columns.
@register(
    "annotation_docs_explode",
    "S5 F8 F9 X15 X18",
    f"""
SELECT '{si.PARTNER}' AS partner, 'conversations' AS dataset, DATE '{si.INGEST_DATE}' AS ingest_date,
       'chat' AS split, turn AS caption_id, conv_id AS image_id, text AS caption
FROM conversations
""",
)
def annotation_docs_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    entry = F.struct(F.col("turn").alias("id"), F.col("conv_id").alias("image_id"), F.col("text").alias("caption"))
    docs = c.groupBy("conv_id", F.floor(F.col("turn") / 500).alias("page")).agg(
        F.collect_list(entry).alias("annotations")
    )
    path = scratch_path(spark, "caption-docs")
    docs.select(F.to_json(F.struct("annotations")).alias("value")).write.text(path)
    read = documents.read_json_docs(spark, path, S.CAPTIONS_DOC, multi_line=False)
    base = read.select(
        F.lit(si.PARTNER).alias("partner"),
        F.lit("conversations").alias("dataset"),
        F.lit(si.INGEST_DATE).alias("ingest_date"),
        F.lit("chat").alias("split"),
        F.struct("annotations").alias("doc"),
    )
    return ann_ops.captions(base, S.SLICE_PARTITION)


def _doc_writer(root: str):
    import json as _json

    import pandas as pd

    from quarry.operators.bronze import _open_out

    def write(pdf: "pd.DataFrame") -> "pd.DataFrame":
        conv, page = int(pdf["conv_id"].iloc[0]), int(pdf["page"].iloc[0])
        doc = {
            "info": {"description": "conversation turns as captions"},
            "annotations": [
                {"id": int(r.turn), "image_id": conv, "caption": r.text} for r in pdf.sort_values("turn").itertuples()
            ],
        }
        path = f"{root}/c{conv}-p{page}/captions_chat.json"
        with _open_out(path) as fh:
            fh.write(_json.dumps(doc, indent=1, ensure_ascii=False).encode("utf-8"))
        return pd.DataFrame({"path": [path]})

    return write


@register(
    "annotation_docs_stream",
    "S5 F5 F8 F9 X15",
    f"""
SELECT '{si.PARTNER}' AS partner, 'conversations' AS dataset, DATE '{si.INGEST_DATE}' AS ingest_date,
       'chat' AS split, turn AS caption_id, conv_id AS image_id, text AS caption
FROM conversations
""",
)
def annotation_docs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as caption documents, one multi-line file per conversation page
    (written by the executors), then the normaliser: file-name routing, Spark's
    JSON reader, base columns from the manifest rows."""
    root = scratch_path(spark, "caption-files")
    c = table(spark, sf_dir, "conversations").withColumn("page", F.floor(F.col("turn") / 500))
    listing = scratch_path(spark, "caption-paths")
    c.groupBy("conv_id", "page").applyInPandas(_doc_writer(root), "path string").write.parquet(listing)  # documents are written once
    files = spark.read.schema("path string").parquet(listing).select(
        "path",
        F.lit(si.PARTNER).alias("partner"),
        F.lit("conversations").alias("dataset"),
        F.lit(si.INGEST_DATE).alias("ingest_date"),
    )
    return ann_ops.normalize(spark, files)["coco_captions"]
