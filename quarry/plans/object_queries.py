"""Queries on object keys, manifests and image profiles (F2, F4, F5, F11, F12, A4, X6,
X8, X9, X11, X12, X13, X14, behaviour: thumbnail collisions).

Stand-in manifest files: every ``part`` row is one file of a delivery.  The delivery is
the brand plus a size band (``a``: images and instance documents, ``b``: captions,
keypoints and notes, ``c``: junk only, so it routes to NOOP); the file name is picked by
``p_size`` from ``NAME_RULES``; the folder is the part type, so equal names in two
folders collide on their thumbnail key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import keys as K
from quarry.operators import annotations as ann_ops
from quarry.operators import images as img_ops
from quarry.operators import manifest as man_ops
from quarry.plans.registry import register
from quarry.plans.standins import table

FILES_DATE = "2024-06-01"
# (largest p_size, kind, text, suffix): "base" -> <p_name with _><suffix>,
# "key" -> <text><p_partkey><suffix>, "lit" -> <text>.
NAME_RULES = [
    (8, "base", "", ".jpg"),
    (12, "base", "", ".JPEG"),
    (16, "base", "", ".png"),
    (18, "base", "", ".Bmp"),
    (20, "base", "", ".gif"),
    (22, "base", "", ".webp"),
    (25, "key", "instances_val", ".json"),
    (27, "key", "captions_train", ".json"),
    (28, "key", "person_keypoints_val", ".json"),
    (29, "key", "foo_instances_v", ".json"),
    (30, "key", "instances_x", ".txt"),
    (31, "lit", "instances.json", ""),
    (32, "lit", "_manifest.json", ""),
    (33, "key", "captions_", ".JSON"),
    (40, "key", "notes_", ".txt"),
    (45, "base", "", ".jpg.bak"),
    (50, "key", "README_", ""),
]
BANDS = [(25, "a"), (40, "b"), (50, "c")]


def _spark_name() -> Column:
    base = F.regexp_replace("p_name", " ", "_")
    key = F.col("p_partkey").cast("string")
    out: Column | None = None
    for hi, kind, text, suffix in reversed(NAME_RULES):
        val = {
            "base": F.concat(base, F.lit(suffix)),
            "key": F.concat(F.lit(text), key, F.lit(suffix)),
            "lit": F.lit(text),
        }[kind]
        out = val if out is None else F.when(F.col("p_size") <= hi, val).otherwise(out)
    return out


def _sql_name() -> str:
    whens = []
    for hi, kind, text, suffix in NAME_RULES:
        val = {
            "base": f"replace(p_name, ' ', '_') || '{suffix}'",
            "key": f"'{text}' || CAST(p_partkey AS VARCHAR) || '{suffix}'",
            "lit": f"'{text}'",
        }[kind]
        whens.append(f"WHEN p_size <= {hi} THEN {val}")
    return "CASE " + " ".join(whens) + " END"


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    band = F.lit("c")
    for hi, b in reversed(BANDS[:-1]):
        band = F.when(F.col("p_size") <= hi, F.lit(b)).otherwise(band)
    dataset = F.concat(F.lower(F.regexp_replace("p_brand", "#", "")), F.lit("-"), band)
    prefix = K.hive_prefix(F.lit("acme"), dataset, F.lit(FILES_DATE))
    return p.select(
        "p_partkey",
        prefix.alias("prefix"),
        F.concat(prefix, F.lit(K.MANIFEST_NAME)).alias("manifest_key"),
        F.concat(prefix, F.lower("p_type"), F.lit("/"), _spark_name()).alias("key"),
    )


_SQL_BAND = " ".join(f"WHEN p_size <= {hi} THEN '{b}'" for hi, b in BANDS[:-1])
SQL_FILES = f"""
mf0 AS (
  SELECT p_partkey,
         'partner=acme/dataset=' || lower(replace(p_brand, '#', '')) || '-' || CASE {_SQL_BAND} ELSE 'c' END ||
         '/ingest_date={FILES_DATE}/' AS prefix,
         lower(p_type) || '/' || {_sql_name()} AS rel
  FROM part),
mf AS (
  SELECT p_partkey, prefix, prefix || '{K.MANIFEST_NAME}' AS manifest_key, prefix || rel AS key,
         regexp_extract(prefix || rel, '[^/]*$', 0) AS file_name
  FROM mf0)
"""
_SQL_IS_IMAGE = " OR ".join(f"lower(key) LIKE '%{s}'" for s in K.IMAGE_SUFFIXES)
_SQL_CUT_LAST_DOT = "CASE WHEN strpos(file_name, '.') > 0 THEN regexp_extract(file_name, '^(.*)\\.', 1) ELSE file_name END"


@register(
    "image_key_filter",
    "F2",
    f"WITH {SQL_FILES} SELECT p_partkey, manifest_key, key FROM mf WHERE {_SQL_IS_IMAGE}",
)
def image_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = manifest_files(spark, sf_dir)
    return f.where(K.is_image_key("key")).select("p_partkey", "manifest_key", "key")


def _sql_content_type() -> str:
    whens = " ".join(f"WHEN '{e}' THEN '{t}'" for e, t in K.CONTENT_TYPES.items())
    ext = "CASE WHEN regexp_matches(file_name, '^.+\\.[^.]+$') THEN lower(regexp_extract(file_name, '(\\.[^.]+)$', 1)) END"
    return f"coalesce(CASE {ext} {whens} END, '{K.DEFAULT_CONTENT_TYPE}')"


@register(
    "content_types",
    "X12",
    f"WITH {SQL_FILES} SELECT p_partkey, key, {_sql_content_type()} AS content_type FROM mf",
)
def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = manifest_files(spark, sf_dir)
    return f.select("p_partkey", "key", K.content_type("key").alias("content_type"))


@register(
    "silver_routing",
    "A4 F4 F11",
    f"""
WITH {SQL_FILES}
SELECT manifest_key, n_files, n_images, n_coco_json,
       n_images > 0 AS run_profile, n_coco_json > 0 AS run_normalize,
       CASE WHEN n_images > 0 OR n_coco_json > 0 THEN 'SUBMITTED' ELSE 'NOOP' END AS status
FROM (SELECT manifest_key, count(*) AS n_files,
             count(*) FILTER (WHERE {_SQL_IS_IMAGE}) AS n_images,
             count(*) FILTER (WHERE regexp_matches(file_name, '{K.COCO_JSON_PATTERN}')) AS n_coco_json
      FROM mf GROUP BY manifest_key)
""",
)
def silver_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return man_ops.silver_routing(manifest_files(spark, sf_dir))


@register(
    "annotation_kind_split",
    "F5 X6",
    f"""
WITH {SQL_FILES},
k AS (SELECT p_partkey, file_name, {_SQL_CUT_LAST_DOT} AS stem FROM mf),
k2 AS (SELECT p_partkey, file_name, split_part(stem, '_', 1) AS kind,
              CASE WHEN strpos(stem, '_') > 0 THEN substr(stem, strpos(stem, '_') + 1) ELSE '' END AS split
       FROM k)
SELECT p_partkey, file_name, kind, split,
       CASE WHEN (kind = 'person' OR split = '') AND file_name LIKE 'person\\_keypoints\\_%' ESCAPE '\\' THEN 'skip_keypoints'
            WHEN kind = 'person' OR split = '' THEN 'ignore'
            WHEN kind IN ('instances', 'captions') THEN kind
            ELSE 'ignore' END AS action
FROM k2
""",
)
def annotation_kind_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = ann_ops.with_kind(manifest_files(spark, sf_dir))
    return f.select("p_partkey", "file_name", "kind", "split", "action")


@register(
    "thumbnail_key_collisions",
    "X8 (collisions)",
    f"""
WITH {SQL_FILES},
t AS (SELECT key, 'thumbnails/' || prefix || {_SQL_CUT_LAST_DOT} || '.jpg' AS thumbnail_key
      FROM mf WHERE {_SQL_IS_IMAGE})
SELECT thumbnail_key, count(*) AS n_images, count(DISTINCT key) AS n_sources
FROM t GROUP BY thumbnail_key HAVING count(*) > 1
""",
)
def thumbnail_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = manifest_files(spark, sf_dir).where(K.is_image_key("key")).withColumn("file_name", K.file_name("key"))
    return img_ops.thumbnail_collisions(img_ops.with_thumbnail_keys(f), key="key")


# ---------------------------------------------------------------------------------------
# Pages as image objects: the html bytes are the content, the URL path names the file.
def _page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://([^?#]*)", 1)
    return p.select(
        "page_id",
        K.file_name(path).alias("file_name"),
        K.hive_prefix(F.lit("web"), F.lit("pages"), F.lit(FILES_DATE)).alias("prefix"),
        F.col("html").cast("binary").alias("content"),
    )


SQL_PAGES = """
pg AS (SELECT page_id, html, regexp_extract(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '[^/]*$', 0) AS file_name
       FROM pages)
"""


@register(
    "profile_checksums",
    "X9 X11",
    f"WITH {SQL_PAGES} SELECT page_id, file_name, CAST(strlen(html) AS BIGINT) AS size_bytes, sha256(html) AS sha256 FROM pg",
)
def profile_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return img_ops.checksums(_page_objects(spark, sf_dir)).select("page_id", "file_name", "size_bytes", "sha256")


@register(
    "thumbnail_keys",
    "X8",
    f"""WITH {SQL_PAGES}
SELECT page_id, 'thumbnails/partner=web/dataset=pages/ingest_date={FILES_DATE}/' || {_SQL_CUT_LAST_DOT} || '.jpg' AS thumbnail_key
FROM pg""",
)
def thumbnail_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return img_ops.with_thumbnail_keys(_page_objects(spark, sf_dir)).select("page_id", "thumbnail_key")


# Documents as profile results: German texts stand for failures with long messages, short
# Spanish ones for failures with an empty message (which count as no error).
@register(
    "profile_error_summary",
    "F12 X13 A5",
    """
SELECT source, count(*) AS n_rows, count(err) AS n_errors,
       CAST(max(length(err)) AS BIGINT) AS max_error_chars, CAST(sum(length(err)) AS BIGINT) AS total_error_chars
FROM (SELECT source,
             CASE WHEN lang = 'de' AND text <> '' THEN left(text, 500) END AS err
      FROM documents)
GROUP BY source
""",
)
def profile_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    err = F.when(F.col("lang") == "de", F.col("text")).when(
        (F.col("lang") == "es") & (F.col("n_chars") < 500), F.lit("")
    )
    return img_ops.error_summary(d.select("source", err.alias("error")), ["source"])


@register(
    "bbox_flatten",
    "X14",
    """
SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS bbox_x, CAST(embedding[2] AS DOUBLE) AS bbox_y,
       CAST(embedding[3] AS DOUBLE) AS bbox_w, CAST(embedding[4] AS DOUBLE) AS bbox_h
FROM embeddings
""",
)
def bbox_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", *ann_ops.bbox_columns("embedding"))
