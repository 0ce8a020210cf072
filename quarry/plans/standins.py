"""Silver-shaped tables derived from the driver's tables.

The driver ships TPC-H-like tables, not image deliveries, so each silver table has a
stand-in computed by Spark from a driver table (whole tables, no sampling):

- coco_annotations <- lineitem  (image_id = l_orderkey, category_id = l_partkey,
                                 area = l_extendedprice, iscrowd = returned)
- coco_categories  <- part      (64 names over the part keys: name vs id counting)
- coco_images      <- orders    (one image per order; orders without lineitems are
                                 images without annotations)
- image_metadata   <- orders that were profiled (status not pending); failed thumbnails
                      for open orders (thumbnail_key null)

Every stand-in has a SQL twin in ``SQL_CTES`` so the DuckDB oracle sees the same inputs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.keys import hive_prefix

PARTNER = "coco"
IMAGES_DATASET = "val2017"
ANN_DATASET = "annotations_trainval2017"
INGEST_DATE = _dt.date(2024, 6, 1)
SPLIT = "val2017"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _slice(dataset: str, split: bool = True) -> list:
    cols = [
        F.lit(PARTNER).alias("partner"),
        F.lit(dataset).alias("dataset"),
        F.lit(INGEST_DATE).alias("ingest_date"),
    ]
    if split:
        cols.append(F.lit(SPLIT).alias("split"))
    return cols


def coco_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *_slice(ANN_DATASET),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("annotation_id"),
        F.col("l_orderkey").alias("image_id"),
        F.col("l_partkey").alias("category_id"),
        F.col("l_quantity").alias("bbox_x"),
        F.col("l_discount").alias("bbox_y"),
        F.col("l_tax").alias("bbox_w"),
        F.col("l_quantity").alias("bbox_h"),
        F.col("l_extendedprice").alias("area"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("iscrowd"),
    )


def coco_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        *_slice(ANN_DATASET),
        F.col("p_partkey").alias("category_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("supercategory"),
    )


def coco_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        *_slice(ANN_DATASET),
        F.col("o_orderkey").alias("image_id"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("file_name"),
        F.col("o_custkey").alias("width"),
        F.length("o_orderpriority").cast("long").alias("height"),
    )


def image_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    prefix = hive_prefix(F.lit(PARTNER), F.lit(IMAGES_DATASET), F.lit(INGEST_DATE))
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg"))
    return o.select(
        *_slice(IMAGES_DATASET, split=False),
        F.concat(prefix, name).alias("bronze_key"),
        name.alias("file_name"),
        (F.col("o_orderkey") * 7 + F.col("o_custkey")).alias("size_bytes"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"),
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.lit("thumbnails/"), prefix, F.col("o_orderkey").cast("string"), F.lit(".jpg")),
        ).alias("thumbnail_key"),
    )


_PREFIX = f"partner={PARTNER}/dataset={IMAGES_DATASET}/ingest_date={INGEST_DATE.isoformat()}/"

# DuckDB twins of the stand-ins (used as a WITH prefix by the oracle queries).
SQL_CTES = f"""
ann AS (
  SELECT '{PARTNER}' AS partner, '{ANN_DATASET}' AS dataset, DATE '{INGEST_DATE}' AS ingest_date,
         '{SPLIT}' AS split, l_orderkey AS image_id, l_partkey AS category_id,
         l_extendedprice AS area, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS iscrowd
  FROM lineitem),
cat AS (
  SELECT '{PARTNER}' AS partner, '{ANN_DATASET}' AS dataset, DATE '{INGEST_DATE}' AS ingest_date,
         '{SPLIT}' AS split, p_partkey AS category_id, p_name AS name, p_type AS supercategory
  FROM part),
img AS (
  SELECT '{PARTNER}' AS partner, '{ANN_DATASET}' AS dataset, DATE '{INGEST_DATE}' AS ingest_date,
         '{SPLIT}' AS split, o_orderkey AS image_id, CAST(o_orderkey AS VARCHAR) || '.jpg' AS file_name,
         o_custkey AS width, CAST(length(o_orderpriority) AS BIGINT) AS height
  FROM orders),
meta AS (
  SELECT '{PARTNER}' AS partner, '{IMAGES_DATASET}' AS dataset, DATE '{INGEST_DATE}' AS ingest_date,
         '{_PREFIX}' || CAST(o_orderkey AS VARCHAR) || '.jpg' AS bronze_key,
         CAST(o_orderkey AS VARCHAR) || '.jpg' AS file_name,
         o_orderkey * 7 + o_custkey AS size_bytes,
         sha256(CAST(o_orderkey AS VARCHAR)) AS sha256,
         CASE WHEN o_orderstatus = 'F' THEN 'thumbnails/{_PREFIX}' || CAST(o_orderkey AS VARCHAR) || '.jpg' END
           AS thumbnail_key
  FROM orders WHERE o_orderstatus <> 'P')
"""
