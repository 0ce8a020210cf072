"""Gold products on the stand-in silver slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import gold
from quarry.plans import standins as si
from quarry.plans.registry import register


def _slice(df: DataFrame, dataset: str, split: bool = True) -> DataFrame:
    return gold.scan_slice(
        df, partner=si.PARTNER, dataset=dataset, ingest_date=si.INGEST_DATE, split=si.SPLIT if split else None
    )


def _inputs(spark: SparkSession, sf_dir: str):
    ann = _slice(si.coco_annotations(spark, sf_dir), si.ANN_DATASET)
    cat = _slice(si.coco_categories(spark, sf_dir), si.ANN_DATASET)
    img = _slice(si.coco_images(spark, sf_dir), si.ANN_DATASET)
    meta = _slice(si.image_metadata(spark, sf_dir), si.IMAGES_DATASET, split=False)
    return ann, cat, img, meta


@register(
    "ml_manifest",
    "J1 J2 J3 A2 X16 X17",
    f"""
WITH {si.SQL_CTES},
boxes AS (SELECT image_id, category_id, count(*) AS n FROM ann GROUP BY ALL),
names_on AS (
  SELECT image_id, name, sum(n) AS n
  FROM boxes JOIN (SELECT category_id, name FROM cat) USING (category_id)
  GROUP BY image_id, name),
summary AS (
  SELECT image_id, CAST(sum(n) AS BIGINT) AS boxes_seen, list(name ORDER BY name) AS seen
  FROM names_on GROUP BY image_id)
SELECT stored.partner, stored.dataset, stored.ingest_date, shot.image_id, shot.file_name, shot.width, shot.height,
       stored.bronze_key, stored.thumbnail_key, stored.size_bytes, stored.sha256,
       CASE WHEN s.seen IS NULL THEN 0 ELSE s.boxes_seen END AS n_annotations,
       CASE WHEN s.seen IS NULL THEN 0 ELSE len(s.seen) END AS n_categories,
       CASE WHEN s.seen IS NULL THEN '' ELSE array_to_string(s.seen, ',') END AS categories
FROM meta AS stored, (SELECT * FROM img) AS shot LEFT JOIN summary AS s ON s.image_id = shot.image_id
WHERE stored.file_name = shot.file_name
""",
)
def ml_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann, cat, img, meta = _inputs(spark, sf_dir)
    return gold.ml_manifest(img, meta, ann, cat)


@register(
    "category_stats",
    "J1 A1 F7",
    f"""
WITH {si.SQL_CTES},
on_image AS (
  SELECT partner, ingest_date, category_id, image_id, count(*) AS n, count(area) AS sized,
         sum(CAST(area AS DECIMAL(18,2))) AS covered, sum(iscrowd) AS crowds
  FROM ann GROUP BY ALL),
totals AS (
  SELECT partner, ingest_date, category_id, sum(n) AS n, count(*) AS images, sum(sized) AS sized,
         sum(covered) AS covered, sum(crowds) AS crowds
  FROM on_image GROUP BY ALL)
SELECT totals.partner, '{si.IMAGES_DATASET}' AS dataset, totals.ingest_date, category_id,
       name AS category, supercategory, CAST(n AS BIGINT) AS n_annotations, images AS n_images,
       CAST(covered AS DOUBLE) / CAST(sized AS BIGINT) AS avg_area, CAST(crowds AS BIGINT) AS crowd_annotations
FROM totals JOIN (SELECT category_id, name, supercategory FROM cat) USING (category_id)
""",
)
def category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann, cat, _, _ = _inputs(spark, sf_dir)
    # area is a 2-decimal amount in the stand-in: a decimal sum makes the average exact.
    return gold.category_stats(ann, cat, si.IMAGES_DATASET, area_scale=2)


@register(
    "per_image_labels",
    "J1 A2 X17",
    f"""
WITH {si.SQL_CTES},
labels AS (
  SELECT partner, dataset, ingest_date, split, image_id, (SELECT name FROM cat WHERE cat.category_id = ann.category_id) AS label
  FROM ann),
tallied AS (
  SELECT partner, dataset, ingest_date, split, image_id, label, count(*) AS n FROM labels WHERE label IS NOT NULL GROUP BY ALL)
SELECT partner, dataset, ingest_date, split, image_id, CAST(sum(n) AS BIGINT) AS n_annotations,
       count(*) AS n_categories, array_to_string(list(label ORDER BY label), ',') AS categories
FROM tallied GROUP BY partner, dataset, ingest_date, split, image_id
""",
)
def per_image_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann, cat, _, _ = _inputs(spark, sf_dir)
    return gold.per_image_labels(ann, cat)


def _ml_manifest_sql() -> str:
    from quarry.plans.registry import REGISTRY

    return REGISTRY["ml_manifest"].sql


@register("gold_build_tables", "S1 S2 S3 K1 K4 K5 K12 (silver build + gold build jobs)", _ml_manifest_sql())
def gold_build_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job chain on stand-in silver inputs: staged tables -> ``jobs.silver_build``
    (tables created from staging; captions have no staging data and are skipped) ->
    ``jobs.gold_build`` for the slice (gold tables replaced) -> the gold ml_manifest table."""
    from pyspark.sql import functions as F

    from quarry import jobs
    from quarry import schemas as S
    from quarry.operators import tables as tbl
    from quarry.session import scratch_path

    layout = jobs.Layout(scratch_path(spark, "gold-chain"))
    meta = si.image_metadata(spark, sf_dir)
    for name in S.IMAGE_METADATA.fieldNames():
        if name not in meta.columns:
            meta = meta.withColumn(name, F.lit(None).cast(S.IMAGE_METADATA[name].dataType))
    staged = {
        "coco_annotations": si.coco_annotations(spark, sf_dir),
        "coco_categories": si.coco_categories(spark, sf_dir),
        "coco_images": si.coco_images(spark, sf_dir),
        "image_metadata": meta.select(*S.IMAGE_METADATA.fieldNames()),
    }
    for table, df in staged.items():
        tbl.stage(df, layout.staging(table), S.SILVER_TABLES[table][0])
    jobs.silver_build(spark, layout)
    jobs.gold_build(spark, layout, si.PARTNER, si.IMAGES_DATASET, si.ANN_DATASET, si.SPLIT, si.INGEST_DATE.isoformat())
    return tbl.read_table(spark, layout.gold("ml_manifest"), S.ML_MANIFEST)


# ---------------------------------------------------------------------------------------
# Many slices in one run.  Lineitems are annotations, sliced by line status (the split) and ship year
# (the ingest date); the images and their metadata are the orders that occur in each slice.
YEARS, SPLITS = (1995, 1996), ("f", "o")
SQL_SLICED = f"""
line AS (
  SELECT lower(l_linestatus) AS split, CAST(date_trunc('year', l_shipdate) AS DATE) AS ingest_date, l_orderkey AS image_id,
         l_partkey AS category_id, l_extendedprice AS area, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS iscrowd
  FROM lineitem WHERE year(l_shipdate) IN {YEARS} AND lower(l_linestatus) IN {SPLITS}),
named AS (SELECT line.*, p_name AS name, p_type AS supercategory FROM line JOIN part ON p_partkey = category_id)
"""


def sliced_silver(spark: SparkSession, sf_dir: str, layout) -> None:
    """The stand-in silver tables of all slices, partitioned as the silver build writes them."""
    from pyspark.sql import functions as F

    from quarry import schemas as S
    from quarry.operators import tables as tbl
    from quarry.plans.standins import table

    li = table(spark, sf_dir, "lineitem").select(
        F.lit(si.PARTNER).alias("partner"), F.lit(si.ANN_DATASET).alias("dataset"), F.to_date(F.date_trunc("year", "l_shipdate")).alias("ingest_date"),
        F.lower("l_linestatus").alias("split"), "*",
    )
    name = F.concat(F.col("image_id").cast("string"), F.lit(".jpg"))
    ann = li.select(
        *S.SLICE_PARTITION, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("annotation_id"), F.col("l_orderkey").alias("image_id"),
        F.col("l_partkey").alias("category_id"), F.col("l_extendedprice").alias("area"), (F.col("l_returnflag") == "R").cast("long").alias("iscrowd"),
    )
    img = ann.select(*S.SLICE_PARTITION, "image_id").distinct().withColumns({"file_name": name, "width": F.col("image_id") % 640, "height": F.lit(480).cast("long")})
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("category_id"), F.col("p_name").alias("name"), F.col("p_type").alias("supercategory"))
    used = ann.select(*S.SLICE_PARTITION, "category_id").distinct()  # each slice delivers the categories it uses
    meta = img.select("partner", F.lit(si.IMAGES_DATASET).alias("dataset"), "ingest_date", "file_name", F.col("image_id").alias("size_bytes")).distinct()
    meta = meta.withColumn("bronze_key", F.concat(F.lit("k/"), F.col("ingest_date").cast("string"), F.lit("/"), "file_name"))
    for t, df in {"coco_annotations": ann, "coco_images": img, "coco_categories": used.join(part, "category_id"), "image_metadata": meta}.items():
        parts, key, schema = S.SILVER_TABLES[t]
        full = df.select(*(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
        tbl.create(spark, full, layout.silver(t), parts, t, key)


@register(
    "gold_many_slices",
    "S3 F1 F7 J1 J2 J3 A1 A2 K3 (many slices, pruned at run time)",
    f"""
WITH {SQL_SLICED},
per_image AS (
  SELECT split, ingest_date, image_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT name)), ',') AS names, count(DISTINCT name) AS n_names
  FROM named GROUP BY ALL),
shots AS (SELECT DISTINCT split, ingest_date, image_id FROM line)
SELECT 'image' AS kind, s.ingest_date, s.image_id AS id, CAST(s.image_id AS VARCHAR) || '.jpg' AS name, coalesce(p.n, 0) AS n,
       coalesce(p.n_names, 0) AS m, 'k/' || CAST(s.ingest_date AS VARCHAR) || '/' || CAST(s.image_id AS VARCHAR) || '.jpg' || ' ' || coalesce(p.names, '') AS what
FROM shots s LEFT JOIN per_image p ON p.split = s.split AND p.ingest_date = s.ingest_date AND p.image_id = s.image_id
UNION ALL
SELECT 'category', ingest_date, category_id, name, count(*), count(DISTINCT image_id), supercategory || ' ' || CAST(sum(iscrowd) AS VARCHAR)
FROM named GROUP BY split, ingest_date, category_id, name, supercategory
""",
)
def gold_many_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two splits and two days built in one run from silver tables that hold more: the slice table prunes
    their partitions at run time; both gold tables are read back in one shape."""
    from pyspark.sql import functions as F

    from quarry import jobs
    from quarry import schemas as S
    from quarry.operators import tables as tbl
    from quarry.session import scratch_path

    layout = jobs.Layout(scratch_path(spark, "gold-slices"))
    sliced_silver(spark, sf_dir, layout)
    slices = [(si.PARTNER, si.IMAGES_DATASET, si.ANN_DATASET, s, f"{y}-01-01") for s in SPLITS for y in YEARS]
    jobs.gold_build_slices(spark, layout, spark.createDataFrame(slices, "partner string, images_dataset string, annotations_dataset string, split string, ingest_date string"))
    stats = tbl.read_table(spark, layout.gold("category_stats"), S.CATEGORY_STATS)
    rows = tbl.read_table(spark, layout.gold("ml_manifest"), S.ML_MANIFEST)
    images = rows.select(
        F.lit("image").alias("kind"), "ingest_date", F.col("image_id").alias("id"), F.col("file_name").alias("name"), F.col("n_annotations").alias("n"),
        F.col("n_categories").alias("m"), F.concat_ws(" ", "bronze_key", "categories").alias("what"),
    )
    categories = stats.select(
        F.lit("category").alias("kind"), "ingest_date", F.col("category_id").alias("id"), F.col("category").alias("name"), F.col("n_annotations").alias("n"),
        F.col("n_images").alias("m"), F.concat_ws(" ", "supercategory", F.col("crowd_annotations").cast("string")).alias("what"),
    )
    return images.unionByName(categories)
