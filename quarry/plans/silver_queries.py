"""Silver work from stored deliveries (S5, S6, S9, R2-R4, F9, J6, X15): annotation documents built from
orders and lineitems, images rendered from embeddings, listed in manifest documents.

Stand-in deliveries: one per order status.  Orders are the images of its instances documents (one per block
of order keys, the split), lineitems the annotations, line numbers the categories; the stored image files are
the rendered vectors, dealt to the deliveries by label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import jobs
from quarry import schemas as S
from quarry.functions import keys as K
from quarry.operators import annotations as ann_ops
from quarry.operators import bronze
from quarry.operators import images as img_ops
from quarry.operators import tables as tbl
from quarry.plans.image_queries import rendered_images
from quarry.plans.registry import register
from quarry.plans.standins import table
from quarry.session import scratch_path

PARTNER, DAY = "acme", "2024-06-01"
ORDERS_PER_DOCUMENT = 5_000
STATUSES = ("F", "O", "P")


def _prefix(dataset) -> F.Column:
    return K.hive_prefix(F.lit(PARTNER), dataset, F.lit(DAY))


def instance_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, key, content): an instances document per delivery and block of order keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.lower("o_orderstatus").alias("status"))
    block = F.floor(F.col("o_orderkey") / ORDERS_PER_DOCUMENT)
    orders = orders.select(F.concat(F.lit("status-"), "status").alias("dataset"), block.alias("block"), "o_orderkey", "o_custkey")
    image = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("file_name"),
        F.col("o_custkey").alias("width"),
        F.lit(7).alias("height"),
        F.lit(1).alias("license"),
    )
    images = orders.groupBy("dataset", "block").agg(F.collect_list(image).alias("images"))
    box = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("image_id"),
        F.col("l_linenumber").alias("category_id"),
        F.array("l_quantity", "l_discount", "l_tax", "l_quantity").alias("bbox"),
        F.array(F.array("l_quantity", "l_tax")).alias("segmentation"),
        F.col("l_extendedprice").alias("area"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("iscrowd"),
    )
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    boxes = lines.groupBy("dataset", "block").agg(F.collect_list(box).alias("annotations"))
    numbers = F.sequence(F.lit(1), F.lit(7))
    categories = F.transform(
        numbers, lambda n: F.struct(n.alias("id"), F.concat(F.lit("line "), n.cast("string")).alias("name"), F.lit("lines").alias("supercategory"))
    )
    docs = images.join(boxes, ["dataset", "block"], "left")
    body = F.struct(
        F.struct(F.lit("orders and lineitems").alias("description")).alias("info"),
        "images",
        F.coalesce("annotations", F.array().cast(boxes.schema["annotations"].dataType)).alias("annotations"),
        categories.alias("categories"),
    )
    name = F.concat(F.lit("annotations/instances_b"), F.col("block").cast("string"), F.lit(".json"))
    return docs.select("dataset", F.concat(_prefix(F.col("dataset")), name).alias("key"), F.to_json(body).cast("binary").alias("content"))


SQL_DOCS = f"""
doc AS (
  SELECT 'status-' || lower(o_orderstatus) AS dataset, 'b' || CAST(o_orderkey // {ORDERS_PER_DOCUMENT} AS VARCHAR) AS split,
         o_orderkey, o_custkey FROM orders)
"""


@register(
    "instances_documents",
    "S5 F5 F8 F9 X14 X15",
    f"""WITH {SQL_DOCS}
SELECT dataset, DATE '{DAY}' AS ingest_date, split, l_orderkey * 10 + l_linenumber AS annotation_id, l_orderkey AS image_id,
       CAST(l_linenumber AS BIGINT) AS category_id, l_quantity AS bbox_x, l_discount AS bbox_y, l_tax AS bbox_w, l_quantity AS bbox_h,
       l_extendedprice AS area, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS iscrowd
FROM lineitem JOIN doc ON l_orderkey = o_orderkey""",
)
def instances_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances documents written as files and normalised: Spark's JSON reader with the subset schema (no
    segmentation is ever read), elements exploded, base columns from the list of files."""
    root = scratch_path(spark, "instances")
    docs = instance_documents(spark, sf_dir)
    bronze.write_objects(docs.select("key", "content"), root).write.parquet(scratch_path(spark, "instances-written"))
    prefix = F.regexp_extract("path", "dataset=([^/]*)/", 1)
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root).select("path")
    files = stored.select("path", F.lit(PARTNER).alias("partner"), prefix.alias("dataset"), F.lit(DAY).alias("ingest_date"))
    return ann_ops.normalize(spark, files)["coco_annotations"].drop("partner")


def _stored_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, key, content): every rendered vector as an image of one of the deliveries."""
    at = F.element_at(F.array(*[F.lit(f"status-{s.lower()}") for s in STATUSES]), (F.col("label") % len(STATUSES) + 1).cast("int"))
    vec = F.regexp_extract("bronze_key", r"(\d+)\.png$", 1).cast("long")
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    named = rendered_images(spark, sf_dir).withColumn("vec_id", vec).join(labels, "vec_id")
    return named.select(
        at.alias("dataset"), F.concat(_prefix(at), F.lit("images/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("key"), "content"
    )


def deliver(spark: SparkSession, sf_dir: str, layout: jobs.Layout) -> None:
    """Objects and manifest documents of all deliveries in bronze."""
    objects = instance_documents(spark, sf_dir).unionByName(_stored_images(spark, sf_dir))
    listing = scratch_path(spark, "delivered")
    bronze.write_objects(objects.select("key", "content"), layout.bronze).write.parquet(listing)
    listed = spark.read.parquet(listing).withColumn("dataset", F.regexp_extract("key", "dataset=([^/]*)/", 1))
    totals = listed.groupBy("dataset").agg(F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("total_bytes"))
    files = listed.join(totals, "dataset").select(
        F.concat(F.lit("drop#"), "dataset").alias("drop_id"),
        F.lit(PARTNER).alias("partner"),
        "dataset",
        F.lit(DAY).alias("ingest_date"),
        F.lit("stand-in").alias("source"),
        F.lit(f"{DAY}T12:00:00Z").alias("completed_at"),
        "file_count",
        "total_bytes",
        F.concat(_prefix(F.col("dataset")), F.lit(K.MANIFEST_NAME)).alias("manifest_key"),
        F.xxhash64("key").alias("pos"),
        "key",
        "size_bytes",
        "crc32",
        K.content_type("key").alias("content_type"),
    )
    bronze.write_manifest_documents(files, layout.bronze).write.parquet(scratch_path(spark, "manifests-written"))


@register(
    "silver_from_manifest_stream",
    "S9 R2 R4 S5 S6 F2 F4 F9 F11 J6 A4",
    f"""WITH {SQL_DOCS},
vec AS (SELECT *, 'status-' || substr('fop', CAST(label % 3 AS INTEGER) + 1, 1) AS dataset FROM embeddings)
SELECT 'annotation' AS kind, dataset, split, l_orderkey * 10 + l_linenumber AS id, CAST(l_orderkey AS DOUBLE) AS a, l_extendedprice AS b
FROM lineitem JOIN doc ON l_orderkey = o_orderkey
UNION ALL SELECT 'image', dataset, split, o_orderkey, CAST(o_custkey AS DOUBLE), 7.0 FROM doc
UNION ALL SELECT 'category', dataset, split, n, NULL, NULL FROM (SELECT DISTINCT dataset, split FROM doc), (SELECT unnest(range(1, 8)) AS n)
UNION ALL SELECT 'file', dataset, NULL, vec_id, CAST(64 * (label + 1) AS DOUBLE), CAST(4 * (label + 1) AS DOUBLE) FROM vec
UNION ALL SELECT 'thumbnail', dataset, NULL, vec_id, CAST(CASE WHEN label < 3 THEN 64 * (label + 1) ELSE 256 END AS DOUBLE),
                 CAST(CASE WHEN label < 3 THEN 4 * (label + 1) ELSE 16 END AS DOUBLE) FROM vec WHERE label < 9
UNION ALL SELECT 'manifest', dataset, NULL, 1, NULL, NULL FROM (SELECT DISTINCT dataset FROM doc)""",
)
def silver_from_manifest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream over manifest documents, one document per micro-batch, does the silver work of every
    delivery: images profiled and thumbnailed, instances documents normalised, each manifest ledgered
    once (a second run finds nothing new).  Every staged row is returned in one shape."""
    from quarry.streaming import manifests

    layout = jobs.Layout(scratch_path(spark, "silver-stream"))
    deliver(spark, sf_dir, layout)
    for _ in range(2):
        manifests.start_silver_stream(spark, layout, scratch_path(spark, "silver-ckpt"), max_files_per_trigger=1).awaitTermination()

    def rows(kind: str, df: DataFrame, split, ident, a=None, b=None) -> DataFrame:
        number = lambda c: (F.lit(None) if c is None else F.col(c)).cast("double")
        return df.select(F.lit(kind).alias("kind"), "dataset", split.alias("split"), ident.cast("long").alias("id"), number(a).alias("a"), number(b).alias("b"))

    staged = {t: tbl.read_table(spark, layout.staging(t), S.SILVER_TABLES[t][2]) for t in S.SILVER_TABLES}
    none, split = F.lit(None).cast("string"), F.col("split")
    vec = lambda c: F.regexp_extract(c, r"(\d+)\.[a-z]+$", 1)
    thumbs = spark.read.parquet(layout.thumbnails).where("error is null")
    led = tbl.read_table(spark, layout.silver_ledger, manifests.LEDGER_TABLE).where("status = 'SUBMITTED'")
    parts = [
        rows("annotation", staged["coco_annotations"], split, F.col("annotation_id"), "image_id", "area"),
        rows("image", staged["coco_images"], split, F.col("image_id"), "width", "height"),
        rows("category", staged["coco_categories"], split, F.col("category_id")),
        rows("file", staged["image_metadata"], none, vec("file_name"), "width", "height"),
        rows("thumbnail", thumbs, none, vec("thumbnail_key"), "thumb_width", "thumb_height"),
        rows("manifest", led.withColumn("dataset", F.regexp_extract("src_key", "dataset=([^/]*)/", 1)), none, F.lit(1)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "stored_image_metadata",
    "S6 J6 U1 X9 X11 F12",
    f"""
SELECT 'pages' AS dataset, 'page-' || CAST(page_id AS VARCHAR) || '.JPG' AS file_name, CAST(strlen(html) AS BIGINT) AS size_bytes,
       sha256(html) AS sha256, NULL AS width, NULL AS height, 'cannot identify image file' AS error, NULL AS thumbnail_key
FROM pages
UNION ALL
SELECT 'status-' || substr('fop', CAST(label % 3 AS INTEGER) + 1, 1) AS dataset, CAST(vec_id AS VARCHAR) || '.png', NULL, NULL,
       CAST(64 * (label + 1) AS BIGINT), CAST(4 * (label + 1) AS BIGINT), CASE WHEN label = 9 THEN 'image file is truncated' END,
       CASE WHEN label < 9 THEN 'thumbnails/partner={PARTNER}/dataset=status-' || substr('fop', CAST(label % 3 AS INTEGER) + 1, 1) ||
            '/ingest_date={DAY}/' || CAST(vec_id AS VARCHAR) || '.jpg' END
FROM embeddings
""",
)
def stored_image_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects written to storage (rendered images, and pages under image names) and profiled there by
    the binary file source, for the keys that a manifest lists.  Size and checksum are returned where SQL has them."""
    root = scratch_path(spark, "stored-images")
    page = F.concat(_prefix(F.lit("pages")), F.lit("in/page-"), F.col("page_id").cast("string"), F.lit(".JPG"))
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("dataset"), page.alias("key"), F.col("html").cast("binary").alias("content"))
    listing = scratch_path(spark, "stored-keys")
    bronze.write_objects(pages.unionByName(_stored_images(spark, sf_dir)).select("key", "content"), root).write.parquet(listing)
    keys = spark.read.parquet(listing).select(
        "key", F.lit(PARTNER).alias("partner"), F.regexp_extract("key", "dataset=([^/]*)/", 1).alias("dataset"), F.lit(DAY).alias("ingest_date")
    )
    meta = img_ops.stored_image_metadata(keys, root)
    known = F.col("dataset") == "pages"
    return meta.select(
        "dataset", "file_name", F.when(known, F.col("size_bytes")).alias("size_bytes"), F.when(known, F.col("sha256")).alias("sha256"),
        "width", "height", "error", "thumbnail_key",
    )
