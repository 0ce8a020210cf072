"""Nested annotation documents -> tidy silver tables (images, categories, annotations,
captions).

Documents are read with an explicit subset schema, so fields the tables never use
(segmentation polygons or RLE, keypoints, licences) are never materialised.  Each array is
exploded in its own projection; after the explode the rows are independent, so
downstream work spreads over the cluster even though one document is one input row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions import keys as K
from quarry.session import scratch_path
from quarry.sources.documents import read_json_docs

BBOX_FIELDS = ("bbox_x", "bbox_y", "bbox_w", "bbox_h")


def bbox_columns(bbox: Column | str) -> list[Column]:
    """``bbox[0..3]`` as four doubles; a box with fewer than four numbers fails the job
    (the reference raises on it too) instead of silently producing nulls."""
    b = F.col(bbox) if isinstance(bbox, str) else bbox
    short = F.raise_error(F.lit("bbox needs four numbers"))
    return [
        F.when(F.size(b) >= 4, b.getItem(i).cast("double")).otherwise(short.cast("double")).alias(n)
        for i, n in enumerate(BBOX_FIELDS)
    ]


def _base(base_cols: list[str]) -> list[Column]:
    return [F.col(c) for c in base_cols]


def images(docs: DataFrame, base_cols: list[str]) -> DataFrame:
    e = docs.select(*_base(base_cols), F.explode("doc.images").alias("x"))
    return e.select(
        *base_cols,
        F.col("x.id").alias("image_id"),
        F.col("x.file_name").alias("file_name"),
        F.col("x.width").alias("width"),
        F.col("x.height").alias("height"),
    )


def categories(docs: DataFrame, base_cols: list[str]) -> DataFrame:
    e = docs.select(*_base(base_cols), F.explode("doc.categories").alias("x"))
    return e.select(
        *base_cols,
        F.col("x.id").alias("category_id"),
        F.col("x.name").alias("name"),
        F.col("x.supercategory").alias("supercategory"),
    )


def annotations(docs: DataFrame, base_cols: list[str]) -> DataFrame:
    e = docs.select(*_base(base_cols), F.explode("doc.annotations").alias("x"))
    return e.select(
        *base_cols,
        F.col("x.id").alias("annotation_id"),
        F.col("x.image_id").alias("image_id"),
        F.col("x.category_id").alias("category_id"),
        *bbox_columns("x.bbox"),
        F.col("x.area").cast("double").alias("area"),
        F.col("x.iscrowd").alias("iscrowd"),
    )


def captions(docs: DataFrame, base_cols: list[str]) -> DataFrame:
    e = docs.select(*_base(base_cols), F.explode("doc.annotations").alias("x"))
    return e.select(
        *base_cols,
        F.col("x.id").alias("caption_id"),
        F.col("x.image_id").alias("image_id"),
        F.col("x.caption").alias("caption"),
    )


def with_kind(files: DataFrame, key: str = "key") -> DataFrame:
    """Add ``file_name``, ``kind``, ``split`` and the normaliser's ``action`` to a list
    of manifest files."""
    return files.withColumns(
        {
            "file_name": K.file_name(key),
            "kind": K.annotation_kind(key),
            "split": K.annotation_split(key),
            "action": K.annotation_action(key),
        }
    )


# ---------------------------------------------------------------------------------------
# the normaliser job: manifest files -> four tidy tables
def _uri(c):
    """File URIs in one form (``file:///x`` and ``file:/x`` both become ``file:/x``)."""
    return F.regexp_replace(c, r"^file:/+", "file:/")


def _complete(schema, kind: str):
    """The document as a struct; a missing array fails the job."""
    names = [n for n in schema.fieldNames() if schema[n].dataType.typeName() == "array"]
    lacks = F.lit(False)
    for n in names:
        lacks = lacks | F.col(n).isNull()
    doc = F.struct(*[F.col(n) for n in schema.fieldNames()])
    return F.when(lacks, F.raise_error(F.lit(f"{kind} document without one of the arrays {names}")).cast(schema)).otherwise(doc)


#: An element of any of the documents' arrays; the fields that its array lacks are null.
ELEMENT = S.struct(
    ("id", S.L), ("image_id", S.L), ("category_id", S.L), ("file_name", S.S), ("width", S.L), ("height", S.L), ("name", S.S),
    ("supercategory", S.S), ("bbox", S.T.ArrayType(S.D)), ("area", S.D), ("iscrowd", S.L), ("caption", S.S),
)


def _elements(doc_schema: S.T.StructType) -> Column:
    """All elements of all arrays of a document, with the name of their array."""

    def of(array: S.T.StructField) -> Column:
        has = array.dataType.elementType.fieldNames()

        def element(x: Column) -> Column:
            fields = [(x[f.name] if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in ELEMENT.fields]
            return F.struct(F.lit(array.name).alias("array"), *fields)

        return F.transform(F.col("doc")[array.name], element)

    return F.concat(*(of(f) for f in doc_schema.fields))


def normalize(spark, files: DataFrame, path_col: str = "path") -> dict[str, DataFrame]:
    """Annotation documents listed in ``files`` (path, partner, dataset, ingest_date) ->
    ``coco_images``, ``coco_categories``, ``coco_annotations``, ``coco_captions``.

    Spark's JSON reader parses each document once, with the subset schema (FAILFAST), in a task of its own; its
    elements are written below the shared checkpoint folder, one partition per array, and the four
    tables read that.  Keypoints files are skipped, base columns and the split come from the
    manifest row, malformed documents and documents without a required array fail the job.  The
    driver holds one path per document of the batch (as any file listing does)."""
    f = with_kind(files, path_col).where(F.col("action").isin("instances", "captions"))
    base = f.select(
        F.col(path_col).alias("path"),
        _uri(F.col(path_col)).alias("source_path"),
        "partner",
        "dataset",
        F.col("ingest_date").cast("date").alias("ingest_date"),
        "split",
        F.col("action").alias("kind"),
    )
    listed = base.distinct().collect()
    scratch = scratch_path(spark, "annotation-elements")
    parts = []
    for kind, schema in (("instances", S.INSTANCES_DOC), ("captions", S.CAPTIONS_DOC)):
        own = [r for r in listed if r.kind == kind]
        if not own:
            continue
        raw = read_json_docs(spark, sorted({r.path for r in own}), schema, multi_line=True, with_path=True)
        rows = F.broadcast(spark.createDataFrame(own, base.schema).drop("path"))  # a row per path just listed
        docs = raw.withColumn("source_path", _uri(F.col("source_path"))).join(rows, "source_path")
        docs = docs.select(*S.SLICE_PARTITION, "kind", _complete(schema, kind).alias("doc"))
        parts.append(docs.select(*S.SLICE_PARTITION, "kind", F.explode(_elements(schema)).alias("x")).select(*S.SLICE_PARTITION, "kind", "x.*"))
    written = S.T.StructType([*(S.COCO_IMAGES[c] for c in S.SLICE_PARTITION), *ELEMENT.fields, *S.struct(("kind", S.S), ("array", S.S)).fields])
    rows = spark.createDataFrame([], written)
    if parts:
        reduce(DataFrame.unionByName, parts).write.partitionBy("kind", "array").parquet(scratch)
        rows = spark.read.schema(written).parquet(scratch)

    def part(kind: str, array: str, *cols) -> DataFrame:
        return rows.where((F.col("kind") == kind) & (F.col("array") == array)).select(*S.SLICE_PARTITION, *cols)

    box = [*bbox_columns("bbox"), "area", "iscrowd"]
    return {
        "coco_images": part("instances", "images", F.col("id").alias("image_id"), "file_name", "width", "height"),
        "coco_categories": part("instances", "categories", F.col("id").alias("category_id"), "name", "supercategory"),
        "coco_annotations": part("instances", "annotations", F.col("id").alias("annotation_id"), "image_id", "category_id", *box),
        "coco_captions": part("captions", "annotations", F.col("id").alias("caption_id"), "image_id", "caption"),
    }
