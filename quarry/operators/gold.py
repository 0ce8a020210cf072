"""Gold products built from silver slices: ``category_stats`` and ``ml_manifest``.

A *slice* is one (partner, dataset, ingest_date, split) delivery.  The reference builds gold
for one slice at a time; here the joins also carry the slice columns, so one call can build
many slices at once and still never match a category or image of another delivery.  For a
single slice the results are identical.

Semantics kept on purpose (they are what users of the reference get today):
- an annotation whose category is unknown is dropped (inner join);
- duplicate category rows multiply counts, exactly as a join-then-aggregate would;
- ``n_categories`` counts distinct category *names*, not ids;
- images join metadata on file name, and images whose profiling failed are kept (their
  thumbnail key is null); a file name with several metadata rows in one delivery gives a
  row for each, and ``repeated_file_names`` reports such names;
- ``dataset`` of ``category_stats`` is the *images* dataset given by the caller.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.keys import date_lit
from quarry.schemas import SLICE_PARTITION

# the id first: sorts compare by the first key, and the slice columns are the same in most rows
CATEGORY_KEY = ["category_id", *SLICE_PARTITION]
IMAGE_KEY = ["image_id", *SLICE_PARTITION]


def scan_slice(
    df: DataFrame,
    partner: str | None = None,
    dataset: str | None = None,
    ingest_date: str | _dt.date | None = None,
    split: str | None = None,
) -> DataFrame:
    """Equality filters on partition columns with typed literals (partition pruning on a
    partitioned table, pushed filters on a plain parquet scan)."""
    conds: list[Column] = []
    if partner is not None:
        conds.append(F.col("partner") == F.lit(partner))
    if dataset is not None:
        conds.append(F.col("dataset") == F.lit(dataset))
    if ingest_date is not None:
        conds.append(F.col("ingest_date") == date_lit(ingest_date))
    if split is not None:
        conds.append(F.col("split") == F.lit(split))
    for c in conds:
        df = df.where(c)
    return df


SLICE = S.struct(("partner", S.S), ("images_dataset", S.S), ("annotations_dataset", S.S), ("split", S.S), ("ingest_date", S.DT))


def slice_table(slices: DataFrame, path: str) -> DataFrame:
    """The slices to build (columns of ``SLICE``), each once, written to ``path`` and read with a filter, which
    is what dynamic partition pruning asks of the side that prunes."""
    rows = slices.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in SLICE.fields)).distinct()
    rows.withColumn("slice", F.monotonically_increasing_id()).write.parquet(path)
    schema = S.T.StructType([*SLICE.fields, S.T.StructField("slice", S.L)])
    return slices.sparkSession.read.schema(schema).parquet(path).where("slice >= 0")


def scan_slices(df: DataFrame, slices: DataFrame, dataset: str = "annotations_dataset", with_split: bool = True) -> DataFrame:
    """The rows of a silver table that belong to any of ``slices``: a semi-join on the partition columns, so
    only the partitions wanted are read, whatever their number."""
    columns = {"partner": "partner", "dataset": dataset, "ingest_date": "ingest_date", **({"split": "split"} if with_split else {})}
    wanted = slices.select(*(F.col(c).alias(f"_{n}") for n, c in columns.items()))
    same = [F.col(n) == F.col(f"_{n}") for n in columns]
    return df.join(wanted, reduce(lambda x, y: x & y, same), "left_semi")


def _labelled(ann: DataFrame, cat: DataFrame) -> DataFrame:
    """Image and name of each annotation whose category is known (inner join on slice + category_id).  A
    plain join: the category side is broadcast when its measured bytes allow it, and
    otherwise adaptive execution splits a hot category."""
    return ann.select(*CATEGORY_KEY, "image_id").join(cat.select(*CATEGORY_KEY, "name"), CATEGORY_KEY, "inner")


def category_stats(
    ann: DataFrame,
    cat: DataFrame,
    images_dataset: str,
    area_scale: int | None = None,
) -> DataFrame:
    """Per category of each annotation slice: annotation count, distinct images, average
    area, crowd count.  Splits and datasets are never merged.

    ``area_scale``: when set, the average is a decimal sum at that scale divided by the
    count, which is exact and independent of partitioning (a double sum is not); when
    None it is the plain ``avg``.
    """
    return _stats(ann, cat, area_scale).withColumn("dataset", F.lit(images_dataset)).select(*STATS_COLUMNS)


def category_stats_of(ann: DataFrame, cat: DataFrame, slices: DataFrame, area_scale: int | None = None) -> DataFrame:
    """``category_stats`` of many slices at once: each slice's rows carry its images dataset."""
    stats = _stats(ann, cat, area_scale).withColumnRenamed("dataset", "annotations_dataset")
    named = stats.join(slices.drop("slice"), ["partner", "annotations_dataset", "ingest_date", "split"])
    return named.withColumnRenamed("images_dataset", "dataset").select(*STATS_COLUMNS)


STATS_COLUMNS = [f.name for f in S.CATEGORY_STATS.fields]


def _stats(ann: DataFrame, cat: DataFrame, area_scale: int | None) -> DataFrame:
    """Annotations are tallied by image and category, then by category, and only the tallies meet the category rows:
    every annotation of a category meets the same ones, and equal rows multiply its counts."""
    area_type = "double" if area_scale is None else f"decimal(38,{area_scale})"
    area = F.col("area").cast(area_type)
    on_image = ann.groupBy("image_id", *CATEGORY_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.sum(area).alias("covered"), F.count(area).alias("sized"), F.sum("iscrowd").alias("crowds")
    )
    totals = on_image.groupBy(*CATEGORY_KEY).agg(
        F.sum("n").alias("n"), F.count("image_id").alias("n_images"),
        *(F.sum(c).alias(c) for c in ("covered", "sized", "crowds")),
    )
    named = cat.groupBy(*CATEGORY_KEY, "name", "supercategory").agg(F.count(F.lit(1)).alias("times"))
    return totals.join(named, CATEGORY_KEY, "inner").select(
        *CATEGORY_KEY,
        F.col("name").alias("category"),
        "supercategory",
        (F.col("n") * F.col("times")).alias("n_annotations"),
        "n_images",
        (F.col("covered").cast("double") / F.col("sized")).alias("avg_area"),
        (F.col("crowds") * F.col("times")).cast("long").alias("crowd_annotations"),
    )


def per_image_labels(ann: DataFrame, cat: DataFrame) -> DataFrame:
    """Per image: annotation count, distinct category names and their sorted list.

    The distinct names are one ``collect_set`` (partially aggregated map-side, bounded by
    the number of category names); its size is the distinct count, so no separate
    distinct-aggregate pass is needed.
    """
    j = _labelled(ann, cat)
    names = F.collect_set("name")
    return (
        j.groupBy(*IMAGE_KEY)
        .agg(F.count(F.lit(1)).alias("n_annotations"), names.alias("_names"))
        .select(
            *SLICE_PARTITION,
            "image_id",
            "n_annotations",
            F.size("_names").cast("long").alias("n_categories"),
            F.concat_ws(",", F.sort_array("_names")).alias("categories"),
        )
    )


def repeated_file_names(meta: DataFrame) -> DataFrame:
    """File names that have several metadata rows in one delivery (the manifest has a row for each)."""
    return meta.groupBy("partner", "ingest_date", "file_name").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def ml_manifest(img: DataFrame, meta: DataFrame, ann: DataFrame, cat: DataFrame) -> DataFrame:
    """Per image: bronze / thumbnail keys, dimensions, checksum and label summary.

    images x metadata is an inner join on file name (within partner and ingest date);
    the label summary is a left join with 0 / 0 / '' defaults.
    """
    images = img.select(*SLICE_PARTITION, "image_id", "file_name", "width", "height")
    return _manifest(images, _stored(meta), ["file_name", "partner", "ingest_date"], ann, cat)


def ml_manifest_of(img: DataFrame, meta: DataFrame, ann: DataFrame, cat: DataFrame, slices: DataFrame) -> DataFrame:
    """``ml_manifest`` of many slices at once: images meet the metadata of their own slice's images dataset."""
    images = img.select(*SLICE_PARTITION, "image_id", "file_name", "width", "height")
    of = slices.select("partner", F.col("annotations_dataset").alias("dataset"), "ingest_date", "split", F.col("images_dataset").alias("stored_dataset"))
    return _manifest(images.join(of, SLICE_PARTITION), _stored(meta), ["file_name", "partner", "stored_dataset", "ingest_date"], ann, cat)


def _stored(meta: DataFrame) -> DataFrame:
    named = F.col("dataset").alias("stored_dataset")
    return meta.select("partner", named, "ingest_date", "file_name", "bronze_key", "thumbnail_key", "size_bytes", "sha256")


def _manifest(images: DataFrame, stored: DataFrame, on: list[str], ann: DataFrame, cat: DataFrame) -> DataFrame:
    labelled = images.join(stored, on, "inner").join(per_image_labels(ann, cat), IMAGE_KEY, "left")
    return labelled.select(
        "partner",
        F.col("stored_dataset").alias("dataset"),
        "ingest_date",
        "image_id",
        "file_name",
        "width",
        "height",
        "bronze_key",
        "thumbnail_key",
        "size_bytes",
        "sha256",
        F.coalesce("n_annotations", F.lit(0)).cast("long").alias("n_annotations"),
        F.coalesce("n_categories", F.lit(0)).cast("long").alias("n_categories"),
        F.coalesce("categories", F.lit("")).alias("categories"),
    )
