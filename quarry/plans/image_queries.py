"""Image profiling (U1, X8, X9, X11, X13, F12, behaviour: dimensions with an error) on
images rendered from ``embeddings``.

Stand-in images: each vector becomes a PNG of 64*(label+1) x 4*(label+1) pixels (its values
as grey levels, repeated); labels 0-4 are greyscale, 5-8 RGB, and label 9 images are cut
short (truncated files: dimensions known, profile error, no thumbnail).  Rendering runs in
a Spark ``mapInArrow`` over the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import images as img_ops
from quarry.plans.registry import register
from quarry.plans.standins import table
from quarry.session import scratch_path

PREFIX = "partner=acme/dataset=vectors/ingest_date=2024-06-01/"


def _picture(label: int, emb: list[float]) -> bytes:
    k = label + 1
    v = np.clip((np.asarray(emb, dtype=np.float64) + 1.0) * 127.5, 0, 255).astype(np.uint8)
    grey = np.tile(np.tile(v, k), (4 * k, 1))
    px = grey if label < 5 else np.stack([grey, 255 - grey, grey // 2], axis=-1)
    png = img_ops._png_bytes(np.ascontiguousarray(px))
    return png[:-20] if label == 9 else png


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bronze_key", pa.string()), ("content", pa.binary())])
    for b in batches:
        out = []
        for vid, label, emb in zip(*(b.column(i).to_pylist() for i in range(3))):
            out.append({"bronze_key": f"{PREFIX}img/{vid}.png", "content": _picture(label, emb)})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def rendered_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return e.mapInArrow(_render, S.struct(("bronze_key", S.S), ("content", S.B)))


@register(
    "image_profile",
    "U1 X8 X9 X11 X13 F12",
    f"""
SELECT '{PREFIX}img/' || CAST(vec_id AS VARCHAR) || '.png' AS bronze_key,
       CAST(vec_id AS VARCHAR) || '.png' AS file_name,
       CAST(64 * (label + 1) AS BIGINT) AS width, CAST(4 * (label + 1) AS BIGINT) AS height,
       'PNG' AS format, CASE WHEN label < 5 THEN 'L' ELSE 'RGB' END AS mode,
       CASE WHEN label < 9 THEN 'thumbnails/{PREFIX}' || CAST(vec_id AS VARCHAR) || '.jpg' END AS thumbnail_key,
       CASE WHEN label = 9 THEN 'image file is truncated' END AS error
FROM embeddings
""",
)
def image_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = img_ops.image_metadata(rendered_images(spark, sf_dir), "acme", "vectors", "2024-06-01")
    return meta.select("bronze_key", "file_name", "width", "height", "format", "mode", "thumbnail_key", "error")


@register(
    "thumbnail_sizes",
    "U2",
    """
SELECT CAST(vec_id AS VARCHAR) || '.png' AS file_name,
       CAST(CASE WHEN label < 3 THEN 64 * (label + 1) ELSE 256 END AS BIGINT) AS thumb_width,
       CAST(CASE WHEN label < 3 THEN 4 * (label + 1) ELSE 16 END AS BIGINT) AS thumb_height
FROM embeddings WHERE label < 9
""",
)
def thumbnail_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thumbnail size of every profiled image (fit in 256x256, aspect kept, never
    enlarged); failed images get none."""
    meta = img_ops.image_metadata(rendered_images(spark, sf_dir), "acme", "vectors", "2024-06-01")
    sizes = img_ops.thumbnail_dims(meta.where(F.col("thumbnail_key").isNotNull()))
    return sizes.select("file_name", "thumb_width", "thumb_height")


def _write_rendered(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.operators.bronze import _open_out

        for b in batches:
            keys = b.column("bronze_key").to_pylist()
            for key, content in zip(keys, b.column("content").to_pylist()):
                with _open_out(f"{root}/{key}") as fh:
                    fh.write(content)
            yield pa.RecordBatch.from_pydict({"bronze_key": keys}, schema=pa.schema([("bronze_key", pa.string())]))

    return run


@register(
    "thumbnails_decoded",
    "U2 K8",
    f"""
SELECT CAST(vec_id AS VARCHAR) || '.png' AS file_name,
       CAST(CASE WHEN label < 3 THEN 64 * (label + 1) ELSE 256 END AS BIGINT) AS width,
       CAST(CASE WHEN label < 3 THEN 4 * (label + 1) ELSE 16 END AS BIGINT) AS height,
       'PNG' AS format, CASE WHEN label < 5 THEN 'L' ELSE 'RGB' END AS mode
FROM embeddings WHERE label < 9
""",
)
def thumbnails_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered images land as files (written by the executors); as in the silver job,
    only images whose profile has no error get a thumbnail (the JVM decoder would accept
    the truncated ones).  Spark's image source decodes them, thumbnails are resized in
    Arrow batches and encoded as PNG, and each thumbnail's own header is read back."""
    root = scratch_path(spark, "rendered")
    rendered = rendered_images(spark, sf_dir)
    written = rendered.mapInArrow(_write_rendered(root), "bronze_key string").count()
    ok = img_ops.image_metadata(rendered, "acme", "vectors", "2024-06-01").where(F.col("error").isNull())
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", "true").load(root)
    th = img_ops.thumbnails(images, written).withColumn("file_name", F.substring_index("origin", "/", -1))
    th = th.join(ok.select("file_name"), "file_name", "left_semi")
    prof = img_ops.profile(th.select(F.col("file_name").alias("bronze_key"), "content"))
    return prof.select(F.col("bronze_key").alias("file_name"), "width", "height", "format", "mode")


def _deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rendered images under suffixes of both cases; label 8 with bytes after the end, label 7 with a sound
    header and a body that does not decode."""
    schema = pa.schema([("bronze_key", pa.string()), ("content", pa.binary())])
    for b in batches:
        out = []
        for vid, label, emb in zip(*(b.column(i).to_pylist() for i in range(3))):
            png = _picture(label, emb)
            if label == 8:
                png += bytes(32)
            elif label == 7:
                body = png.index(b"IDAT") + 4
                png = png[:body] + bytes(8) + png[body + 8 :]
            out.append({"bronze_key": f"{PREFIX}img/{vid}.{'PNG' if label % 2 else 'png'}", "content": png})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


@register(
    "thumbnails_missing",
    "U2 K8",
    f"""
SELECT '{PREFIX}img/' || CAST(vec_id AS VARCHAR) || '.PNG' AS bronze_key,
       'thumbnails/{PREFIX}' || CAST(vec_id AS VARCHAR) || '.jpg' AS thumbnail_key,
       'not decodable by the image source' AS reason
FROM embeddings WHERE label = 7
""",
)
def thumbnails_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thumbnail step of the silver job on stored images, some of which profile well and do not decode: these
    alone lack a thumbnail, whatever the case of the suffix or what follows the end marker."""
    from quarry import jobs

    layout = jobs.Layout(scratch_path(spark, "delivered"))
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    delivered = e.mapInArrow(_deliver, S.struct(("bronze_key", S.S), ("content", S.B)))
    delivered.mapInArrow(_write_rendered(layout.bronze), "bronze_key string").count()
    path = scratch_path(spark, "delivered-metadata")
    img_ops.image_metadata(delivered, "acme", "vectors", "2024-06-01").write.parquet(path)
    meta = spark.read.parquet(path)
    jobs.write_thumbnails(spark, layout, meta)
    return jobs.missing_thumbnails(meta, spark.read.parquet(layout.thumbnails))
