"""Image objects -> image_metadata rows and thumbnails.

Checksums and sizes are built-in expressions on the binary column.  Header decoding
(dimensions, format, mode, three EXIF tags) runs in ``mapInArrow`` over Arrow batches,
one small parser per task; errors are captured per row, never per job.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions import image_headers as H
from quarry.functions import keys as K
from quarry.operators.joins import gathered
from quarry.session import scratch_path, ship_code


def checksums(objects: DataFrame, content: str = "content") -> DataFrame:
    """``size_bytes`` and hex ``sha256`` of each object's bytes."""
    return objects.withColumns(
        {
            "size_bytes": F.octet_length(content).cast("long"),
            "sha256": F.sha2(F.col(content), 256),
        }
    )


def with_thumbnail_keys(images: DataFrame, prefix: str = "prefix", name: str = "file_name") -> DataFrame:
    return images.withColumn("thumbnail_key", K.thumbnail_key(prefix, name))


def thumbnail_collisions(images: DataFrame, key: str = "key") -> DataFrame:
    """Thumbnail keys produced by more than one image (the last write would win):
    same stem with another suffix, or the same name in another folder."""
    return (
        images.groupBy("thumbnail_key")
        .agg(F.count(F.lit(1)).alias("n_images"), F.count_distinct(key).alias("n_sources"))
        .where(F.col("n_images") > 1)
    )


def error_summary(meta: DataFrame, by: list[str]) -> DataFrame:
    """Rows and failed rows per group; an empty message is not an error, and messages
    are cut to the stored length first."""
    err = K.truncate_error("error")
    return (
        meta.withColumn("_err", err)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("_err").alias("n_errors"),
            F.max(F.length("_err")).cast("long").alias("max_error_chars"),
            F.sum(F.length("_err")).cast("long").alias("total_error_chars"),
        )
    )


# ---------------------------------------------------------------------------------------
# header profiling (mapInArrow)
HEAD_BYTES = 1 << 20  # header bytes sent to Python; longer headers get a second, full pass
TAIL_BYTES = 16

#: What a header tells, as it stands there; ``unsure`` asks for the whole file.
HEADER = S.struct(
    ("format", S.S), ("width", S.L), ("height", S.L), ("mode", S.S), ("make", S.S), ("model", S.S), ("orientation", S.L),
    ("problem", S.S), ("unsure", S.BOOL),
)


def read_one(head: bytes, tail: bytes, size: int) -> tuple:
    """The values of ``HEADER`` for a file of ``size`` bytes from its first and last ones.  A problem never
    raises; a file may have dimensions and a problem (one that ends too early)."""
    whole, nothing = len(head) >= size, (None,) * 7
    try:
        kind, width, height, mode, tags = H.read_header(head)
        ends_early = H.is_truncated(kind, head if whole else tail, whole)
    except H.NeedMore:
        known = head.startswith((b"\xff\xd8", b"\x89P"))
        return (*nothing, (H.TRUNCATED if known else H.UNKNOWN) if whole else None, not whole)
    except Exception as exc:
        return (*nothing, str(exc) or type(exc).__name__, False)
    texts = (None if v is None else str(v) for v in map(tags.get, (H.EXIF_MAKE, H.EXIF_MODEL)))
    return (kind, width, height, mode, *texts, tags.get(H.EXIF_ORIENTATION), H.TRUNCATED if ends_early else None, ends_early is None)


def _header_batches(root: str | None):
    """(bronze_key, head, tail, size, other columns) -> ``HEADER``, bronze_key and the other columns.  Where the first
    bytes do not tell, the whole object is fetched from ``root``, if given."""
    names = HEADER.fieldNames()
    kinds = {S.S: pa.string(), S.L: pa.int64(), S.BOOL: pa.bool_()}
    types = [kinds[f.dataType] for f in HEADER.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.operators.bronze import _open

        for b in batches:
            told = []
            for key, head, tail, size in zip(*(b.column(c).to_pylist() for c in ("bronze_key", "head", "tail", "size")), strict=True):
                told.append(read_one(head or b"", tail or b"", size or 0))
                if told[-1][-1] and root is not None:
                    with _open(f"{root.rstrip('/')}/{key}") as fh:
                        body = fh.read()
                    told[-1] = read_one(body, body[-TAIL_BYTES:], len(body))
            columns = [pa.array(c, t) for c, t in zip(zip(*told, strict=True), types, strict=True)] if told else [pa.array([], t) for t in types]
            others = [n for n in b.schema.names if n not in ("head", "tail", "size")]
            yield pa.RecordBatch.from_arrays(columns + [b.column(n) for n in others], names=names + others)

    return run


def _headers(objects: DataFrame, content: str, head_bytes: int | None, keep: list[str], root: str | None = None) -> DataFrame:
    ship_code(objects.sparkSession)
    head = F.col(content) if head_bytes is None else F.substring(content, 1, head_bytes)
    small = objects.select(
        "bronze_key",
        head.alias("head"),
        F.substring(content, -TAIL_BYTES, TAIL_BYTES).alias("tail"),
        F.octet_length(content).cast("long").alias("size"),
        *keep,
    )
    others = [f for f in small.schema.fields if f.name not in ("head", "tail", "size")]
    return small.mapInArrow(_header_batches(root), S.T.StructType([*HEADER.fields, *others]))


def _profiled(told: DataFrame) -> DataFrame:
    """The profile columns from what the headers tell: empty tags and orientation 0 count as absent."""
    return told.withColumns(
        {
            "exif_make": F.nullif("make", F.lit("")),
            "exif_model": F.nullif("model", F.lit("")),
            "exif_orientation": F.nullif("orientation", F.lit(0).cast("long")),
            "error": F.col("problem"),
        }
    ).drop("make", "model", "orientation", "problem", "unsure")


def profile(
    objects: DataFrame,
    key: str = "bronze_key",
    content: str = "content",
    head_bytes: int = HEAD_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Header profile per object (``key``, ``content``).  Only the first ``head_bytes`` and last bytes go to
    Python; objects for which these do not tell (rare) are profiled again from their full
    content, so results never depend on the cut.  What the first pass found is written below the shared
    checkpoint folder, so the objects are read once more only where needed."""
    spark = objects.sparkSession
    keep = [c for c in (keep or []) if c != key]
    named = objects if key == "bronze_key" else objects.withColumn("bronze_key", F.col(key))
    path = scratch_path(spark, "headers")
    first = _headers(named, content, head_bytes, keep)
    first.write.parquet(path)
    first = spark.read.schema(first.schema).parquet(path)
    unsure = first.where("unsure")
    if unsure.isEmpty():
        return _profiled(first)
    again = named.join(unsure.select("bronze_key").distinct(), "bronze_key", "left_semi")
    return _profiled(first.where(~F.col("unsure")).unionByName(_headers(again, content, None, keep)))


_META_COLS = ["partner", "dataset", "ingest_date", "size_bytes", "sha256"]


def _finish(prof: DataFrame) -> DataFrame:
    prefix = K.hive_prefix("partner", "dataset", "ingest_date")
    name = K.file_name("bronze_key")
    return prof.select(
        "partner",
        "dataset",
        "ingest_date",
        "bronze_key",
        name.alias("file_name"),
        "size_bytes",
        "sha256",
        "width",
        "height",
        "format",
        "mode",
        "exif_make",
        "exif_model",
        "exif_orientation",
        F.when(F.col("error").isNull(), K.thumbnail_key(prefix, name)).alias("thumbnail_key"),
        K.truncate_error("error").alias("error"),
    )


def image_metadata(
    objects: DataFrame,
    partner: str | None = None,
    dataset: str | None = None,
    ingest_date: str | None = None,
    key: str = "bronze_key",
    content: str = "content",
) -> DataFrame:
    """image_metadata rows for objects with a binary ``content`` column: size and SHA-256
    JVM-side, header profile in Arrow batches, all in one pass over the objects; thumbnail
    key when the thumbnail could be made (no error).  The drop columns come from the
    arguments, or from the objects' own columns when None."""
    base = objects.select(
        F.col(key).alias("bronze_key"),
        content,
        (F.lit(partner) if partner is not None else F.col("partner")).alias("partner"),
        (F.lit(dataset) if dataset is not None else F.col("dataset")).alias("dataset"),
        (K.date_lit(ingest_date) if ingest_date is not None else F.col("ingest_date").cast("date")).alias("ingest_date"),
        F.octet_length(content).cast("long").alias("size_bytes"),
        F.sha2(F.col(content), 256).alias("sha256"),
    )
    return _finish(profile(base, "bronze_key", content, keep=_META_COLS))


def stored_objects(keys: DataFrame, root: str, name_glob: str = "*") -> DataFrame:
    """(key, content) of the objects in the drop folders of ``keys`` (key, partner, dataset, ingest_date) below ``root``,
    by Spark's binary file source: files are listed folder by folder (the driver gets one folder per drop), and
    small ones share a task.  The source passes over names that begin with ``_`` or ``.``; those among the
    keys are fetched by key on the executors."""
    spark = keys.sparkSession
    from quarry.operators.bronze import read_objects

    prefix = K.hive_prefix(*S.DROP_PARTITION)
    inside = F.substr(F.col("key"), F.length(prefix) + 1)
    folders = sorted(r[0] for r in keys.select(prefix).distinct().collect())
    if not folders:
        return spark.createDataFrame([], "key string, content binary")
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)
        .load([f"{root.rstrip('/')}/{f}" for f in folders])
    )
    hidden = "(^|/)([_.][^/]*|[^/]*[.]_COPYING_)(/|$)"
    passed_over = keys.where(inside.rlike(hidden)).select("key").distinct()
    visible = found.select(K.key_below("path", root).alias("key"), "content")
    below = F.regexp_replace("key", "^partner=[^/]*/dataset=[^/]*/ingest_date=[^/]*/", "")
    return visible.where(~below.rlike(hidden)).unionByName(read_objects(passed_over, root))


def stored_image_metadata(keys: DataFrame, root: str) -> DataFrame:
    """image_metadata rows for objects stored at ``root/key`` (``keys``: key, partner, dataset, ingest_date).

    Sizes and checksums are taken in the JVM as the binary file source reads the objects, headers in
    Arrow batches in the same pass; only the small rows that result are joined to the keys.  A listed
    key without an object fails the job."""
    keys = keys.select("key", "partner", "dataset", F.col("ingest_date").cast("date").alias("ingest_date"))
    objects = gathered(stored_objects(keys, root, K.IMAGE_GLOB), keys.count()).withColumnRenamed("key", "bronze_key")
    told = _profiled(_headers(checksums(objects), "content", HEAD_BYTES, ["size_bytes", "sha256"], root))
    listed = keys.withColumnRenamed("key", "_key").join(told, F.col("_key") == F.col("bronze_key"), "left")
    lost = F.raise_error(F.concat(F.lit("manifest lists a key with no object: "), "_key"))
    present = F.when(F.col("bronze_key").isNull(), lost.cast("string")).otherwise(F.col("bronze_key"))
    return _finish(listed.withColumn("bronze_key", present))


# ---------------------------------------------------------------------------------------
# thumbnails from Spark's image source (decoded pixels, BGR order)
def _png_bytes(pixels: np.ndarray) -> bytes:
    h, w = pixels.shape[:2]
    ctype = 0 if pixels.ndim == 2 else 2
    raw = b"".join(b"\x00" + pixels[r].tobytes() for r in range(h))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, ctype, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def resize_area(img: np.ndarray, tw: int, th: int) -> np.ndarray:
    """Area-average downscale of an (h, w[, c]) uint8 array."""
    h, w = img.shape[:2]
    rows = (np.arange(th) * h) // th
    cols = (np.arange(tw) * w) // tw
    a = np.add.reduceat(img, rows, axis=0, dtype=np.uint64)  # whole numbers, so the sums are exact
    a = np.add.reduceat(a, cols, axis=1)
    rcount = np.diff(np.append(rows, h))
    ccount = np.diff(np.append(cols, w))
    denom = rcount[:, None] * ccount[None, :]
    if a.ndim == 3:
        denom = denom[:, :, None]
    return np.clip(np.rint(a / denom), 0, 255).astype(np.uint8)


_THUMB_ARROW = pa.schema([("origin", pa.string()), ("width", pa.int64()), ("height", pa.int64()), ("content", pa.binary())])


def _thumb_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for im, tw, th in zip(*(b.column(n).to_pylist() for n in ("image", "thumb_width", "thumb_height")), strict=True):
            h, w, c = im["height"], im["width"], im["nChannels"]
            px = np.frombuffer(im["data"], dtype=np.uint8).reshape(h, w, c)
            px = px[:, :, 0] if c == 1 else px[:, :, 2::-1]  # BGR(A) -> RGB, alpha dropped
            small = resize_area(np.ascontiguousarray(px), tw, th) if (tw, th) != (w, h) else px
            out.append({"origin": im["origin"], "width": tw, "height": th, "content": _png_bytes(np.ascontiguousarray(small))})
        yield pa.RecordBatch.from_pylist(out, schema=_THUMB_ARROW)


def thumbnails(images: DataFrame, total_images: int | None = None) -> DataFrame:
    """Thumbnails (fit in 256x256, aspect kept, never enlarged; RGB or L; PNG bytes) of a
    DataFrame from ``spark.read.format("image")``.  Where their number is known, small files share a task."""
    ship_code(images.sparkSession)
    if total_images is not None:
        images = gathered(images, total_images)
    sized = thumbnail_dims(images.select("image", "image.width", "image.height").where("width > 0 and height > 0"))
    return sized.select("image", "thumb_width", "thumb_height").mapInArrow(
        _thumb_batches, S.struct(("origin", S.S), ("width", S.L), ("height", S.L), ("content", S.B))
    )



def thumbnail_dims(meta: DataFrame, bound: int = H.THUMBNAIL_MAX) -> DataFrame:
    """``thumb_width`` / ``thumb_height`` from ``width`` / ``height``: an image inside bound x bound
    keeps its size.  Any other gets ``bound`` for its longer side, and for the shorter one that of the two
    whole numbers around the exact length whose width : height is nearer to the original's (the
    smaller if both are as near, 1 at least).  Whole-number arithmetic throughout."""
    w, h = F.col("width").cast("long"), F.col("height").cast("long")
    long_side, short = F.greatest(w, h), F.least(w, h)
    b = F.lit(bound).cast("long")
    low = F.expr(f"({bound}L * least(width, height)) div greatest(width, height)")
    exact = b * short == low * long_side
    # upright: widths low and low + 1 over bound, the nearer to b * short / long
    upright = 2 * b * short <= (2 * low + 1) * long_side
    # lying: bound over heights low and low + 1; b/low - w/h <= w/h - b/(low + 1), cleared of fractions
    lying = b * (2 * low + 1) * short <= 2 * long_side * low * (low + 1)
    nearer = F.when(exact | F.when(h >= w, upright).otherwise(lying), low).otherwise(low + 1)
    side = F.greatest(nearer, F.lit(1).cast("long"))
    inside = long_side <= b
    return meta.withColumns(
        {
            "thumb_width": F.when(inside, w).when(h >= w, side).otherwise(b),
            "thumb_height": F.when(inside, h).when(h >= w, b).otherwise(side),
        }
    )
