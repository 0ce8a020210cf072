"""Explicit schemas of every table the pipeline reads or writes.

Nothing is inferred: partner/dataset/split are always strings, ingest_date is always a
date, ids are bigint, bbox and area are double.  An empty input therefore still yields a
table with all its columns.
"""

from pyspark.sql import types as T

S, L, D, DT, B, TS, BOOL = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.BinaryType(),
    T.TimestampType(),
    T.BooleanType(),
)


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Partition columns of the layers (key scheme partner=/dataset=/ingest_date=[/split=]).
DROP_PARTITION = ["partner", "dataset", "ingest_date"]
SLICE_PARTITION = ["partner", "dataset", "ingest_date", "split"]

# Landing object-created event (one per object, delivered at least once).
LANDING_EVENT = struct(
    (
        "detail",
        struct(
            ("bucket", struct(("name", S))),
            ("object", struct(("key", S), ("size", L), ("etag", S))),
        ),
    ),
    ("time", S),
)

# Ledger: append-only status events; the current state of a drop is its latest event.
LEDGER = struct(
    ("drop_id", S),
    ("partner", S),
    ("src_bucket", S),
    ("src_key", S),
    ("size_bytes", L),
    ("ingest_date", S),
    ("status", S),
    ("received_at", S),
)

LEDGER_STATUS_EVENT = struct(
    ("drop_id", S),
    ("status", S),
    ("updated_at", TS),
    ("batch_job_id", S),
    ("bronze_key", S),
    ("bronze_prefix", S),
    ("manifest_key", S),
    ("file_count", L),
    ("error", S),
)

# One extracted archive entry (a row of the bronze table).
ARCHIVE_ENTRY = struct(
    ("archive_path", S),
    ("pos", L),
    ("path", S),
    ("size_bytes", L),
    ("crc32", L),
    ("content", B),
    ("error", S),
)

MANIFEST_FILE = struct(("key", S), ("size_bytes", L), ("crc32", L))

# Manifest header (one per drop); files are a separate table, never one collected list.
MANIFEST_HEADER = struct(
    ("drop_id", S),
    ("partner", S),
    ("dataset", S),
    ("ingest_date", S),
    ("source", S),
    ("completed_at", S),
    ("file_count", L),
    ("total_bytes", L),
)

# A manifest document page: the header plus at most PAGE_SIZE file entries.
MANIFEST_PAGE = T.StructType(
    list(MANIFEST_HEADER.fields)
    + [
        T.StructField("page", L, True),
        T.StructField("files", T.ArrayType(MANIFEST_FILE), True),
    ]
)

# Nested annotation documents: only the listed arrays are ever materialised
# (segmentation, keypoints, licences ... are not in the schema, so never parsed).
INSTANCES_DOC = struct(
    (
        "images",
        T.ArrayType(struct(("id", L), ("file_name", S), ("width", L), ("height", L))),
    ),
    (
        "categories",
        T.ArrayType(struct(("id", L), ("name", S), ("supercategory", S))),
    ),
    (
        "annotations",
        T.ArrayType(
            struct(
                ("id", L),
                ("image_id", L),
                ("category_id", L),
                ("bbox", T.ArrayType(D)),
                ("area", D),
                ("iscrowd", L),
            )
        ),
    ),
)

CAPTIONS_DOC = struct(
    ("annotations", T.ArrayType(struct(("id", L), ("image_id", L), ("caption", S)))),
)

_BASE = [("partner", S), ("dataset", S), ("ingest_date", DT)]

COCO_IMAGES = struct(*_BASE, ("image_id", L), ("file_name", S), ("width", L), ("height", L), ("split", S))
COCO_CATEGORIES = struct(*_BASE, ("category_id", L), ("name", S), ("supercategory", S), ("split", S))
COCO_ANNOTATIONS = struct(
    *_BASE,
    ("annotation_id", L),
    ("image_id", L),
    ("category_id", L),
    ("bbox_x", D),
    ("bbox_y", D),
    ("bbox_w", D),
    ("bbox_h", D),
    ("area", D),
    ("iscrowd", L),
    ("split", S),
)
COCO_CAPTIONS = struct(*_BASE, ("caption_id", L), ("image_id", L), ("caption", S), ("split", S))

IMAGE_METADATA = struct(
    *_BASE,
    ("bronze_key", S),
    ("file_name", S),
    ("size_bytes", L),
    ("sha256", S),
    ("width", L),
    ("height", L),
    ("format", S),
    ("mode", S),
    ("exif_make", S),
    ("exif_model", S),
    ("exif_orientation", L),
    ("thumbnail_key", S),
    ("error", S),
)

THUMBNAIL = struct(("thumbnail_key", S), ("width", L), ("height", L), ("content", B))

CATEGORY_STATS = struct(
    ("partner", S),
    ("dataset", S),
    ("ingest_date", DT),
    ("category_id", L),
    ("category", S),
    ("supercategory", S),
    ("n_annotations", L),
    ("n_images", L),
    ("avg_area", D),
    ("crowd_annotations", L),
)

ML_MANIFEST = struct(
    ("partner", S),
    ("dataset", S),
    ("ingest_date", DT),
    ("image_id", L),
    ("file_name", S),
    ("width", L),
    ("height", L),
    ("bronze_key", S),
    ("thumbnail_key", S),
    ("size_bytes", L),
    ("sha256", S),
    ("n_annotations", L),
    ("n_categories", L),
    ("categories", S),
)

# Silver table registry: table -> (partition columns, merge key or None for partition overwrite).
SILVER_TABLES = {
    "image_metadata": (DROP_PARTITION, "bronze_key", IMAGE_METADATA),
    "coco_images": (SLICE_PARTITION, None, COCO_IMAGES),
    "coco_categories": (SLICE_PARTITION, None, COCO_CATEGORIES),
    "coco_annotations": (SLICE_PARTITION, None, COCO_ANNOTATIONS),
    "coco_captions": (SLICE_PARTITION, None, COCO_CAPTIONS),
}
