"""Manifests: per-drop file lists, silver routing, and the manifest-vs-objects check.

A manifest is kept as two tables, never as one collected list: a header per drop
(counts and byte totals from a partial aggregate) and a files table (one row per entry).
For export as JSON documents the files are cut into pages of at most ``page_size``
entries, so no document, row or task ever holds an unbounded drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import keys as K
from quarry.operators.joins import work_of

DEFAULT_PAGE_SIZE = 1000


def header(files: DataFrame, drop_cols: list[str]) -> DataFrame:
    """File count and total bytes per drop (map-side partial aggregation)."""
    return files.groupBy(*drop_cols).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size_bytes").cast("long").alias("total_bytes"),
    )


def pages(files: DataFrame, drop_cols: list[str], pos: str = "pos", page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Manifest document pages: ``files`` (key, size_bytes, crc32) of at most
    ``page_size`` entries each, in archive order (``pos``)."""
    entry = F.struct(
        F.col(pos).alias("pos"),
        F.col("key").alias("key"),
        F.col("size_bytes").alias("size_bytes"),
        F.col("crc32").alias("crc32"),
    )
    return (
        files.withColumn("page", F.floor(F.col(pos) / page_size).cast("long"))
        .groupBy(*drop_cols, "page")
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        .select(
            *drop_cols,
            "page",
            F.size("_entries").cast("long").alias("page_file_count"),
            F.aggregate("_entries", F.lit(0).cast("long"), lambda acc, e: acc + F.coalesce(e["size_bytes"], F.lit(0))).alias(
                "page_bytes"
            ),
            F.transform("_entries", lambda e: F.struct(e["key"].alias("key"), e["size_bytes"].alias("size_bytes"), e["crc32"].alias("crc32"))).alias(
                "files"
            ),
        )
    )


def explode_files(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Manifest documents (or pages) -> one row per listed file, with ``keep`` columns."""
    return docs.select(*keep, F.posexplode("files").alias("entry_pos", "f")).select(
        *keep, "entry_pos", "f.key", "f.size_bytes", "f.crc32"
    )


def silver_routing(files: DataFrame, manifest_col: str = "manifest_key", key: str = "key") -> DataFrame:
    """Per manifest: images and annotation documents listed, and which silver jobs run.
    A manifest with neither gets status NOOP instead of waiting for ever."""
    out = files.groupBy(manifest_col).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(K.is_image_key(key)).alias("n_images"),
        F.count_if(K.is_coco_json(key)).alias("n_coco_json"),
    )
    return out.withColumns(
        {
            "run_profile": F.col("n_images") > 0,
            "run_normalize": F.col("n_coco_json") > 0,
        }
    ).withColumn(
        "status",
        F.when(F.col("run_profile") | F.col("run_normalize"), F.lit("SUBMITTED")).otherwise(F.lit("NOOP")),
    )


#: Rows of both sides that one task of an anti-join should hold.
KEYS_A_TASK = 1 << 20


def _absent(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key is not among those of ``known``.  Both sides are dealt by key over a number of tasks that
    follows their rows: adaptive execution would size tasks by compressed bytes, and keys compress so well that
    a task's memory would grow with the input.  A task holds the distinct keys it was dealt, and sorts nothing."""
    n_rows = sum(work_of(side)[1] for side in (rows, known))
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // KEYS_A_TASK))
    keys = known.select(key).repartition(n, key).hint("shuffle_hash")
    return rows.repartition(n, key).join(keys, key, "left_anti")


def missing_objects(listed: DataFrame, objects: DataFrame, key: str = "key") -> DataFrame:
    """Listed keys with no stored object (anti-join)."""
    return _absent(listed, objects, key)


def unlisted_objects(listed: DataFrame, objects: DataFrame, key: str = "key") -> DataFrame:
    """Stored objects no manifest lists (anti-join the other way)."""
    return _absent(objects, listed, key)


def require_objects(listed: DataFrame, objects: DataFrame, key: str = "key") -> None:
    """Fail the job when a listed key has no object, as an unguarded fetch would."""
    missing = missing_objects(listed.select(key), objects, key).limit(5).collect()
    if missing:
        raise FileNotFoundError(f"manifest lists keys with no object, e.g. {[r[0] for r in missing]}")
