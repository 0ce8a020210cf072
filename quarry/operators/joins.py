"""How many tasks heavy per-row work is spread over, and how few the reading of many small files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of content one task of extraction, fetching or parsing should handle, and rows at most.
TASK_BYTES, TASK_ROWS = 128 << 20, 2_000


def spread(rows: DataFrame, keys: list[str], total_bytes: int | None = None, total_rows: int = 0) -> DataFrame:
    """``rows`` (small descriptions of heavy work) dealt over tasks by a hash of ``keys``.

    The number of partitions follows the bytes and rows of work, not the size of the
    descriptions; given as a number, adaptive execution does not merge them.  At least one
    partition per core, so that a single large archive or document still uses the cluster; where
    the work is not known, as many as the session shuffles to."""
    spark = rows.sparkSession
    least = spark.sparkContext.defaultParallelism
    if total_bytes is None and not total_rows:
        least = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = max(least, -(-(total_bytes or 0) // TASK_BYTES), -(-total_rows // TASK_ROWS))
    # by a hash of the keys: where the rows come dealt by the keys themselves, Spark would leave this repartition
    # out, and adaptive execution would merge the tasks by the few bytes of the descriptions
    return rows.repartition(int(n), F.xxhash64(*keys))


def gathered(files: DataFrame, total_files: int) -> DataFrame:
    """``files`` (read from storage, a row per small file) in as many tasks as the number of files asks for, four per core
    at least.  A file counts as 4 MB when Spark cuts a scan, so that a task has some thirty small files and
    costs more than they do."""
    n = max(4 * files.sparkSession.sparkContext.defaultParallelism, -(-total_files // (TASK_ROWS // 4)))
    return files.coalesce(int(n))


def work_of(rows: DataFrame, size: Column | None = None) -> tuple[int, int]:
    """(bytes, rows) of the work that ``rows`` describe; one aggregate over small rows."""
    total = F.sum(size) if size is not None else F.lit(0)
    r = rows.agg(F.coalesce(total, F.lit(0)).cast("long").alias("b"), F.count(F.lit(1)).alias("n")).first()
    return r.b, r.n
