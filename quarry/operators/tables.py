"""Silver/gold table operations on partitioned parquet tables: stage, read staged data,
create, upsert (MERGE on one key), dynamic partition overwrite, create-or-replace,
audit counts and a per-table version log.

Path tables are the primary form (works on any storage a cluster shares); catalog
variants use the session catalog.  Every write counts its rows with ``observe`` (no
second scan) and appends a row to the table's version log.

Upsert without a table format (no MERGE on plain parquet), on tables bucketed by the merge key:
1. fail if a staged key that matches the target occurs twice in the staged rows;
2. touched partitions = staged partitions + partitions of target rows whose key is staged;
3. result = target rows of the touched partitions, full outer joined with the staged rows on the
   key: staged where there is one (null keys never match, so they stay).  The target is read bucket by
   bucket, so only the staged rows are shuffled;
4. the result is written once, with dynamic partition overwrite: the new files are complete before they
   are swapped in, so the plan may read the files it replaces; touched partitions left with no
   rows are dropped.
The commit is per partition, not atomic across partitions.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import os
import tempfile
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path, setting

VERSION_LOG = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("rows_total", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)


#: Buckets of a table that is merged into, unless the caller gives another number.
MERGE_BUCKETS = 32


def _dyn_writer(df: DataFrame, partition_cols: list[str]):
    return (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .format("parquet")
    )


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


#: Partitions that a writing task keeps open at once; only rows of tasks that meet more are sorted by partition first.
OPEN_FILES = 4


def _unsorted(spark: SparkSession):
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)


def _layout(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Few files per partition: AQE's rebalance groups rows by partition and splits a hot
    partition over several tasks instead of one."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df


# ---------------------------------------------------------------------------------------
# small files beside the tables
def _fs(spark: SparkSession, path: str):
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def _put_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless it exists; False if it does.  Of several writers one succeeds: the file is
    linked into place on a local disk, created without overwriting elsewhere."""
    fs, hp = _fs(spark, path)
    fs.mkdirs(hp.getParent())
    if fs.getScheme() == "file":
        local = hp.toUri().getPath()
        with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(local), prefix=".", suffix=".tmp") as fh:
            fh.write(text)
            fh.flush()
            try:
                os.link(fh.name, local)
            except FileExistsError:
                return False
        return True
    try:
        out = fs.create(hp, False)
    except Py4JJavaError as e:
        if fs.exists(hp):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read_small(spark: SparkSession, path: str) -> str | None:
    fs, hp = _fs(spark, path)
    if not fs.exists(hp):
        return None
    stream = fs.open(hp)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


# ---------------------------------------------------------------------------------------
# version log
def version_log_path(path: str) -> str:
    return path.rstrip("/") + ".versions"


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions of the table at ``path``, one row each, by number."""
    if not path_exists(spark, version_log_path(path)):
        return spark.createDataFrame([], VERSION_LOG)
    return spark.read.schema(VERSION_LOG).option("pathGlobFilter", "*.json").json(version_log_path(path))


def _version_numbers(spark: SparkSession, log: str) -> list[int]:
    fs, hp = _fs(spark, log)
    names = [st.getPath().getName() for st in fs.listStatus(hp)] if fs.exists(hp) else []
    return [int(n[: -len(".json")]) for n in names if n.endswith(".json")]


def table_rows(spark: SparkSession, path: str, version: int | None = None) -> int:
    """Rows of the table as its version log has them: one small file is read, the table is not counted."""
    log = version_log_path(path)
    if version is None:
        version = max(_version_numbers(spark, log), default=0)
    text = _read_small(spark, f"{log}/{version:012d}.json")
    return json.loads(text)["rows_total"] if text else 0


def log_version(spark: SparkSession, path: str, table_name: str, operation: str, rows: int, replaced: int | None = None) -> int:
    """Append one version: a small file named by its number, made only if no other writer has made it; who
    comes second takes the next number.  ``replaced`` rows went as ``rows`` came; None: the whole
    table was written.  Returns the number."""
    log = version_log_path(path)
    version = max(_version_numbers(spark, log), default=0) + 1
    while True:
        now = _dt.datetime.now(_dt.UTC).isoformat(timespec="microseconds")
        total = rows if replaced is None else table_rows(spark, path, version - 1) + rows - replaced
        row = {"table_name": table_name, "version": version, "operation": operation, "rows_written": int(rows), "rows_total": int(total), "committed_at": now}
        if _put_absent(spark, f"{log}/{version:012d}.json", json.dumps(row)):
            return version
        version += 1


def version_counts(versions: DataFrame) -> DataFrame:
    """Number of versions and rows written per table (the snapshot count of the reference)."""
    return versions.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_versions"), F.sum("rows_written").cast("long").alias("rows_written")
    )


# ---------------------------------------------------------------------------------------
# staging and reading
def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hp = _fs(spark, path)
    return bool(fs.exists(hp))


def _is_missing_path(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (cond() if cond else None) == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e)


def stage(df: DataFrame, path: str, partition_cols: list[str], laid_out: bool = False) -> int:
    """Write staged rows under Hive partition folders; re-running a drop replaces exactly
    its partitions (dynamic overwrite).  Returns the number of rows written.  ``laid_out``: ``df`` is read from a table
    of the same partitions, so its few files per partition stay few without a shuffle."""
    df, obs = _observed(df if laid_out else _layout(df, partition_cols))
    with _unsorted(df.sparkSession):
        _dyn_writer(df, partition_cols).save(path)
    return int(obs.get["rows"])


def append(df: DataFrame, path: str, partition_cols: list[str]) -> int:
    """Adds rows to a partitioned table; returns their number."""
    df, obs = _observed(_layout(df, partition_cols))
    df.write.mode("append").partitionBy(*partition_cols).parquet(path)
    return int(obs.get["rows"])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, ingest_date: str | _dt.date | None = None
) -> DataFrame | None:
    """Read a partitioned parquet table with an explicit schema (partition values keep
    their declared types); None when the path does not exist (only that error is
    swallowed).  ``ingest_date`` limits the read to one day's partitions."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.parquet(path)
    except AnalysisException as e:
        if _is_missing_path(e):
            return None
        raise
    if ingest_date is not None:
        d = ingest_date if isinstance(ingest_date, _dt.date) else _dt.date.fromisoformat(ingest_date)
        df = df.where(F.col("ingest_date") == F.lit(d))
    return df


# ---------------------------------------------------------------------------------------
# pure forms
def upsert(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *, as a DataFrame."""
    keys = staged.select(key).where(F.col(key).isNotNull()).distinct()
    kept = target.join(keys, key, "left_anti")
    return staged.unionByName(kept.select(*staged.columns))


def check_merge_duplicates(target: DataFrame, staged: DataFrame, key: str) -> None:
    """A target row matched by two staged rows is an error for MERGE; so is it here."""
    dup = staged.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1).select(key)
    if not dup.limit(1).count():  # the usual case: no staged key repeats, the target is not read
        return
    bad = dup.join(target.select(key), key, "left_semi").limit(5).collect()
    if bad:
        raise ValueError(f"MERGE source has several rows for target keys {[r[0] for r in bad]}")


# ---------------------------------------------------------------------------------------
# path tables
def create(
    spark: SparkSession, df: DataFrame, path: str, partition_cols: list[str], table_name: str, key: str | None = None, buckets: int = MERGE_BUCKETS,
    laid_out: bool = False,
) -> int:
    """Create a table from a DataFrame (fails if it exists); no dedup of the first load.  With a merge
    ``key`` its files are bucketed by it, and a note beside the table says so.  ``laid_out``: as in ``stage``."""
    if key is None:
        df, obs = _observed(df if laid_out else _layout(df, partition_cols))
        with _unsorted(spark):
            df.write.mode("errorifexists").partitionBy(*partition_cols).parquet(path)
    else:
        if path_exists(spark, path):
            raise ValueError(f"{path} exists")
        df, obs = _observed(df.repartition(buckets, key))  # a task per bucket: one file per bucket and partition
        (
            df.write.format("parquet").partitionBy(*partition_cols).bucketBy(buckets, key).sortBy(key)
            .option("path", path).mode("overwrite").saveAsTable(_catalog_name(path))
        )
        ordered = [c for c in df.columns if c not in partition_cols] + partition_cols
        note = {"key": key, "buckets": buckets, "partition_cols": partition_cols, "schema": df.select(*ordered).schema.jsonValue()}
        _put_absent(spark, _bucket_note(path), json.dumps(note))
    rows = int(obs.get["rows"])
    log_version(spark, path, table_name, "create", rows)
    return rows


# ---------------------------------------------------------------------------------------
# bucketed tables: the session catalog is told of them when they are opened

def _bucket_note(path: str) -> str:
    return path.rstrip("/") + ".buckets"


def _catalog_name(path: str) -> str:
    return "quarry_" + hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:16]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bucketed(spark: SparkSession, path: str, key: str) -> str | None:
    """The catalog name under which the table at ``path`` reads as bucketed by ``key``; None if it isn't.
    Only the session's catalog changes; partitions are found by listing."""
    text = _read_small(spark, _bucket_note(path))
    note = json.loads(text) if text else {}
    if note.get("key") != key:
        return None
    name = _catalog_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(note["schema"]).fields)
    parts = ", ".join(f"`{c}`" for c in note["partition_cols"])
    tracked = spark.conf.get("spark.sql.hive.manageFilesourcePartitions")
    spark.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet " + (f"PARTITIONED BY ({parts}) " if parts else "")
            + f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {note['buckets']} BUCKETS LOCATION {_quoted(path)}"
        )
    finally:
        spark.conf.set("spark.sql.hive.manageFilesourcePartitions", tracked)
    return name


def overwrite_partitions(
    spark: SparkSession, df: DataFrame, path: str, partition_cols: list[str], table_name: str, laid_out: bool = False
) -> int:
    """Replace exactly the partitions present in ``df``; others are untouched.  ``laid_out``: as in ``stage``."""
    old = read_table(spark, path)
    replaced = in_partitions(old, partition_cols, df.select(*partition_cols).distinct()).count() if old is not None else 0
    rows = stage(df, path, partition_cols, laid_out)
    log_version(spark, path, table_name, "overwrite_partitions", rows, replaced)
    return rows


def replace(spark: SparkSession, df: DataFrame, path: str, partition_cols: list[str], table_name: str) -> int:
    """Create or replace the whole table (gold semantics: other partners' rows go too)."""
    df, obs = _observed(_layout(df, partition_cols))
    with _unsorted(spark):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_cols).parquet(path)
    rows = int(obs.get["rows"])
    log_version(spark, path, table_name, "replace", rows)
    return rows


def in_partitions(df: DataFrame, partition_cols: list[str], touched: DataFrame) -> DataFrame:
    """The rows of ``df`` in the partitions of ``touched`` (null values match null): a
    semi-join on the partition columns, so partitions are pruned at run time whatever their number."""
    names = {c: f"_touched_{i}" for i, c in enumerate(partition_cols)}
    side = touched.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return df.join(side, reduce(lambda x, y: x & y, same), "left_semi")


# Characters escaped in partition folder names (as Spark names them), and the null folder.
_PATH_ESCAPE = set('"%' + "'*/:=?\\\x7f{[]^")
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_dir_name(value) -> str:
    if value is None:
        return NULL_PARTITION
    text = str(value)
    return "".join(f"%{ord(ch):02X}" if ch in _PATH_ESCAPE or ord(ch) < 0x20 else ch for ch in text)


def drop_partitions(spark: SparkSession, path: str, partition_cols: list[str], parts: list) -> None:
    """Delete the folders of the given partitions (rows or dicts of partition values)."""
    for p in parts:
        sub = "/".join(f"{partition_dir_name(c)}={partition_dir_name(p[c])}" for c in partition_cols)
        fs, hp = _fs(spark, f"{path.rstrip('/')}/{sub}")
        fs.delete(hp, True)


def merge_rows(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Target rows with a staged row of their key become that row; the others of both sides stay as they are.
    ``_was`` tells the rows that stand for one of the target."""
    old = target.select(F.col(key).alias("_key"), F.struct(*staged.columns).alias("_old"))
    new = staged.select(F.col(key).alias("_staged"), F.struct(*staged.columns).alias("_new"))
    both = old.join(new, F.col("_key") == F.col("_staged"), "full_outer")
    return both.select(F.coalesce("_new", "_old").alias("_row"), F.col("_old").isNotNull().alias("_was")).select("_row.*", "_was")


def touched_partitions(target: DataFrame, staged: DataFrame, key: str, partition_cols: list[str]) -> DataFrame:
    """The partitions of staged rows and of target rows whose key is staged: one row each."""
    keys = staged.select(F.col(key).alias("_staged")).where("_staged is not null")
    moved = target.select(key, *partition_cols).join(keys, F.col(key) == F.col("_staged"), "left_semi").select(*partition_cols)
    return staged.select(*partition_cols).unionByName(moved).distinct()


def upsert_into(
    spark: SparkSession,
    staged: DataFrame,
    path: str,
    key: str,
    partition_cols: list[str],
    table_name: str,
    schema: T.StructType | None = None,
    buckets: int = MERGE_BUCKETS,
) -> int:
    """Upsert ``staged`` into the partitioned parquet table at ``path`` on ``key``; returns rows written.

    Creates the table, bucketed by ``key``, when it does not exist; one that exists without buckets
    is shuffled for each upsert.  ``staged`` is written once below the shared checkpoint folder, and every step
    reads that copy.  The driver holds the partitions touched, as the file listing of the table does."""
    target = read_table(spark, path, schema)
    if target is None:
        return create(spark, staged, path, partition_cols, table_name, key, buckets)
    copy = scratch_path(spark, "upsert-staged")
    staged.write.parquet(copy)
    staged = spark.read.schema(staged.schema).parquet(copy)
    name = bucketed(spark, path, key)
    if name is not None:
        target = spark.table(name)
    check_merge_duplicates(target, staged, key)
    parts = touched_partitions(target, staged, key, partition_cols).collect()  # one row per partition
    if not parts:
        return 0
    touched = spark.createDataFrame(parts, T.StructType([staged.schema[c] for c in partition_cols]))
    result = merge_rows(in_partitions(target.select(*staged.columns), partition_cols, touched), staged, key)
    seen = Observation()
    left_over = F.collect_set(F.struct(*partition_cols)).alias("left")
    result = result.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("_was").alias("was"), left_over).drop("_was")
    if name is not None:
        overwrite_table_partitions(spark, result, name)
    else:
        _dyn_writer(_layout(result, partition_cols), partition_cols).save(path)
    left = {tuple(r) for r in seen.get["left"]}
    drop_partitions(spark, path, partition_cols, [p for p in parts if tuple(p) not in left])
    rows = int(seen.get["rows"])
    log_version(spark, path, table_name, "merge", rows, int(seen.get["was"]))
    return rows


# ---------------------------------------------------------------------------------------
# catalog tables (session catalog; a table-format catalog takes the same calls)
def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(df: DataFrame, name: str, partition_cols: list[str]) -> None:
    df.writeTo(name).using("parquet").partitionedBy(*[F.col(c) for c in partition_cols]).create()


def overwrite_table_partitions(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Dynamic partition overwrite into a catalog table, by column name (partition columns
    sit last in a parquet table, so the DataFrame is reordered to the table's order)."""
    cols = spark.table(name).columns
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.select(*cols).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def replace_table(df: DataFrame, name: str, partition_cols: list[str]) -> None:
    df.write.mode("overwrite").partitionBy(*partition_cols).format("parquet").saveAsTable(name)


def audit_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (one aggregate per table, unioned)."""
    out = None
    for name, df in tables.items():
        c = df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = c if out is None else out.unionByName(c)
    return out
