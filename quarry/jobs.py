"""Job entry points: the medallion flow as Spark jobs over one shared storage root.

    landing/<bucket>/<key>             objects dropped by partners
    ledger/                            drop registrations (partitions by hash bucket and batch)
    ledger-quarantine/                 events that are malformed, with the reason
    ledger-status/                     append-only status events
    drop-state/                        current state per drop (open ones apart), kept incrementally
    bronze/<partner=/dataset=/ingest_date=>/<path>   immutable objects
    manifests/                         manifest files table (one row per listed file)
    staging/<table>/                   silver staging (Hive partitions)
    silver/<table>/, gold/<table>/     partitioned parquet tables (+ .versions logs)
    thumbnails/                        thumbnail table (key, size, PNG bytes)

Every step is idempotent: keys are deterministic, partitions are replaced, the ledger
anti-joins.  A step's work set is read from the tables, so re-running after a failure
redoes exactly what is missing.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions import keys as K
from quarry.operators import annotations as A
from quarry.operators import bronze, drop_state, gold, landing
from quarry.operators import images as I
from quarry.operators import manifest as M
from quarry.operators import tables as tbl
from quarry.operators.joins import spread, work_of
from quarry.session import scratch_path
from quarry.streaming import ledger as ledger_stream

MANIFEST_FILES = S.struct(
    ("drop_id", S.S),
    ("pos", S.L),
    ("key", S.S),
    ("size_bytes", S.L),
    ("crc32", S.L),
    ("source", S.S),
    ("content_type", S.S),
    ("partner", S.S),
    ("dataset", S.S),
    ("ingest_date", S.DT),
)
FILE_ROWS = 1 << 20  # rows of a drop that one file of the manifests table holds
STATUS_EVENTS = S.struct(
    ("drop_id", S.S),
    ("status", S.S),
    ("updated_at", S.TS),
    ("bronze_key", S.S),
    ("manifest_key", S.S),
    ("file_count", S.L),
    ("error", S.S),
    ("bronze_prefix", S.S),
    ("batch_job_id", S.S),
)


@dataclass(frozen=True)
class Layout:
    root: str

    def __getattr__(self, name: str) -> str:  # landing, ledger, bronze, manifests, ...
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name.replace('_', '-')}"

    def staging(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/staging/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{table}"


def _now(spark: SparkSession):
    return F.lit(_dt.datetime.now(_dt.UTC).replace(tzinfo=None)).cast("timestamp")


def _uri(c):
    return F.regexp_replace(c, r"^file:/+", "file:/")


# ---------------------------------------------------------------------------------------
def register_events(spark: SparkSession, layout: Layout, events: DataFrame, batch_id: int | None = None) -> int:
    """Batch form of the landing stream: record new drops in the ledger.  Without a
    ``batch_id`` a fresh one is taken, so that an earlier registration is never replaced; a
    given one replays that batch."""
    if batch_id is None:
        batch_id = ledger_stream.fresh_batch_id(spark, layout.ledger)
    return ledger_stream.register_batch(spark, events, batch_id, layout.ledger, state_path=layout.drop_state)


def pending_drops(spark: SparkSession, layout: Layout) -> DataFrame:
    """Drops whose current status is not final (the work set, read after registration, so a lost
    submission is retried): the open partitions of the state table, not the history."""
    if not tbl.path_exists(spark, layout.drop_state):
        led = tbl.read_table(spark, layout.ledger, ledger_stream.LEDGER_TABLE)
        if led is None:
            return spark.createDataFrame([], ledger_stream.LEDGER_TABLE).select(*landing.LEDGER_COLUMNS)
        drop_state.rebuild(spark, layout.drop_state, led, tbl.read_table(spark, layout.ledger_status, STATUS_EVENTS))
    todo = drop_state.open_drops(spark, layout.drop_state).where("src_key is not null")
    return todo.select(*landing.LEDGER_COLUMNS)


def _status(spark: SparkSession, df: DataFrame, status, **columns) -> DataFrame:
    """Status events of ``df`` (drop_id); attributes not given are null."""
    given = {"status": status, "updated_at": _now(spark), "batch_job_id": F.lit(spark.sparkContext.applicationId), **columns}
    values = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATUS_EVENTS.fields if f.name != "drop_id"]
    return df.select("drop_id", *values)


def _record(spark: SparkSession, layout: Layout, events: DataFrame) -> None:
    """Status events into the history and the state table; what ``events`` does runs once."""
    path = scratch_path(spark, "status")
    events.write.parquet(path)
    events = spark.read.schema(STATUS_EVENTS).parquet(path)
    events.write.mode("append").parquet(layout.ledger_status)
    drop_state.update(spark, layout.drop_state, events)


def bronze_job(spark: SparkSession, layout: Layout, drops: DataFrame) -> None:
    """Unpack archives and copy loose objects of ``drops`` into bronze; write manifest rows,
    manifest documents and status events.

    Each distinct archive is listed and read once, however many drops deliver it, by tasks
    whose number follows its bytes.  A drop with any entry that could not be listed, read or
    written is FAILED and gets no manifest; so is a loose object that could not be copied."""
    work = scratch_path(spark, "work-set")  # fixed here: the tables it comes from change while the job runs
    drops.select(*landing.LEDGER_COLUMNS).write.parquet(work)
    routed = landing.route(spark.read.parquet(work))
    src_key = F.concat("src_bucket", F.lit("/"), "src_key")
    landing_root = layout.landing.rstrip("/") + "/"
    archives = routed.where(F.col("action") == "unpack").select(
        "drop_id",
        "partner",
        "dataset",
        F.col("ingest_date").cast("date").alias("ingest_date"),
        "bronze_prefix",
        _uri(F.concat(F.lit(landing_root), src_key)).alias("upath"),
    )
    prefix = {"bronze_prefix": F.col("bronze_prefix")}
    began = [_status(spark, archives, F.lit(state), **prefix) for state in ("SUBMITTED", "UNPACKING")]
    _record(spark, layout, began[0].unionByName(began[1]))

    listing_path, written_path = scratch_path(spark, "listing"), scratch_path(spark, "unpacked")
    paths = archives.select(F.col("upath").alias("path")).distinct()
    bronze.list_entries(paths).withColumn("upath", _uri("archive_path")).write.parquet(listing_path)
    listing = spark.read.parquet(listing_path)
    targets = archives.select("upath", "bronze_prefix").distinct()
    entries = (
        listing.where("error is null")
        .join(targets.groupBy("upath").agg(F.collect_set("bronze_prefix").alias("prefixes")), "upath")  # one per delivery day
        .withColumn("keys", F.transform("prefixes", lambda p: F.concat(p, F.col("path"))))
    )
    n_bytes, n_rows = work_of(listing, F.col("size_bytes"))
    bronze.unpack_to(entries, layout.bronze, n_bytes, n_rows).withColumn("upath", _uri("archive_path")).write.parquet(written_path)
    written = spark.read.parquet(written_path)

    # outcome of each archive and prefix: entries written, and the first error of any step
    of_key = F.expr("substring(key, 1, length(bronze_prefix)) = bronze_prefix")
    placed = written.withColumnRenamed("upath", "w_upath").join(targets, (F.col("w_upath") == F.col("upath")) & of_key).drop("w_upath")
    done = placed.groupBy("upath", "bronze_prefix").agg(
        F.count_if(F.col("error").isNull()).alias("file_count"),
        F.sum(F.when(F.col("error").isNull(), F.col("size_bytes"))).alias("total_bytes"),
        F.min("error").alias("write_error"),
    )
    unlisted = listing.where("error is not null").groupBy("upath").agg(F.min("error").alias("list_error"))
    outcome = (
        archives.join(done, ["upath", "bronze_prefix"], "left")
        .join(unlisted, "upath", "left")
        .withColumn("error", F.coalesce("list_error", "write_error"))
        .withColumn("file_count", F.coalesce("file_count", F.lit(0)))
        .withColumn("total_bytes", F.coalesce("total_bytes", F.lit(0)).cast("long"))
        .withColumn("manifest_key", F.concat("bronze_prefix", F.lit(K.MANIFEST_NAME)))
    )
    good = outcome.where("error is null")
    named = good.withColumnRenamed("error", "drop_error").join(
        placed.select("upath", "bronze_prefix", "pos", "key", "size_bytes", "crc32"), ["upath", "bronze_prefix"], "left"
    )
    named = named.withColumn("source", F.col("upath")).withColumn("content_type", K.content_type("key"))
    # the work here is a file per drop, not the few bytes of its rows
    files = spread(named.where("key is not null").select(*MANIFEST_FILES.fieldNames(), (F.col("pos") / FILE_ROWS).cast("long").alias("_part")), [*S.DROP_PARTITION, "_part"])
    tbl.stage(files.drop("_part"), layout.manifests, S.DROP_PARTITION, laid_out=True)
    stamped = named.withColumn("completed_at", F.date_format(_now(spark), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    latest = stamped.withColumn("ingest_date", F.col("ingest_date").cast("string"))
    bronze.write_manifest_documents(latest, layout.bronze).count()  # every document is written before any drop is DONE
    final = _status(
        spark,
        outcome,
        F.when(F.col("error").isNull(), F.lit("DONE")).otherwise(F.lit("FAILED")),
        manifest_key=F.when(F.col("error").isNull(), F.col("manifest_key")),
        file_count=F.col("file_count"),
        error=K.truncate_error("error", K.LEDGER_ERROR_MAX_CHARS),
        **prefix,
    )
    _record(spark, layout, final)

    # loose objects: fetched by key on the executors, copied under dataset=loose
    loose = routed.where(F.col("action") == "copy").select("drop_id", "bronze_key", src_key.alias("key"))
    copied = bronze.copy_objects(loose, layout.landing, layout.bronze)
    ok = F.col("error").isNull()
    outcomes = _status(
        spark,
        copied,
        F.when(ok, F.lit("DONE")).otherwise(F.lit("FAILED")),
        bronze_key=F.when(ok, F.col("bronze_key")),
        file_count=F.when(ok, F.lit(1)).otherwise(F.lit(0)),
        error=K.truncate_error("error", K.LEDGER_ERROR_MAX_CHARS),
    )
    _record(spark, layout, outcomes)


def silver_job(spark: SparkSession, layout: Layout, files: DataFrame) -> DataFrame:
    """Profile the images and normalise the annotation documents listed in manifest rows
    ``files``; results go to staging.  Returns the routing of each drop."""
    routing = M.silver_routing(files, "drop_id", "key")
    # a key that several deliveries list is one object
    listed = files.where(K.is_image_key("key")).select("key", *S.DROP_PARTITION).distinct()
    meta_path = scratch_path(spark, "image-metadata")
    I.stored_image_metadata(listed, layout.bronze).write.parquet(meta_path)  # objects are read once: two writes follow
    meta = spark.read.schema(S.IMAGE_METADATA).parquet(meta_path)
    tbl.stage(meta, layout.staging("image_metadata"), S.DROP_PARTITION)
    write_thumbnails(spark, layout, meta)
    ann_files = files.select(
        F.concat(F.lit(layout.bronze.rstrip("/") + "/"), "key").alias("path"), *S.DROP_PARTITION
    ).distinct()
    for table, df in A.normalize(spark, ann_files).items():
        tbl.stage(df, layout.staging(table), S.SLICE_PARTITION)
    return routing


def write_thumbnails(spark: SparkSession, layout: Layout, meta: DataFrame) -> int:
    """Thumbnails of the profiled images that had no error, decoded by Spark's image
    source from the drops' bronze folders, stored as a table keyed by thumbnail_key.  An image that
    the decoder does not read is a row with an error and no content, never a missing row."""
    ok = meta.where(F.col("thumbnail_key").isNotNull())
    prefixes = [r[0] for r in ok.select(K.hive_prefix("partner", "dataset", "ingest_date")).distinct().collect()]
    if not prefixes:
        return 0
    paths = [f"{layout.bronze.rstrip('/')}/{p}" for p in prefixes]  # one folder per drop
    images = (
        spark.read.format("image")
        .option("dropInvalid", True)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", K.IMAGE_GLOB)
        .load(paths)
    )
    th = I.thumbnails(images, ok.count()).select(
        K.key_below("origin", layout.bronze).alias("bronze_key"),
        F.col("width").alias("thumb_width"),
        F.col("height").alias("thumb_height"),
        "content",
    )
    out = ok.select("bronze_key", "thumbnail_key", "partner", "dataset", "ingest_date").join(th, "bronze_key", "left")
    out = out.withColumn("error", F.when(F.col("content").isNull(), F.lit("not decodable by the image source")))
    return tbl.stage(out, layout.thumbnails, S.DROP_PARTITION)


def missing_thumbnails(meta: DataFrame, thumbnails: DataFrame) -> DataFrame:
    """(bronze_key, thumbnail_key, reason) of images whose metadata names a thumbnail that the thumbnail table has
    no picture of."""
    stored = thumbnails.select("bronze_key", F.col("content").isNotNull().alias("made"), F.col("error").alias("reason"))
    named = meta.where(F.col("thumbnail_key").isNotNull()).select("bronze_key", "thumbnail_key")
    lacking = named.join(stored, "bronze_key", "left").where(~F.coalesce("made", F.lit(False)))
    return lacking.select("bronze_key", "thumbnail_key", F.coalesce("reason", F.lit("no row")).alias("reason"))


def silver_build(spark: SparkSession, layout: Layout, ingest_date: str | None = None, buckets: int = tbl.MERGE_BUCKETS) -> dict[str, int]:
    """Staging -> silver tables: create on first run (image_metadata bucketed by its key), MERGE image_metadata
    on bronze_key, replace the staged partitions of the annotation tables.  Returns the tables' row
    counts, from what the writes observed."""
    counts: dict[str, int] = {}
    for table, (parts, merge_key, schema) in S.SILVER_TABLES.items():
        staged = tbl.read_table(spark, layout.staging(table), schema, ingest_date=ingest_date)
        if staged is None:
            continue  # no staging data for this table
        target = layout.silver(table)
        if not tbl.path_exists(spark, target):
            tbl.create(spark, staged, target, parts, table, merge_key, buckets, laid_out=True)
        elif merge_key:
            tbl.upsert_into(spark, staged, target, merge_key, parts, table, schema)
        else:
            tbl.overwrite_partitions(spark, staged, target, parts, table, laid_out=True)
        counts[table] = tbl.table_rows(spark, target)
    return counts


def gold_build_slices(spark: SparkSession, layout: Layout, slices: DataFrame) -> dict[str, int]:
    """Gold products of many slices in one run: ``slices`` (partner, images_dataset, annotations_dataset, split,
    ingest_date) are written as a small table, the silver tables are read for its partitions alone
    (pruned at run time), and the gold partitions the slices produce are replaced."""
    def silver(t):
        return tbl.read_table(spark, layout.silver(t), S.SILVER_TABLES[t][2])

    wanted = gold.slice_table(slices, scratch_path(spark, "gold-slices"))
    ann, cat, img = (gold.scan_slices(silver(t), wanted) for t in ("coco_annotations", "coco_categories", "coco_images"))
    meta = gold.scan_slices(silver("image_metadata"), wanted, "images_dataset", with_split=False)
    products = {
        "category_stats": gold.category_stats_of(ann, cat, wanted),
        "ml_manifest": gold.ml_manifest_of(img, meta, ann, cat, wanted),
    }
    return {t: tbl.overwrite_partitions(spark, df, layout.gold(t), S.DROP_PARTITION, t) for t, df in products.items()}


def gold_build(
    spark: SparkSession,
    layout: Layout,
    partner: str,
    images_dataset: str,
    annotations_dataset: str,
    split: str,
    ingest_date: str,
    mode: str = "replace",
) -> dict[str, int]:
    """One slice -> category_stats and ml_manifest.  ``mode="replace"`` replaces each gold
    table whole (building one partner removes the others' rows, as the original does);
    ``mode="partitions"`` replaces only the partitions this slice produces."""
    write = tbl.replace if mode == "replace" else tbl.overwrite_partitions
    def silver(t):
        return tbl.read_table(spark, layout.silver(t), S.SILVER_TABLES[t][2])

    # both products scan the annotation slice: each reads its own few columns, which costs less than
    # building a cache of the slice
    ann = gold.scan_slice(silver("coco_annotations"), partner, annotations_dataset, ingest_date, split)
    cat = gold.scan_slice(silver("coco_categories"), partner, annotations_dataset, ingest_date, split)
    img = gold.scan_slice(silver("coco_images"), partner, annotations_dataset, ingest_date, split)
    meta = gold.scan_slice(silver("image_metadata"), partner, images_dataset, ingest_date)
    out = {}
    out["category_stats"] = write(
        spark, gold.category_stats(ann, cat, images_dataset), layout.gold("category_stats"), S.DROP_PARTITION, "category_stats"
    )
    out["ml_manifest"] = write(
        spark, gold.ml_manifest(img, meta, ann, cat), layout.gold("ml_manifest"), S.DROP_PARTITION, "ml_manifest"
    )
    return out
