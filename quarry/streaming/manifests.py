"""Manifest-triggered silver work (batch-complete trigger).

A stream over the manifest documents that the bronze job leaves in the drop folders: one document is
one file and one row, so a drop, however large, is always whole within a micro-batch.  Every micro-batch
  1. puts documents that are malformed into a quarantine table, with the reason,
  2. ledgers each manifest once as ``silver#<manifest key>`` (one that is rewritten is skipped),
  3. routes the new manifests (profile if images, normalise if annotation documents,
     NOOP if neither),
  4. runs the silver job for the new manifests' files.
The ledger gets its rows last, so a batch that fails on the way does its work again; what is ledgered is
never worked on twice, whatever becomes of the stream's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry import jobs
from quarry import schemas as S
from quarry.functions import keys as K
from quarry.operators import landing
from quarry.operators import tables as tbl
from quarry.session import listing_session, scratch_path
from quarry.streaming.ledger import LEDGER_TABLE, PARTITION, quarantine_path, unseen

FILE = S.struct(("key", S.S), ("size_bytes", S.L), ("crc32", S.L), ("content_type", S.S))
DOCUMENT = S.T.StructType([*S.MANIFEST_HEADER.fields, S.T.StructField("files", S.T.ArrayType(FILE)), S.T.StructField(landing.CORRUPT, S.S)])


def document_problem() -> Column:
    """Why a manifest cannot be worked on, null for a sound one."""
    lacks = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return (
        F.when(F.col(landing.CORRUPT).isNotNull(), F.lit("not the JSON of a manifest"))
        .when(lacks("partner") | lacks("dataset"), F.lit("no partner or dataset"))
        .when(F.col("ingest_date").try_cast("date").isNull(), F.lit("no ingest date"))
        .when(F.col("files").isNull(), F.lit("no file list"))
        .when(F.exists("files", lambda f: f["key"].isNull()), F.lit("a file without key"))
    )


def routing(documents: DataFrame) -> DataFrame:
    """Adds n_files, n_images, n_coco_json and the status of each manifest, from its own list."""
    count = lambda test: F.size(F.filter("files", lambda f: test(f["key"])))
    counted = documents.withColumns({"n_files": F.size("files"), "n_images": count(K.is_image_key), "n_coco_json": count(K.is_coco_json)})
    work = (F.col("n_images") > 0) | (F.col("n_coco_json") > 0)
    return counted.withColumn("status", F.when(work, F.lit("SUBMITTED")).otherwise(F.lit("NOOP")))


def run_batch(spark: SparkSession, layout: jobs.Layout, documents: DataFrame, batch_id: int) -> int:
    """One micro-batch of manifest documents (``DOCUMENT`` and path); the number of manifests ledgered."""
    copy = scratch_path(spark, "manifests")
    documents.withColumn("_problem", document_problem()).write.parquet(copy)  # parsed once
    documents = spark.read.schema(documents.schema.add("_problem", S.S)).parquet(copy)
    bad = documents.where("_problem is not null").select(F.col("_problem").alias("reason"), F.col("path").alias("record"))
    tbl.stage(bad.withColumn("batch_id", F.lit(batch_id).cast("long")), quarantine_path(layout.silver_ledger), ["batch_id"])
    sound = routing(documents.where("_problem is null")).withColumn("manifest_key", K.key_below("path", layout.bronze))
    rows = sound.select(
        F.concat(F.lit("silver#"), "manifest_key").alias("drop_id"),
        "partner",
        F.lit("bronze").alias("src_bucket"),
        F.col("manifest_key").alias("src_key"),
        F.lit(None).cast("long").alias("size_bytes"),
        "ingest_date",
        "status",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("received_at"),
    )
    rows = rows.withColumn("bucket", landing.ledger_bucket("drop_id")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    new_path = scratch_path(spark, "new-manifests")
    unseen(spark, layout.silver_ledger, rows).select(*LEDGER_TABLE.fieldNames()).write.parquet(new_path)
    new = spark.read.schema(LEDGER_TABLE).parquet(new_path)
    todo = sound.join(new.where("status <> 'NOOP'").select(F.col("src_key").alias("manifest_key")), "manifest_key", "left_semi")
    if not todo.isEmpty():
        files = todo.select("drop_id", *S.DROP_PARTITION[:2], F.col("ingest_date").cast("date").alias("ingest_date"), "source", F.posexplode("files").alias("pos", "f"))
        jobs.silver_job(spark, layout, files.select("*", "f.*").drop("f"))
    return tbl.append(new, layout.silver_ledger, PARTITION)


def document_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The manifest documents of the drop folders of ``root`` as a stream, a row each, with the path; a file that is no
    JSON comes as it is in the column ``landing.CORRUPT``.  Documents are found by their place
    (``keys.manifest_glob``), so the drops' own objects are never listed and the driver gets documents alone."""
    reader = (
        spark.readStream.schema(DOCUMENT)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", landing.CORRUPT)
        .option("recursiveFileLookup", True)  # no columns from the folder names
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return reader.json(K.manifest_glob(root)).withColumn("path", path)


def start_silver_stream(
    spark: SparkSession,
    layout: jobs.Layout,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Silver work for every manifest document below ``layout.bronze``, ``max_files_per_trigger`` documents at a time."""
    stream = document_stream(listing_session(spark), layout.bronze, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(lambda df, bid: run_batch(spark, layout, df, bid)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
