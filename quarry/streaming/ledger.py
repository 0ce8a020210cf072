"""Exactly-once drop registration over at-least-once object-created events.

``readStream`` (file source of event records) -> ``foreachBatch``:
  malformed events to the quarantine table -> normalise -> keep the first event per drop id
  within the batch -> anti-join against the batch's buckets of the ledger -> write the new rows
  into the ledger partitions ``bucket=<hash of the drop id>/batch_id=<id>``.

Replays are safe: only rows that the ledger lacks are appended, so a batch that is run again, after a
failure at any point, neither duplicates nor drops drops (one writer at a time).  The seen-id state is the ledger table itself: durable
and unbounded like the reference's key-value table, with no state-store memory.  (For a
bounded-state variant, ``dropDuplicatesWithinWatermark`` on the drop id does the same
within a watermark.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry import schemas as S
from quarry.operators import drop_state, landing
from quarry.operators import tables as tbl
from quarry.operators.drop_state import buckets_of
from quarry.session import scratch_path

LEDGER_TABLE = S.struct(*[(f.name, f.dataType) for f in S.LEDGER.fields], ("bucket", S.T.IntegerType()), ("batch_id", S.L))
PARTITION = ["bucket", "batch_id"]
QUARANTINE = S.struct(("reason", S.S), ("record", S.S), ("batch_id", S.L))


def quarantine_path(ledger_path: str) -> str:
    return ledger_path.rstrip("/") + "-quarantine"


def unseen(spark: SparkSession, ledger_path: str, candidates: DataFrame) -> DataFrame:
    """Rows of ``candidates`` (drop_id, bucket; one per drop) that the ledger lacks.  Only the candidates'
    buckets of the ledger are read: at most ``LEDGER_BUCKETS`` numbers, as a partition filter."""
    ledger = tbl.read_table(spark, ledger_path, LEDGER_TABLE)
    if ledger is None:
        return candidates
    own = F.col("bucket").isin(*(buckets_of(candidates) or [-1]))
    return landing.insert_if_absent(ledger.where(own), candidates)


def register_batch(
    spark: SparkSession, events: DataFrame, batch_id: int, ledger_path: str, seq: str | None = None, state_path: str | None = None
) -> int:
    """Register the drops of one micro-batch of raw events; returns rows added.

    Events that are malformed go to the quarantine table beside the ledger (a partition per batch,
    replaced by a replay); the others are registered.  With ``state_path`` the new drops also enter the
    state table, before the ledger: a batch that fails between the two is found unregistered.  The ledger
    itself says what is new and gets only that, so a batch run again, even under another id (a stream
    whose checkpoint was lost), registers what is missing and nothing twice."""
    copy = scratch_path(spark, "events")
    events.write.parquet(copy)  # read once from the source: three writes follow
    sound, rejected = landing.split_malformed(spark.read.schema(events.schema).parquet(copy))
    tbl.stage(rejected.withColumn("batch_id", F.lit(batch_id).cast("long")), quarantine_path(ledger_path), ["batch_id"])
    first_path, new_path = scratch_path(spark, "first-seen"), scratch_path(spark, "new-drops")
    first = landing.first_seen(landing.normalize_events(sound, seq)).withColumn("bucket", landing.ledger_bucket("drop_id"))
    first.withColumn("batch_id", F.lit(batch_id).cast("long")).select(*LEDGER_TABLE.fieldNames()).write.parquet(first_path)
    first = spark.read.schema(LEDGER_TABLE).parquet(first_path)
    unseen(spark, ledger_path, first).select(*LEDGER_TABLE.fieldNames()).write.parquet(new_path)
    new = spark.read.schema(LEDGER_TABLE).parquet(new_path)
    if state_path is not None:
        drop_state.update(spark, state_path, drop_state.registered(new))
    return tbl.append(new, ledger_path, PARTITION)


#: Batch registrations take ids from here on, apart from those of streams, which count from 0.
FIRST_BATCH_RUN = 1 << 40


def fresh_batch_id(spark: SparkSession, ledger_path: str) -> int:
    """An id that no registration has used: one above the largest of earlier batch runs.  Two
    runs at once must be given ids of their own."""
    ledger = tbl.read_table(spark, ledger_path, LEDGER_TABLE)
    used = ledger.agg(F.max("batch_id")).first()[0] if ledger is not None else None
    return max(FIRST_BATCH_RUN, (used if used is not None else -1) + 1)


def event_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None, extra=()) -> DataFrame:
    """Object-created events as a stream of JSON files (explicit schema, no inference); a line
    that does not parse comes as it is, in the column ``landing.CORRUPT``."""
    reader = spark.readStream.schema(event_schema(extra)).option("columnNameOfCorruptRecord", landing.CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source_dir)


def event_schema(extra=()) -> S.T.StructType:
    more = [S.T.StructField(name, dtype) for name, dtype in extra]
    return S.T.StructType([*S.LANDING_EVENT.fields, *more, S.T.StructField(landing.CORRUPT, S.S)])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The same records as a batch."""
    return spark.read.schema(event_schema()).option("columnNameOfCorruptRecord", landing.CORRUPT).json(path)


def start_ledger_stream(
    spark: SparkSession,
    source_dir: str,
    ledger_path: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    seq: str | None = None,
    extra=(),
    state_path: str | None = None,
) -> StreamingQuery:
    events = event_stream(spark, source_dir, max_files_per_trigger, extra)
    writer = events.writeStream.foreachBatch(
        lambda df, bid: register_batch(spark, df, bid, ledger_path, seq, state_path)
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def dedup_within_watermark(events: DataFrame, delay: str, seq: str | None = None) -> DataFrame:
    """Bounded-state registration: a streaming ``dropDuplicatesWithinWatermark`` on the
    drop id.  A replay arriving within ``delay`` of the first copy is dropped; state for a
    drop id expires with the watermark, so memory stays bounded (replays later than
    ``delay`` would register again, and events that come later than ``delay`` behind the newest
    are dropped by the watermark and never registered: use the ledger form above where every
    event must be registered)."""
    sound = events.where(landing.event_problem(events).isNull())  # malformed events have no drop id
    objs = landing.normalize_events(sound, seq).withColumn(
        "event_ts", F.to_timestamp("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return objs.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["drop_id"])


COMPACTED_BATCH = -1


def compact_ledger(spark: SparkSession, ledger_path: str, keep_last: int = 16) -> int:
    """Fold every batch except the newest ``keep_last`` into ``batch_id=-1``, one row per drop id (the earliest), bucket by bucket in
    one job.  The new partitions are swapped in before the old folders go; a crash between the two leaves
    duplicates that the next compaction removes.  Returns the rows in the compacted partitions."""
    led = tbl.read_table(spark, ledger_path, LEDGER_TABLE)
    if led is None:
        return 0
    parts = [(r.bucket, r.batch_id) for r in led.select(*PARTITION).distinct().collect()]  # one row per partition
    batches = sorted({b for _, b in parts if b != COMPACTED_BATCH})
    old = set(batches[:-keep_last] if keep_last else batches)
    if not old:
        return 0
    part = led.where(F.col("batch_id").isin(*old, COMPACTED_BATCH))
    first = F.min(F.struct("received_at", *[c for c in landing.LEDGER_COLUMNS if c not in ("drop_id", "received_at")]))
    folded = (
        part.groupBy("drop_id", "bucket")
        .agg(first.alias("f"))
        .select("drop_id", "f.*", "bucket")
        .select(*landing.LEDGER_COLUMNS, "bucket")
        .withColumn("batch_id", F.lit(COMPACTED_BATCH).cast("long"))
    )
    n = tbl.stage(folded, ledger_path, PARTITION)
    tbl.drop_partitions(spark, ledger_path, PARTITION, [{"bucket": k, "batch_id": b} for k, b in parts if b in old])
    return n
