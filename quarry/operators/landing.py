"""Landing -> ledger -> route: what happens to each object dropped by a partner.

The reference records every object-created event once in a key-value ledger (conditional
put on ``partner#key#etag``), then either unpacks an archive or copies a loose object to
bronze.  Here the ledger is an append-only table of status events; a drop's current state
is its latest event, and registration is an anti-join of new drop ids against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import keys as K

# Ledger statuses and their order; a terminal status is never hidden by a
# late earlier one (a SUBMITTED written after DONE stays below it).
STATUS_RANK = {"RECEIVED": 0, "SUBMITTED": 1, "UNPACKING": 2, "DONE": 3, "FAILED": 3, "NOOP": 3}

#: Ledger and state tables are cut into so many buckets by a hash of the drop id.
LEDGER_BUCKETS = 64
#: Column of a JSON source that holds a line it could not parse.
CORRUPT = "_corrupt_record"

LEDGER_COLUMNS = [
    "drop_id",
    "partner",
    "src_bucket",
    "src_key",
    "size_bytes",
    "ingest_date",
    "status",
    "received_at",
]


def ledger_bucket(drop_id: Column | str) -> Column:
    """The ledger partition of a drop id."""
    d = F.col(drop_id) if isinstance(drop_id, str) else drop_id
    return F.pmod(F.xxhash64(d), F.lit(LEDGER_BUCKETS)).cast("int")


def event_problem(events: DataFrame) -> Column:
    """Why an event cannot be registered, null for a sound one.  Bucket, key and a time that begins with a
    date are required; size and etag are not."""
    d = F.col("detail")
    lacks = lambda c: F.coalesce(c, F.lit("")) == ""
    problem = (
        F.when(lacks(d["bucket"]["name"]), F.lit("no bucket name"))
        .when(lacks(d["object"]["key"]), F.lit("no object key"))
        .when(lacks(F.col("time")), F.lit("no time"))
        .when(F.substring("time", 1, 10).try_cast("date").isNull() | ~F.col("time").rlike(r"^\d{4}-\d{2}-\d{2}"), F.lit("time without a date"))
    )
    if CORRUPT in events.columns:
        return F.when(F.col(CORRUPT).isNotNull(), F.lit("not the JSON of an event")).otherwise(problem)
    return problem


def split_malformed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound events, rejected ones as (reason, record)): the record is the line as it came, or the parsed
    parts of one that is JSON but lacks something."""
    marked = events.withColumn("_problem", event_problem(events))
    parsed = F.to_json(F.struct("detail", "time"))
    record = F.coalesce(F.col(CORRUPT), parsed) if CORRUPT in events.columns else parsed
    rejected = marked.where("_problem is not null").select(F.col("_problem").alias("reason"), record.alias("record"))
    return marked.where("_problem is null").drop("_problem"), rejected


def normalize_events(events: DataFrame, seq: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten object-created events (``detail.bucket.name``, ``detail.object.{key,size,
    etag}``, ``time``) and derive partner, ingest date and drop id.  A missing size counts
    as 0 and a missing etag as ''.  ``seq`` names an optional tie-break column kept as
    ``event_seq``; ``keep`` columns pass through unchanged."""
    d = F.col("detail")
    out = events.select(
        d["bucket"]["name"].alias("src_bucket"),
        d["object"]["key"].alias("src_key"),
        F.coalesce(d["object"]["size"], F.lit(0).cast("long")).alias("size_bytes"),
        F.coalesce(d["object"]["etag"], F.lit("")).alias("etag"),
        F.col("time").alias("event_time"),
        *([F.col(seq).alias("event_seq")] if seq else [F.lit(0).cast("long").alias("event_seq")]),
        *keep,
    )
    return out.withColumns(
        {
            "partner": K.partner_from_bucket("src_bucket"),
            "ingest_date": K.ingest_date_str("event_time"),
        }
    ).withColumn("drop_id", K.drop_id("partner", "src_key", "etag"))


def route(objects: DataFrame) -> DataFrame:
    """Route each (normalised) object: archives are unpacked into
    ``partner=/dataset=<archive stem>/ingest_date=/``, anything else is copied to
    ``partner=/dataset=loose/ingest_date=/<base name>``."""
    archive = K.is_archive_key("src_key")
    dataset = F.when(archive, K.path_stem("src_key")).otherwise(F.lit(K.LOOSE_DATASET))
    return objects.withColumns(
        {
            "action": F.when(archive, F.lit("unpack")).otherwise(F.lit("copy")),
            "dataset": dataset,
            "bronze_prefix": K.hive_prefix("partner", dataset, "ingest_date"),
        }
    ).withColumn(
        "bronze_key",
        F.when(~archive, K.loose_bronze_key("partner", "ingest_date", "src_key")),
    )


def first_seen(objects: DataFrame) -> DataFrame:
    """One ledger row per drop id: the earliest event (by time, then ``event_seq``).

    ``min`` over a struct is a partial (map-side) aggregate, so a drop id replayed
    millions of times still shuffles one row per map task.
    """
    first = F.min(
        F.struct("event_time", "event_seq", "partner", "src_bucket", "src_key", "size_bytes", "ingest_date")
    ).alias("f")
    return objects.groupBy("drop_id").agg(first).select(
        "drop_id",
        "f.partner",
        "f.src_bucket",
        "f.src_key",
        "f.size_bytes",
        "f.ingest_date",
        F.lit("RECEIVED").alias("status"),
        F.col("f.event_time").alias("received_at"),
    )


def insert_if_absent(ledger: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of ``candidates`` (one per drop id) whose drop id is not in ``ledger`` yet:
    the conditional put of the reference, for a whole batch at once.

    The ledger is first reduced to the batch's ids: a semi-join whose small side (the batch)
    is broadcast when its measured bytes allow it, so the ledger is scanned for one column and
    not shuffled.  The batch is then anti-joined against the few ids found."""
    seen = ledger.select("drop_id").join(candidates.select("drop_id"), "drop_id", "left_semi")
    return candidates.join(seen, "drop_id", "left_anti")


def status_rank(status: Column | str) -> Column:
    s = F.col(status) if isinstance(status, str) else status
    table = F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv])
    return F.coalesce(table[s], F.lit(-1))


def latest_status(status_events: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Current state per drop id from append-only status events: the status with the
    highest (rank, updated_at, *order) and, per attribute, its latest non-null value."""
    order = order or []
    key = F.struct(status_rank("status").alias("r"), "updated_at", *order)
    attrs = [c for c in status_events.columns if c not in {"drop_id", "status", "updated_at", *order}]
    aggs = [
        F.max_by("status", key).alias("status"),
        F.max_by("updated_at", key).alias("updated_at"),
        F.count(F.lit(1)).alias("n_events"),
    ]
    aggs += [F.max_by(c, F.when(F.col(c).isNotNull(), key)).alias(c) for c in attrs]
    return status_events.groupBy("drop_id").agg(*aggs)
