"""Streaming registration of landing events (S8, R1) on the events stand-in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import tables as tbl
from quarry.plans.landing_queries import SQL_LANDING, landing_events
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.streaming import ledger as ledger_stream


@register(
    "landing_events_stream",
    "S8 R1 K10",
    f"""
WITH {SQL_LANDING}
SELECT DISTINCT drop_id, partner, src_bucket, src_key, size_bytes FROM drops
""",
)
def landing_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land as JSON files; an available-now stream registers them batch by batch
    (two files per trigger), and the ledger is read back.  Which replay of a drop is kept
    depends on batch order, so only drop-determined columns are returned."""
    src = scratch_path(spark, "landing")
    landing_events(spark, sf_dir).select("event_id", "detail", "time").repartition(8).write.json(src)
    ledger_path = scratch_path(spark, "ledger")
    q = ledger_stream.start_ledger_stream(
        spark,
        src,
        ledger_path,
        scratch_path(spark, "ledger-ckpt"),
        max_files_per_trigger=2,
        seq="event_id",
        extra=[("event_id", S.L)],
    )
    q.awaitTermination()
    out = tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE)
    return out.select("drop_id", "partner", "src_bucket", "src_key", F.col("size_bytes"))


@register(
    "landing_dedup_watermark",
    "R1 (bounded state)",
    f"""
WITH {SQL_LANDING}
SELECT DISTINCT drop_id, partner, src_bucket, src_key, size_bytes FROM drops
""",
)
def landing_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stream through ``dropDuplicatesWithinWatermark`` (31-day delay: the stand-in
    spans 30 days, so every replay falls inside it) into a parquet sink; read back."""
    src = scratch_path(spark, "landing-wm")
    landing_events(spark, sf_dir).select("event_id", "detail", "time").repartition(8).write.json(src)
    out = scratch_path(spark, "dedup-wm")
    stream = ledger_stream.event_stream(spark, src, max_files_per_trigger=2, extra=[("event_id", S.L)])
    deduped = ledger_stream.dedup_within_watermark(stream, "31 days", seq="event_id")
    q = (
        deduped.select("drop_id", "partner", "src_bucket", "src_key", "size_bytes")
        .writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "dedup-wm-ck"))
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    return spark.read.schema("drop_id string, partner string, src_bucket string, src_key string, size_bytes long").parquet(out)


# Lines that no event can be made of, derived from the same rows: a broken line, one without a key, one
# without a bucket, one without a date, a number where the size belongs to be text.
DAMAGE = (
    ("cut off", "not the JSON of an event"),
    ("no key", "no object key"),
    ("no bucket", "no bucket name"),
    ("no date", "time without a date"),
    ("wrong type", "not the JSON of an event"),
)


@register(
    "landing_events_malformed",
    "S8 R1 K10 (quarantine)",
    f"""
WITH {SQL_LANDING}
SELECT 'registered' AS outcome, partner || '#' || src_key || '#' || etag AS what, CAST(1 AS BIGINT) AS n
FROM (SELECT DISTINCT partner, src_key, etag FROM drops WHERE event_id % 10 >= {len(DAMAGE)})
UNION ALL
SELECT 'rejected', CASE event_id % 10 {" ".join(f"WHEN {i} THEN '{reason}'" for i, (_, reason) in enumerate(DAMAGE))} END, count(*)
FROM drops WHERE event_id % 10 < {len(DAMAGE)} GROUP BY 2
""",
)
def landing_events_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events are damaged as they land, in five ways; the stream registers the sound ones and
    puts the others, line by line, into the quarantine table with the reason."""
    e = landing_events(spark, sf_dir)
    kind = F.col("event_id") % 10
    line = F.to_json(F.struct("event_id", "detail", "time"))
    no_key = F.struct(F.col("detail.bucket"), F.struct(F.col("detail.object.size"), F.col("detail.object.etag")).alias("object")).alias("detail")
    no_bucket = F.struct(F.col("detail.object")).alias("detail")
    damaged = (
        F.when(kind == 0, F.substr(line, F.lit(1), F.length(line) - 9))
        .when(kind == 1, F.to_json(F.struct("event_id", no_key, "time")))
        .when(kind == 2, F.to_json(F.struct("event_id", no_bucket, "time")))
        .when(kind == 3, F.to_json(F.struct("event_id", "detail", F.lit("yesterday").alias("time"))))
        .when(kind == 4, F.regexp_replace(line, '"object":\\{', '"object":{"size":"big",'))
        .otherwise(line)
    )
    src = scratch_path(spark, "landing-damaged")
    e.select(damaged.alias("value")).repartition(8).write.text(src)
    ledger_path = scratch_path(spark, "ledger")
    q = ledger_stream.start_ledger_stream(
        spark, src, ledger_path, scratch_path(spark, "ledger-ckpt"), max_files_per_trigger=4, seq="event_id", extra=[("event_id", S.L)]
    )
    q.awaitTermination()
    led = tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE)
    bad = tbl.read_table(spark, ledger_stream.quarantine_path(ledger_path), ledger_stream.QUARANTINE)
    registered = led.select(F.lit("registered").alias("outcome"), F.col("drop_id").alias("what"), F.lit(1).cast("long").alias("n"))
    rejected = bad.groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return registered.unionByName(rejected.select(F.lit("rejected").alias("outcome"), "what", "n"))


@register(
    "drop_state_incremental",
    "A6 R3 K11 (state kept per batch)",
    f"""
WITH {SQL_LANDING},
st AS (
  SELECT drop_id, ts, CASE WHEN value < 20 THEN 'RECEIVED' WHEN value < 40 THEN 'SUBMITTED' WHEN value < 60 THEN 'UNPACKING'
                           WHEN value < 80 THEN 'DONE' ELSE 'FAILED' END AS status,
         CASE WHEN value >= 60 AND value < 80 THEN 'm-' || CAST(event_id AS VARCHAR) END AS manifest_key
  FROM drops),
ranked AS (SELECT *, CASE status WHEN 'RECEIVED' THEN 0 WHEN 'SUBMITTED' THEN 1 WHEN 'UNPACKING' THEN 2 ELSE 3 END AS r FROM st)
SELECT drop_id, arg_max(status, (r, ts, status)) AS status, arg_max(ts, (r, ts, status)) AS updated_at,
       arg_max(manifest_key, (r, ts, manifest_key)) FILTER (WHERE manifest_key IS NOT NULL) AS manifest_key,
       max(r) < 3 AS still_open
FROM ranked GROUP BY drop_id
""",
)
def drop_state_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events of the drops (out of order, many late) folded into the state table in four batches, dealt
    by a hash; the current state is read back, with whether the drop is among the open ones."""
    from quarry.operators import drop_state, landing
    from quarry.plans.landing_queries import STATUS_BANDS

    o = landing.normalize_events(landing_events(spark, sf_dir), seq="event_id", keep=("ts", "value"))
    status = F.lit("FAILED")
    for bound, name in reversed(STATUS_BANDS):
        status = F.when(F.col("value") < bound, F.lit(name)).otherwise(status)
    done = (F.col("value") >= 60) & (F.col("value") < 80)
    key = F.when(done, F.concat(F.lit("m-"), F.col("event_seq").cast("string")))
    events = o.select("drop_id", status.alias("status"), F.col("ts").cast("timestamp").alias("updated_at"), key.alias("manifest_key"), "event_seq")
    path = scratch_path(spark, "drop-state")
    for batch in range(4):
        drop_state.update(spark, path, events.where(F.pmod(F.xxhash64("event_seq"), F.lit(4)) == batch).drop("event_seq"))
    to_do = drop_state.open_drops(spark, path).select("drop_id", F.lit(True).alias("still_open"))
    now = drop_state.current(drop_state.stored(spark, path)).join(to_do, "drop_id", "left")
    return now.select("drop_id", "status", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), "manifest_key", F.coalesce("still_open", F.lit(False)).alias("still_open"))
