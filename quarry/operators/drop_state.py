"""Current state of every drop, kept up to date without reading its history.

The state table holds one row per drop: for each attribute the value that its latest event gave, with
the rank and time of that event, so that any later event, however late it comes, can be folded in by
a plain maximum.  Folding is associative and idempotent: events applied in any order, in any
batches, or twice, give the state that one aggregate over the whole history gives.

The table is partitioned by ``open`` (not in a final status) and by a hash bucket of the drop id.  An
update reads and replaces only the buckets its events fall into; what is still to do is read from
the open partitions alone, whatever the number of finished drops.  One writer at a time
may update a bucket; ``rebuild`` makes the table anew from ledger and history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import landing
from quarry.operators import tables as tbl
from quarry.session import scratch_path

FINAL = tuple(s for s, r in landing.STATUS_RANK.items() if r == max(landing.STATUS_RANK.values()))
ATTRIBUTES = {
    "status": S.S, "partner": S.S, "src_bucket": S.S, "src_key": S.S, "size_bytes": S.L, "ingest_date": S.S, "received_at": S.S,
    "bronze_key": S.S, "manifest_key": S.S, "file_count": S.L, "error": S.S, "bronze_prefix": S.S, "batch_job_id": S.S,
}
STATE = S.struct(
    ("drop_id", S.S),
    *[(name, S.struct(("r", S.T.IntegerType()), ("t", S.TS), ("v", kind))) for name, kind in ATTRIBUTES.items()],
    ("open", S.BOOL),
    ("bucket", S.T.IntegerType()),
)
PARTITION = ["open", "bucket"]


def as_state(events: DataFrame) -> DataFrame:
    """Status events (drop_id, status, updated_at, any attributes) in the shape of state rows."""
    rank = landing.status_rank("status").cast("int")

    def dated(name: str, kind) -> Column:
        if name not in events.columns:
            return F.lit(None).cast(STATE[name].dataType).alias(name)
        value = F.col(name).cast(kind)
        dated_value = F.struct(rank.alias("r"), F.col("updated_at").cast("timestamp").alias("t"), value.alias("v"))
        return F.when(value.isNotNull(), dated_value).cast(STATE[name].dataType).alias(name)

    return events.select("drop_id", *(dated(n, k) for n, k in ATTRIBUTES.items()), landing.ledger_bucket("drop_id").alias("bucket"))


def fold(states: DataFrame) -> DataFrame:
    """One row per drop: of each attribute the value with the highest (rank, time); combined map-side."""
    folded = states.groupBy("drop_id", "bucket").agg(*(F.max(n).alias(n) for n in ATTRIBUTES))
    still = ~F.coalesce(F.col("status.v").isin(*FINAL), F.lit(False))
    return folded.withColumn("open", still).select(*STATE.fieldNames())


def buckets_of(events: DataFrame) -> list[int]:
    """The buckets that ``events`` (bucket) fall into: at most ``landing.LEDGER_BUCKETS`` numbers."""
    return sorted(r.bucket for r in events.select("bucket").distinct().collect())


def stored(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The state table, of the given buckets only (a partition filter)."""
    state = tbl.read_table(spark, path, STATE)
    if state is None:
        return spark.createDataFrame([], STATE)
    return state if buckets is None else state.where(F.col("bucket").isin(*buckets) if buckets else F.lit(False))


def update(spark: SparkSession, path: str, events: DataFrame) -> int:
    """Folds status events into the table at ``path``; the number of rows in the buckets replaced.

    The new partitions are written beside the old ones and swapped in when all are complete
    (dynamic partition overwrite), so the files read stay until then.  A bucket whose last open drop became
    final loses its open partition after that; until then that drop is merely listed twice, and
    the fold of the next update keeps its final status."""
    copy = scratch_path(spark, "status-events")
    as_state(events).write.parquet(copy)
    new = spark.read.schema(S.T.StructType([f for f in STATE.fields if f.name != "open"])).parquet(copy)
    buckets = buckets_of(new)
    if not buckets:
        return 0
    old = stored(spark, path, buckets)
    seen = Observation()
    merged = fold(old.drop("open").unionByName(new)).observe(seen, F.collect_set(F.when(F.col("open"), F.col("bucket"))).alias("open"))
    rows = tbl.stage(merged, path, PARTITION)
    still_open = set(seen.get["open"])
    tbl.drop_partitions(spark, path, PARTITION, [{"open": "true", "bucket": b} for b in buckets if b not in still_open])
    return rows


def current(state: DataFrame) -> DataFrame:
    """drop_id, status, updated_at and every attribute as plain columns; one row per drop."""
    return state.select("drop_id", F.col("status.t").alias("updated_at"), *(F.col(f"{n}.v").alias(n) for n in ATTRIBUTES))


def open_drops(spark: SparkSession, path: str) -> DataFrame:
    """Drops without a final status: a scan of the open partitions, no history and no finished drops."""
    return current(stored(spark, path).where(F.col("open")))


def registered(drops: DataFrame) -> DataFrame:
    """Ledger rows as status events: RECEIVED at the time of the object's event."""
    return drops.withColumn("updated_at", F.try_to_timestamp("received_at"))


def rebuild(spark: SparkSession, path: str, ledger: DataFrame, history: DataFrame | None) -> int:
    """The table made anew from all registrations and status events."""
    states = as_state(registered(ledger))
    if history is not None:
        states = states.unionByName(as_state(history))
    return tbl.replace(spark, fold(states), path, PARTITION, "drop_state")
