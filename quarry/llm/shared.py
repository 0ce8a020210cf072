"""Helpers several operators use: null-safe text, written intermediate tables, ranks
within skewed groups, connected components, and byte-bounded Arrow slices."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir, scratch_path, ship_code

#: Python stages work on slices of about this many bytes of text at a time.
SLICE_BYTES = 2 << 20
#: Rows cross into the Python stages of whole texts in Arrow batches of about this many bytes at most.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_of(name: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back: cuts the
    lineage, so that lost executors re-read files instead of repeating the stages before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Removes tables made by ``written`` that nothing will read again."""
    for table in tables:
        path = getattr(table, "scratch", None)
        if path is not None:
            jvm = table.sparkSession.sparkContext._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prepare(spark: SparkSession) -> None:
    """Before a Python stage: the package on the executors, the checkpoint folder set."""
    checkpoint_dir(spark)
    ship_code(spark)


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by ``BATCH_BYTES``, unless its own bound is lower.  A task's batch stands several
    times over, in the JVM's writer and reader and in the worker, and none of them gives that memory back while the
    application lasts.  The setting stays: a frame is planned when its caller runs it, after the operator is done."""
    given = re.fullmatch(r"(\d+) *([kmg]?)i?b?", spark.conf.get(_BATCH_SETTING).strip().lower())
    if not given or not 0 < int(given[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[given[2]] <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def rank_within(df: DataFrame, key: str, order: list[str], out: str = "rank", buckets: int | None = None) -> DataFrame:
    """Adds ``out``: a 0-based gapless rank of each row within its ``key`` (no nulls in it).

    A key may hold any share of the rows: rows are dealt to buckets by a hash of the
    ``order`` columns, ranked within (key, bucket), and shifted by the counts of the
    buckets before, so no task ever gets a whole key.  Rows equal in all ``order``
    columns take neighbouring ranks in any order."""
    n = buckets or min(max(8, shuffle_partitions(df.sparkSession)), 2000)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    counts = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        F.col(key).alias("_key"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    joined = dealt.join(base, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_b")))
    own = Window.partitionBy(key, "_bucket").orderBy(*order)
    return joined.withColumn(out, F.col("_base") + F.row_number().over(own) - 1).drop("_bucket", "_key", "_b", "_base")


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b): the component
    is its smallest node.

    Each round contracts the graph: in an order drawn for the round every node points at its
    first neighbour, if that comes before itself, pointers are followed once more, and edges are
    rewritten to the nodes pointed at.  A drawn order leaves about half the nodes or fewer
    each round whatever the graph's shape, long chains included.  Only min-aggregates (combined
    before the shuffle) and equi-joins that adaptive execution can split are used, so hubs of
    any degree are fine.  Every round is written to the shared folder; the driver only sees
    whether edges are left."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = written(both.where("a <> b").distinct(), "cc-edges")
    labels = None
    for round_ in range(max_rounds):
        place = lambda c: F.xxhash64(c, F.lit(round_))  # noqa: B023, E731
        first = live.groupBy("a").agg(F.min_by("b", place("b")).alias("b"))
        points = first.select(F.col("a").alias("node"), F.when(place("b") < place("a"), F.col("b")).otherwise(F.col("a")).alias("to"))
        hop = points.select(F.col("node").alias("to"), F.col("to").alias("to2"))
        step = written(points.join(hop, "to").select("node", F.col("to2").alias("to")), "cc-step")
        if labels is None:
            newer = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), F.col("to").alias("_to"))
            newer = labels.join(moved, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
        newer = written(newer, "cc-labels")
        ends = step.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        other = step.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        rewritten = live.join(ends, "a").join(other, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        left = written(rewritten.where("a <> b").distinct(), "cc-edges")
        discard(labels, live, step)  # what this round replaces
        labels, live = newer, left
        if live.isEmpty():
            least = labels.groupBy("component").agg(F.min("node").alias("least"))
            settled = written(labels.join(least, "component").select("node", F.col("least").alias("component")), "components")
            discard(labels, live)
            return settled
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def map_text(df: DataFrame, schema: str, per_slice: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text") -> DataFrame:
    """``mapInArrow`` over byte-bounded slices; ``per_slice`` gets and returns one batch."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, column):
            yield per_slice(batch)

    return df.mapInArrow(run, schema)
