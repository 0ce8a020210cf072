import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm.shared import BATCH_BYTES, connected_components, rank_within, small_batches


def union_find(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(700)],
        "star": [(500, i) for i in range(400)] + [(1000, 1001)],
        "random": [(rnd.randrange(500), rnd.randrange(500)) for _ in range(240)],
        "none": [],
    }[shape]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == union_find([(a, b) for a, b in edges if a != b])


def test_rank_within_a_hot_key(spark):
    rows = [(0 if i % 3 else i, i, 7) for i in range(900)] + [(0, 5, 7)] * 4
    ranked = rank_within(spark.createDataFrame(rows, "k long, id long, n long"), "k", ["id", "n"], buckets=8).collect()
    by_key = {}
    for r in ranked:
        by_key.setdefault(r.k, []).append(r["rank"])
    assert len(ranked) == len(rows) and all(sorted(v) == list(range(len(v))) for v in by_key.values())


SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def batch_sizes(spark, n, size):
    """Rows and bytes of the Arrow batches in which ``n`` texts of ``size`` characters reach a Python stage."""

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64()), "size": pa.array([batch.nbytes], pa.int64())})

    rows = spark.range(0, n, 1, 1).select("id", F.rpad(F.col("id").cast("string"), size, "x").alias("text"))
    return [tuple(r) for r in rows.mapInArrow(measure, "n long, size long").collect()]


def test_small_batches(spark):
    own = spark.newSession()  # its settings are its own
    own.conf.set(SETTING, str(64 << 20))
    assert max(b for _, b in batch_sizes(own, 9_000, 2_000)) > 3 * BATCH_BYTES
    small_batches(own)
    found = batch_sizes(own, 9_000, 2_000)
    assert sum(n for n, _ in found) == 9_000 and max(b for _, b in found) < 1.5 * BATCH_BYTES
    # a text above the bound comes alone, and whole
    found = batch_sizes(own, 3, 2 * BATCH_BYTES)
    assert [n for n, _ in found] == [1, 1, 1] and min(b for _, b in found) >= 2 * BATCH_BYTES
    for given, kept in (("100000", "100000"), ("1m", "1m"), ("2MB", "2MB"), ("5m", None), ("1g", None), ("67108864b", None)):
        own.conf.set(SETTING, given)
        small_batches(own)
        assert own.conf.get(SETTING) == (kept or str(BATCH_BYTES))
