"""Upsert / partition overwrite / create / replace semantics on path and catalog tables."""

import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import tables as tbl
from quarry.session import scratch_path

SCHEMA = "k long, v string, part string"


def test_upsert_pure_matches_merge_semantics(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (None, "n", "y")], SCHEMA)
    staged = spark.createDataFrame([(2, "B", "x"), (3, "c", "y"), (None, "m", "y")], SCHEMA)
    got = sorted((tuple(r) for r in tbl.upsert(target, staged, "k").collect()), key=str)
    # matched 2 updated, 3 inserted, 1 kept, null keys never match (both stay)
    assert got == sorted([(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (None, "n", "y"), (None, "m", "y")], key=str)


def test_duplicate_matched_key_fails(spark):
    target = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    staged = spark.createDataFrame([(1, "b", "x"), (1, "c", "x")], SCHEMA)
    with pytest.raises(ValueError):
        tbl.check_merge_duplicates(target, staged, "k")


def test_upsert_into_path_moves_keys_and_drops_emptied_partitions(spark):
    path = scratch_path(spark, "t")
    tbl.create(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA), path, ["part"], "t")
    # key 2 moves from partition y to z, leaving y empty
    tbl.upsert_into(spark, spark.createDataFrame([(2, "b2", "z"), (3, "c", "x")], SCHEMA), path, "k", ["part"], "t")
    df = tbl.read_table(spark, path)
    assert sorted((r.k, r.v, r.part) for r in df.collect()) == [(1, "a", "x"), (2, "b2", "z"), (3, "c", "x")]
    # running the same upsert again changes nothing (idempotent)
    tbl.upsert_into(spark, spark.createDataFrame([(2, "b2", "z"), (3, "c", "x")], SCHEMA), path, "k", ["part"], "t")
    assert sorted((r.k, r.v, r.part) for r in tbl.read_table(spark, path).collect()) == [
        (1, "a", "x"),
        (2, "b2", "z"),
        (3, "c", "x"),
    ]
    v = tbl.version_counts(tbl.read_versions(spark, path)).first()
    assert v.n_versions == 3


@settings(max_examples=8, deadline=None)
@given(
    st.dictionaries(st.integers(0, 30), st.sampled_from("pqr"), max_size=12),
    st.dictionaries(st.integers(0, 30), st.sampled_from("pqr"), min_size=1, max_size=12),
)
def test_upsert_into_matches_dict_model(spark, target, staged):
    path = scratch_path(spark, "prop")
    t_rows = [(k, f"t{k}", p) for k, p in target.items()]
    s_rows = [(k, f"s{k}", p) for k, p in staged.items()]
    if t_rows:
        tbl.create(spark, spark.createDataFrame(t_rows, SCHEMA), path, ["part"], "t")
    tbl.upsert_into(spark, spark.createDataFrame(s_rows, SCHEMA), path, "k", ["part"], "t")
    model = {k: (f"t{k}", p) for k, p in target.items()}
    model.update({k: (f"s{k}", p) for k, p in staged.items()})
    got = sorted((r.k, r.v, r.part) for r in tbl.read_table(spark, path).collect())
    assert got == sorted((k, v, p) for k, (v, p) in model.items())


def test_overwrite_partitions_replaces_only_present_partitions(spark):
    path = scratch_path(spark, "ow")
    tbl.create(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA), path, ["part"], "t")
    for _ in range(2):  # twice = once
        tbl.overwrite_partitions(spark, spark.createDataFrame([(3, "c", "y")], SCHEMA), path, ["part"], "t")
    assert sorted((r.k, r.part) for r in tbl.read_table(spark, path).collect()) == [(1, "x"), (3, "y")]


def test_replace_drops_other_partitions(spark):
    path = scratch_path(spark, "rp")
    tbl.create(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA), path, ["part"], "t")
    tbl.replace(spark, spark.createDataFrame([(3, "c", "z")], SCHEMA), path, ["part"], "t")
    assert [(r.k, r.part) for r in tbl.read_table(spark, path).collect()] == [(3, "z")]


def test_missing_staging_path_is_none(spark):
    assert tbl.read_table(spark, scratch_path(spark, "nothing-here")) is None


def test_partition_filter_prunes(spark):
    path = scratch_path(spark, "prune")
    df = spark.createDataFrame([(i, "v", f"p{i % 3}") for i in range(30)], SCHEMA)
    tbl.stage(df, path, ["part"])
    plan = tbl.read_table(spark, path).where(F.col("part") == "p1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "p1" in plan


def test_catalog_tables(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA)
    tbl.create_table(df, name, ["part"])
    assert tbl.table_exists(spark, name)
    tbl.overwrite_table_partitions(spark, spark.createDataFrame([(3, "c", "y")], SCHEMA), name)
    assert sorted(r.k for r in spark.table(name).collect()) == [1, 3]
    tbl.replace_table(spark.createDataFrame([(4, "d", "z")], SCHEMA), name, ["part"])
    assert [r.k for r in spark.table(name).collect()] == [4]
    audit = {r.table_name: r.n_rows for r in tbl.audit_counts({name: spark.table(name)}).collect()}
    assert audit == {name: 1}


def test_emptied_partitions_with_special_and_null_values_are_dropped(spark):
    path = scratch_path(spark, "esc")
    tbl.create(spark, spark.createDataFrame([(1, "a", "we/ird=p%"), (2, "b", None), (3, "c", "z")], SCHEMA), path, ["part"], "t")
    tbl.upsert_into(spark, spark.createDataFrame([(1, "a2", "z"), (2, "b2", "z")], SCHEMA), path, "k", ["part"], "t")
    got = sorted((r.k, r.v, r.part) for r in tbl.read_table(spark, path).collect())
    assert got == [(1, "a2", "z"), (2, "b2", "z"), (3, "c", "z")]


def test_touched_partitions_of_any_number(spark):
    path = scratch_path(spark, "touched")
    df = spark.createDataFrame([(i, "v", f"p{i % 5}" if i % 7 else None) for i in range(50)], SCHEMA).withColumn("sub", F.col("k") % 2)
    tbl.stage(df, path, ["part", "sub"])
    t = tbl.read_table(spark, path)
    few = spark.createDataFrame([("p1", 1), ("p2", 0), (None, 0)], "part string, sub long")
    got = tbl.in_partitions(t, ["part", "sub"], few).select("part", "sub").distinct().collect()
    assert sorted(map(str, got)) == sorted(map(str, few.collect()))
    many = spark.range(5000).select(F.concat(F.lit("p"), "id").alias("part"), F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("sub"))
    assert tbl.in_partitions(t, ["part", "sub"], many).count() == df.where("part is not null").count()


def test_upsert_into_many_partitions(spark):
    path = scratch_path(spark, "upsert-many")
    df = spark.range(600).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.concat(F.lit("p"), F.col("id") % 300).alias("part"))
    tbl.create(spark, df, path, ["part"], "t")
    staged = df.withColumn("v", F.lit("new")).withColumn("part", F.when(F.col("k") == 5, F.lit("p6")).otherwise(F.col("part"))).where("k < 300")
    tbl.upsert_into(spark, staged, path, "k", ["part"], "t")
    out = {r.k: (r.v, r.part) for r in tbl.read_table(spark, path).collect()}
    assert len(out) == 600 and all(v == ("new" if k < 300 else "old") for k, (v, _) in out.items()) and out[5] == ("new", "p6")


def test_cluster_conf_sizing():
    from quarry.session import cluster_conf

    big = cluster_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    small = cluster_conf(2**30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64
    assert big["spark.sql.adaptive.enabled"] == "true" and big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def _plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _above(plan, leaf):
    """The plan lines from the root to the first line that holds ``leaf``, without those of other branches."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    path, d = [lines[at]], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < d:
            path, d = [line, *path], depth(line)
    return path


def test_merge_shuffles_only_the_staged_rows(spark):
    path = scratch_path(spark, "bucketed")
    target = spark.range(4000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.concat(F.lit("p"), F.col("id") % 5).alias("part"))
    tbl.create(spark, target, path, ["part"], "t", "k", buckets=4)
    staged = target.where("k % 10 = 0").withColumn("v", F.lit("new")).unionByName(spark.createDataFrame([(9001, "in", "p9"), (None, "n", "p1")], SCHEMA))
    name = tbl.bucketed(spark, path, "k")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")  # as with staged rows too many to broadcast
    try:
        for df in (tbl.merge_rows(spark.table(name).select(*SCHEMA_COLUMNS), staged, "k"), tbl.touched_partitions(spark.table(name), staged, "k", ["part"])):
            plan = _plan_of(df)
            path_up = _above(plan, "Bucketed: true")
            joins = [i for i, line in enumerate(path_up) if "Join" in line]
            assert joins and not any("Exchange" in line for line in path_up[joins[-1] :]), plan
    finally:
        spark.conf.set(conf, before)
    for _ in range(2):
        tbl.upsert_into(spark, staged.where("k is not null"), path, "k", ["part"], "t")
    rows = {r.k: (r.v, r.part) for r in tbl.read_table(spark, path).collect()}
    assert len(rows) == 4001 and rows[9001] == ("in", "p9") and all(rows[k][0] == ("new" if k % 10 == 0 else "old") for k in range(4000))
    assert tbl.table_rows(spark, path) == 4001
    per_partition = [len(spark.read.parquet(f"{path}/part=p{i}").inputFiles()) for i in range(5)]
    assert max(per_partition) <= 4  # one file per bucket


SCHEMA_COLUMNS = ["k", "v", "part"]


def test_merge_into_a_table_without_buckets(spark):
    path = scratch_path(spark, "plain")
    tbl.create(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "x")], SCHEMA), path, ["part"], "t")
    assert tbl.upsert_into(spark, spark.createDataFrame([(2, "B", "x"), (3, "c", "z")], SCHEMA), path, "k", ["part"], "t") == 4
    got = sorted(((r.k, r.v, r.part) for r in tbl.read_table(spark, path).collect()), key=repr)
    assert got == sorted([(1, "a", "x"), (2, "B", "x"), (3, "c", "z"), (None, "n", "x")], key=repr)
    assert tbl.table_rows(spark, path) == 4


def test_version_numbers_of_writers_at_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = scratch_path(spark, "versions")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: tbl.log_version(spark, path, "t", "append", i, replaced=0), range(40)))
    assert sorted(got) == list(range(1, 41))  # none taken twice, none left out
    log = tbl.read_versions(spark, path).collect()
    assert sorted(r.version for r in log) == sorted(got) and sorted(r.rows_written for r in log) == list(range(40))
    assert tbl.table_rows(spark, path) == sum(range(40)) and all(r.committed_at for r in log)
