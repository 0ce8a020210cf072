"""The jobs of the third round's findings: what the driver gets, how tasks are dealt, and results at the edges."""

import os

import pytest
from pyspark.sql import functions as F

from quarry import jobs
from quarry import schemas as S
from quarry.functions import keys as K
from quarry.operators import bronze, gold
from quarry.operators import images as I
from quarry.operators import manifest as M
from quarry.operators import tables as tbl
from quarry.operators.joins import gathered, spread
from quarry.session import listing_by_the_core, listing_session, scratch_path


def _tasks(df) -> int:
    return df.select(F.spark_partition_id().alias("t")).distinct().count()


# F1, F4
def test_only_manifest_documents_are_listed(spark, tmp_path):
    from quarry.streaming import manifests as ms

    root = tmp_path / "odd [1]{x}"
    for d in ("a", "b"):
        drop = root / f"partner=p/dataset={d}/ingest_date=2024-06-01"
        os.makedirs(drop / "sub")
        for i in range(50):
            (drop / "sub" / f"{i}.txt").write_text("x")
        (drop / "manifest.json").write_text('{"partner": "p"}')
    assert ms.document_stream(spark, f"file:{root}").isStreaming
    found = spark.read.format("binaryFile").load(K.manifest_glob(f"file:{root}/"))
    assert sorted(r.path.split("dataset=")[1][0] for r in found.select("path").collect()) == ["a", "b"]
    read = []
    stream = ms.document_stream(listing_session(spark), f"file:{root}").writeStream.option("checkpointLocation", f"file:{tmp_path}/ck")
    stream.foreachBatch(lambda df, _: read.extend(r.path for r in df.collect())).trigger(availableNow=True).start().awaitTermination()
    assert len(read) == 2 and all(p.endswith("ingest_date=2024-06-01/manifest.json") for p in read)


def test_lists_of_paths_are_looked_up_by_the_core(spark):
    key, most = "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(8 * spark.sparkContext.defaultParallelism)
    before, zone = spark.conf.get(key), spark.conf.get("spark.sql.session.timeZone")
    with listing_by_the_core(spark):
        assert spark.conf.get(key) == most
    own = listing_session(spark)
    assert own.conf.get(key) == most and own.conf.get("spark.sql.session.timeZone") == zone
    assert spark.conf.get(key) == before


# F4
def test_small_entries_of_an_archive_go_together(spark):
    small = [("a" if i < 200 else "b", i % 200, f"{i}.txt", 10, 0, None) for i in range(400)]
    large = [("c", i, f"{i}.bin", bronze.COPY_BYTES, 0, None) for i in range(64)]
    entries = spark.createDataFrame(small + large, bronze.ENTRY_LIST).withColumn("keys", F.array("path"))
    dealt = bronze.dealt_entries(entries, 0, 400_000).withColumn("t", F.spark_partition_id()).collect()
    assert len(dealt) == 464 and "_run" not in dealt[0].asDict()
    of = lambda a: {r.t for r in dealt if r.archive_path == a}
    assert len(of("a")) <= 4 and len(of("b")) <= 4  # runs of 64, each in one task
    assert len(of("c")) > 20  # large entries each by themselves


def test_work_is_spread_though_its_rows_come_dealt(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("path")).distinct()  # dealt by path already
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _tasks(spread(rows, ["path"])) == n


def test_a_file_per_drop_is_work_for_many_tasks(spark, monkeypatch):
    import zipfile

    layout = jobs.Layout(scratch_path(spark, "many-drops"))
    bucket = "imgp-dev-landing-acme-123456789012"
    folder = f"{layout.landing}/{bucket}/drops".replace("file:", "")
    os.makedirs(folder)
    for i in range(12):
        with zipfile.ZipFile(f"{folder}/d{i}.zip", "w") as z:
            z.writestr("a.txt", "x")
            z.writestr("b.txt", "y")
    detail = F.struct(F.struct(F.lit(bucket).alias("name")).alias("bucket"), F.struct(F.concat(F.lit("drops/d"), F.col("id").cast("string"), F.lit(".zip")).alias("key"), F.lit(1).cast("long").alias("size"), F.lit("e").alias("etag")).alias("object"))
    jobs.register_events(spark, layout, spark.range(12).select(detail.alias("detail"), F.lit("2024-06-01T10:00:00Z").alias("time")))
    tasks = []
    real = tbl.stage
    monkeypatch.setattr(tbl, "stage", lambda df, path, *a, **b: (tasks.append(_tasks(df)) if path == layout.manifests else None) or real(df, path, *a, **b))
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    assert tasks[0] > 3  # 24 small rows are more than one task's work here
    files = tbl.read_table(spark, layout.manifests, jobs.MANIFEST_FILES)
    assert files.count() == 24 and files.select(F.col("_metadata.file_path")).distinct().count() == 12


# F2, F6
def _gold_inputs(spark):
    part = ("p", "d", "2024-06-01", "s")
    typed = "partner string, dataset string, ingest_date string, split string"
    ann = spark.createDataFrame(
        [(*part, 1, 10, 2.0, 1), (*part, 1, 10, 4.0, 0), (*part, 1, 11, None, None), (*part, 2, 10, None, None), (*part, 3, 10, 1.0, 1),
         (*part, None, 10, 1.0, 1), (*part, 1, None, 6.0, 0)],
        f"{typed}, category_id long, image_id long, area double, iscrowd long",
    )
    cat = spark.createDataFrame(
        [(*part, 1, "one", "x"), (*part, 1, "one", "x"), (*part, 1, "uno", "x"), (*part, 2, None, None), (*part, None, "none", "x")],
        f"{typed}, category_id long, name string, supercategory string",
    )
    return ann, cat


@pytest.mark.parametrize("scale", [None, 2])
def test_category_stats_as_a_join_would_count(spark, scale):
    ann, cat = _gold_inputs(spark)
    stats = gold.category_stats(ann, cat, "imgs", area_scale=scale)
    got = {(r.category_id, r.category): (r.n_annotations, r.n_images, r.avg_area, r.crowd_annotations) for r in stats.collect()}
    assert got == {(1, "one"): (8, 2, 4.0, 2), (1, "uno"): (4, 2, 4.0, 1), (2, None): (1, 1, None, None)}
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # tallies meet the categories, not annotations


def test_gold_build_keeps_no_cache_and_copies_without_a_shuffle(spark, monkeypatch):
    layout = jobs.Layout(scratch_path(spark, "laid-out"))
    rows = spark.range(100).select(F.lit("p").alias("partner"), F.lit("d").alias("dataset"), F.lit("2024-06-01").cast("date").alias("ingest_date"),
                                   (F.col("id") % 9).cast("string").alias("split"), F.col("id").alias("category_id"), F.lit("n").alias("name"), F.lit("s").alias("supercategory"))
    tbl.stage(rows, layout.staging("coco_categories"), S.SLICE_PARTITION)
    hinted = []
    real = tbl._layout
    monkeypatch.setattr(tbl, "_layout", lambda df, cols: hinted.append(cols) or real(df, cols))
    assert jobs.silver_build(spark, layout) == {"coco_categories": 100}
    assert jobs.silver_build(spark, layout) == {"coco_categories": 100}  # the second time partitions are replaced
    assert hinted == []
    silver = tbl.read_table(spark, layout.silver("coco_categories"), S.COCO_CATEGORIES)
    assert sorted((r.split, r["count"]) for r in silver.groupBy("split").count().collect()) == [(str(i), 12 if i == 0 else 11) for i in range(9)]
    files = silver.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert files == tbl.read_table(spark, layout.staging("coco_categories"), S.COCO_CATEGORIES).select(F.col("_metadata.file_path").alias("f")).distinct().count()


def test_rows_are_not_sorted_for_few_partitions(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with tbl._unsorted(spark):
        assert int(spark.conf.get(key)) == tbl.OPEN_FILES
    assert spark.conf.get(key) == before
    path = scratch_path(spark, "many-open")  # more partitions in a task than it may keep open
    assert tbl.stage(spark.range(1000).withColumn("p", F.col("id") % 50).coalesce(1), path, ["p"]) == 1000
    assert spark.read.parquet(path).groupBy("p").count().where("count = 20").count() == 50


# F5
def test_keys_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(M, "KEYS_A_TASK", 10)
    listed = spark.createDataFrame([(i % 300 if i else None,) for i in range(600)], "key long")
    objects = spark.createDataFrame([(i if i else None,) for i in range(0, 600, 2)] + [(2,), (700,), (700,)], "key long")
    missing, unlisted = M.missing_objects(listed, objects), M.unlisted_objects(listed, objects)
    assert _tasks(missing) > 20  # adaptive execution would have made it one task
    want = lambda rows: sorted(rows, key=lambda v: (v is not None, v))
    assert want(r.key for r in missing.distinct().collect()) == want([None, 0, *range(1, 300, 2)])
    assert want(r.key for r in unlisted.collect()) == want([None, *range(300, 600, 2), 700, 700])
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan


# F3, F7
def test_small_files_share_tasks(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"{i}.bin").write_bytes(b"x" * i)
    files = lambda: spark.read.format("binaryFile").load(f"file:{tmp_path}")
    least = 4 * spark.sparkContext.defaultParallelism
    many = files().repartition(100)
    assert _tasks(gathered(many, 400)) <= least < _tasks(many)
    assert gathered(files(), 400).agg(F.sum(F.length("content"))).first()[0] == sum(range(400))


def test_area_sums_are_exact(spark):
    import numpy as np

    px = np.full((1000, 1200, 3), 255, np.uint8)
    assert (I.resize_area(px, 3, 2) == 255).all()  # sums beyond one and two bytes
    img = np.random.default_rng(1).integers(0, 256, (37, 91), dtype=np.uint8)
    rows, cols = (np.arange(5) * 37) // 5, (np.arange(7) * 91) // 7
    want = np.array([[np.rint(b.mean()) for b in np.split(a, cols[1:], axis=1)] for a in np.split(img.astype(float), rows[1:])])
    assert (I.resize_area(img, 7, 5) == want).all()
