"""Plan shape checks for the hot-key design: every group-by combines map-side before its
shuffle, dimension sides broadcast only when small, and only image headers cross into
Python.  Plus a skewed run: one key holding a third of all rows gives exact results."""


from pyspark.sql import functions as F

from quarry.operators import gold, images, landing
from quarry.plans import standins as si
from conftest import SMOKE_DIR


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(plan, fn):
    i, j = plan.find(f"partial_{fn}"), plan.find("Exchange")
    return i >= 0 and j >= 0


def test_ledger_aggregates_combine_map_side(spark):
    ev = spark.createDataFrame(
        [(f"d{i % 3}", f"2024-01-0{1 + i % 5}T00:00:00Z", i) for i in range(30)], "drop_id string, event_time string, event_seq long"
    ).withColumns({"partner": F.lit("p"), "src_bucket": F.lit("b"), "src_key": F.col("drop_id"), "size_bytes": F.lit(1).cast("long"), "ingest_date": F.lit("x")})
    assert _partial_before_exchange(_plan(landing.first_seen(ev)), "min")
    st = ev.select("drop_id", F.lit("DONE").alias("status"), F.current_timestamp().alias("updated_at"))
    assert _partial_before_exchange(_plan(landing.latest_status(st)), "max_by")


def test_gold_plans_need_no_probe(spark):
    ann, cat = si.coco_annotations(spark, SMOKE_DIR), si.coco_categories(spark, SMOKE_DIR)
    meta, img = si.image_metadata(spark, SMOKE_DIR), si.coco_images(spark, SMOKE_DIR)
    for df in (gold.category_stats(ann, cat, "v"), gold.per_image_labels(ann, cat), gold.ml_manifest(img, meta, ann, cat)):
        assert "SinglePartition" not in _plan(df)
    labels = _plan(gold.per_image_labels(ann, cat))
    assert _partial_before_exchange(labels, "collect_set") and "count(distinct" not in labels.lower()


def test_only_headers_cross_into_python(spark):
    objs = spark.createDataFrame([("k", b"\x89PNG" + bytes(100))], "bronze_key string, content binary")
    plan = _plan(images._headers(objs, "content", images.HEAD_BYTES, []))
    assert f"substring(content#" in plan and str(images.HEAD_BYTES) in plan


def test_hot_key_third_of_rows_exact(spark):
    n = 3000
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{i}"
        rows.append((key, f"2024-01-01T00:{i // 60 % 60:02d}:{i % 60:02d}Z", i))
    ev = spark.createDataFrame(rows, "drop_id string, event_time string, event_seq long").withColumns(
        {"partner": F.lit("p"), "src_bucket": F.lit("b"), "src_key": F.col("drop_id"), "size_bytes": F.col("event_seq"), "ingest_date": F.lit("x")}
    )
    led = {r.drop_id: r for r in landing.first_seen(ev).collect()}
    assert len(led) == 1 + 2 * n // 3
    assert led["hot"].size_bytes == 0 and led["hot"].received_at == "2024-01-01T00:00:00Z"


def test_hot_category_third_of_annotations_exact(spark):
    import collections
    import datetime

    rows = []
    for i in range(3000):
        cat = 1 if i % 3 == 0 else 2 + i % 40
        rows.append(("p", "d", datetime.date(2024, 1, 1), "s", i // 7, cat, float(i % 13), i % 2))
    ann = spark.createDataFrame(
        rows, "partner string, dataset string, ingest_date date, split string, image_id long, category_id long, area double, iscrowd long"
    )
    cat = spark.createDataFrame(
        [("p", "d", datetime.date(2024, 1, 1), "s", c, f"c{c % 10}", "x") for c in range(1, 42)],
        "partner string, dataset string, ingest_date date, split string, category_id long, name string, supercategory string",
    )
    n, imgs, area, crowd = collections.Counter(), collections.defaultdict(set), collections.Counter(), collections.Counter()
    for _, _, _, _, img, c, a, cr in rows:
        n[c] += 1
        imgs[c].add(img)
        area[c] += a
        crowd[c] += cr
    for side in (cat.hint("broadcast"), cat.hint("merge")):
        got = {r.category_id: r for r in gold.category_stats(ann, side, "v").collect()}
        assert got[1].n_annotations == 1000
        for c in n:
            assert (got[c].n_annotations, got[c].n_images, got[c].crowd_annotations) == (n[c], len(imgs[c]), crowd[c])
            assert abs(got[c].avg_area - area[c] / n[c]) < 1e-9
