"""Event -> zip -> bronze -> profile + normalise -> silver -> gold, run twice: the second
run registers nothing new and leaves every table as it was."""

import io
import json
import os
import zipfile


import pytest
from pyspark.sql import functions as F

from quarry import jobs, schemas as S
from quarry.operators import tables as tbl
from quarry.session import scratch_path
from test_images import png

BUCKET = "imgp-dev-landing-coco-000000000042"
INSTANCES = {
    "images": [
        {"id": 1, "file_name": "1.png", "width": 640, "height": 480},
        {"id": 2, "file_name": "2.png", "width": 10, "height": 7},
        {"id": 3, "file_name": "3.jpg", "width": 5, "height": 5},
    ],
    "categories": [{"id": 1, "name": "person", "supercategory": "person"}, {"id": 2, "name": "dog", "supercategory": "animal"}],
    "annotations": [
        {"id": 10, "image_id": 1, "category_id": 1, "bbox": [0, 0, 10, 10], "area": 100.0, "iscrowd": 0, "segmentation": [[1, 2]]},
        {"id": 11, "image_id": 1, "category_id": 2, "bbox": [1, 1, 2, 2], "area": 4, "iscrowd": 1},
        {"id": 12, "image_id": 2, "category_id": 1, "bbox": [1, 1, 3, 3], "area": 9, "iscrowd": 0},
    ],
}


def _setup(layout):
    root = layout.landing.replace("file:", "")
    d = os.path.join(root, BUCKET, "drops")
    os.makedirs(d, exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("images/", b"")
        zf.writestr("images/1.png", png(640, 480, ctype=2))
        zf.writestr("images/2.png", png(10, 7, ctype=6))
        zf.writestr("images/3.jpg", b"not an image")
        zf.writestr("annotations/instances_val2017.json", json.dumps(INSTANCES))
        zf.writestr("annotations/captions_val2017.json", json.dumps({"annotations": [{"id": 7, "image_id": 1, "caption": "a dog"}]}))
        zf.writestr("annotations/person_keypoints_val2017.json", "{}")
    with open(os.path.join(d, "val2017.zip"), "wb") as f:
        f.write(buf.getvalue())
    with open(os.path.join(d, "photo.png"), "wb") as f:
        f.write(png(20, 20))


def _events(spark):
    def ev(key, t):
        return {"detail": {"bucket": {"name": BUCKET}, "object": {"key": key, "size": 1, "etag": "x"}}, "time": t}

    rows = [ev("drops/val2017.zip", "2024-06-01T10:00:00Z"), ev("drops/val2017.zip", "2024-06-01T10:05:00Z"),
            ev("drops/photo.png", "2024-06-01T11:00:00Z")]
    return spark.read.schema(S.LANDING_EVENT).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def _run(spark, layout, batch_id):
    added = jobs.register_events(spark, layout, _events(spark), batch_id)
    drops = jobs.pending_drops(spark, layout)
    if drops.limit(1).count():
        jobs.bronze_job(spark, layout, drops)
        files = tbl.read_table(spark, layout.manifests, jobs.MANIFEST_FILES)
        jobs.silver_job(spark, layout, files)
    counts = jobs.silver_build(spark, layout)
    gold = jobs.gold_build(spark, layout, "coco", "val2017", "val2017", "val2017", "2024-06-01")
    return added, counts, gold


def _snapshot(spark, layout):
    out = {}
    for t, schema in (("category_stats", S.CATEGORY_STATS), ("ml_manifest", S.ML_MANIFEST)):
        df = tbl.read_table(spark, layout.gold(t)).select(*schema.fieldNames())
        out[t] = sorted(tuple(r) for r in df.collect())
    out["meta"] = sorted((r.bronze_key, r.width, r.error) for r in tbl.read_table(spark, layout.silver("image_metadata"), S.IMAGE_METADATA).collect())
    return out


def test_end_to_end_twice(spark):
    layout = jobs.Layout(scratch_path(spark, "e2e"))
    _setup(layout)
    added, counts, gold = _run(spark, layout, 0)
    assert added == 2  # the replayed event is registered once
    assert counts == {"image_metadata": 3, "coco_images": 3, "coco_categories": 2, "coco_annotations": 3, "coco_captions": 1}
    snap = _snapshot(spark, layout)
    meta = {k.rsplit("/", 1)[-1]: (w, e) for k, w, e in snap["meta"]}
    assert meta["1.png"] == (640, None) and meta["3.jpg"][0] is None and meta["3.jpg"][1]
    stats = {r[3]: r for r in snap["category_stats"]}  # by category_id
    assert stats[1][6:] == (2, 2, 54.5, 0) and stats[2][6:] == (1, 1, 4.0, 1)
    man = {r[3]: r for r in snap["ml_manifest"]}  # by image_id
    assert man[1][-3:] == (2, 2, "dog,person") and man[3][-3:] == (0, 0, "")
    assert man[3][8] is None  # failed profile: no thumbnail key, still listed
    th = tbl.read_table(spark, layout.thumbnails).collect()
    assert sorted((r.thumb_width, r.thumb_height) for r in th) == [(10, 7), (256, 192)]
    loose = spark.read.format("binaryFile").load(layout.bronze + "/partner=coco/dataset=loose/ingest_date=2024-06-01/photo.png")
    assert loose.count() == 1

    added2, counts2, _ = _run(spark, layout, 1)
    assert added2 == 0 and counts2 == counts
    assert _snapshot(spark, layout) == snap


def test_manifest_stream_triggers_silver_once(spark):
    from quarry.streaming import manifests as ms

    layout = jobs.Layout(scratch_path(spark, "e2e-stream"))
    _setup(layout)
    jobs.register_events(spark, layout, _events(spark), 0)
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    ck = scratch_path(spark, "silver-stream-ck")
    ms.start_silver_stream(spark, layout, ck).awaitTermination()
    led = tbl.read_table(spark, layout.silver_ledger, ms.LEDGER_TABLE).collect()
    assert [(r.drop_id, r.status) for r in led] == [
        ("silver#partner=coco/dataset=val2017/ingest_date=2024-06-01/manifest.json", "SUBMITTED")
    ]
    staged = tbl.read_table(spark, layout.staging("image_metadata"), S.IMAGE_METADATA)
    assert staged.count() == 3
    # the drop is re-unpacked (its manifest partition rewritten): the stream sees new
    # files but the manifest key is already ledgered, so nothing runs twice
    jobs.bronze_job(spark, layout, tbl.read_table(spark, layout.ledger, jobs.ledger_stream.LEDGER_TABLE))
    ms.start_silver_stream(spark, layout, ck).awaitTermination()
    assert tbl.read_table(spark, layout.silver_ledger, ms.LEDGER_TABLE).count() == 1


def test_cli_runs_the_jobs(spark, tmp_path, capsys):
    from quarry import cli

    layout = jobs.Layout(scratch_path(spark, "e2e-cli"))
    _setup(layout)
    ev = tmp_path / "events.json"
    ev.write_text("\n".join(json.dumps(r.asDict(recursive=True)) for r in _events(spark).collect()))
    root = ["--root", layout.root.replace("file:", "")]  # a path without scheme is Spark's own, here a local one
    assert cli.main(["register", "--events", f"file:{ev}", *root]) == 0
    assert cli.main(["bronze", *root]) == 0
    assert cli.main(["silver", *root]) == 0
    assert cli.main(["silver-build", *root]) == 0
    gold = ["--partner", "coco", "--images-dataset", "val2017", "--annotations-dataset", "val2017",
            "--split", "val2017", "--ingest-date", "2024-06-01", "--mode", "partitions"]
    assert cli.main(["gold-build", *gold, *root]) == 0
    assert cli.main(["compact-ledger", "--keep-last", "0", *root]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert lines[5] == {"compacted_rows": 2}
    assert lines[0] == {"registered": 2}
    assert lines[3]["coco_annotations"] == 3
    assert lines[4] == {"category_stats": 2, "ml_manifest": 3}


def test_status_history_of_a_drop(spark):
    layout = jobs.Layout(scratch_path(spark, "e2e-status"))
    _setup(layout)
    jobs.register_events(spark, layout, _events(spark), 0)
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    st = tbl.read_table(spark, layout.ledger_status, jobs.STATUS_EVENTS)
    hist = sorted((r.drop_id.split("#")[1], r.status) for r in st.collect())
    assert hist == [("drops/photo.png", "DONE")] + [("drops/val2017.zip", x) for x in ("DONE", "SUBMITTED", "UNPACKING")]
    latest = {r.drop_id.split("#")[1]: r for r in jobs.landing.latest_status(st).collect()}
    assert latest["drops/val2017.zip"].status == "DONE"
    assert latest["drops/val2017.zip"].manifest_key.endswith("/manifest.json")
    assert latest["drops/val2017.zip"].bronze_prefix == "partner=coco/dataset=val2017/ingest_date=2024-06-01/"
    assert latest["drops/val2017.zip"].batch_job_id == spark.sparkContext.applicationId
    with open(f"{layout.bronze.replace('file:', '')}/{latest['drops/val2017.zip'].manifest_key}") as fh:
        doc = json.load(fh)
    assert doc["file_count"] == 6 == len(doc["files"]) and doc["total_bytes"] == sum(f["size_bytes"] for f in doc["files"])
    assert [f["key"].rsplit("/", 1)[-1] for f in doc["files"]][:3] == ["1.png", "2.png", "3.jpg"]
    assert doc["files"][0]["content_type"] == "image/png" and doc["files"][0]["crc32"] > 0 and doc["partner"] == "coco"
    assert jobs.pending_drops(spark, layout).count() == 0


def test_jobs_on_an_empty_root(spark):
    layout = jobs.Layout(scratch_path(spark, "empty"))
    assert jobs.pending_drops(spark, layout).count() == 0
    assert jobs.silver_build(spark, layout) == {}


def test_corrupt_archive_fails_only_its_drop(spark):
    layout = jobs.Layout(scratch_path(spark, "e2e-corrupt"))
    _setup(layout)
    root = layout.landing.replace("file:", "")
    with open(os.path.join(root, BUCKET, "drops", "broken.zip"), "wb") as f:
        f.write(b"PK\x03\x04" + b"\x00" * 40)
    rows = [
        {"detail": {"bucket": {"name": BUCKET}, "object": {"key": k, "size": 1, "etag": "x"}}, "time": "2024-06-01T10:00:00Z"}
        for k in ("drops/val2017.zip", "drops/broken.zip")
    ]
    ev = spark.read.schema(S.LANDING_EVENT).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    jobs.register_events(spark, layout, ev, 0)
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    latest = {r.drop_id.split("#")[1]: r for r in jobs.landing.latest_status(
        tbl.read_table(spark, layout.ledger_status, jobs.STATUS_EVENTS)).collect()}
    assert latest["drops/val2017.zip"].status == "DONE" and latest["drops/val2017.zip"].file_count == 6
    assert latest["drops/broken.zip"].status == "FAILED" and 0 < len(latest["drops/broken.zip"].error) <= 1000
    files = tbl.read_table(spark, layout.manifests, jobs.MANIFEST_FILES)
    assert files.where(F.col("dataset") == "broken").count() == 0 and files.count() == 6


def test_gold_replace_vs_partition_mode(spark):
    layout = jobs.Layout(scratch_path(spark, "e2e-gold-modes"))
    _setup(layout)
    _run(spark, layout, 0)  # builds gold for partner coco (replace mode)
    stats = lambda: tbl.read_table(spark, layout.gold("category_stats"), S.CATEGORY_STATS)
    assert stats().count() == 2
    # another partner's slice, partition mode: coco's gold rows stay
    jobs.gold_build(spark, layout, "other", "val2017", "val2017", "val2017", "2024-06-01", mode="partitions")
    assert stats().count() == 2
    # replace mode (the original's createOrReplace): the table becomes exactly the new slice
    jobs.gold_build(spark, layout, "other", "val2017", "val2017", "val2017", "2024-06-01", mode="replace")
    assert stats().count() == 0


def _drops(spark, keys_and_tags):
    rows = [
        {"detail": {"bucket": {"name": BUCKET}, "object": {"key": k, "size": 1, "etag": tag}}, "time": "2024-06-01T10:00:00Z"}
        for k, tag in keys_and_tags
    ]
    return spark.read.schema(S.LANDING_EVENT).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def _latest(spark, layout):
    st = tbl.read_table(spark, layout.ledger_status, jobs.STATUS_EVENTS)
    return {tuple(r.drop_id.split("#")[1:]): r for r in jobs.landing.latest_status(st).collect()}


def test_bad_entry_and_failed_copy_fail_only_their_drops(spark):
    layout = jobs.Layout(scratch_path(spark, "e2e-crc"))
    _setup(layout)
    folder = os.path.join(layout.landing.replace("file:", ""), BUCKET, "drops")
    with open(os.path.join(folder, "val2017.zip"), "rb") as f:
        data = bytearray(f.read())
    at = data.find(b"not an image")
    if at < 0:  # compressed: break the first entry's data instead
        at = data.find(b"1.png") + 40
    data[at] ^= 0xFF
    with open(os.path.join(folder, "badcrc.zip"), "wb") as f:
        f.write(data)
    jobs.register_events(spark, layout, _drops(spark, [("drops/val2017.zip", "x"), ("drops/badcrc.zip", "x"), ("drops/absent.png", "x"), ("drops/photo.png", "x")]))
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    latest = {k[0]: r for k, r in _latest(spark, layout).items()}
    assert latest["drops/val2017.zip"].status == "DONE" and latest["drops/photo.png"].status == "DONE"
    assert latest["drops/badcrc.zip"].status == "FAILED" and latest["drops/badcrc.zip"].error
    assert latest["drops/absent.png"].status == "FAILED" and latest["drops/absent.png"].error
    files = tbl.read_table(spark, layout.manifests, jobs.MANIFEST_FILES)
    assert {r.dataset for r in files.collect()} == {"val2017"}  # no manifest rows for a failed drop
    assert not os.path.exists(f"{layout.bronze.replace('file:', '')}/partner=coco/dataset=badcrc/ingest_date=2024-06-01/manifest.json")


def test_redelivered_key_lists_its_files_once_per_drop(spark):
    layout = jobs.Layout(scratch_path(spark, "e2e-redelivery"))
    _setup(layout)
    jobs.register_events(spark, layout, _drops(spark, [("drops/val2017.zip", "x"), ("drops/val2017.zip", "y")]))
    jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
    latest = _latest(spark, layout)
    assert len(latest) == 2 and all(r.status == "DONE" and r.file_count == 6 for r in latest.values())
    files = tbl.read_table(spark, layout.manifests, jobs.MANIFEST_FILES)
    assert sorted(r["count"] for r in files.groupBy("drop_id").count().collect()) == [6, 6]
    jobs.silver_job(spark, layout, files)
    assert tbl.read_table(spark, layout.staging("image_metadata"), S.IMAGE_METADATA).count() == 3
    jobs.silver_build(spark, layout)
    assert jobs.silver_build(spark, layout)["image_metadata"] == 3  # the merge meets each key once


def test_registrations_do_not_replace_one_another(spark):
    layout = jobs.Layout(scratch_path(spark, "e2e-register"))
    assert jobs.register_events(spark, layout, _drops(spark, [("a.zip", "1"), ("b.zip", "1")])) == 2
    assert jobs.register_events(spark, layout, _drops(spark, [("b.zip", "1"), ("c.zip", "1")])) == 1
    led = tbl.read_table(spark, layout.ledger, jobs.ledger_stream.LEDGER_TABLE)
    assert sorted(r.src_key for r in led.collect()) == ["a.zip", "b.zip", "c.zip"]


def test_heavy_work_is_spread(spark):
    from quarry.operators import bronze

    layout = jobs.Layout(scratch_path(spark, "e2e-spread"))
    _setup(layout)
    path = f"{layout.landing}/{BUCKET}/drops/val2017.zip"
    entries = bronze.list_entries(spark.createDataFrame([(path,)], "path string"))
    tasks = bronze.extract(entries).select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 1


def _deliver(spark, layout, dataset, files):
    """Objects and a manifest document of one drop in bronze, without the jobs before."""
    prefix = f"partner=coco/dataset={dataset}/ingest_date=2024-06-01/"
    root = layout.bronze.replace("file:", "")
    for name, body in files.items():
        os.makedirs(os.path.dirname(f"{root}/{prefix}{name}"), exist_ok=True)
        with open(f"{root}/{prefix}{name}", "wb") as f:
            f.write(body)
    head = {"drop_id": f"coco#{dataset}#x", "partner": "coco", "dataset": dataset, "ingest_date": "2024-06-01", "source": "s", "completed_at": "t"}
    doc = head | {"file_count": len(files), "total_bytes": 1, "files": [{"key": prefix + n, "size_bytes": len(b), "crc32": 1} for n, b in files.items()]}
    os.makedirs(f"{root}/{prefix}", exist_ok=True)
    with open(f"{root}/{prefix}manifest.json", "w") as f:
        json.dump(doc, f, indent=1)


def _instances(n):
    return json.dumps({
        "images": [{"id": i, "file_name": f"{i}.png", "width": 4, "height": 4} for i in range(n)], "categories": [{"id": 1, "name": "c", "supercategory": "s"}],
        "annotations": [{"id": i, "image_id": i, "category_id": 1, "bbox": [0, 0, 1, 1], "area": 1, "iscrowd": 0} for i in range(n)],
    }).encode()


def test_manifest_stream_does_each_delivery_whole(spark, monkeypatch):
    from quarry.streaming import manifests as ms

    layout = jobs.Layout(scratch_path(spark, "e2e-manifests"))
    for d, n in (("a", 6), ("b", 2)):
        files = {f"img/{i}.PNG": png(8 + i, 4) for i in range(n)} | {f"annotations/instances_{d}.json": _instances(n), "annotations/captions_x.json": b'{"annotations": []}'}
        _deliver(spark, layout, d, files | {"__MACOSX/._1.png": b"resource fork", "notes.txt": b"x"})
    _deliver(spark, layout, "text", {"readme.txt": b"nothing to do"})
    _deliver(spark, layout, "empty", {})
    root = layout.bronze.replace("file:", "")
    for name, text in (("broken", "{not json"), ("blank", '{"partner": "coco"}')):
        os.makedirs(f"{root}/partner=coco/dataset={name}/ingest_date=2024-06-01")
        with open(f"{root}/partner=coco/dataset={name}/ingest_date=2024-06-01/manifest.json", "w") as f:
            f.write(text)
    done = []
    real = jobs.silver_job
    monkeypatch.setattr(jobs, "silver_job", lambda spark, layout, files: done.append({r.dataset for r in files.select("dataset").distinct().collect()}) or real(spark, layout, files))
    for _ in range(2):  # one document per micro-batch; the second run has lost its checkpoint
        ms.start_silver_stream(spark, layout, scratch_path(spark, "ck"), max_files_per_trigger=1).awaitTermination()
    assert sorted(map(sorted, done)) == [["a"], ["b"]]
    led = tbl.read_table(spark, layout.silver_ledger, ms.LEDGER_TABLE).collect()
    key = "silver#partner=coco/dataset=%s/ingest_date=2024-06-01/manifest.json"
    assert sorted((r.drop_id, r.status) for r in led) == [(key % d, s) for d, s in (("a", "SUBMITTED"), ("b", "SUBMITTED"), ("empty", "NOOP"), ("text", "NOOP"))]
    staged = {t: tbl.read_table(spark, layout.staging(t), S.SILVER_TABLES[t][2]) for t in ("image_metadata", "coco_annotations", "coco_images")}
    assert sorted((r.dataset, r["count"]) for r in staged["image_metadata"].groupBy("dataset").count().collect()) == [("a", 7), ("b", 3)]
    assert {r.error for r in staged["image_metadata"].where("file_name = '._1.png'").collect()} == {"cannot identify image file"}
    assert sorted((r.dataset, r.split, r["count"]) for r in staged["coco_annotations"].groupBy("dataset", "split").count().collect()) == [("a", "a", 6), ("b", "b", 2)]
    bad = tbl.read_table(spark, ms.quarantine_path(layout.silver_ledger), jobs.ledger_stream.QUARANTINE).collect()
    assert {(r.reason, r.record.split("dataset=")[1].split("/")[0]) for r in bad} == {("not the JSON of a manifest", "broken"), ("no partner or dataset", "blank")}


def test_a_listed_key_without_object_fails(spark):
    from quarry.operators import images as I

    layout = jobs.Layout(scratch_path(spark, "e2e-lost"))
    _deliver(spark, layout, "a", {"1.png": png(4, 4), "_x/.2.png": png(5, 5)})
    prefix = "partner=coco/dataset=a/ingest_date=2024-06-01/"
    listed = lambda *names: spark.createDataFrame([(prefix + n, "coco", "a", "2024-06-01") for n in names], "key string, partner string, dataset string, ingest_date string")
    assert sorted((r.file_name, r.width) for r in I.stored_image_metadata(listed("1.png", "_x/.2.png"), layout.bronze).collect()) == [(".2.png", 5), ("1.png", 4)]
    for lost in ("3.png", "_x/.4.png"):
        with pytest.raises(Exception, match="no object|[Nn]o such file"):
            I.stored_image_metadata(listed("1.png", lost), layout.bronze).collect()


def test_gold_slices_prune_at_run_time(spark):
    from quarry.operators import gold
    from quarry.plans.gold_queries import sliced_silver
    from conftest import SMOKE_DIR

    layout = jobs.Layout(scratch_path(spark, "e2e-slices"))
    sliced_silver(spark, SMOKE_DIR, layout)
    rows = [("coco", "val2017", "annotations_trainval2017", s, f"{y}-01-01") for s in "fo" for y in (1995, 1996)]
    wanted = gold.slice_table(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in gold.SLICE.fieldNames())), scratch_path(spark, "slices"))
    ann = gold.scan_slices(tbl.read_table(spark, layout.silver("coco_annotations"), S.COCO_ANNOTATIONS), wanted)
    assert "dynamicpruning" in ann._jdf.queryExecution().executedPlan().toString()
    read = {r[0] for r in ann.select(F.concat_ws("/", F.col("ingest_date").cast("string"), "split")).distinct().collect()}
    assert read == {f"{y}-01-01/{s}" for y in (1995, 1996) for s in "fo"}
    one = jobs.gold_build_slices(spark, layout, wanted.where("split = 'f' and ingest_date = '1995-01-01'"))
    jobs.gold_build(spark, layout, "coco", "val2017", "annotations_trainval2017", "f", "1995-01-01", mode="partitions")
    assert tbl.table_rows(spark, layout.gold("ml_manifest")) == one["ml_manifest"] > 0  # a single slice gives what the single build gives
