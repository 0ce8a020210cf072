"""Landing events -> ledger: replays, new etags, missing etag/size, archive routing,
latest status, and the streaming form surviving a replayed batch."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from quarry import jobs
from quarry import schemas as S
from quarry.operators import drop_state, landing
from quarry.operators import tables as tbl
from quarry.session import scratch_path
from quarry.streaming import ledger as ledger_stream

B = "imgp-dev-landing-coco-000000000042"


def ev(key, etag="e1", size=10, t="2024-06-01T10:00:00Z", bucket=B):
    obj = {"key": key}
    if etag is not None:
        obj["etag"] = etag
    if size is not None:
        obj["size"] = size
    return {"detail": {"bucket": {"name": bucket}, "object": obj}, "time": t}


def _df(spark, events):
    return spark.read.schema(S.LANDING_EVENT).json(spark.sparkContext.parallelize([json.dumps(e) for e in events]))


def test_first_seen_and_routing(spark):
    events = [
        ev("a/drop.ZIP"),
        ev("a/drop.ZIP", t="2024-06-02T00:00:00Z"),  # replay, same etag
        ev("a/drop.ZIP", etag="e2", t="2024-06-03T00:00:00Z"),  # new version
        ev("a/img.jpg", etag=None, size=None),
    ]
    objs = landing.normalize_events(_df(spark, events))
    led = {r.drop_id: r for r in landing.first_seen(objs).collect()}
    assert set(led) == {"coco#a/drop.ZIP#e1", "coco#a/drop.ZIP#e2", "coco#a/img.jpg#"}
    assert led["coco#a/drop.ZIP#e1"].ingest_date == "2024-06-01"
    assert led["coco#a/img.jpg#"].size_bytes == 0
    routed = {r.src_key: r for r in landing.route(objs).collect()}
    assert routed["a/drop.ZIP"].action == "unpack" and routed["a/drop.ZIP"].dataset == "drop"
    assert routed["a/img.jpg"].bronze_key == "partner=coco/dataset=loose/ingest_date=2024-06-01/img.jpg"


def test_insert_if_absent(spark):
    objs = landing.normalize_events(_df(spark, [ev("x.jpg"), ev("y.jpg")]))
    ledger = landing.first_seen(landing.normalize_events(_df(spark, [ev("x.jpg")])))
    cand = landing.first_seen(objs)
    assert [r.src_key for r in landing.insert_if_absent(ledger, cand).collect()] == ["y.jpg"]


def test_latest_status_rank_beats_late_submitted(spark):
    t = dt.datetime
    rows = [
        ("d1", "RECEIVED", t(2024, 1, 1), None),
        ("d1", "DONE", t(2024, 1, 2), "m.json"),
        ("d1", "SUBMITTED", t(2024, 1, 3), None),  # late, must not hide DONE
        ("d2", "RECEIVED", t(2024, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "drop_id string, status string, updated_at timestamp, manifest_key string")
    got = {r.drop_id: r for r in landing.latest_status(df).collect()}
    assert got["d1"].status == "DONE" and got["d1"].manifest_key == "m.json" and got["d1"].n_events == 3
    assert got["d2"].status == "RECEIVED"


def test_stream_registers_once_and_survives_replayed_batch(spark):
    src = scratch_path(spark, "src")
    os.makedirs(src.replace("file:", ""), exist_ok=True)
    local = src.replace("file:", "")
    for i, events in enumerate([[ev("a.jpg"), ev("a.jpg")], [ev("a.jpg"), ev("b.zip")]]):
        with open(f"{local}/part-{i}.json", "w") as f:
            f.write("\n".join(json.dumps(e) for e in events))
    ledger_path = scratch_path(spark, "ledger")
    q = ledger_stream.start_ledger_stream(spark, src, ledger_path, scratch_path(spark, "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    rows = tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE).collect()
    assert sorted(r.drop_id for r in rows) == ["coco#a.jpg#e1", "coco#b.zip#e1"]
    # a replay of batch 1 (same id) rewrites its own partition: no duplicate, no loss
    batch1 = _df(spark, [ev("a.jpg"), ev("b.zip")])
    ledger_stream.register_batch(spark, batch1, 1, ledger_path)
    rows = tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE).collect()
    assert sorted(r.drop_id for r in rows) == ["coco#a.jpg#e1", "coco#b.zip#e1"]


def test_compact_ledger_keeps_ids_and_replay_safety(spark):
    ledger_path = scratch_path(spark, "ledger-compact")
    for bid, keys in enumerate([["a.jpg", "b.jpg"], ["c.jpg"], ["a.jpg", "d.jpg"], ["e.jpg"]]):
        ledger_stream.register_batch(spark, _df(spark, [ev(k) for k in keys]), bid, ledger_path)
    before = sorted(r.drop_id for r in tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE).collect())
    n = ledger_stream.compact_ledger(spark, ledger_path, keep_last=1)
    led = tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE).collect()
    assert sorted(r.drop_id for r in led) == before and n == 4
    assert sorted({r.batch_id for r in led}) == [-1, 3]
    # compaction again is a no-op for the ids; a replay of the kept batch stays exact
    ledger_stream.compact_ledger(spark, ledger_path, keep_last=1)
    ledger_stream.register_batch(spark, _df(spark, [ev("e.jpg"), ev("f.jpg")]), 3, ledger_path)
    ids = sorted(r.drop_id for r in tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE).collect())
    assert ids == sorted(set(before) | {"coco#f.jpg#e1"})


def test_malformed_events_are_quarantined_and_name_no_drop(spark):
    src = scratch_path(spark, "bad")
    local = src.replace("file:", "")
    os.makedirs(local)
    no_key, no_time = ev("k"), ev("k")
    del no_key["detail"]["object"]["key"], no_time["time"]
    bad = ['{"detail": {"bucket"', "not json at all", json.dumps(no_key), json.dumps(no_time), json.dumps(ev("")), json.dumps(ev("k", t="soon")), "{}", '{"detail": 7, "time": "2024-06-01"}']
    with open(f"{local}/a.json", "w") as f:
        f.write("\n".join([*bad, json.dumps(ev("good.zip")), json.dumps(ev("bare.zip", etag=None, size=None))]))
    ledger_path = scratch_path(spark, "ledger")
    for _ in range(2):  # the second run has lost its checkpoint
        ledger_stream.start_ledger_stream(spark, src, ledger_path, scratch_path(spark, "ck")).awaitTermination()
    led = tbl.read_table(spark, ledger_path, ledger_stream.LEDGER_TABLE).collect()
    assert sorted(r.drop_id for r in led) == ["coco#bare.zip#", "coco#good.zip#e1"]
    kept = tbl.read_table(spark, ledger_stream.quarantine_path(ledger_path), ledger_stream.QUARANTINE).collect()
    assert len(kept) == len(bad) and {r.record for r in kept} >= set(bad[:2])
    reasons = sorted(r.reason for r in kept)
    assert reasons == sorted(["not the JSON of an event"] * 3 + ["no object key"] * 2 + ["no time", "time without a date", "no bucket name"])


def test_a_batch_reads_only_its_ledger_buckets(spark):
    ledger_path = scratch_path(spark, "ledger-buckets")
    ledger_stream.register_batch(spark, _df(spark, [ev(f"{i}.zip") for i in range(200)]), 0, ledger_path)
    few = landing.first_seen(landing.normalize_events(_df(spark, [ev("7.zip"), ev("new.zip")]))).withColumn("bucket", landing.ledger_bucket("drop_id"))
    own = sorted({r.bucket for r in few.collect()})
    new = ledger_stream.unseen(spark, ledger_path, few)
    assert [r.src_key for r in new.collect()] == ["new.zip"]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and all(str(b) in plan for b in own)


def test_state_in_batches_is_the_state_of_the_whole_history(spark):
    rnd = random.Random(4)
    names = list(landing.STATUS_RANK)
    rows = [(f"d{rnd.randrange(9)}", rnd.choice(names), dt.datetime(2024, 1, 1 + rnd.randrange(20), rnd.randrange(24)), rnd.choice([None, f"m{i}"]), rnd.choice([None, i])) for i in range(120)]
    schema = "drop_id string, status string, updated_at timestamp, manifest_key string, file_count long"
    path = scratch_path(spark, "state")
    for i in range(0, 120, 30):
        part = spark.createDataFrame(rows[i : i + 30], schema)
        drop_state.update(spark, path, part)
        drop_state.update(spark, path, part)  # applied twice, as after a failure
    whole = drop_state.current(drop_state.fold(drop_state.as_state(spark.createDataFrame(rows, schema))))
    columns = ["drop_id", "status", "updated_at", "manifest_key", "file_count"]
    state = drop_state.stored(spark, path)
    assert sorted(map(tuple, drop_state.current(state).select(*columns).collect())) == sorted(map(tuple, whole.select(*columns).collect()))
    latest = {r.drop_id: r for r in landing.latest_status(spark.createDataFrame(rows, schema)).collect()}
    for r in state.collect():
        assert landing.STATUS_RANK[r.status.v] == landing.STATUS_RANK[latest[r.drop_id].status]
        assert r.open == (r.status.v not in drop_state.FINAL)
    # a late SUBMITTED never hides a final status
    done = [r.drop_id for r in state.where(~F.col("open")).collect()]
    drop_state.update(spark, path, spark.createDataFrame([(d, "SUBMITTED", dt.datetime(2025, 1, 1)) for d in done], "drop_id string, status string, updated_at timestamp"))
    assert {r.drop_id for r in drop_state.open_drops(spark, path).collect()}.isdisjoint(done)


def test_what_is_to_do_is_read_from_open_partitions(spark):
    layout = jobs.Layout(scratch_path(spark, "todo"))
    jobs.register_events(spark, layout, _df(spark, [ev(f"{i}.zip") for i in range(30)]))
    drops = [r.drop_id for r in jobs.pending_drops(spark, layout).collect()]
    assert len(drops) == 30
    done = spark.createDataFrame([(d, "DONE", dt.datetime(2024, 7, 1)) for d in drops[:29]], "drop_id string, status string, updated_at timestamp")
    drop_state.update(spark, layout.drop_state, done)
    todo = jobs.pending_drops(spark, layout)
    assert [(r.drop_id, r.status, r.ingest_date) for r in todo.collect()] == [(drops[29], "RECEIVED", "2024-06-01")]
    plan = todo._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(open" in plan  # no history, no finished drops
    # a state table that is lost is made anew from the ledger and the history
    jobs._record(spark, layout, jobs._status(spark, done.limit(3), F.lit("FAILED")))
    led = tbl.read_table(spark, layout.ledger, ledger_stream.LEDGER_TABLE)
    assert drop_state.rebuild(spark, layout.drop_state, led, tbl.read_table(spark, layout.ledger_status, jobs.STATUS_EVENTS)) == 30
    assert jobs.pending_drops(spark, layout).count() == 27
