"""Manifest properties: totals equal the sum of entries, pages are bounded, explode
restores exactly the input; silver routing statuses."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import manifest as M


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2", "d3"]), st.integers(0, 10_000)), min_size=1, max_size=60))
def test_header_pages_and_explode(spark, entries):
    rows = [(d, i, f"{d}/f{i}.jpg", size, i * 7) for i, (d, size) in enumerate(entries)]
    files = spark.createDataFrame(rows, "drop string, pos long, key string, size_bytes long, crc32 long")
    head = {r.drop: (r.file_count, r.total_bytes) for r in M.header(files, ["drop"]).collect()}
    for d in {d for d, _ in entries}:
        sizes = [s for dd, s in entries if dd == d]
        assert head[d] == (len(sizes), sum(sizes))
    pages = M.pages(files, ["drop"], page_size=4)
    assert pages.agg(F.max("page_file_count")).first()[0] <= 4
    back = M.explode_files(pages, ["drop"]).select("drop", "key", "size_bytes", "crc32").collect()
    assert sorted(tuple(r) for r in back) == sorted((d, k, s, c) for d, _, k, s, c in rows)
    # pages keep archive order
    keys = [r.key for r in M.explode_files(pages.orderBy("drop", "page"), ["drop"]).where("drop = 'd1'").collect()]
    assert keys == [k for d, _, k, _, _ in rows if d == "d1"]


def test_silver_routing_statuses(spark):
    files = spark.createDataFrame(
        [
            ("m1", "p/a.JPG"),
            ("m1", "p/instances_val2017.json"),
            ("m2", "p/captions_train.json"),
            ("m3", "p/readme.txt"),
            ("m3", "p/_manifest.json"),
        ],
        "manifest_key string, key string",
    )
    got = {r.manifest_key: (r.n_images, r.n_coco_json, r.status) for r in M.silver_routing(files).collect()}
    assert got == {"m1": (1, 1, "SUBMITTED"), "m2": (0, 1, "SUBMITTED"), "m3": (0, 0, "NOOP")}


def test_missing_and_unlisted(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("b",)], "key string")
    objects = spark.createDataFrame([("b",), ("c",)], "key string")
    assert [r.key for r in M.missing_objects(listed, objects).distinct().collect()] == ["a"]
    assert [r.key for r in M.unlisted_objects(listed, objects).collect()] == ["c"]
    import pytest

    with pytest.raises(FileNotFoundError):
        M.require_objects(listed, objects)
