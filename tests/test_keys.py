"""Key and routing expressions, including the reference's own test cases as data rows."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import keys as K


def _eval(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_partner_from_bucket_reference_cases(spark):
    got = _eval(
        spark,
        [
            "imgp-dev-landing-coco-000000000042",
            "imgp-dev-landing-acme-media-000000000042",
            "imgp-dev-bronze-000000000042",
            "some-other-bucket",
        ],
        K.partner_from_bucket,
    )
    assert got == ["coco", "acme-media", "unknown", "unknown"]


def test_image_suffix_reference_cases(spark):
    assert _eval(spark, ["p/d/000000397133.jpg", "p/d/_manifest.json", "A.JPEG", "x.webp.bak"], K.is_image_key) == [
        True,
        False,
        True,
        False,
    ]


def test_coco_json_reference_cases(spark):
    names = [
        "instances_val2017.json",
        "captions_train2017.json",
        "person_keypoints_val2017.json",
        "_manifest.json",
        "000000397133.jpg",
        "foo_instances_v.json",  # searched, not anchored: matches
    ]
    assert _eval(spark, names, K.is_coco_json) == [True, True, True, False, False, True]


@pytest.mark.parametrize(
    "name,stem",
    [("a.tar.zip", "a.tar"), (".zip", ".zip"), ("a.", "a."), ("a", "a"), ("..zip", "."), ("x/y.zip", "y")],
)
def test_path_stem_like_pathlib(spark, name, stem):
    from pathlib import PurePosixPath

    assert PurePosixPath(name).stem == stem
    assert _eval(spark, [name], K.path_stem) == [stem]


@pytest.mark.parametrize(
    "name,kind,split,action",
    [
        ("instances_val2017.json", "instances", "val2017", "instances"),
        ("captions_train2017.json", "captions", "train2017", "captions"),
        ("person_keypoints_val2017.json", "person", "keypoints_val2017", "skip_keypoints"),
        ("instances.json", "instances", "", "ignore"),
        ("foo_instances_v.json", "foo", "instances_v", "ignore"),
        ("instances_x.txt", "instances", "x", "instances"),
        ("_manifest.json", "", "manifest", "ignore"),
    ],
)
def test_annotation_kind(spark, name, kind, split, action):
    df = spark.createDataFrame([(f"p/d/{name}",)], "key string")
    r = df.select(K.annotation_kind("key"), K.annotation_split("key"), K.annotation_action("key")).first()
    # the normaliser's own rule: stem cut at the last dot, split at the first underscore
    stem = name.rsplit(".", 1)[0]
    k, _, s = stem.partition("_")
    assert (k, s) == (kind, split)
    assert tuple(r) == (kind, split, action)


def test_content_type_and_drop_id(spark):
    df = spark.createDataFrame([("a/b.JPG", None), ("a/b.bin", "e1"), ("noext", "")], "key string, etag string")
    rows = df.select(K.content_type("key"), K.drop_id(F.lit("p"), "key", "etag")).collect()
    assert [tuple(r) for r in rows] == [
        ("image/jpeg", "p#a/b.JPG#"),
        ("application/octet-stream", "p#a/b.bin#e1"),
        ("application/octet-stream", "p#noext#"),
    ]


def test_thumbnail_key_and_loose_key(spark):
    df = spark.createDataFrame([("p/d/a.b.png",), ("p/d/noext",)], "key string")
    rows = df.select(
        K.thumbnail_key(F.lit("partner=x/dataset=y/ingest_date=2024-01-01/"), K.file_name("key")),
        K.loose_bronze_key(F.lit("x"), F.lit("2024-01-01"), "key"),
    ).collect()
    assert rows[0][0] == "thumbnails/partner=x/dataset=y/ingest_date=2024-01-01/a.b.jpg"
    assert rows[1][0] == "thumbnails/partner=x/dataset=y/ingest_date=2024-01-01/noext.jpg"
    assert rows[0][1] == "partner=x/dataset=loose/ingest_date=2024-01-01/a.b.png"


def test_package_is_shipped_to_workers_once(spark):
    from quarry.session import checkpoint_dir, ship_code

    ship_code(spark)
    ship_code(spark)
    shipped = [f for f in spark.sparkContext.listFiles if "/quarry-code/quarry-" in f]
    assert len(shipped) == 1 and shipped[0].endswith(".zip")
    assert checkpoint_dir(spark).split("://")[-1].lstrip("/").split("/")[0] in shipped[0]
