"""Annotation documents -> tidy tables, and gold semantics on them."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.operators import annotations as A
from quarry.operators import gold


def _write(tmp_path, name, doc):
    p = tmp_path / name
    p.write_text(json.dumps(doc, indent=2))  # multi-line document, like a delivered file
    return f"file:{p}"


INSTANCES = {
    "info": {"year": 2017},
    "images": [{"id": 1, "file_name": "1.jpg", "width": 640, "height": 480, "license": 3}],
    "categories": [
        {"id": 1, "name": "person", "supercategory": "person"},
        {"id": 2, "name": "dog", "supercategory": "animal"},
    ],
    "annotations": [
        {"id": 10, "image_id": 1, "category_id": 1, "bbox": [1, 2, 3, 4], "area": 12, "iscrowd": 0,
         "segmentation": [[1, 2, 3, 4]]},
        {"id": 11, "image_id": 1, "category_id": 2, "bbox": [0.5, 1.5, 2.0, 3.0], "area": 6.25, "iscrowd": 1,
         "segmentation": {"counts": "abc", "size": [480, 640]}},
        {"id": 12, "image_id": 1, "category_id": 99, "bbox": [0, 0, 1, 1], "area": 1, "iscrowd": 0},
    ],
}


def _files(spark, rows):
    return spark.createDataFrame(rows, "path string, partner string, dataset string, ingest_date string")


def test_normalize_instances_and_captions(spark, tmp_path):
    inst = _write(tmp_path, "instances_val2017.json", INSTANCES)
    caps = _write(tmp_path, "captions_val2017.json", {"annotations": [{"id": 5, "image_id": 1, "caption": "a dog"}]})
    kp = _write(tmp_path, "person_keypoints_val2017.json", {"annotations": "never read"})
    empty = _write(tmp_path, "instances_train2017.json", {"images": [], "categories": [], "annotations": []})
    files = _files(spark, [(p, "coco", "ann", "2024-06-01") for p in (inst, caps, kp, empty)])
    t = A.normalize(spark, files)
    ann = sorted((r.annotation_id, r.bbox_x, r.area, r.iscrowd, r.split) for r in t["coco_annotations"].collect())
    assert ann[0] == (10, 1.0, 12.0, 0, "val2017")
    assert ann[1][1:3] == (0.5, 6.25)
    assert [r.caption for r in t["coco_captions"].collect()] == ["a dog"]
    assert t["coco_images"].count() == 1 and t["coco_categories"].count() == 2
    assert t["coco_images"].schema["ingest_date"].dataType.typeName() == "date"


def test_short_bbox_fails(spark, tmp_path):
    bad = dict(INSTANCES, annotations=[{"id": 1, "image_id": 1, "category_id": 1, "bbox": [1, 2], "area": 1, "iscrowd": 0}])
    t = A.normalize(spark, _files(spark, [(_write(tmp_path, "instances_x.json", bad), "c", "d", "2024-06-01")]))
    with pytest.raises(Exception, match="bbox"):
        t["coco_annotations"].collect()


def test_malformed_document_fails(spark, tmp_path):
    p = tmp_path / "instances_bad.json"
    p.write_text("{not json")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        A.normalize(spark, _files(spark, [(f"file:{p}", "c", "d", "2024-06-01")]))


def _gold_inputs(spark, tmp_path):
    t = A.normalize(spark, _files(spark, [(_write(tmp_path, "instances_val2017.json", INSTANCES), "coco", "ann", "2024-06-01")]))
    return t["coco_annotations"], t["coco_categories"], t["coco_images"]


@pytest.mark.parametrize("lacking", ["images", "categories", "annotations"])
def test_missing_array_fails(spark, tmp_path, lacking):
    doc = {k: v for k, v in INSTANCES.items() if k != lacking}
    with pytest.raises(Exception, match="without"):
        A.normalize(spark, _files(spark, [(_write(tmp_path, "instances_x.json", doc), "c", "d", "2024-06-01")]))


def test_gold_unknown_category_dropped(spark, tmp_path):
    ann, cat, _ = _gold_inputs(spark, tmp_path)
    small = sorted(tuple(r) for r in gold.category_stats(ann, cat, "val2017").collect())
    assert [(r[3], r[6], r[7]) for r in small] == [(1, 1, 1), (2, 1, 1)]  # category 99 dropped
    labels = gold.per_image_labels(ann, cat).first()
    assert (labels.n_annotations, labels.n_categories, labels.categories) == (2, 2, "dog,person")


def test_gold_duplicate_category_rows_multiply_like_join_then_aggregate(spark, tmp_path):
    ann, cat, _ = _gold_inputs(spark, tmp_path)
    dup = cat.unionByName(cat.where("category_id = 1"))
    r = {x.category_id: x for x in gold.category_stats(ann, dup, "v").collect()}
    assert r[1].n_annotations == 2 and r[1].n_images == 1 and r[1].avg_area == 12.0


def test_category_stats_keeps_splits_apart(spark, tmp_path):
    ann, cat, _ = _gold_inputs(spark, tmp_path)
    both = lambda df: df.unionByName(df.withColumn("split", F.lit("train2017")))
    rows = gold.category_stats(both(ann), both(cat), "v").collect()
    assert sorted((r.category_id, r.n_annotations, r.n_images) for r in rows) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (2, 1, 1)]


def test_ml_manifest_gives_a_row_per_metadata_row_of_a_name(spark, tmp_path):
    ann, cat, img = _gold_inputs(spark, tmp_path)
    meta = spark.createDataFrame(
        [("coco", "val2017", "k1", "1.jpg", None, 1, "s"), ("coco", "val2017", "k2", "1.jpg", None, 1, "s")],
        "partner string, dataset string, bronze_key string, file_name string, thumbnail_key string, size_bytes long, sha256 string",
    ).withColumn("ingest_date", F.to_date(F.lit("2024-06-01")))
    ok = gold.ml_manifest(img, meta.where("bronze_key = 'k1'"), ann, cat).collect()
    assert [(r.image_id, r.bronze_key, r.n_annotations) for r in ok] == [(1, "k1", 2)]
    twice = gold.ml_manifest(img, meta, ann, cat)
    assert sorted((r.bronze_key, r.n_annotations) for r in twice.collect()) == [("k1", 2), ("k2", 2)] and twice.count() == 2
    assert [(r.file_name, r.n_rows) for r in gold.repeated_file_names(meta).collect()] == [("1.jpg", 2)]


def _tricky_doc(seed):
    import random

    rnd = random.Random(seed)
    words = ['a]b', 'c}d', 'q"u"o', 'back\\\\slash', 'x\\\\', '\\\\"', '[{,}]', 'ß', '日本', ':', ',']
    def text():
        return "".join(rnd.choice(words) for _ in range(rnd.randint(0, 4)))
    return {
        "info": {"desc": text(), "nested": [[1, [2, {"k": text()}]], "]"]},
        "images": [{"id": i, "file_name": text() + ".jpg", "width": rnd.randint(1, 999), "height": 3} for i in range(rnd.randint(0, 30))],
        "licenses": [{"name": text()}],
        "annotations": [
            {"id": i, "image_id": rnd.randint(0, 5), "category_id": 1, "bbox": [rnd.random(), 2, 3, 4], "area": rnd.random() * 1e6,
             "iscrowd": rnd.randint(0, 1), "segmentation": [[rnd.random() for _ in range(rnd.randint(0, 6))]], "note": text()}
            for i in range(rnd.randint(0, 60))
        ],
        "categories": [{"id": 1, "name": text(), "supercategory": text()}],
    }


def test_paths_with_odd_characters_and_no_documents(spark, tmp_path):
    folder = tmp_path / "_hidden a+b %41 ü"
    folder.mkdir()
    p = _write(folder, "captions_x y+z.json", {"annotations": [{"id": 1, "image_id": 2, "caption": "c"}], "info": {"x": [1]}})
    got = A.normalize(spark, _files(spark, [(p, "c", "d", "2024-06-01"), (p, "c", "d", "2024-06-01")]))["coco_captions"].collect()
    assert [(r.split, r.caption_id, r.caption) for r in got] == [("x y+z", 1, "c")]
    none = A.normalize(spark, _files(spark, [(p, "c", "d", "2024-06-01")]).limit(0))
    assert {n: t.count() for n, t in none.items()} == dict.fromkeys(["coco_images", "coco_categories", "coco_annotations", "coco_captions"], 0)
    assert none["coco_annotations"].columns[-7:] == ["category_id", "bbox_x", "bbox_y", "bbox_w", "bbox_h", "area", "iscrowd"]
