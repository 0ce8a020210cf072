"""Archive unpacking on generated zips: folder entry, duplicate entry, '..' path, empty
archive, corrupt archive, CRC mismatch."""

import os
import zipfile
import zlib


from quarry.operators import bronze


def _zip(path, entries):
    with zipfile.ZipFile(path, "w") as zf:
        for name, data in entries:
            zf.writestr(name, data)


def test_unpack_cases(spark, tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    _zip(d / "good.zip", [("imgs/", b""), ("imgs/a.jpg", b"A" * 10), ("ann/instances_val.json", b"{}")])
    _zip(d / "evil.zip", [("ok.txt", b"x"), ("../escape.txt", b"y")])
    _zip(d / "empty.zip", [])
    with zipfile.ZipFile(d / "dup.zip", "w") as zf:
        zf.writestr("same.txt", b"one")
        zf.writestr("same.txt", b"two")
    (d / "corrupt.zip").write_bytes(b"PK\x03\x04 not really a zip")
    archives = spark.read.format("binaryFile").load(str(d)).select("path")
    rows = {(os.path.basename(r.archive_path), r.pos): r for r in bronze.unpack(archives, partitions=3).collect()}

    assert rows[("good.zip", 0)].path == "imgs/a.jpg"  # folder entry skipped
    assert rows[("good.zip", 0)].content == b"A" * 10
    assert rows[("good.zip", 0)].crc32 == zlib.crc32(b"A" * 10)
    assert rows[("good.zip", 1)].size_bytes == 2
    assert rows[("evil.zip", 1)].error.startswith("unsafe entry name")
    assert rows[("evil.zip", 0)].error is None
    assert not any(k[0] == "empty.zip" for k in rows)
    assert {rows[("dup.zip", 0)].path, rows[("dup.zip", 1)].path} == {"same.txt"}
    assert rows[("corrupt.zip", -1)].error

    outcome = {os.path.basename(r.archive_path): r for r in bronze.drop_outcome(bronze.list_entries(archives)).collect()}
    assert outcome["good.zip"].status == "DONE" and outcome["good.zip"].file_count == 2
    assert outcome["evil.zip"].status == "FAILED"
    assert outcome["corrupt.zip"].status == "FAILED"


def test_crc_mismatch_is_an_entry_error(spark, tmp_path):
    p = tmp_path / "bad.zip"
    _zip(p, [("f.txt", b"hello world")])
    raw = bytearray(p.read_bytes())
    i = raw.find(b"hello world")
    raw[i] = ord("j")
    p.write_bytes(bytes(raw))
    archives = spark.read.format("binaryFile").load(str(p)).select("path")
    r = bronze.unpack(archives).first()
    assert r.content is None and "CRC" in r.error


def test_bronze_objects_keys_and_types(spark, tmp_path):
    p = tmp_path / "drop.zip"
    _zip(p, [("a/x.PNG", b"1"), ("b/readme", b"22")])
    archives = spark.read.format("binaryFile").load(str(p)).select("path")
    objs = bronze.bronze_objects(bronze.unpack(archives), "coco", "drop", "2024-06-01").orderBy("pos").collect()
    assert [o.key for o in objs] == [
        "partner=coco/dataset=drop/ingest_date=2024-06-01/a/x.PNG",
        "partner=coco/dataset=drop/ingest_date=2024-06-01/b/readme",
    ]
    assert [o.content_type for o in objs] == ["image/png", "application/octet-stream"]
    assert objs[0].ingest_date.isoformat() == "2024-06-01"


def test_one_archive_is_extracted_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    p = tmp_path / "big.zip"
    _zip(p, [(f"img/{i:03d}.jpg", bytes([i]) * (100 + i)) for i in range(40)])
    archives = spark.read.format("binaryFile").load(str(p)).select("path")
    out = bronze.extract(bronze.list_entries(archives), partitions=4).withColumn("task", F.spark_partition_id())
    rows = out.collect()
    assert sorted(r.pos for r in rows) == list(range(40))
    assert all(r.content == bytes([r.pos]) * (100 + r.pos) for r in rows)
    assert len({r.task for r in rows}) > 1  # the hot archive is spread, not one task


def test_objects_larger_than_a_piece_are_copied_whole_in_bounded_memory(tmp_path, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(bronze, "COPY_BYTES", 1 << 20)
    size = 64 << 20
    os.makedirs(tmp_path / "in")
    with open(tmp_path / "in" / "big.bin", "wb") as f:
        f.seek(size - 1)
        f.write(b"x")
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.write(tmp_path / "in" / "big.bin", "big.bin")
    copies = pa.RecordBatch.from_pylist([{"drop_id": "d", "key": "big.bin", "bronze_key": "out/b"}, {"drop_id": "e", "key": "none", "bronze_key": "out/n"}])
    entry = {"archive_path": str(tmp_path / "a.zip"), "pos": 0, "path": "big.bin", "size_bytes": size, "crc32": 0, "error": None, "keys": ["un/1", "un/2"]}
    tracemalloc.start()
    rows = [r for b in bronze._copy_batches(str(tmp_path / "in"), str(tmp_path))(iter([copies])) for r in b.to_pylist()]
    rows += [r for b in bronze._unpack_batches(str(tmp_path))(iter([pa.RecordBatch.from_pylist([entry])])) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    assert [r["error"] is None for r in rows] == [True, False, True, True]
    assert all((tmp_path / p).stat().st_size == size for p in ("out/b", "un/1", "un/2")) and not (tmp_path / "out/n").exists()


def test_a_failed_copy_leaves_no_object(tmp_path):
    import io

    class Broken(io.BytesIO):
        def read(self, n=-1):
            if self.tell():
                raise OSError("lost")
            return super().read(3)

    try:
        bronze._stream(Broken(b"abcdef"), str(tmp_path / "x"))
    except OSError:
        pass
    assert not (tmp_path / "x").exists()
