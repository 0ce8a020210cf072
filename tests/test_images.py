"""Image header profiling and thumbnails on generated images (PNG from struct + zlib, a
hand-made JPEG header with EXIF)."""

import struct
import zlib

import numpy as np
import pytest

from quarry.functions import image_headers as H
from quarry.operators import images as I


def png(w, h, ctype=0, depth=8, exif=None, truncate=0):
    ch = {0: 1, 2: 3, 4: 2, 6: 4}[ctype]
    raw = b"".join(b"\x00" + bytes(w * ch) for _ in range(h))

    def chunk(k, d):
        return struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))

    body = chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, ctype, 0, 0, 0))
    if exif is not None:
        body += chunk(b"eXIf", exif)
    data = b"\x89PNG\r\n\x1a\n" + body + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    return data[: len(data) - truncate] if truncate else data


def tiff_exif(make=None, orientation=None):
    entries = []
    extra = b""
    base = 8 + 2 + 12 * 2 + 4
    if make is not None:
        m = make.encode() + b"\x00"
        entries.append(struct.pack("<HHII", 271, 2, len(m), base + len(extra)))
        extra += m
    if orientation is not None:
        entries.append(struct.pack("<HHIHH", 274, 3, 1, orientation, 0))
    while len(entries) < 2:
        entries.append(struct.pack("<HHII", 0, 0, 0, 0))
    return b"II*\x00" + struct.pack("<I", 8) + struct.pack("<H", 2) + b"".join(entries) + struct.pack("<I", 0) + extra


def jpeg(w, h, comps=3, exif=None):
    out = b"\xff\xd8"
    if exif is not None:
        payload = b"Exif\x00\x00" + exif
        out += b"\xff\xe1" + struct.pack(">H", len(payload) + 2) + payload
    out += b"\xff\xc0" + struct.pack(">HBHHB", 8 + 3 * comps, 8, h, w, comps) + bytes(3 * comps)
    return out + b"\xff\xda\x00\x02" + b"\x00" * 10 + b"\xff\xd9"


@pytest.mark.parametrize(
    "data,expect",
    [
        (png(640, 480), ("PNG", 640, 480, "L")),
        (png(10, 7, ctype=6), ("PNG", 10, 7, "RGBA")),
        (png(3000, 20, ctype=2), ("PNG", 3000, 20, "RGB")),
        (png(5, 5, ctype=0, depth=1), ("PNG", 5, 5, "1")),
        (jpeg(800, 600), ("JPEG", 800, 600, "RGB")),
        (jpeg(32, 16, comps=1), ("JPEG", 32, 16, "L")),
        (b"GIF89a" + struct.pack("<HHB", 12, 9, 0x80) + b"\x00" * 10, ("GIF", 12, 9, "P")),
        (b"BM" + b"\x00" * 12 + struct.pack("<IiiHH", 40, 20, -10, 1, 24) + b"\x00" * 30, ("BMP", 20, 10, "RGB")),
    ],
)
def test_read_header(data, expect):
    assert H.read_header(data)[:4] == expect


def test_exif_tags_and_orientation_zero():
    fmt, w, h, mode, exif = H.read_header(jpeg(4, 4, exif=tiff_exif("Canon", 6)))
    assert exif == {271: "Canon", 274: 6}


def told(head, tail, size):
    return dict(zip(I.HEADER.fieldNames(), I.read_one(head, tail, size), strict=True))


def test_thumbnail_dims_by_definition(spark):
    import random
    from fractions import Fraction

    rnd = random.Random(3)
    sizes = [(640, 480), (100, 50), (3000, 20), (300, 100), (200, 300), (1, 5000), (5000, 1), (256, 256), (257, 3), (257, 257), (512, 3)]
    sizes += [(rnd.randint(1, 4000), rnd.randint(1, 4000)) for _ in range(400)]
    df = spark.createDataFrame(sizes, "width long, height long").coalesce(1)
    got = [(r.thumb_width, r.thumb_height) for r in I.thumbnail_dims(df).collect()]
    assert got[:6] == [(256, 192), (100, 50), (256, 2), (256, 85), (171, 256), (1, 256)]
    for (w, h), (tw, th) in zip(sizes, got, strict=True):
        if max(w, h) <= 256:
            assert (tw, th) == (w, h)
            continue
        exact = Fraction(256 * min(w, h), max(w, h))
        around = {max(1, exact.__floor__()), max(1, exact.__ceil__())}
        fits = [(n, 256) if h >= w else (256, n) for n in sorted(around)]
        assert (tw, th) == min(fits, key=lambda s: abs(Fraction(w, h) - Fraction(*s)))


def test_end_of_file_markers():
    whole = jpeg(30, 20)
    profiled = lambda b: told(b, b[-16:], len(b))["problem"]
    assert profiled(whole) is None and profiled(whole + b"\0" * 8) is None and profiled(whole + b"x" * 500) is None
    assert profiled(whole[:-2]) == H.TRUNCATED
    gif = b"GIF89a" + struct.pack("<HHB", 12, 9, 0x80) + b"\x00" * 10
    assert profiled(gif) == H.TRUNCATED and profiled(gif + b";") is None and profiled(gif + b";\0\0") is None
    # last bytes that do not tell ask for the whole file
    assert told(whole[:40], b"x" * 16, 5000)["unsure"]


def test_profile_job_cases(spark):
    objs = [
        ("p/grey.png", png(640, 480)),
        ("p/rgba.png", png(10, 7, ctype=6)),
        ("p/trunc.png", png(64, 64, truncate=20)),
        ("p/fake.jpg", b"this is not an image at all"),
        ("p/exif.jpg", jpeg(40, 30, exif=tiff_exif("Nikon", 6))),
        ("p/big-header.jpg", jpeg(9, 9, exif=tiff_exif("X", 1) + b"\x00" * 5000)),
        ("p/zero.png", png(4, 4, exif=tiff_exif(None, 0))),
    ]
    df = spark.createDataFrame(objs, "bronze_key string, content binary")
    # a small head forces the second, full-content pass for the long header
    meta = {r.bronze_key: r for r in I.image_metadata(df, "acme", "d", "2024-06-01").collect()}
    assert (meta["p/grey.png"].width, meta["p/grey.png"].mode, meta["p/grey.png"].format) == (640, "L", "PNG")
    assert meta["p/grey.png"].thumbnail_key == "thumbnails/partner=acme/dataset=d/ingest_date=2024-06-01/grey.jpg"
    assert meta["p/trunc.png"].width == 64 and meta["p/trunc.png"].error == H.TRUNCATED
    assert meta["p/trunc.png"].thumbnail_key is None
    assert meta["p/fake.jpg"].width is None and meta["p/fake.jpg"].error == H.UNKNOWN
    assert (meta["p/exif.jpg"].exif_make, meta["p/exif.jpg"].exif_orientation) == ("Nikon", 6)
    assert (meta["p/zero.png"].exif_make, meta["p/zero.png"].exif_orientation) == (None, None)  # orientation 0 counts as absent
    assert meta["p/exif.jpg"].size_bytes == len(objs[4][1])
    import hashlib

    assert meta["p/exif.jpg"].sha256 == hashlib.sha256(objs[4][1]).hexdigest()
    small = {r.bronze_key: r for r in I.profile(df, head_bytes=64).collect()}
    assert small["p/big-header.jpg"].width == 9 and small["p/big-header.jpg"].error is None


def test_thumbnails_from_image_source(spark, tmp_path):
    (tmp_path / "wide.png").write_bytes(png(640, 480, ctype=2))
    (tmp_path / "small.png").write_bytes(png(100, 50))
    imgs = spark.read.format("image").load(str(tmp_path))
    th = {r.origin.rsplit("/", 1)[-1]: r for r in I.thumbnails(imgs).collect()}
    assert (th["wide.png"].width, th["wide.png"].height) == (256, 192)
    assert (th["small.png"].width, th["small.png"].height) == (100, 50)
    assert H.read_header(th["wide.png"].content)[:4] == ("PNG", 256, 192, "RGB")


def test_resize_area_average():
    img = np.arange(16, dtype=np.uint8).reshape(4, 4)
    assert I.resize_area(img, 2, 2).tolist() == [[2, 4], [10, 12]]


def test_missing_thumbnails_with_reasons(spark, tmp_path):
    from quarry import jobs

    whole = png(40, 30, ctype=2)
    body = whole.index(b"IDAT") + 4
    files = {
        "good.PNG": whole,
        "after-the-end.png": whole + bytes(32),
        "broken-body.png": whole[:body] + bytes(8) + whole[body + 8 :],
        "four-inks.JPG": jpeg(16, 16, comps=4) + b"\xff\xd9",
        "cut.png": whole[:-20],
    }
    prefix = "partner=acme/dataset=d/ingest_date=2024-06-01/"
    layout = jobs.Layout(str(tmp_path))
    folder = tmp_path / "bronze" / prefix
    folder.mkdir(parents=True)
    for name, content in files.items():
        (folder / name).write_bytes(content)
    df = spark.createDataFrame([(prefix + n, bytearray(c)) for n, c in files.items()], "bronze_key string, content binary")
    meta = I.image_metadata(df, "acme", "d", "2024-06-01")
    assert meta.where("thumbnail_key is null").count() == 1  # the one cut short
    assert jobs.write_thumbnails(spark, layout, meta) == 4
    stored = spark.read.parquet(layout.thumbnails)

    def lacking(thumbnails):
        return {r.bronze_key[len(prefix) :]: r.reason for r in jobs.missing_thumbnails(meta, thumbnails).collect()}

    refused = dict.fromkeys(["broken-body.png", "four-inks.JPG"], "not decodable by the image source")
    assert lacking(stored) == refused
    assert lacking(stored.where("bronze_key not like '%good%'")) == refused | {"good.PNG": "no row"}
