import base64
import hashlib
import io
import struct
import zipfile

import pytest

from quarry.llm import warc as W
from quarry.session import scratch_path

SCHEMA = "page_id long, url string, html string, id string, digest string, row long, lead int, hot int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1, 2, 3) for i, u, h in rows], SCHEMA).repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    """(page_id, bytes, digest, type, refers_to); of rows that repeat page and payload one is the response."""
    out, done = [], set()
    lead = {}
    for i, _, h in rows:
        key = h or ""
        lead[key] = max(lead.get(key, (-1, i)), (-1 if i is None else i, i), key=lambda p: p[0])
    for i, _, h in rows:
        key = h or ""
        size = len(key.encode())
        first = (key, i) not in done
        done.add((key, i))
        alone = size < least or (i == lead[key][1] and first)
        out.append((i, size, digest(h), "response" if alone else "revisit", None if alone else lead[key][1]))
    return sorted(out, key=repr)


ROWS = [
    (1, "https://a.example/ü?q=a b\r\nX: y", "<p>one</p>"), (2, "https://a.example/2", "<p>same</p>"), (3, None, "<p>same</p>"), (9, "u", "<p>same</p>"),
    (4, "u4", None), (5, "u5", ""), (6, "u6", "WARC/1.1\r\n\r\n漢字 🙂 " * 3), (7, "u7", "long " * 400_000), (7, "u7", "long " * 400_000),
    (None, "n", "<p>null id</p>"), (None, "n", "<p>same</p>"), (None, "m", "only null"), (None, "m", "only null"), (11, "u", "x"), (11, "u", "y"), (-5, "u", "minus"), (-6, "u", "minus"),
]


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least", [0, 8])
@pytest.mark.parametrize("package_records", [3, 100_000])
def test_against_brute_force(spark, monkeypatch, least, package_records):
    monkeypatch.setattr(W, "PACKAGE_RECORDS", package_records)
    monkeypatch.setattr(W, "STRETCH_BYTES", 500)
    assert result(W.archive_pages(pages(spark, ROWS), scratch_path(spark, "warc"), least)) == brute(ROWS, least)


def test_hot_and_rare_copies_and_an_empty_table(spark, monkeypatch):
    rows = [(i, "u", "hot") for i in range(300)] + [(1000 + i, "u", f"rare {i % 100}") for i in range(200)] + [(5000 + i, "u", f"alone {i}") for i in range(50)]
    monkeypatch.setattr(W, "HOT_PARTS", 10)
    assert result(W.archive_pages(pages(spark, rows), scratch_path(spark, "warc"))) == brute(rows)
    assert W.archive_pages(pages(spark, rows).limit(0), scratch_path(spark, "warc")).collect() == []


def test_payloads_and_fields_come_back_whole(spark):
    packages = W.write_packages(W.captures(pages(spark, ROWS)), scratch_path(spark, "warc")).collect()
    names = spark.createDataFrame([(p.archive,) for p in packages], "archive string")
    found = {r.record_id: r for r in W.read_packages(names).collect()}
    assert len(found) == len(ROWS) == sum(p.records for p in packages)  # every record has an id of its own
    responses = [r for r in found.values() if r.record_type == "response"]
    assert sorted(bytes(r.payload).decode() for r in responses) == sorted({h or "" for _, _, h in ROWS})
    assert all(found[r.refers_to].payload_digest == r.payload_digest for r in found.values() if r.record_type == "revisit")
    assert {r.url for r in responses if r.record_id.startswith("urn:x-capture:1:")} == {"https://a.example/%C3%BC?q=a%20b%0D%0AX:%20y"}
    with zipfile.ZipFile(packages[0].archive.removeprefix("file:")) as zf:  # another reader agrees that it is a sound package
        assert zf.testzip() is None and zf.namelist() == [W.MEMBER, W.INDEX]


RECORD = dict(id="urn:x:1", url="http://e/", payload=b"abc", digest=digest("abc"), length=3, refers_to=None, refers_url=None)


def package(members, before=b"", comment=b"", method=zipfile.ZIP_STORED, force=False):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", method) as zf:
        for name, data in members:
            with zf.open(name, "w", force_zip64=force) as fh:
                fh.write(data)
        zf.comment = comment
    return before + buf.getvalue()


def zip64(data):
    """The package with every 32-bit field of its directory at the limit, the values in ZIP64 records."""
    end = data.rfind(b"PK\x05\x06")
    n, size, at = struct.unpack_from("<HII", data, end + 10)
    central, out, pos = data[at : at + size], b"", 0
    for _ in range(n):
        packed, full, n_name, n_extra, _ = struct.unpack_from("<IIHHH", central, pos + 20)
        (header,) = struct.unpack_from("<I", central, pos + 42)
        name = central[pos + 46 : pos + 46 + n_name]
        extra = struct.pack("<HHQQQ", 1, 24, full, packed, header)
        other = struct.pack("<HHI", 0x9999, 4, 7)  # a foreign field before it
        fixed = bytearray(central[pos : pos + 46])
        struct.pack_into("<IIHHH", fixed, 20, 0xFFFFFFFF, 0xFFFFFFFF, n_name, len(other + extra), 0)
        struct.pack_into("<I", fixed, 42, 0xFFFFFFFF)
        out += bytes(fixed) + name + other + extra
        pos += 46 + n_name + n_extra
    end64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(out), at)
    locator = struct.pack("<IIQI", 0x07064B50, 0, at + len(out), 1)
    return data[:at] + out + end64 + locator + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)


def read_all(tmp_path, data):
    path = tmp_path / "p.wacz"
    path.write_bytes(data)
    with open(path, "rb") as fh:
        return [W.parse_record(W._read_at(fh, at, n)) for _, at, n in W.places(str(path))]


def test_packages_of_other_writers(tmp_path):
    raw = W.record_bytes(RECORD, "2024-01-01T00:00:00Z")
    import gzip

    packed = gzip.compress(raw)
    line = f'e,)/ 2024 {{"offset": "{len(packed)}", "length": {len(packed)}, "filename": "a.warc.gz"}}\n'.encode()
    for data, want in [
        (package([("archive/a.warc", raw * 3)]), 3),  # no index: scanned
        (package([("archive/a.warc.gz", packed * 3)], before=b"#!stub " * 9, comment=b"PK\x05\x06 in a comment"), 3),
        (package([("archive/a.warc.gz", packed * 2), ("indexes/index.cdx.gz", gzip.compress(b"!meta\n" + line))], force=True), 1),  # as the index says
        (zip64(package([("archive/a.warc.gz", packed * 2), ("other.txt", b"x")])), 2),
        (b"before" * 5 + zip64(package([("archive/a.warc", raw)])), 1),
        (package([("other.txt", b"x")]), 0),
    ]:
        got = read_all(tmp_path, data)
        assert [(r["payload"], r["url"]) for r in got] == [(b"abc", "http://e/")] * want


def test_damage_is_an_error(tmp_path):
    raw = W.record_bytes(RECORD, "2024-01-01T00:00:00Z")
    whole = package([("archive/a.warc", raw)])
    for data in (b"", b"no package at all", whole[:-30], whole.replace(b"abc", b"abd"), package([("archive/a.warc", raw)], method=zipfile.ZIP_DEFLATED), package([("archive/a.warc", raw[:-9])])):
        with pytest.raises(ValueError):
            read_all(tmp_path, data)
