"""Web archives: WARC records in ZIP packages, written and read by range.

A package holds two stored members: ``archive/data.warc.gz``, one compressed block per record, and
``indexes/index.cdxj``, a line per record with its offset and length.  The reader never
extracts: it parses the package's central directory (the ZIP64 one where sizes need it), finds
where the stored members begin, takes the places of the records from the index (or, without
one, from a scan of the member), and fetches each record by its range.

Records with equal payloads are written once; the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import prepare, written
from quarry.operators.bronze import _open, _open_out
from quarry.operators.joins import spread, work_of

#: A package is closed beyond so many bytes of records, or so many records.
PACKAGE_BYTES, PACKAGE_RECORDS = 128 << 20, 100_000
#: A task of the reader fetches records from stretches of about this many bytes.
STRETCH_BYTES = 32 << 20
#: Payloads that so large a part of all rows share are joined by broadcast (so at most this many of them).
HOT_PARTS = 1_000

# fixed values of the formats
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64, CENTRAL, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# ---------------------------------------------------------------------------------------
# the ZIP package


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    header_at: int
    packed: int
    size: int


def _read_at(fh, at: int, n: int) -> bytes:
    fh.seek(at)
    data = fh.read(n)
    if len(data) != n:
        raise ValueError(f"the package ends at {at + len(data)}, {at + n} wanted")
    return data


def _size_of(fh) -> int:
    fh.seek(0, 2)
    return fh.tell()


def _end_at(tail: bytes) -> int:
    """Where the end record begins whose comment fills the rest; a signature within a comment is passed over."""
    at = len(tail)
    while (at := tail.rfind(struct.pack("<I", END), 0, at)) >= 0:
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    return at


def directory(fh) -> list[Member]:
    """The members listed by the central directory, ZIP64 or not; bytes before the package are allowed."""
    size = _size_of(fh)
    tail_at = max(0, size - (22 + 0xFFFF))
    tail = _read_at(fh, tail_at, size - tail_at)
    at = _end_at(tail)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    entries, cd_size, cd_at = struct.unpack_from("<HII", tail, at + 10)
    end_at = tail_at + at
    if 0xFFFF == entries or 0xFFFFFFFF in (cd_size, cd_at):
        locator = _read_at(fh, end_at - 20, 20) if end_at >= 20 else b"\0" * 20
        if struct.unpack_from("<I", locator)[0] == LOCATOR64:
            (claimed,) = struct.unpack_from("<Q", locator, 8)
            # where the package does not begin the file, the record still sits before its locator
            for at64 in (claimed, end_at - 20 - 56):
                record = _read_at(fh, at64, 56) if 0 <= at64 <= end_at - 76 else b""
                if record and struct.unpack_from("<I", record)[0] == END64:
                    entries, cd_size, cd_at = struct.unpack_from("<QQQ", record, 32)
                    end_at = at64
                    break
            else:
                raise ValueError("no ZIP64 end of central directory where its locator says")
    before = end_at - cd_size - cd_at  # bytes before the package
    if before < 0:
        raise ValueError("the central directory does not fit into the package")
    raw, at, out = _read_at(fh, cd_at + before, cd_size), 0, []
    for _ in range(entries):
        if struct.unpack_from("<I", raw, at)[0] != CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        (header_at,) = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        full, packed, header_at = _wide(extra, full, packed, header_at)
        if flags & 1:
            raise ValueError(f"{name} is encrypted")
        out.append(Member(name, method, header_at + before, packed, full))
        at += 46 + n_name + n_extra + n_comment
    return out


def _wide(extra: bytes, *fields: int) -> list[int]:
    """The fields, those at their 32-bit limit taken from the ZIP64 extra field in order."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = extra[at + 4 : at + 4 + n]
        at += 4 + n
    out, at = [], 0
    for value in fields:
        if value == 0xFFFFFFFF and at + 8 <= len(wide):
            (value,) = struct.unpack_from("<Q", wide, at)
            at += 8
        out.append(value)
    return out


def data_at(fh, member: Member) -> int:
    """Where the member's bytes begin (the local header has name and extra field lengths of its own)."""
    header = _read_at(fh, member.header_at, 30)
    if struct.unpack_from("<I", header)[0] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.header_at + 30 + n_name + n_extra


def _is_archive(name: str) -> bool:
    return name.lower().endswith((".warc", ".warc.gz"))


def _index_lines(fh, member: Member) -> Iterator[dict]:
    data = _read_at(fh, data_at(fh, member), member.packed)
    if member.method == 8:
        data = zlib.decompress(data, -15)
    elif member.method != 0:
        raise ValueError(f"{member.name} is compressed by method {member.method}")
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    for line in data.splitlines():
        brace = line.find(b"{")
        if brace >= 0 and not line.startswith(b"!"):
            yield json.loads(line[brace:])


def _scan(fh, base: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of each record of a member without index."""
    at = 0
    while at < size:
        if _read_at(fh, base + at, 2) == b"\x1f\x8b":
            inflate, n = zlib.decompressobj(31), 0
            while not inflate.eof:
                part = _read_at(fh, base + at + n, min(1 << 20, size - at - n))
                if not part:
                    raise ValueError("the last record is cut off")
                inflate.decompress(part)
                n += len(part)
            n -= len(inflate.unused_data)
        else:
            head = b""
            while b"\r\n\r\n" not in head:
                part = _read_at(fh, base + at + len(head), min(1 << 14, size - at - len(head)))
                if not part:
                    raise ValueError("the last record is cut off")
                head += part
            fields = head[: head.index(b"\r\n\r\n")]
            length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", fields)
            n = len(fields) + 4 + int(length[1]) + 4
        yield at, n
        at += n


def places(path: str) -> list[tuple[str, int, int]]:
    """(member, first byte in the package, length) of every record of one package."""
    with _open(path) as fh:
        members = directory(fh)
        archives = {m.name: m for m in members if _is_archive(m.name)}
        for m in archives.values():
            if m.method != 0:
                raise ValueError(f"{m.name} is not stored, its records have no ranges")
        bases = {name: data_at(fh, m) for name, m in archives.items()}
        out, indexed = [], set()
        for m in members:
            if m.name.startswith("indexes/") and m.name.lower().endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")):
                for line in _index_lines(fh, m):
                    name = next(n for n in archives if n == line["filename"] or n.endswith("/" + line["filename"]))
                    indexed.add(name)
                    out.append((name, bases[name] + int(line["offset"]), int(line["length"])))
        for name, m in archives.items():
            if name not in indexed:
                out += [(name, bases[name] + at, n) for at, n in _scan(fh, bases[name], m.size)]
    return out


# ---------------------------------------------------------------------------------------
# WARC records


def base32(hex_digest: Column) -> Column:
    """A SHA-1 in hex as 32 characters of base 32, ten hex digits at a time."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), digits, BASE32)


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC record.  ``row``: id, url, digest and length of the full payload, payload (None for a
    revisit), refers_to and refers_url of a revisit."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['length']}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if row["payload"] is not None else "revisit"), ("WARC-Record-ID", f"<{row['id']}>"), ("WARC-Date", date)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~")))
    if row["payload"] is None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{row['refers_to']}>")]
        if row["refers_url"] is not None:
            fields.append(("WARC-Refers-To-Target-URI", quote(row["refers_url"], safe="!#$%&'()*+,/:;=?@[]~")))
    else:
        block += row["payload"]
    fields += [
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(raw: bytes) -> dict:
    """The parts of one record; block and payload digests are checked."""
    if raw[:2] == b"\x1f\x8b":
        raw = zlib.decompress(raw, 31)
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record at this place")
    f = _fields(head)
    n = int(f["content-length"])
    block = rest[:n]
    if len(block) != n:
        raise ValueError(f"record {f.get('warc-record-id')} is cut off")
    claimed = f.get("warc-block-digest")
    if claimed and claimed.startswith("sha1:") and claimed[5:] != _sha1(block):
        raise ValueError(f"record {f.get('warc-record-id')} differs from its block digest")
    payload, length = None, None
    if f.get("content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        told = _fields(http).get("content-length")
        length = int(told) if told is not None else len(body)
        payload = body
    else:
        payload, length = block, n
    digest = f.get("warc-payload-digest")
    digest = digest[5:] if digest and digest.startswith("sha1:") else None
    if f["warc-type"] == "revisit":
        payload = None
    else:
        own = _sha1(payload)
        if digest is not None and digest != own:
            raise ValueError(f"record {f.get('warc-record-id')} differs from its payload digest")
        digest, length = own, len(payload)
    return {
        "record_id": f["warc-record-id"].strip("<>"), "record_type": f["warc-type"], "url": f.get("warc-target-uri"), "date": f.get("warc-date"),
        "refers_to": f["warc-refers-to"].strip("<>") if "warc-refers-to" in f else None, "payload_digest": digest, "payload_bytes": length,
        "payload": payload,
    }


# ---------------------------------------------------------------------------------------
# Spark jobs

CAPTURE = "id string, url string, payload binary, digest string, length long, refers_to string, refers_url string"


def captures(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Records to write (``CAPTURE``), one per row of ``pages``.

    Rows with equal payloads of ``least`` bytes or more have one response, the row with the largest
    key (of rows that repeat it one); the others refer to it and carry no payload.  A
    payload that a large part of all rows shares is looked up by broadcast, so no join has a hot key."""
    prepare(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(key).alias("order"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.select(
        "*",
        F.monotonically_increasing_id().alias("row"),
        F.octet_length("payload").cast("long").alias("length"),
        base32(F.sha1("payload")).alias("digest"),
        F.sha2("payload", 256).alias("same"),
    )
    rows = written(rows, "captures")
    lead = F.max(F.struct("order", "row", "key", "url", "digest")).alias("lead")
    groups = rows.where(F.col("length") >= least).groupBy("same").agg(lead, F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = written(groups.select("same", "n", "lead.row", "lead.key", "lead.url", "lead.digest"), "payload-groups")
    of_lead = [F.col(c).alias(f"lead_{c}") for c in ("row", "key", "url", "digest")]
    hot = F.col("n") >= F.lit(max(2, -(-rows.count() // HOT_PARTS)))
    frequent = groups.where(hot).select(F.col("same").alias("_same"), F.struct(*of_lead).alias("hot"))  # HOT_PARTS rows at most
    others = groups.where(~hot).select(F.col("same").alias("_rare"), F.struct(*of_lead).alias("rare"))
    found = rows.join(F.broadcast(frequent), F.col("same") == F.col("_same"), "left").drop("_same")
    # a row whose payload is frequent has its answer: it joins the rest under a key of its own
    by = F.when(F.col("hot").isNotNull(), F.concat(F.lit("row "), F.col("row"))).otherwise(F.col("same"))
    found = found.withColumn("_by", by).join(others, F.col("_by") == F.col("_rare"), "left")
    found = found.withColumn("lead", F.coalesce("hot", "rare"))
    again = F.coalesce(F.col("lead.lead_row") != F.col("row"), F.lit(False))
    name = lambda k, d: F.concat(F.lit("urn:x-capture:"), F.coalesce(k, F.lit("")), F.lit(":"), d)
    own = name(F.col("key"), F.col("digest"))
    return found.select(
        F.when(again, F.concat(own, F.lit(":again:"), F.col("row"))).otherwise(own).alias("id"),
        "url",
        F.when(~again, F.col("payload")).alias("payload"),
        "digest",
        "length",
        F.when(again, name(F.col("lead.lead_key"), F.col("lead.lead_digest"))).alias("refers_to"),
        F.when(again, F.col("lead.lead_url")).alias("refers_url"),
    )


class _Package:
    """One package while it is written."""

    def __init__(self, path: str):
        self.path, self.index, self.size = path, [], 0
        self.fh = _open_out(path)
        self.zip = zipfile.ZipFile(self.fh, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(MEMBER, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True)

    def add(self, row: dict, date: str) -> None:
        packed = gzip.compress(record_bytes(row, date), 1, mtime=0)
        self.member.write(packed)
        entry = {"url": row["url"], "digest": f"sha1:{row['digest']}", "length": str(len(packed)), "offset": str(self.size), "filename": "data.warc.gz"}
        self.index.append(f"{quote(row['url'] or '-', safe=':/?&=')} {re.sub('[^0-9]', '', date)[:14]} {json.dumps(entry)}\n")
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX, (2024, 1, 1, 0, 0, 0)), "".join(sorted(self.index)))
        self.zip.close()
        self.fh.close()
        return self.path, len(self.index), self.size


def write_packages(records: DataFrame, root: str) -> DataFrame:
    """Writes ``records`` (columns of ``CAPTURE``) into packages below ``root``: (archive, records, bytes) of each.

    A task writes packages under names of its own attempt, so one that is repeated never meets
    its earlier files; the rows of the attempt that counts name the packages that count."""
    prepare(records.sparkSession)
    date = dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None

        def closed():
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in package.close()], ["archive", "records", "bytes"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if package is None:
                    package = _Package(f"{root.rstrip('/')}/{uuid.uuid4().hex}.wacz")
                package.add(row, date)
                if package.size >= PACKAGE_BYTES or len(package.index) >= PACKAGE_RECORDS:
                    yield closed()
                    package = None
        if package is not None:
            yield closed()

    return records.mapInArrow(run, "archive string, records long, bytes long")


RECORD = "archive string, record_id string, record_type string, url string, date string, refers_to string, payload_digest string, payload_bytes long"


def read_packages(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records (``RECORD`` and, if wanted, payload) of the packages that ``archives`` (archive) names.

    First the directories and indexes are read, a small row per record (when the frame is built); these are dealt
    by stretches of the packages over as many tasks as their bytes ask for, so a package of any size is
    fetched by many tasks, each reading its ranges in order.  A record that is damaged fails the job.  Revisits have no payload; their digest and length are the full one's."""
    prepare(archives.sparkSession)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                found = places(path)
                for i in range(0, len(found), 50_000):
                    _, at, n = zip(*found[i : i + 50_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(at)), pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["archive", "at", "length"])

    names = [part.split()[0] for part in RECORD.split(", ")] + (["payload"] if payloads else [])
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, fh = None, None
        for batch in batches:
            out, held = [], 0
            for path, at, n in zip(*(batch.column(c).to_pylist() for c in ("archive", "at", "length")), strict=True):
                if path != current:
                    if fh is not None:
                        fh.close()
                    current, fh = path, _open(path)
                out.append({"archive": path, **parse_record(_read_at(fh, at, n))})
                held += len(out[-1]["payload"] or b"") if payloads else 200
                if held >= 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kinds.get(c, pa.string())) for c in names], names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kinds.get(c, pa.string())) for c in names], names)
        if fh is not None:
            fh.close()

    listed = spread(archives.select("archive"), ["archive"]).mapInArrow(locate, "archive string, at long, length long")
    listed = written(listed.withColumn("stretch", F.floor(F.col("at") / STRETCH_BYTES)), "places")
    dealt = spread(listed, ["archive", "stretch"], *work_of(listed, F.col("length"))).sortWithinPartitions("archive", "at")
    return dealt.drop("stretch").mapInArrow(fetch, RECORD + (", payload binary" if payloads else ""))


def archive_pages(pages: DataFrame, root: str, least: int = 0) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html), written as WARC records into packages below ``root``
    and read back: page_id, payload_bytes, payload_digest (SHA-1 in base 32), record_type, refers_to, url, archive.

    A null html is an empty payload, a null url leaves the record without one, a null page_id comes before
    all others.  Of equal payloads of ``least`` bytes or more the row with the largest page_id is the
    response; of rows that repeat page_id and payload one is, the others revisit it (and refer
    to their own page_id).  Other columns are ignored; an empty table gives no rows."""
    packages = written(write_packages(captures(pages, least=least), root), "packages")
    records = read_packages(packages, payloads=False)
    key = lambda c: F.nullif(F.regexp_extract(c, "^urn:x-capture:(-?[0-9]*):", 1), F.lit("")).cast("long")
    return records.select(key(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", key(F.col("refers_to")).alias("refers_to"), "url", "archive")
