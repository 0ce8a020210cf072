"""Landing archives -> bronze objects + manifests.

Two phases, so one large archive never becomes one task:
1. ``list_entries``: per archive, read only the zip central directory and emit one row per
   entry (name, sizes, CRC, position).  Directory entries are dropped; absolute names and
   names with ``..`` are rejected with an error row (the drop is then FAILED); a corrupt
   archive gives one error row.
2. ``extract`` / ``unpack_to``: the entry rows are dealt over as many tasks as their bytes
   ask for (a hot archive spreads over the cluster), and each task opens the archives it
   needs with random access and reads just its entries; the CRC is verified on read.
   ``unpack_to`` writes each entry as an object in the same task; an entry that cannot be
   read or written is a row with an error, never a failed job.

Archives are opened through ``pyarrow.fs`` from their path, so binary-file size limits do not
apply to them; ``unpack_to`` holds a piece of an entry at a time, ``extract`` whole entries.
"""

from __future__ import annotations

import contextlib
import io
import itertools
import json
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions import keys as K
from quarry.operators.joins import spread
from quarry.session import ship_code

ENTRY_LIST = S.struct(
    ("archive_path", S.S),
    ("pos", S.L),
    ("path", S.S),
    ("size_bytes", S.L),
    ("crc32", S.L),
    ("error", S.S),
)
COPY_BYTES = 8 << 20  # objects are copied in pieces of this size
RUN = 64  # entries below ``COPY_BYTES`` of one archive that one task unpacks together
BATCH_BYTES = 64 << 20  # output Arrow batches of binary content stay below this size

ENTRY_CONTENT = S.struct(*[(f.name, f.dataType) for f in ENTRY_LIST.fields], ("content", S.B))


def _open(path: str):
    """Random-access file for a Spark path (``file:/x``, ``hdfs://``, ``s3a://`` ...)."""
    from pyarrow import fs

    if path.startswith("file:"):
        local = path[len("file:") :]
        while local.startswith("//"):
            local = local[1:]
        return open(local, "rb")
    if path.startswith("s3a://") or path.startswith("s3n://"):
        path = "s3://" + path.split("://", 1)[1]
    if "://" not in path:
        return open(path, "rb")
    filesystem, inner = fs.FileSystem.from_uri(path)
    f = filesystem.open_input_file(inner)
    if f.size() < (1 << 20):  # small archive: whole bytes, bounded
        data = f.read()
        f.close()
        return io.BytesIO(data)
    return f


def _open_out(path: str):
    """Writable stream for a Spark path (used to land archives on shared storage)."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    if "://" not in path:
        import os

        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    filesystem, inner = fs.FileSystem.from_uri(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(inner)


def _unsafe(name: str) -> bool:
    parts = name.replace("\\", "/").split("/")
    return name.startswith("/") or name.startswith("\\") or ".." in parts or (len(name) > 1 and name[1] == ":")


def _list_one(path: str) -> list[dict]:
    rows = []
    try:
        with _open(path) as fh, zipfile.ZipFile(fh) as zf:
            pos = 0
            for info in zf.infolist():
                if info.is_dir():
                    continue
                err = f"unsafe entry name: {info.filename}" if _unsafe(info.filename) else None
                rows.append(
                    {
                        "archive_path": path,
                        "pos": pos,
                        "path": info.filename,
                        "size_bytes": info.file_size,
                        "crc32": info.CRC,
                        "error": err,
                    }
                )
                pos += 1
    except Exception as exc:  # corrupt or unreadable archive: one error row
        rows = [
            {"archive_path": path, "pos": -1, "path": None, "size_bytes": None, "crc32": None, "error": str(exc)[:1000]}
        ]
    return rows


def _list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("archive_path", pa.string()), ("pos", pa.int64()), ("path", pa.string()),
                        ("size_bytes", pa.int64()), ("crc32", pa.int64()), ("error", pa.string())])
    for b in batches:
        for p in b.column("path").to_pylist():
            rows = _list_one(p)
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_pylist(rows[i : i + 10_000], schema=schema)


def list_entries(archives: DataFrame, path_col: str = "path") -> DataFrame:
    """One row per file entry of each archive (no content read)."""
    ship_code(archives.sparkSession)
    return spread(archives.select(F.col(path_col).alias("path")), ["path"]).mapInArrow(_list_batches, ENTRY_LIST)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("archive_path", pa.string()), ("pos", pa.int64()), ("path", pa.string()), ("size_bytes", pa.int64()),
              ("crc32", pa.int64()), ("error", pa.string()), ("content", pa.binary())]
    schema = pa.schema(fields)
    for b in batches:
        out: list[dict] = []
        rows = b.to_pylist()
        rows.sort(key=lambda r: (r["archive_path"], r["pos"]))
        current, fh, zf = None, None, None
        held = 0
        try:
            for r in rows:
                content, err = None, r["error"]
                if err is None:
                    try:
                        if r["archive_path"] != current:
                            if zf is not None:
                                zf.close()
                                fh.close()
                            current = r["archive_path"]
                            fh = _open(current)
                            zf = zipfile.ZipFile(fh)
                        content = zf.read(r["path"])  # raises on a CRC mismatch
                    except Exception as exc:
                        err = str(exc)[:1000]
                out.append({**r, "error": err, "content": content})
                held += len(content or b"")
                if len(out) >= 256 or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
        finally:
            if zf is not None:
                zf.close()
                fh.close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def extract(entries: DataFrame, partitions: int | None = None) -> DataFrame:
    """Entry rows -> entry rows with ``content``; dealt over ``partitions`` tasks first (one
    per core at least)."""
    ship_code(entries.sparkSession)
    keys = ["archive_path", "pos"]
    dealt = entries.repartition(partitions, *keys) if partitions else spread(entries, keys)
    return dealt.mapInArrow(_extract_batches, ENTRY_CONTENT)


WRITTEN = S.struct(("archive_path", S.S), ("key", S.S), ("pos", S.L), ("size_bytes", S.L), ("crc32", S.L), ("error", S.S))


def _stream(source, path: str) -> int:
    """Copies an open file to a new object piece by piece; its size.  What a failed copy leaves is removed."""
    size = 0
    try:
        with _open_out(path) as out:
            while piece := source.read(COPY_BYTES):
                out.write(piece)
                size += len(piece)
    except Exception:
        _remove(path)
        raise
    return size


def _remove(path: str) -> None:
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    filesystem, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    if filesystem.get_file_info(inner).type == fs.FileType.File:
        filesystem.delete_file(inner)


def _unpack_batches(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WRITTEN.fieldNames()
        schema = pa.schema(list(zip(names, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)))
        for b in batches:
            out = []
            by_archive = sorted(b.to_pylist(), key=lambda r: (r["archive_path"], r["pos"]))
            for path, entries in itertools.groupby(by_archive, key=lambda r: r["archive_path"]):
                with contextlib.ExitStack() as stack:
                    archive = problem = None
                    try:
                        archive = stack.enter_context(zipfile.ZipFile(stack.enter_context(_open(path))))
                    except Exception as exc:
                        problem = str(exc)[:1000] or type(exc).__name__
                    for r in entries:
                        for key in r["keys"]:
                            error = r["error"] or problem
                            if error is None:
                                try:
                                    with archive.open(r["path"]) as entry:  # raises at its end on a CRC mismatch
                                        _stream(entry, f"{root.rstrip('/')}/{key}")
                                except Exception as exc:
                                    error = str(exc)[:1000] or type(exc).__name__
                            out.append({n: {**r, "key": key, "error": error}[n] for n in names})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def unpack_to(entries: DataFrame, root: str, total_bytes: int, total_rows: int) -> DataFrame:
    """Copies each entry (columns of ``ENTRY_LIST`` and ``keys``, the object keys it goes to) to ``root``
    piece by piece, so entries of any size pass through bounded memory; content never leaves
    the task.  One row per key with its error, if any.

    Up to ``RUN`` neighbouring small entries go to one task, which opens their archive once for them; a large
    one is dealt by itself, so that a hot archive still spreads over the cluster."""
    ship_code(entries.sparkSession)
    return dealt_entries(entries, total_bytes, total_rows).mapInArrow(_unpack_batches(root), WRITTEN)


def dealt_entries(entries: DataFrame, total_bytes: int, total_rows: int) -> DataFrame:
    run = F.when(F.col("size_bytes") < COPY_BYTES, -1 - F.floor(F.col("pos") / RUN)).otherwise(F.col("pos"))
    rows = entries.select(*ENTRY_LIST.fieldNames(), "keys").withColumn("_run", run.cast("long"))
    return spread(rows, ["archive_path", "_run"], total_bytes, total_rows).drop("_run")


def unpack(archives: DataFrame, path_col: str = "path", partitions: int | None = None) -> DataFrame:
    return extract(list_entries(archives, path_col), partitions)


def bronze_objects(entries: DataFrame, partner: str, dataset: str, ingest_date: str) -> DataFrame:
    """Bronze rows of extracted entries: key under the drop's Hive prefix, content type."""
    prefix = K.hive_prefix(F.lit(partner), F.lit(dataset), F.lit(ingest_date))
    return entries.select(
        F.lit(partner).alias("partner"),
        F.lit(dataset).alias("dataset"),
        K.date_lit(ingest_date).alias("ingest_date"),
        F.concat(prefix, F.col("path")).alias("key"),
        "pos",
        "size_bytes",
        "crc32",
        K.content_type("path").alias("content_type"),
        "content",
        "error",
    )


def drop_outcome(entries: DataFrame) -> DataFrame:
    """Per archive: entries, bytes and the first error; any error fails the drop."""
    return entries.groupBy("archive_path").agg(
        F.count_if(F.col("error").isNull()).alias("file_count"),
        F.sum(F.when(F.col("error").isNull(), F.col("size_bytes"))).cast("long").alias("total_bytes"),
        F.min("error").alias("error"),
    ).withColumn("status", F.when(F.col("error").isNull(), F.lit("DONE")).otherwise(F.lit("FAILED")))


def _put(path: str, content: bytes) -> str | None:
    """Writes one object; the error, if any."""
    try:
        with _open_out(path) as fh:
            fh.write(content)
    except Exception as exc:
        return str(exc)[:1000] or type(exc).__name__
    return None


def _write_batches(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("size_bytes", pa.int64()), ("crc32", pa.int64()), ("error", pa.string())])
        for b in batches:
            out = []
            for key, content in zip(b.column("key").to_pylist(), b.column("content").to_pylist(), strict=True):
                if content is None:
                    out.append({"key": key, "size_bytes": None, "crc32": None, "error": "no content"})
                else:
                    error = _put(f"{root.rstrip('/')}/{key}", content)
                    out.append({"key": key, "size_bytes": len(content), "crc32": zlib.crc32(content), "error": error})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _copy_batches(source: str, target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("drop_id", pa.string()), ("bronze_key", pa.string()), ("size_bytes", pa.int64()), ("error", pa.string())])
        for b in batches:
            out = []
            for drop, key, to in zip(*(b.column(c).to_pylist() for c in ("drop_id", "key", "bronze_key")), strict=True):
                size, error = None, None
                try:
                    with _open(f"{source.rstrip('/')}/{key}") as fh:
                        size = _stream(fh, f"{target.rstrip('/')}/{to}")
                except Exception as exc:
                    error = str(exc)[:1000] or type(exc).__name__
                out.append({"drop_id": drop, "bronze_key": to, "size_bytes": size, "error": error})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def copy_objects(loose: DataFrame, source: str, target: str) -> DataFrame:
    """Copies ``source/key`` to ``target/bronze_key`` for each row (drop_id, key, bronze_key) on
    the executors, piece by piece (objects of any size in bounded memory); one row per drop with
    its error, if any."""
    ship_code(loose.sparkSession)
    schema = S.struct(("drop_id", S.S), ("bronze_key", S.S), ("size_bytes", S.L), ("error", S.S))
    return spread(loose.select("drop_id", "key", "bronze_key"), ["drop_id"]).mapInArrow(_copy_batches(source, target), schema)


def _document_batches(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, fh, first = None, None, True

        def close():
            if fh is not None:
                fh.write(b"]}")
                fh.close()

        for b in batches:
            for r in b.to_pylist():
                if r["drop_id"] != current:
                    close()
                    current, first = r["drop_id"], True
                    head = {n: r[n] for n in DOCUMENT_HEAD}
                    fh = _open_out(f"{root.rstrip('/')}/{r['manifest_key']}")
                    fh.write((json.dumps(head, default=str)[:-1] + ', "files": [').encode())
                    yield pa.RecordBatch.from_pylist([{"drop_id": current, "manifest_key": r["manifest_key"]}])
                if r["key"] is not None:
                    entry = {n: r[n] for n in ("key", "size_bytes", "crc32", "content_type")}
                    fh.write((("" if first else ",") + json.dumps(entry)).encode())
                    first = False
        close()

    return run


DOCUMENT_HEAD = ("drop_id", "partner", "dataset", "ingest_date", "source", "completed_at", "file_count", "total_bytes")


def write_manifest_documents(files: DataFrame, root: str) -> DataFrame:
    """One JSON document per drop at ``root/manifest_key``: the fields of ``DOCUMENT_HEAD`` and
    ``files`` in archive order.  Rows hold the head columns, manifest_key, pos, key, size_bytes, crc32
    and content_type (a drop without files is one row with null key).  A document is one
    object, so one task writes it, row by row."""
    ship_code(files.sparkSession)
    rows = files.select(*DOCUMENT_HEAD, "manifest_key", "pos", "key", "size_bytes", "crc32", "content_type")
    dealt = spread(rows, ["drop_id"]).sortWithinPartitions("drop_id", "pos")
    return dealt.mapInArrow(_document_batches(root), "drop_id string, manifest_key string")


def write_objects(objects: DataFrame, root: str) -> DataFrame:
    """Write each (key, content) row as an object at ``root/key`` from the executors
    (deterministic keys: a re-run rewrites the same bytes).  Returns key, size, CRC, error."""
    ship_code(objects.sparkSession)
    return objects.select("key", "content").mapInArrow(
        _write_batches(root), S.struct(("key", S.S), ("size_bytes", S.L), ("crc32", S.L), ("error", S.S))
    )


def _read_batches(root: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("key").to_pylist()
            start, contents, held = 0, [], 0
            for i, key in enumerate(keys):
                with _open(f"{root.rstrip('/')}/{key}") as fh:  # a listed key with no object fails the job
                    contents.append(fh.read())
                held += len(contents[-1])
                if held >= BATCH_BYTES or i == len(keys) - 1:
                    part = b.slice(start, i + 1 - start)
                    arrays = [part.column(n) for n in names] + [pa.array(contents, type=pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=names + ["content"])
                    start, contents, held = i + 1, [], 0

    return run


def read_objects(keys: DataFrame, root: str) -> DataFrame:
    """Fetch the objects of ``keys`` (a ``key`` column plus any pass-through columns) on
    the executors: only listed objects are read, and no key list reaches the driver."""
    ship_code(keys.sparkSession)
    names = keys.columns
    schema = S.T.StructType(list(keys.schema.fields) + [S.T.StructField("content", S.B, True)])
    return keys.mapInArrow(_read_batches(root, names), schema)
