"""Column expressions for object keys, partner names, routing predicates and content types.

All are built-in Spark expressions (no Python UDF), so they stay inside whole-stage codegen
and run on the executors next to the scan.
"""

from __future__ import annotations

import datetime as _dt
import mimetypes
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------------------
# Landing bucket name pattern: imgp-<env>-landing-<partner>-<12-digit account id>.
LANDING_BUCKET_PATTERN = r"^imgp-[^-]+-landing-(.+)-[0-9]{12}$"
UNKNOWN_PARTNER = "unknown"
# Suffixes treated as images (case-insensitive) and as archives (case-insensitive).
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".gif", ".webp")
ARCHIVE_SUFFIXES = (".zip",)
# Annotation documents the silver router reacts to (searched in the file name).
COCO_JSON_PATTERN = r"(instances|captions|person_keypoints)_.*\.json$"
# Annotation kinds the normaliser flattens; "person" (keypoints) is skipped on purpose.
NORMALISED_KINDS = ("instances", "captions")
SKIPPED_KINDS = ("person",)
# Content types of a bronze object by extension: the standard library's own table, without the
# machine's files, so that every machine gives the same types.
CONTENT_TYPES = dict(sorted(mimetypes.MimeTypes(filenames=()).types_map[True].items()))
# Extensions of a compressed form: the type of such an object is that of its inner extension.
ENCODINGS = tuple(sorted(x.lower() for x in mimetypes.MimeTypes(filenames=()).encodings_map))
# Extensions that stand for two, e.g. a packed archive.
SUFFIX_ALIASES = dict(sorted(mimetypes.MimeTypes(filenames=()).suffix_map.items()))
# The image suffixes in any mixture of cases, for file sources.
IMAGE_GLOB = "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in x[1:]) for x in IMAGE_SUFFIXES) + "}"
DEFAULT_CONTENT_TYPE = "application/octet-stream"
LOOSE_DATASET = "loose"
MANIFEST_NAME = "manifest.json"  # a leading "_" would hide it from every Spark file source


def manifest_glob(root: str) -> str:
    """The path pattern of the manifest documents of all drop folders below ``root``."""
    plain = re.sub(r"([\\\[\]{}*?])", r"\\\1", root.rstrip("/"))
    return f"{plain}/partner=*/dataset=*/ingest_date=*/{MANIFEST_NAME}"

ERROR_MAX_CHARS = 500
LEDGER_ERROR_MAX_CHARS = 1000
# ---------------------------------------------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def partner_from_bucket(bucket: Column | str) -> Column:
    """Partner name of a landing bucket, ``unknown`` for any other bucket."""
    got = F.regexp_extract(_c(bucket), LANDING_BUCKET_PATTERN, 1)
    return F.coalesce(F.nullif(got, F.lit("")), F.lit(UNKNOWN_PARTNER))


def ingest_date_str(event_time: Column | str) -> Column:
    """Ingest date of an event: the first ten characters of its ISO time."""
    return F.substring(_c(event_time), 1, 10)


def drop_id(partner: Column | str, key: Column | str, etag: Column | str) -> Column:
    """``partner#key#etag``; a missing etag counts as empty (concat_ws would skip it)."""
    return F.concat_ws(
        "#",
        F.coalesce(_c(partner), F.lit("")),
        F.coalesce(_c(key), F.lit("")),
        F.coalesce(_c(etag), F.lit("")),
    )


def file_name(key: Column | str) -> Column:
    """Text after the last ``/`` (the whole key when there is none)."""
    return F.substring_index(_c(key), "/", -1)


def path_stem(name: Column | str) -> Column:
    """File stem with only the last extension removed, where a leading dot is not an
    extension and a trailing dot is not one either (``a.tar.zip`` -> ``a.tar``,
    ``.zip`` -> ``.zip``, ``a.`` -> ``a.``)."""
    n = file_name(name)
    return F.when(n.rlike(r"^.+\.[^.]+$"), F.regexp_extract(n, r"^(.+)\.[^.]+$", 1)).otherwise(n)


def cut_last_dot(name: Column | str) -> Column:
    """Everything before the last dot, the whole name when there is no dot."""
    n = _c(name)
    return F.when(F.instr(n, ".") > 0, F.regexp_extract(n, r"^(.*)\.", 1)).otherwise(n)


def hive_prefix(partner: Column | str, dataset: Column | str, ingest_date: Column | str) -> Column:
    """``partner=<p>/dataset=<d>/ingest_date=<yyyy-MM-dd>/``."""
    return F.concat(
        F.lit("partner="),
        _c(partner),
        F.lit("/dataset="),
        _c(dataset),
        F.lit("/ingest_date="),
        _c(ingest_date).cast("string"),
        F.lit("/"),
    )


def thumbnail_key(prefix: Column | str, name: Column | str) -> Column:
    """``thumbnails/<partition prefix><name before its last dot>.jpg``."""
    return F.concat(F.lit("thumbnails/"), _c(prefix), cut_last_dot(name), F.lit(".jpg"))


def loose_bronze_key(partner: Column | str, ingest_date: Column | str, key: Column | str) -> Column:
    """Bronze key of a loose (non-archive) object: only its base name is kept."""
    return F.concat(hive_prefix(partner, F.lit(LOOSE_DATASET), ingest_date), file_name(key))


def _ends_with_any(c: Column, suffixes: tuple[str, ...]) -> Column:
    low = F.lower(c)
    out = low.endswith(suffixes[0])
    for s in suffixes[1:]:
        out = out | low.endswith(s)
    return out


def is_image_key(key: Column | str) -> Column:
    return _ends_with_any(_c(key), IMAGE_SUFFIXES)


def is_archive_key(key: Column | str) -> Column:
    return _ends_with_any(_c(key), ARCHIVE_SUFFIXES)


def is_coco_json(key: Column | str) -> Column:
    """Router predicate: searched (not anchored at the start) in the base name."""
    return file_name(key).rlike(COCO_JSON_PATTERN)


def annotation_kind(key: Column | str) -> Column:
    """Text before the first ``_`` of the stem (cut at the last dot)."""
    return F.substring_index(cut_last_dot(file_name(key)), "_", 1)


def annotation_split(key: Column | str) -> Column:
    """Text after the first ``_`` of the stem; empty when there is no ``_``."""
    stem = cut_last_dot(file_name(key))
    pos = F.instr(stem, "_")
    return F.when(pos > 0, F.substr(stem, pos + F.lit(1))).otherwise(F.lit(""))


def annotation_action(key: Column | str) -> Column:
    """What the normaliser does with a manifest file: ``instances`` / ``captions`` are
    flattened, keypoints files are reported as skipped, anything else is ignored."""
    kind, split = annotation_kind(key), annotation_split(key)
    skipped = kind.isin(*SKIPPED_KINDS) | (split == "")
    return (
        F.when(skipped & file_name(key).startswith("person_keypoints_"), F.lit("skip_keypoints"))
        .when(skipped, F.lit("ignore"))
        .when(kind.isin(*NORMALISED_KINDS), kind)
        .otherwise(F.lit("ignore"))
    )


def content_type(key: Column | str) -> Column:
    """Content type by the last extension (in any case), of the inner extension for compressed
    forms; octet-stream when unknown."""
    lookup = lambda table: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    last = lambda name: F.regexp_extract(name, r"^.*[^.].*?(\.[^.]*)$", 1)
    name = F.lower(file_name(key))
    alias = lookup(SUFFIX_ALIASES)[last(name)]
    name = F.when(alias.isNotNull(), F.concat(cut_last_dot(name), alias)).otherwise(name)
    packed = last(name).isin(*ENCODINGS)
    inner = F.when(packed, cut_last_dot(name)).otherwise(name)
    return F.coalesce(lookup(CONTENT_TYPES)[last(inner)], F.lit(DEFAULT_CONTENT_TYPE))


def truncate_error(err: Column | str, n: int = ERROR_MAX_CHARS) -> Column:
    """Error text cut to ``n`` characters; an empty message counts as no error."""
    e = _c(err)
    return F.when(e.isNotNull() & (e != ""), F.substring(e, 1, n))


def date_lit(d: str | _dt.date) -> Column:
    """Typed date literal, so partition filters stay prunable."""
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d))


def key_below(path: Column | str, root: str) -> Column:
    """The object key of a path below ``root``, both in any of the spellings of a local path."""
    one = root.rstrip("/") + "/"
    one = one if "://" in one or one.startswith("file:") else "file:" + one
    one = re.sub(r"^file:/+", "file:/", one)
    return F.substr(F.regexp_replace(_c(path), "^file:/+", "file:/"), F.lit(len(one) + 1))
