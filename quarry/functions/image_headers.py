"""Image header reader: dimensions, format, mode and three EXIF tags from the first bytes
of a PNG, JPEG, GIF, BMP or WebP file, plus the thumbnail size rule.

A small per-row helper called from ``mapInArrow``; it never decodes pixels.  Format and
mode names follow the common imaging-library conventions (``PNG``/``JPEG``/``GIF``/``BMP``/
``WEBP``; ``1``, ``L``, ``LA``, ``P``, ``RGB``, ``RGBA``, ``CMYK``, ``I;16``).
"""

from __future__ import annotations

import struct

# EXIF tag numbers read, and the thumbnail bound.
EXIF_MAKE, EXIF_MODEL, EXIF_ORIENTATION = 271, 272, 274
THUMBNAIL_MAX = 256

UNKNOWN = "cannot identify image file"
TRUNCATED = "image file is truncated"


class NeedMore(Exception):
    """The header runs past the bytes given."""


def _exif(tiff: bytes) -> dict:
    out: dict = {}
    if len(tiff) < 8:
        return out
    bo = {b"II": "<", b"MM": ">"}.get(tiff[:2])
    if bo is None:
        return out
    (ifd,) = struct.unpack(bo + "I", tiff[4:8])
    if ifd + 2 > len(tiff):
        return out
    (n,) = struct.unpack(bo + "H", tiff[ifd : ifd + 2])
    for i in range(n):
        e = ifd + 2 + 12 * i
        if e + 12 > len(tiff):
            break
        tag, typ, count = struct.unpack(bo + "HHI", tiff[e : e + 8])
        if tag in (EXIF_MAKE, EXIF_MODEL) and typ == 2:
            if count <= 4:
                raw = tiff[e + 8 : e + 8 + count]
            else:
                (off,) = struct.unpack(bo + "I", tiff[e + 8 : e + 12])
                raw = tiff[off : off + count]
            out[tag] = raw.split(b"\x00", 1)[0].decode("latin-1").strip()
        elif tag == EXIF_ORIENTATION and typ == 3:
            (out[tag],) = struct.unpack(bo + "H", tiff[e + 8 : e + 10])
    return out


def _png(b: bytes):
    if len(b) < 33:
        raise NeedMore
    w, h, depth, ctype = struct.unpack(">IIBB", b[16:26])
    mode = {
        0: {1: "1", 16: "I;16"}.get(depth, "L"),
        2: "RGB",
        3: "P",
        4: "LA",
        6: "RGBA",
    }.get(ctype)
    if mode is None:
        raise ValueError(UNKNOWN)
    exif: dict = {}
    pos = 8
    while pos + 8 <= len(b):
        (length,) = struct.unpack(">I", b[pos : pos + 4])
        kind = b[pos + 4 : pos + 8]
        if kind == b"eXIf":
            if pos + 8 + length > len(b):
                raise NeedMore
            exif = _exif(b[pos + 8 : pos + 8 + length])
        if kind in (b"IDAT", b"IEND"):
            break
        pos += 12 + length
    return "PNG", w, h, mode, exif


_SOF = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}


def _jpeg(b: bytes):
    pos, exif = 2, {}
    while True:
        while pos < len(b) and b[pos] != 0xFF:
            pos += 1
        while pos < len(b) and b[pos] == 0xFF:
            pos += 1
        if pos + 3 > len(b):
            raise NeedMore
        marker = b[pos]
        pos += 1
        if marker in (0xD8, 0x01) or 0xD0 <= marker <= 0xD7:
            continue
        if marker == 0xD9:
            raise ValueError(UNKNOWN)
        (length,) = struct.unpack(">H", b[pos : pos + 2])
        if marker == 0xE1 and b[pos + 2 : pos + 8] == b"Exif\x00\x00":
            if pos + length > len(b):
                raise NeedMore
            exif = _exif(b[pos + 8 : pos + length])
        if marker in _SOF:
            if pos + 8 > len(b):
                raise NeedMore
            h, w, comps = struct.unpack(">HHB", b[pos + 3 : pos + 8])
            mode = {1: "L", 3: "RGB", 4: "CMYK"}.get(comps)
            if mode is None:
                raise ValueError(UNKNOWN)
            return "JPEG", w, h, mode, exif
        pos += length


def _gif(b: bytes):
    if len(b) < 13:
        raise NeedMore
    w, h, flags = struct.unpack("<HHB", b[6:11])
    return "GIF", w, h, ("P" if flags & 0x80 else "L"), {}


def _bmp(b: bytes):
    if len(b) < 30:
        raise NeedMore
    (hsize,) = struct.unpack("<I", b[14:18])
    if hsize == 12:
        w, h, _, bpp = struct.unpack("<HHHH", b[18:26])
    else:
        w, h, _, bpp = struct.unpack("<iiHH", b[18:30])
    mode = {1: "P", 4: "P", 8: "P", 16: "RGB", 24: "RGB", 32: "RGB"}.get(bpp)
    if mode is None or w <= 0 or h == 0:
        raise ValueError(UNKNOWN)
    return "BMP", w, abs(h), mode, {}


def _webp(b: bytes):
    if len(b) < 30:
        raise NeedMore
    kind = b[12:16]
    if kind == b"VP8 ":
        if b[23:26] != b"\x9d\x01\x2a":
            raise ValueError(UNKNOWN)
        w, h = struct.unpack("<HH", b[26:30])
        return "WEBP", w & 0x3FFF, h & 0x3FFF, "RGB", {}
    if kind == b"VP8L":
        if b[20] != 0x2F:
            raise ValueError(UNKNOWN)
        (bits,) = struct.unpack("<I", b[21:25])
        w, h, alpha = (bits & 0x3FFF) + 1, ((bits >> 14) & 0x3FFF) + 1, (bits >> 28) & 1
        return "WEBP", w, h, ("RGBA" if alpha else "RGB"), {}
    if kind == b"VP8X":
        flags = b[20]
        w = int.from_bytes(b[24:27], "little") + 1
        h = int.from_bytes(b[27:30], "little") + 1
        return "WEBP", w, h, ("RGBA" if flags & 0x10 else "RGB"), {}
    raise ValueError(UNKNOWN)


def read_header(head: bytes):
    """(format, width, height, mode, exif dict) of an image from its first bytes.
    Raises ``NeedMore`` when the header runs past ``head``, ``ValueError`` otherwise."""
    if head[:8] == b"\x89PNG\r\n\x1a\n":
        return _png(head)
    if head[:2] == b"\xff\xd8":
        return _jpeg(head)
    if head[:6] in (b"GIF87a", b"GIF89a"):
        return _gif(head)
    if head[:2] == b"BM":
        return _bmp(head)
    if head[:4] == b"RIFF" and head[8:12] == b"WEBP":
        return _webp(head)
    if len(head) < 16:
        raise NeedMore
    raise ValueError(UNKNOWN)


def is_truncated(fmt: str, data: bytes, whole: bool) -> bool | None:
    """Whether the file ends early: no end marker of its format (bytes may follow it).
    ``data`` is the whole file or its last bytes; None when those do not tell."""
    if fmt == "PNG":
        ended = b"IEND\xaeB`\x82" in data
    elif fmt == "JPEG":
        # the marker must follow the last scan: an embedded preview has one of its own
        ended = data.rfind(b"\xff\xd9") > data.rfind(b"\xff\xda")
    elif fmt == "GIF":
        ended = data.rstrip(b"\0").endswith(b";")
    else:
        return False
    return False if ended else True if whole else None
