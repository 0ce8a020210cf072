"""Whitening of embeddings from exact integer scatter, gathered bit plane by bit plane.

Components become integers.  In blocks of rows each dimension is shifted to begin at zero and cut
into bit planes; a plane packs one bit of every row of the block into words.  The cross-product of
two dimensions is then the sum of 2^(p+q) * popcount(plane p AND plane q), exact whatever the
order of the blocks.  Block sums become one matrix of integers, centred as integers, and only then
doubles: eigenvectors come from ``eigh``, made precise in the basis it gives by plane rotations on
the exact matrix, so small components keep their digits beside large ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import prepare, written

#: Rows of a block: 64 words a plane.
BLOCK = 4_096
#: Integers travel as sums of limbs of 32 bits, so that no size of input overflows.
LIMB, LIMBS = 32, 6
COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
#: Entries beyond this make no long; such vectors are treated as not finite.
LARGEST = float(1 << 52)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows whose vector is there and has finite entries only."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("embedding"))
    return rows.where(F.col("embedding").isNotNull() & ~F.exists("embedding", bad))


def integers(column: pa.ListArray, width: int) -> np.ndarray:
    """(rows, width) of floor(1024 c) + 100000; shorter vectors count as padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    if len(sizes) and (sizes == width).all():
        c = flat.reshape(len(sizes), width)
    else:
        c = np.zeros((len(sizes), width))
        c[np.arange(width) < sizes[:, None]] = flat
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def cross_products(x: np.ndarray) -> np.ndarray:
    """Exact x^T x of integers as Python numbers, by AND and popcount of packed bit planes."""
    n, width = x.shape
    low = x.min(axis=0)
    y = (x - low).astype(np.uint64)
    bits = max(1, int(y.max()).bit_length())
    rows = -(-n // 64) * 64
    planes = np.zeros((width, bits, rows), np.uint8)
    for p in range(bits):
        planes[:, p, :n] = ((y >> np.uint64(p)) & np.uint64(1)).T
    words = np.packbits(planes.reshape(width * bits, rows), axis=1).view(np.uint64)
    counts = np.zeros((width * bits, width * bits), np.int64)
    for i in range(width * bits):  # planes of this dimension and those after it
        first = i // bits * bits
        counts[i, first:] = np.bitwise_count(words[first:] & words[i]).sum(axis=1, dtype=np.int64)
    by_bits = counts.reshape(width, bits, width, bits)
    weights = [1 << p for p in range(bits)]
    if 2 * bits + n.bit_length() + 1 < 63:
        w = np.array(weights, np.int64)
        yy = np.einsum("apbq,p,q->ab", by_bits, w, w).astype(object)
    else:
        w = np.array(weights, object)
        yy = sum(by_bits[:, p, :, q].astype(object) * (w[p] * w[q]) for p in range(bits) for q in range(bits))
    yy = np.triu(yy)
    yy = yy + np.triu(yy, 1).T
    m, s = low.astype(object), np.array([int(v) for v in y.sum(axis=0, dtype=object)] if bits > 50 else y.sum(axis=0).tolist(), object)
    # x = y + low: back to the values themselves
    return yy + np.outer(m, s) + np.outer(s, m) + n * np.outer(m, m)


def _limbs(value: int) -> list[int]:
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    for _ in range(LIMBS):
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    if rest:
        raise OverflowError("cross-products beyond 192 bits")
    return out


def scatter(rows: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums by dimension, sums of cross-products) over ``rows`` (embedding): exact integers.  Tasks
    give one row per pair of dimensions, added up by Spark; the driver gets width^2 / 2 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, n, held = np.zeros((width, width), object), np.zeros(width, object), 0, []

        def add(x):
            nonlocal total, sums, n
            total = total + cross_products(x)
            sums = sums + np.array([sum(c) for c in x.T.tolist()] if np.abs(x).max() > 1 << 50 else x.sum(axis=0).tolist(), object)
            n += len(x)

        for batch in batches:
            x = integers(batch.column("embedding"), width)
            held.append(x)
            if sum(map(len, held)) >= BLOCK:
                x = np.concatenate(held)
                whole = len(x) // BLOCK * BLOCK
                for i in range(0, whole, BLOCK):
                    add(x[i : i + BLOCK])
                held = [x[whole:]]
        if held and sum(map(len, held)):
            add(np.concatenate(held))
        if not n:
            return
        # the row (-1, -1) counts, the rows (a, -1) sum, the others are cross-products
        at = [(-1, -1)] + [(a, -1) for a in range(width)] + [(a, b) for a in range(width) for b in range(a, width)]
        values = [n, *sums, *(total[a, b] for a in range(width) for b in range(a, width))]
        limbs = list(zip(*map(_limbs, values), strict=True))
        columns = [pa.array([c[i] for c in at], pa.int32()) for i in (0, 1)] + [pa.array(c, pa.int64()) for c in limbs]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", *(f"l{i}" for i in range(LIMBS))])

    schema = "a int, b int, " + ", ".join(f"l{i} long" for i in range(LIMBS))
    parts = rows.select("embedding").mapInArrow(run, schema)
    merged = parts.groupBy("a", "b").agg(*(F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS))).collect()  # width^2 / 2 rows
    n, sums, cross = 0, [0] * width, np.zeros((width, width), object)
    for r in merged:
        value = sum(int(r[f"l{i}"]) << (LIMB * i) for i in range(LIMBS))
        if r.a < 0:
            n = value
        elif r.b < 0:
            sums[r.a] = value
        else:
            cross[r.a, r.b] = cross[r.b, r.a] = value
    return n, sums, cross


def _rotated(b: np.ndarray, q: np.ndarray, sweeps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Plane rotations until every entry off the diagonal is small beside its own two diagonal ones."""
    b, q, width = b.copy(), q.copy(), len(b)
    for _ in range(sweeps):
        turned = False
        for i in range(width - 1):
            for j in range(i + 1, width):
                if abs(b[i, j]) <= 1e-15 * math.sqrt(abs(b[i, i] * b[j, j])) or b[i, j] == 0:
                    continue
                turned = True
                tau = (b[j, j] - b[i, i]) / (2 * b[i, j])
                t = math.copysign(1, tau) / (abs(tau) + math.hypot(1, tau)) if math.isfinite(tau) else 0.0
                c = 1 / math.hypot(1, t)
                s = c * t
                for m in (b, q):
                    m[:, [i, j]] = np.stack((c * m[:, i] - s * m[:, j], s * m[:, i] + c * m[:, j]), axis=1)
                b[[i, j]] = np.stack((c * b[i] - s * b[j], s * b[i] + c * b[j]))
                b[i, j] = b[j, i] = 0.0
        if not turned:
            break
    return np.diag(b).copy(), q


def principal(n: int, sums: list[int], cross: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues by falling size, unit eigenvectors as columns, trace) of the covariance with divisor n."""
    s = np.array(sums, object)
    centred = n * cross - np.outer(s, s)  # n^2 times the covariance, in integers
    square = n * n
    v = np.array([[int(c) / square for c in line] for line in centred])
    _, q = np.linalg.eigh(v)
    # the exact matrix in the basis found: what rounding left there is turned away
    whole = np.array([[int(round(c * (1 << 60))) for c in line] for line in q.tolist()], object)
    inner = whole.T.dot(centred).dot(whole)
    b = np.array([[int(c) / (square << 120) for c in line] for line in inner])
    e, q = _rotated((b + b.T) / 2, q)
    order = np.argsort(-e, kind="stable")
    e, q = e[order], q[:, order] / np.linalg.norm(q[:, order], axis=0)
    trace = sum(int(centred[i, i]) for i in range(len(s))) / square
    least = trace * 1e-30  # below it there is nothing but rounding
    return np.where(e > least, e, 0.0), q, trace


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """sum over dimensions of (n x - S)^2 for each row, exact."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if largest < 1 << 62:
        t = n * x - np.array(sums, np.int64)
        top = int(np.abs(t).max(initial=0))
        if top * top * max(1, x.shape[1]) < 1 << 62:
            return (t * t).sum(axis=1).tolist()
        rows = t.tolist()
    else:
        rows = [[n * v - s for v, s in zip(line, sums, strict=True)] for line in x.tolist()]
    return [sum(v * v for v in line) for line in rows]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each row of ``embeddings`` (vec_id, embedding) with a whole vector, and each of the first
    ``components`` components: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error, deviation_exact.

    Vectors that are null or hold null or non-finite entries (or any beyond 2^52) take no part; shorter
    ones count as padded with zeros; rows that repeat a vec_id, and null ids, are rows like others;
    other columns are ignored; an empty table gives no rows.  ``deviation`` is null where it does not fit a
    long, ``deviation_exact`` holds its digits always.  A component without variance has whitened
    0, explained 0 (and no say in identity_error, which is measured on the whitened values).
    Building the frame gathers the scatter and measures the result."""
    spark = embeddings.sparkSession
    prepare(spark)
    rows = usable(embeddings)
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    kinds = "vec_id long, deviation long, deviation_exact string, z array<double>"
    n, sums, cross = scatter(rows, width) if width else (0, [], np.zeros((0, 0), object))
    if n:
        e, q, trace = principal(n, sums, cross)
    else:
        e, q, trace = np.zeros(0), np.zeros((0, 0)), 0.0
    k = min(components, len(e))
    with np.errstate(divide="ignore"):
        onto = q[:, :k] * np.where(e[:k] > 0, 1 / np.sqrt(e[:k]), 0.0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean_whole = [s // n for s in sums]
        mean_rest = np.array([(s % n) / n for s in sums])
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = integers(part.column("embedding"), width)
                d = deviations(x, n, sums)
                z = ((x - np.array(mean_whole, np.int64)) - mean_rest) @ onto
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(z.ravel()))
                fits = pa.array([v if v < 1 << 63 else None for v in d], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), fits, pa.array(map(str, d), pa.string()), lists], ["vec_id", "deviation", "deviation_exact", "z"])

    white = written(rows.mapInArrow(project, kinds) if n else spark.createDataFrame([], kinds), "whitened")
    pairs = [(a, b) for a in range(k) for b in range(a, k) if e[a] > 0 and e[b] > 0]
    error = 0.0
    if pairs:
        held = white.agg(*(F.covar_pop(F.col("z")[a], F.col("z")[b]).alias(f"c{a}_{b}") for a, b in pairs)).first()
        error = max(abs(c - (a == b)) for (a, b), c in zip(pairs, held, strict=True))
    explained = F.array(*(F.lit(float(v / trace) if trace > 0 else 0.0) for v in e[:k])) if k else F.array().cast("array<double>")
    out = white.select("vec_id", "deviation", "deviation_exact", F.posexplode("z").alias("_at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
        "deviation_exact",
    )
