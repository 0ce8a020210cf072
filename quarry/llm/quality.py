"""Quality scores: random Fourier features of document statistics, ridge regression by
partition-summed normal equations, isotonic calibration.

The statistics of a text (a few dozen numbers, in one pass over it) are standardised and mapped to
``FEATURES`` random cosines, whose inner products approximate a Gaussian kernel.  Each partition of
the labelled rows contributes the sums Z'Z and Z'y; their total gives the ridge weights, and a
monotone step function fitted on the same rows turns raw scores into probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.labels import MAX_FIT_ROWS, fit_rows, held_out, scored_rows
from quarry.llm.shared import map_text, prepare, sliced, small_batches, written

FEATURES = 256
#: Kernel width in standard deviations of the statistics, and the ridge.
WIDTH, RIDGE = 8.0, 0.1
#: Steps of the calibration: raw scores are summed in this many equal-width bins over [-1, 2].
BINS = 3_000
PREDICT_AT = 0.3

_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKS = np.frombuffer(bytes(c for c in range(33, 127) if not chr(c).isalnum()), np.uint8)


def statistics(text: str) -> list[float]:
    """Numbers that describe a text of any length; zeros for an empty one."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    n = max(1, len(raw))
    words = text.split()
    w = max(1, len(words))
    lines = text.split("\n")
    distinct = set(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    marks = counts[_MARKS]
    capitals = len(_UPPER.findall(text))
    letters = max(1, len(text) - int(counts[:65].sum()))
    words_1 = {x.strip(".,;:!?").lower() for x in distinct}
    half = words[: len(words) // 2]
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        lengths.mean() if len(words) else 0.0,
        np.sqrt(lengths.var()) if len(words) else 0.0,
        np.log1p(int(lengths.max())) if len(words) else 0.0,
        len(distinct) / np.sqrt(w),
        len(distinct) / w,
        len(words_1) / max(1, len(distinct)),
        repeats / w,
        capitals / letters,
        sum(map(str.isupper, words)) / w,
        sum(map(str.isalpha, words)) / w,
        counts[48:58].sum() / n,
        marks.sum() / n,
        marks.max(initial=0) / n,
        counts[ord("!")] / w,
        counts[ord("|")] / w,
        (counts[ord(".")] + counts[ord(",")]) / w,
        (marks.sum() - counts[ord(".")] - counts[ord(",")]) / w,
        counts[32] / n,
        counts[128:].sum() / n,
        counts[:32].sum() / n,
        len(set(lines)) / len(lines),
        np.log1p(len(lines)),
        len(set(half)) / max(1, len(half)),
        float((counts[counts > 0] / n * -np.log(counts[counts > 0] / n)).sum()) if len(raw) else 0.0,
    ]


def matrix(batch: pa.RecordBatch, column: str = "text") -> np.ndarray:
    """Statistics of a batch; a text seen twice in it is read once."""
    seen: dict[str, list[float]] = {}
    rows = []
    for text in batch.column(column).to_pylist():
        row = seen.get(text)
        if row is None:
            row = seen[text] = statistics(text)
        rows.append(row)
    return np.array(rows, np.float64)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = fourier(x, self.mean, self.spread, self.waves, self.phases)
        # row by row sums, so that a score does not depend on the rows beside it
        return (z * self.weights).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.values)


def fourier(x, mean, spread, waves, phases) -> np.ndarray:
    """Random cosines of the standardised statistics, and a constant."""
    scaled = np.clip((x - mean) / spread, -4, 4)
    z = np.sqrt(2 / len(phases)) * np.cos(np.stack([scaled @ w for w in waves.T], axis=1) + phases)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def isotonic(x: np.ndarray, hits: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of ``x``: knots of a monotone function, with
    one hit and one miss spread over each pool so that it stays off 0 and 1."""
    pools: list[list[float]] = []
    for at, h, c in zip(x, hits, n, strict=True):
        pools.append([h, c, at, at])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            h2, c2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + h2, pools[-1][1] + c2, pools[-1][2], hi]
    edges = np.array([e for p in pools for e in (p[2], p[3])])
    values = np.array([v for p in pools for v in [(p[0] + 0.5) / (p[1] + 1)] * 2])
    return edges, np.maximum.accumulate(values)


def _summed(rows: DataFrame, per_slice, width: int) -> list[np.ndarray]:
    """Sums of the matrices that ``per_slice`` gives for each slice: every partition emits one
    partial sum per matrix row, and rows are added up by their number."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in sliced(batches, "text"):
            part = per_slice(batch)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column("i").to_pylist(), batch.column("sums"), strict=True):
                v = v.values.to_numpy()
                totals[i] = totals[i] + v if i in totals else v.copy()
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.list_(pa.float64()))], ["i", "sums"]
            )

    sums = rows.mapInArrow(partial, "i int, sums array<double>").repartition(8, "i").mapInArrow(add, "i int, sums array<double>")
    return [np.array(r.sums) for r in sorted(sums.collect(), key=lambda r: r.i)]  # one row per matrix row


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_FIT_ROWS, features: int = FEATURES, seed: int = 7) -> Model | None:
    """The model, or None if there is nothing to learn from (no row that may be used)."""
    d = len(statistics(""))
    sample = written(fit_rows(docs, labels, "quality", most), "quality-rows")

    def moments(batch):
        x = matrix(batch)
        return np.stack([np.full(d, float(len(x))), x.sum(axis=0), (x**2).sum(axis=0)])

    m = _summed(sample, moments, d)
    if not m:
        return None
    mean = m[1] / m[0]
    spread = np.sqrt(np.maximum(m[2] / m[0] - mean**2, 0)) + 1e-6
    rng = np.random.default_rng(seed)
    waves = rng.normal(0, 1 / WIDTH, (d, features))
    phases = rng.uniform(0, 2 * np.pi, features)

    def normal(batch):
        z = fourier(matrix(batch), mean, spread, waves, phases)
        y = np.array(batch.column("label").to_pylist(), np.float64)
        return np.concatenate([z.T @ z, (z.T @ y)[:, None]], axis=1)

    total = np.stack(_summed(sample, normal, features + 2))
    gram, target = total[:, :-1], total[:, -1]
    weights = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), target)
    rough = Model(mean, spread, waves, phases, weights, np.zeros(1), np.zeros(1))

    def binned(batch):
        raw = np.clip((rough.raw(matrix(batch)) + 1) / 3, 0, 1 - 1e-9)
        y = np.array(batch.column("label").to_pylist(), np.float64)
        at = (raw * BINS).astype(np.int64)
        return np.stack([np.bincount(at, minlength=BINS).astype(float), np.bincount(at, y, minlength=BINS)])

    n, hits = _summed(sample, binned, BINS)
    used = n > 0
    centre = (np.arange(BINS) + 0.5) / BINS * 3 - 1
    edges, values = isotonic(centre[used], hits[used], n[used])
    return Model(mean, spread, waves, phases, weights, edges, values)


def score_quality(
    docs: DataFrame, labels: DataFrame, most: int = MAX_FIT_ROWS, predict_at: float = PREDICT_AT, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1, higher: label 1
    likelier), predicted (1 if score >= ``predict_at``, else 0), and the columns ``carry`` of ``docs``.

    ``labels`` (doc_id, quality) are learned from where crc32(doc_id as text) mod 5 is not 0,
    on a sample of at most ``most`` of them; only the text enters a score.  Null counts as
    empty, and an empty text is scored like any other; a null doc_id is never held out; repeated rows give
    repeated rows; without any usable label every score is 0.5; an empty table gives no rows.
    Building the frame fits the model."""
    prepare(docs.sparkSession)
    small_batches(docs.sparkSession)
    model = fit(docs, labels, most)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score(matrix(batch, "_text")) if model else np.full(batch.num_rows, 0.5)
        return pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), *batch.columns[1:]], ["score", *batch.schema.names[1:]])

    rows, own = scored_rows(docs, carry)
    scored = map_text(rows, "score double, " + own, score, "_text")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= predict_at).cast("int").alias("predicted"), *carry)
