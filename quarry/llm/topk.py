"""Exact top-k by inner product with pivot-table elimination.

Every vector carries its precomputed distances to many pivots.  By the triangle inequality the
largest difference of two vectors' distances to one pivot bounds their own distance from below, and
so, with their norms, their inner product from above.  Candidates are evaluated in the order of that
bound until no remaining bound reaches the k-th score: the answer is exact.

Vectors are dealt to cells by their nearest pivot and their distance to it, and large cells to blocks of
bounded size.  A query first meets the block it lies in, which gives it a k-th score.  Each cell
keeps the least and greatest distance of its vectors to every pivot, so the bound holds for a
whole cell as well: a query then travels only to the blocks of cells whose bound reaches its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import prepare, shuffle_partitions, written

#: Rows with the smallest hash of vec_id that pivots are chosen among (any pivots give exact answers).
PIVOT_SAMPLE = 2_000
PIVOTS = 32
#: What bounds of cells are kept for; a cell of more rows than a block has several blocks.
MOST_CELLS = 256
QUERY_BLOCK, CANDIDATE_BLOCK = 65_536, 16_384
#: Candidates evaluated first; each further step takes twice as many.
FIRST = 128
#: Rows of one Arrow batch sent to blocks.
SENT = 2_048

TABLE = "row long, vec_id long, vector binary, distances binary, cell int"
HOME = "row long, vec_id long, vector binary, distances binary, block long, kth long, found array<struct<vec_id: long, score: long>>"
VISIT = "block long, part int, kind int, vec_id long, vector binary, distances binary, kth long"
FOUND = "query_id long, vec_id long, score long"


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is farthest from those before."""
    if not len(vectors):
        return vectors
    chosen = [0]
    near = ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(vectors)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    return vectors[chosen]


def quantised(embeddings: DataFrame, scale: float) -> DataFrame:
    """(row, vec_id, v): integer vectors, each with a number of its own; null or not finite vectors and null ids
    take no part."""
    x = F.col("embedding")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    usable = embeddings.select("vec_id", F.transform(x, lambda c: c.cast("double")).alias("embedding")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & ~F.exists("embedding", bad)
    )
    return usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda c: F.floor(c * scale).cast("long")).alias("v"),
    )


def distances_to(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


class Cells:
    """Cells by nearest centre (the first pivots) and, around each centre, rings cut at the sample's quantiles."""

    def __init__(self, sample: np.ndarray, pivots: np.ndarray, wanted: int):
        self.centres = max(1, min(len(pivots), wanted))
        self.rings = -(-wanted // self.centres)
        self.edges = np.zeros((self.centres, self.rings - 1))
        if len(pivots):
            d = distances_to(sample, pivots[: self.centres])
            nearest, least = d.argmin(axis=1), d.min(axis=1)
            for i in set(nearest.tolist()):
                self.edges[i] = np.quantile(least[nearest == i], np.arange(1, self.rings) / self.rings)

    def of(self, distances: np.ndarray) -> np.ndarray:
        d = distances[:, : self.centres]
        nearest = d.argmin(axis=1)
        return nearest * self.rings + (d.min(axis=1)[:, None] >= self.edges[nearest]).sum(axis=1)


def pivot_table(rows: DataFrame, pivots: np.ndarray, width: int, cells: Cells) -> DataFrame:
    """Each vector, padded with zeros to ``width``, with its distances to the pivots and its cell."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lists = batch.column("v")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            whole = np.zeros((len(lists), width), np.int64)
            whole[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            d = distances_to(whole.astype(np.float64), pivots)
            binary = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (whole, d)]
            columns = [batch.column("row"), batch.column("vec_id"), *binary, pa.array(cells.of(d), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "vec_id", "vector", "distances", "cell"])

    return rows.mapInArrow(measure, TABLE)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _norms(vectors: np.ndarray) -> np.ndarray:
    return (vectors.astype(np.float64) ** 2).sum(axis=1)


class Bounds:
    """Of every cell its rows, greatest norm, and least and greatest distance to each pivot: at most
    ``MOST_CELLS`` times ``PIVOTS`` entries, whatever the table."""

    def __init__(self, table: DataFrame):
        def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            for batch in batches:
                if not len(batch):
                    continue
                cell, d, norms = batch.column("cell").to_numpy(), _matrix(batch.column("distances"), np.float64), _norms(_matrix(batch.column("vector"), np.int64))
                for c in np.unique(cell).tolist():
                    own = cell == c
                    new = (int(own.sum()), norms[own].max(), d[own].min(axis=0), d[own].max(axis=0))
                    n, norm, low, high = held.get(c, (0, 0.0, new[2], new[3]))
                    held[c] = (n + new[0], max(norm, new[1]), np.minimum(low, new[2]), np.maximum(high, new[3]))
            for c, (n, norm, low, high) in held.items():
                yield pa.RecordBatch.from_pydict(
                    {"cell": [c] * len(low), "pivot": list(range(len(low))), "n": [n] * len(low), "norm": [norm] * len(low), "low": low, "high": high}
                )

        parts = table.select("cell", "vector", "distances").mapInArrow(reach, "cell long, pivot long, n long, norm double, low double, high double")
        rows = parts.groupBy("cell", "pivot").agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
        self.cells = sorted({r.cell for r in rows})
        place = {c: i for i, c in enumerate(self.cells)}
        shape = (len(self.cells), 1 + max((r.pivot for r in rows), default=0))
        self.n, self.norm, self.low, self.high = np.zeros(shape[0], np.int64), np.zeros(shape[0]), np.zeros(shape), np.zeros(shape)
        for r in rows:
            i = place[r.cell]
            self.n[i], self.norm[i], self.low[i, r.pivot], self.high[i, r.pivot] = r.n, r.norm, r.low, r.high
        self.blocks = -(-self.n // CANDIDATE_BLOCK)

    def block(self):
        """The block of a row of the table: its cell, and a slice of it by a hash of the row's number."""
        count = [1] * (1 + max(self.cells, default=0))
        for c, n in zip(self.cells, self.blocks.tolist(), strict=True):
            count[c] = n
        slices = F.element_at(F.array(*map(F.lit, count)), F.col("cell") + 1)
        return F.col("cell").cast("long") * (1 << 32) + F.pmod(F.xxhash64("row"), slices)

    def hopeful(self, own: float, far: np.ndarray, kth: float) -> np.ndarray:
        """Blocks that may hold a product of ``kth`` or more with a query of squared norm ``own``."""
        blur = 2e-6 * (3 * np.sqrt(np.maximum(self.norm, own))[:, None] + np.maximum(self.high, far))
        least = np.maximum(np.maximum(self.low - far, far - self.high) - blur, 0).max(axis=1)
        slack = 0.01 + 1e-9 * (self.norm + own)
        bound = np.floor(np.minimum((self.norm + own - least**2) / 2, np.sqrt(self.norm * own)) + slack)
        some = [(self.cells[i] << 32) + np.arange(self.blocks[i]) for i in np.flatnonzero(bound >= kth)]
        return np.concatenate(some) if some else np.empty(0, np.int64)


class Block:
    """One block of candidates, held once for all queries that come to it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors, far = ids[by_id], vectors[by_id], distances[by_id].T
        self.norms = _norms(self.vectors)
        self.slack, self.greatest = 0.01 + 1e-9 * self.norms, self.norms.max()
        self.farthest = far.max(axis=1)
        self.far = np.ascontiguousarray(far.astype(np.float32))
        self.apart = np.empty_like(self.far)
        self.held: dict[type, np.ndarray] = {}

    def products(self, at: np.ndarray, query: np.ndarray, own: float) -> np.ndarray:
        """Exact products, in the narrowest kind that holds every whole number of them."""
        reach = np.sqrt(self.greatest * own)  # no product or sum of some of them exceeds it
        kind = np.float32 if reach < 1 << 23 else np.float64 if reach < 1 << 52 else np.int64
        if kind not in self.held:
            self.held = {kind: self.vectors.astype(kind)}
        return (self.held[kind][at] @ query.astype(kind)).astype(np.int64)

    def best(self, query_id: int, query: np.ndarray, far: np.ndarray, k: int, kth: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates of other ids that reach ``kth``."""
        own = float((query.astype(np.float64) ** 2).sum())
        # rounding of norms, and of distances to each pivot, whose own length counts too (at most that of a vector
        # and its distance): single precision and the square root of a cancelled sum
        blur = 2e-6 * (3 * np.sqrt(max(self.greatest, own)) + np.maximum(self.farthest, far))
        apart = np.abs(np.subtract(self.far, far.astype(np.float32)[:, None], out=self.apart), out=self.apart)
        least = np.subtract(apart, blur.astype(np.float32)[:, None], out=apart).max(axis=0).astype(np.float64)
        bound = np.floor((self.norms + own - np.maximum(least, 0) ** 2) / 2 + self.slack + 1e-9 * own)
        bound[np.searchsorted(self.ids, query_id) : np.searchsorted(self.ids, query_id, "right")] = -np.inf
        todo = np.flatnonzero((bound >= kth) & (bound > -np.inf))
        if len(todo) > FIRST:  # the first step needs no order within it
            todo = todo[np.argpartition(-bound[todo], FIRST - 1)]
        at, score, step, begin, ordered = todo[:0], np.empty(0, np.int64), FIRST, 0, len(todo) <= FIRST
        while begin < len(todo):
            if begin and not ordered:
                rest = todo[begin:]
                rest = rest[bound[rest] >= kth]
                todo, begin, ordered = rest[np.argsort(-bound[rest], kind="stable")], 0, True
                continue
            now = todo[begin : begin + step]
            if ordered and bound[now[0]] < kth:
                break  # bounds only fall from here: the answer is complete
            new = self.products(now, query, own)
            at, score = np.concatenate([at, now]), np.concatenate([score, new])
            if len(score) >= k:
                top = np.argpartition(-score, k - 1)
                kth = max(kth, int(score[top[k - 1]]))
                keep = score >= kth
                at, score = at[keep], score[keep]
            begin, step = begin + step, 2 * step
        keep = score >= kth
        at, score = at[keep], score[keep]
        first = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[first]], score[first]


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The batches cut where one of ``names`` changes."""
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in names])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield tuple(keys[:, a].tolist()), batch.slice(a, b - a)


def _read(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    whole = [
        (p.column("vec_id").to_numpy(), _matrix(p.column("vector"), np.int64), _matrix(p.column("distances"), np.float64)) for p in parts
    ]
    return tuple(map(np.concatenate, zip(*whole, strict=True)))


def at_home(dealt: DataFrame, tasks: int, k: int, every: int) -> DataFrame:
    """Each query with the k best of the block it lies in, and the k-th score if there are k."""

    def settle(parts: list[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
        ids, vectors, distances = _read(parts)
        here, rows = Block(ids, vectors, distances), np.concatenate([p.column("row").to_numpy() for p in parts])
        asking = np.flatnonzero(ids % every == 0)
        for chunk in np.array_split(asking, -(-len(asking) // SENT) or 1):
            answers = [here.best(int(ids[i]), vectors[i], distances[i], k, -np.inf) for i in chunk]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[chunk], pa.int64()),
                    pa.array(ids[chunk], pa.int64()),
                    pa.array([vectors[i].tobytes() for i in chunk], pa.binary()),
                    pa.array([distances[i].tobytes() for i in chunk], pa.binary()),
                    pa.array([block] * len(chunk), pa.int64()),
                    pa.array([int(s[-1]) if len(s) == k else None for _, s in answers], pa.int64()),
                    pa.array(
                        [[{"vec_id": i, "score": s} for i, s in zip(a.tolist(), b.tolist(), strict=True)] for a, b in answers],
                        pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.int64())])),
                    ),
                ],
                ["row", "vec_id", "vector", "distances", "block", "kth", "found"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for (block,), part in _runs(batches, ["block"]):
            if block != held and parts:
                yield from settle(parts, held)
                parts = []
            held = block
            parts.append(part)
        if parts:
            yield from settle(parts, held)

    return dealt.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(run, HOME)


def sent_out(home: DataFrame, bounds: Bounds, parts: int, places_only: bool) -> DataFrame:
    """A row for every block that a query has still to visit; or, with ``places_only``, the (block, part) visited."""

    def targets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        far, norms = _matrix(batch.column("distances"), np.float64), _norms(_matrix(batch.column("vector"), np.int64))
        columns = (batch.column(c).to_pylist() for c in ("part", "block", "kth"))
        for i, (part, home_block, kth) in enumerate(zip(*columns, strict=True)):
            blocks = bounds.hopeful(norms[i], far[i], -np.inf if kth is None else kth)
            yield i, part, blocks[blocks != home_block]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, part, blocks in targets(batch) if len(batch) else ():
                seen[part] = np.union1d(seen[part], blocks) if part in seen else blocks
        for part, blocks in seen.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "part": pa.array([part] * len(blocks), pa.int32())})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whom, where, n = [], [], 0
            for i, _, blocks in targets(batch) if len(batch) else ():
                for a in range(0, len(blocks), SENT):
                    some = blocks[a : a + SENT]
                    whom.append(np.full(len(some), i))
                    where.append(some)
                    n += len(some)
                    if n >= SENT:
                        yield letters(batch, whom, where)
                        whom, where, n = [], [], 0
            if n:
                yield letters(batch, whom, where)

    def letters(batch: pa.RecordBatch, whom: list, where: list) -> pa.RecordBatch:
        rows = batch.take(pa.array(np.concatenate(whom)))
        columns = [pa.array(np.concatenate(where), pa.int64()), rows.column("part"), pa.array([1] * len(rows), pa.int32())]
        names = ["vec_id", "vector", "distances", "kth"]
        return pa.RecordBatch.from_arrays(columns + [rows.column(c) for c in names], ["block", "part", "kind", *names])

    asking = home.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")).drop("found")
    if places_only:
        return asking.mapInArrow(places, "block long, part int").distinct()
    return asking.mapInArrow(send, VISIT)


def visited(letters: DataFrame, candidates: DataFrame, tasks: int, k: int) -> DataFrame:
    """What queries find in the blocks they are sent to.  A task reads a block's candidates first, holds them, and
    lets the queries stream past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, here = None, [], None
        for (block, part, kind), some in _runs(batches, ["block", "part", "kind"]):
            if (block, part) != held:
                held, parts, here = (block, part), [], None
            if kind == 0:
                parts.append(some)
                continue
            if here is None:
                here, parts = Block(*_read(parts)), []
            ids, vectors, distances = _read([some])
            out = []
            for i, kth in enumerate(some.column("kth").to_pylist()):
                a, s = here.best(int(ids[i]), vectors[i], distances[i], k, -np.inf if kth is None else kth)
                out.append((np.full(len(a), ids[i]), a, s))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    both = letters.unionByName(candidates).repartition(tasks, "block", "part").sortWithinPartitions("block", "part", "kind")
    return both.mapInArrow(run, FOUND)


def top_k(embeddings: DataFrame, k: int = 20, scale: float = 64.0, every: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each row of ``embeddings`` (vec_id, embedding) whose vec_id is
    divisible by ``every``, against all rows of other vec_ids: the ``k`` highest inner products of the vectors
    floor(scale * x), ties to the smaller vec_id; all if there are fewer.

    Scores are exact as long as they fit 64 bits (beyond 2^52 they are whole-number products).  Null vectors, those
    with null or non-finite components, and null ids take no part; rows that repeat a vec_id are
    candidates each, and as queries share one answer, the best of all their products; shorter
    vectors count as padded with zeros; other columns are ignored; an empty table gives no rows."""
    spark = embeddings.sparkSession
    prepare(spark)
    rows = written(quantised(embeddings, scale), "vectors")
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.sum((F.col("vec_id") % every == 0).cast("int")).alias("q")).first()
    width = totals.width or 1
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(PIVOT_SAMPLE).collect()  # a bounded sample
    padded = np.zeros((len(sample), width))
    for line, r in zip(padded, sample, strict=True):
        line[: len(r.v)] = r.v
    pivots = choose_pivots(padded, PIVOTS)
    cells = Cells(padded, pivots, min(MOST_CELLS, -(-totals.n // CANDIDATE_BLOCK)) or 1)
    table = written(pivot_table(rows, pivots, width, cells), "pivot-table")
    bounds = Bounds(table)
    dealt = table.withColumn("block", bounds.block())
    parts = -(-(totals.q or 0) // QUERY_BLOCK) or 1
    tasks = lambda groups: max(2 * groups, shuffle_partitions(spark))
    blocks = int(bounds.blocks.sum())
    home = written(at_home(dealt, tasks(blocks), k, every), "home-answers")
    places = written(sent_out(home, bounds, parts, places_only=True), "places")
    candidates = dealt.join(places, "block").select(
        "block", "part", F.lit(0).alias("kind"), "vec_id", "vector", "distances", F.lit(None).cast("long").alias("kth")
    )
    found = visited(sent_out(home, bounds, parts, places_only=False), candidates, tasks(blocks * parts), k)
    at_first = home.select(F.col("vec_id").alias("query_id"), F.inline("found"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = at_first.unionByName(found).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
