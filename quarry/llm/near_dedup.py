"""Near-duplicates by HyperMinHash sketches, banding, estimation and exact verification.

A document's set is its distinct word shingles.  Each bucket of the hash space keeps its smallest
hash as leading zeros and the mantissa after them, in 16 bits for the 128 registers that are banded,
in two-bit codes of 1,024 registers that documents with a candidate get for finer estimates.  Empty registers of small
sets borrow from a filled one in a fixed random order of their own, so that a register
agrees with the probability of the Jaccard similarity whatever the set's size.

Equal sets are one node.  Bands of registers give buckets of candidates.  No bucket's pairs are
listed: in a few rounds each bucket links its members to one hub, and members already
connected are not compared again; what is then left unconnected within a bucket is compared in
blocks, outsiders against all.  Every pair is first estimated from the sketches (corrected for
register collisions) and then confirmed on the full sets: those of a block's likely pairs go once to
the task that confirms them, which passes on a spanning forest of the links it finds.

Recall: a pair at the threshold 0.75 shares none of the 32 bands of 4 registers with
probability (1 - 0.75^4)^32 = 5e-6, and its estimate falls under the cut of ``ESTIMATE_MARGIN``
standard errors with probability 3e-7.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import connected_components, discard, map_text, prepare, small_batches, text_of, written



@dataclass(frozen=True)
class Layout:
    """A sketch of 2 ** ``bits`` registers with ``mantissa`` bits each besides ``zeros`` bits for the leading zeros."""

    bits: int
    zeros: int
    mantissa: int

    @property
    def registers(self) -> int:
        return 1 << self.bits

    @property
    def kind(self) -> np.dtype:
        return np.dtype(np.uint16 if self.zeros + self.mantissa > 8 else np.uint8)


BANDED, FINE = Layout(7, 6, 10), Layout(10, 5, 11)
#: Fine registers are compared by codes of so many bits, 32 of them in a word.
CODE_BITS = 2
REGISTERS = BANDED.registers
BAND = 4
BANDS = REGISTERS // BAND
ESTIMATE_MARGIN = 5.0
#: Members of one bucket compared at once, and bytes of full sets a task holds to confirm their pairs.
BLOCK = 2_048
SET_BYTES = 64 << 20
#: Rounds that link each bucket to one hub before what is left is compared in blocks.
HUB_ROUNDS = 3

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its ``width``-word shingles: ASCII
    lower-cased words between ASCII white space; a text with fewer words has its whole
    sequence as one shingle, one without words none."""
    from xxhash import xxh64_intdigest

    out = []
    multipliers = _mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    for text in texts:
        words = text.lower().split()
        n = len(words)
        if not n:
            out.append(np.empty(0, np.uint64))
            continue
        h = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
        k = min(width, n)
        total = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            total += h[j : n - k + 1 + j] * multipliers[j]
        out.append(np.unique(_mix(total)))
    return out


@functools.cache
def _borrow_order(registers: int) -> np.ndarray:
    """For each register (column) the registers it asks in turn while empty: a fixed random permutation each."""
    keys = _mix(np.arange(registers * registers, dtype=np.uint64) + np.uint64(12345)).reshape(registers, registers)
    return np.argsort(keys, axis=0, kind="stable").astype(np.int16)


def sketches(sets: list[np.ndarray], layout: Layout = BANDED) -> np.ndarray:
    """(len(sets), registers); rows of empty sets hold the largest number."""
    empty = np.iinfo(layout.kind).max
    out = np.full((len(sets), layout.registers), empty, layout.kind)
    rest_bits = 64 - layout.bits
    shift, low, most = np.uint64(rest_bits), np.uint64((1 << rest_bits) - 1), (1 << layout.zeros) - 2
    for row, s in zip(out, sets, strict=True):
        if len(s):  # sorted: the first hash of each bucket is its smallest
            bucket = (s >> shift).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            rest = s[first] & low
            bits = np.frexp((rest >> np.uint64(11)).astype(np.float64))[1] + 11  # length of rest in bits, 11 at least
            zeros = np.minimum(rest_bits - bits, most)
            mantissa = (rest >> (bits - 1 - layout.mantissa).astype(np.uint64)).astype(np.int64) & ((1 << layout.mantissa) - 1)
            row[bucket[first]] = (zeros << layout.mantissa) | mantissa
    order = _borrow_order(layout.registers)
    full = out.copy()
    rows, cols = np.nonzero((out == empty) & (out != empty).any(axis=1)[:, None])
    for turn in range(layout.registers):
        if not len(rows):
            break
        got = out[rows, order[turn, cols]]
        full[rows, cols] = got
        missing = got == empty
        rows, cols = rows[missing], cols[missing]
    return full


def estimate(agree: np.ndarray, n: np.ndarray, m: np.ndarray, layout: Layout = BANDED) -> np.ndarray:
    """Jaccard similarity from the share of agreeing registers and the set sizes, without the
    agreements expected by collision of mantissas."""
    # fixed value: constant of the published collision approximation
    ratio = np.maximum(n, m) / np.maximum(1, np.minimum(n, m))
    by_chance = 0.169919487159739093975315012348 / (1 << layout.mantissa) * 4 * ratio / (1 + ratio) ** 2
    return np.clip((agree - by_chance) / (1 - by_chance), 0, 1)


def least_estimate(threshold: float, layout: Layout = BANDED) -> float:
    return threshold - ESTIMATE_MARGIN * math.sqrt(threshold * (1 - threshold) / layout.registers)


def codes(registers: np.ndarray) -> np.ndarray:
    """(rows, words): ``CODE_BITS`` of a hash of each fine register, 32 registers to a word."""
    at = np.arange(registers.shape[1], dtype=np.uint64) << np.uint64(16)
    code = _mix(registers.astype(np.uint64) + at) & np.uint64(3)
    shifts = np.arange(0, 64, CODE_BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(code.reshape(len(registers), -1, len(shifts)) << shifts, axis=2)


def code_estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal codes, without the quarter that are equal by chance."""
    other = x ^ y
    differ = np.bitwise_count((other | (other >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1, dtype=np.int64)
    return 1 - differ / FINE.registers * 4 / 3


def least_code_estimate(threshold: float) -> float:
    equal = 0.25 + 0.75 * threshold
    return threshold - ESTIMATE_MARGIN * math.sqrt(equal * (1 - equal) / FINE.registers) * 4 / 3


def band_marks(sketch: np.ndarray) -> np.ndarray:
    """(rows, bands) of 32 bits that stand for the bands of a sketch."""
    return (_mix(np.ascontiguousarray(sketch).view(np.uint64)) >> np.uint64(32)).astype(np.uint32)


SIGNATURE = "n_shingles long, digest binary, sketch binary"


def signatures(docs: DataFrame) -> DataFrame:
    """(n_shingles, digest of the full set, sketch, doc_id, text and the other columns) of every row."""
    own = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = ", ".join([SIGNATURE, *(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)])

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sketches(sets)], pa.binary()),
                *batch.columns,
            ],
            ["n_shingles", "digest", "sketch", *batch.schema.names],
        )

    return map_text(own, schema, sign)


def band_rows(nodes: DataFrame) -> DataFrame:
    """(node, band, bucket): one row per band of each node."""
    parts = [F.xxhash64(F.lit(b), F.substring("sketch", 1 + 2 * BAND * b, 2 * BAND)) for b in range(BANDS)]
    return nodes.select("node", F.posexplode(F.array(*parts)).alias("band", "bucket"))


def full_sets(signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n_shingles, shingles, fine, banded) for ``wanted`` (node), the rows of ``signed`` that stand for a
    set: the sorted set, the codes of the finer sketch and the marks of the bands as bytes."""
    joined = signed.select(F.col("row").alias("node"), text_of().alias("text")).join(wanted, "node")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())
        raw = [s.tobytes() for s in sets]
        fine = [c.tobytes() for c in codes(sketches(sets, FINE))]
        banded = [m.tobytes() for m in band_marks(sketches(sets))]
        columns = [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(c, pa.binary()) for c in (raw, fine, banded))]
        return pa.RecordBatch.from_arrays(columns, ["node", "n_shingles", "shingles", "fine", "banded"])

    return map_text(joined, "node long, n_shingles long, shingles binary, fine binary, banded binary", make)


def likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sketches agree well enough to be worth confirming."""
    a = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na"))
    b = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb"))
    sized = pairs.join(a, "a").join(b, "b").where(F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb"))
    least = least_estimate(threshold)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), BANDED.kind).reshape(-1, REGISTERS) for c in ("sa", "sb"))
                n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
                yield batch.select(["a", "b"]).filter(pa.array(estimate((x == y).mean(axis=1), n, m) >= least))

    return sized.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(keep, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    short, long = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(long, short)
    both = int((long[np.minimum(at, len(long) - 1)] == short).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on the full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for xa, xb in zip(batch.column("xa"), batch.column("xb"), strict=True):
                good.append(linked(*(np.frombuffer(s.as_buffer(), np.uint64) for s in (xa, xb)), percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "xa", "xb").mapInArrow(check, "a long, b long")


def hub_pairs(members: DataFrame, round_: int) -> DataFrame:
    """``members`` (bucket, node, comp): a bucket's hub is its smallest node at first, then its first in an
    order drawn for the round.  Every member is paired with one hub, that of another component with which
    it shares most buckets: at most one pair per member and round."""
    order = F.col("node") if round_ == 0 else F.xxhash64("node", F.lit(round_))
    hubs = (
        members.groupBy("bucket")
        .agg(F.min_by("node", order).alias("hub"), F.min_by("comp", order).alias("hub_comp"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        .where("lo <> hi")
        .select("bucket", "hub", "hub_comp")
    )
    common = members.join(hubs, "bucket").where("comp <> hub_comp").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    best = common.groupBy("node").agg(F.max_by("hub", "n").alias("hub"))
    return best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _by_cell(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, list[list]]]:
    """(cell, its columns) for batches sorted by cell."""
    cell, held = None, [[] for _ in names]
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        ends = [*(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)] if len(cells) else []
        columns, begin = [batch.column(n) for n in names], 0
        for end in ends:
            if cells[begin] != cell:
                if held[0]:
                    yield cell, held
                cell, held = cells[begin], [[] for _ in names]
            for h, c in zip(held, columns, strict=True):
                h += c.slice(begin, end - begin).to_pylist()
            begin = end
    if held[0]:
        yield cell, held


def _listed(cell: int, a: np.ndarray, b: np.ndarray, sizes: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """The pairs of a cell as (cell, node, partners): a row for each node that has a pair, with those it is the first
    of.  A cell whose sets are more than ``SET_BYTES`` is cut by hashes of both nodes."""
    cuts = -(-sum(8 * sizes[x] for x in np.unique(np.concatenate([a, b])).tolist()) // SET_BYTES)
    part = (_mix(a.view(np.uint64)) % np.uint64(cuts)) * np.uint64(cuts) + _mix(b.view(np.uint64)) % np.uint64(cuts)
    for p in np.unique(part):
        x, y = a[part == p], b[part == p]
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        first, begins = np.unique(x, return_index=True)
        rest = np.setdiff1d(y, first)
        ends = np.concatenate([begins, np.full(len(rest) + 1, len(y))])
        name = _mix(np.array([cell], np.int64).view(np.uint64) + p).view(np.int64)
        columns = [np.repeat(name, len(first) + len(rest)), np.concatenate([first, rest])]
        partners = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(y, pa.int64()))
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), partners], ["cell", "node", "partners"])


def block_pairs(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """All likely pairs of one bucket and different components, as (cell, node, partners).

    Of each bucket the component with most members is its bulk; the others, the outsiders,
    meet one another and the bulk, and bulk never meets bulk.  Both are dealt into blocks of about
    ``BLOCK`` members; a cell is two blocks, so a task holds two however large the bucket.  A pair
    is looked at in the bucket of its first common band alone, and there in one cell."""
    sizes = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    buckets = (
        sizes.groupBy("bucket")
        .agg(F.max_by("comp", "n").alias("bulk"), F.max("n").alias("n_bulk"), F.sum("n").alias("n_all"))
        .where("n_all > n_bulk")
        .select(
            "bucket",
            "bulk",
            F.ceil((F.col("n_all") - F.col("n_bulk")) / BLOCK).cast("int").alias("outs"),
            F.ceil(F.col("n_bulk") / BLOCK).cast("int").alias("bulks"),
        )
    )
    known = sets.select("node", "n_shingles", "fine", "banded")
    is_out = (F.col("comp") != F.col("bulk")).alias("out")
    dealt = members.join(buckets, "bucket").select("bucket", "band", "node", "comp", "outs", "bulks", is_out).join(known, "node")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("out"), F.col("outs")).otherwise(F.col("bulks"))).cast("int")
    # blocks of outsiders count from 0, those of the bulk go on after them; a cell is a pair of blocks, an outsider block first
    block = F.when(F.col("out"), own).otherwise(F.col("outs") + own)
    meets = F.when(F.col("out"), F.sequence(F.lit(0), F.col("outs") + F.col("bulks") - 1)).otherwise(F.sequence(F.lit(0), F.col("outs") - 1))
    spread = dealt.withColumn("block", block).withColumn("other", F.explode(meets))
    cell = F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("cell")
    least = least_code_estimate(threshold)
    names = ["band", "block", "out", "node", "comp", "n_shingles", "fine", "banded"]

    def compare(band, block, out, node, comp, n, fine, banded) -> tuple[list[int], list[int]]:
        order = np.argsort(~np.array(out), kind="stable")  # outsiders first
        block, node, comp, n = (np.array(c, np.int64)[order] for c in (block, node, comp, n))
        if (comp == comp[0]).all():
            return [], []
        fine = np.frombuffer(b"".join(fine), np.uint64).reshape(len(node), -1)[order]
        before = np.frombuffer(b"".join(banded), np.uint32).reshape(len(node), -1)[order, : band[0]]
        apart, found = block.min() != block.max(), ([], [])
        for k in range(min(sum(out), len(node) - 1)):
            rest = slice(k + 1, None)
            hopeful = (comp[rest] != comp[k]) & (np.minimum(n[rest], n[k]) >= threshold * np.maximum(n[rest], n[k]))
            if apart:
                hopeful &= block[rest] != block[k]
            other = k + 1 + np.flatnonzero(hopeful)
            other = other[~(before[other] == before[k]).any(axis=1)]
            good = other[code_estimate(fine[other], fine[k]) >= least]
            found[0].extend(np.minimum(node[good], node[k]).tolist())
            found[1].extend(np.maximum(node[good], node[k]).tolist())
        return found

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, columns in _by_cell(batches, names):
            a, b = compare(*columns) if len(columns[0]) > 1 else ((), ())
            if a:
                sizes = dict(zip(columns[names.index("node")], columns[names.index("n_shingles")], strict=True))
                yield from _listed(at, np.array(a, np.int64), np.array(b, np.int64), sizes)

    return spread.select(cell, *names).repartition("cell").sortWithinPartitions("cell").mapInArrow(groups, LISTED)


LISTED = "cell long, node long, partners array<long>"


def confirmed_in_cells(listed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect whatever the confirmed pairs of ``listed`` (cell, node, partners) connect within a
    cell.  The set of a node goes to a cell once, however many pairs it has there."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (nodes, partners, shingles) in _by_cell(batches, ["node", "partners", "shingles"]):
            held = {x: np.frombuffer(s, np.uint64) for x, s in zip(nodes, shingles, strict=True)}
            root = {x: x for x in nodes}

            def top(x):
                while root[x] != x:
                    root[x] = x = root[root[x]]  # noqa: B023
                return x

            a, b = [], []
            for x, ys in zip(nodes, partners, strict=True):
                for y in ys:
                    if top(x) != top(y) and linked(held[x], held[y], percent):
                        root[top(x)] = top(y)
                        a.append(x)
                        b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = listed.join(sets.select("node", "shingles"), "node").select("cell", "node", "partners", "shingles")
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(check, "a long, b long")


def near_dedup(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs of characters outside [\\x20\\x09-\\x0D], A-Z lower-cased.  Rows are linked when
    100 * intersection >= ``percent`` * union of their sets of 5-word shingles; component_id is
    the smallest doc_id reachable over links, kept says that it is the row's own.  A text with
    one to four words has its sequence as the one shingle; null, empty and blank texts have
    none, are linked with nothing and kept.  Rows that repeat a doc_id are documents of their own;
    null ids never name a component unless all its ids are null.  Other columns are ignored;
    an empty table gives no rows.  Building the frame runs the rounds described above."""
    prepare(docs.sparkSession)
    small_batches(docs.sparkSession)
    signed = written(signatures(docs.select("doc_id", "text")).withColumn("row", F.monotonically_increasing_id()), "signatures")
    labelled = _labelled(signed, percent)
    groups = labelled.groupBy("comp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # written, so that both sides of the join come from an exchange and a large component can be split
    joined = labelled.join(written(groups.select("comp", "least_id", "n"), "groups"), "comp", "left")
    component = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("least_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_copies(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others), one of each group that ``near_dedup`` links: the one with
    the smallest doc_id (null ids last), and of several rows with it one.  Rows are told apart by
    a number of their own, so null and repeated ids bring no copy back."""
    prepare(docs.sparkSession)
    small_batches(docs.sparkSession)
    others = [F.struct(*(c for c in docs.columns if c not in ("doc_id", "text"))).alias("_others")] if len(docs.columns) > 2 else []
    signed = written(signatures(docs.select("doc_id", "text", *others)).withColumn("row", F.monotonically_increasing_id()), "signatures")
    labelled = written(_labelled(signed, percent), "labelled")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "row")).alias("first")
    groups = labelled.groupBy("comp").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").select("comp", F.col("first.row").alias("keep"))
    copies = labelled.join(written(groups, "groups"), "comp").where("row <> keep").select("row")
    left = signed.join(copies, "row", "left_anti")
    own = dict(docs.dtypes)
    columns = [F.col(c).cast(own[c]).alias(c) if c in ("doc_id", "text") else F.col("_others")[c].alias(c) for c in docs.columns]
    return left.select(*columns)


def _labelled(signed: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n_shingles, row, comp) of every row of ``signed``."""
    threshold = percent / 100
    classes = (
        signed.where("n_shingles > 0").groupBy("digest").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("members"))
    )
    classes = written(classes, "classes")
    nodes = signed.join(classes.select("node"), F.col("row") == F.col("node")).select(
        "node", "n_shingles", "sketch"
    )
    nodes = written(nodes, "nodes")
    bands = band_rows(nodes)
    shared_buckets = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = written(bands.join(shared_buckets, "bucket", "left_semi"), "members")
    comps = _components(signed, nodes, members, threshold, percent)
    of_class = classes.select("digest", "node").join(comps, "node", "left").select("digest", F.coalesce("comp", "node").alias("comp"))
    # rows without shingles stand alone
    labelled = signed.select("doc_id", "n_shingles", "digest", "row").join(of_class, "digest", "left")
    return labelled.select("doc_id", "n_shingles", "row", F.when(F.col("n_shingles") == 0, F.col("row")).otherwise(F.col("comp")).alias("comp"))


def _components(signed: DataFrame, nodes: DataFrame, members: DataFrame, threshold: float, percent: int) -> DataFrame:
    """(node, comp) for the nodes that share a bucket with another."""
    comps = written(members.select("node").distinct().withColumn("comp", F.col("node")), "comps")
    sets = written(full_sets(signed, members.select("node").distinct()), "sets")
    for round_ in range(HUB_ROUNDS + 1):
        grouped = members.join(comps, "node").select("bucket", "band", "node", "comp")
        pairs = None
        if round_ < HUB_ROUNDS:
            links = written(confirmed(likely(hub_pairs(grouped, round_), nodes, threshold), sets, percent), "links")
        else:
            pairs = written(block_pairs(grouped, sets, threshold), "block-pairs")
            links = written(confirmed_in_cells(pairs, sets, percent), "links")
        if not links.isEmpty():
            a, b = (comps.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")) for c in "ab")
            edges = links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b").distinct()
            joined = connected_components(edges)
            moved = joined.select(F.col("node").alias("comp"), F.col("component").alias("to"))
            newer = written(comps.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "comps")
            discard(comps, joined)
            comps = newer
        discard(links, pairs)
    discard(sets)
    return comps
