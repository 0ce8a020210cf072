"""Best-fit packing of token sequences, planned on the histogram of lengths.

Only counts reach the driver: at most ``capacity`` of them.  Best-fit decreasing runs over the
counts (all pieces of one length at once, bins of one remaining capacity at once), and gives
runs: the pieces of this length with ranks from here to there go into those sequences at that
offset.  Pieces take their places by joining on their rank within the length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import BYTE_ALPHABET, Vocabulary
from quarry.llm.shared import map_text, rank_within, small_batches, text_of, written

#: The byte-level word rule for texts of ASCII and the accented letters of Latin-1 alone.
PLAIN_TEXT = re.compile("[\n -~À-ÖØ-öø-ÿ]*")
PLAIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\\s+(?!\\S)|\\s+")


#: The byte alphabet by byte; 0 stands between words.
SPELLING = np.array([0, *(ord(BYTE_ALPHABET[b]) for b in range(1, 256))], "<u4")


class UnitNumbers(dict):
    """Numbers units in the order they are first asked for; ``new`` are those whose ids are not there yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.given = 0

    def __missing__(self, unit: str) -> int:
        number = self[unit] = self.given
        self.given += 1
        self.new.append(unit)
        return number


class SpacedTokenizer:
    """Ids of whole texts by the ``tokenizers`` library, remembered per unit.

    A text of common letters is cut into the words of the vocabulary's own rule.  Any other is
    cut at spaces before visible characters: such a space begins a token whatever stands
    before it.  The library encodes each distinct unit once, a word of the rule by its model alone; ids lie
    in one array, and a text gathers its units' ids from there.  Lives as long as the Python worker and begins anew when it holds much."""

    CUT = re.compile(r"(?= \S)")
    MOST_UNITS, MOST_IDS = 200_000, 4 << 20
    GATHERED = 1 << 18  # units whose ids are gathered at a time

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_str(spec)
        parsed = json.loads(spec)
        before = parsed["pre_tokenizer"] or {}
        self.plain_rule = (
            parsed["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        )
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self._begin()

    def _begin(self) -> None:
        self.units = UnitNumbers()
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _is_plain(self, text: str) -> bool:
        return bool(self.plain_rule and PLAIN_TEXT.fullmatch(text) and not (self.special and self.special.search(text)))

    def _learn(self, are_words: bool) -> None:
        """Ids of all new units, behind those known."""
        new, self.units.new = self.units.new, []
        if not new:
            return
        if are_words:
            model = self.library.model.tokenize
            spelled = SPELLING[np.frombuffer("\0".join(new).encode(), np.uint8)].tobytes().decode("utf-32-le").split("\0")
            found = [[t.id for t in model(w)] for w in spelled]
        else:
            found = [e.ids for e in self.library.encode_batch_fast(new, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), "<u4", int(counts.sum()))
        first = self.units.given - len(new)
        if self.units.given > len(self.starts):
            more = max(self.units.given, 2 * len(self.starts)) - len(self.starts)
            self.starts, self.lengths = np.pad(self.starts, (0, more)), np.pad(self.lengths, (0, more))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.pad(self.ids[: self.used], (0, max(len(ids), self.used)))
        self.starts[first : first + len(new)] = self.used + np.cumsum(counts) - counts
        self.lengths[first : first + len(new)] = counts
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        for u in new:
            if len(u) > 512:  # one long unit is not worth keeping
                del self.units[u]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if self.units.given > self.MOST_UNITS or self.used > self.MOST_IDS:
            self._begin()
        plain = [self._is_plain(t) for t in texts]
        order, sizes, numbers = [], [], []
        for kind, cut in ((True, PLAIN_WORDS.findall), (False, self.CUT.split)):
            of_kind = [i for i, p in enumerate(plain) if p == kind]
            units = [cut(texts[i]) for i in of_kind]
            order += of_kind
            sizes += map(len, units)
            numbers.append(np.fromiter(map(self.units.__getitem__, chain.from_iterable(units)), np.int64, sum(map(len, units))))
            del units
            self._learn(kind)
        numbers = np.concatenate(numbers)
        parts = []
        for begin in range(0, len(numbers), self.GATHERED):
            some = numbers[begin : begin + self.GATHERED]
            counts = self.lengths[some]
            ends = np.cumsum(counts)
            parts.append(self.ids[np.arange(ends[-1]) + np.repeat(self.starts[some] - ends + counts, counts)])
        ids = np.concatenate(parts) if parts else self.ids[:0]
        edges = np.append(0, np.cumsum(self.lengths[numbers]))[np.append(0, np.cumsum(sizes, dtype=np.int64))].tolist()
        found = dict(zip(order, zip(edges, edges[1:], strict=False), strict=True))
        return [ids[slice(*found[i])].tobytes() for i in range(len(texts))]


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and ``end_id``, cut if
    longer than ``capacity`` so that only the first piece may be shorter."""
    spec = Vocabulary(docs.sparkSession, vocabulary_path)
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        found = spec.kept(SpacedTokenizer).encode(batch.column("text").to_pylist())
        for doc, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
            ids += end
            total = len(ids) // 4
            edges = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
            rows += [(doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return map_text(rows, "doc_id long, piece int, start long, length long, ids_crc32 long", cut)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.  Runs (length, first rank, end rank, first sequence,
    pieces per sequence, offset of the first); a run takes all sequences of one range or all
    pieces left, so there are O(capacity) runs whatever the counts."""
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by remaining capacity: ranges (first, n)
    runs, sequences = [], 0

    def fill(length: int, rank: int, count: int, first: int, n: int, room: int) -> int:
        """Puts up to ``count`` pieces into sequences first .. first+n-1; returns how many."""
        each = room // length
        full = min(n, count // each)
        done = full * each
        if full:
            runs.append((length, rank, rank + done, first, each, capacity - room))
            free[room - each * length].append((first, full))
        if full < n and done < count:  # the last pieces share one sequence
            runs.append((length, rank + done, rank + count, first + full, count - done, capacity - room))
            free[room - (count - done) * length].append((first + full, 1))
            full, done = full + 1, count
        if full < n:
            free[room].append((first + full, n - full))
        return done

    for length in sorted(histogram, reverse=True):
        count, rank = histogram[length], 0
        room = length
        while rank < count:
            while room <= capacity and not free[room]:
                room += 1
            if room > capacity:
                need = -(-(count - rank) // (capacity // length))
                rank += fill(length, rank, count - rank, sequences, need, capacity)
                sequences += need
            else:
                first, n = free[room].pop()
                rank += fill(length, rank, count - rank, first, n, room)
    return runs


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with doc_id, piece, length and any more columns) with sequence_id and offset: no
    sequence exceeds ``capacity``, offsets are gapless from 0.  Lengths are 1 to ``capacity``.
    Building the frame counts the pieces of each length."""
    spark = pieces.sparkSession
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    runs = spark.createDataFrame(
        plan(histogram, capacity), "of_length long, begin long, end long, first_sequence long, each long, at long"
    )
    ranked = rank_within(pieces, "length", [c for c in pieces.columns if c != "length"])
    step = F.col("rank") - F.col("begin")
    return (
        ranked.join(
            F.broadcast(runs),  # O(capacity) rows
            (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("end")),
        )
        .withColumn("sequence_id", F.col("first_sequence") + F.expr("(rank - begin) div each"))
        .withColumn("offset", F.col("at") + step % F.col("each") * F.col("length"))
        .drop("rank", "of_length", "begin", "end", "first_sequence", "each", "at")
    )


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text): doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    Null counts as empty: a document of the end id alone.  Repeated rows are packed each for
    itself; other columns are ignored; texts of any length are tokenized whole; an empty table gives
    no rows.  The pieces (not their ids) are written once to the shared folder."""
    return pack(written(pieces(docs, vocabulary_path, capacity, end_id), "pieces"), capacity)
