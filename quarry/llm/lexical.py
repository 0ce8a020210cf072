"""Ranked lexical search by dense blocked matrix products.

The terms of a batch of items are the vocabulary.  One pass over the documents keeps of each its number of
terms and its vocabulary terms with their counts; collection statistics come from that compact table.
Items are cut into tiles, each with the compact vocabulary of its own terms; documents become
tiles of impacts (documents x vocabulary).  Both hold whole numbers as float64, and a tile's vocabulary is
cut where a partial sum could reach 2^53, so every product is exact.  Each tile keeps the k best
documents of each item, ties at the cut included until documents are compared by id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import map_text, prepare, shuffle_partitions, text_of, written

#: Items whose texts have about so many bytes are answered at once; further ones take another pass.
BATCH_BYTES = 8 << 20
ITEM_TILE, DOC_TILE = 64, 1_024
#: Whole numbers below this are exact in float64.
EXACT = 1 << 53
#: The impact of a term is below this: (10^9 tf) div (1000 tf + 8 m).
IMPACT = 10**6

#: A-Z to lower case, every other ASCII character that is no letter or digit to a space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or bytes([b]).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case."""
    return text.translate(_PLAIN).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def lengths_to_m(n_terms: np.ndarray, n: int, total: int) -> np.ndarray:
    """100 - 75 + ((75 * n_terms * n) div total)."""
    if len(n_terms) and 75 * int(n_terms.max()) * n >= 1 << 63:
        return np.array([25 + 75 * int(t) * n // total for t in n_terms], np.int64)
    return 25 + 75 * n_terms * n // total


COMPACT = "doc_id long, n long, terms array<int>, counts array<int>"


def compact(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with at least one term: the number of its
    terms, and its vocabulary terms with how often each occurs."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ns, terms, counts, ends = [], [], [], [], [0]
        texts = batch.column("text").cast(pa.binary())
        get = vocabulary.get
        for i in range(batch.num_rows):
            words = terms_of(texts[i].as_buffer().to_pybytes())
            if not words:
                continue
            held = Counter(map(get, words))
            held.pop(None, None)
            ids.append(i)
            ns.append(len(words))
            terms += held.keys()
            counts += held.values()
            ends.append(len(terms))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c, pa.int32())) for c in (terms, counts)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(ns, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), COMPACT, count)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row boundaries (from 0) and the values of a list column."""
    ends = column.offsets.to_numpy()
    return ends - ends[0], column.values.to_numpy()[ends[0] : ends[-1]]


def document_frequencies(table: DataFrame, size: int) -> dict[int, int]:
    """How many documents hold each of the ``size`` vocabulary terms: counted in the tasks, added up by
    Spark; the driver gets ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("terms"))[1], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["term", "df"])

    parts = table.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in parts.collect()}


class Tile:
    """Some items with the compact vocabulary of their terms: ``parts`` are (terms, weights as items x terms), cut so
    that no partial sum reaches 2^53."""

    def __init__(self, first: int, items: list[dict[int, int]], weights: np.ndarray):
        self.first, self.size = first, len(items)
        terms = sorted({t for item in items for t in item if weights[t] > 0})
        place = {t: i for i, t in enumerate(terms)}
        dense = np.zeros((len(items), len(terms)), object)
        for row, item in zip(dense, items, strict=True):
            for t, repeats in item.items():
                if t in place:
                    row[place[t]] = repeats * int(weights[t])
        self.parts, begin, sums = [], 0, np.zeros(len(items), object)
        for i in range(len(terms)):
            sums = sums + dense[:, i] * IMPACT
            if max(dense[:, i]) * IMPACT >= EXACT:
                raise OverflowError("an item repeats a term so often that one product passes 2^53")
            if max(sums) >= EXACT:
                self.parts.append((np.array(terms[begin:i]), dense[:, begin:i].astype(np.float64)))
                begin, sums = i, dense[:, i] * IMPACT
        if begin < len(terms):
            self.parts.append((np.array(terms[begin:]), dense[:, begin:].astype(np.float64)))

    def scores(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, vocabulary: int) -> np.ndarray:
        """(items, documents) of whole numbers, for documents given as entries (row, term, impact)."""
        total = np.zeros((self.size, n_docs), np.int64)
        for terms, weights in self.parts:
            place = np.full(vocabulary, -1)
            place[terms] = np.arange(len(terms))
            at = place[term]
            here = at >= 0
            block = np.zeros((n_docs, len(terms)))
            block[row[here], at[here]] = impact[here]
            total += (weights @ block.T).astype(np.int64)
        return total


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores above 0, equal ones by ascending id (the last bit of order is the place)."""
    hopeful = np.flatnonzero(scores > 0)
    if len(hopeful) > k:
        least = np.partition(scores[hopeful], -k)[-k]
        hopeful = hopeful[scores[hopeful] >= least]  # all that tie with the k-th
    return hopeful[np.lexsort((ids[hopeful], -scores[hopeful]))][:k]


NO_ID = -(1 << 63)  # stands for a null doc_id: before all others


def top_documents(table: DataFrame, items: list[dict[int, int]], weights: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score): the ``k`` best documents of each item in each task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [Tile(i, items[i : i + ITEM_TILE], weights) for i in range(0, len(items), ITEM_TILE)]
        kept = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items]
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(at, DOC_TILE)
                ids = part.column("doc_id").fill_null(NO_ID).to_numpy()
                m = lengths_to_m(part.column("n").to_numpy(), n, total)
                ends, term = _flat(part.column("terms"))
                tf = _flat(part.column("counts"))[1].astype(np.int64)
                row = np.repeat(np.arange(len(ids)), np.diff(ends))
                impact = (10**9 * tf // (1000 * tf + 8 * m[row])).astype(np.float64)
                for tile in tiles:
                    scores = tile.scores(row, term, impact, len(ids), len(weights))
                    for j in np.flatnonzero(scores.max(axis=1, initial=0) > 0):
                        old_ids, old_scores = kept[tile.first + j]
                        if len(old_ids) == k and scores[j].max() < old_scores[-1]:
                            continue
                        both_ids, both = np.concatenate([old_ids, ids]), np.concatenate([old_scores, scores[j]])
                        best = best_of(both, both_ids, k)
                        kept[tile.first + j] = both_ids[best], both[best]
        columns = np.repeat(np.arange(len(items)), [len(i) for i, _ in kept]), *(np.concatenate([x[c] for x in kept] or [[]]) for c in (0, 1))
        item, doc, score = (pa.array(c.astype(np.int64), pa.int64()) for c in columns)
        yield pa.RecordBatch.from_arrays([item, doc, score], ["item", "doc_id", "score"])

    found = table.mapInArrow(run, "item long, doc_id long, score long")
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID).cast("long")))


def ranked_search(items: DataFrame, docs: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents of ``docs`` (doc_id, text) with the highest scores above 0
    for each row of ``items`` (item_id, text), equal scores by ascending doc_id (null first).

    Null and empty texts have no terms: such documents count nowhere, such items give no rows.  Items and
    documents that repeat an id are each on their own.  Other columns are ignored; an empty
    table gives no rows.  Items are answered in batches of bounded size, each with its own pass over
    the documents.  Building the frame runs the passes that count."""
    spark = docs.sparkSession
    prepare(spark)
    asked = items.select(F.col("item_id").alias("item_id"), text_of().alias("text"))
    n_batches = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BATCH_BYTES))
    batch_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_batches))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(n_batches):
        rows = asked.where(batch_of == b).collect()  # about BATCH_BYTES of text
        counted = [(r.item_id, Counter(terms_of(r.text.encode()))) for r in rows]
        counted = [(i, c) for i, c in counted if c]
        if counted:
            found = _answered(docs, counted, k)
            names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(counted)], "item long, item_id long")
            out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def _answered(docs: DataFrame, counted: list[tuple], k: int) -> DataFrame:
    """(item, rank, doc_id, score) for one batch of items (id, counts of terms)."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
    table = written(compact(docs, vocabulary), "compact-documents")
    stats = table.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
    held = document_frequencies(table, len(vocabulary))
    weights = np.array([weight(stats.n, held[t]) if t in held else 0 for t in range(len(vocabulary))], np.int64)  # no document, no score
    queries = [{vocabulary[t]: r for t, r in c.items()} for _, c in counted]
    found = top_documents(table, queries, weights, stats.n, stats.total or 1, k)
    # the tasks' answers are merged in groups first, so that one item's rows never meet in one task all at once
    groups = F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(shuffle_partitions(docs.sparkSession)))))
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    some = Window.partitionBy("item", "_group").orderBy(*order)
    each = Window.partitionBy("item").orderBy(*order)
    merged = found.withColumn("_group", groups).withColumn("_rank", F.row_number().over(some)).where(F.col("_rank") <= k)
    return merged.withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")
