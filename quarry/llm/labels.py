"""Labelled rows for fitting: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most about this many labelled rows are fitted on; beyond it a share of them, drawn by a hash of the id.
MAX_FIT_ROWS = 60_000
#: The sample is dealt over so many partitions, so that partial sums do not follow the number of scan tasks.
FIT_PARTITIONS = 32


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32(doc_id as text) leaves 0 modulo 5 are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, most: int = MAX_FIT_ROWS) -> DataFrame:
    """(text, label 0/1) of the labelled rows that may be learned from, ``most`` at most in
    expectation.  Null labels and null ids teach nothing; a document labelled more than once
    takes its largest label, and of rows that repeat its id the smallest text counts.  The sampled ids are broadcast (their number is bounded), so texts of
    other rows are dropped at the scan, not shuffled."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out()
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, most / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known.where(draw)), "doc_id")
    # combined before the exchange, so that an id many rows repeat is one row and in no task more than that
    once = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return once.repartition(FIT_PARTITIONS, "doc_id").select("text", "label")


def scored_rows(docs: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """(_text, doc_id, the columns ``carry`` besides doc_id), and the schema of all but the text."""
    others = [c for c in carry if c != "doc_id"]
    rows = docs.select(F.coalesce("text", F.lit("")).alias("_text"), F.col("doc_id").cast("long").alias("doc_id"), *others)
    return rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
