"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and returns the DataFrame
that, written as Parquet and read again, is the next one's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.exact_dedup import without_copies
from quarry.llm.near_dedup import without_near_copies
from quarry.llm.packing import pack_documents
from quarry.llm.quality import score_quality
from quarry.llm.queries import documents, labels, query, vocabulary_path
from quarry.llm.shared import prepare, written
from quarry.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CARRIED = tuple(COLUMNS[1:])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon finds toxic go."""
    scored = score_toxicity(docs, labels(spark, sf_dir), carry=CARRIED)
    return scored.where("predicted = 0").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as low quality go."""
    scored = score_quality(docs, labels(spark, sf_dir), carry=CARRIED)
    return scored.where("predicted = 1").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return without_copies(docs).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, that of the smallest doc_id."""
    return without_near_copies(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack_documents(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("packing", packing),
]

#: Learned lexicons, kernels and sketches have no SQL form; tests compare with brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    prepare(spark)
    docs = documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
