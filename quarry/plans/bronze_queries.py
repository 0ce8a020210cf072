"""Archive unpacking and bronze manifests on archives built from ``documents``
(S7, U3, K6, F6, X10, X11, X12, A3).

Stand-in deliveries: Spark packs the documents into zip archives of at most 50 documents
(one archive per block of doc ids, one folder per source inside, written by the executors
to shared scratch), then the bronze job lists and extracts them like any landing archive.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import bronze
from quarry.functions import keys as K
from quarry.plans.registry import register
from quarry.plans.standins import table
from quarry.session import scratch_path

DOCS_PER_ARCHIVE = 50


def _writer(root: str):
    def write_archive(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for src in sorted(pdf["source"].unique()):
                zf.writestr(f"{src}/", b"")  # a folder entry, which unpacking skips
            for r in pdf.sort_values("doc_id").itertuples():
                zf.writestr(f"{r.source}/{r.lang}/doc_{r.doc_id}.txt", r.text.encode("utf-8"))
        path = f"{root}/docs-{block}.zip"
        with bronze._open_out(path) as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"archive_path": [path], "n": [len(pdf)]})

    return write_archive


def build_archives(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    root = root or scratch_path(spark, "landing-archives")
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "text", "source", F.floor(F.col("doc_id") / DOCS_PER_ARCHIVE).alias("block")
    )
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = d.repartition(n, "block")  # given as a number, it is not merged by the bytes before they are packed
    d.groupBy("block").applyInPandas(_writer(root), "archive_path string, n long").count()
    return root


def _unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = build_archives(spark, sf_dir)
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(root).select("path")
    return bronze.unpack(archives)


SQL_DOCS = f"""
dz AS (SELECT 'docs-' || CAST(doc_id // {DOCS_PER_ARCHIVE} AS VARCHAR) || '.zip' AS archive,
              source || '/' || lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text
       FROM documents)
"""


@register(
    "bronze_unpack",
    "S7 U3 K6 F6 X9 X11 X12",
    f"""WITH {SQL_DOCS}
SELECT archive, path, CAST(strlen(text) AS BIGINT) AS size_bytes, sha256(text) AS sha256,
       'text/plain' AS content_type
FROM dz""",
)
def bronze_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _unpacked(spark, sf_dir)
    return e.select(
        F.substring_index("archive_path", "/", -1).alias("archive"),
        "path",
        "size_bytes",
        F.sha2(F.col("content"), 256).alias("sha256"),
        K.content_type("path").alias("content_type"),
    )


@register(
    "bronze_manifest",
    "A3",
    f"""WITH {SQL_DOCS}
SELECT archive, count(*) AS file_count, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes, 'DONE' AS status
FROM dz GROUP BY archive""",
)
def bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per archive: listed files, total bytes and the drop's outcome (listing only; the
    manifest never needs the content)."""
    entries = bronze.list_entries(
        spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(build_archives(spark, sf_dir)).select("path")
    )
    out = bronze.drop_outcome(entries)
    return out.select(
        F.substring_index("archive_path", "/", -1).alias("archive"), "file_count", "total_bytes", "status"
    )
