"""JSON documents (manifests, annotation files) read with an explicit schema.

Only the fields in the schema are materialised.  ``FAILFAST``: a malformed document fails
the job, as a strict parser would, instead of turning into a row of nulls.  A
``multiLine`` file is one document and cannot be split, so parallelism comes from having
many files; JSON-lines files (one document per line) split normally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.session import listing_by_the_core


def read_json_docs(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    multi_line: bool = True,
    with_path: bool = False,
) -> DataFrame:
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
    with listing_by_the_core(spark):
        df = reader.json(paths)
    if with_path:
        from pyspark.sql import functions as F

        # the file's path is given in its URL form; a plus sign is itself there
        df = df.withColumn("source_path", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    return df
