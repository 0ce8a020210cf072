"""quarry: a Spark-native medallion pipeline for third-party image deliveries.

Landing events -> ledger -> bronze objects and manifests -> silver image metadata and
tidy annotation tables -> gold category statistics and an ML-ready image manifest.
Every step is a DataFrame-in / DataFrame-out function on stock Spark.
"""

__version__ = "0.1.0"
