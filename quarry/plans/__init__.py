"""Queries over the driver's tables: each one composes library operators on stand-in
inputs derived from the given parquet tables, and carries a DuckDB oracle twin."""

from quarry.plans import bronze_queries, gold_queries, image_queries, job_queries, landing_queries, object_queries, silver_queries, stream_queries, table_queries  # noqa: F401  (registers)
from quarry.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
