"""Command line for the jobs (``spark-submit -m`` style: ``python -m quarry.cli <job> ...``).

The session comes from the cluster's configuration (``getOrCreate``); all paths are below
``--root`` on shared storage.

    register    --root R --events PATH [--batch-id N]     landing events (JSON) -> ledger
    bronze      --root R                                  pending drops -> bronze + manifests
    silver      --root R [--checkpoint C]                 manifests -> staging (stream, available-now)
    silver-build --root R [--ingest-date D]               staging -> silver tables
    compact-ledger --root R [--keep-last N]               fold old ledger batch partitions
    gold-build  --root R --partner P --images-dataset I --annotations-dataset A
                --split S --ingest-date D [--mode replace|partitions]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from quarry import jobs
from quarry.session import BASE_CONF, qualified


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("quarry").getOrCreate()
    for k in (
        "spark.sql.session.timeZone",
        "spark.sql.sources.partitionOverwriteMode",
        "spark.sql.execution.arrow.maxBytesPerBatch",
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold",
    ):
        spark.conf.set(k, BASE_CONF[k])
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarry")
    sub = p.add_subparsers(dest="job", required=True)
    r = sub.add_parser("register")
    r.add_argument("--events", required=True)
    r.add_argument("--batch-id", type=int, help="replay this batch; a fresh id is taken when not given")
    sub.add_parser("bronze")
    s = sub.add_parser("silver")
    s.add_argument("--checkpoint")
    c = sub.add_parser("compact-ledger")
    c.add_argument("--keep-last", type=int, default=16)
    b = sub.add_parser("silver-build")
    b.add_argument("--ingest-date")
    g = sub.add_parser("gold-build")
    for a in ("--partner", "--images-dataset", "--annotations-dataset", "--split", "--ingest-date"):
        g.add_argument(a, required=True)
    g.add_argument("--mode", choices=["replace", "partitions"], default="replace")
    for sp in sub.choices.values():
        sp.add_argument("--root", required=True)
    args = p.parse_args(argv)

    spark = _session()
    layout = jobs.Layout(qualified(spark, args.root))
    if args.job == "register":
        from quarry.streaming.ledger import read_events

        events = read_events(spark, args.events)
        out = {"registered": jobs.register_events(spark, layout, events, args.batch_id)}
    elif args.job == "bronze":
        jobs.bronze_job(spark, layout, jobs.pending_drops(spark, layout))
        out = {"bronze": "done"}
    elif args.job == "silver":
        from quarry.streaming import manifests

        ck = args.checkpoint or f"{args.root.rstrip('/')}/checkpoints/silver"
        manifests.start_silver_stream(spark, layout, ck).awaitTermination()
        out = {"silver": "done"}
    elif args.job == "compact-ledger":
        from quarry.streaming.ledger import compact_ledger

        out = {"compacted_rows": compact_ledger(spark, layout.ledger, args.keep_last)}
    elif args.job == "silver-build":
        out = jobs.silver_build(spark, layout, args.ingest_date)
    else:
        out = jobs.gold_build(
            spark, layout, args.partner, args.images_dataset, args.annotations_dataset, args.split, args.ingest_date, args.mode
        )
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
