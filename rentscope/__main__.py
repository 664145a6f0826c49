"""Command line: run the pipeline, or ingest fetched pages as a snapshot.

    python -m rentscope run --snapshots DIR --out DIR [--publish DIR] [--named-prefix listings_2]
    python -m rentscope ingest-pages --pages PATH --snapshots DIR [--stamp yyyyMMdd_HHmmss]

The session comes from the environment (``spark-submit`` / cluster
defaults); intermediates go to the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="rentscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="newest snapshot -> clean, stats, star, views, quality gate")
    run.add_argument("--snapshots", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--publish")
    run.add_argument("--format", default="parquet")
    run.add_argument("--named-prefix", help="flat folder of <prefix><stamp>.csv files instead of partitions")
    run.add_argument("--append-star", action="store_true", help="append to the warehouse (insert-only rerun)")
    ing = sub.add_parser("ingest-pages", help="pages(page_id, url, html) Parquet -> one listing snapshot")
    ing.add_argument("--pages", required=True)
    ing.add_argument("--snapshots", required=True)
    ing.add_argument("--stamp")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("rentscope").getOrCreate()
    from rentscope.session import apply_conf, sized_conf
    from rentscope.sources.files import exists, size_bytes
    source = args.snapshots if args.cmd == "run" else args.pages
    if exists(spark, source):
        apply_conf(spark, sized_conf(size_bytes(spark, source), spark.sparkContext.defaultParallelism))
    if args.cmd == "run":
        from rentscope.plans.pipeline import run_pipeline
        res = run_pipeline(spark, args.snapshots, args.out, args.publish, args.format,
                           "append" if args.append_star else "overwrite",
                           named_prefix=args.named_prefix)
        for name, path in sorted(res.paths.items()):
            print(f"{name}\t{path}")
    else:
        from rentscope.plans.pipeline import ingest_pages
        ingest_pages(spark.read.parquet(args.pages), args.snapshots, stamp=args.stamp)
    return 0


if __name__ == "__main__":
    sys.exit(main())
