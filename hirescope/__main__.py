"""Command line: ``python -m hirescope run ...``, or on a cluster
``spark-submit --py-files hirescope.zip scripts/run_job.py run ...``.

Runs every model once for one load date, reading raw files and writing
bronze, silver and gold tables under ``--warehouse``.  The session comes
from ``spark-submit`` / the cluster's defaults; nothing here sets a master.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from .plans import jobs


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="hirescope")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="build every model for one load date")
    run.add_argument("--feed-a", required=True, help="folder of feed A Parquet files")
    run.add_argument("--feed-b", required=True, help="folder of feed B Parquet files")
    run.add_argument("--availability", required=True, help="folder of availability CSV files")
    run.add_argument("--summaries", required=True, help="folder of AI summary Parquet files")
    run.add_argument("--warehouse", required=True, help="root folder of the tables")
    run.add_argument("--as-of", default=str(dt.date.today()), help="day the marts look back from, yyyy-MM-dd")
    run.add_argument("--load-ts", help="stamp of this load, ISO time in UTC (default: now)")
    run.add_argument("--format", default="parquet")
    run.add_argument("--views", action="store_true", help="models as temp views (nothing written)")
    run.add_argument("--catalog", help="catalog database for the tables (default: path-only tables)")
    run.add_argument("--buckets", type=int, default=0, help="bucket the enrichment inputs by posting id")
    run.add_argument("--no-marts", action="store_true")
    run.add_argument("--threads", type=int, default=4)
    run.add_argument("--bronze-mode", choices=["files", "stream"], default="files")
    run.add_argument("--reprocess-on-change", action="store_true")
    run.add_argument("--remove-inactive", action="store_true")
    run.add_argument("--employment-mode", choices=["reference", "fixed"], default="reference")
    run.add_argument("--no-rescue", action="store_true", help="drop what does not fit the raw schema")
    run.add_argument("--filter-both", action="store_true", help="filter both feeds' descriptions by the mark")
    run.add_argument("--incremental-marts", action="store_true", help="keep marts from partials (with --catalog)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("hirescope").getOrCreate()
    raw = jobs.RawInputs(args.feed_a, args.feed_b, args.availability, args.summaries)
    layout = jobs.Layout(args.warehouse, args.format, "view" if args.views else "table",
                         catalog=args.catalog, buckets=args.buckets)
    written = jobs.run(
        spark,
        raw,
        layout,
        dt.date.fromisoformat(args.as_of),
        marts=not args.no_marts,
        reprocess_on_change=args.reprocess_on_change,
        remove_inactive=args.remove_inactive,
        threads=args.threads,
        bronze_mode=args.bronze_mode,
        employment_mode=args.employment_mode,
        rescue=not args.no_rescue,
        load_ts=dt.datetime.fromisoformat(args.load_ts) if args.load_ts else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
        filter_both=args.filter_both,
        incremental_marts=args.incremental_marts,
    )
    print(json.dumps(written, indent=2, sort_keys=True))


if __name__ == "__main__":
    main()
