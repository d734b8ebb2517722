"""Command-line entry for the jobs (``python -m strata.plans.cli <job> ...``
or ``spark-submit strata/plans/cli.py <job> ...``).

Each sub-command maps its arguments onto one function of
:mod:`strata.plans.jobs`; the session comes from the submitting environment
(master, cluster config, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from strata.plans import jobs as J  # noqa: E402
from strata.session import get_session  # noqa: E402


def _audit(p: argparse.ArgumentParser) -> None:
    p.add_argument("--create-user", required=True)
    p.add_argument("--create-process", required=True)
    p.add_argument("--first-source", required=True)
    p.add_argument("--as-of", help="pin the load time, 'YYYY-MM-DD HH:MM:SS' (UTC)")


def _catalog(p: argparse.ArgumentParser) -> None:
    p.add_argument("--catalog-zone", help="database in which to register what is written")
    p.add_argument("--table-prefix", default="")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--master", help="only for local runs; clusters set it via spark-submit")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("full-load-snapshot", help="catalog database -> raw pipe-CSV")
    p.add_argument("--database", required=True)
    p.add_argument("--raw-root", required=True)
    p.add_argument("--pattern", default="%")
    p.add_argument("--parallelism", type=int, default=4)

    p = sub.add_parser("raw-to-transient", help="raw pipe-CSV -> transient Parquet")
    p.add_argument("--raw-path", required=True)
    p.add_argument("--transient-path", required=True)
    p.add_argument("--table", help="registered table that types the CSV (else by the folder name)")
    p.add_argument("--infer", action="store_true", help="infer the types instead (an extra pass)")
    p.add_argument("--escaped-breaks", action="store_true", help="the CSV was written by full-load-snapshot")
    _catalog(p)

    p = sub.add_parser("land-stream", help="JSON message files -> landed (data, metadata) Parquet")
    p.add_argument("--inbox", help="folder receiving JSON-lines message files")
    p.add_argument("--format", help="any other streaming source that Spark can read, e.g. kafka")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option of that source")
    p.add_argument("--max-bytes", type=int, help="bytes of new files per micro-batch (default: no limit)")
    p.add_argument("--landing", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--flat", action="store_true", help="do not partition by operation/table")
    p.add_argument("--available-now", action="store_true",
                   help="process what is there and stop (else flush every 900 s)")

    p = sub.add_parser("cdc-to-transient", help="landed change events -> transient tables")
    p.add_argument("--landing", required=True)
    p.add_argument("--transient-root", required=True)
    p.add_argument("--operation", choices=("insert", "update", "all"), required=True,
                   help="'all' routes inserts and updates from one decode of each batch")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--flat", action="store_true", help="the landing is not partitioned by operation/table")
    p.add_argument("--cutover-notice", help="leave out changes before this full-load completion time")
    _catalog(p)
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--max-bytes-per-trigger", type=int)

    p = sub.add_parser("transient-to-refined", help="transient -> refined with audit columns")
    p.add_argument("--transient-path", required=True)
    p.add_argument("--refined-path", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--max-bytes-per-trigger", type=int)
    _catalog(p)
    _audit(p)

    p = sub.add_parser("update-history-to-refined", help="*_cdc_update tables -> refined")
    p.add_argument("--transient-root", required=True)
    p.add_argument("--refined-root", required=True)
    p.add_argument("--checkpoint-root", required=True)
    _audit(p)

    p = sub.add_parser("customer-tables", help="refined demographic/base id + clusters -> customer star")
    p.add_argument("--demographic", required=True)
    p.add_argument("--baseid", required=True)
    p.add_argument("--match", required=True, help="match-cluster CSV (bid, match_id)")
    p.add_argument("--output-root", required=True)
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--month-from", type=int, default=1)
    p.add_argument("--month-to", type=int, default=12)
    p.add_argument("--day-from", type=int, default=1)
    p.add_argument("--day-to", type=int, default=31)
    _catalog(p)
    _audit(p)
    return ap


def run(args: argparse.Namespace, spark) -> object:
    if args.job == "full-load-snapshot":
        return J.full_load_snapshot(spark, args.database, args.raw_root, args.pattern,
                                    parallelism=args.parallelism)
    if args.job == "raw-to-transient":
        J.raw_to_transient(spark, args.raw_path, args.transient_path, table=args.table, infer=args.infer,
                           escaped_breaks=args.escaped_breaks, zone=args.catalog_zone, prefix=args.table_prefix)
        return args.transient_path
    if args.job == "land-stream":
        from strata.streaming import landing as LAND
        if args.format:
            messages = LAND.message_stream(spark, args.format, dict(o.split("=", 1) for o in args.option))
        else:
            messages = LAND.message_file_stream(spark, args.inbox, max_bytes_per_trigger=args.max_bytes)
        q = LAND.cdc_land_stream(messages, args.landing, args.checkpoint,
                                 available_now=args.available_now, routed=not args.flat)
        q.awaitTermination()
        return args.landing
    if args.job == "cdc-to-transient":
        operations = ("insert", "update") if args.operation == "all" else args.operation
        return J.cdc_to_transient(spark, args.landing, args.transient_root, operations,
                                  args.checkpoint, routed=not args.flat,
                                  max_files_per_trigger=args.max_files_per_trigger,
                                  max_bytes_per_trigger=args.max_bytes_per_trigger,
                                  cutover_notice=args.cutover_notice,
                                  zone=args.catalog_zone, prefix=args.table_prefix)
    audit = (args.create_user, args.create_process, args.first_source)
    if args.job == "transient-to-refined":
        return J.transient_to_refined(spark, args.transient_path, args.refined_path,
                                      args.checkpoint, *audit, as_of=args.as_of,
                                      max_bytes_per_trigger=args.max_bytes_per_trigger,
                                      zone=args.catalog_zone, prefix=args.table_prefix)
    if args.job == "update-history-to-refined":
        return J.update_history_to_refined(spark, args.transient_root, args.refined_root,
                                           args.checkpoint_root, *audit, as_of=args.as_of)
    if args.job == "customer-tables":
        return J.customer_tables(spark, args.demographic, args.baseid, args.match,
                                 args.output_root, *audit, year=args.year,
                                 month_from=args.month_from, month_to=args.month_to,
                                 day_from=args.day_from, day_to=args.day_to, as_of=args.as_of,
                                 zone=args.catalog_zone, prefix=args.table_prefix)
    raise ValueError(args.job)


def main(argv: list[str] | None = None, spark=None) -> object:
    args = parser().parse_args(argv)
    spark = spark or get_session(args.master, app_name=f"strata-{args.job}")
    return run(args, spark)


if __name__ == "__main__":
    main()
