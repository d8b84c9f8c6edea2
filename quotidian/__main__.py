"""Command line of the daily run.

    python -m quotidian --lake PATH ingest-prices  --landing PATH [--run-date D] [--universe CSV]
    python -m quotidian --lake PATH ingest-revenue --landing PATH
    python -m quotidian --lake PATH ingest-filings --downloads PATH [--run-date D]
    python -m quotidian --lake PATH curate   [--run-date D]
    python -m quotidian --lake PATH build    [--run-date D]
    python -m quotidian --lake PATH backfill [--target-date D] [--end-date D] [--landing PATH]
                                             [--days N] [--skip-curation] [--run-features]
                                             [--no-skip-existing]
    python -m quotidian --lake PATH tables | describe TABLE [--limit N] | query SQL [--limit N] [--output PATH]

Dates are YYYY-MM-DD and default to today. The session comes from spark-submit's settings.
"""

from __future__ import annotations

import argparse
import csv
import sys

from pyspark.sql import SparkSession

from quotidian import schemas
from quotidian.functions.scalar import parse_run_date
from quotidian.plans import backfill, daily
from quotidian.session import SETTINGS
from quotidian.sources import catalog
from quotidian.sources.lake import Lake
from quotidian.sources.universe import read_universe


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quotidian")
    top.add_argument("--lake", required=True, help="root folder of the layers")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *, dated: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        if dated:
            sub.add_argument("--run-date")
        return sub

    priced = command("ingest-prices")
    priced.add_argument("--landing", required=True)
    priced.add_argument("--universe", help="CSV of tickers; files of others are left alone")
    command("ingest-revenue", dated=False).add_argument("--landing", required=True)
    command("ingest-filings").add_argument("--downloads", required=True)
    command("curate")
    command("build")

    fill = command("backfill", dated=False)
    fill.add_argument("--target-date")
    fill.add_argument("--end-date")
    fill.add_argument("--landing")
    fill.add_argument("--days", type=int, default=schemas.INGEST_WINDOW_DAYS)
    fill.add_argument("--skip-curation", action="store_true")
    fill.add_argument("--run-features", action="store_true")
    fill.add_argument("--no-skip-existing", action="store_true")

    command("tables", dated=False)
    table = command("describe", dated=False)
    table.add_argument("table", help="such as curated.daily_prices")
    table.add_argument("--limit", type=int, default=10)
    sql = command("query", dated=False)
    sql.add_argument("sql")
    sql.add_argument("--limit", type=int, help="at most so many rows; all, if not given")
    sql.add_argument("--output", help="write the rows as Parquet here instead of printing them")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    lake = Lake(args.lake.rstrip("/"))
    day = parse_run_date(getattr(args, "run_date", None))

    if args.command == "ingest-prices":
        names = read_universe(spark, args.universe) if args.universe else None
        daily.ingest_prices(spark, lake, args.landing, day, names)
    elif args.command == "ingest-revenue":
        daily.ingest_revenue(spark, lake, args.landing)
    elif args.command == "ingest-filings":
        daily.ingest_filings(spark, lake, args.downloads, day)
    elif args.command == "curate":
        report = daily.curate_day(spark, lake, day)
        print(report or f"no prices up to {day}")
    elif args.command == "build":
        daily.build_day(spark, lake, day)
    elif args.command == "backfill":
        backfill.backfill(
            spark,
            lake,
            parse_run_date(args.target_date),
            parse_run_date(args.end_date) if args.end_date else None,
            landing=args.landing,
            days_to_fetch=args.days,
            run_curation=not args.skip_curation,
            run_features=args.run_features,
            skip_existing=not args.no_skip_existing,
        )
    else:
        for name in catalog.register_lake(spark, lake):
            print(f"{name} is a table of its own and not the lake's", file=sys.stderr)
        return look(spark, args)
    return 0


def look(spark: SparkSession, args: argparse.Namespace) -> int:
    """The commands that only read."""
    if args.command == "tables":
        for schema in ("raw", "curated", "marts"):
            for row in catalog.list_tables(spark, schema).collect():
                print(f"{schema}.{row['table_name']}: {row['row_count']} rows")
    elif args.command == "describe":
        schema, _, table = args.table.rpartition(".")
        info = catalog.show_table_info(spark, table, schema or "curated", args.limit)
        if info is None:
            print(f"no table {args.table}", file=sys.stderr)
            return 1
        print(f"{args.table}: {info['row_count']} rows")
        for name, kind in info["columns"]:
            print(f"  {name}: {kind}")
        info["sample"].show(args.limit, truncate=False)
    else:
        rows = catalog.run_query(spark, args.sql)
        if args.limit is not None:
            rows = rows.limit(args.limit)
        if args.output:
            rows.write.mode("error").parquet(args.output)
            return 0
        # All rows, a partition at a time.
        out = csv.writer(sys.stdout, delimiter="\t", lineterminator="\n")
        out.writerow(rows.columns)
        for row in rows.toLocalIterator():
            out.writerow(["NULL" if v is None else v for v in row])
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"quotidian {args.command}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return run(builder.getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
