"""Command line: ``spark-submit ... -m daybook`` or ``python -m daybook <command> <root> ...``.

    load ROOT CSV              land CSV deliveries and append raw volumes per project
    refresh ROOT [--dates D..] [--responses PATH]   value volumes, all dates or some
    arrivals ROOT FOLDER --name N --progress P      take up newly arrived CSV files
    answers ROOT FOLDER --progress P                take up newly arrived answers of the quote provider
    load-checked ROOT CSV --batch B                 land CSV deliveries, keep lines that do not fit aside
    rejects ROOT               lines kept aside, with their file
    quotes-import ROOT FOLDER  take over quotes kept as JSON objects (also: quotes)
    quotes-export ROOT FOLDER  keep every stored quote as a JSON object
    missing ROOT               quotes still to be fetched
    daily-volumes ROOT         JSON records per date and currency
    project-volumes ROOT       JSON records per project and currency
    verify ROOT                dollar value per date and currency as text
    control ROOT               records landed, read and counted per date
    validate ROOT              checks, project totals, and the verdict as exit status
    vacuum ROOT                remove files that the last two publications do not name

Reports print their first 10,000 lines; ``--out PATH`` writes all of them to files instead.
"""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import quality, reports
from daybook.operators.quote_objects import put_quotes
from daybook.operators.sinks import store_quotes, write_lines
from daybook.plans.control import control_totals
from daybook.plans.initial_load import initial_load
from daybook.plans.lake import Lake
from daybook.plans.quarantine import land_with_quarantine, quarantined
from daybook.plans.refresh import refresh, worklist
from daybook.plans.validation import validate
from daybook.sources.metrics import read_metrics
from daybook.sources.quotes import (
    read_quote_objects,
    read_quotes,
    read_responses,
    stream_responses,
)
from daybook.sources.transactions import stream_transactions
from daybook.streaming.arrivals import refresh_on_arrival, reprice_on_arrival


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daybook")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("root", help="folder of the tables")
        sub.add_argument("--database", help="database that shows the metrics in SQL")
        return sub

    load = command("load")
    load.add_argument("csv")
    load.add_argument("--batch", help="label; by default one for these paths")
    load.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    load.add_argument("--gather", action="store_true", help="bring the rows of a date together")
    again = command("refresh")
    again.add_argument("--dates", nargs="*", type=datetime.date.fromisoformat)
    again.add_argument("--responses", help="landed answers of the quote provider")
    again.add_argument("--format", default="json", help="file format of the responses")
    arrivals = command("arrivals")
    arrivals.add_argument("folder")
    arrivals.add_argument("--name", required=True)
    arrivals.add_argument("--progress", required=True, help="checkpoint of the stream")
    arrivals.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    arrivals.add_argument("--gather", action="store_true", help="bring the rows of a date together")
    answers = command("answers")
    answers.add_argument("folder")
    answers.add_argument("--progress", required=True, help="checkpoint of the stream")
    answers.add_argument("--format", default="json", help="file format of the answers")
    checked = command("load-checked")
    checked.add_argument("csv")
    checked.add_argument("--batch", required=True)
    checked.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    for name in ("quotes", "quotes-import", "quotes-export"):
        command(name).add_argument("objects", help="folder of quotes, one JSON object per symbol and day")
    for name in ("missing", "rejects", "daily-volumes", "project-volumes", "verify", "control"):
        command(name).add_argument("--out", help="folder to write the lines to")
    for name in ("validate", "vacuum"):
        command(name)
    return parser.parse_args(argv)


#: Lines that a command prints.
SHOWN = 10_000


def _print(frame: DataFrame, out: str | None = None) -> None:
    """Writes all rows as lines to ``out``, or prints the first ``SHOWN``."""
    cells = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("None")) for name in frame.columns]
    lines = frame.select(F.concat_ws("\t", *cells).alias("line"))
    if out:
        write_lines(lines, out)
        return
    rows = lines.take(SHOWN + 1)
    for row in rows[:SHOWN]:
        print(row.line)
    if len(rows) > SHOWN:
        print(f"only the first {SHOWN} lines; --out writes all", file=sys.stderr)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    lake = Lake.under(args.root, args.database)
    if args.command == "load":
        added = initial_load(spark, args.csv, lake, args.batch, args.multi_line, args.gather)
        print(f"{added} rows added")
    elif args.command == "refresh":
        responses = read_responses(spark, args.responses, args.format) if args.responses else None
        refresh(spark, lake, args.dates, responses)
    elif args.command == "arrivals":
        arriving = stream_transactions(spark, args.folder, multi_line=args.multi_line)
        refresh_on_arrival(
            arriving, lake, args.name, args.progress, gather=args.gather
        ).awaitTermination()
    elif args.command == "answers":
        arriving = stream_responses(spark, args.folder, args.format)
        reprice_on_arrival(arriving, lake, args.progress).awaitTermination()
    elif args.command == "load-checked":
        land_with_quarantine(spark, args.csv, lake, args.batch, args.multi_line)
    elif args.command == "rejects":
        _print(quarantined(spark, lake).orderBy("batch", "file", "block", "line"), args.out)
    elif args.command == "control":
        _print(control_totals(spark, lake), args.out)
    elif args.command == "vacuum":
        lake.vacuum(spark)
    elif args.command == "quotes-export":
        print(f"{put_quotes(read_quotes(spark, lake.quotes), args.objects)} objects")
    elif args.command in ("quotes", "quotes-import"):
        lake.create(spark)
        store_quotes(read_quote_objects(spark, args.objects), lake.quotes)
    elif args.command == "missing":
        _print(worklist(spark, lake), args.out)
    elif args.command == "daily-volumes":
        _print(reports.json_records(reports.daily_volumes(read_metrics(spark, lake.metrics))), args.out)
    elif args.command == "project-volumes":
        _print(reports.json_records(reports.project_volumes(read_metrics(spark, lake.metrics))), args.out)
    elif args.command == "verify":
        _print(reports.verify_text(read_metrics(spark, lake.metrics)), args.out)
    elif args.command == "validate":
        verdict = validate(spark, lake.metrics)
        if verdict.readable:
            metrics = read_metrics(spark, lake.metrics)
            _print(quality.profile(metrics))
            _print(reports.project_text(metrics))
        print(verdict)
        return 0 if verdict.ok else 1
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = (
        SparkSession.builder.appName("daybook")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    return run(spark, args)


if __name__ == "__main__":
    sys.exit(main())
