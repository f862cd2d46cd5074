"""Command line: ``python -m ledgermill <job>``; ``--help`` lists the jobs and their folders."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from ledgermill.jobs import bronze, quality, report, silver
from ledgermill.plans.filters import ALL, ACTIVE, CHURNED, CLEAN, RAW, MetricFilter
from ledgermill.session import build_session, fit_partitions

#: Rows of a report that are printed; all are in its table.
PREVIEW_ROWS = 40


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgermill")
    parser.add_argument("--shuffle-partitions", type=int, help="default: from the input size")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("bronze", help="extracts to bronze tables")
    job.add_argument("--extracts", required=True)
    job.add_argument("--bronze", required=True)

    job = jobs.add_parser("silver", help="bronze to silver tables")
    job.add_argument("--bronze", required=True)
    job.add_argument("--silver", required=True)

    job = jobs.add_parser("quality", help="quality checks of the extracts")
    job.add_argument("--extracts", required=True)
    job.add_argument("--out", required=True)

    job = jobs.add_parser("report", help="key figures and series for a filter")
    job.add_argument("--extracts")
    job.add_argument("--silver")
    job.add_argument("--out", required=True, help="folder of the report's tables")
    job.add_argument("--mode", choices=(RAW, CLEAN), default=RAW)
    job.add_argument("--plan", action="append")
    job.add_argument("--no-plan", action="store_true", help="an empty selection of plans")
    job.add_argument("--industry", action="append")
    job.add_argument("--no-industry", action="store_true", help="an empty selection of industries")
    job.add_argument("--start", type=datetime.date.fromisoformat)
    job.add_argument("--end", type=datetime.date.fromisoformat)
    job.add_argument("--status", choices=(ALL, ACTIVE, CHURNED), default=ALL)
    return parser


def _print_report(written: dict[str, dict[str, object]]) -> None:
    for table, measures in written.items():
        print(table, ", ".join(f"{name}: {value}" for name, value in measures.items()))


def _selection(values: list[str] | None, none: bool) -> tuple[str, ...] | None:
    if none and values:
        raise SystemExit("an empty selection cannot name values")
    return () if none else tuple(values) if values else None


def _preview(spark: SparkSession, out_dir: str, n_rows: int) -> None:
    rows = spark.read.parquet(f"{out_dir}/{report.REPORT}").orderBy("part", "label")
    rows.show(PREVIEW_ROWS, truncate=False)
    print(f"first {min(n_rows, PREVIEW_ROWS)} of {n_rows} rows; all are in {out_dir}/{report.REPORT}")


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session(f"ledgermill-{args.job}")
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.shuffle_partitions)
    else:
        inputs = {"bronze": "extracts", "silver": "bronze", "quality": "extracts"}
        names = [inputs[args.job]] if args.job in inputs else ["extracts", "silver"]
        fit_partitions(spark, *(vars(args)[name] for name in names if vars(args)[name]))
    if args.job == "bronze":
        _print_report(bronze.run(spark, args.extracts, args.bronze))
        _print_report(bronze.validate(spark, args.bronze))
    elif args.job == "silver":
        _print_report(silver.run(spark, args.bronze, args.silver))
    elif args.job == "quality":
        _print_report(quality.run(spark, args.extracts, args.out))
    else:
        wanted = MetricFilter(
            mode=args.mode,
            plans=_selection(args.plan, args.no_plan),
            start_date=args.start,
            end_date=args.end,
            industries=_selection(args.industry, args.no_industry),
            status=args.status,
        )
        folders = {"extracts_dir": args.extracts, "silver_dir": args.silver}
        written = report.write(spark, wanted, args.out, **folders)
        _print_report(written)
        _preview(spark, args.out, written[report.REPORT]["n_rows"])


if __name__ == "__main__":
    main()
    SparkSession.active().stop()
