"""Command line: ``python -m giftledger <job> --warehouse DIR --execution-date YYYY-MM-DD ...``."""

from __future__ import annotations

import argparse
import sys
from datetime import date

from .operators.identity import MODES, SCOPES, match_rule_counts
from .operators.mart import lapsed_donors
from .operators.profile import profile_report
from .operators.quality import GateFailed, Limits
from .plans import daily_run as R
from .schemas import DIM_DONORS, MART, STAGING
from .session import get_session
from .sources import tables as tb
from .sources.delimited import read_headerless, write_delimited
from .sources.versions import KEEP


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="giftledger", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def dated(name: str, text: str) -> argparse.ArgumentParser:
        job = jobs.add_parser(name, help=text)
        job.add_argument("--execution-date", required=True, type=date.fromisoformat, help="YYYY-MM-DD")
        job.add_argument("--warehouse", required=True, help="folder that holds the tables")
        return job

    def with_source(job: argparse.ArgumentParser) -> None:
        job.add_argument("--csv-path", required=True, help="source file or folder")
        job.add_argument("--headers", help="comma-separated header file; the source then has no header line")
        job.add_argument("--on-malformed", choices=("fail", "skip"), default="fail")

    def with_identity(job: argparse.ArgumentParser) -> None:
        job.add_argument("--conflicts", choices=MODES, default=MODES[0])
        job.add_argument("--scope", choices=SCOPES, default=SCOPES[0])
        job.add_argument("--zero-zip-is-null", action="store_true")

    ingest = dated("ingest", "replace one day of the raw table")
    with_source(ingest)
    ingest.add_argument("--table", help="raw table path (default: the warehouse's)")
    dated("staging", "clean one raw day and upsert it into staging").add_argument("--lenient-dates", action="store_true")
    identity = dated("identity", "resolve donors of one staged day")
    with_identity(identity)
    identity.add_argument("--fixture", help="resolve this scenario file into test tables instead")
    run = dated("run", "all jobs with their checks, in order")
    with_source(run)
    with_identity(run)
    run.add_argument("--as-of", type=date.fromisoformat, help="day the scores refer to")
    run.add_argument("--lenient-dates", action="store_true", help="read one-digit months and days")
    run.add_argument("--min-rows", type=int, default=1, help="rows below which a check fails")
    run.add_argument("--max-rows", type=int, help="rows from which a check fails")
    run.add_argument("--null-rate", action="append", default=[], metavar="COLUMN=PERCENT", help="limit of blanks in a raw column")
    run.add_argument("--keep", type=int, default=KEEP, help="states of each table to keep")
    rebuild = dated("rebuild", "resolve all staged days again and replace dimension, review table and mart")
    with_identity(rebuild)
    rebuild.add_argument("--as-of", type=date.fromisoformat, help="day the scores refer to")
    lapsed = dated("lapsed", "donors of the published mart who have lapsed")
    lapsed.add_argument("--output", required=True, help="folder for the list")

    profile = jobs.add_parser("profile", help="describe a headerless source and write a sample")
    profile.add_argument("--input", required=True)
    profile.add_argument("--headers", required=True)
    profile.add_argument("--rows", type=int, default=50_000)
    profile.add_argument("--output", help="folder for the sample")
    return parser


def _limits(args: argparse.Namespace) -> Limits:
    given = dict(item.split("=", 1) for item in args.null_rate)
    rates = {**Limits().null_rates, **{column: float(rate) for column, rate in given.items()}}
    return Limits(min_rows=args.min_rows, max_rows=args.max_rows, null_rates=rates)


def _options(args: argparse.Namespace) -> R.Options:
    return R.Options(
        lenient_dates=args.lenient_dates,
        limits=_limits(args),
        keep=args.keep,
        as_of=args.as_of,
        conflict_mode=args.conflicts,
        zero_zip_is_null=args.zero_zip_is_null,
        scope=args.scope,
    )


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session()
    if args.job == "profile":
        source = read_headerless(spark, args.input, args.headers)
        report = profile_report(source, args.rows)
        sample = report.pop("sample")
        for name, result in report.items():
            print(name)
            result.show(truncate=False)
        if args.output:
            write_delimited(sample, args.output, mode="overwrite")
        return 0

    warehouse, day = R.Warehouse(args.warehouse), args.execution_date
    if args.job in ("ingest", "run"):
        source = R.read_source(spark, args.csv_path, args.headers is None, args.headers, args.on_malformed)
    try:
        if args.job == "ingest":
            print(R.ingest_raw(spark, source, day, args.table or warehouse.raw))
        elif args.job == "staging":
            print(R.run_staging(spark, warehouse.raw, warehouse.staging, day, args.lenient_dates))
        elif args.job == "rebuild":
            choices = {"mode": args.conflicts, "zero_zip_is_null": args.zero_zip_is_null, "scope": args.scope}
            print(R.rebuild(spark, warehouse, args.as_of or day, **choices))
        elif args.job == "lapsed":
            write_delimited(lapsed_donors(tb.read_snapshot(spark, warehouse.mart, MART), day), args.output)
        elif args.job == "identity":
            dim_path, review_path = warehouse.dim_donors, warehouse.unresolved
            if args.fixture:
                dim_path, review_path = f"{dim_path}_test", f"{review_path}_test"
                R.run_fixture_identity(spark, args.fixture, day, dim_path, review_path)
            else:
                staged = tb.read_table(spark, warehouse.staging, STAGING)
                if args.scope == "date":
                    staged = tb.read_partition(spark, warehouse.staging, STAGING, day)
                R.run_identity(
                    spark, staged, dim_path, review_path, args.conflicts, args.zero_zip_is_null, args.scope, day
                )
            match_rule_counts(tb.read_partition(spark, dim_path, DIM_DONORS, day)).show()
        else:
            print(R.run_day(spark, source, day, warehouse, _options(args)))
    except GateFailed as failure:
        print(f"ERROR: {failure}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
