"""Command line: ``python -m viewtide.jobs <job> ...`` or through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.operators.inventory import list_data_files
from viewtide.operators.layout import STORAGE_LEVELS
from viewtide.params import (
    DATA_FILE_LINK,
    DIRECTORY_LINK,
    DOMAIN,
    GRAINS,
    MIN_VIEWS,
    SAMPLE_FILES,
    TOP_N,
)
from viewtide.plans import master, publish, stages, trends
from viewtide.sources import (
    last_kept_names,
    list_files,
    read_top_list,
    scan_lines,
    scope_paths,
    within_names,
)


def _lines(spark: SparkSession, args: argparse.Namespace, positions: bool = False) -> DataFrame:
    """Lines of the chosen scope: years and months, sample, or first files.

    Without a year all files below the source are read, however deep.
    """
    source = args.source
    if args.year is not None:
        source = scope_paths(args.source, args.year, args.start_month, args.end_month)
    elif args.start_month is not None or args.end_month is not None:
        raise ValueError("months need a year")
    files = list_files(spark, source)
    if files.isEmpty():
        raise FileNotFoundError(f"no file in the scope of {args.source}")
    # A test on the file name inside the scan skips the other files.
    where = F.col("_metadata.file_name").isin(*SAMPLE_FILES) if args.sample else None
    if args.files_per_month:
        kept = within_names(last_kept_names(files, args.files_per_month))
        where = kept if where is None else where & kept
    return scan_lines(spark, source, where=where, positions=positions, recursive=True)


def _refuse_partial(spark: SparkSession, args: argparse.Namespace) -> None:
    """Some files of a month must not replace a whole month."""
    if not (args.sample or args.files_per_month):
        return
    try:
        spark.read.parquet(f"{args.output}/daily")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return
    raise ValueError(f"{args.output} has results; give a sampled run an output of its own")


def _trends(spark: SparkSession, args: argparse.Namespace) -> None:
    _refuse_partial(spark, args)
    options = trends.TrendOptions(
        domain=args.domain, min_views=None if args.no_threshold else args.min_views,
        top_n=args.top_n, collapse_ties=args.collapse_ties, grains=tuple(args.grains))
    trends.build_trends(_lines(spark, args), args.output, args.storage_level, options,
                        args.rebuild).show(truncate=False)


def _stages(spark: SparkSession, args: argparse.Namespace) -> None:
    stages.build_stages(_lines(spark, args), args.output, args.partitions, args.domain)


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    publish.load_documents(spark, args.source, args.serving).write.mode("append").parquet(
        f"{args.serving}/reports")


def _lookup(spark: SparkSession, args: argparse.Namespace) -> None:
    found = read_top_list(spark, args.table, args.grain, args.interval).orderBy("rank")
    # One list: as many rows as it was built with.
    found.show(found.count() if args.rows is None else args.rows, False)


def _master(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = _lines(spark, args, positions=args.limit > 0)
    master.load_master(raw, args.output, args.limit, args.audit).show(truncate=False)


def _consolidate(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = _lines(spark, args, positions=args.limit > 0)
    master.consolidate(raw, args.output, args.limit).show(truncate=False)


def _inventory(spark: SparkSession, args: argparse.Namespace) -> None:
    pages = spark.read.parquet(args.pages)
    list_data_files(pages, args.start_url, args.directory_link, args.file_link).write.mode(
        "overwrite").parquet(args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="viewtide.jobs")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *paths):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(path)
        return sub

    def load(name, run):
        sub = job(name, run, "source", "output")
        for bound in ("--year", "--start-month", "--end-month"):
            sub.add_argument(bound, type=int)
        sub.add_argument("--sample", action="store_true", help="only the fixed sample files")
        sub.add_argument("--files-per-month", type=int, default=0, help="first files, 0 for all")
        return sub

    sub = load("trends", _trends)
    sub.add_argument("--storage-level", choices=list(STORAGE_LEVELS))
    sub.add_argument("--domain", default=DOMAIN)
    sub.add_argument("--min-views", type=int, default=MIN_VIEWS)
    sub.add_argument("--no-threshold", action="store_true")
    sub.add_argument("--top-n", type=int, default=TOP_N)
    sub.add_argument("--collapse-ties", action="store_true")
    sub.add_argument("--rebuild", action="store_true",
                     help="derive lists and series from all stored months")
    sub.add_argument("--grains", nargs="+", default=["day", "month", "year"], choices=GRAINS)
    sub = load("stages", _stages)
    sub.add_argument("--domain", default=DOMAIN)
    sub.add_argument("--partitions", type=int)
    for name, run in (("master", _master), ("consolidate", _consolidate)):
        sub = load(name, run)
        sub.add_argument(
            "--limit", type=int, default=0, help="accepted records per file, 0 for all")
        if name == "master":
            sub.add_argument("--audit", action="store_true",
                             help="read back what was written and count what differs")
    job("publish", _publish, "source", "serving")
    sub = job("lookup", _lookup, "table", "grain", "interval")
    sub.add_argument("--rows", type=int, help="the whole list by default")
    sub = job("inventory", _inventory, "pages", "start_url", "output")
    sub.add_argument("--directory-link", default=DIRECTORY_LINK)
    sub.add_argument("--file-link", default=DATA_FILE_LINK)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("viewtide").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
