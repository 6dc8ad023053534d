"""From hourly text files to top lists and page series."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from viewtide.functions.lines import DOMAIN_REASON, REASONS
from viewtide.operators import documents, quality, ranking, rollup, series
from viewtide.operators.layout import persist_level
from viewtide.params import DOMAIN, MIN_VIEWS, TOP_N, URL_PREFIX
from viewtide.parts import current_version
from viewtide.sinks import (
    doc_lines,
    series_part,
    write_doc_lines,
    write_facts,
    write_rejects,
    write_series,
    write_top_pages,
)
from viewtide.sources import read_daily, read_series, read_top_pages
from viewtide.storage import scratch_path


@dataclass(frozen=True)
class TrendOptions:
    domain: str = DOMAIN
    min_views: int | None = MIN_VIEWS
    top_n: int = TOP_N
    url_prefix: str = URL_PREFIX
    collapse_ties: bool = False
    grains: Sequence[str] = ("day", "month", "year")


ACCOUNT = ("lines BIGINT, kept BIGINT, rejected BIGINT, "
           + ", ".join(f"{reason} BIGINT" for reason in REASONS)
           + ", daily_facts BIGINT, quarantined BIGINT")


def _stage(raw: DataFrame, options: TrendOptions) -> tuple[DataFrame, DataFrame]:
    """One pass over the text: daily facts and reported rejects, staged in the shared
    folder, and the account of all lines."""
    spark = raw.sparkSession
    read, judged = Observation("read"), Observation("judged")
    lines = quality.filter_domain(raw.observe(read, F.count("*").alias("lines")), options.domain)
    outcomes = quality.daily_outcomes(
        quality.with_outcome(lines, options.domain).observe(judged, *quality.outcome_metrics()),
        options.domain)
    if options.min_views is not None:
        outcomes = outcomes.filter(
            F.col("reject_reason").isNotNull() | (F.col("views") > options.min_views))
    outcomes = outcomes.withColumns({"kept": F.col("reject_reason").isNull(),
                                     "yyyymm": F.year("day") * 100 + F.month("day")})
    path = scratch_path(spark, "outcomes")
    (outcomes.hint("rebalance", F.col("kept"), F.col("yyyymm"))
     .write.partitionBy("kept", "yyyymm").parquet(path))
    staged = spark.read.schema(outcomes.schema).parquet(path)
    put = staged.agg(F.count_if("kept").alias("facts"), F.coalesce(
        F.sum(F.when(~F.col("kept"), F.col("copies"))), F.lit(0)).alias("rejects")).first()
    if put["facts"] or put["rejects"]:
        all_lines, found = read.get["lines"], judged.get
        counts = {DOMAIN_REASON: all_lines - found["in_domain"]} | found
    else:
        # Spark drops a plan without rows, and its observations with it.
        counts = {row["outcome"]: row["lines"] for row in
                  quality.reject_counts(raw, options.domain).collect()}
        all_lines = sum(counts.values())
    kept = counts.get("kept", 0)
    row = (all_lines, kept, all_lines - kept, *[counts.get(name, 0) for name in REASONS],
           put["facts"], put["rejects"])
    return staged, spark.createDataFrame([row], ACCOUNT)


def _in_months(facts: DataFrame, months: Iterable[int]) -> DataFrame:
    """Daily facts of the months, found by their folders."""
    return facts.filter((F.col("year") * 100 + F.col("month")).isin(sorted(months)))


def _week_months(months: Iterable[int]) -> set[int]:
    """Months in which weeks of the given months start."""
    found = set(months)
    for month in months:
        first = date(month // 100, month % 100, 1)
        start = first - timedelta(days=first.isoweekday() % 7)
        found.add(start.year * 100 + start.month)
    return found


def _next_month(month: int) -> int:
    return month + 89 if month % 100 == 12 else month + 1


def refreshed_lists(daily: DataFrame, months: Sequence[int], options: TrendOptions
                    ) -> tuple[DataFrame, list[str]]:
    """Top lists of the intervals that the months touch, and the parts they fill.

    ``daily`` has the partition columns ``year`` and ``month``. Days and months are
    ranked in the given months only, years as a whole, weeks by the month in which they
    start, which reaches into the next one.
    """
    years = sorted({month // 100 for month in months})
    starts = _week_months(months)
    own = _in_months(daily, months).drop("year", "month")
    in_years = daily.filter(F.col("year").isin(years)).drop("year", "month")
    start = F.col("interval_start")
    weeks = rollup.weekly_views(_in_months(
        daily, starts | {_next_month(month) for month in starts}).drop("year", "month")).filter(
        (F.year(start) * 100 + F.month(start)).isin(sorted(starts)))
    facts = {"day": own, "week": weeks, "month": rollup.monthly_views(own),
             "year": rollup.yearly_views(rollup.monthly_views(in_years))}
    covered = {"day": months, "week": sorted(starts), "month": months, "year": years}
    tops = {grain: ranking.top_pages(facts[grain], grain, options.top_n, options.min_views,
                                     grain == "day") for grain in options.grains}
    if options.collapse_ties:
        tops = {grain: ranking.collapse_ties(ranked) for grain, ranked in tops.items()}
    parts = [f"{grain}-{label}" for grain in options.grains for label in covered[grain]]
    return ranking.tagged_lists(tops), parts


def _refresh_series(daily: DataFrame, lists: DataFrame, months: Sequence[int], path: str) -> None:
    """Merges the months into the stored series; only buckets that change are written."""
    spark = daily.sparkSession
    held = scratch_path(spark, "popular")
    series.popular_page_ids(lists).write.parquet(held)
    popular = spark.read.schema(lists.select(*rollup.PAGE).schema).parquet(held)
    facts = daily.drop("year", "month")
    if current_version(spark, path) is None:
        write_series(series.page_series(series.popular_daily_views(facts, popular)), path)
        return
    points = series.popular_daily_views(_in_months(daily, months).drop("year", "month"), popular)
    pages, fresh = series.changed_series(read_series(spark, path), popular, points, months)
    pages = pages.withColumn("part", series_part())
    parts = [row["part"] for row in pages.select("part").distinct().collect()]
    if not parts:
        return
    in_parts = series_part().isin(parts)
    history = facts.filter("false") if fresh.isEmpty() else series.popular_daily_views(
        facts, fresh, prefilter=True)
    write_series(series.merged_series(
        read_series(spark, path, parts), popular.filter(in_parts), points.filter(in_parts),
        history, months), path, cleared=parts)


def build_trends(raw: DataFrame, output: str, storage_level: str | None = None,
                 options: TrendOptions = TrendOptions(), rebuild: bool = False) -> DataFrame:
    """From scanned lines, writes below ``output`` and returns the account of the lines:

    ``daily``: facts by year and month; months present in ``raw`` are replaced.
    ``rejects``: the reported rejects of these months.
    ``top_pages``: lookup table; the intervals that these months touch are ranked anew.
    ``documents``: text by grain and year, of the years touched.
    ``series``: day-by-day series of popular pages; pages that change are merged.

    The text is read once: facts and rejects are staged together, and every later step
    starts from the stored facts, so a lost executor never leads back to the text. A
    load costs what it touches, not what is stored. Loads of one output should have the
    same options; ``rebuild`` derives everything from all stored months again.
    ``storage_level`` keeps the facts that a run needs in executors between steps; that
    pays where reading them back is slow.
    """
    spark = raw.sparkSession
    staged, account = _stage(raw, options)
    found = sorted({row["yyyymm"] for row in staged.select("yyyymm").distinct().collect()})
    facts = staged.filter("kept").select("day", *rollup.PAGE, "views")
    write_facts(facts, f"{output}/daily")
    rejects = staged.filter("NOT kept").select("day", "file_name", "reject_reason", "value",
                                               "copies")
    write_rejects(rejects, f"{output}/rejects", cleared=map(str, found))
    daily = read_daily(spark, f"{output}/daily")
    if rebuild:
        months = sorted({row["year"] * 100 + row["month"] for row in
                         daily.select("year", "month").distinct().collect()})
    else:
        months = found
    if not months:
        return account
    if storage_level:
        daily = persist_level(daily, storage_level)
    try:
        ranked, parts = refreshed_lists(daily, months, options)
        write_top_pages(ranked, f"{output}/top_pages", cleared=parts)
        lists = read_top_pages(spark, f"{output}/top_pages").filter(
            F.col("grain").isin(list(options.grains)))
        for grain in options.grains:
            years = {int(part.rpartition("-")[2][:4]) for part in parts
                     if part.startswith(f"{grain}-")}
            chosen = lists.filter((F.col("grain") == grain)
                                  & F.year("interval_start").isin(sorted(years)))
            docs = documents.interval_docs(documents.nest_top_pages(chosen, options.url_prefix))
            write_doc_lines(doc_lines(docs, grain), f"{output}/documents")
        _refresh_series(daily, lists, months, f"{output}/series")
    finally:
        if storage_level:
            daily.unpersist()
    return account
