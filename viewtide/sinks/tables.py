"""Parquet outputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.parts import read_parts, replace_parts


def write_facts(facts: DataFrame, path: str) -> None:
    """Fact table partitioned by year and month of its day or interval start.

    Rebalancing keeps files near the advisory size and splits a month that
    holds much more than the others.
    """
    start = F.col("day" if "day" in facts.columns else "interval_start")
    table = facts.withColumns({"year": F.year(start), "month": F.month(start)})
    (table.hint("rebalance", F.col("year"), F.col("month")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path))


def write_bucketed_facts(facts: DataFrame, table: str, path: str, buckets: int) -> None:
    """Facts in hash buckets of pages, sorted by page, as catalog table ``table``.

    Joins and sums by page on this table need no exchange of it. An earlier table is
    replaced. One task writes a bucket: choose so many that each is a few hundred
    megabytes.
    """
    page = ("domain_code", "page_title")
    (facts.repartition(buckets, *page).write.mode("overwrite").bucketBy(buckets, *page)
     .sortBy(*page).option("path", path).format("parquet").saveAsTable(table))


def write_master(records: DataFrame, path: str) -> None:
    """Typed records partitioned by year and month.

    Records of one hourly file share a month, so tasks already write to few
    folders and no shuffle is needed.
    """
    stamp = F.col("hourly_timestamp")
    (records.withColumns({"year": stamp["year"], "month": stamp["month"]})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month").parquet(path))


def overwrite_year(table: DataFrame, path: str) -> list[str]:
    """Replaces the years present in ``table`` (column ``year``), keeps the rest.

    The years are staged beside the current ones and published together, so until the
    last step, and after a write that failed, readers have the old years whole.
    """
    return replace_parts(table, F.col("year").cast("string"), path)


def read_years(spark: SparkSession, path: str, schema, *years: int) -> DataFrame:
    """The table of ``overwrite_year``: all years, or the given ones."""
    return read_parts(spark, path, schema, map(str, years) if years else None)


def top_pages_part(grain: Column, start: Column) -> Column:
    """Part of the lookup table that holds an interval: its grain and month, of a year
    its year."""
    return F.when(grain == "year", F.concat(grain, F.lit("-"), F.date_format(start, "yyyy"))
                  ).otherwise(F.concat(grain, F.lit("-"), F.date_format(start, "yyyyMM")))


def write_top_pages(ranked: DataFrame, path: str, cleared: Iterable[str] = ()) -> list[str]:
    """Lookup table of ranked pages. Parts that ``ranked`` has rows of are replaced,
    parts in ``cleared`` too, all others keep their files."""
    part = top_pages_part(F.col("grain"), F.col("interval_start"))
    return replace_parts(ranked, part, path, cleared, sort=("grain", "interval", "rank"))


# Buckets of pages in the stored series.
SERIES_BUCKETS = 64


def series_part(buckets: int = SERIES_BUCKETS) -> Column:
    """Part of the stored series that holds a page."""
    number = F.pmod(F.xxhash64("domain_code", "page_title"), F.lit(buckets)).cast("string")
    return F.concat(F.lpad(number, len(str(buckets)), "0"), F.lit(f"-of-{buckets}"))


def write_series(series: DataFrame, path: str, cleared: Iterable[str] = ()) -> list[str]:
    """Page series in buckets of pages; buckets without rows here stay as they are."""
    return replace_parts(series, series_part(), path, cleared, sort=("domain_code", "page_title"))


def write_rejects(rejects: DataFrame, path: str, cleared: Iterable[str] = ()) -> list[str]:
    """Rejected lines, one part per month; the months in ``cleared`` are replaced."""
    return replace_parts(rejects, F.date_format("day", "yyyyMM"), path, cleared)
