"""Readers of what the sinks write."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.functions.fields import LABEL_LENGTH, split_page_id
from viewtide.operators.ranking import top_pages_for, with_position
from viewtide.parts import read_parts

# Schemas are given, so reading starts no inference job and an empty table works.
_DAILY_SCHEMA = ("day DATE, domain_code STRING, page_title STRING, views BIGINT, "
                 "year INT, month INT")
_TOP_PAGES_SCHEMA = ("interval_start DATE, interval STRING, rank INT, domain_code STRING, "
                     "page_title STRING, page_id STRING, views BIGINT, grain STRING")
_SERIES_SCHEMA = ("domain_code STRING, page_title STRING, page_id STRING, "
                  "daily_views ARRAY<STRUCT<day: DATE, views: BIGINT>>")
_REJECT_SCHEMA = ("day DATE, file_name STRING, reject_reason STRING, value STRING, copies BIGINT")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily facts with their partition columns ``year`` and ``month``."""
    return spark.read.schema(_DAILY_SCHEMA).parquet(path)


def read_top_pages(spark: SparkSession, path: str) -> DataFrame:
    """Lookup table of ranked pages, all grains and intervals."""
    return read_parts(spark, path, _TOP_PAGES_SCHEMA)


def read_top_list(spark: SparkSession, path: str, grain: str, interval: str) -> DataFrame:
    """The list of one interval by its label. Of the lookup table only the part that
    holds the interval is opened."""
    part = f"{grain}-{interval[:4] if grain == 'year' else interval[:6]}"
    return top_pages_for(read_parts(spark, path, _TOP_PAGES_SCHEMA, [part]), grain, interval)


def read_series(spark: SparkSession, path: str, parts: Iterable[str] | None = None) -> DataFrame:
    """Stored page series, of some parts or of all."""
    return read_parts(spark, path, _SERIES_SCHEMA, parts)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Lines that runs rejected, with file, reason and number of equal lines."""
    return read_parts(spark, path, _REJECT_SCHEMA)


def read_stage_kv(spark: SparkSession, path: str, grain: str) -> DataFrame:
    """Stage text ``label+domain title<TAB>views`` as
    ``interval, domain_code, page_title, views``."""
    width = LABEL_LENGTH[grain]
    key = F.substring_index("value", "\t", 1)
    page = F.substring(key, F.lit(width + 1), F.length(key))
    return spark.read.text(path).select(
        F.substring(key, 1, width).alias("interval"), *split_page_id(page),
        F.substring_index("value", "\t", -1).cast("bigint").alias("views"))


def read_doc_lines(spark: SparkSession, path: str) -> DataFrame:
    """Document lines ``(id,json)`` below a folder, blank ones included.

    Returns ``file_path``, ``grain`` (from a folder ``grain=``, else empty), the
    line position, ``value``, ``doc_id`` and ``doc``. The document starts at the first ``,{``; where there is none,
    both are null. Partition folders do not become columns.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.regexp_extract("_metadata.file_path", "/grain=([^/]+)/", 1).alias("grain"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"), "value")
    cut = F.instr("value", ",{")
    inner = F.length("value") - cut - F.lit(1)
    return lines.select(
        "*",
        F.when(cut > 0, F.substring("value", F.lit(2), cut - F.lit(2))).alias("doc_id"),
        F.when(cut > 0, F.substring("value", cut + F.lit(1), inner)).alias("doc"))


def read_master(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """Typed master records; with ``limit``, the first ones in a fixed order.

    Hours are counted first. All records of the hours before the one in which the limit
    is reached are taken as they lie; only that hour is sorted, in ranges, and cut by
    position. So no task ever holds as many rows as the limit. The driver sees one
    count per hour.
    """
    records = spark.read.parquet(path)
    if limit <= 0:
        return records
    stamp = F.col("hourly_timestamp")
    hour = ((stamp["year"] * 100 + stamp["month"]) * 100 + stamp["day"]).cast("bigint") * 100 \
        + stamp["hour"]
    counts = records.groupBy(hour.alias("hour")).count().collect()
    before = 0
    for at, count in sorted((row["hour"], row["count"]) for row in counts):
        if before + count >= limit:
            break
        before += count
    else:
        return records
    order = ["domain_code", "page_title", "count_views", "total_response_size"]
    rest = [name for name in records.columns if name not in (*order, "hourly_timestamp")]
    last = records.filter(hour == at)
    if before + count > limit:
        last = with_position(last.orderBy(*order, *rest), "_place").filter(
            F.col("_place") <= limit - before).drop("_place")
    return records.filter(hour < at).unionByName(last)
