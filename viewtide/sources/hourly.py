"""Hourly text files and the choice of which files and lines to load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.functions import fields
from viewtide.operators.topn import top_rows
from viewtide.params import SAMPLE_FILES

# Columns that order the lines of one file: start of the split, then the line
# within it. Both are needed because a large uncompressed file has many splits.
POSITION = ("block_start", "line_id")


def scan_lines(spark: SparkSession, path: str | Sequence[str], where: Column | None = None,
               positions: bool = False, recursive: bool = False) -> DataFrame:
    """Lines of text files, gzip included: ``file_name, value``.

    ``where`` restricts the scan and is applied directly on it, so tests on
    partition columns prune files. ``positions`` adds the POSITION columns,
    which order the lines of a file. A folder partitioned by ``file_name``
    supplies the name itself.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    lines = reader.text(path if isinstance(path, str) else list(path))
    if where is not None:
        lines = lines.filter(where)
    name = "file_name" if "file_name" in lines.columns else "_metadata.file_name"
    columns = [F.col(name).alias("file_name")]
    if positions:
        columns += [F.col("_metadata.file_block_start").alias("block_start"),
                    F.monotonically_increasing_id().alias("line_id")]
    return lines.select(*columns, "value")


def scope_paths(base: str, year: int, start_month: int | None = None,
                end_month: int | None = None) -> list[str]:
    """Folders ``base/YYYY/*`` or ``base/YYYY/MM`` of a year, month or range."""
    months = month_range(start_month, end_month)
    if months is None:
        return [f"{base}/{year}/*"]
    return [f"{base}/{year}/{month:02d}" for month in months]


def month_range(start_month: int | None, end_month: int | None) -> range | None:
    """Months of a scope, None for all: a start alone is one month, an end alone
    means all months up to it."""
    if start_month is None and end_month is None:
        return None
    first = 1 if start_month is None else start_month
    last = first if end_month is None else end_month
    if not 1 <= first <= last <= 12:
        raise ValueError(f"no months from {first} to {last}")
    return range(first, last + 1)


def load_scope(table: DataFrame, year: int, start_month: int | None = None,
               end_month: int | None = None) -> DataFrame:
    """Rows of a year, month or month range of a table partitioned by both."""
    scope = F.col("year") == year
    months = month_range(start_month, end_month)
    if months is not None:
        scope &= F.col("month").between(months[0], months[-1])
    return table.filter(scope)


def limit_per_file(records: DataFrame, n: int,
                   order: Sequence[str] = POSITION) -> DataFrame:
    """First ``n`` accepted records of every file; 0 keeps all."""
    if n <= 0:
        return records
    return top_rows(records, ["file_name"], [F.col(name) for name in order], n).drop("rank")


def list_files(spark: SparkSession, path: str | Sequence[str],
               pattern: str = "*") -> DataFrame:
    """Inventory ``file_name, length`` of folder trees; contents are not read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern)
             .load(path if isinstance(path, str) else list(path)))
    return found.select(F.substring_index("path", "/", -1).alias("file_name"), "length")


def files_limit(files: DataFrame, n: int) -> DataFrame:
    """First ``n`` distinct file names of every month, by name; 0 keeps all."""
    names = files.select("file_name").distinct()
    if n <= 0:
        return names
    by_month = names.withColumn("file_month", fields.file_month(F.col("file_name")))
    return top_rows(by_month, ["file_month"], [F.col("file_name")], n).select("file_name")


def keep_files(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Lines of the files in the inventory."""
    return lines.join(files.select("file_name"), "file_name", "left_semi")


def last_kept_names(files: DataFrame, n: int) -> dict[str, str]:
    """Per month the last of its first ``n`` file names: one entry a month."""
    kept = files_limit(files, n)
    rows = (kept.groupBy(fields.file_month(F.col("file_name")).alias("month"))
            .agg(F.max("file_name").alias("name")).collect())
    return {row["month"]: row["name"] for row in rows}


def within_names(last: dict[str, str]) -> Column:
    """Test on the file name inside the scan: other files are not opened."""
    name = F.col("_metadata.file_name")
    test = F.lit(False)
    for month, bound in sorted(last.items()):
        test = test | (name.startswith(f"pageviews-{month}") & (name <= bound))
    return test


def sample_files(lines: DataFrame, names: Sequence[str] = SAMPLE_FILES) -> DataFrame:
    """Lines of a fixed list of files."""
    return lines.filter(F.col("file_name").isin(list(names)))
