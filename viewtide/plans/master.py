"""From hourly text files to the typed record store or one stamped text set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from viewtide.functions.fields import file_month
from viewtide.functions.lines import RECORD_REASONS
from viewtide.operators import quality
from viewtide.sinks import write_master, write_stamped_lines
from viewtide.sources import limit_per_file

ACCOUNT = ("files BIGINT, records BIGINT, good_records BIGINT, bad_records BIGINT, "
           "max_domain_length INT, max_domain_example STRING, "
           + ", ".join(f"{reason} BIGINT" for reason in RECORD_REASONS)
           + ", written BIGINT, damaged BIGINT")


def _account(raw: DataFrame, judged: Observation, written: Observation,
             damaged: int | None = None) -> DataFrame:
    """One row on a load: good and bad records add up to all lines.

    The counts were taken while the load was written, so the text is read once.
    ``files`` are the files in the scope of the load; ``written`` differs from
    ``good_records`` only by a limit. ``damaged`` is null without an audit.
    """
    found = judged.get
    longest = found["longest"]
    files = len(set(raw.inputFiles())) or raw.select("file_name").distinct().count()
    row = (files, found["records"], found["good_records"],
           found["records"] - found["good_records"],
           None if longest is None else -longest["size"],
           None if longest is None else longest["domain_code"],
           *[found[reason] for reason in RECORD_REASONS], written.get["written"], damaged)
    return raw.sparkSession.createDataFrame([row], ACCOUNT)


def load_master(raw: DataFrame, path: str, limit: int = 0, audit: bool = False) -> DataFrame:
    """Writes the typed records of all domains; returns the account of the load.

    A ``limit`` of accepted records per file needs lines scanned with positions.
    ``audit`` reads the stored months back and counts the records that differ. The
    fingerprint of what was written is taken while it is written, so a sound store costs
    one pass over its own files; only if that differs is the text read again.
    """
    judged, written = Observation("judged"), Observation("written")
    lines = quality.with_record_outcome(raw).observe(judged, *quality.record_metrics())
    records = limit_per_file(quality.records_of(lines), limit).drop("block_start", "line_id")
    marks = quality.fingerprint_metrics(records.columns) if audit else []
    write_master(records.observe(written, F.count("*").alias("written"), *marks), path)
    if not audit:
        return _account(raw, judged, written)
    stored = _loaded_months(raw, path).select(*records.columns)
    found, seen = stored.agg(*marks).first(), written.get
    sound = all(found[name] == seen[name] for name in ("n", "x", "s"))
    damaged = 0 if sound else quality.record_differences(records, stored).agg(
        F.coalesce(F.sum(F.abs(F.col("in_source") - F.col("in_store"))), F.lit(0))).first()[0]
    return _account(raw, judged, written, damaged)


def _loaded_months(raw: DataFrame, path: str) -> DataFrame:
    """The stored records of the months that the files of a load belong to."""
    month = file_month(F.col("file_name"))
    names = {name.rpartition("/")[2] for name in raw.inputFiles()}
    months = {name[10:16] for name in names} or {
        row[0] for row in raw.select(month).distinct().collect()}
    stored = raw.sparkSession.read.parquet(path)
    return stored.filter((F.col("year") * 100 + F.col("month")).isin(sorted(map(int, months))))


def consolidate(raw: DataFrame, path: str, limit: int = 0) -> DataFrame:
    """Writes hour-stamped lines of all files; returns the account of the load.

    Lines of four fields are written whatever their numbers; the account still
    tells which of them are no typed records.
    """
    judged, written = Observation("judged"), Observation("written")
    seen = quality.with_record_outcome(raw).observe(judged, *quality.record_metrics()).select(
        *raw.columns)
    write_stamped_lines(limit_per_file(quality.stamp_lines(seen), limit).observe(
        written, F.count("*").alias("written")), path)
    return _account(raw, judged, written)
