"""Text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions import fields


def doc_lines(docs: DataFrame, grain: str) -> DataFrame:
    """Documents as text lines ``(id,json)`` with ``grain`` and ``year``."""
    line = F.concat(F.lit("("), "doc_id", F.lit(","), "doc", F.lit(")"))
    return docs.select(line.alias("value"), F.lit(grain).alias("grain"),
                       F.year("interval_start").alias("year"))


def write_doc_lines(lines: DataFrame, path: str) -> None:
    """Writes document lines into one folder per grain and year. Folders that
    get new lines are replaced, the others stay."""
    parts = ("grain", "year")
    (lines.hint("rebalance", *[F.col(name) for name in parts]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).text(path))


def export_compressed(lines: DataFrame, path: str) -> None:
    """Gzip copy of text lines for transfer; an earlier copy is replaced."""
    lines.select("value").write.mode("overwrite").option("compression", "gzip").text(path)


def write_stage_kv(facts: DataFrame, path: str, grain: str) -> None:
    """Facts as ``label+domain title<TAB>views`` text; an earlier run is replaced."""
    start = "day" if "day" in facts.columns else "interval_start"
    key = fields.stage_key(fields.interval_label(F.col(start), grain),
                           F.col("domain_code"), F.col("page_title"))
    facts.select(F.concat_ws("\t", key, F.col("views")).alias("value")).write.mode("overwrite").text(path)


def write_stamped_lines(stamped: DataFrame, path: str) -> None:
    """Hour-stamped lines of all files as one text set, without a shuffle.

    An earlier run is replaced.
    """
    stamped.select("value").write.mode("overwrite").text(path)
