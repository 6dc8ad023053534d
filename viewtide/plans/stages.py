"""Full sums per page, without a threshold, as tab-separated stages.

Daily views feed the weeks and the months, and the months feed the years. Each
stage is read back from its text, so stages can be run or repeated apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.functions.fields import label_start
from viewtide.operators import quality, rollup
from viewtide.operators.layout import partition_by_key
from viewtide.params import DOMAIN
from viewtide.sinks import write_stage_kv
from viewtide.sources import read_stage_kv


def stage_facts(spark: SparkSession, path: str, grain: str) -> DataFrame:
    """A stage as facts."""
    rows = read_stage_kv(spark, path, grain)
    return rows.select(label_start(F.col("interval")).alias("interval_start"),
                       *rollup.PAGE, "views")


def build_stages(raw: DataFrame, output: str, partitions: int | None = None,
                 domain: str = DOMAIN) -> None:
    """Writes ``daily``, ``weekly``, ``monthly`` and ``yearly`` below ``output``.

    ``partitions`` fixes the number of files per stage, hashed by key.
    """
    spark = raw.sparkSession

    def write(facts: DataFrame, name: str, grain: str) -> DataFrame:
        if partitions:
            start = "day" if "day" in facts.columns else "interval_start"
            facts = partition_by_key(facts, partitions, (start, *rollup.PAGE))
        write_stage_kv(facts, f"{output}/{name}", grain)
        return stage_facts(spark, f"{output}/{name}", grain)

    daily = write(rollup.daily_views(quality.clean_lines(raw, domain)), "daily", "day")
    write(rollup.weekly_views(daily), "weekly", "week")
    monthly = write(rollup.monthly_views(daily), "monthly", "month")
    write(rollup.yearly_views(monthly), "yearly", "year")
