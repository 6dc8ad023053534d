"""Order by popularity and the most viewed pages of every interval."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions import fields
from viewtide.operators.rollup import PAGE, above
from viewtide.operators.topn import top_rows
from viewtide.params import MIN_VIEWS, TOP_N
from viewtide.storage import shared_dir

# Low bits of monotonically_increasing_id: the row within its partition.
_ROW_BITS = 33


def _order() -> list:
    return [F.col("views").desc(), *[F.col(name).asc() for name in PAGE]]


def sort_popularity(facts: DataFrame) -> DataFrame:
    """Latest interval first, then most viewed; page order breaks ties."""
    return facts.orderBy(F.col("interval_start").desc(), *_order())


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Adds the 1-based place in the global order of a sorted table.

    No task sees more than its own range: the sorted ranges are written to the
    checkpoint folder once, and each range is shifted by the number of rows in
    the ranges before it. That offset table has one row per partition.
    """
    shared_dir(ordered.sparkSession)
    ranges = ordered.checkpoint().select(
        "*", F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("_range").agg(F.count("*").alias("_size")).select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (ranges.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_before") + F.col("_row") + F.lit(1))
            .drop("_range", "_row", "_before"))


def within_reach(facts: DataFrame, n: int) -> DataFrame:
    """Facts with at least the ``n``-th highest view count of their interval.

    No page of a top list is lost, ties included. The cutoffs come from counts
    per interval and view count, which needs no page names. They are broadcast:
    one row per interval, so a century of days is under 40,000 rows.
    """
    counts = facts.groupBy("interval_start", "views").agg(F.count("*").alias("_pages"))
    highest = top_rows(counts, ["interval_start"], [F.col("views").desc()], n)
    higher = (Window.partitionBy("interval_start").orderBy(F.col("views").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    cutoffs = (highest.withColumn("_above", F.coalesce(F.sum("_pages").over(higher), F.lit(0)))
               .filter(F.col("_above") < n)
               .groupBy("interval_start").agg(F.min("views").alias("_cutoff")))
    return (facts.join(F.broadcast(cutoffs), "interval_start")
            .filter(F.col("views") >= F.col("_cutoff")).drop("_cutoff"))


def top_pages(facts: DataFrame, grain: str, n: int = TOP_N,
              min_views: int | None = MIN_VIEWS, stored: bool = False) -> DataFrame:
    """The ``n`` most viewed pages of every interval, ranked from 1.

    Equal counts are ordered by page and none is lost. Returns
    ``interval_start, interval, rank, domain_code, page_title, page_id, views``.

    ``stored`` says that the facts are cheap to read twice. Then most of them
    are dropped by their view count before any sort compares page names; on
    facts that would be computed twice this costs more than it saves.
    """
    if "day" in facts.columns:
        facts = facts.withColumnRenamed("day", "interval_start")
    facts = above(facts, min_views)
    ranked = top_rows(within_reach(facts, n) if stored else facts, ["interval_start"],
                      _order(), n)
    return ranked.select(
        "interval_start",
        fields.interval_label(F.col("interval_start"), grain).alias("interval"),
        "rank", *PAGE, fields.page_id(*[F.col(name) for name in PAGE]).alias("page_id"), "views")


def collapse_ties(ranked: DataFrame) -> DataFrame:
    """Keeps the first page of every view count in a top list and ranks again.

    Works on ranked rows, so a group is never larger than the list limit.
    """
    window = Window.partitionBy("interval_start").orderBy("rank")
    previous = F.lag("views").over(window)
    return (ranked.withColumn("_first", ~previous.eqNullSafe(F.col("views")))
            .withColumn("rank", F.sum(F.col("_first").cast("int")).over(window).cast("int"))
            .filter("_first").drop("_first"))


def tagged_lists(tops: dict[str, DataFrame]) -> DataFrame:
    """Top lists of several grains as one table with a ``grain`` column.

    One query for all grains lets Spark reuse the daily and monthly shuffles
    that the lists share.
    """
    tagged = [ranked.withColumn("grain", F.lit(grain)) for grain, ranked in tops.items()]
    return reduce(DataFrame.unionByName, tagged)


def top_pages_for(table: DataFrame, grain: str, interval: str) -> DataFrame:
    """The list of one day, month or year from a table of lists, in rank order."""
    return table.filter((F.col("grain") == grain) & (F.col("interval") == interval))
