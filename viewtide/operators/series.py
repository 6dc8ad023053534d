"""Popular pages and their day-by-day series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions import fields
from viewtide.operators.bloom import maybe_in
from viewtide.operators.rollup import PAGE


def popular_page_ids(*ranked: DataFrame) -> DataFrame:
    """Pages in any of the top lists, once each."""
    pages = [top.select(*PAGE) for top in ranked]
    return reduce(DataFrame.unionByName, pages).distinct()


def popular_daily_views(daily: DataFrame, popular: DataFrame,
                        prefilter: bool = False) -> DataFrame:
    """Daily rows of popular pages. Spark picks the join side by size.

    ``prefilter`` tests the rows against a bitmap of the pages where they are scanned;
    ``popular`` is then read twice, so it should be stored. On facts that lie in buckets
    of pages (``write_bucketed_facts``) the join needs no exchange of facts.
    """
    rows = maybe_in(daily, popular, PAGE) if prefilter else daily
    return rows.join(popular, list(PAGE), "left_semi")


def page_series(daily: DataFrame) -> DataFrame:
    """Per page, the array of ``(day, views)`` in day order.

    ``daily`` holds one row per day and page, so an array has at most one
    element per calendar day.
    """
    point = F.struct("day", "views")
    series = F.sort_array(F.collect_list(point)).alias("daily_views")
    page = fields.page_id(*[F.col(name) for name in PAGE]).alias("page_id")
    return daily.groupBy(*PAGE).agg(series).select(*PAGE, page, "daily_views")


def _months(days: Column) -> Column:
    return F.year(days) * 100 + F.month(days)


def changed_series(stored: DataFrame, popular: DataFrame, points: DataFrame,
                   months: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Pages whose stored series no longer holds, and those of them without one so far.

    ``months`` (as ``yyyymm``) were loaded anew, ``points`` are their daily rows. A page
    changes if it has points there, had some there before, or became or ceased to be
    popular.
    """
    page = list(PAGE)
    had = stored.filter(F.exists("daily_views", lambda p: _months(p["day"]).isin(*months)))
    fresh = popular.join(stored.select(*page), page, "left_anti")
    gone = stored.select(*page).join(popular, page, "left_anti")
    moved = points.select(*page).distinct().join(popular, page, "left_semi")
    changed = (had.select(*page).unionByName(gone).unionByName(moved).unionByName(fresh)
               .distinct())
    return changed, fresh


def merged_series(stored: DataFrame, popular: DataFrame, points: DataFrame, history: DataFrame,
                  months: Sequence[int]) -> DataFrame:
    """Stored series with the loaded months exchanged, whole series of fresh pages.

    ``points`` are the daily rows of the loaded months, ``history`` all daily rows of
    the pages that have no series yet. A page meets at most three rows here, so the
    arrays are joined without gathering days anew.
    """
    page = list(PAGE)
    kept = stored.select(*page, F.filter(
        "daily_views", lambda p: ~_months(p["day"]).isin(*months)).alias("daily_views"))
    known = points.join(stored.select(*page), page, "left_semi")
    parts = (kept.unionByName(page_series(known).drop("page_id"))
             .unionByName(page_series(history).drop("page_id")))
    joined = parts.join(popular, page, "left_semi").groupBy(*page).agg(F.sort_array(F.flatten(
        F.collect_list("daily_views"))).alias("daily_views")).filter("size(daily_views) > 0")
    name = fields.page_id(*[F.col(part) for part in PAGE]).alias("page_id")
    return joined.select(*page, name, "daily_views")


def page_series_docs(series: DataFrame) -> DataFrame:
    """JSON document per page, all leaves as strings: ``doc_id, doc``."""
    def leaf(point):
        return F.struct(F.date_format(point["day"], "yyyyMMdd").alias("day"),
                        point["views"].cast("string").alias("views"))
    body = F.struct(F.col("page_id").alias("pageId"),
                    F.transform("daily_views", leaf).alias("dailyViews"))
    return series.select(F.col("page_id").alias("doc_id"), F.to_json(body).alias("doc"))
