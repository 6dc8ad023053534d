"""Sums of views per page and interval.

``*_views`` roll up daily rows above the threshold; pass the unthresholded
daily table for full sums (the ``_all`` flavour). A fact table has
``domain_code, page_title, views`` and either ``day`` or ``interval_start``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions.fields import interval_start
from viewtide.params import MIN_VIEWS

PAGE = ("domain_code", "page_title")


def daily_views(rows: DataFrame) -> DataFrame:
    """Views per day and page of hourly or finer rows."""
    return rows.groupBy("day", *PAGE).agg(F.sum("views").alias("views"))


def above(facts: DataFrame, min_views: int | None = MIN_VIEWS) -> DataFrame:
    """Facts with strictly more than ``min_views`` views; None keeps all."""
    return facts if min_views is None else facts.filter(F.col("views") > min_views)


# Grains that whole intervals of a grain nest in. A week may straddle months and years.
_NESTS_IN = {"day": ("day", "week", "month", "year"), "week": ("week",),
             "month": ("month", "year"), "year": ("year",)}


def rollup(facts: DataFrame, grain: str, source: str | None = None) -> DataFrame:
    """Views per interval of the grain and page, from finer facts.

    ``source`` is the grain of the facts, by default day where there is a
    ``day`` column. Facts whose intervals do not nest in the grain are refused:
    a week belongs to no single month.
    """
    source = source or ("day" if "day" in facts.columns else None)
    if source is not None and grain not in _NESTS_IN[source]:
        raise ValueError(f"{source} facts do not nest in {grain} intervals")
    finer = "day" if "day" in facts.columns else "interval_start"
    start = interval_start(F.col(finer), grain).alias("interval_start")
    return facts.groupBy(start, *PAGE).agg(F.sum("views").alias("views"))


def weekly_views(daily: DataFrame) -> DataFrame:
    return rollup(daily, "week", "day")


def monthly_views(daily: DataFrame) -> DataFrame:
    return rollup(daily, "month", "day")


def yearly_views(monthly: DataFrame) -> DataFrame:
    """Month rows summed by year, before any month threshold."""
    return rollup(monthly, "year", "month")
