"""Fields, roll-ups, rankings and physical controls, over page-day facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import (
    FORMATS,
    LINEITEM_SQL,
    PARTS_SQL,
    daily_above,
    daily_lineitem,
    daily_parts,
    plain,
    top_sql,
)
from viewtide.functions import fields
from viewtide.operators import layout, ranking, rollup
from viewtide.storage import shared_dir

TOP = 10
TOP_YEAR = 500
MONTH_FLOOR = 1000
YEAR_FLOOR = 10000
PARTITIONS = 16


def _daily(spark, sf_dir):
    return daily_above(daily_lineitem(spark, sf_dir))


def _field(name, make):
    """One scalar expression beside the columns it is computed from."""
    def run(spark, sf_dir):
        rows = daily_lineitem(spark, sf_dir)
        return plain(rows.select("day", "page_title", "views", make().alias(name)))
    return run


def _label(grain):
    return _field("label", lambda: fields.interval_label(
        fields.interval_start(F.col("day"), grain), grain))


def split_page_id(spark, sf_dir):
    rows = daily_lineitem(spark, sf_dir).select(
        fields.page_id(F.col("domain_code"), F.col("page_title")).alias("page_id"))
    return rows.select("page_id", *fields.split_page_id(F.col("page_id")))


def _keyed(spark, sf_dir):
    rows = daily_lineitem(spark, sf_dir)
    return rows.select("page_title", fields.sort_key(
        fields.interval_label(F.col("day"), "day"), F.col("views")).alias("sort_key"))


def parse_sort_key(spark, sf_dir):
    return _keyed(spark, sf_dir).select(
        "page_title", "sort_key", *fields.parse_sort_key(F.col("sort_key")))


def daily_views_min(spark, sf_dir):
    return plain(_daily(spark, sf_dir))


def _rolled(grain, source=_daily, floor=None):
    def run(spark, sf_dir):
        daily = source(spark, sf_dir)
        if grain == "year":
            facts = rollup.yearly_views(rollup.monthly_views(daily))
        else:
            facts = rollup.rollup(daily, grain)
        return plain(rollup.above(facts, floor))
    return run


def _all_days(spark, sf_dir):
    return rollup.daily_views(daily_lineitem(spark, sf_dir))


def tops(daily, n, grains=("day", "month", "year")):
    """Top lists of a daily table by grain."""
    monthly = rollup.monthly_views(daily)
    facts = {"day": daily, "week": rollup.weekly_views(daily), "month": monthly,
             "year": rollup.yearly_views(monthly)}
    return {grain: ranking.top_pages(facts[grain], grain, n) for grain in grains}


def _top(grain, n=TOP, source=daily_lineitem):
    def run(spark, sf_dir):
        daily = daily_above(source(spark, sf_dir))
        return tops(daily, n, (grain,))[grain].drop("interval_start")
    return run


def sort_popularity(spark, sf_dir):
    daily = _daily(spark, sf_dir).withColumnRenamed("day", "interval_start")
    return plain(ranking.with_position(ranking.sort_popularity(daily)))


def top_pages_daily_stored(spark, sf_dir):
    """The daily lists with pages out of reach dropped by their view count first."""
    ranked = ranking.top_pages(_daily(spark, sf_dir), "day", TOP, stored=True)
    return ranked.drop("interval_start")


def page_rank_no(spark, sf_dir):
    return _top("day")(spark, sf_dir).select("interval", "rank", "page_title")


def top_pages_collapsed(spark, sf_dir):
    ranked = ranking.top_pages(_daily(spark, sf_dir), "day", TOP)
    return ranking.collapse_ties(ranked).drop("interval_start")


def top_pages_yearly_deep(spark, sf_dir):
    """A limit above the size up to which Spark prunes before the exchange."""
    daily = daily_above(daily_parts(spark, sf_dir))
    yearly = rollup.yearly_views(rollup.monthly_views(daily))
    return ranking.top_pages(yearly, "year", 1500).drop("interval_start")


def partition_by_key(spark, sf_dir):
    key = ("day", "domain_code", "page_title")
    placed = layout.partition_by_key(_all_days(spark, sf_dir), PARTITIONS)
    return plain(placed.withColumn("part", F.spark_partition_id()).groupBy(*key).agg(
        F.sum("views").alias("views"), F.count_distinct("part").alias("parts")))


def persist_level(spark, sf_dir):
    """A list made from a kept table, which is released again."""
    shared_dir(spark)
    daily = layout.persist_level(_daily(spark, sf_dir), "DISK")
    try:
        return tops(daily, TOP, ("year",))["year"].drop("interval_start").checkpoint()
    finally:
        daily.unpersist()


QUERIES = {
    "key_day": _label("day"),
    "key_month": _label("month"),
    "key_year": _label("year"),
    "week_start": _field("week_start", lambda: fields.week_start(F.col("day"))),
    "page_id": _field("page_id", lambda: fields.page_id(F.col("domain_code"),
                                                        F.col("page_title"))),
    "page_topic": _field("topic", lambda: fields.page_topic(F.col("page_title"))),
    "page_url": _field("url", lambda: fields.page_url(F.col("page_title"))),
    "sort_key": _keyed,
    "parse_sort_key": parse_sort_key,
    "split_page_id": split_page_id,
    "daily_views_min": daily_views_min,
    "weekly_views": _rolled("week"),
    "monthly_views": _rolled("month"),
    "yearly_views": _rolled("year"),
    "monthly_views_min": _rolled("month", floor=MONTH_FLOOR),
    "yearly_views_min": _rolled("year", floor=YEAR_FLOOR),
    "weekly_views_all": _rolled("week", _all_days),
    "monthly_views_all": _rolled("month", _all_days),
    "yearly_views_all": _rolled("year", _all_days),
    "sort_popularity": sort_popularity,
    "top_pages_daily": _top("day"),
    "top_pages_daily_stored": top_pages_daily_stored,
    "top_pages_weekly": _top("week"),
    "top_pages_monthly": _top("month"),
    "top_pages_yearly": _top("year", TOP_YEAR, daily_parts),
    "top_pages_yearly_deep": top_pages_yearly_deep,
    "page_rank_no": page_rank_no,
    "top_pages_collapsed": top_pages_collapsed,
    "partition_by_key": partition_by_key,
    "persist_level": persist_level,
}


def _sql(query):
    return f"WITH {LINEITEM_SQL} {query}"


def _field_sql(name, expression):
    return _sql(f"""SELECT CAST(day AS VARCHAR) AS day, page_title, views,
        {expression} AS "{name}" FROM l_rows""")


def _rolled_sql(grain, floor=0):
    return _sql(f"""SELECT CAST(start AS VARCHAR) AS interval_start, domain_code, page_title,
        views FROM l_{grain} WHERE views > {floor}""")


def _rolled_all_sql(start):
    return _sql(f"""SELECT CAST(CAST({start} AS DATE) AS VARCHAR) AS interval_start,
        domain_code, page_title, CAST(sum(views) AS BIGINT) AS views FROM l_rows GROUP BY ALL""")


_TOP_COLUMNS = '"interval", "rank", domain_code, page_title, page_id, views'


def _top_sql(prefix, grain, n=TOP):
    source = LINEITEM_SQL if prefix == "l" else PARTS_SQL
    return f"WITH {source} SELECT {_TOP_COLUMNS} FROM {top_sql(prefix, grain, n)}"


_WEEK = "day - CAST(dayofweek(day) AS INTEGER)"
_KEY = "strftime(day, '%Y%m%d') || lpad(CAST(views AS VARCHAR), 12, '0')"

SQL = {
    "key_day": _field_sql("label", f"strftime(day, '{FORMATS['day']}')"),
    "key_month": _field_sql("label", f"strftime(day, '{FORMATS['month']}')"),
    "key_year": _field_sql("label", f"strftime(day, '{FORMATS['year']}')"),
    "week_start": _field_sql("week_start", f"CAST(CAST({_WEEK} AS DATE) AS VARCHAR)"),
    "page_id": _field_sql("page_id", "'en ' || page_title"),
    "page_topic": _field_sql("topic", "replace(page_title, '_', ' ')"),
    "page_url": _field_sql("url", "'https://en.wikipedia.org/wiki/' || page_title"),
    "sort_key": _sql(f"SELECT page_title, {_KEY} AS sort_key FROM l_rows"),
    "parse_sort_key": _sql(f"""SELECT page_title, {_KEY} AS sort_key,
        strftime(day, '%Y%m%d') AS head, views FROM l_rows"""),
    "split_page_id": _sql("""SELECT 'en ' || page_title AS page_id, domain_code, page_title
        FROM l_rows"""),
    "daily_views_min": _sql("""SELECT CAST(day AS VARCHAR) AS day, domain_code, page_title, views
        FROM l_day"""),
    "weekly_views": _rolled_sql("week"),
    "monthly_views": _rolled_sql("month"),
    "yearly_views": _rolled_sql("year"),
    "monthly_views_min": _rolled_sql("month", MONTH_FLOOR),
    "yearly_views_min": _rolled_sql("year", YEAR_FLOOR),
    "weekly_views_all": _rolled_all_sql(_WEEK),
    "monthly_views_all": _rolled_all_sql("date_trunc('month', day)"),
    "yearly_views_all": _rolled_all_sql("date_trunc('year', day)"),
    "sort_popularity": _sql("""SELECT CAST(day AS VARCHAR) AS interval_start, domain_code,
        page_title, views, row_number() OVER (ORDER BY day DESC, views DESC, page_title)
          AS "position" FROM l_day"""),
    "top_pages_daily": _top_sql("l", "day"),
    "top_pages_daily_stored": _top_sql("l", "day"),
    "top_pages_weekly": _top_sql("l", "week"),
    "top_pages_monthly": _top_sql("l", "month"),
    "top_pages_yearly": _top_sql("w", "year", TOP_YEAR),
    "top_pages_yearly_deep": _top_sql("w", "year", 1500),
    "page_rank_no": _sql(f"""SELECT "interval", "rank", page_title
        FROM {top_sql("l", "day", TOP)}"""),
    "top_pages_collapsed": _sql(f"""SELECT "interval", domain_code, page_title, page_id, views,
        CAST(row_number() OVER (PARTITION BY "interval" ORDER BY views DESC) AS INTEGER) AS "rank"
      FROM (SELECT * FROM {top_sql("l", "day", TOP)}
        QUALIFY row_number() OVER (PARTITION BY "interval", views ORDER BY page_title) = 1)"""),
    "partition_by_key": _sql("""SELECT CAST(day AS VARCHAR) AS day, domain_code, page_title, views,
        CAST(1 AS BIGINT) AS parts FROM l_sums"""),
    "persist_level": _top_sql("l", "year"),
}
