"""Nested output, JSON documents, popular pages and their series."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.facts import TOP, tops
from catalog.fixtures import (
    LINEITEM_SQL,
    PARTS_SQL,
    daily_above,
    daily_lineitem,
    daily_parts,
    docs_sql,
    plain,
    top_sql,
)
from viewtide import sinks
from viewtide.operators import documents, series
from viewtide.storage import scratch_path


def nested_days(spark, sf_dir, n=TOP, source=daily_lineitem):
    """Daily top lists as one nested row per day."""
    ranked = tops(daily_above(source(spark, sf_dir)), n, ("day",))["day"]
    return documents.nest_top_pages(ranked)


def nest_top_pages(spark, sf_dir):
    nested = nested_days(spark, sf_dir)
    return nested.select("interval", F.posexplode("top_pages").alias("pos", "page")).select(
        "interval", "pos", "page.*")


def interval_docs(spark, sf_dir):
    return documents.interval_docs(nested_days(spark, sf_dir)).drop("interval_start")


def unnest_top_page_ids(spark, sf_dir):
    return documents.unnest_top_page_ids(
        documents.interval_docs(nested_days(spark, sf_dir, 1, daily_parts)))


def _popular(spark, sf_dir):
    daily = daily_above(daily_parts(spark, sf_dir))
    popular = series.popular_page_ids(*tops(daily, 1).values())
    return popular, series.popular_daily_views(daily, popular)


def popular_page_ids(spark, sf_dir):
    return _popular(spark, sf_dir)[0]


def popular_daily_views(spark, sf_dir):
    return plain(_popular(spark, sf_dir)[1])


def popular_daily_views_bucketed(spark, sf_dir):
    """The same over stored facts in buckets of pages, tested at the scan."""
    daily = daily_above(daily_parts(spark, sf_dir))
    path = scratch_path(spark, "facts_by_page")
    table = "facts_by_page_" + uuid.uuid4().hex
    sinks.write_bucketed_facts(daily, table, path, 8)
    held = scratch_path(spark, "popular")
    series.popular_page_ids(*tops(daily, 1).values()).write.parquet(held)
    return plain(series.popular_daily_views(
        spark.table(table), spark.read.parquet(held), prefilter=True))


def page_series(spark, sf_dir):
    nested = series.page_series(_popular(spark, sf_dir)[1])
    return plain(nested.select("page_id", F.posexplode("daily_views").alias("pos", "point"))
                 .select("page_id", "pos", "point.*"))


def page_series_docs(spark, sf_dir):
    return series.page_series_docs(series.page_series(_popular(spark, sf_dir)[1]))


QUERIES = {
    "nest_top_pages": nest_top_pages,
    "interval_docs": interval_docs,
    "unnest_top_page_ids": unnest_top_page_ids,
    "popular_page_ids": popular_page_ids,
    "popular_daily_views": popular_daily_views,
    "popular_daily_views_bucketed": popular_daily_views_bucketed,
    "page_series": page_series,
    "page_series_docs": page_series_docs,
}

_POPULAR_SQL = f"""{PARTS_SQL},
popular AS (
  SELECT page_title FROM {top_sql("w", "day", 1)}
  UNION SELECT page_title FROM {top_sql("w", "month", 1)}
  UNION SELECT page_title FROM {top_sql("w", "year", 1)}),
popular_days AS (SELECT * FROM w_day WHERE page_title IN (SELECT page_title FROM popular))"""

SQL = {
    "nest_top_pages": f"""WITH {LINEITEM_SQL} SELECT "interval",
        CAST("rank" - 1 AS INTEGER) AS pos, "rank", page_id,
        'https://en.wikipedia.org/wiki/' || page_title AS url,
        replace(page_title, '_', ' ') AS topic, views FROM {top_sql("l", "day", TOP)}""",
    "interval_docs": f"""WITH {LINEITEM_SQL}
        SELECT doc_id, doc FROM {docs_sql(top_sql("l", "day", TOP))}""",
    "unnest_top_page_ids": f"""WITH {PARTS_SQL}
        SELECT DISTINCT page_id FROM {top_sql("w", "day", 1)}""",
    "popular_page_ids": f"""WITH {_POPULAR_SQL}
        SELECT 'en' AS domain_code, page_title FROM popular""",
    "popular_daily_views": f"""WITH {_POPULAR_SQL} SELECT CAST(day AS VARCHAR) AS day,
        domain_code, page_title, views FROM popular_days""",
    "page_series": f"""WITH {_POPULAR_SQL} SELECT 'en ' || page_title AS page_id,
        CAST(row_number() OVER (PARTITION BY page_title ORDER BY day) - 1 AS INTEGER) AS pos,
        CAST(day AS VARCHAR) AS day, views FROM popular_days""",
    "page_series_docs": f"""WITH {_POPULAR_SQL} SELECT 'en ' || page_title AS doc_id,
        to_json(struct_pack("pageId" := 'en ' || page_title, "dailyViews" := list(
          struct_pack(day := strftime(day, '%Y%m%d'), views := CAST(views AS VARCHAR))
          ORDER BY day)))::VARCHAR AS doc
        FROM popular_days GROUP BY page_title""",
}
SQL["popular_daily_views_bucketed"] = SQL["popular_daily_views"]
