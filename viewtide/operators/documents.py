"""Nested rows and the JSON documents built from ranked pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions import fields
from viewtide.params import URL_PREFIX

_TOP_PAGE_SCHEMA = ("interval STRING, topPages ARRAY<STRUCT<rank: STRING, pageId: STRING, "
                    "url: STRING, topic: STRING, views: STRING>>")


def nest_top_pages(ranked: DataFrame, url_prefix: str = URL_PREFIX) -> DataFrame:
    """One row per interval with its pages as an array in rank order.

    The array is bounded by the list limit. Grouping includes
    ``interval_start``, by which ranked rows are already partitioned, so this
    adds no exchange.
    """
    title = F.col("page_title")
    page = F.struct("rank", "page_id", fields.page_url(title, url_prefix).alias("url"),
                    fields.page_topic(title).alias("topic"), "views")
    return (ranked.groupBy("interval_start", "interval")
            .agg(F.sort_array(F.collect_list(page)).alias("top_pages")))


def interval_docs(nested: DataFrame) -> DataFrame:
    """JSON document per interval, all leaves as strings: ``doc_id, doc``."""
    def leaf(page):
        return F.struct(
            page["rank"].cast("string").alias("rank"), page["page_id"].alias("pageId"),
            page["url"].alias("url"), page["topic"].alias("topic"),
            page["views"].cast("string").alias("views"))
    body = F.struct("interval", F.transform("top_pages", leaf).alias("topPages"))
    return nested.select("interval_start", F.col("interval").alias("doc_id"),
                         F.to_json(body).alias("doc"))


def unnest_top_page_ids(docs: DataFrame) -> DataFrame:
    """Distinct page ids named in interval documents."""
    pages = F.explode(F.from_json("doc", _TOP_PAGE_SCHEMA)["topPages"])
    return docs.select(pages.alias("page")).select(
        F.col("page.pageId").alias("page_id")).distinct()


def with_validity(docs: DataFrame) -> DataFrame:
    """Adds ``valid``: whether the document parses as JSON. Judged lines stay as they are."""
    if "valid" in docs.columns:
        return docs
    return docs.withColumn("valid", F.expr("try_parse_json(doc) IS NOT NULL"))


def valid_json_docs(lines: DataFrame) -> DataFrame:
    """Non-blank document lines whose document parses."""
    return with_validity(lines.filter("value <> ''")).filter("valid").drop("valid")


def invalid_json_docs(lines: DataFrame) -> DataFrame:
    """Non-blank document lines whose document does not parse, with their place."""
    return with_validity(lines.filter("value <> ''")).filter("NOT valid").drop("valid")
