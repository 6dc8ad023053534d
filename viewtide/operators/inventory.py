"""Inventory of data files from stored listing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions import links
from viewtide.params import DATA_FILE_LINK, DIRECTORY_LINK
from viewtide.storage import scratch_path


def extract_links(pages: DataFrame) -> DataFrame:
    """One row per anchor with an ``href``: the other page columns, its place
    on the page from 0, and ``href``."""
    kept = [name for name in pages.columns if name != "html"]
    return pages.select(*kept, F.posexplode(links.anchor_hrefs(F.col("html"))).alias("pos", "href"))


def classify_links(hrefs: DataFrame, directory: str = DIRECTORY_LINK,
                   data_file: str = DATA_FILE_LINK) -> DataFrame:
    return hrefs.withColumn("link_class", links.link_class(F.col("href"), directory, data_file))


# Directory levels below the start page that a walk may reach.
LEVELS = 100


def list_data_files(pages: DataFrame, start_url: str, directory: str = DIRECTORY_LINK,
                    data_file: str = DATA_FILE_LINK, levels: int = LEVELS) -> DataFrame:
    """Distinct urls of data files reachable from ``start_url``.

    Links are relative and are appended to the url of their page. The HTML is searched
    once; pages keep their directory and file links as arrays (one row per page, so a
    page with very many links is not a hot join key), written to the shared folder.
    The walk is one recursive query over them. An empty link would lead back to its own
    page and is left out; urls grow with every level, so a walk over any set of pages
    ends. A walk of more than ``levels`` levels is an error, not a shorter result.
    """
    spark = pages.sparkSession
    hrefs = pages.select("url", links.anchor_hrefs(F.col("html")).alias("hrefs"))
    linked = hrefs.select(
        "url",
        F.array_distinct(F.filter("hrefs", lambda h: (h != "") & links.is_directory_link(
            h, directory))).alias("directories"),
        F.filter("hrefs", lambda h: links.is_data_file_link(h, data_file)).alias("files"),
    ).filter("size(directories) + size(files) > 0")
    path = scratch_path(spark, "links")
    linked.write.parquet(path)
    linked = spark.read.schema(linked.schema).parquet(path)
    # One row more than the levels: the walk must find nothing there.
    reached = spark.sql(
        f"""WITH RECURSIVE walk (url, level) MAX RECURSION LEVEL {levels + 2} AS (
              SELECT :start AS url, 0 AS level
              UNION ALL
              SELECT concat(page.url, page.href) AS url, page.level + 1 AS level
              FROM (SELECT walk.url, walk.level, explode(linked.directories) AS href
                    FROM walk JOIN {{linked}} AS linked ON walk.url = linked.url
                    WHERE walk.level <= {levels}) AS page)
            SELECT DISTINCT url, level FROM walk""", args={"start": start_url}, linked=linked)
    # A url of the level beyond the bound exists only if a directory was left unread.
    checked = reached.filter(F.when(F.col("level") <= levels, True).otherwise(F.raise_error(
        F.lit(f"more than {levels} directory levels below {start_url}")).cast("boolean")))
    found = linked.join(checked.select("url").distinct(), "url", "left_semi")
    href = F.explode("files").alias("href")
    return found.select("url", href).select(F.concat("url", "href").alias("url")).distinct()


def with_file_name(urls: DataFrame) -> DataFrame:
    """Adds ``file_name``, the last segment of the url."""
    return urls.withColumn("file_name", links.file_base_name(F.col("url")))
