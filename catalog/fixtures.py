"""Page-view inputs derived from the driver's tables, in Spark and in SQL.

``raw_events``: one raw line per event, its defect chosen by the event id.
``daily_lineitem``: page-day observations, pages named by part name.
``daily_parts``: the same with one page per part.
``listing``: the listing pages a file server would show for the raw files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.functions.fields import file_month
from viewtide.operators import rollup
from viewtide.storage import scratch_path

ROOT_URL = "https://dumps.example.org/pageviews/"
DIRECTORY = r"20\d\d.*/"
DATA_FILE = r"pageviews-20.*\.gz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_name, seq, value``."""
    user = F.concat(F.lit(" User_"), "user_id", F.lit(" "))
    count = F.floor(F.col("value") * 10).cast("string")
    domain = (F.when(F.col("event_type") == "signup", "de")
              .when(F.col("event_type") == "error", "en.m").otherwise("en"))
    bodies = {
        1: (F.lit(" - "), count, F.lit(" 0")),
        2: (F.lit(" User\t"), "user_id", F.lit(" "), count, F.lit(" 0")),
        3: (user, count),
        4: (user, F.lit("x"), count, F.lit(" 0")),
        5: (user, F.lit("-"), count, F.lit(" 0")),
        6: (user, count, F.lit(" 0 ")),
        7: (F.lit(' User_"'), "user_id", F.lit('" '), count, F.lit(" 0")),
        8: (F.lit(" User "), "user_id", F.lit(" "), count, F.lit(" 0")),
        9: (user, F.lit("99999999999999999999 0")),
    }
    line = F.concat(domain, user, count, F.lit(" 0"))
    for defect, body in bodies.items():
        line = F.when(F.col("event_id") % 50 == defect, F.concat(domain, *body)).otherwise(line)
    name = F.concat(F.lit("pageviews-"), F.date_format("ts", "yyyyMMdd-HH"), F.lit("0000.gz"))
    # A one-element generator, so that filters do not copy the long expression.
    return table(spark, sf_dir, "events").select(
        name.alias("file_name"), F.col("event_id").alias("seq"),
        F.explode(F.array(line)).alias("value"))


def write_hourly_text(raw: DataFrame) -> str:
    """Raw lines as gzip text, one folder per hourly file, lines in ``seq`` order.

    A range partitioning on file and line keeps the order and splits a file
    that holds far more lines than the others. The number of ranges is given so
    that small input is not merged into one writing task.
    """
    spark = raw.sparkSession
    path = scratch_path(spark, "hourly")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (raw.repartitionByRange(ranges, "file_name", "seq").sortWithinPartitions("file_name", "seq")
     .select("file_name", "value").write.partitionBy("file_name")
     .option("compression", "gzip").text(path))
    return path


def _line_facts(spark: SparkSession, sf_dir: str, title) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", title.alias("page_title"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_shipdate").cast("date").alias("day"), F.lit("en").alias("domain_code"),
        "page_title", (F.col("l_quantity").cast("bigint") * 4).alias("views"))


def daily_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``day, domain_code, page_title, views``, not yet summed."""
    return _line_facts(spark, sf_dir, F.replace("p_name", F.lit(" "), F.lit("_")))


def daily_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    return _line_facts(spark, sf_dir, F.concat_ws("_", name, "p_partkey"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, html``: root, year and month pages. A month page lists its files."""
    files = raw_events(spark, sf_dir).select("file_name").distinct()
    year = F.substring(file_month(F.col("file_name")), 1, 4)
    month = F.concat_ws("-", year, F.substring(file_month(F.col("file_name")), 5, 2))
    located = files.select("file_name", F.concat(year, F.lit("/")).alias("year"),
                           F.concat(month, F.lit("/")).alias("month"))
    months = located.select("year", "month").distinct()
    years = months.select("year").distinct()
    return (
        _pages(located, ("year", "month"), "file_name",
               '<a href="../">../</a>', '<a href="readme.html">readme.html</a>')
        .unionByName(_pages(months, ("year",), "month", "", ""))
        .unionByName(_pages(years, (), "year", "", "")))


def _pages(items: DataFrame, parents: tuple[str, ...], item: str,
           before: str, after: str) -> DataFrame:
    anchor = F.concat(F.lit('<a href="'), item, F.lit('">'), item, F.lit("</a>"))
    anchors = F.array_join(F.array_sort(F.collect_list(anchor)), "\n")
    return items.groupBy(*parents).agg(anchors.alias("anchors")).select(
        F.concat(F.lit(ROOT_URL), *parents).alias("url"),
        F.concat(F.lit(f"<html><body>{before}"), "anchors",
                 F.lit(f"{after}</body></html>")).alias("html"))


def daily_above(facts: DataFrame) -> DataFrame:
    """Summed daily facts above the default threshold."""
    return rollup.above(rollup.daily_views(facts))


def plain(result: DataFrame) -> DataFrame:
    """Dates and times as text, so both engines print them alike."""
    return result.select(*[
        F.col(field.name).cast("string").alias(field.name)
        if field.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
        else F.col(field.name) for field in result.schema.fields])


# SQL counterparts. The expected outcome of a line follows from the event
# columns alone; no rule of the operators is repeated here.
RAW_SQL = """
ev AS (
  SELECT event_id AS seq, event_id % 50 AS defect, ts, user_id,
         CAST(floor(value * 10) AS BIGINT) AS cnt,
         CASE event_type WHEN 'signup' THEN 'de' WHEN 'error' THEN 'en.m' ELSE 'en' END AS dom,
         'pageviews-' || strftime(ts, '%Y%m%d-%H') || '0000.gz' AS file_name
  FROM events),
raw AS (
  SELECT *, dom || CASE defect
    WHEN 1 THEN ' - ' || cnt || ' 0'
    WHEN 2 THEN ' User' || chr(9) || user_id || ' ' || cnt || ' 0'
    WHEN 3 THEN ' User_' || user_id || ' ' || cnt
    WHEN 4 THEN ' User_' || user_id || ' x' || cnt || ' 0'
    WHEN 5 THEN ' User_' || user_id || ' -' || cnt || ' 0'
    WHEN 6 THEN ' User_' || user_id || ' ' || cnt || ' 0 '
    WHEN 7 THEN ' User_"' || user_id || '" ' || cnt || ' 0'
    WHEN 8 THEN ' User ' || user_id || ' ' || cnt || ' 0'
    WHEN 9 THEN ' User_' || user_id || ' 99999999999999999999 0'
    ELSE ' User_' || user_id || ' ' || cnt || ' 0' END AS value,
    CASE defect WHEN 1 THEN '-' WHEN 2 THEN 'User' || chr(9) || user_id
      WHEN 7 THEN 'User_"' || user_id || '"' WHEN 8 THEN 'User'
      ELSE 'User_' || user_id END AS title,
    CASE WHEN dom <> 'en' THEN 'domain' WHEN defect = 1 THEN 'hyphen_title'
      WHEN defect = 2 THEN 'has_tab' WHEN defect IN (3, 8) THEN 'field_count'
      WHEN defect IN (4, 5) THEN 'noninteger_views'
      WHEN defect = 9 THEN 'views_out_of_range' ELSE 'kept' END AS outcome
  FROM ev),
clean AS (SELECT * FROM raw WHERE outcome = 'kept')"""


def _facts_sql(prefix: str, title: str) -> str:
    return f"""
{prefix}_rows AS (
  SELECT CAST(l_shipdate AS DATE) AS day, 'en' AS domain_code, {title} AS page_title,
         CAST(l_quantity AS BIGINT) * 4 AS views
  FROM lineitem JOIN part ON l_partkey = p_partkey),
{prefix}_sums AS (
  SELECT day, domain_code, page_title, CAST(sum(views) AS BIGINT) AS views
  FROM {prefix}_rows GROUP BY ALL),
{prefix}_day AS (SELECT * FROM {prefix}_sums WHERE views > 100),
{prefix}_week AS (
  SELECT CAST(day - CAST(dayofweek(day) AS INTEGER) AS DATE) AS start, domain_code, page_title,
         CAST(sum(views) AS BIGINT) AS views FROM {prefix}_day GROUP BY ALL),
{prefix}_month AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS start, domain_code, page_title,
         CAST(sum(views) AS BIGINT) AS views FROM {prefix}_day GROUP BY ALL),
{prefix}_year AS (
  SELECT CAST(date_trunc('year', day) AS DATE) AS start, domain_code, page_title,
         CAST(sum(views) AS BIGINT) AS views FROM {prefix}_day GROUP BY ALL)"""


LINEITEM_SQL = _facts_sql("l", "replace(p_name, ' ', '_')")
PARTS_SQL = _facts_sql("w", "replace(p_name, ' ', '_') || '_' || p_partkey")

FORMATS = {"day": "%Y%m%d", "week": "%Y%m%d", "month": "%Y%m", "year": "%Y"}


def top_sql(prefix: str, grain: str, n: int) -> str:
    """Ranked rows of one grain as a subquery."""
    start = "day" if grain == "day" else "start"
    return f"""(SELECT strftime({start}, '{FORMATS[grain]}') AS "interval",
      CAST(row_number() OVER (PARTITION BY {start} ORDER BY views DESC, page_title) AS INTEGER)
        AS "rank", domain_code, page_title, domain_code || ' ' || page_title AS page_id, views,
      {start} AS interval_start
    FROM {prefix}_{grain} QUALIFY "rank" <= {n})"""


def docs_sql(ranked: str) -> str:
    """Interval documents of ranked rows as a subquery."""
    return f"""(SELECT "interval" AS doc_id, to_json(struct_pack("interval" := "interval",
        "topPages" := list(struct_pack("rank" := CAST("rank" AS VARCHAR), "pageId" := page_id,
          url := 'https://en.wikipedia.org/wiki/' || page_title,
          topic := replace(page_title, '_', ' '), views := CAST(views AS VARCHAR))
          ORDER BY "rank")))::VARCHAR AS doc
    FROM {ranked} GROUP BY "interval")"""
