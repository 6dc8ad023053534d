"""Scans, parsing, data quality and master records, over raw event lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import RAW_SQL, plain, raw_events, write_hourly_text
from viewtide import sources
from viewtide.functions import fields
from viewtide.operators import quality, rollup

# Eight hours of the fixture in pairs: same day, next day, other week, month end.
SAMPLE = tuple(f"pageviews-202401{day}-{hour}0000.gz"
               for day in ("01", "02", "15", "29") for hour in ("11", "14"))
PER_FILE = 3
FILES_PER_MONTH = 100


def scan_hourly_text(spark, sf_dir):
    path = write_hourly_text(raw_events(spark, sf_dir))
    return sources.scan_lines(spark, path)


def file_day(spark, sf_dir):
    return plain(raw_events(spark, sf_dir).select(
        "seq", "file_name", fields.file_day(F.col("file_name")).alias("day")))


def file_hour(spark, sf_dir):
    return plain(raw_events(spark, sf_dir).select(
        "seq", "file_name", fields.file_hour(F.col("file_name")).alias("hour_ts")))


def limit_per_file(spark, sf_dir):
    records = quality.master_records(raw_events(spark, sf_dir))
    return sources.limit_per_file(records, PER_FILE, order=["seq"]).drop("hourly_timestamp")


def files_limit(spark, sf_dir):
    return sources.files_limit(raw_events(spark, sf_dir), FILES_PER_MONTH)


def files_limit_lines(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return sources.keep_files(raw, sources.files_limit(raw, FILES_PER_MONTH))


def sample_files(spark, sf_dir):
    return sources.sample_files(raw_events(spark, sf_dir), SAMPLE)


def _lines(operator):
    return lambda spark, sf_dir: operator(raw_events(spark, sf_dir))


def json_escape(spark, sf_dir):
    titles = quality.clean_lines(raw_events(spark, sf_dir))
    return titles.select("seq", fields.json_escape(F.col("page_title")).alias("escaped"))


def payload_hex(spark, sf_dir):
    return raw_events(spark, sf_dir).select(
        "seq", fields.payload_hex(F.col("value")).alias("payload"))


def _flat(records):
    return records.select("*", "hourly_timestamp.*").drop("hourly_timestamp")


def daily_views(spark, sf_dir):
    return plain(rollup.daily_views(quality.clean_lines(raw_events(spark, sf_dir))))


def daily_views_min_raw(spark, sf_dir):
    return plain(rollup.above(rollup.daily_views(
        quality.clean_lines(raw_events(spark, sf_dir)))))


QUERIES = {
    "scan_hourly_text": scan_hourly_text,
    "file_day": file_day,
    "file_hour": file_hour,
    "limit_per_file": limit_per_file,
    "files_limit": files_limit,
    "files_limit_lines": files_limit_lines,
    "sample_files": sample_files,
    "parse_line": _lines(quality.parse_line),
    "filter_domain": _lines(quality.filter_domain),
    "reject_hyphen_title": _lines(quality.reject_hyphen_title),
    "reject_tab": _lines(quality.reject_tab),
    "reject_field_count": _lines(quality.reject_field_count),
    "reject_noninteger": _lines(quality.reject_noninteger),
    "clean_lines": lambda spark, sf_dir: plain(quality.clean_lines(raw_events(spark, sf_dir))),
    "reject_report": _lines(quality.reject_report),
    "reject_counts": _lines(quality.reject_counts),
    "reject_rows": _lines(quality.reject_rows),
    "master_records": lambda spark, sf_dir: _flat(
        quality.master_records(raw_events(spark, sf_dir))),
    "master_reject_counts": _lines(quality.master_reject_counts),
    "stamp_lines": _lines(quality.stamp_lines),
    "load_profile": _lines(quality.load_profile),
    "json_escape": json_escape,
    "payload_hex": payload_hex,
    "daily_views": daily_views,
    "daily_views_min_raw": daily_views_min_raw,
    "daily_views_all": daily_views,
}


def _sql(query):
    return f"WITH {RAW_SQL} {query}"


def _kept_sql(condition):
    return _sql(f"SELECT file_name, seq, value FROM raw WHERE {condition}")


# Records the typed loader accepts, with their fields.
MASTER_SQL = """(SELECT seq, file_name, ts, dom AS domain_code, title AS page_title,
    CAST(CASE WHEN defect = 5 THEN -cnt ELSE cnt END AS BIGINT) AS count_views,
    CAST(0 AS BIGINT) AS total_response_size
  FROM raw WHERE defect NOT IN (3, 4, 8, 9))"""
_DAILY_SQL = """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, dom AS domain_code,
    title AS page_title, CAST(sum(cnt) AS BIGINT) AS views FROM clean GROUP BY ALL"""
_FILES_SQL = f"""(SELECT file_name FROM (SELECT DISTINCT file_name FROM raw)
  QUALIFY row_number() OVER (PARTITION BY substr(file_name, 11, 6) ORDER BY file_name)
    <= {FILES_PER_MONTH})"""
_SAMPLE_SQL = ", ".join(f"'{name}'" for name in SAMPLE)

SQL = {
    "scan_hourly_text": _sql("SELECT file_name, value FROM raw"),
    "file_day": _sql("SELECT seq, file_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM raw"),
    "file_hour": _sql("""SELECT seq, file_name,
        CAST(date_trunc('hour', ts) AS VARCHAR) AS hour_ts FROM raw"""),
    "limit_per_file": _sql(f"""SELECT file_name, seq, domain_code, page_title, count_views,
        total_response_size FROM {MASTER_SQL}
        QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY seq) <= {PER_FILE}"""),
    "files_limit": _sql(f"SELECT file_name FROM {_FILES_SQL}"),
    "files_limit_lines": _kept_sql(f"file_name IN {_FILES_SQL}"),
    "sample_files": _kept_sql(f"file_name IN ({_SAMPLE_SQL})"),
    "parse_line": _sql("""SELECT file_name, seq, dom AS domain_code, title AS page_title,
        CASE defect WHEN 4 THEN 'x' || cnt WHEN 5 THEN '-' || cnt WHEN 8 THEN '' || user_id
          WHEN 9 THEN '99999999999999999999' ELSE '' || cnt END AS count_views,
        CASE defect WHEN 3 THEN NULL WHEN 8 THEN '' || cnt ELSE '0' END AS total_response_size,
        CAST(CASE defect WHEN 3 THEN 3 WHEN 8 THEN 5 ELSE 4 END AS INTEGER) AS field_count
        FROM raw"""),
    "filter_domain": _kept_sql("dom = 'en'"),
    "reject_hyphen_title": _kept_sql("NOT (dom = 'en' AND defect = 1)"),
    "reject_tab": _kept_sql("defect <> 2"),
    "reject_field_count": _kept_sql("defect NOT IN (3, 8)"),
    "reject_noninteger": _kept_sql("defect NOT IN (4, 5)"),
    "clean_lines": _sql("""SELECT file_name, seq, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
        CAST(date_trunc('hour', ts) AS VARCHAR) AS hour_ts, dom AS domain_code,
        title AS page_title, cnt AS views FROM clean"""),
    "reject_report": _sql("""SELECT counter, count(*) FILTER (hit) AS lines FROM (
          SELECT 'GOOD' AS counter, outcome = 'kept' AS hit FROM raw
          UNION ALL SELECT 'BAD', outcome <> 'kept' FROM raw
          UNION ALL SELECT 'CONTAINS_TABS', outcome = 'has_tab' FROM raw
          UNION ALL SELECT 'CONTAINS_QUOTES', outcome = 'kept' AND defect = 7 FROM raw
          UNION ALL SELECT 'NONINTEGER_COUNT_OF_VIEWS', outcome = 'noninteger_views' FROM raw)
        GROUP BY counter"""),
    "reject_counts": _sql("SELECT outcome, count(*) AS lines FROM raw GROUP BY outcome"),
    "reject_rows": _sql("""SELECT file_name, seq, value, outcome AS reject_reason FROM raw
        WHERE outcome NOT IN ('kept', 'domain', 'hyphen_title')"""),
    "master_records": _sql(f"""SELECT file_name, seq, domain_code, page_title, count_views,
        total_response_size, CAST(year(ts) AS INTEGER) AS "year",
        CAST(month(ts) AS INTEGER) AS "month", CAST(day(ts) AS INTEGER) AS "day",
        CAST(hour(ts) AS INTEGER) AS "hour" FROM {MASTER_SQL}"""),
    "master_reject_counts": _sql("""SELECT CASE WHEN defect IN (3, 8) THEN 'field_count'
          WHEN defect = 4 THEN 'noninteger_views' WHEN defect = 9 THEN 'views_out_of_range'
          ELSE 'stored' END AS outcome, count(*) AS lines FROM raw GROUP BY ALL"""),
    "stamp_lines": _sql("""SELECT file_name, seq, strftime(ts, '%Y%m%d%H') || value AS value
        FROM raw WHERE defect NOT IN (3, 8)"""),
    "load_profile": _sql("""SELECT count(DISTINCT file_name) AS files, count(*) AS records,
        count(*) FILTER (defect IN (3, 8)) AS bad_records,
        CAST(max(length(dom)) FILTER (defect NOT IN (3, 8)) AS INTEGER) AS max_domain_length,
        (SELECT min(dom) FROM raw WHERE defect NOT IN (3, 8) AND length(dom) =
          (SELECT max(length(dom)) FROM raw WHERE defect NOT IN (3, 8))) AS max_domain_example
        FROM raw"""),
    "json_escape": _sql("""SELECT seq, replace(title, '"', '\\"') AS escaped FROM clean"""),
    "payload_hex": _sql("SELECT seq, lower(hex(encode(value))) AS payload FROM raw"),
    "daily_views": _sql(_DAILY_SQL),
    "daily_views_min_raw": _sql(f"{_DAILY_SQL} HAVING sum(cnt) > 100"),
    "daily_views_all": _sql(_DAILY_SQL),
}
