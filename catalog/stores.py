"""Sinks, stored tables and load results: written, read back and returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.documents import nested_days
from catalog.facts import TOP, tops
from catalog.fixtures import (
    LINEITEM_SQL,
    RAW_SQL,
    daily_above,
    daily_lineitem,
    docs_sql,
    plain,
    raw_events,
    top_sql,
)
from catalog.raw import MASTER_SQL
from viewtide import sinks, sources
from viewtide.operators import documents, quality, ranking, rollup
from viewtide.params import GRAINS
from viewtide.storage import scratch_path

SCOPE = (1996, 3, 6)
MASTER_LIMIT = 1000
YEAR = 1996
LOOKUPS = (("day", "19960703"), ("month", "199607"), ("year", "1996"))
FEW = 3


def load_scope(spark, sf_dir):
    path = scratch_path(spark, "facts")
    sinks.write_facts(rollup.daily_views(daily_lineitem(spark, sf_dir)), path)
    return plain(sources.load_scope(spark.read.parquet(path), *SCOPE))


def _stage(spark, sf_dir):
    path = scratch_path(spark, "stage")
    sinks.write_stage_kv(rollup.daily_views(daily_lineitem(spark, sf_dir)), path, "day")
    return path


def read_stage_kv(spark, sf_dir):
    return sources.read_stage_kv(spark, _stage(spark, sf_dir), "day")


def write_stage_kv(spark, sf_dir):
    return spark.read.text(_stage(spark, sf_dir))


def _day_docs(spark, sf_dir, n=TOP):
    return documents.interval_docs(nested_days(spark, sf_dir, n))


def _day_lines(spark, sf_dir, n=TOP):
    return sinks.doc_lines(_day_docs(spark, sf_dir, n), "day")


def _write_docs(spark, sf_dir):
    path = scratch_path(spark, "docs")
    sinks.write_doc_lines(_day_lines(spark, sf_dir), path)
    return path


def read_doc_lines(spark, sf_dir):
    lines = sources.read_doc_lines(spark, _write_docs(spark, sf_dir))
    return lines.select("doc_id", "doc")


def write_doc_lines(spark, sf_dir):
    return spark.read.text(_write_docs(spark, sf_dir))


def overwrite_year(spark, sf_dir):
    """One year written again with shorter lists; the other years stay."""
    path = scratch_path(spark, "docs_by_year")
    for n, year in ((TOP, None), (FEW, YEAR)):
        docs = _day_docs(spark, sf_dir, n).withColumn("year", F.year("interval_start"))
        chosen = docs if year is None else docs.filter(F.col("year") == year)
        sinks.overwrite_year(chosen.drop("interval_start"), path)
    return sinks.read_years(spark, path, "doc_id STRING, doc STRING")


def export_compressed(spark, sf_dir):
    path = scratch_path(spark, "export")
    sinks.export_compressed(_day_lines(spark, sf_dir), path)
    return spark.read.text(path)


def _master(spark, sf_dir):
    path = scratch_path(spark, "master")
    sinks.write_master(quality.master_records(raw_events(spark, sf_dir)), path)
    return path


def write_master(spark, sf_dir):
    stored = spark.read.parquet(_master(spark, sf_dir)).drop("year", "month")
    return stored.select("*", "hourly_timestamp.*").drop("hourly_timestamp")


def read_master(spark, sf_dir):
    records = sources.read_master(spark, _master(spark, sf_dir), MASTER_LIMIT)
    return records.select("hourly_timestamp.day", "hourly_timestamp.hour", "domain_code",
                          "page_title", "count_views", "total_response_size")


def roundtrip_audit(spark, sf_dir):
    """The stored records with every hundredth count altered, against the source."""
    source = quality.master_records(raw_events(spark, sf_dir))
    stored = spark.read.parquet(_master(spark, sf_dir))
    altered = stored.withColumn("count_views", F.when(
        F.col("seq") % 100 == 0, F.col("count_views") + 1).otherwise(F.col("count_views")))
    return quality.roundtrip_audit(source, altered, ["file_name", "seq"])


def roundtrip_summary(spark, sf_dir):
    """What the real write and read damaged: nothing is expected."""
    source = quality.master_records(raw_events(spark, sf_dir))
    stored = spark.read.parquet(_master(spark, sf_dir))
    return quality.roundtrip_summary(source, stored, ["file_name", "seq"])


def write_stamped_lines(spark, sf_dir):
    path = scratch_path(spark, "stamped")
    sinks.write_stamped_lines(quality.stamp_lines(raw_events(spark, sf_dir)), path)
    return spark.read.text(path)


def top_pages_for(spark, sf_dir):
    path = scratch_path(spark, "top_pages")
    daily = daily_above(daily_lineitem(spark, sf_dir))
    sinks.write_top_pages(ranking.tagged_lists(tops(daily, TOP)), path)
    first, *rest = [sources.read_top_list(spark, path, *lookup).drop("interval_start")
                    for lookup in LOOKUPS]
    for found in rest:
        first = first.unionByName(found)
    return first


def seeded_lines(spark, sf_dir):
    """Two batches of document lines on disk. January 1998 differs in the second
    batch; the first also has broken escapes (copies of February), unquoted keys
    (March) and blank lines (April)."""
    path = scratch_path(spark, "seeded")
    docs = _day_docs(spark, sf_dir).select("doc_id", "doc")
    month = F.substring("doc_id", 1, 6)
    empty = F.concat(F.lit('{"interval":"'), "doc_id", F.lit('","topPages":[]}'))
    first = docs.withColumn("batch", F.lit(1))
    second = docs.withColumns({
        "batch": F.lit(2), "doc": F.when(month == "199801", empty).otherwise(F.col("doc"))})
    broken = F.when(month == "199802", F.replace("doc", F.lit('"interval":"'),
                                                 F.lit('"interval":"\\q'))).when(
        month == "199803", F.replace("doc", F.lit('"interval"'), F.lit("interval")))
    bad = first.withColumn("doc", broken).filter("doc IS NOT NULL")
    line = F.concat(F.lit("("), "doc_id", F.lit(","), "doc", F.lit(")")).alias("value")
    blank = first.filter(month == "199804").select("batch", F.lit("").alias("value"))
    lines = first.unionByName(second).unionByName(bad).select("batch", line).unionByName(blank)
    lines.write.partitionBy("batch").text(path)
    found = sources.read_doc_lines(spark, path)
    return found.withColumn(
        "batch", F.regexp_extract("file_path", "batch=([0-9]+)", 1).cast("int"))


def valid_json_docs(spark, sf_dir):
    return documents.valid_json_docs(seeded_lines(spark, sf_dir)).select("batch", "doc_id", "doc")


def invalid_json_docs(spark, sf_dir):
    return documents.invalid_json_docs(seeded_lines(spark, sf_dir)).select(
        "batch", "doc_id", "doc")


def upsert_docs(spark, sf_dir):
    """The first batch published, then the second over it."""
    path = scratch_path(spark, "serving")
    valid = documents.valid_json_docs(seeded_lines(spark, sf_dir))
    for batch in (1, 2):
        sinks.publish_docs(valid.filter(F.col("batch") == batch), path)
    return sinks.read_serving(spark, path).drop("grain")


def _all_grain_lines(spark, sf_dir):
    """Document lines of all four grains on disk; weeks and their Sundays share ids."""
    path = scratch_path(spark, "all_grains")
    daily = daily_above(daily_lineitem(spark, sf_dir))
    for grain, ranked in tops(daily, TOP, GRAINS).items():
        docs = documents.interval_docs(documents.nest_top_pages(ranked))
        sinks.write_doc_lines(sinks.doc_lines(docs, grain), path)
    return sources.read_doc_lines(spark, path)


def upsert_docs_all_grains(spark, sf_dir):
    """Days, weeks, months and years in one serving table."""
    path = scratch_path(spark, "serving")
    sinks.publish_docs(documents.valid_json_docs(_all_grain_lines(spark, sf_dir)), path)
    return sinks.read_serving(spark, path)


def load_report_all_grains(spark, sf_dir):
    """The report per grain against a table that holds the days."""
    lines = _all_grain_lines(spark, sf_dir)
    days = documents.valid_json_docs(lines).filter("grain = 'day'")
    return sinks.load_report(lines, days, by=["grain"])


def upsert_docs_at_once(spark, sf_dir):
    """Both batches in one load: the later path wins."""
    return sinks.upsert_docs(
        None, documents.valid_json_docs(seeded_lines(spark, sf_dir))).drop("grain")


def load_report(spark, sf_dir):
    """Both batches against a table that already holds one year."""
    known = _day_docs(spark, sf_dir).filter(F.year("interval_start") == YEAR)
    return sinks.load_report(seeded_lines(spark, sf_dir), known, by=["batch"])


QUERIES = {
    "load_scope": load_scope,
    "read_stage_kv": read_stage_kv,
    "write_stage_kv": write_stage_kv,
    "read_doc_lines": read_doc_lines,
    "write_doc_lines": write_doc_lines,
    "overwrite_year": overwrite_year,
    "export_compressed": export_compressed,
    "write_master": write_master,
    "read_master": read_master,
    "roundtrip_audit": roundtrip_audit,
    "roundtrip_summary": roundtrip_summary,
    "write_stamped_lines": write_stamped_lines,
    "top_pages_for": top_pages_for,
    "valid_json_docs": valid_json_docs,
    "invalid_json_docs": invalid_json_docs,
    "upsert_docs": upsert_docs,
    "upsert_docs_at_once": upsert_docs_at_once,
    "upsert_docs_all_grains": upsert_docs_all_grains,
    "load_report": load_report,
    "load_report_all_grains": load_report_all_grains,
}

_DOCS = docs_sql(top_sql("l", "day", TOP))
_LINES_SQL = f"""WITH {LINEITEM_SQL} SELECT '(' || doc_id || ',' || doc || ')' AS value,
    CAST('day' AS VARCHAR) AS grain, CAST(substr(doc_id, 1, 4) AS INTEGER) AS "year" FROM {_DOCS}"""
_SEEDED_SQL = f"""WITH {LINEITEM_SQL},
docs AS (SELECT doc_id, doc, substr(doc_id, 1, 6) AS ym FROM {_DOCS}),
good AS (
  SELECT CAST(1 AS INTEGER) AS batch, doc_id, doc FROM docs
  UNION ALL SELECT 2, doc_id, CASE WHEN ym = '199801'
    THEN '{{"interval":"' || doc_id || '","topPages":[]}}' ELSE doc END FROM docs),
bad AS (
  SELECT CAST(1 AS INTEGER) AS batch, doc_id,
    replace(doc, '"interval":"', '"interval":"\\q') AS doc FROM docs WHERE ym = '199802'
  UNION ALL SELECT 1, doc_id, replace(doc, '"interval"', 'interval')
    FROM docs WHERE ym = '199803')"""
_UPSERTED_SQL = f"{_SEEDED_SQL} SELECT doc_id, doc FROM good WHERE batch = 2"
_ALL_GRAINS_SQL = " UNION ALL ".join(
    f"SELECT '{grain}' AS grain, doc_id, doc FROM {docs_sql(top_sql('l', grain, TOP))}"
    for grain in GRAINS)
_LOOKUP_SQL = " UNION ALL ".join(
    f"""SELECT '{grain}' AS grain, "interval", "rank", domain_code, page_title, page_id, views
        FROM {top_sql("l", grain, TOP)} WHERE "interval" = '{interval}'"""
    for grain, interval in LOOKUPS)

SQL = {
    "load_scope": f"""WITH {LINEITEM_SQL} SELECT CAST(day AS VARCHAR) AS day, domain_code,
        page_title, views, CAST(year(day) AS INTEGER) AS "year",
        CAST(month(day) AS INTEGER) AS "month" FROM l_sums
        WHERE year(day) = {SCOPE[0]} AND month(day) BETWEEN {SCOPE[1]} AND {SCOPE[2]}""",
    "read_stage_kv": f"""WITH {LINEITEM_SQL} SELECT strftime(day, '%Y%m%d') AS "interval",
        domain_code, page_title, views FROM l_sums""",
    "write_stage_kv": f"""WITH {LINEITEM_SQL} SELECT strftime(day, '%Y%m%d') || 'en ' ||
        page_title || chr(9) || views AS value FROM l_sums""",
    "read_doc_lines": f"WITH {LINEITEM_SQL} SELECT doc_id, doc FROM {_DOCS}",
    "write_doc_lines": _LINES_SQL,
    "overwrite_year": f"""WITH {LINEITEM_SQL}
        SELECT doc_id, doc FROM {_DOCS} WHERE doc_id NOT LIKE '{YEAR}%' UNION ALL
        SELECT doc_id, doc FROM {docs_sql(top_sql("l", "day", FEW))}
        WHERE doc_id LIKE '{YEAR}%'""",
    "export_compressed": f"""WITH {LINEITEM_SQL}
        SELECT '(' || doc_id || ',' || doc || ')' AS value FROM {_DOCS}""",
    "write_master": f"""WITH {RAW_SQL} SELECT file_name, seq, domain_code, page_title,
        count_views, total_response_size, CAST(year(ts) AS INTEGER) AS "year",
        CAST(month(ts) AS INTEGER) AS "month", CAST(day(ts) AS INTEGER) AS "day",
        CAST(hour(ts) AS INTEGER) AS "hour" FROM {MASTER_SQL}""",
    "read_master": f"""WITH {RAW_SQL} SELECT CAST(day(ts) AS INTEGER) AS "day",
        CAST(hour(ts) AS INTEGER) AS "hour", domain_code, page_title, count_views,
        total_response_size FROM {MASTER_SQL}
        ORDER BY date_trunc('hour', ts), domain_code, page_title, count_views
        LIMIT {MASTER_LIMIT}""",
    "roundtrip_audit": f"""WITH {RAW_SQL} SELECT file_name, seq, 'both' AS presence,
        false AS domain_code_changed, false AS page_title_changed, true AS count_views_changed,
        false AS total_response_size_changed FROM {MASTER_SQL} WHERE seq % 100 = 0""",
    "roundtrip_summary": f"""WITH {RAW_SQL}
        SELECT count(*) AS compared, CAST(0 AS BIGINT) AS damaged FROM {MASTER_SQL}""",
    "write_stamped_lines": f"""WITH {RAW_SQL} SELECT strftime(ts, '%Y%m%d%H') || value AS value
        FROM raw WHERE defect NOT IN (3, 8)""",
    "top_pages_for": f"WITH {LINEITEM_SQL} {_LOOKUP_SQL}",
    "valid_json_docs": f"{_SEEDED_SQL} SELECT batch, doc_id, doc FROM good",
    "invalid_json_docs": f"{_SEEDED_SQL} SELECT batch, doc_id, doc FROM bad",
    "upsert_docs": _UPSERTED_SQL,
    "upsert_docs_at_once": _UPSERTED_SQL,
    "upsert_docs_all_grains": f"WITH {LINEITEM_SQL} {_ALL_GRAINS_SQL}",
    "load_report_all_grains": f"""WITH {LINEITEM_SQL} SELECT grain, count(*) AS lines,
        CAST(0 AS BIGINT) AS blank, CAST(0 AS BIGINT) AS invalid, count(*) AS loaded,
        count(*) FILTER (grain <> 'day') AS created, count(*) FILTER (grain = 'day') AS updated
        FROM ({_ALL_GRAINS_SQL}) GROUP BY grain""",
    "load_report": f"""{_SEEDED_SQL},
        blanks AS (SELECT 1 AS batch, count(*) AS n FROM docs WHERE ym = '199804'),
        bads AS (SELECT 1 AS batch, count(*) AS n FROM bad),
        goods AS (SELECT batch, count(*) AS n,
          count(*) FILTER (batch = 1 AND doc_id NOT LIKE '{YEAR}%') AS created
          FROM good GROUP BY batch)
        SELECT batch, CAST(g.n + coalesce(b.n, 0) + coalesce(x.n, 0) AS BIGINT) AS lines,
          CAST(coalesce(b.n, 0) AS BIGINT) AS blank, CAST(coalesce(x.n, 0) AS BIGINT) AS invalid,
          g.n AS loaded, g.created AS created, g.n - g.created AS updated
        FROM goods g LEFT JOIN blanks b USING (batch) LEFT JOIN bads x USING (batch)""",
}
