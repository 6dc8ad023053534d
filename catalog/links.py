"""Link inventory, over the stored web pages and the listing of raw files."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import DATA_FILE, DIRECTORY, RAW_SQL, ROOT_URL, listing, table
from viewtide.operators import inventory


def extract_links(spark, sf_dir):
    return inventory.extract_links(table(spark, sf_dir, "pages"))


def classify_links(spark, sf_dir):
    hrefs = inventory.extract_links(listing(spark, sf_dir)).drop("pos")
    return inventory.classify_links(hrefs, DIRECTORY, DATA_FILE)


def list_data_files(spark, sf_dir):
    return inventory.list_data_files(listing(spark, sf_dir), ROOT_URL, DIRECTORY, DATA_FILE)


def file_base_name(spark, sf_dir):
    return inventory.with_file_name(list_data_files(spark, sf_dir))


def page_base_name(spark, sf_dir):
    return inventory.with_file_name(table(spark, sf_dir, "pages").select(F.col("url")))


QUERIES = {
    "extract_links": extract_links,
    "classify_links": classify_links,
    "list_data_files": list_data_files,
    "file_base_name": file_base_name,
    "page_base_name": page_base_name,
}

_LINKS_SQL = f"""{RAW_SQL},
files AS (SELECT DISTINCT file_name, strftime(ts, '%Y') || '/' AS y,
  strftime(ts, '%Y-%m') || '/' AS m FROM raw),
urls AS (SELECT '{ROOT_URL}' || y || m || file_name AS url, file_name FROM files)"""

SQL = {
    "extract_links": """SELECT page_id, url,
        CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos, unnest(hrefs) AS href
      FROM (SELECT page_id, url, regexp_extract_all(
        regexp_replace(html, '<!--.*?-->|<script.*?</script>', '', 'gs'),
        '<a [^>]*href="([^"]*)"', 1) AS hrefs FROM pages)""",
    "classify_links": f"""WITH {_LINKS_SQL}
      SELECT '{ROOT_URL}' || y || m AS url, file_name AS href, 'data_file' AS link_class FROM files
      UNION ALL SELECT DISTINCT '{ROOT_URL}' || y || m, '../', 'other' FROM files
      UNION ALL SELECT DISTINCT '{ROOT_URL}' || y || m, 'readme.html', 'other' FROM files
      UNION ALL SELECT DISTINCT '{ROOT_URL}' || y, m, 'directory' FROM files
      UNION ALL SELECT DISTINCT '{ROOT_URL}', y, 'directory' FROM files""",
    "list_data_files": f"WITH {_LINKS_SQL} SELECT url FROM urls",
    "file_base_name": f"WITH {_LINKS_SQL} SELECT url, file_name FROM urls",
    "page_base_name": "SELECT url, regexp_extract(url, '[^/]*$') AS file_name FROM pages",
}
