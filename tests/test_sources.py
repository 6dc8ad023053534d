import gzip

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from viewtide import sources
from viewtide.operators import quality
from viewtide.sinks import write_facts, write_master, write_stage_kv


@pytest.fixture
def hours(tmp_path):
    """Three real gzip files in two month folders."""
    files = {"01/pageviews-20160101-000000.gz": 40, "01/pageviews-20160101-010000.gz": 30,
             "02/pageviews-20160201-000000.gz": 20}
    for name, count in files.items():
        path = tmp_path / "raw" / "2016" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [f"en P{i} {i} 0" if i % 4 else f"broken {i}" for i in range(count)]
        path.write_bytes(gzip.compress(("\n".join(lines) + "\n").encode()))
    return str(tmp_path / "raw")


def test_scan_keeps_the_file_name(spark, hours):
    lines = sources.scan_lines(spark, sources.scope_paths(hours, 2016))
    counts = {r.file_name: r["count"] for r in lines.groupBy("file_name").count().collect()}
    assert counts == {"pageviews-20160101-000000.gz": 40, "pageviews-20160101-010000.gz": 30,
                      "pageviews-20160201-000000.gz": 20}


def test_scope_paths(spark, hours):
    assert sources.scan_lines(spark, sources.scope_paths(hours, 2016, 2)).count() == 20
    assert sources.scan_lines(spark, sources.scope_paths(hours, 2016, 1, 2)).count() == 90


@pytest.mark.parametrize("n", [1, 7, 0])
def test_limit_counts_accepted_lines_only(spark, hours, n):
    raw = sources.scan_lines(spark, f"{hours}/2016/*", positions=True)
    kept = sources.limit_per_file(quality.master_records(raw), n)
    accepted = [i for i in range(40) if i % 4]
    views = kept.filter(F.col("file_name") == "pageviews-20160101-000000.gz").collect()
    assert sorted(r.count_views for r in views) == (accepted[:n] if n else accepted)


def test_positions_order_a_split_file(spark, tmp_path, set_conf):
    """A plain text file read in many splits keeps its line order."""
    set_conf("spark.sql.files.maxPartitionBytes", "2000")
    set_conf("spark.sql.files.openCostInBytes", "0")
    (tmp_path / "pageviews-20160101-000000").write_text(
        "".join(f"en P{i} {i} 0\n" for i in range(2000)))
    raw = sources.scan_lines(spark, str(tmp_path), positions=True)
    assert raw.select("block_start").distinct().count() > 3
    kept = sources.limit_per_file(quality.master_records(raw), 700)
    assert sorted(r.count_views for r in kept.collect()) == list(range(700))


def test_inventory_does_not_read_contents(spark, hours):
    files = sources.list_files(spark, hours)
    assert files.count() == 3
    assert "ReadSchema: struct<path:string,length:bigint>" in plan_of(files)
    first = sources.files_limit(files, 1)
    assert {r.file_name for r in first.collect()} == {
        "pageviews-20160101-000000.gz", "pageviews-20160201-000000.gz"}
    assert sources.files_limit(files, 0).count() == 3
    raw = sources.scan_lines(spark, f"{hours}/2016/*")
    assert sources.keep_files(raw, first).count() == 60
    assert sources.sample_files(raw, ["pageviews-20160201-000000.gz"]).count() == 20


def test_scope_prunes_partitions(spark, facts, tmp_path):
    write_facts(facts(*[(f"2016-{m:02d}-01", "A", m) for m in range(1, 13)]), str(tmp_path))
    scoped = sources.load_scope(spark.read.parquet(str(tmp_path)), 2016, 3, 5)
    assert sorted(r.views for r in scoped.collect()) == [3, 4, 5]
    assert "PartitionFilters: [isnotnull(year" in plan_of(scoped)
    table = spark.read.parquet(str(tmp_path))
    assert sources.load_scope(table, 2016, 7).count() == 1
    assert sources.load_scope(table, 2015).count() == 0


def test_stage_text_round_trip(spark, facts, tmp_path):
    rows = [("2016-07-01", 'Q"uote', 5), ("2016-07-02", "Back\\", 6), ("2016-07-02", "#x", 7)]
    write_stage_kv(facts(*rows), str(tmp_path / "stage"), "day")
    read = sources.read_stage_kv(spark, str(tmp_path / "stage"), "day")
    assert {(r.interval, r.domain_code, r.page_title, r.views) for r in read.collect()} == {
        (day.replace("-", ""), "en", page, views) for day, page, views in rows}


@pytest.mark.parametrize("limit", [1, 30, 31, 45, 60, 90, 1000])
def test_limited_master_equals_a_full_sort(spark, hours, tmp_path, limit):
    """Hours with 30, 22 and 15 records; titles and counts tie at the border of the cut."""
    path = str(tmp_path / "master")
    raw = sources.scan_lines(spark, f"{hours}/2016/*")
    records = quality.master_records(raw).withColumn("page_title", F.substring("page_title", 1, 2))
    write_master(records.unionByName(records.filter("count_views % 7 = 1")), path)
    order = ["hourly_timestamp", "domain_code", "page_title", "count_views",
             "total_response_size"]
    stored = sources.read_master(spark, path)
    rest = [name for name in stored.columns if name not in order]
    expected = stored.orderBy(*order, *rest).limit(limit).collect()
    assert sorted(sources.read_master(spark, path, limit).collect()) == sorted(expected)


def test_limited_master_sorts_one_hour(spark, hours, tmp_path):
    path = str(tmp_path / "master")
    write_master(quality.master_records(sources.scan_lines(spark, f"{hours}/2016/*")), path)
    plan = plan_of(sources.read_master(spark, path, 40))
    assert "Limit" not in plan and "TakeOrdered" not in plan
