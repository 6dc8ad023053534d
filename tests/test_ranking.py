import random

import pytest

from tests.conftest import plan_of
from viewtide.operators import layout, ranking, rollup, topn
from viewtide.sinks import write_top_pages
from viewtide.sources import read_top_list, read_top_pages


def brute(rows, n, floor=100):
    """Ranked titles per day by sorting everything."""
    days = {}
    for day, page, views in rows:
        if views > floor:
            days.setdefault(day, []).append((-views, page))
    return {(day.replace("-", ""), rank): (page, -negative)
            for day, pages in days.items()
            for rank, (negative, page) in enumerate(sorted(pages)[:n], 1)}


def found(ranked):
    return {(r.interval, r["rank"]): (r.page_title, r.views) for r in ranked.collect()}


def skewed(count=3000):
    """A third of the rows on one day, many equal counts."""
    chosen = random.Random(7)
    return [("2016-07-01" if i % 3 == 0 else f"2016-07-{chosen.randint(2, 9):02d}",
             f"P{i:05d}", chosen.randint(90, 400)) for i in range(count)]


@pytest.mark.parametrize("n", [1, 10, 500, 5000])
def test_equals_sorting_everything(facts, n):
    rows = skewed()
    assert found(ranking.top_pages(facts(*rows), "day", n)) == brute(rows, n)


@pytest.mark.parametrize("n", [1, 10, 500, 5000])
@pytest.mark.parametrize("partitions", ["1", "4"])
def test_dropping_by_view_count_first_changes_nothing(facts, set_conf, n, partitions):
    set_conf("spark.sql.shuffle.partitions", partitions)
    rows = skewed()
    assert found(ranking.top_pages(facts(*rows), "day", n, stored=True)) == brute(rows, n)


def test_reach_keeps_ties_at_the_cutoff(facts):
    rows = [("2016-07-01", page, views) for page, views in
            (("A", 300), ("B", 200), ("C", 200), ("D", 200), ("E", 150))]
    frame = facts(*rows).withColumnRenamed("day", "interval_start")
    kept = {n: {r.page_title for r in ranking.within_reach(frame, n).collect()}
            for n in (1, 2, 4, 5, 9)}
    assert kept == {1: {"A"}, 2: set("ABCD"), 4: set("ABCD"), 5: set("ABCDE"), 9: set("ABCDE")}


def test_deep_limit_uses_more_rounds(facts, set_conf):
    set_conf("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    rows = skewed(600)
    frame = facts(*rows)
    assert topn._rounds(frame, 6) == [topn.SLICES, 5]
    assert topn._rounds(frame, 5) == [topn.SLICES]
    assert found(ranking.top_pages(frame, "day", 6)) == brute(rows, 6)


def test_ties_are_kept_and_ordered_by_page(facts):
    rows = [("2016-07-01", page, 200) for page in "CAB"]
    assert found(ranking.top_pages(facts(*rows), "day", 2)) == {
        ("20160701", 1): ("A", 200), ("20160701", 2): ("B", 200)}


def test_collapsed_ties(facts):
    rows = [("2016-07-01", "A", 300), ("2016-07-01", "C", 200), ("2016-07-01", "B", 200),
            ("2016-07-01", "D", 150), ("2016-07-02", "D", 300), ("2016-07-02", "A", 300)]
    collapsed = ranking.collapse_ties(ranking.top_pages(facts(*rows), "day", 3))
    assert found(collapsed) == {("20160701", 1): ("A", 300), ("20160701", 2): ("B", 200),
                                ("20160702", 1): ("A", 300)}


def test_plan_limits_groups_before_each_exchange(spark, facts):
    rows = facts(*skewed()).repartition(4)
    plan = plan_of(ranking.top_pages(rollup.daily_views(rows), "day", 500))
    assert plan.count("WindowGroupLimit") == 4
    assert plan.count("Partial") >= 2


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_positions_follow_the_global_order(facts, set_conf, partitions):
    set_conf("spark.sql.shuffle.partitions", partitions)
    rows = skewed(800)
    frame = facts(*rows).withColumnRenamed("day", "interval_start")
    placed = ranking.with_position(ranking.sort_popularity(frame)).collect()
    expected = sorted(rows, key=lambda r: r[1])
    expected = sorted(expected, key=lambda r: r[2], reverse=True)
    expected = sorted(expected, key=lambda r: r[0], reverse=True)
    assert {r.position: r.page_title for r in placed} == {
        i: page for i, (_, page, _) in enumerate(expected, 1)}


def test_lookup_reads_one_part(spark, facts, tmp_path):
    daily = facts(*skewed())
    lists = {"day": ranking.top_pages(daily, "day", 10),
             "month": ranking.top_pages(rollup.monthly_views(daily), "month", 10)}
    path = str(tmp_path / "lists")
    write_top_pages(ranking.tagged_lists(lists), path)
    month = read_top_list(spark, path, "month", "201607")
    assert found(month) == found(lists["month"])
    assert all("_part=month-201607" in name for name in month.inputFiles())
    assert read_top_list(spark, path, "day", "201607").count() == 0
    assert read_top_list(spark, path, "year", "2016").count() == 0
    table = read_top_pages(spark, path)
    assert found(ranking.top_pages_for(table, "month", "201607")) == found(month)


@pytest.mark.parametrize("level", ["MEMDISK", "DISK", "disk"])
def test_storage_level_does_not_change_results(facts, level):
    rows = skewed(300)
    kept = layout.persist_level(facts(*rows), level)
    assert found(ranking.top_pages(kept, "day", 10)) == brute(rows, 10)
    assert kept.storageLevel.useMemory == (level == "MEMDISK")
    kept.unpersist()


def test_key_stays_in_one_partition(facts):
    from pyspark.sql import functions as F
    placed = layout.partition_by_key(rollup.daily_views(facts(*skewed(300))), 5)
    parts = placed.withColumn("part", F.spark_partition_id()).select("part").distinct()
    assert 1 < parts.count() <= 5
