import pytest

from viewtide.operators import rollup


def sums(frame):
    return {(str(r.interval_start), r.page_title): r.views for r in frame.collect()}


def test_months_add_only_days_above_the_threshold(facts):
    rows = facts(("2016-07-01", "A", 100), ("2016-07-02", "A", 101), ("2016-07-03", "A", 200),
                 ("2016-08-01", "A", 150), ("2016-08-01", "B", 5))
    daily = rollup.above(rollup.daily_views(rows))
    monthly = rollup.monthly_views(daily)
    assert sums(monthly) == {("2016-07-01", "A"): 301, ("2016-08-01", "A"): 150}
    assert sums(rollup.yearly_views(monthly)) == {("2016-01-01", "A"): 451}
    everything = rollup.monthly_views(rollup.daily_views(rows))
    assert sums(everything)[("2016-07-01", "A")] == 401
    assert sums(rollup.yearly_views(everything)) == {("2016-01-01", "A"): 551,
                                                     ("2016-01-01", "B"): 5}


def test_year_sums_ignore_the_month_threshold(facts):
    monthly = rollup.monthly_views(facts(("2016-07-01", "A", 60), ("2016-08-01", "A", 60)))
    assert rollup.above(monthly).count() == 0
    assert rollup.above(rollup.yearly_views(monthly)).count() == 1


def test_week_straddles_new_year(facts):
    daily = facts(("2015-12-31", "A", 200), ("2016-01-02", "A", 300), ("2016-01-03", "A", 400))
    assert sums(rollup.weekly_views(daily)) == {("2015-12-27", "A"): 500, ("2016-01-03", "A"): 400}


def test_sums_do_not_wrap(facts):
    rows = facts(("2016-07-01", "A", 2**31 - 1), ("2016-07-01", "A", 2**31 - 1))
    assert rollup.daily_views(rows).first().views == 2**32 - 2


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_partition_count_does_not_matter(facts, set_conf, partitions):
    set_conf("spark.sql.shuffle.partitions", partitions)
    rows = [(f"2016-07-{i % 28 + 1:02d}", f"P{i % 7}", i) for i in range(500)]
    expected = {}
    for day, page, views in rows:
        expected[(day, page)] = expected.get((day, page), 0) + views
    found = {(str(r.day), r.page_title): r.views
             for r in rollup.daily_views(facts(*rows)).collect()}
    assert found == expected


def test_facts_must_nest_in_the_grain(spark, facts):
    import pytest
    weekly = rollup.weekly_views(facts(("2015-12-27", "A", 1)))
    for grain in ("month", "year"):
        with pytest.raises(ValueError, match="nest"):
            rollup.rollup(weekly, grain, "week")
    with pytest.raises(ValueError, match="nest"):
        rollup.rollup(weekly, "week", "month")
