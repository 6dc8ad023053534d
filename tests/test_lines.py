import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from viewtide.functions import lines
from viewtide.operators import quality, rollup

FILE = "pageviews-20160701-110000.gz"
CASES = [
    ("en Main_Page 150 0", None),
    ("en Foo 60 0 ", None),
    ("en Foo 60 0   ", None),
    ('en Quote"d 5 0', None),
    ("en Back\\slash 5 0", None),
    ("en - 500 0", "hyphen_title"),
    ("en -x 500 0", None),
    ("en - ", "field_count"),
    ("de Bar 900 0", "domain"),
    ("en.m Bar 900 0", "domain"),
    ("enBar 900 0", "domain"),
    ("", "domain"),
    ("en Tab\tx 5 0", "has_tab"),
    ("en - 5\t 0", "hyphen_title"),
    ("en Tab\tx 5", "has_tab"),
    ("en Foo 12", "field_count"),
    ("en a b 1 0", "field_count"),
    ("en Foo x1 0", "noninteger_views"),
    ("en Foo -5 0", "noninteger_views"),
    ("en Foo  0", "noninteger_views"),
    ("en Foo ١٢ 0", "noninteger_views"),
    ("en Foo 1.5 0", "noninteger_views"),
    ("en Foo 99999999999999999999 0", "views_out_of_range"),
    ("en Foo 2147483647 0", None),
    ("en Foo 9223372036854775808 0", "views_out_of_range"),
    ("en  101 0", "empty_title"),
]


@pytest.fixture
def raw(spark):
    rows = [(FILE, i, value) for i, (value, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "file_name STRING, seq BIGINT, value STRING")


def test_first_broken_rule_wins(raw):
    found = {row.seq: row.reject_reason for row in quality.with_outcome(raw).collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_kept_and_rejected_add_up(raw):
    counts = {row.outcome: row.lines for row in quality.reject_counts(raw).collect()}
    assert sum(counts.values()) == len(CASES)
    assert counts["kept"] == quality.clean_lines(raw).count()
    report = {row.counter: row.lines for row in quality.reject_report(raw).collect()}
    assert report["GOOD"] == counts["kept"]
    assert report["GOOD"] + report["BAD"] == len(CASES)
    assert report["CONTAINS_TABS"] == counts["has_tab"]
    assert report["CONTAINS_QUOTES"] == 1
    assert report["NONINTEGER_COUNT_OF_VIEWS"] == counts["noninteger_views"]


def test_reported_rejects_leave_out_expected_ones(raw):
    reasons = {row.reject_reason for row in quality.reject_rows(raw).collect()}
    assert reasons == {reason for _, reason in CASES} - {None, "domain", "hyphen_title"}


def test_typed_columns(raw):
    row = quality.clean_lines(raw).filter("seq = 1").first()
    assert (str(row.day), str(row.hour_ts)) == ("2016-07-01", "2016-07-01 11:00:00")
    assert (row.domain_code, row.page_title, row.views) == ("en", "Foo", 60)


def test_other_domain(raw):
    assert [row.page_title for row in quality.clean_lines(raw, "de").collect()] == ["Bar"]


def test_master_takes_all_domains_and_signed_numbers(spark):
    lines = ["de Bar 900 7", "en Foo -5 +3", "en Foo x 0", "en Foo 1", "en Tab\tx 5 0 ",
             "en Foo 5\t 0", "en Foo 1.5 0", "en Foo 99999999999999999999 0"]
    raw = spark.createDataFrame([(FILE, v) for v in lines], "file_name STRING, value STRING")
    rows = quality.master_records(raw).collect()
    assert {(r.domain_code, r.page_title, r.count_views, r.total_response_size) for r in rows} == {
        ("de", "Bar", 900, 7), ("en", "Foo", -5, 3), ("en", "Tab\tx", 5, 0)}
    assert tuple(rows[0].hourly_timestamp) == (2016, 7, 1, 11)


def test_stamped_lines_keep_the_raw_line(raw):
    stamped = {row.seq: row.value for row in quality.stamp_lines(raw).collect()}
    assert stamped[1] == "2016070111en Foo 60 0 "
    assert 15 not in stamped and 16 not in stamped


def test_load_profile(raw):
    profile = quality.load_profile(raw).first()
    assert (profile.files, profile.records) == (1, len(CASES))
    assert (profile.max_domain_length, profile.max_domain_example) == (4, "en.m")
    nothing = quality.load_profile(raw.filter("value = ''")).first()
    assert (nothing.bad_records, nothing.max_domain_example) == (1, None)


def test_split_happens_once(raw):
    from tests.conftest import plan_of
    plan = plan_of(quality.clean_lines(raw.repartition(1)))
    assert plan.count("split(") == 1


def test_text_scan_gets_the_domain_test_and_sums_start_in_the_map_tasks(spark, tmp_path):
    from tests.conftest import plan_of
    from viewtide.sources import scan_lines
    (tmp_path / FILE.removesuffix(".gz")).write_text("en A 1 0\n")
    raw = scan_lines(spark, str(tmp_path))
    plan = plan_of(rollup.daily_views(quality.clean_lines(raw)))
    assert "StringStartsWith(value,en )" in plan
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_threshold_is_strict(spark):
    lines = [(FILE, f"en A {n} 0") for n in (60, 40)] + [(FILE, f"en B {n} 0") for n in (60, 41)]
    raw = spark.createDataFrame(lines, "file_name STRING, value STRING")
    daily = rollup.above(rollup.daily_views(quality.clean_lines(raw)))
    assert [(r.page_title, r.views) for r in daily.collect()] == [("B", 101)]


def test_audit_names_the_changed_field(spark):
    schema = ("file_name STRING, seq INT, hourly_timestamp STRUCT<year: INT>, domain_code STRING, "
              "page_title STRING, count_views INT, total_response_size INT")
    rows = [(FILE, i, (2016,), "en", "A", i, 0) for i in range(4)]
    changed = [rows[0], rows[1][:5] + (9, 0), (FILE, 7, (2016,), "en", "A", 7, 0), rows[2]]
    source, stored = spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema)
    found = {r.seq: (r.presence, r.count_views_changed, r.page_title_changed)
             for r in quality.roundtrip_audit(source, stored, ["file_name", "seq"]).collect()}
    assert found == {1: ("both", True, False), 3: ("lost", True, True), 7: ("added", True, True)}
    summary = quality.roundtrip_summary(source, stored, ["file_name", "seq"]).first()
    assert (summary.compared, summary.damaged) == (5, 3)


def test_a_sound_store_shuffles_no_record(spark):
    """Only fingerprints are exchanged; the join behind them has nothing to read."""
    rows = spark.range(3000).select(
        F.lit("f").alias("file_name"), F.col("id").alias("seq"),
        F.struct(F.lit(2016).alias("year")).alias("hourly_timestamp"),
        F.lit("en").alias("domain_code"), F.concat(F.lit("P"), "id").alias("page_title"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("count_views"),
        F.lit(0).alias("total_response_size"))
    key = ["file_name", "seq"]
    sound = quality.roundtrip_audit(rows, rows.repartition(7), key)
    assert "Exchange" not in plan_of(sound) and sound.count() == 0
    assert tuple(quality.roundtrip_summary(rows, rows, key).first()) == (3000, 0)
    broken = rows.filter("seq <> 17").withColumn("count_views", F.when(
        F.col("seq") == 10, F.lit(0)).otherwise(F.col("count_views")))
    found = {r.seq: (r.presence, r.count_views_changed)
             for r in quality.roundtrip_audit(rows, broken, key).collect()}
    assert found == {17: ("lost", True), 10: ("both", True)}
    assert tuple(quality.roundtrip_summary(rows, broken, key).first()) == (3000, 2)


def test_differences_without_a_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "t STRING, n INT")
    other = spark.createDataFrame([("a", 1), ("b", None), ("c", 4), ("c", 4)], "t STRING, n INT")
    found = {tuple(r) for r in quality.record_differences(rows, other).collect()}
    assert found == {("a", 1, 2, 1), ("c", 3, 1, 0), ("c", 4, 0, 2)}
    assert quality.record_differences(rows, rows).count() == 0


@pytest.mark.parametrize(("text", "value"), [
    ("12", 12), ("+5", 5), ("-5", -5), ("007", 7), ("", None), ("+", None), ("1.5", None),
    ("1e3", None), ("\t12", None), ("12\t", None), (" 12", None), ("12L", None), ("1/2", None),
    ("9223372036854775807", 2 ** 63 - 1), ("9223372036854775808", None), ("١٢", None),
    ("\x7f12", None), ("12\x7f", None), (None, None)])
def test_numbers_are_parsed_as_they_are_judged(spark, text, value):
    row = spark.createDataFrame([(text,)], "t STRING").select(
        lines.as_long(F.col("t")).alias("v"), lines.is_whole_number(F.col("t")).alias("w")).first()
    assert row.v == value and row.w == (value is not None or text == "9223372036854775808")
