import datetime

import pytest
from pyspark.sql import functions as F

from viewtide.functions import fields


@pytest.fixture
def value(spark):
    def evaluate(*columns):
        return spark.range(1).select(*columns).first()
    return evaluate


@pytest.mark.parametrize("day, sunday", [
    ("2016-07-01", "2016-06-26"), ("2016-07-03", "2016-07-03"), ("2017-01-01", "2017-01-01"),
    ("2016-01-01", "2015-12-27")])
def test_week_starts_on_sunday(value, day, sunday):
    assert str(value(fields.week_start(F.lit(day).cast("date")))[0]) == sunday


def test_interval_labels(value):
    day = F.lit("2016-07-06").cast("date")
    labels = [fields.interval_label(fields.interval_start(day, g), g)
              for g in ("day", "week", "month", "year")]
    assert list(value(*labels)) == ["20160706", "20160703", "201607", "2016"]
    with pytest.raises(ValueError):
        fields.interval_start(day, "decade")


def test_file_name_parts(value):
    name = F.lit("pageviews-20160929-140000.gz")
    row = value(fields.file_day(name), fields.file_hour(name), fields.hour_stamp(name),
                fields.file_month(name))
    assert list(row) == [datetime.date(2016, 9, 29), datetime.datetime(2016, 9, 29, 14),
                         "2016092914", "201609"]


def test_page_id_splits_at_the_first_space(value):
    assert list(value(*fields.split_page_id(F.lit("en Main Page")))) == ["en", "Main Page"]


def test_sort_key_round_trip(value):
    key = fields.sort_key(F.lit("20160929"), F.lit(1871863))
    assert value(key)[0] == "20160929000001871863"
    assert list(value(*fields.parse_sort_key(key))) == ["20160929", 1871863]


def test_json_escape(value):
    assert value(fields.json_escape(F.lit('a"b\\c')))[0] == 'a\\"b\\\\c'


def test_hex_topic_url(value):
    row = value(fields.payload_hex(F.lit("aé")), fields.page_topic(F.lit("Main_Page")),
                fields.page_url(F.lit("Main_Page"), "https://example.org/"))
    assert list(row) == ["61c3a9", "Main Page", "https://example.org/Main_Page"]
