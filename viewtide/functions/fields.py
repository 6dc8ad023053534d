"""Scalar expressions on days, page names and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewtide.params import URL_PREFIX, VIEWS_KEY_DIGITS

_LABELS = {"day": "yyyyMMdd", "week": "yyyyMMdd", "month": "yyyyMM", "year": "yyyy"}
# Length of the interval label at the head of a key, per grain.
LABEL_LENGTH = {grain: len(pattern) for grain, pattern in _LABELS.items()}


def file_day(file_name: Column) -> Column:
    """DATE from a file name ``pageviews-YYYYMMDD-HHMMSS.gz``.

    Arithmetic on the digits costs a third of parsing a date from text, and this
    runs on every raw line. A name without the digits is an error.
    """
    return F.make_date(*_day_parts(file_name))


def file_hour(file_name: Column) -> Column:
    """Hour stamp from the file name, without a time zone (log hours are UTC)."""
    hour = F.substring(file_name, 20, 2).cast("int")
    return F.make_timestamp_ntz(*_day_parts(file_name), hour, F.lit(0), F.lit(0))


def _day_parts(file_name: Column) -> tuple[Column, Column, Column]:
    """Year, month and day from the eight digits, read as one number."""
    digits = F.substring(file_name, 11, 8).cast("int")
    return (digits / 10000).cast("int"), (digits / 100).cast("int") % 100, digits % 100


def file_month(file_name: Column) -> Column:
    """``YYYYMM`` of the file: the month directory it belongs to."""
    return F.substring(file_name, 11, 6)


def hour_stamp(file_name: Column) -> Column:
    """``YYYYMMDDHH`` of the file."""
    return F.concat(F.substring(file_name, 11, 8), F.substring(file_name, 20, 2))


def week_start(day: Column) -> Column:
    """The Sunday on or before the day."""
    return F.date_sub(day, F.dayofweek(day) - F.lit(1))


def interval_start(day: Column, grain: str) -> Column:
    """First day of the interval of this grain that holds the day."""
    if grain == "day":
        return day
    if grain == "week":
        return week_start(day)
    if grain in ("month", "year"):
        return F.trunc(day, grain).cast("date")
    raise ValueError(f"unknown grain: {grain}")


def interval_label(start: Column, grain: str) -> Column:
    """``yyyymmdd`` for day and week, ``yyyymm`` for month, ``yyyy`` for year."""
    return F.date_format(start, _LABELS[grain])


def label_start(label: Column) -> Column:
    """First day of the interval a label names."""
    return F.to_date(F.rpad(label, 8, "01"), "yyyyMMdd")


def page_id(domain_code: Column, page_title: Column) -> Column:
    return F.concat_ws(" ", domain_code, page_title)


def split_page_id(page: Column) -> tuple[Column, Column]:
    """Domain code and title. Only the first space separates them."""
    parts = F.split(page, " ", 2)
    return F.get(parts, F.lit(0)).alias("domain_code"), F.get(parts, F.lit(1)).alias("page_title")


def page_topic(page_title: Column) -> Column:
    return F.replace(page_title, F.lit("_"), F.lit(" "))


def page_url(page_title: Column, url_prefix: str = URL_PREFIX) -> Column:
    return F.concat(F.lit(url_prefix), page_title)


def json_escape(text: Column) -> Column:
    """The text as it stands between the quotes of a JSON string."""
    quoted = F.to_json(F.array(text))
    return F.substring(quoted, F.lit(3), F.length(quoted) - F.lit(4))


def sort_key(label: Column, views: Column) -> Column:
    """Interval label followed by the zero-padded view count."""
    return F.concat(label, F.format_string(f"%0{VIEWS_KEY_DIGITS}d", views))


def parse_sort_key(key: Column) -> tuple[Column, Column]:
    """Text before the padded view count, and the count."""
    head = F.substring(key, F.lit(1), F.length(key) - F.lit(VIEWS_KEY_DIGITS))
    views = F.right(key, F.lit(VIEWS_KEY_DIGITS)).try_cast("bigint")
    return head.alias("head"), views.alias("views")


def payload_hex(text: Column) -> Column:
    """Lower-case hex of the UTF-8 bytes."""
    return F.lower(F.hex(F.encode(text, "UTF-8")))


def stage_key(label: Column, domain_code: Column, page_title: Column) -> Column:
    """Key of the tab-separated stage text: label, domain, space, title."""
    return F.concat(label, page_id(domain_code, page_title))
