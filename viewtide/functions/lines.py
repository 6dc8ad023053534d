"""Parsing and validation of raw hourly lines.

A line holds four fields separated by single spaces: domain code, page title,
view count, response size. Trailing spaces do not count as fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewtide.params import DOMAIN

FIELD_COUNT = 4

# Reject reasons in the order the rules are tried.
DOMAIN_REASON = "domain"
HYPHEN = "hyphen_title"
TAB = "has_tab"
FIELDS = "field_count"
NONINTEGER = "noninteger_views"
RANGE = "views_out_of_range"
EMPTY_TITLE = "empty_title"
REASONS = (DOMAIN_REASON, HYPHEN, TAB, FIELDS, NONINTEGER, RANGE, EMPTY_TITLE)
# Rejects that are expected in every file and are not reported line by line.
SILENT_REASONS = (DOMAIN_REASON, HYPHEN)
# Reject reasons of typed records, in the order they are tried.
SIZE = "noninteger_size"
SIZE_RANGE = "size_out_of_range"
RECORD_REASONS = (FIELDS, NONINTEGER, RANGE, SIZE, SIZE_RANGE)


def line_fields(value: Column) -> Column:
    """All fields of the line as an array."""
    return F.split(F.rtrim(value), " ")


def in_domain(value: Column, domain: str = DOMAIN) -> Column:
    return F.startswith(value, F.lit(f"{domain} "))


def has_hyphen_title(value: Column, domain: str = DOMAIN) -> Column:
    """The page is titled just ``-``."""
    head = f"{domain} - "
    return F.startswith(value, F.lit(head)) & (F.length(value) > len(head))


def has_tab(value: Column) -> Column:
    return F.contains(value, F.lit("\t"))


def has_wrong_arity(fields: Column) -> Column:
    return F.size(fields) != FIELD_COUNT


def is_digits(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A[0-9]+\z"), F.lit(False))


def is_whole_number(text: Column) -> Column:
    """Whether the text is an optionally signed decimal number."""
    return F.coalesce(text.rlike(r"\A[+-]?[0-9]+\z"), F.lit(False))


def as_long(text: Column) -> Column:
    """BIGINT value of an optionally signed decimal number, else null.

    The cast refuses everything else but blanks around the number, so a look at the
    first and the last character replaces a regular expression.
    """
    first, last = F.ascii(text), F.ascii(F.right(text, F.lit(1)))
    ends = first.between(ord("+"), ord("9")) & last.between(ord("0"), ord("9"))
    return F.when(ends, text.try_cast("bigint"))


def number_fault(text: Column, value: Column, no_number: str, out_of_range: str) -> Column:
    """Why a text has no BIGINT ``value``; the text is only searched where it has none."""
    return F.when(value.isNull(), F.when(is_whole_number(text), out_of_range)
                  .otherwise(no_number))


def field(fields: Column, position: int) -> Column:
    """One field by its 1-based position, null where the line is shorter."""
    return F.try_element_at(fields, F.lit(position))


def reject_reason(value: Column, fields: Column, domain: str = DOMAIN) -> Column:
    """Name of the first rule the line breaks, null for a good line.

    ``fields`` is the parsed column, so the cheap tests on the raw line come
    first and the split happens once.
    """
    views = field(fields, 3)
    return (
        F.when(~in_domain(value, domain), DOMAIN_REASON)
        .when(has_hyphen_title(value, domain), HYPHEN)
        .when(has_tab(value), TAB)
        .when(has_wrong_arity(fields), FIELDS)
        .when(~is_digits(views), NONINTEGER)
        .when(views.try_cast("bigint").isNull(), RANGE)
        .when(field(fields, 2) == "", EMPTY_TITLE)
    )


def record_numbers(fields: Column) -> Column:
    """The two numbers of a record, parsed: ``views`` and ``size``."""
    return F.struct(as_long(field(fields, 3)).alias("views"),
                    as_long(field(fields, 4)).alias("size"))


def record_reject_reason(fields: Column, numbers: Column) -> Column:
    """Why a line of any domain is no typed record, null if it is one."""
    return F.when(has_wrong_arity(fields), FIELDS).otherwise(F.coalesce(
        number_fault(field(fields, 3), numbers["views"], NONINTEGER, RANGE),
        number_fault(field(fields, 4), numbers["size"], SIZE, SIZE_RANGE)))
