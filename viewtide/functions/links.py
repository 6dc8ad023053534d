"""Expressions on the HTML of stored listing pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewtide.params import DATA_FILE_LINK, DIRECTORY_LINK

# HTML syntax the link search depends on.
_NOT_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)\b.*?</\1\s*>"
# Whole attributes before the href, values in quotes included, so that neither a
# ``>`` nor an ``href=`` inside another attribute counts.
_ATTRIBUTE = r"""(?:[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?|[/"'=])"""
_ANCHOR_HREF = (r"(?is)<a(?:\s++|/)(?:(?!href\s*=)" + _ATTRIBUTE + r"\s*+)*+"
                r"""href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""")
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|lt|gt|quot|apos|amp);"


def anchor_hrefs(html: Column) -> Column:
    """``href`` of every anchor in page order, as an array."""
    found = F.regexp_extract_all(F.regexp_replace(html, _NOT_MARKUP, ""),
                                 F.lit(_ANCHOR_HREF), F.lit(1))
    return F.transform(found, _attribute_text)


def _attribute_text(raw: Column) -> Column:
    """An attribute value without quotes, character references decoded once."""
    text = F.regexp_replace(raw, "^[\"']|[\"']$", "")
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    decoded = F.zip_with(
        F.split(text, _REFERENCE, -1), found,
        lambda piece, reference: F.concat(
            piece, F.when(reference.isNull(), "").otherwise(_character(reference))))
    return F.when(F.size(found) == 0, text).otherwise(F.array_join(decoded, ""))


def _character(reference: Column) -> Column:
    body = F.regexp_replace(reference, "[&#;]", "")
    code = F.when(body.rlike("^[xX]"), F.conv(F.substring(body, 2, 6), 16, 10)).otherwise(
        body).try_cast("bigint")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    result = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(
        "\ufffd")
    for name, character in _NAMED.items():
        result = F.when(reference == name, character).otherwise(result)
    return result


def is_directory_link(href: Column, pattern: str = DIRECTORY_LINK) -> Column:
    return href.rlike(rf"\A(?:{pattern})\z")


def is_data_file_link(href: Column, pattern: str = DATA_FILE_LINK) -> Column:
    return href.rlike(rf"\A(?:{pattern})\z")


def link_class(href: Column, directory: str = DIRECTORY_LINK,
               data_file: str = DATA_FILE_LINK) -> Column:
    """``directory``, ``data_file`` or ``other``; the whole href must match."""
    return (F.when(is_directory_link(href, directory), "directory")
            .when(is_data_file_link(href, data_file), "data_file")
            .otherwise("other"))


def file_base_name(url: Column) -> Column:
    """Last path segment."""
    return F.substring_index(url, "/", -1)
