"""Default parameters of the page-view operators.

Every operator takes these as arguments; the constants are only defaults.
"""

from __future__ import annotations

# Thresholds, limits, names and patterns that results depend on.
MIN_VIEWS = 100
TOP_N = 500
DOMAIN = "en"
URL_PREFIX = "https://en.wikipedia.org/wiki/"
VIEWS_KEY_DIGITS = 12
DIRECTORY_LINK = r"201\d.*/"
DATA_FILE_LINK = r"pageviews-201.*\.gz"
SAMPLE_FILES = (
    "pageviews-20160701-110000.gz",
    "pageviews-20160701-140000.gz",
    "pageviews-20160702-110000.gz",
    "pageviews-20160702-140000.gz",
    "pageviews-20160729-110000.gz",
    "pageviews-20160729-140000.gz",
    "pageviews-20160929-110000.gz",
    "pageviews-20160929-140000.gz",
)

GRAINS = ("day", "week", "month", "year")
