"""URL columns: links in a page, quoting, keys, host class."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from roamdex import fixed


def is_excluded(url: Column) -> Column:
    """True when the URL names an image or office file anywhere in it (case-sensitive)."""
    return url.rlike(fixed.EXCLUDED_TYPES)


def absolute_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(fixed.ABSOLUTE_LINK), F.lit(0))


def relative_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(fixed.RELATIVE_LINK), F.lit(1))


def origin(url: Column, pattern: str = fixed.ORIGIN_HTTPS) -> Column:
    """``scheme://host`` of a URL that has a path, else an empty string."""
    return F.regexp_extract(url, pattern, 1)


def quote(url: Column) -> Column:
    """Percent-quote in UTF-8, keeping letters, digits, ``_.-~`` and the characters of QUOTE_KEEP."""
    swaps = [("+", "%20"), ("*", "%2A"), ("%7E", "~")]
    swaps += [(f"%{ord(ch):02X}", ch) for ch in fixed.QUOTE_KEEP]
    return reduce(lambda c, s: F.replace(c, F.lit(s[0]), F.lit(s[1])), swaps, F.url_encode(url))


def url_key(quoted: Column) -> Column:
    """File name a fetched page is stored under."""
    return F.concat(F.md5(quoted), F.lit(".txt"))


def queue_rank(url: Column, priority_host: str) -> Column:
    """0 for URLs that mention the priority host, 1 for all others."""
    return F.when(F.contains(url, F.lit(priority_host)), 0).otherwise(1)
