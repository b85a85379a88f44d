"""Text clean-up columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roamdex import fixed


def newlines(c: Column) -> Column:
    """CR and CRLF to LF, as a text-mode read does."""
    return F.regexp_replace(c, r"\r\n?", "\n")


def strip(c: Column) -> Column:
    """Trim all Unicode white space at both ends."""
    return F.regexp_replace(c, fixed.STRIP, "")


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


def after_first_line(c: Column) -> Column:
    """What follows the first line feed; nothing where there is none."""
    at = F.instr(c, "\n")
    return F.when(at > 0, F.substring(c, at + 1, F.length(c))).otherwise(F.when(c.isNotNull(), F.lit("")))


def between(found: Column, start: str, end: str) -> Column:
    """Inner parts of those matches that have their end."""
    whole = F.filter(found, lambda m: F.endswith(m, F.lit(end)))
    return F.transform(whole, lambda m: F.substring(m, len(start) + 1, F.length(m) - len(start) - len(end)))


def strip_tags(c: Column) -> Column:
    """Drop ``<...>`` within a line; a tag broken over lines stays."""
    return F.regexp_replace(c, fixed.TAG, "$1")


def squeeze_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n+", "\n")


def clean_name(c: Column) -> Column:
    """Entity name without its subtitle, bracket or site part, and without line feeds."""
    return F.regexp_replace(c, fixed.NAME_TAIL, "")


def clean_infobox(c: Column) -> Column:
    """Infobox key or value: trimmed, markup dropped, pipes and runs of spaces to one space."""
    bare = F.regexp_replace(strip_tags(strip(c)), fixed.INFOBOX_MARKS, "")
    return F.regexp_replace(F.replace(bare, F.lit("|"), F.lit(" ")), fixed.SPACES, " ")


def drop_query_specials(c: Column) -> Column:
    """Delete the characters a search prompt treats as operators (nothing is put in their place)."""
    return F.regexp_replace(c, fixed.QUERY_SPECIAL, "")


def last_word_tokens(c: Column) -> Column:
    """Tokens of the last word that has any, the only required word of a keyword query; none where no word has."""
    words = F.filter(F.transform(F.split(strip(c), r"\s+"), tokens), lambda t: F.size(t) > 0)
    return F.coalesce(F.get(F.slice(words, -1, 1), F.lit(0)), F.array().cast("array<string>"))


def tokens(c: Column) -> Column:
    """Lower-cased word tokens, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(fixed.TOKEN), F.lit(0))
