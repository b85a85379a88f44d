"""Links of fetched pages as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamdex import fixed
from roamdex.functions import text, urls

RELATIVE, ABSOLUTE = 0, 1


def page_links(pages: DataFrame, origin_pattern: str = fixed.ORIGIN_HTTPS, raw: str = "raw") -> DataFrame:
    """``src, dst, kind, pos`` for every link of every page, repeats included.

    Links are those of the fetched content: what follows the URL line that a page file begins with.

    Relative links (kind 0) come before absolute ones (kind 1); ``pos`` is the place within its kind.
    Relative links of a page without a usable origin, and links to excluded file types, are dropped.
    One scan: both kinds are put in one array per page and exploded together.
    """
    body = text.after_first_line(F.col(raw))
    root = urls.origin(F.col("link"), origin_pattern)
    relative = F.when(root != "", urls.relative_links(body)).otherwise(F.array().cast("array<string>"))
    both = pages.select(
        F.col("link").alias("src"),
        root.alias("_root"),
        relative.alias("_rel"),
        urls.absolute_links(body).alias("_abs"),
    )
    edge = both.select(
        "src",
        F.explode(
            F.concat(
                F.transform("_rel", lambda u, i: _edge(F.concat("_root", u), RELATIVE, i)),
                F.transform("_abs", lambda u, i: _edge(u, ABSOLUTE, i)),
            )
        ).alias("e"),
    )
    return edge.select("src", "e.dst", "e.kind", "e.pos").filter(~urls.is_excluded(F.col("dst")))


def _edge(dst, kind: int, pos):
    return F.struct(dst.alias("dst"), F.lit(kind).alias("kind"), pos.alias("pos"))
