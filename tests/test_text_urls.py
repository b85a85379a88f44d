import hashlib
import re
from urllib.parse import quote

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roamdex import fixed
from roamdex.functions import text, urls


def column(spark, values, fn):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.o for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


SAMPLES = [
    "", " ", "a", "\x1c  x y  　", "A - b", "Cat2 (S)", "St-Denis", "A|b", "A |b\nc", "é – x", "é — x\ny",
    "<b>x</b> <a\nhref> y", "a\n\n\nb", "r\r\ns\rt",
]


def test_strip_is_unicode_wide(spark):
    assert column(spark, SAMPLES, text.strip) == [s.strip() for s in SAMPLES]


def test_clean_name(spark):
    tail = re.compile(fixed.NAME_TAIL.removeprefix("(?d)"))
    assert column(spark, SAMPLES, text.clean_name) == [tail.sub("", s) for s in SAMPLES]


def test_tags_and_newlines(spark):
    assert column(spark, SAMPLES, text.strip_tags) == [re.sub("<.*?>", "", s) for s in SAMPLES]
    assert column(spark, SAMPLES, text.squeeze_newlines) == [re.sub("\n+", "\n", s) for s in SAMPLES]
    assert column(spark, ["r\r\ns\rt\n"], text.newlines) == ["r\ns\nt\n"]


def test_tokens(spark):
    got = column(spark, ["U.S. d'Ivoire 3.14, St-Denis 1,000 a_b", "", "--", "Ünï ÇA"], text.tokens)
    assert got == [["u.s", "d'ivoire", "3.14", "st", "denis", "1,000", "a_b"], [], [], ["ünï", "ça"]]


def test_long_runs_do_not_overflow_the_stack(spark):
    assert column(spark, ["1," * 200_000], lambda c: F.size(text.tokens(c))) == [1]
    url = "https://" + "a." * 200_000 + "b/c"
    assert column(spark, [url], lambda c: urls.absolute_links(c)[0]) == [url]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=20, max_size=60))
def test_quote_matches_percent_quoting(spark, values):
    values = [v.replace("\x00", "") for v in values] + ["https://x.org/wiki/Côte_d'Ivoire?a=b&c=1#x~*+ <>!"]
    quoted = [quote(v, "<>=/:!") for v in values]
    assert column(spark, values, urls.quote) == quoted
    keys = column(spark, values, lambda c: urls.url_key(urls.quote(c)))
    assert keys == [hashlib.md5(q.encode()).hexdigest() + ".txt" for q in quoted]


def test_absolute_links(spark):
    body = (
        'x https://a.b/c. "https://a.b.c" https://a.b https://é-x.org/p?q=1#f, http://n.o/x '
        "https://a..b/c https://host/x https://a.b/i.png.html https://a.b.c:"
    )
    parts = regex.compile(fixed.ABSOLUTE_LINK_PARTS)
    assert column(spark, [body], urls.absolute_links) == [[m.group(0) for m in parts.finditer(body)]]
    kinds = column(spark, ["a.png", "a.PNG", "x.pdf/y", "a.html"], urls.is_excluded)
    assert kinds == [True, False, True, False]


def test_relative_links_and_origin(spark):
    assert column(spark, ['<a href="/a b"><a href="b"><a href="/c">'], urls.relative_links) == [["/a b", "/c"]]
    assert column(spark, ["https://h.o/x/y", "http://h.o/x", "https://h.o"], urls.origin) == ["https://h.o", "", ""]
    assert column(spark, ["https://p.org/x?u=q.org", "https://z.org"], lambda c: urls.queue_rank(c, "q.org")) == [0, 1]
