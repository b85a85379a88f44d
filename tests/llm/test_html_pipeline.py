"""Main text of pages, the pipeline from end to end, and the registered queries against their SQL."""

import html as html_lib
import re

import oracle_check
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roamdex.llm import html_text, queries

SF = "/root/testdata/sf0.001"


def plain_article(html):
    """Text of the one article of a driver page, by cutting at its block tags."""
    part = html.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = re.split(r"</?(?:p|h1|h2|div)[^>]*>", re.sub(r"</?b>", "", part.replace("<br>", " ")))
    return "\n".join(b for b in (" ".join(html_lib.unescape(x).split()) for x in blocks) if b)


def test_main_text_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == plain_article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(plain_article(r["html"])) and got[r["page_id"]]["url"] == r["url"]


UNSEEN = """<html><head><title>T</title><style>p{}</style></head><body><header class="masthead"><p>A tagline, with words in it.</p></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="column"><article><h1>Title</h1><p>First &amp; one&nbsp;two.
 three</p><div class="notice"><p>Read our terms, please.</p></div><p>Second<script>var x = "<p>no</p>";</script> part.</p>
<form><p>Subscribe now!</p><input><button>Go</button></form></article><section id="comments"><p>A reader wrote this long comment, and it has many words.</p></section></div>
<aside class="sidebar"><p>A sidebar with a sentence in it.</p></aside><footer><p>All rights reserved. Contact us.</p></footer></body></html>"""


def test_parts_around_the_text_stay_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_text.fit(pages)
    assert model.main_text(UNSEEN) == "Title\nFirst & one two. three\nSecond part."


# Layouts that neither the table nor the labelled pages have, with what is main text in each.
LAYOUTS = {
    "links in a paragraph": (
        '<div id="content"><p>See <a href=a>long link text</a> and <a href=b>another link with words</a>.</p><p>It is short, but it counts.</p></div>',
        "See long link text and another link with words.\nIt is short, but it counts.",
    ),
    "comment system": (
        '<div class="post"><h1>Tides</h1><p>The tide comes twice a day, and goes as often. Nobody is late for it.</p></div>'
        '<div id="disqus_thread"><div><p>I lived by the sea for years, and I was late for it every single time, believe me.</p></div></div>',
        "Tides\nThe tide comes twice a day, and goes as often. Nobody is late for it.",
    ),
    "header of the article": (
        '<div class="site-header"><a href="/">Home</a></div><div id="main"><div class="article-header"><h1>A title</h1></div>'
        "<div class='article-body'><p>The text goes here, with some words in it. And then it ends.</p></div></div>",
        "A title\nThe text goes here, with some words in it. And then it ends.",
    ),
    "hidden parts": (
        '<article><p>One is shown, to all of us.</p><p hidden>Two is not.</p><div style="display: none"><p>Three is not, either.</p></div><p>Four is <span hidden>not</span> shown.</p></article>',
        "One is shown, to all of us.\nFour is shown.",
    ),
    "semantic page": (
        "<header><nav><a href=/>Home</a></nav></header><main><h1>Clay</h1><p>Clay is soft when wet. It is hard when fired.</p></main>"
        "<aside><p>Our shop sells clay by the ton, and tools.</p></aside><footer><p>All rights reserved. Contact.</p></footer>",
        "Clay\nClay is soft when wet. It is hard when fired.",
    ),
    "blog with replies": (
        '<div class="entry"><h2>My garden</h2><p>The beans are up, at last. I had given up on them.</p></div>'
        '<div class="replies"><div class="reply"><p>Mine are up too, they were late this year, were they not?</p></div></div>',
        "My garden\nThe beans are up, at last. I had given up on them.",
    ),
    "cookie notice": (
        '<div id="cookie-consent"><p>We store cookies, to make this site better. You may refuse them.</p><button>Accept</button></div>'
        "<article><h1>Ink</h1><p>Ink is made of soot and gum. It keeps for years, in a cool place.</p></article>",
        "Ink\nInk is made of soot and gum. It keeps for years, in a cool place.",
    ),
    "menu of lists": (
        "<ul class=menu><li><a href=1>First</a></li><li><a href=2>Second</a></li></ul><div class=content><p>There was a list above, and it is gone. This stays.</p></div>",
        "There was a list above, and it is gone. This stays.",
    ),
    "recipe with lists": (
        "<main><h1>Soup</h1><ul><li>One onion</li><li>Two leeks</li></ul><ol><li>Chop all of it.</li><li>Boil it for an hour.</li></ol></main><footer>Imprint</footer>",
        "Soup\nOne onion\nTwo leeks\nChop all of it.\nBoil it for an hour.",
    ),
    "advert within": (
        "<article><p>The first paragraph is long enough to be read. It has two sentences.</p><div class='ad-slot advert'><p>Buy now, and save a lot of money today.</p></div><p>The second follows it.</p></article>",
        "The first paragraph is long enough to be read. It has two sentences.\nThe second follows it.",
    ),
    "sidebar of sections": (
        "<div class=wrap><section class=story><h1>Owls</h1><p>Owls hear a mouse under snow. They turn their heads far around.</p></section>"
        "<section class='sidebar-right'><h3>About</h3><p>I write about birds, for my own pleasure and yours.</p></section></div>",
        "Owls\nOwls hear a mouse under snow. They turn their heads far around.",
    ),
    "form at the end": (
        "<main><p>Write to us, if you know more. We read all of it, sooner or later.</p><form action=/s><p>Your name and your message, please.</p><input><button>Send</button></form></main>",
        "Write to us, if you know more. We read all of it, sooner or later.",
    ),
    "breadcrumbs and pages": (
        "<div class=breadcrumb><a href=/>Home</a> / <a href=/g>Guides</a></div><div class='post-body'><p>Sharpen the blade first. Then oil it, but not too much.</p></div><div class=pagination><a href=2>2</a> <a href=3>Next</a></div>",
        "Sharpen the blade first. Then oil it, but not too much.",
    ),
    "table in the text": (
        "<article><h1>Trains</h1><p>There are two trains a day, one each way.</p><table><tr><th>North</th><td>9:10</td></tr><tr><th>South</th><td>17:40</td></tr></table></article><nav><a href=/t>Tickets</a></nav>",
        "Trains\nThere are two trains a day, one each way.\nNorth\n9:10\nSouth\n17:40",
    ),
    "related stories": (
        "<article><h1>Fog</h1><p>The fog stayed for nine days. On the tenth it rained.</p></article><div class='related'><h3>Related</h3><p><a href=/r>Rain, and what to do about it when it does not stop</a></p></div>",
        "Fog\nThe fog stayed for nine days. On the tenth it rained.",
    ),
    "newsletter": (
        "<div class='story-text'><p>He sold the mill in spring. By autumn it had burned down.</p></div><div class='newsletter-signup'><p>Get the best stories by mail, each week, for free.</p><form><input></form></div>",
        "He sold the mill in spring. By autumn it had burned down.",
    ),
}


@pytest.fixture(scope="module")
def page_model(spark):
    return html_text.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("name", LAYOUTS)
def test_unseen_layouts(page_model, name):
    body, text = LAYOUTS[name]
    assert page_model.main_text(f"<html><head><title>t</title></head><body>{body}</body></html>") == text


def test_marginals_are_brute_force():
    """Sum-product against the sum over all labellings of a small tree."""
    import itertools
    import math

    model = html_text.weighed(html_text.Counter())
    page = html_text.Page("<div class='post'><p>Some text, here.</p><div class='ad'>Buy.</div></div><nav><a href=x>y</a></nav>")
    n = len(page.tag)
    found, total, on = html_text.features(page), 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n - 1):
        y = (0, *labels)
        p = 1.0
        for i in range(1, n):
            p *= model.edge[html_text.edge_kind(page, i)][y[page.parent[i]]][y[i]]
            p *= math.exp(sum(model.unary.get(f, (0.0, 0.0))[y[i]] for f in found[i]))
        total += p
        for i in range(n):
            on[i] += p * y[i]
    assert model.marginals(page) == pytest.approx([x / total for x in on], abs=1e-9)


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    odd = [None, "", "   ", "no tags &lt; at all, only words here.", "<p", "</p></div>", "<!-- only -->", deep, "<p>" + "long text, " * 50000, "<b><i>x</b></i>"]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(odd)] + [(1, "u", "")], "page_id bigint, url string, html string")
    got = html_text.extract(pages.withColumn("text", F.lit("clash"))).collect()
    assert len(got) == len(odd) + 1 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert all(r["text"] == "" for r in got if r["page_id"] in (0, 1, 2, 5, 6))
    assert html_text.extract(pages.where("false")).collect() == []


def test_unclosed_heads_and_self_closed_drawings():
    """Texts of pages whose head or drawing has no end tag; what stands in a head stays out."""

    def read(html):
        return [t for t in html_text.Page(html).text if t is not None]

    body = "<body><p>All of it.</p><p>More.</p></body></html>"
    for head in ("<head>", "<head><title>t</title><meta charset=x>", "<head><noscript>no", "<head><template><p>no</p>"):
        assert read("<html>" + head + body) == ["All of it.", "More."], head
    assert read("<head><title>t</title><p>All of it.</p>") == ["All of it."]
    assert read("<head><title>t</title>Bare text") == ["Bare text"]
    assert read("<head><template><div>no</div></template><noscript><p>no</p></noscript></head><p>yes") == ["yes"]
    for drawing in ("<svg/>", "<math />", "<svg><title>no</title></svg>"):
        assert read(f"<div><p>one {drawing} two</p><p>three</p></div>") == ["one two", "three"], drawing


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.count())
        if k < 4:
            assert docs.columns == columns, name
    assert before > seen[0] > seen[1] == seen[2] and seen[3] > 0
    mixed = spark.read.parquet(f"{tmp_path}/3").withColumn("n", queries.mixing.word_count(F.col("text")))
    assert docs.agg(F.sum("size")).first()[0] == mixed.agg(F.sum("n")).first()[0]


def test_pipeline_of_odd_rows(spark, documents, tmp_path):
    rows = [(1, None, None), (2, "", "a"), (2, "", "a"), (None, "some words here.", "b"), (3, "w " * 9000, None)]
    docs = documents(rows).withColumn("size", F.lit("clash"))
    for table in (docs, docs.where("false")):
        now = table
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            folder = f"{tmp_path}/{table.count()}-{k}"
            stage(spark, now, SF).write.parquet(folder)
            now = spark.read.parquet(folder)
        now.collect()


def test_registered(spark):
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = oracle_check.connect(SF)
    assert oracle_check.difference(queries.QUERIES[name](spark, SF), con, queries.ORACLE[name]) is None
