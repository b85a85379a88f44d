import random

from pyspark.sql import functions as F

from roamdex.operators import enrich as en
from roamdex.operators import evaluate as ev
from roamdex.operators import ordered
from roamdex.operators import phrase_join as pj
from roamdex.operators.joins import keyed_join, without

SCHEMA = (
    "doc_id string, link string, title string, num_cat int, categories array<string>, "
    "paragraphs map<string,string>, other string, extra map<string,string>"
)
DOCS = [
    ("1", "u1", "Old Town of Bay", 1, ["X"], {"See": "s"}, "o", {}),
    ("2", "u2", "Bay", 0, [], {}, "o", {"k": "kept"}),
    ("3", "u3", "Unmatched", 0, [], {}, "o", {}),
]
BOXES = [
    ("Bay", {"title": "no", "cap": "B", "See": "no", "k": "new", "categories": "c"}),
    ("Old-Town!", {"cap": "none"}),
    ("Town of", {"cap": "T"}),
    ("!!", {"cap": "none"}),
    ("Bay", {"cap": "B2"}),
]


def frames(spark):
    return spark.createDataFrame(DOCS, SCHEMA), spark.createDataFrame(BOXES, "title string, kv map<string,string>")


def test_phrase_join_matches_containment(spark):
    rng = random.Random(2)
    words = ["a", "b", "c", "d-e", "F"]
    titles = [" ".join(rng.choices(words, k=rng.randrange(0, 7))) for _ in range(150)]
    phrases = sorted({" ".join(rng.choices(words, k=rng.randrange(0, 4))) for _ in range(60)})
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(titles)], "doc_id string, title string")
    got = {(r.title, r.doc_id) for r in pj.title_phrase_join(spark.createDataFrame([(p,) for p in phrases], "title string"), docs).collect()}
    doc_words = [f" {t.lower().replace('-', ' ')} " for t in titles]
    plain = {p: p.lower().replace("-", "") for p in phrases}  # a dash is deleted from a phrase, not made a space
    want = {
        (p, str(i)) for p, q in plain.items() for i, t in enumerate(doc_words) if q.strip() and f" {q} " in t
    }
    assert got == want


def test_enrich_copies_and_replaces(spark):
    docs, boxes = frames(spark)
    rows = {}
    for r in en.enrich_replace(docs, boxes).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sorted((d, len(rs)) for d, rs in rows.items()) == [("3", 1), ("_1", 3), ("_2", 2)]
    one = sorted((sorted(r.extra.items()) for r in rows["_1"]))
    assert one == [[("cap", "B"), ("k", "new")], [("cap", "B2")], [("cap", "T")]]
    two = sorted((sorted(r.extra.items()) for r in rows["_2"]))
    assert two == [[("See", "no"), ("cap", "B"), ("categories", "c"), ("k", "kept")], [("cap", "B2"), ("k", "kept")]]
    assert rows["_1"][0].num_cat == 1 and rows["_1"][0].paragraphs == {"See": "s"}


def test_enrich_merged(spark):
    docs, boxes = frames(spark)
    rows = {r.doc_id: r for r in en.enrich_replace(docs, boxes, merge=True).collect()}
    assert sorted(rows) == ["3", "_1", "_2"]
    assert rows["_1"].extra == {"cap": "T", "k": "new"}


def test_macro_recall(spark):
    pairs = [(1, 1), (1, 2), (2, 2), (0, 3), (5, 5), (5, 1), (5, 5)]
    rows = spark.createDataFrame(pairs, "truth int, predicted int")
    labels = {x for p in pairs for x in p}

    def recall(label):
        mine = [p for p in pairs if p[0] == label]
        return sum(a == b for a, b in mine) / len(mine) if mine else 0

    want = sum(map(recall, labels)) / len(labels)
    assert abs(ev.macro_recall(rows).first()[0] - want) < 1e-12


def test_average_precision(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(2), rng.randrange(40) / 3) for _ in range(500)]
    rows = spark.createDataFrame(pairs, "truth int, score double")
    positives, ap, tp = sum(t for t, _ in pairs), 0, 0
    for s in sorted({s for _, s in pairs}, reverse=True):
        step = sum(t for t, x in pairs if x == s)
        tp += step
        ap += step / positives * tp / sum(x >= s for _, x in pairs)
    for ranges in (1, 7, 256):
        got = ev.average_precision(rows, F.col("truth") > 0, ranges=ranges).first()[0]
        assert abs(got - ap) < 1e-9
    none = ev.average_precision(rows.withColumn("truth", F.lit(0)), F.col("truth") > 0)
    assert none.first()[0] == 0.0


def test_result_counts(spark):
    pages = [("a", '<i data-mw-num-results-total="1,234" x="">'), ("b", "none"), ("c", 'data-mw-num-results-total=""'), ("d", None)]
    rows = ev.result_counts(spark.createDataFrame(pages, "keyword string, html string")).collect()
    assert {r.keyword: r.truth for r in rows} == {"a": 1234, "b": None, "c": None, "d": None}


def test_dense_numbers(spark):
    docs = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("doc_id"))
    rows = ordered.dense_numbers(docs, "doc_id").collect()
    ids = sorted(r.doc_id for r in rows)
    assert all(ids[r.n] == r.doc_id for r in rows) and len({r.n for r in rows}) == 1000


def test_keyed_joins_equal_plain_ones(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (7, "c"), (99, "d"), (99, "d")], "k bigint, v string").distinct()
    for how in ("inner", "left_semi", "left_anti", "left"):
        plain = big.join(small, ["k"], how)
        rows = keyed_join(big, small, ["k"], how).select(*plain.columns).collect()
        assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_without(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "url string, seq int")
    known = spark.createDataFrame([("b",), ("c",), ("b",)], "url string")
    assert [tuple(r) for r in without(new, known, "url").collect()] == [("a", 1)]
