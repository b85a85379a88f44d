import math
import random

import pytest
from pyspark.sql import functions as F

from roamdex.operators import batch_search as bs
from roamdex.operators import search as se
from roamdex.operators.postings import DOCUMENT_FIELDS, FieldSpec, Index
from roamdex.operators.search import Clause

WORDS = ["old", "town", "of", "new", "bay", "port", "st"]
SPECS = (FieldSpec("title", positions=True), FieldSpec("link", analyzer="keyword"))


def collection(n=60, seed=1):
    rng = random.Random(seed)
    return [
        (f"d{i:02d}", f"https://{rng.choice(['en', 'de'])}.x/{i}", " ".join(rng.choices(WORDS, k=rng.randrange(1, 9))))
        for i in range(n)
    ]


DOCS = collection()


def bm25(docs, term):
    """Plain BM25 of one term, per document."""
    toks = {d: t.split() for d, _, t in docs}
    avg = sum(map(len, toks.values())) / len(toks)
    df = sum(term in t for t in toks.values())
    idf = math.log(1 + (len(toks) - df + 0.5) / (df + 0.5))
    return {
        d: idf * t.count(term) / (t.count(term) + 1.2 * (0.25 + 0.75 * len(t) / avg)) for d, t in toks.items() if term in t
    }


@pytest.fixture(scope="module", params=["live", "stored"])
def index(request, spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, "doc_id string, link string, title string")
    live = Index.build(docs, SPECS)
    return live if request.param == "live" else live.stored(str(tmp_path_factory.mktemp("index")))


def run(index, *clauses):
    return {r.doc_id: round(r.score, 9) for r in se.search(index, clauses).collect()}


def total(*parts, need=None):
    out = {}
    for part in parts:
        for d, s in part.items():
            out[d] = out.get(d, 0) + s
    return {d: round(s, 9) for d, s in out.items() if need is None or need(d)}


def test_terms(index):
    old, bay = bm25(DOCS, "old"), bm25(DOCS, "bay")
    assert run(index, Clause("Old")) == total(old)
    assert run(index, Clause("old"), Clause("bay", boost=2)) == total(old, {d: 2 * s for d, s in bay.items()})
    assert run(index, *se.all_of(Clause("old"), Clause("bay"))) == total(old, bay, need=lambda d: d in old and d in bay)
    assert run(index, Clause("old"), Clause("bay", occur=se.MUST_NOT)) == total(old, need=lambda d: d not in bay)
    assert run(index, Clause("nowhere")) == {}
    assert run(index, Clause("old-bay")) == total(old, bay)


def test_prefix_and_keyword_field(index):
    en = {d for d, u, _ in DOCS if u.startswith("https://en.")}
    assert run(index, Clause("https://en.", "link", se.PREFIX)) == dict.fromkeys(en, 1.0)
    old = bm25(DOCS, "old")
    got = run(index, *se.all_of(Clause("old"), Clause("https://en.", "link", se.PREFIX)))
    assert got == {d: round(s + 1, 9) for d, s in old.items() if d in en}
    assert set(run(index, Clause(DOCS[0][1], "link"))) == {DOCS[0][0]}
    last = run(index, *se.keyword_clauses("old new bay", "https://en."))
    assert set(last) == {d for d in bm25(DOCS, "bay") if d in en}


def test_phrase(index):
    hits = {d: sum(t.split()[i : i + 2] == ["old", "town"] for i in range(8)) for d, _, t in DOCS}
    toks = {d: t.split() for d, _, t in DOCS}
    avg = sum(map(len, toks.values())) / len(toks)
    idf = 0
    for w in ("old", "town"):
        df = sum(w in t for t in toks.values())
        idf += math.log(1 + (len(toks) - df + 0.5) / (df + 0.5))
    want = {
        d: round(idf * f / (f + 1.2 * (0.25 + 0.75 * len(toks[d]) / avg)), 9) for d, f in hits.items() if f
    }
    assert want and run(index, Clause("Old town", kind=se.PHRASE)) == want
    same = {d for d, _, t in DOCS if "bay bay" in t}
    assert set(run(index, Clause("bay bay", kind=se.PHRASE))) == same
    assert run(index, Clause("bay", kind=se.PHRASE)) == total(bm25(DOCS, "bay"))


def test_many_term_kinds(index):
    def having(test):
        return {d for d, _, t in DOCS if any(map(test, t.split()))}

    assert set(run(index, Clause("?o*", kind=se.WILDCARD))) == having(lambda w: len(w) > 1 and w[1] == "o")
    assert set(run(index, Clause("bray", kind=se.FUZZY))) == having(lambda w: w in ("bay",))
    assert set(run(index, Clause("prto", kind=se.FUZZY))) == having(lambda w: w in ("port",))
    assert set(run(index, Clause("otwn", kind=se.FUZZY, edits=1))) == having(lambda w: w == "town")
    assert run(index, Clause("otwn", kind=se.FUZZY, edits=1, transpositions=False)) == {}
    assert set(run(index, Clause("port", kind=se.RANGE))) == having(lambda w: w >= "port")
    assert set(run(index, Clause(None, kind=se.RANGE, high="new"))) == having(lambda w: w <= "new")
    assert set(run(index, Clause("new", kind=se.RANGE, high="port", high_inclusive=False))) == having(lambda w: "new" <= w < "port")
    assert set(run(index, Clause("new", kind=se.RANGE, high="of"))) == having(lambda w: "new" <= w <= "of")
    assert set(run(index, Clause("new", kind=se.RANGE, high="port", inclusive=False))) == having(lambda w: "new" < w < "port")


def test_groups(index):
    old, bay, of = (bm25(DOCS, w) for w in ("old", "bay", "of"))
    either = se.Group((Clause("old"), Clause("bay")), se.MUST, 2.0)
    want = total({d: 2 * s for d, s in old.items()}, {d: 2 * s for d, s in bay.items()}, of, need=lambda d: d in of and (d in old or d in bay))
    assert run(index, either, Clause("of", occur=se.MUST)) == want
    both = se.Group(tuple(se.all_of(Clause("old"), Clause("bay"))), se.MUST_NOT)
    assert run(index, Clause("of"), both) == total(of, need=lambda d: not (d in old and d in bay))
    assert run(index, se.Group((se.Group((Clause("of"),)), Clause("--")))) == total(of)


def test_edit_distance_with_swaps(spark):
    def distance(a, b):
        rows = [list(range(len(b) + 1))]
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    row[-1] = min(row[-1], rows[-2][j - 2] + 1)
            rows.append(row)
        return rows[-1][-1]

    rng = random.Random(6)
    terms = sorted({"".join(rng.choices("abé", k=rng.randrange(1, 6))) for _ in range(200)})
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    for word, edits in (("abca", 2), ("éa", 1), ("ba", 2)):
        got = {r.t for r in df.where(se.within_edits(F.col("t"), word, edits)).collect()}
        assert got == {t for t in terms if distance(t, word) <= edits}


def test_bad_queries(index):
    with pytest.raises(ValueError, match="not must_not"):
        se.search(index, [Clause("old", occur=se.MUST_NOT)])
    with pytest.raises(ValueError, match="positions"):
        se.search(index, [Clause("a b", "other", se.PHRASE)])


def test_top_hits_break_ties_by_id(index):
    hits = se.top_hits(se.search(index, [Clause("of")]), 5).collect()
    best = sorted(bm25(DOCS, "of").items(), key=lambda x: (-round(x[1], 9), x[0]))[:5]
    assert [r.doc_id for r in hits] == [d for d, _ in best]


def test_hit_counts(index, spark):
    keys = ["Old Town", "bay", "Bay", "port-bay", "x St. !", "nowhere", "--", "bay"]
    got = {r.keyword: r.hits for r in bs.hit_counts(index, spark.createDataFrame([(k,) for k in keys], "keyword string")).collect()}
    en = [t.split() for _, u, t in DOCS if u.startswith("https://en.")]
    n = lambda *ws: sum(any(w in t for w in ws) for t in en)
    assert got == {
        "Old Town": n("town"), "bay": n("bay"), "Bay": n("bay"), "port-bay": n("port", "bay"), "x St. !": n("st"),
        "nowhere": 0, "--": 0,
    }
    for key in ("Old Town", "bay --", "--"):
        assert se.search(index, se.keyword_clauses(key, "https://en.")).count() == got.get(key, got.get(key.split()[0], 0))


def test_search_batch(index, spark):
    rows = [(1, "title", "old", True), (1, "title", "bay", False), (2, "title", "of", False), (3, "title", "zz", False)]
    queries = spark.createDataFrame(rows, "query_id int, field string, term string, required boolean")
    got = bs.search_batch(index, queries, 4).orderBy("query_id", "rank").collect()
    old, bay = bm25(DOCS, "old"), bm25(DOCS, "bay")
    one = total(old, bay, need=lambda d: d in old)
    best = lambda m: [d for d, _ in sorted(m.items(), key=lambda x: (-x[1], x[0]))[:4]]
    assert [(r.query_id, r.doc_id) for r in got] == [(1, d) for d in best(one)] + [
        (2, d) for d in best(total(bm25(DOCS, "of")))
    ]


def test_batch_scores_few_documents(spark):
    """With rare and common terms, only documents that can be among the best are scored, and the result is that of all."""
    rng = random.Random(9)
    docs = [(f"{i:04d}", " ".join(["the", "of"] * rng.randrange(1, 3) + rng.choices(["x", "y", "z"], k=2) + [f"r{rng.randrange(150)}"])) for i in range(1500)]
    index = Index.build(spark.createDataFrame(docs, "doc_id string, title string"), SPECS[:1])
    rows = [(q, "title", t, False) for q in range(20) for t in ("the", "of", f"r{q}", f"r{q + 40}")]
    queries = spark.createDataFrame(rows, "query_id int, field string, term string, required boolean")
    best = {(r.query_id, r.rank): r.doc_id for r in bs.search_batch(index, queries, 5).collect()}
    every = {}
    for r in bs.search_batch(index, queries).collect():
        every.setdefault(r.query_id, []).append((-round(r.score, 9), r.doc_id))
    assert best == {(q, k + 1): d for q, hits in every.items() for k, (_, d) in enumerate(sorted(hits)[:5])}
    pairs = bs.candidates(*bs.asked_postings(index, queries), 5).count()
    assert pairs < 0.05 * sum(map(len, every.values()))


def test_batch_moves_postings_by_block_only(spark, monkeypatch):
    """Beside few queries postings are dealt by block and added up there; many queries give the same hits."""
    rng = random.Random(5)
    docs = [(f"{i:04d}", " ".join(rng.choices([*WORDS, "r1", "r2", "r3"], k=6))) for i in range(400)]
    index = Index.build(spark.createDataFrame(docs, "doc_id string, title string"), SPECS[:1])
    rows = [(q, "title", t, q % 4 == 0) for q in range(12) for t in rng.sample(WORDS, 3)] + [(None, "title", "bay", False)]
    queries = spark.createDataFrame(rows, "query_id int, field string, term string, required boolean")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = bs.search_batch(index, queries, 5)
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(block" in plan and "hashpartitioning(field" not in plan
        few = sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in few.collect())
        monkeypatch.setattr(bs, "SMALL_ROWS", 0)
        assert sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in bs.search_batch(index, queries, 5).collect()) == few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_stored_fields_of_hits(spark):
    rows = [("1", "u", "Old bay", 1, ["A", "B"], {"See": "x"}, "rest", {"capital": "C"})]
    docs = spark.createDataFrame(
        rows,
        "doc_id string, link string, title string, num_cat int, categories array<string>, "
        "paragraphs map<string,string>, other string, extra map<string,string>",
    )
    index = Index.build(docs, DOCUMENT_FIELDS)
    hits = se.search(index, [Clause("c", "capital", occur=se.MUST), Clause("A", "categories", occur=se.MUST)])
    value = lambda name: [r.value for r in se.project_hits(hits, docs, name).collect()]
    assert value("capital") == ["C"] and value("See") == ["x"] and value("title") == ["Old bay"] and value("none") == [None]
    assert value("categories") == ["A"] and value("id") == ["1"]
    assert sorted(value("all_fields")) == ["See", "capital", "categories", "categories", "id", "link", "other", "title"]
    assert se.search(index, [Clause("a", "categories")]).count() == 0
    assert se.search(index, [Clause("rest", "other")]).select(F.col("doc_id")).count() == 1
