"""Clauses that stand for terms of the dictionary, phrases over neighbours, batches in blocks, and an index that grows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roamdex.operators import batch_search as bs
from roamdex.operators import postings as po
from roamdex.operators import search as se
from roamdex.operators.postings import FieldSpec, Index
from roamdex.operators.search import FUZZY, MUST, MUST_NOT, PHRASE, PREFIX, RANGE, WILDCARD, Clause
from roamdex.operators.segments import SegmentedIndex

SPECS = (FieldSpec("title", positions=True), FieldSpec("link", analyzer="keyword"), FieldSpec("body", neighbours=True))
SCHEMA = "doc_id string, title string, link string, body string"


def word(rng):
    return "".join(rng.choice("abc") for _ in range(rng.randrange(1, 7)))


def documents(n=120, seed=3):
    rng = random.Random(seed)
    some = [word(rng) for _ in range(60)] + ["é", "über", "a.b", "it's"]
    return [
        (f"d{i:03d}", " ".join(rng.choices(some, k=rng.randrange(8))), f"https://{rng.choice(['en', 'de'])}.x/{i}",
         " ".join(rng.choices(some[:7], k=rng.randrange(40))))
        for i in range(n)
    ]


DOCS = documents()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    path = str(tmp_path_factory.mktemp("index"))
    Index.build(docs, SPECS).write(path)
    return Index.read(spark, path, SPECS, docs)


@pytest.fixture(scope="module")
def live(spark):
    return Index.build(spark.createDataFrame(DOCS, SCHEMA), SPECS)


def tokens(text):
    return [t for t in re.split(r" +", text.lower()) if t]


def distance(a, b):
    """Edits and swaps of neighbours, each part edited once."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if i * j == 0}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def having(test, field=1):
    return {d[0] for d in DOCS if any(test(t) for t in tokens(d[field]))}


def hits(index, *clauses):
    return {r.doc_id for r in se.search(index, clauses).collect()}


TESTS = [
    *[(Clause(w, kind=FUZZY, edits=e), lambda t, w=w, e=e: distance(t, w) <= e) for w, e in (("abc", 1), ("cabab", 1), ("bacbca", 2), ("ueber", 2), ("a", 1))],
    (Clause("abcb", kind=FUZZY, edits=1, transpositions=False), lambda t: distance(t, "abcb") <= 1 and not (sorted(t) == sorted("abcb") and t != "abcb")),
    *[(Clause(p, kind=WILDCARD), lambda t, p=p: re.fullmatch(p.replace(".", r"\.").replace("*", ".*").replace("?", "."), t)) for p in ("*b", "a?c*", "*", "??", "*ba*c", "a.?")],
    (Clause("ab", kind=PREFIX), lambda t: t.startswith("ab")),
    (Clause("b", kind=RANGE, high="c", high_inclusive=False), lambda t: "b" <= t < "c"),
    (Clause("zzz", kind=WILDCARD), lambda t: t == "zzz"),
]


@pytest.mark.parametrize("most", [1_000, 2])
def test_expanded_clauses_are_plain(stored, live, monkeypatch, most):
    """Lists in the plan and joined tables, over a stored dictionary and over documents, give the same."""
    monkeypatch.setattr(se, "MOST_LISTED", most)
    for clause, test in TESTS:
        expected = having(test)
        assert hits(stored, clause) == expected, clause
        if most > 2:
            assert hits(live, clause) == expected, clause


@pytest.mark.parametrize("most", [1_000, 2])
def test_expanded_clauses_together(stored, monkeypatch, most):
    monkeypatch.setattr(se, "MOST_LISTED", most)
    a, b, c = having(lambda t: t.startswith("a")), having(lambda t: distance(t, "cab") <= 1), having(lambda t: t.endswith("c"))
    links = {d[0] for d in DOCS if d[2].startswith("https://en.")}
    clauses = [Clause("a", kind=PREFIX), Clause("cab", kind=FUZZY, edits=1, boost=3.0), Clause("*c", kind=WILDCARD, occur=MUST_NOT)]
    got = {r.doc_id: r.score for r in se.search(stored, clauses).collect()}
    assert got == {d: (d in a) + 3.0 * (d in b) for d in (a | b) - c}
    assert hits(stored, Clause("a*", kind=WILDCARD, occur=MUST), Clause("https://en.", "link", PREFIX, MUST)) == a & links


def test_expansion_reads_the_dictionary(stored):
    """Terms are found in the gram table by equal grams, and reach the postings as a list that the reader sees."""
    found = se.expansion(stored, Clause("*bab*", kind=WILDCARD), lambda f, t: t.rlike("bab"), True)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "gram" in text and "positions" not in text and re.search(r"PushedFilters: \[.*gram", text)
    text = se.search(stored, [Clause("*bab*", kind=WILDCARD)])._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" not in text and "levenshtein" not in text and re.search(r"PushedFilters: \[.*term", text)


@pytest.mark.parametrize("way", ["stored", "live"])
def test_phrases_over_neighbours(request, way):
    index = request.getfixturevalue(way)
    rng = random.Random(1)
    texts = {d[0]: tokens(d[3]) for d in DOCS}
    phrases = [rng.choice([t for t in texts.values() if len(t) > 9])[k : k + n] for k, n in ((0, 2), (3, 2), (2, 3), (4, 3), (1, 4))]
    phrases.append([phrases[0][0]] * 2)
    for phrase in phrases:
        counts = {d: sum(t[i : i + len(phrase)] == phrase for i in range(len(t))) for d, t in texts.items()}
        got = {r.doc_id: r.score for r in se.search(index, [Clause(" ".join(phrase), "body", PHRASE)]).collect()}
        assert set(got) == {d for d, n in counts.items() if n}
        # Of documents of one length, the one with more occurrences scores more.
        by_count = {(len(texts[d]), counts[d]): s for d, s in got.items()}
        assert all(by_count[k] < by_count[m] for k in by_count for m in by_count if k[0] == m[0] and k[1] < m[1])
    both = hits(index, Clause(" ".join(phrases[0]), "body", PHRASE, MUST), Clause(phrases[1][0], "body", occur=MUST))
    assert both == {d for d, t in texts.items() if phrases[1][0] in t and any(t[i : i + 2] == phrases[0] for i in range(len(t)))}


def test_phrases_need_positions_or_neighbours(spark):
    plain = Index.build(spark.createDataFrame(DOCS, SCHEMA), (FieldSpec("body"),))
    with pytest.raises(ValueError, match="neighbours"):
        se.search(plain, [Clause("a b", "body", PHRASE)])


def queries_of(spark, seed=5, required=False):
    rng = random.Random(seed)
    rows = []
    for q in range(12):
        ts = rng.sample(tokens(" ".join(d[3] for d in DOCS)), rng.randrange(1, 6))
        rows += [(q, "body", t, required and k == 0) for k, t in enumerate(dict.fromkeys(ts))]
    return rows, spark.createDataFrame(rows, "query_id int, field string, term string, required boolean")


@pytest.mark.parametrize("required", [False, True])
@pytest.mark.parametrize("n", [1, 5, None])
def test_batches_are_single_searches(spark, stored, live, monkeypatch, required, n):
    monkeypatch.setattr(bs, "BLOCK_DOCS", 4)
    rows, asked = queries_of(spark, required=required)
    single = {}
    for q in range(12):
        clauses = [Clause(t, f, occur=MUST if r else se.SHOULD) for i, f, t, r in rows if i == q]
        found = se.search(stored, clauses)
        single[q] = {r.doc_id: round(r.score, 9) for r in (se.top_hits(found, n) if n else found).collect()}
    for index in (stored, live):
        got = {q: {} for q in range(12)}
        for r in bs.search_batch(index, asked, n).collect():
            got[r.query_id][r.doc_id] = round(r.score, 9)
        assert got == single


def test_blocks_are_passed_over(spark, stored, monkeypatch):
    """Fewer blocks than all are live where one document is far better than the rest."""
    monkeypatch.setattr(bs, "BLOCK_DOCS", 4)
    asked, parts = bs.asked_postings(stored, queries_of(spark)[1])
    impacts = bs.impact_blocks(parts)
    live = bs.live_blocks(asked, impacts, bs.floors(asked, parts, 1)).count()
    every = impacts.join(asked, ["field", "term"]).select("query_id", "block").distinct().count()
    assert 12 <= live < every / 2


def test_batches_under_a_prefix(spark, live):
    _, asked = queries_of(spark)
    every = {(r.query_id, r.doc_id): round(r.score, 9) for r in bs.search_batch(live, asked).collect()}
    under = {d[0] for d in DOCS if d[2].startswith("https://de.")}
    got = bs.search_batch(live, asked, 200, [Clause("https://de.", "link", PREFIX, boost=2.0)]).collect()
    assert {(r.query_id, r.doc_id): round(r.score, 9) for r in got} == {k: round(s + 2, 9) for k, s in every.items() if k[1] in under}
    with pytest.raises(ValueError, match="prefixes"):
        bs.search_batch(live, asked, 5, [Clause("a")])


@pytest.mark.parametrize("most_segments", [16, 2])
def test_segments_are_an_index_built_anew(spark, tmp_path, most_segments):
    rng = random.Random(most_segments)
    specs = (FieldSpec("title", positions=True), FieldSpec("link", analyzer="keyword"))
    grown = SegmentedIndex(spark, str(tmp_path / "grown"), specs, most_segments)
    now = {}
    for step in range(4):
        gone = {d: now[d] for d in rng.sample(sorted(now), len(now) // 3)}
        new = {d[0]: d for d in documents(40, seed=step)[step * 5 : step * 5 + 25] if d[0] not in now or d[0] in gone}
        added, deleted = (spark.createDataFrame(list(x.values()), SCHEMA) if x else None for x in (new, gone))
        assert grown.change(added, deleted) == step + 1
        now = {**{d: r for d, r in now.items() if d not in gone}, **new}
    # A segment that was not ended is no part of the index.
    (tmp_path / "grown" / "seg=9" / "postings").mkdir(parents=True)
    index, anew = grown.index(), Index.build(spark.createDataFrame(list(now.values()), SCHEMA), specs)
    merged = len([p for p in (tmp_path / "grown").iterdir() if p.name.startswith("merged")])
    assert merged == (0 if most_segments > 4 else 1 if merged == 1 else 2)
    for table, keys in (("postings", ["field", "term", "doc_id", "tf", "doc_len"]), ("terms", ["field", "term", "df", "cf"]), ("fields", ["field", "n_docs", "total_len"])):
        rows = [sorted(map(tuple, getattr(i, table).select(*keys).collect())) for i in (index, anew)]
        assert rows[0] == rows[1], table
    asked = [Clause("a*", kind=WILDCARD), Clause("abc", kind=FUZZY), Clause("ab")]
    assert [{r.doc_id: round(r.score, 9) for r in se.search(i, asked).collect()} for i in (index, anew)][0] == {
        r.doc_id: round(r.score, 9) for r in se.search(anew, asked).collect()
    }
    plan = se.search(index, [Clause("ab")])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[.*term.*ab", plan)


def test_grams(spark):
    row = spark.range(1).select(po.grams_of(F.lit("aba")).alias("g"), po.grams_of(F.lit("é")).alias("h")).first()
    assert row["g"] == ["\x02a", "ab", "ba", "a\x03"] and row["h"] == ["\x02é", "é\x03"]
