"""Scored search with a list of clauses."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamdex import fixed
from roamdex.functions import text
from roamdex.operators.postings import BEGIN, END, Index, Test, field_terms
from roamdex.session import cut_lineage

MUST, SHOULD, MUST_NOT = "must", "should", "must_not"
TERM, PHRASE, PREFIX, WILDCARD, FUZZY, RANGE = "term", "phrase", "prefix", "wildcard", "fuzzy", "range"


@dataclass(frozen=True)
class Clause:
    """One part of a query. ``text`` is analysed as its field is; ``high`` closes a range.

    A term clause whose text gives several tokens matches any of them. Term and phrase clauses score by
    BM25, all other kinds by their boost. A range without ``text`` or ``high`` is open at that end; ``inclusive`` holds
    for both ends unless ``high_inclusive`` says otherwise. A fuzzy clause allows ``edits`` insertions, deletions,
    changes and, with ``transpositions``, swaps of neighbours.
    """

    text: str | None
    field: str = "title"
    kind: str = TERM
    occur: str = SHOULD
    boost: float = 1.0
    high: str | None = None
    inclusive: bool = True
    high_inclusive: bool | None = None
    edits: int = fixed.FUZZY_EDITS
    transpositions: bool = True


@dataclass(frozen=True)
class Group:
    """Clauses and groups that count as one clause: ``(a OR b) AND c`` is ``[Group((a, b), MUST), c with MUST]``.

    The same rules hold inside as for a whole query. A group scores what its parts do, times its boost.
    """

    clauses: tuple[Clause | Group, ...]
    occur: str = SHOULD
    boost: float = 1.0


def all_of(*clauses: Clause | Group) -> list[Clause | Group]:
    """AND of clauses."""
    return [replace(c, occur=MUST) if c.occur == SHOULD else c for c in clauses]


def keyword_clauses(keyword: str, prefix: str, field: str = "title", prefix_field: str = "link") -> list[Clause]:
    """The clauses of ``field:w1 w2 ... wn AND prefix``: AND makes its two neighbours required, so of the
    words only the last is; the others raise the score. The last word is the last one that has a token; a keyword
    without any has no hits."""
    words = keyword.split()
    row = SparkSession.active().sql("select 1").select(F.array(*[F.size(text.tokens(F.lit(w))) for w in words]).alias("n"))
    last = max((i for i, n in enumerate(row.first()["n"] or []) if n), default=None)
    terms = [Clause(w, field, occur=MUST if i == last else SHOULD) for i, w in enumerate(words)]
    if last is None:
        terms = [Clause("", field, WILDCARD, MUST)]
    return [*terms, Clause(prefix, prefix_field, PREFIX, MUST)]


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def tf_norm(tf: Column, doc_len: Column, avg_len: Column) -> Column:
    k1, b = fixed.BM25_K1, fixed.BM25_B
    return tf / (tf + k1 * (1 - b + b * doc_len / avg_len))


def _analysed(index: Index, clauses: Sequence[Clause]) -> list[list[str]]:
    """Query terms of each term or phrase clause, by the same expression the documents went through."""
    spark = index.postings.sparkSession
    standard = [
        c.kind in (TERM, PHRASE) and index.analyzer(c.field) == "standard" for c in clauses
    ]
    # One row of literals, which the optimizer works out without a job.
    found = spark.sql("select 1").select(*[text.tokens(F.lit(c.text).cast("string")) for c in clauses]).first()
    return [found[i] if s else [c.text] for i, (c, s) in enumerate(zip(clauses, standard))]


def _glob(pattern: str) -> str:
    """Anchored regex of a ``*`` and ``?`` pattern."""
    parts = {"*": ".*", "?": "."}
    return r"(?s)\A" + "".join(parts.get(ch, re.sub(r"([^\w])", r"\\\1", ch)) for ch in pattern) + r"\z"


def within_edits(term: Column, word: str, edits: int) -> Column:
    """Whether ``term`` is at most ``edits`` edits or swaps of neighbours (each part edited once) from ``word``.

    The table of distances is filled by the characters of the term, for the few terms that need it: the last two rows
    and the last character are carried along.
    """
    letters = F.transform(F.sequence(F.lit(1), F.length(term)), lambda i: F.substring(term, i, 1))
    first = F.array(*[F.lit(j) for j in range(len(word) + 1)])
    start = F.struct(first.alias("two"), first.alias("one"), F.lit("").alias("last"), F.lit(0).alias("n"))

    def row(state: Column, letter: Column) -> Column:
        cells = [F.get(state["one"], F.lit(0)) + 1]
        for j, w in enumerate(word, 1):
            change = F.get(state["one"], F.lit(j - 1)) + F.when(letter == w, 0).otherwise(1)
            best = [F.get(state["one"], F.lit(j)) + 1, cells[-1] + 1, change]
            if j > 1:
                swap = (state["n"] > 0) & (letter == word[j - 2]) & (state["last"] == w)
                best.append(F.when(swap, F.get(state["two"], F.lit(j - 2)) + 1))
            cells.append(F.least(*best))
        return F.struct(state["one"].alias("two"), F.array(*cells).alias("one"), letter.alias("last"), (state["n"] + 1).alias("n"))

    table = F.aggregate(letters, start, row)
    exact = F.get(table["one"], F.lit(len(word))) <= edits
    # Beyond the plain distance a swap has to be in it, so two neighbours of the word stand in the term the other way round.
    swaps = {word[i + 1] + word[i] for i in range(len(word) - 1) if word[i] != word[i + 1]}
    swapped = reduce(or_, [F.contains(term, F.lit(s)) for s in sorted(swaps)], F.lit(False))
    possible = swapped & (F.abs(F.length(term) - len(word)) < edits)
    return F.when(F.levenshtein(term, F.lit(word), edits) >= 0, True).when(possible, exact).otherwise(False)


def _test(clause: Clause, terms: list[str], standard: bool) -> Test:
    """What a posting must be to count for a clause."""
    low, high = clause.text, clause.high
    if standard:
        low, high = low.lower() if low is not None else low, high.lower() if high is not None else high

    def in_range(term: Column) -> Column:
        tests = [F.lit(True)]
        if low is not None:
            tests.append(term >= low if clause.inclusive else term > low)
        if high is not None:
            closed = clause.inclusive if clause.high_inclusive is None else clause.high_inclusive
            tests.append(term <= high if closed else term < high)
        return reduce(and_, tests)

    def holds(term: Column) -> Column:
        if clause.kind in (TERM, PHRASE):
            return term.isin(terms)
        if clause.kind == PREFIX:
            return F.startswith(term, F.lit(low))
        if clause.kind == WILDCARD:
            return F.startswith(term, F.lit(re.split(r"[*?]", low)[0])) & term.rlike(_glob(low))
        if clause.kind == FUZZY:
            if clause.transpositions:
                return within_edits(term, low, clause.edits)
            return F.levenshtein(term, F.lit(low), clause.edits) >= 0
        if clause.kind == RANGE:
            return in_range(term)
        raise ValueError(f"unknown clause kind {clause.kind}")

    return lambda field, term: (field == clause.field) & holds(term)


def _leaves(clauses: Sequence[Clause | Group]) -> list[Clause]:
    return [leaf for c in clauses for leaf in (_leaves(c.clauses) if isinstance(c, Group) else [c])]


def _pruned(clauses: Sequence[Clause | Group], terms: dict[int, list[str]]) -> list[Clause | Group]:
    """The query without clauses that have no terms, and without groups left empty by that."""
    out = []
    for c in clauses:
        if isinstance(c, Group):
            inner = _pruned(c.clauses, terms)
            if inner:
                out.append(replace(c, clauses=tuple(inner)))
        elif terms[id(c)]:
            out.append(c)
    return out


def _check(clauses: Sequence[Clause | Group]) -> None:
    if all(c.occur == MUST_NOT for c in clauses):
        raise ValueError("a query needs a clause with terms that is not must_not")
    for c in clauses:
        if isinstance(c, Group):
            _check(c.clauses)


#: Terms that a clause may stand for as a list in the plan; more are joined as a table.
MOST_LISTED = 1_000


def _literal_grams(pattern: str) -> list[str]:
    """Pairs of neighbouring characters that every term of a ``*`` and ``?`` pattern has, its ends marked."""
    runs = re.split(r"[*?]", BEGIN + pattern + END)
    return sorted({run[i : i + 2] for run in runs for i in range(len(run) - 1)})


def expansion(index: Index, clause: Clause, test: Test, standard: bool) -> DataFrame | None:
    """``term``: what a wildcard, fuzzy, prefix or range clause stands for in the index's dictionary.

    Wildcards and fuzzy words find the terms that share enough pairs of characters by the gram table, and test only those.
    An edit takes at most two of a word's pairs, a swap of neighbours three. Where that leaves none to ask for, the
    dictionary is tested, cut to the lengths or the beginning that the clause allows.
    """
    terms = index.dictionary(clause.field)
    if terms is None:
        return None
    if not standard and clause.kind in (PREFIX, RANGE):
        return None  # values of their own, as many as documents: a range of the postings' order
    word = (clause.text or "").lower() if standard else clause.text or ""
    some = None
    if clause.kind == WILDCARD:
        grams = _literal_grams(word)
        some = index.with_grams(clause.field, grams, len(grams)) if grams else None
        if some is None:
            some = terms.filter(F.startswith("term", F.lit(re.split(r"[*?]", word)[0])))
    elif clause.kind == FUZZY:
        grams = _literal_grams(re.sub(r"[*?]", "\x01", word))
        least = len(grams) - (3 if clause.transpositions else 2) * clause.edits
        if least > 0 and not re.search(r"[*?]", word):
            some = index.with_grams(clause.field, grams, least)
        if some is None:
            some = terms
        some = some.filter(F.length("term").between(len(word) - clause.edits, len(word) + clause.edits))
    else:
        some = terms
    return some.filter(test(F.lit(clause.field), F.col("term"))).select("term").distinct()


def _expanded(index: Index, kept: list[tuple[Clause, list[str]]], tests: list[Test]) -> tuple[dict[int, list[str]], dict[int, DataFrame]]:
    """Terms of the clauses that the dictionary can list, and tables of those that have too many."""
    tables = {}
    for i, (c, _) in enumerate(kept):
        if c.kind not in (TERM, PHRASE):
            found = expansion(index, c, tests[i], index.analyzer(c.field) == "standard")
            if found is not None:
                tables[i] = found.select(F.lit(i).alias("i"), F.lit(c.field).alias("field"), "term")
    if not tables:
        return {}, {}
    every = cut_lineage(reduce(DataFrame.unionByName, tables.values()))
    sizes = {r["i"]: r["count"] for r in every.groupBy("i").count().collect()}
    listed = [i for i in tables if sizes.get(i, 0) <= MOST_LISTED]
    lists = {i: [] for i in listed}
    for r in every.where(F.col("i").isin(listed)).collect():
        lists[r["i"]].append(r["term"])
    # Beginnings and ranges of terms are ranges of the postings' order, which the reader finds by itself.
    joined = {i: every.where(F.col("i") == i).select("field", "term") for i in tables if i not in lists and kept[i][0].kind in (WILDCARD, FUZZY)}
    return lists, joined


def _listed(field_: str, terms: list[str]) -> Test:
    return lambda field, term: (field == field_) & (term.isin(terms) if terms else F.lit(False))


def search(index: Index, clauses: Sequence[Clause | Group]) -> DataFrame:
    """``doc_id, score`` of every matching document.

    One pass over the postings the clauses can match (field and term tests reach the parquet reader of a
    stored index), one shuffle by document. Wildcard, fuzzy, prefix and range clauses are turned into the terms they
    stand for by the index's dictionary first, and reach the postings as those. Where an exact clause is required,
    prefixes and the like are tested on the documents that have it only. Term statistics join in for the query's own
    terms only, at most one row per term asked for, which bounds their broadcast.
    """
    leaves = _leaves(clauses)
    analysed = {id(c): ts or ([""] if c.kind not in (TERM, PHRASE) else []) for c, ts in zip(leaves, _analysed(index, leaves))}
    query = _pruned(clauses, analysed)
    _check(query)
    kept = [(c, analysed[id(c)]) for c in _leaves(query)]
    for c, ts in kept:
        if c.kind == PHRASE and len(ts) > 1 and not (index.has_positions(c.field) or index.has_neighbours(c.field)):
            raise ValueError(f"field {c.field} is indexed without positions or neighbours")
    tests = [_test(c, ts, index.analyzer(c.field) == "standard") for c, ts in kept]

    def any_of(some: Sequence[Test]) -> Test:
        return lambda field, term: reduce(or_, [t(field, term) for t in some])

    fields = sorted({c.field for c, _ in kept})
    exact = [(c.field, t) for c, ts in kept if c.kind in (TERM, PHRASE) for t in ts]
    scored_fields, terms = sorted({f for f, _ in exact}), sorted({t for _, t in exact})
    exact_tests = [t for t, (c, _) in zip(tests, kept) if c.kind in (TERM, PHRASE)]
    needed = [(c.field, analysed[id(c)]) for c in query if isinstance(c, Clause) and c.occur == MUST and c.kind in (TERM, PHRASE)]
    if len(exact_tests) == len(kept):
        rows = index.matching(any_of(tests), fields, terms)
    elif needed:
        rows = index.matching_where(any_of(tests), fields, (any_of(exact_tests), scored_fields, terms), needed[0])
    else:
        lists, joined = _expanded(index, kept, tests)
        for i, found in lists.items():
            tests[i] = _listed(kept[i][0].field, found)
        by_list = [tests[i] for i, (c, _) in enumerate(kept) if i in lists or c.kind in (TERM, PHRASE)]
        some = sorted({*terms, *(t for found in lists.values() for t in found)})
        parts = [index.matching(any_of(by_list), fields, some)] if some else []
        by_test = [i for i, (c, _) in enumerate(kept) if c.kind not in (TERM, PHRASE) and i not in lists and i not in joined]
        listed_test = any_of(by_list) if some else (lambda f, t: F.lit(False))
        if by_test:
            loose = any_of([tests[i] for i in by_test])
            parts.append(index.loosely_matching(lambda f, t: loose(f, t) & ~listed_test(f, t), fields))
        if joined:
            wanted = reduce(DataFrame.unionByName, joined.values()).distinct()
            already = any_of([listed_test, *[tests[i] for i in by_test]])
            wanted = wanted.where(~already(F.col("field"), F.col("term")))
            own = index.postings.filter(F.col("field").isin(sorted({kept[i][0].field for i in joined})))
            parts.append(own.join(wanted, ["field", "term"], "left_semi").select(*own.columns))
        if not parts:
            parts = [index.matching(lambda f, t: F.lit(False), fields, [])]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rows = rows.select("field", "term", "doc_id", "tf", "doc_len", "positions")
    statistics = index.statistics(scored_fields, terms) if exact else None
    if exact:
        rows = _weighted(rows, statistics)
    else:
        rows = rows.withColumn("_weight", F.lit(None).cast("double")).withColumns({"_idf": F.lit(None).cast("double"), "_avg": F.lit(None).cast("double")})
    by_pairs = {i: ts for i, (c, ts) in enumerate(kept) if c.kind == PHRASE and len(ts) > 1 and not index.has_positions(c.field)}
    for i, ts in by_pairs.items():
        rows = rows.unionByName(_phrase_rows(index, i, kept[i][0].field, ts, statistics), allowMissingColumns=True)
    field, term = F.col("field"), F.col("term")

    aggs = []
    for i, (c, ts) in enumerate(kept):
        here = tests[i](field, term)
        if i in by_pairs:
            aggs.append(F.max(f"_phrase{i}").alias(f"s{i}"))
        elif c.kind == PHRASE and len(ts) > 1:
            for j, t in enumerate(ts):
                slot = here & (term == t)
                aggs += [
                    F.max(F.when(slot, F.col("positions"))).alias(f"p{i}_{j}"),
                    F.max(F.when(slot, F.col("_idf"))).alias(f"w{i}_{j}"),
                ]
            aggs += [
                F.max(F.when(here, F.col("doc_len"))).alias(f"l{i}"),
                F.max(F.when(here, F.col("_avg"))).alias(f"a{i}"),
            ]
        elif c.kind in (TERM, PHRASE):
            aggs.append(F.sum(F.when(here, F.col("_weight"))).alias(f"s{i}"))
        else:
            aggs.append(F.max(F.when(here, F.lit(1.0))).alias(f"s{i}"))
    return _combined(rows.groupBy("doc_id").agg(*aggs), kept, query, set(by_pairs))


def _phrase_rows(index: Index, i: int, field: str, terms: list[str], statistics: DataFrame) -> DataFrame:
    """``doc_id`` and the phrase's score in it, from pairs of neighbours.

    Of two terms the pair's count is the phrase's. Of more, documents with all the pairs may have the phrase; their own
    texts tell, which are read for those documents only.
    """
    pairs = list(zip(terms, terms[1:]))
    found = index.neighbouring(field, sorted(set(pairs)))
    if len(pairs) > 1:
        spec = next(s for s in index.specs if s.name == field)
        whole = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(set(pairs))).select("doc_id")
        tokens = field_terms(index.texts(), [spec], index.text_id()).join(whole, "doc_id", "left_semi")
        starts = F.filter(
            F.sequence(F.lit(0), F.size("terms") - len(terms)),
            lambda at: F.slice("terms", at + 1, len(terms)) == F.array(*[F.lit(t) for t in terms]),
        )
        fits = F.when(F.size("terms") >= len(terms), F.size(starts)).otherwise(0)
        found = tokens.select("doc_id", fits.alias("tf"), F.size("terms").alias("doc_len")).where("tf > 0")
    else:
        found = found.select("doc_id", "tf", "doc_len")
    # One row of the field's and terms' figures.
    distinct = statistics.where((F.col("field") == field) & F.col("term").isin(terms))
    times = F.create_map(*[x for t in sorted(set(terms)) for x in (F.lit(t), F.lit(float(terms.count(t))))])
    weight = distinct.agg(
        F.struct(
            F.sum(idf(F.col("n_docs"), F.col("df")) * F.element_at(times, F.col("term"))).alias("w"),
            F.max(F.col("total_len") / F.col("n_docs")).alias("a"),
        )
    )
    scored = found.withColumn("_k", weight.scalar())
    return scored.select("doc_id", (F.col("_k.w") * tf_norm(F.col("tf"), F.col("doc_len"), F.col("_k.a"))).alias(f"_phrase{i}"))


def _weighted(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """Add ``_idf``, ``_avg`` and ``_weight`` to postings of the exact terms."""
    stats = statistics.select(
        "field",
        "term",
        idf(F.col("n_docs"), F.col("df")).alias("_idf"),
        (F.col("total_len") / F.col("n_docs")).alias("_avg"),
    )
    weight = F.col("_idf") * tf_norm(F.col("tf"), F.col("doc_len"), F.col("_avg"))
    return rows.join(F.broadcast(stats), ["field", "term"], "left").withColumn("_weight", weight)


def _shifted(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


def _combined(
    per_doc: DataFrame, kept: list[tuple[Clause, list[str]]], query: Sequence[Clause | Group], ready: set[int]
) -> DataFrame:
    """Clause scores to document scores, by occurrence rules. Phrases that are ``ready`` have theirs."""
    scored = per_doc
    for i, (c, ts) in enumerate(kept):
        if c.kind == PHRASE and len(ts) > 1 and i not in ready:
            starts = [_shifted(F.col(f"p{i}_{j}"), j) for j in range(len(ts))]
            scored = scored.withColumn(f"f{i}", F.size(reduce(F.array_intersect, starts)))
            weights = reduce(lambda a, b: a + b, [F.col(f"w{i}_{j}") for j in range(len(ts))])
            value = weights * tf_norm(F.col(f"f{i}"), F.col(f"l{i}"), F.col(f"a{i}"))
            scored = scored.withColumn(f"s{i}", F.when(F.col(f"f{i}") > 0, value))
    numbers = iter(range(len(kept)))

    def score_of(parts: Sequence[Clause | Group]) -> Column:
        """Score of a list of parts; null where it does not match."""
        values = [
            ((score_of(c.clauses) if isinstance(c, Group) else F.col(f"s{next(numbers)}")) * c.boost, c.occur) for c in parts
        ]
        must = [v.isNotNull() for v, o in values if o == MUST] + [v.isNull() for v, o in values if o == MUST_NOT]
        if not any(o == MUST for _, o in values):
            must.append(reduce(or_, [v.isNotNull() for v, o in values if o == SHOULD], F.lit(False)))
        total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v, o in values if o != MUST_NOT], F.lit(0.0))
        return F.when(reduce(and_, must), total)

    return scored.select("doc_id", score_of(query).alias("score")).where("score is not null")


def best_first() -> list[Column]:
    """Falling score, then document id. Scores are compared to nine decimals, so that copies of a document
    tie in whatever order their parts were added up."""
    return [F.round("score", 9).desc(), F.col("doc_id").asc()]


def top_hits(hits: DataFrame, n: int) -> DataFrame:
    """Best ``n`` hits."""
    return hits.orderBy(*best_first()).limit(n)


def hit_documents(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Stored documents of hits, with their scores."""
    return documents.join(hits, "doc_id")


def stored_fields() -> Column:
    """Names of the fields a hit prints under ``all_fields``: one per stored value."""
    return F.concat(
        F.transform("categories", lambda _: F.lit("categories")),
        F.map_keys("paragraphs"),
        F.map_keys("extra"),
        F.array(*[F.lit(n) for n in ("id", "link", "other", "title")]),
    )


def project_hits(hits: DataFrame, documents: DataFrame, output: str) -> DataFrame:
    """One output field of each hit, or with ``all_fields`` the names of all its fields."""
    found = hit_documents(hits, documents)
    if output == "all_fields":
        return found.select("doc_id", "score", F.explode(stored_fields()).alias("value"))
    if output == "categories":
        value = F.get("categories", F.lit(0))
    elif output == "id":
        value = F.col("doc_id")
    elif output in ("title", "link", "other"):
        value = F.col(output)
    else:
        value = F.coalesce(F.try_element_at("paragraphs", F.lit(output)), F.try_element_at("extra", F.lit(output)))
    return found.select("doc_id", "score", value.alias("value"))
