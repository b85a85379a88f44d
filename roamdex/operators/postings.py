"""Postings and term statistics of a document table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roamdex.functions import text
from roamdex.session import cut_lineage
from roamdex.sources.readers import path_exists

SCALAR, ARRAY, MAP = "scalar", "array", "map"


@dataclass(frozen=True)
class FieldSpec:
    """How a document column is indexed.

    ``standard`` text is cut into tokens, ``keyword`` values are terms as they stand. A map column gives one
    field per key. Phrase clauses need ``positions``, or ``neighbours``: pairs of neighbouring terms, which take far
    less room in a field of long texts.
    """

    name: str
    analyzer: str = "standard"
    shape: str = SCALAR
    positions: bool = False
    column: str | None = None
    neighbours: bool = False

    @property
    def source(self) -> Column:
        return F.col(self.column or self.name)

    def analysed(self, value: Column) -> Column:
        """Terms of one value; a missing value has none."""
        return text.tokens(value) if self.analyzer == "standard" else F.array_compact(F.array(value))

    def entries(self) -> Column:
        """Array of (field, terms) structs this column adds to a document."""
        if self.shape == MAP:
            return F.transform(
                F.map_entries(self.source), lambda e: _entry(e["key"], self.analysed(e["value"]))
            )
        terms = F.array_compact(self.source) if self.shape == ARRAY else self.analysed(self.source)
        return F.array(_entry(F.lit(self.name), terms))


def _entry(field: Column, terms: Column) -> Column:
    return F.struct(field.alias("field"), terms.alias("terms"))


DOCUMENT_FIELDS = (
    FieldSpec("title", positions=True),
    FieldSpec("other"),
    FieldSpec("link", analyzer="keyword"),
    FieldSpec("id", analyzer="keyword", column="doc_id"),
    FieldSpec("categories", analyzer="keyword", shape=ARRAY),
    FieldSpec("paragraphs", shape=MAP),
    FieldSpec("extra", shape=MAP),
)


def field_terms(documents: DataFrame, specs: Sequence[FieldSpec], doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, field, terms``: one row per document and non-empty field, terms in order."""
    entries = F.concat(*[s.entries() for s in specs])
    return (
        documents.select(F.col(doc_id).alias("doc_id"), F.explode(entries).alias("_e"))
        .select("doc_id", "_e.field", "_e.terms")
        .filter(F.size("terms") > 0)
    )


Test = Callable[[Column, Column], Column]  # of (field, term)


def _term_runs(rows: DataFrame, positions: bool, keep: Test | None) -> DataFrame:
    """Postings of rows from ``field_terms``, worked out inside each row.

    A document's terms are sorted in place and cut where the term changes, so counting needs no shuffle;
    what would be the largest exchange of an index build does not happen. The projections are kept apart so
    that each array is made once.
    """
    entries = F.col("terms")
    if positions:
        entries = F.transform(entries, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))

    def term_of(entry: Column) -> Column:
        return entry["term"] if positions else entry

    if keep:
        entries = F.filter(entries, lambda e: keep(F.col("field"), term_of(e)))
    cut = rows.select("doc_id", "field", F.size("terms").alias("doc_len"), F.sort_array(entries).alias("_sorted"))
    n = F.size("_sorted")
    # A term ends where the next one differs; past the last there is none. No terms kept: no ends.
    ends = F.filter(
        F.when(n > 0, F.sequence(F.lit(1), n)),
        lambda i: ~term_of(F.get("_sorted", i)).eqNullSafe(term_of(F.get("_sorted", i - 1))),
    )
    cut = cut.withColumn("_ends", ends)

    def run(end: Column, k: Column) -> Column:
        start = F.when(k > 0, F.get("_ends", k - 1)).otherwise(0)
        where = (
            F.transform(F.slice("_sorted", start + 1, end - start), lambda s: s["pos"])
            if positions
            else F.lit(None).cast("array<int>")
        )
        return F.struct(
            term_of(F.get("_sorted", end - 1)).alias("term"), (end - start).alias("tf"), where.alias("positions")
        )

    runs = cut.select("field", "doc_id", "doc_len", F.explode(F.transform("_ends", run)).alias("_r"))
    return runs.select("field", "_r.term", "doc_id", "_r.tf", "doc_len", "_r.positions")


def build_postings(
    documents: DataFrame,
    specs: Sequence[FieldSpec] = DOCUMENT_FIELDS,
    doc_id: str = "doc_id",
    keep: Test | None = None,
) -> DataFrame:
    """``field, term, doc_id, tf, doc_len, positions``: one row per field, term and document.

    With ``keep`` only terms that pass the test are counted and given.
    """
    parts = []
    for positions in (True, False):
        group = [s for s in specs if s.positions == positions]
        if group:
            parts.append(_term_runs(field_terms(documents, group, doc_id), positions, keep))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def neighbour_postings(documents: DataFrame, specs: Sequence[FieldSpec], doc_id: str = "doc_id", keep: Test | None = None) -> DataFrame:
    """``field, term, following, doc_id, tf, doc_len``: the pairs of neighbouring terms of the fields with ``neighbours``.

    They are worked out as postings are, inside each row. ``keep`` tests (term, following).
    """
    wanted = [s for s in specs if s.neighbours]
    rows = field_terms(documents, wanted, doc_id).filter(F.size("terms") > 1)
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("terms") - 1),
        lambda i: F.struct(F.get("terms", i - 1).alias("term"), F.get("terms", i).alias("following")),
    )
    if keep:
        pairs = F.filter(pairs, lambda p: keep(p["term"], p["following"]))
    cut = rows.select("doc_id", "field", F.size("terms").alias("doc_len"), F.sort_array(pairs).alias("_sorted"))
    n = F.size("_sorted")
    ends = F.filter(
        F.when(n > 0, F.sequence(F.lit(1), n)), lambda i: ~F.get("_sorted", i).eqNullSafe(F.get("_sorted", i - 1))
    )
    cut = cut.withColumn("_ends", ends)
    runs = F.transform(
        "_ends",
        lambda end, k: F.struct(
            F.get("_sorted", end - 1).alias("pair"), (end - F.when(k > 0, F.get("_ends", k - 1)).otherwise(0)).alias("tf")
        ),
    )
    found = cut.select("field", "doc_id", "doc_len", F.explode(runs).alias("_r"))
    return found.select("field", "_r.pair.term", "_r.pair.following", "doc_id", "_r.tf", "doc_len")


def term_stats(postings: DataFrame) -> DataFrame:
    """``field, term, df, cf``: documents with the term and its total count."""
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )


def field_stats(
    documents: DataFrame, specs: Sequence[FieldSpec] = DOCUMENT_FIELDS, doc_id: str = "doc_id"
) -> DataFrame:
    """``field, n_docs, total_len`` over the documents that have the field."""
    return (
        field_terms(documents, specs, doc_id)
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("terms")).alias("total_len"))
    )


# Marks of a term's beginning and end in its grams; no token holds them.
BEGIN, END = "\x02", "\x03"


def grams_of(term: Column) -> Column:
    """Different pairs of neighbouring characters of a term, its ends marked."""
    whole = F.concat(F.lit(BEGIN), term, F.lit(END))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(term) + 1), lambda i: F.substring(whole, i, F.lit(2))))


def term_grams(terms: DataFrame, specs: Sequence[FieldSpec]) -> DataFrame:
    """``field, gram, term`` of the term dictionary, for the fields cut into tokens."""
    exact = [s.name for s in specs if s.analyzer != "standard" and s.shape != MAP]
    texts = terms.filter(~F.col("field").isin(exact)) if exact else terms
    return texts.select("field", F.explode(grams_of(F.col("term"))).alias("gram"), "term")


@dataclass(frozen=True)
class Index:
    """Postings with the statistics a search needs.

    ``terms`` is the dictionary: each term of a field once. ``grams`` tells which of them hold a pair of characters.
    ``neighbours`` has the pairs of neighbouring terms of the fields that have them (see ``neighbour_postings``).
    """

    postings: DataFrame
    terms: DataFrame
    fields: DataFrame
    specs: tuple[FieldSpec, ...] = DOCUMENT_FIELDS
    grams: DataFrame | None = None
    neighbours: DataFrame | None = None
    stored_documents: DataFrame | None = None

    @staticmethod
    def build(
        documents: DataFrame, specs: Sequence[FieldSpec] = DOCUMENT_FIELDS, doc_id: str = "doc_id"
    ) -> LiveIndex:
        postings = build_postings(documents, specs, doc_id)
        fields = field_stats(documents, specs, doc_id)
        pairs = neighbour_postings(documents, specs, doc_id) if any(s.neighbours for s in specs) else None
        return LiveIndex(postings, term_stats(postings), fields, tuple(specs), None, pairs, None, documents, doc_id)

    @classmethod
    def read(
        cls, spark: SparkSession, path: str, specs: Sequence[FieldSpec] = DOCUMENT_FIELDS, documents: DataFrame | None = None
    ) -> Index:
        more = [spark.read.parquet(f"{path}/{t}") if path_exists(spark, f"{path}/{t}") else None for t in ("grams", "neighbours")]
        return cls(
            spark.read.parquet(f"{path}/postings"),
            spark.read.parquet(f"{path}/terms"),
            spark.read.parquet(f"{path}/fields"),
            tuple(specs),
            *more,
            documents,
        )

    def write(self, path: str, partitions: int | None = None, ordered: bool = True) -> None:
        """Write the tables, postings in (field, term, doc_id) order.

        The order lets a search skip all row groups but those of its terms. Ranges break inside a frequent
        term as well, as ``doc_id`` is part of the order. An unordered index is for batches that read most of
        it anyway: it is written where it was counted, without a shuffle.
        """
        order = ["field", "term", "doc_id"]
        rows = self.postings
        if ordered:
            ranges = (partitions, *order) if partitions else order
            rows = rows.repartitionByRange(*ranges).sortWithinPartitions(*order)
        rows.write.mode("overwrite").parquet(f"{path}/postings")
        spark = self.postings.sparkSession
        terms = term_stats(spark.read.parquet(f"{path}/postings"))
        if ordered:
            terms = terms.repartitionByRange("field", "term").sortWithinPartitions("field", "term")
        terms.write.mode("overwrite").parquet(f"{path}/terms")
        if ordered:
            grams = term_grams(spark.read.parquet(f"{path}/terms"), self.specs)
            order = ["field", "gram", "term"]
            grams.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/grams")
        if self.neighbours is not None:
            order = ["field", "term", "following", "doc_id"]
            pairs = self.neighbours.repartitionByRange(*order).sortWithinPartitions(*order)
            pairs.write.mode("overwrite").parquet(f"{path}/neighbours")
        self.fields.write.mode("overwrite").parquet(f"{path}/fields")

    def stored(self, path: str, ordered: bool = True) -> Index:
        """Write to ``path`` and read back."""
        self.write(path, ordered=ordered)
        return Index.read(self.postings.sparkSession, path, self.specs)

    def analyzer(self, field: str) -> str:
        """Analyzer of a field; names that are no column of their own come from the text maps."""
        return next((s.analyzer for s in self.specs if s.name == field and s.shape != MAP), "standard")

    def has_positions(self, field: str) -> bool:
        return any(s.positions for s in self.specs if s.name == field)

    def has_neighbours(self, field: str) -> bool:
        return any(s.neighbours for s in self.specs if s.name == field)

    def dictionary(self, field: str) -> DataFrame | None:
        """``term`` of a field, each once, where the index has them at hand."""
        return self.terms.filter(F.col("field") == field).select("term")

    def with_grams(self, field: str, grams: Sequence[str], least: int) -> DataFrame | None:
        """``term`` of a field with ``least`` or more of the grams; none where the index has no grams of the field."""
        if self.grams is None or self.analyzer(field) != "standard":
            return None
        held = self.grams.filter((F.col("field") == field) & F.col("gram").isin(list(grams)))
        return held.groupBy("term").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select("term")

    def loosely_matching(self, test: Test, fields: Sequence[str]) -> DataFrame:
        """Postings that pass a test on terms that is no list of terms; only which documents they are of counts."""
        return self.matching(test, fields)

    def matching(self, test: Test, fields: Sequence[str], terms: Sequence[str] | None = None) -> DataFrame:
        """Postings that pass the test. ``fields`` and ``terms`` name all it can match and are there for the
        parquet reader, which skips row groups by them."""
        rows = self.postings.filter(F.col("field").isin(list(fields)))
        if terms is not None:
            rows = rows.filter(F.col("term").isin(list(terms)))
        return rows.filter(test(F.col("field"), F.col("term")))

    def matching_where(
        self, test: Test, fields: Sequence[str], exact: tuple[Test, Sequence[str], Sequence[str]], needed: tuple[str, Sequence[str]]
    ) -> DataFrame:
        """Postings that pass the test, of the documents that have one of the needed terms in its field.

        The exact postings (their own test, fields and terms) are few and found by the reader's filters; those of
        prefixes and the like, which may be nearly all documents', are cut down to the documents that can match.
        """
        found = self.matching(*exact)
        field, terms = needed
        documents = self.matching(lambda f, t: (f == field) & t.isin(list(terms)), [field], terms).select("doc_id")
        loose = self.matching(lambda f, t: test(f, t) & ~exact[0](f, t), fields)
        return found.unionByName(loose.join(documents, "doc_id", "left_semi").select(*found.columns))

    def texts(self) -> DataFrame:
        """The documents that were indexed; phrases of three terms and more are checked on them."""
        if self.stored_documents is None:
            raise ValueError("a phrase of three terms over neighbours needs the documents: set stored_documents")
        return self.stored_documents

    def text_id(self) -> str:
        return "doc_id"

    def neighbouring(self, field: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
        """``term, following, doc_id, tf, doc_len`` of the given pairs; the reader skips row groups by their first terms."""
        rows = self.neighbours.filter((F.col("field") == field) & F.col("term").isin([a for a, _ in pairs]))
        return rows.filter(_among(pairs)(F.col("term"), F.col("following"))).drop("field")

    def asked(self, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Postings (``field, term, doc_id, tf, doc_len``) of a table of (field, term), and the statistics of the fields."""
        postings = self.postings.select("field", "term", "doc_id", "tf", "doc_len")
        return cut_lineage(postings.join(terms, ["field", "term"], "left_semi")), self.fields

    def statistics(self, fields: Sequence[str], terms: Sequence[str]) -> DataFrame:
        """``field, term, df, n_docs, total_len`` of the given terms, at most one row per field and term."""
        wanted = F.col("field").isin(list(fields))
        df = self.terms.filter(wanted & F.col("term").isin(list(terms))).select("field", "term", "df")
        return df.join(self.fields.filter(wanted), "field")


def _among(pairs: Sequence[tuple[str, str]]) -> Test:
    """Whether (term, following) is one of the pairs."""
    return lambda term, following: reduce(or_, [(term == a) & (following == b) for a, b in pairs])


@dataclass(frozen=True)
class LiveIndex(Index):
    """Index over documents that were not indexed before.

    A search tests terms inside each document and lets only those it asks for out, so it sorts and moves
    none of the others.
    """

    documents: DataFrame | None = None
    doc_id: str = "doc_id"

    def _specs_of(self, fields: Sequence[str]) -> list[FieldSpec]:
        """The columns that can hold the fields: their own, and the maps, which may have a key of any name."""
        return [s for s in self.specs if s.shape == MAP or s.name in fields]

    def matching(self, test: Test, fields: Sequence[str], terms: Sequence[str] | None = None) -> DataFrame:
        return build_postings(self.documents, self._specs_of(fields), self.doc_id, keep=lambda f, t: f.isin(list(fields)) & test(f, t))

    def dictionary(self, field: str) -> DataFrame | None:
        return None

    def asked(self, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
        """One pass: each document gives its tokens, of which the asked ones stay, and a row without a term, for the totals."""
        rows = field_terms(self.documents, self.specs, self.doc_id)
        every = F.explode(F.concat(F.array(F.lit(None).cast("string")), "terms")).alias("term")
        tokens = rows.select("field", every, "doc_id", F.size("terms").alias("doc_len"))
        marked = tokens.join(terms.withColumn("_asked", F.lit(True)), ["field", "term"], "left")
        kept = marked.where(F.col("_asked") | F.col("term").isNull())
        counts = cut_lineage(kept.groupBy("field", "term", "doc_id", "doc_len").agg(F.count(F.lit(1)).alias("tf")))
        totals = counts.where(F.col("term").isNull()).groupBy("field")
        fields = totals.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("doc_len").alias("total_len"))
        return counts.where(F.col("term").isNotNull()).select("field", "term", "doc_id", "tf", "doc_len"), fields

    def texts(self) -> DataFrame:
        return self.documents

    def text_id(self) -> str:
        return self.doc_id

    def loosely_matching(self, test: Test, fields: Sequence[str]) -> DataFrame:
        """Each term of a document is tested once, as a row of its own: that is compiled code, which a test inside an array is not."""
        rows = field_terms(self.documents, self._specs_of(fields), self.doc_id).filter(F.col("field").isin(list(fields)))
        terms = rows.select("field", F.explode(F.array_distinct("terms")).alias("term"), "doc_id", F.size("terms").alias("doc_len"))
        none = F.lit(None).cast("array<int>").alias("positions")
        return terms.filter(test(F.col("field"), F.col("term"))).select("field", "term", "doc_id", F.lit(1).alias("tf"), "doc_len", none)

    def matching_where(
        self, test: Test, fields: Sequence[str], exact: tuple[Test, Sequence[str], Sequence[str]], needed: tuple[str, Sequence[str]]
    ) -> DataFrame:
        """As in a stored index; here a document is looked at by itself, and one that lacks the terms gives nothing."""
        field, terms = needed
        has = F.exists(
            F.concat(*[s.entries() for s in self._specs_of([field])]),
            lambda e: (e["field"] == field) & F.arrays_overlap(e["terms"], F.array(*[F.lit(t) for t in terms])),
        )
        some = replace(self, documents=self.documents.where(has))
        return some.matching(test, fields)

    def neighbouring(self, field: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
        specs = [s for s in self.specs if s.name == field]
        return neighbour_postings(self.documents, specs, self.doc_id, keep=_among(pairs)).drop("field")

    def statistics(self, fields: Sequence[str], terms: Sequence[str]) -> DataFrame:
        """One pass: each document gives a row per field without a term, for the totals, and one per term."""
        rows = field_terms(self.documents, self._specs_of(fields), self.doc_id)
        asked = F.array(*[F.lit(t) for t in terms])
        found = F.concat(F.array(F.lit(None).cast("string")), F.array_intersect("terms", asked))
        sums = (
            rows.select("field", F.size("terms").alias("doc_len"), F.explode(found).alias("term"))
            .groupBy("field", "term")
            .agg(F.count(F.lit(1)).alias("df"), F.sum("doc_len").alias("total_len"))
        )
        # A field's few sums: its total and one per asked term.
        total = Window.partitionBy("field")
        return sums.select(
            "field",
            "term",
            "df",
            F.max(F.when(F.col("term").isNull(), F.col("df"))).over(total).alias("n_docs"),
            F.max(F.when(F.col("term").isNull(), F.col("total_len"))).over(total).alias("total_len"),
        ).filter(F.col("term").isNotNull() & F.col("field").isin(list(fields)))
