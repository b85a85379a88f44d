"""Phrase collocations by Toivonen's sampling: a sample proposes, full passes count exactly until the border holds.

A hash sample of documents proposes words and word pairs that are likely to be frequent. A full pass counts exactly all
phrases whose shorter parts were all proposed: the proposed phrases and their negative border, to which every single
word belongs. Where a phrase of the border (one not proposed) turns out to be frequent, the phrases that this makes
countable have been missed: a further pass counts them, and so on until no pass finds one. Every frequent phrase is
counted by then, whatever the sample: a bad one costs passes, never results. For three words there are three passes at most.

What is known to be frequent goes to the tasks as a Bloom filter of at most ``FILTER_BYTES``. A false positive has some
rare phrases counted too, which the exact counts then tell; which pass counts a phrase is read from the same filters, so
that none is counted twice. Counts are summed per batch in numpy, then by Spark; no task holds more than a batch.

Words are told apart by 64-bit hashes of language and word within a batch's counting, phrases by those of their words.

Defined cases: a null text counts as empty and a null language as ``und``; repeated rows count each; an empty table, or
one without frequent phrases, gives no rows; a text is read whole, whatever its length; other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamdex.llm import bloom, ngrams
from roamdex.llm.common import bounded_batches, stored

LEAST = 10
#: A shorter phrase goes where a longer one has this share, in percent, of its occurrences.
COVERED = 50
TOP = 2_000
SAMPLE_SHARE = 8  # one document of so many
SAMPLE_LEAST = 2
FILTER_BYTES = 32 * 1024 * 1024

# --- fixed values: what ends a piece, and what parts words ---
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"

_BREAKS, _ENDS = ngrams.byte_class(PIECE_ENDS + SPACES), ngrams.byte_class(PIECE_ENDS)
_SCHEMA = "w1 bigint, w2 bigint, w3 bigint, lang string, word string, n bigint"


class _Known:
    """Phrases taken for frequent, by the filters of the passes so far. Without any, all are."""

    def __init__(self, filters: list[bloom.Filter] | None) -> None:
        self.filters = filters

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if self.filters is None:
            return np.ones(len(keys), bool)
        found = np.zeros(len(keys), bool)
        for f in self.filters:
            found |= f.has(keys)
        return found


def _sequences(texts: pa.Array, langs: list[str]) -> tuple:
    """Hashes of a batch's words in order, their bytes' places, languages, and whether one piece holds it and the next."""
    buffer, at = ngrams.joined(texts)
    starts, ends, hashes = ngrams.words(buffer, _BREAKS)
    owner = np.searchsorted(at, starts, "right") - 1
    names = {x: k for k, x in enumerate(dict.fromkeys(langs))}
    lang = np.array([names[x] for x in langs], np.int64)[owner]
    salts = np.array([int.from_bytes(md5(x.encode()).digest()[:8], "little") for x in names], np.uint64)
    hashes = ngrams.paired(salts[lang], hashes)
    stops = np.cumsum(_ENDS[np.frombuffer(buffer, np.uint8)], dtype=np.int64)
    together = stops[starts[1:]] == stops[starts[:-1]] if len(starts) else np.zeros(0, bool)
    return buffer, starts, ends, hashes, lang, list(names), together


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, a place of each, the number of each key among them, and how often each occurs."""
    return np.unique(keys, return_index=True, return_inverse=True, return_counts=True)


def _rows(w: list[np.ndarray], langs: pa.Array | None, words: list[bytes] | None, n: np.ndarray) -> pa.RecordBatch:
    none = np.zeros(len(n), np.uint64)
    columns = [ngrams.signed(np.ascontiguousarray(x)) for x in [*w, none, none, none][:3]]
    blank = pa.array([""], pa.string()).take(pa.array(np.zeros(len(n), np.int64)))
    texts = [langs if langs is not None else blank, blank if words is None else pa.array(words, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays([*columns, *texts, pa.array(n, pa.int64())], ["w1", "w2", "w3", "lang", "word", "n"])


def _count_batch(texts: pa.Array, langs: list[str], now: _Known, before: _Known | None) -> Iterator[pa.RecordBatch]:
    """Counts of the words, pairs and triples of a batch that this pass counts.

    Those countable by what is known ``now``, but for those that an earlier pass could count (``before``; without it this
    is the first pass, which counts the words too).
    """
    buffer, starts, ends, hashes, lang, names, together = _sequences(texts, langs)
    if not len(hashes):
        return
    words, first, word, n = _counted(hashes)
    if before is None:
        spans = zip(starts[first].tolist(), ends[first].tolist())
        named = pa.array(names, pa.string())
        yield _rows([words], named.take(pa.array(lang[first])), [buffer[a:b] for a, b in spans], n)
        yield _rows([], named, None, np.bincount(lang, minlength=len(names)))

    def countable(known: _Known | None, keys: np.ndarray) -> np.ndarray:
        return np.zeros(len(keys), bool) if known is None else known(keys)

    # Pairs of neighbours, each by the place of its first word.
    at = np.flatnonzero(together)
    known_now, known_before = now(words), countable(before, words)
    able = known_now[word[at]] & known_now[word[at + 1]]
    at = at[able]
    pairs, first, pair, n = _counted(word[at] << 32 | word[at + 1])
    a, b = words[pairs >> 32], words[pairs & 0xFFFFFFFF]
    fresh = ~(known_before[pairs >> 32] & known_before[pairs & 0xFFFFFFFF])
    if fresh.any():
        yield _rows([a[fresh], b[fresh]], None, None, n[fresh])
    # Triples: neighbouring pairs, both known.
    keys = ngrams.paired(a, b)
    pair_now, pair_before = now(keys), countable(before, keys) & ~fresh
    next_to = np.flatnonzero(at[1:] == at[:-1] + 1)
    next_to = next_to[pair_now[pair[next_to]] & pair_now[pair[next_to + 1]]]
    if len(next_to):
        triples, n = np.unique(pair[next_to] << 32 | pair[next_to + 1], return_counts=True)
        left, right = triples >> 32, triples & 0xFFFFFFFF
        fresh = ~(pair_before[left] & pair_before[right])
        if fresh.any():
            yield _rows([a[left[fresh]], b[left[fresh]], b[right[fresh]]], None, None, n[fresh])


def _counts(docs: DataFrame, now: list | None, before: list | None) -> DataFrame:
    """One pass over ``text, lang``. ``now`` and ``before`` are the broadcast filters, None for a pass without any."""

    def known(shared: list | None) -> _Known | None:
        return None if shared is None else _Known([b.value for b in shared])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = _Known(None) if now is None else known(now), known(before)
        for batch in batches:
            for some in ngrams.slices(batch, "text"):
                langs = pc.fill_null(some.column("lang"), "und").to_pylist()
                yield from _count_batch(some.column("text"), langs, *tests)

    counted = docs.select("text", "lang").mapInArrow(run, _SCHEMA)
    return counted.groupBy("w1", "w2", "w3", "lang", "word").agg(F.sum("n").alias("n"))


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """Keys in a filter of words and pairs, as the counting tasks make them."""
    a, b = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("w1", "w2"))
    return np.where(b == 0, a, ngrams.paired(a, b))


def _filter_keys(frequent: DataFrame) -> DataFrame:
    """``key, level`` of the frequent words and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([ngrams.signed(_keys(batch))], ["key"])

    keys = frequent.select("w1", "w2").mapInArrow(run, "key bigint")
    return keys.withColumn("level", F.lit(1).cast("tinyint"))


def _not_known(frequent: DataFrame, filters: list) -> DataFrame:
    """Frequent words and pairs that no filter holds: failures of the border."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known([f.value for f in filters])
        for batch in batches:
            yield batch.filter(pa.array(~known(_keys(batch))))

    return stored(frequent.select("w1", "w2", "w3").where("w3 = 0").mapInArrow(run, "w1 bigint, w2 bigint, w3 bigint"))


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, sample_share: int = SAMPLE_SHARE, filter_bytes: int = FILTER_BYTES
) -> tuple[DataFrame, int]:
    """``text, lang`` -> phrases of one to three words that occur ``least`` times or more, and how many full passes it took.

    Phrases are ``w1, w2, w3`` (hashes, 0 for none), for single words ``lang, word``, and their exact count ``n``. A language's
    number of words is its row without words.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def shared(frequent: DataFrame):
        blocks = bloom.blocks_for(2 * frequent.count(), filter_bytes)
        return spark.sparkContext.broadcast(bloom.build(_filter_keys(frequent), blocks))

    drawn = docs.where(F.pmod(F.xxhash64("text", "lang"), F.lit(sample_share)) == 0)
    proposed = _counts(drawn, None, None).where((F.col("n") >= SAMPLE_LEAST) & (F.col("w1") != 0) & (F.col("w3") == 0))
    filters, before, found = [shared(stored(proposed.select("w1", "w2", "w3")))], None, []
    while True:
        counts = _counts(docs, filters, before).where((F.col("n") >= least) | (F.col("w1") == 0))
        found.append(stored(counts))
        missed = _not_known(found[-1].where("w1 <> 0"), filters)
        if missed.isEmpty():
            return reduce(DataFrame.unionByName, found), len(found)
        before, filters = filters, [*filters, shared(missed)]


def _cut(left: str, right: str) -> Column:
    """Score of a cut into parts that occur ``left`` and ``right`` times: floor(1000000 a a / (l r)).

    Exact for counts below 10^16.
    """
    wide = "cast({} as decimal(38, 0))".format
    return F.expr(f"({wide(1000000)} * {wide('a')} * {wide('a')}) div ({wide(left)} * {wide(right)})")


def collocations(
    docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP, sample_share: int = SAMPLE_SHARE
) -> DataFrame:
    """``text, lang`` -> ``lang, rank, phrase, a, l, r, n, score``: the best collocations of each language.

    Parts of a frequent phrase are frequent, so all counts that scores need are among those of the frequent phrases. The
    joins are on hashes of words; those of a very common word are on one side only, which the skew join splits.
    """
    found, _ = frequent_phrases(docs, least, sample_share)
    languages = found.where("w1 = 0").select("lang", F.col("n").alias("n"))
    words = found.where("w1 <> 0 and w2 = 0").select("w1", "lang", "word", "n")
    pairs = found.where("w2 <> 0 and w3 = 0").select("w1", "w2", F.col("n").alias("a"))
    triples = found.where("w3 <> 0").select("w1", "w2", "w3", F.col("n").alias("a"))

    def word(k: int) -> DataFrame:
        return words.select(F.col("w1").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("n").alias(f"c{k}"))

    first = words.select("w1", "lang", F.col("word").alias("t1"), F.col("n").alias("c1"))
    longer = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longer = longer.groupBy("w1", "w2").agg(F.max("a").alias("longest"))
    free = pairs.join(longer, ["w1", "w2"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a"))
    )
    two = free.join(first, "w1").join(word(2), "w2").select(
        "lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a", F.col("c1").alias("l"), F.col("c2").alias("r"),
        _cut("c1", "c2").alias("score"),
    )
    head, tail = pairs.withColumnRenamed("a", "p12"), pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("p23"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(first, "w1").join(word(2), "w2").join(word(3), "w3")
    three = three.withColumn("s1", _cut("c1", "p23")).withColumn("s2", _cut("p12", "c3"))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a",
        F.when(early, F.col("c1")).otherwise(F.col("p12")).alias("l"),
        F.when(early, F.col("p23")).otherwise(F.col("c3")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(languages, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
