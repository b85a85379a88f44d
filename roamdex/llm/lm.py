"""Language-model scoring with a log-frequency Bloom filter of n-gram counts.

Words and word pairs of the training documents are counted exactly by one shuffle. Their counts go, quantised to levels,
into a log-frequency Bloom filter (see ``bloom``) that is broadcast. A text is scored token by token: the counts of the
token, of the word before it and of both together are read back by repeated membership probes, and smoothed:

    P(w | h) = (count(h w) + PRIOR P(w)) / (count(h) + PRIOR),    P(w) = (count(w) + 0.1) / (N + 0.1 (V + 1))

so that an unseen pair falls back to the word's own share, and an unseen word to the share of all unseen ones. The word
before the first is a mark of its own; a text's last token is its end. Counts up to 8 are read back exactly, larger ones
within 12 %.

A pair that was never seen is read as seen once with the chance of a false positive, about 1 in 60. So P adds up to
nearly one after common words, but to more after rare ones, where one occurrence weighs much: the price of the filter.

The filter takes at most ``MOST_BYTES``. Where the n-grams need more, those of least counts are left out of it by whole
levels, pairs first. An n-gram that the filter reads below its least level leaves the text as a row and meets the table of
those left out in a join, quantised alike: the score is that of a filter with room for all, but for false positives.

The base score needs exact counts of a text's words. Those of the commonest words, at most ``COMMON_WORDS``, are
broadcast; the others of a text leave it as (text, word) rows, meet the counts in a join and are summed per text.

Words are told apart by 64-bit hashes, texts by 128-bit digests.

Defined cases: a null text counts as empty, and an empty text is its end token; a null ``doc_id`` has remainder 0, as the
crc32 of no text, and is held out; rows equal in id and text are scored alike; without training documents all counts are
0; an empty table gives no rows; other columns are kept out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamdex.llm import bloom, ngrams
from roamdex.llm.common import bounded_batches, stored, written
from roamdex.session import shared_folder

PRIOR = 20.0
MOST_BYTES = 96 * 1024 * 1024
COMMON_WORDS = 1 << 18

# --- fixed values: what parts words, and the base's smoothing ---
SPACES = b" \t\n\x0b\x0c\r"
ADD = 0.1

_BREAKS = ngrams.byte_class(SPACES)
_END, _BEGIN = (ngrams.mix(np.array([x], np.uint64)) for x in (2, 3))


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is one that the model doesn't learn from: crc32 of the id's digits, of which the tenth part is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a batch's tokens, of the token before each, and the text that each is of."""
    buffer, at = ngrams.joined(texts)
    starts, _, hashes = ngrams.words(buffer, _BREAKS)
    n = np.diff(np.searchsorted(starts, at)) + 1
    owner = np.repeat(np.arange(len(n)), n)
    last = np.cumsum(n) - 1
    tokens = np.empty(len(owner), np.uint64)
    is_word = np.ones(len(owner), bool)
    is_word[last] = False
    tokens[is_word], tokens[last] = hashes, _END[0]
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[last - n + 1] = _BEGIN[0]
    return tokens, before, owner


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``text`` -> ``key, word, n``: exact counts of the words (and ends and beginnings of texts) and of the pairs.

    Rows are dealt by parts of the key space, which is how the filter is built of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in ngrams.slices(b, "text")):
            tokens, before, _ = _tokens(batch.column("text"))
            words, n = np.unique(tokens, return_counts=True)
            pairs, m = np.unique(ngrams.paired(before, tokens), return_counts=True)
            is_word = np.repeat([True, False, True], [len(words), len(pairs), 1])
            keys, counts = np.concatenate([words, pairs, _BEGIN]), np.concatenate([n, m, [batch.num_rows]])
            yield pa.RecordBatch.from_arrays(
                [ngrams.signed(keys), pa.array(is_word), pa.array(counts, pa.int64())], ["key", "word", "n"]
            )

    counted = docs.select("text").mapInArrow(run, "key bigint, word boolean, n bigint")
    dealt = counted.repartition(bloom.bucket(F.col("key")))
    return dealt.groupBy(bloom.bucket(F.col("key")).alias("bucket"), "key", "word").agg(F.sum("n").alias("n")).drop("bucket")


class Model:
    """What scoring needs: the filter and the levels of words and pairs it begins at, totals, exact counts of common words."""

    def __init__(
        self, grams: bloom.Filter, least: tuple[int, int], total: int, different: int, words: np.ndarray, counts: np.ndarray
    ) -> None:
        self.grams, self.least, self.total, self.different = grams, least, total, different
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        # The commonest words have the highest levels, which cost most probes: they are read once.
        self.levels = grams.levels(self.words).astype(np.int8)
        self.read_as = bloom.count_of()

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + ADD) / (self.total + ADD * (self.different + 1)))

    def _place(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words are among the commonest, and which of them are."""
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return at, self.words[at] == words

    def common(self, words: np.ndarray) -> np.ndarray:
        """Exact counts of words; -1 for those that are not among the commonest."""
        at, here = self._place(words)
        out = np.full(len(words), -1, np.int64)
        out[here] = self.counts[at[here]]
        return out

    def word_levels(self, words: np.ndarray) -> np.ndarray:
        """Levels of words as the filter has them."""
        at, here = self._place(words)
        out = np.zeros(len(words), np.int64)
        out[here] = self.levels[at[here]]
        out[~here] = self.grams.levels(words[~here])
        return out

    def probed(self, keys: np.ndarray) -> np.ndarray:
        """Counts of n-grams as the filter has them."""
        return self.read_as[self.grams.levels(keys)]

    def share(self, count: np.ndarray) -> np.ndarray:
        return (count + ADD) / (self.total + ADD * (self.different + 1))

    def log_shares(self, tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log10 P of each token after the one before it, of what the filter has."""
        words, at = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        return self.read(words, at[: len(tokens)], at[len(tokens) :])[0]

    def read(self, words: np.ndarray, word: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of tokens and those before them, as places in ``words``: log10 P of each token after the one before it; the pair's
        key; the levels of the token, of the one before and of the pair, -1 where the n-gram may be among those left out of
        the filter."""
        of_word = self.word_levels(words)
        pairs, pair = np.unique(ngrams.paired(words[prior], words[word]), return_inverse=True)
        of_pair = self.grams.levels(pairs)
        # A level is never read too low: what is read below the least one is not in, or by a false positive.
        for levels, least in ((of_word, self.least[0]), (of_pair, self.least[1])):
            levels[levels < least] = -1 if least > 1 else 0
        own, history, both = of_word[word], of_word[prior], of_pair[pair]
        if self.least[1] > 1:
            both[(own == 0) | (history == 0)] = 0
        n_own, n_history, together = (self.read_as[np.maximum(x, 0)] for x in (own, history, both))
        # A pair is no more frequent than its words: what the filter says beyond that is a false positive.
        together = np.minimum(together, np.minimum(n_own, n_history))
        logs = np.log10((together + PRIOR * self.share(n_own)) / (n_history + PRIOR))
        return logs, pairs[pair], own, history, both


def _level_counts(counts: DataFrame) -> list:
    """Number of n-grams by level and kind: a few hundred rows."""
    return counts.groupBy("word", bloom.level_of(F.col("n")).alias("level")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect()


def _least_levels(levels: list, most: int) -> tuple[int, int]:
    """The lowest levels of words and of pairs from which on all fit into a filter of ``most`` bytes: words come first."""
    items, least = 0, [1, 1]
    for kind, word in enumerate((True, False)):
        for level in range(bloom.MOST_LEVEL, 0, -1):
            items += sum(r["k"] * level for r in levels if r["level"] == level and r["word"] == word)
            if items * bloom.BITS_PER_ITEM > most * 8:
                least[kind:] = [level + 1] + [bloom.MOST_LEVEL + 1] * (1 - kind)
                return least[0], least[1]
    return 1, 1


def _common_count(words: DataFrame, most: int) -> int:
    """The least count that no more than ``most`` words have; counts are compared by steps of a sixteenth of their size."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    seen = 0
    for r in sorted(words.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        seen += r["count"]
        if seen > most:
            return int(2 ** ((r["step"] + 1) / 16)) + 1
    return 1


def train(docs: DataFrame, most_bytes: int = MOST_BYTES, common_words: int = COMMON_WORDS) -> tuple[Model, DataFrame]:
    """The model of ``text``, and its exact counts of words: ``word`` (a hash), ``count``, a written table."""
    return _trained(docs, most_bytes, common_words)[:2]


def _trained(docs: DataFrame, most_bytes: int, common_words: int) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the counts of words, and the n-grams that the filter had no room for: ``key, word, level``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = f"{shared_folder(spark)}/lm-{uuid.uuid4().hex}"
    ngram_counts(docs).write.parquet(path)
    counts = spark.read.schema("key bigint, word boolean, n bigint").parquet(path)
    levels = _level_counts(counts)
    begin = int(_BEGIN.view(np.int64)[0])
    words = counts.where(F.col("word") & (F.col("key") != begin)).select(F.col("key").alias("word"), F.col("n").alias("count"))
    texts = counts.where(F.col("word") & (F.col("key") == begin)).agg(F.sum("n")).first()[0] or 0
    total = sum(r["n"] for r in levels if r["word"]) - texts
    different = sum(r["k"] for r in levels if r["word"]) - (texts > 0)
    least = _least_levels(levels, most_bytes)
    items = sum(r["k"] * r["level"] for r in levels if r["level"] >= least[not r["word"]])
    leveled = counts.select("key", "word", bloom.level_of(F.col("n")).alias("level"))
    is_kept = F.col("level") >= F.when(F.col("word"), least[0]).otherwise(least[1])
    grams = bloom.build(leveled.where(is_kept), bloom.blocks_for(items, most_bytes), dealt=True)
    common = words.where(F.col("count") >= _common_count(words.withColumnRenamed("count", "n"), common_words)).toArrow()
    known = common.column("word").to_numpy().view(np.uint64), common.column("count").to_numpy()
    return Model(grams, least, total, different, *known), words, leveled.where(~is_kept)


def _row_key(doc_id: int | None, text: bytes) -> bytes:
    return md5(b"%s:%s" % (str(doc_id).encode(), text)).digest()


def _lists(cuts: np.ndarray, *values: pa.Array) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), v) for v in values]


def _open_pairs(n: int, tokens: np.ndarray, before: np.ndarray, owner: np.ndarray, read: tuple[np.ndarray, ...]) -> list[pa.Array]:
    """The pairs of each of ``n`` texts of which the filter may lack something, once each, in the order of ``OPEN``."""
    _, pair, own, history, both = read
    order = np.lexsort((pair, owner))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(owner[order]) != 0) | (pair[order][1:] != pair[order][:-1])
    first, times = order[new], np.diff(np.append(np.flatnonzero(new), len(order)))
    cuts = np.searchsorted(owner[first], np.arange(n + 1))
    levels = (pa.array(x[first], pa.int8()) for x in (own, history, both))
    longs = (ngrams.signed(x[first]) for x in (pair, tokens, before))
    return _lists(cuts, *levels, pa.array(times, pa.int32()), *longs)


SQL_NAMES = {pa.int64(): "bigint", pa.int32(): "int", pa.int8(): "tinyint"}
# Columns, in lists, of a text's pairs that need a look at what the filter had no room for. The two words only where it
# lacks words.
OPEN = {
    "own": pa.int8(), "history": pa.int8(), "both": pa.int8(), "often": pa.int32(), "pair": pa.int64(), "token": pa.int64(),
    "before": pa.int64(),
}


def _open_columns(model: Model) -> list[str]:
    return list(OPEN) if model.least[0] > 1 else list(OPEN)[:-2] if model.least[1] > 1 else []


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per text: its scores as far as the broadcast tables tell, and its other words with their numbers.

    Where the filter had no room for all n-grams, also the pairs that are not in ``score`` yet.
    """
    spark = docs.sparkSession
    more = _open_columns(model)
    shared = spark.sparkContext.broadcast(model)
    kinds = {
        "doc_id": pa.int64(), "held_out": pa.bool_(), "row": pa.binary(), "n_tokens": pa.int64(), "n_known": pa.int64(),
        "base_score": pa.float64(), "score": pa.float64(), "words": pa.list_(pa.int64()), "times": pa.list_(pa.int32()),
    }
    kinds |= {name: pa.list_(OPEN[name]) for name in more}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in (s for b in batches for s in ngrams.slices(b, "text")):
            n = batch.num_rows
            texts = batch.column("text").cast(pa.binary())
            tokens, before, owner = _tokens(texts)
            words, word = np.unique(tokens, return_inverse=True)
            # The word before a token is the token before it, but for a text's first.
            prior = np.empty_like(word)
            prior[1:] = word[:-1]
            prior[np.flatnonzero(np.diff(owner, prepend=-1))] = len(words)
            read = model.read(np.append(words, _BEGIN), word, prior)
            closed = np.minimum(np.minimum(read[2], read[3]), read[4]) >= 0
            score = np.bincount(owner[closed], read[0][closed], n).astype(float)
            count = model.common(words)
            here = count[word] >= 0
            base = np.bincount(owner[here], model.base(np.maximum(count, 0))[word[here]], n).astype(float)
            known = np.bincount(owner[here & (count[word] > 0)], minlength=n)
            rest, times = np.unique(owner[~here] << 32 | word[~here], return_counts=True)
            cuts = np.searchsorted(rest >> 32, np.arange(n + 1))
            lists = _lists(cuts, ngrams.signed(words[rest & 0xFFFFFFFF]), pa.array(times, pa.int32()))
            if more:
                found = _open_pairs(n, *(x[~closed] for x in (tokens, before, owner)), tuple(x[~closed] for x in read))
                lists += found[: len(more)]
            rows = [_row_key(i, t or b"") for i, t in zip(batch.column("doc_id").to_pylist(), texts.to_pylist())]
            columns = [
                batch.column("doc_id"), batch.column("held_out"), rows, np.bincount(owner, minlength=n), known, base, score, *lists,
            ]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds.values())]
            yield pa.RecordBatch.from_arrays(arrays, list(kinds))

    schema = (
        "doc_id bigint, held_out boolean, row binary, n_tokens bigint, n_known bigint, base_score double, score double,"
        " words array<bigint>, times array<int>"
    )
    schema += "".join(f", {name} array<{SQL_NAMES[OPEN[name]]}>" for name in more)
    return docs.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out")).mapInArrow(run, schema)


def _open_scores(scored: DataFrame, model: Model, left: DataFrame) -> DataFrame:
    """``row, score``: sums over the pairs that the filter could not tell, with the levels of the n-grams left out of it."""
    found = scored.select("row", F.inline(F.arrays_zip(*_open_columns(model))))
    for name, key, word in (("own", "token", True), ("history", "before", True), ("both", "pair", False)):
        if model.least[not word] > 1:
            table = left.where(F.col("word") == word).select(F.col("key").alias(key), F.col("level").alias("found"))
            # Only rows that ask are moved.
            met = found.where(F.col(name) < 0).join(table, key, "left").withColumn(name, F.coalesce("found", F.lit(0).cast("tinyint")))
            found = met.drop("found", key).unionByName(found.where(F.col(name) >= 0).drop(key))
    read_as = F.lit([float(n) for n in model.read_as])
    own, history, both = (F.get(read_as, F.col(name).cast("int")) for name in ("own", "history", "both"))
    share = (own + F.lit(ADD)) / F.lit(model.total + ADD * (model.different + 1))
    logs = F.log10((F.least(both, own, history) + F.lit(PRIOR) * share) / (history + F.lit(PRIOR)))
    return found.groupBy("row").agg(F.sum(F.col("often") * logs).alias("more"))


def score(docs: DataFrame, most_bytes: int = MOST_BYTES, common_words: int = COMMON_WORDS) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    bounded_batches(docs.sparkSession)
    model, counts, left = _trained(docs.where(~is_held_out(F.col("doc_id"))), most_bytes, common_words)
    partial = len(_open_columns(model)) > 0
    scored = written(_scored(docs, model), "lm-scored") if partial else stored(_scored(docs, model))
    # The words that were not at hand, with their counts; the mark of each text tells how many rows are equal.
    rest = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rest = rest.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    met = rest.join(counts, "word", "left").select("row", "times", F.coalesce("count", F.lit(0)).alias("count"))
    share = (F.col("count") + F.lit(ADD)) / F.lit(model.total + ADD * (model.different + 1))
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(share)).alias("base"),
        F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("known"),
    )
    is_open = F.size("words") > 0
    if partial:
        sums = sums.join(_open_scores(scored, model, left), "row", "full")
        is_open |= F.size("pair") > 0
    else:
        sums = sums.withColumn("more", F.lit(0.0))
    equal = scored.where(is_open).groupBy("row").agg(F.count(F.lit(1)).alias("rows"))
    sums = stored(sums.join(equal, "row").select(
        "row", (F.col("base") / F.col("rows")).alias("base"), (F.col("known") / F.col("rows")).cast("bigint").alias("known"),
        (F.col("more") / F.col("rows")).alias("more"),
    ))
    whole = scored.select("doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "score").join(sums, "row", "left")
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
