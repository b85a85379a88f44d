"""Quality classifier from weak labels: overlapping heuristics vote, EM weighs them, a hashed linear scorer learns.

Every document gets a vote pattern: each labeller says good, bad or nothing. Patterns are counted over all documents
(at most 3 ** labellers of them, so the counts fit the driver), and expectation-maximisation estimates, for each
labeller, how often it says what of good and of bad documents. The posterior of a pattern is the label of its
documents. A logistic scorer over hashed word shapes is then fitted to the posteriors of a bounded hash sample of
documents (``SAMPLE_ROWS``, a parameter) and scores every document from its text alone.

Defined cases: null, empty and wordless texts have no evidence against them, score as the prior of an empty feature
vector and are kept where it is at least the threshold; repeated rows score alike; an empty table gives no rows and
a scorer that keeps everything; other columns pass through ``keep_good`` and are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamdex.llm.common import bounded_batches

SAMPLE_ROWS = 20_000
BUCKETS = 4096
KEEP_FROM = 0.5
SHAPE_SIGNS = 12
#: Words' worth of nothing added to each document, so that a few words say little.
DAMPING = 10.0

# --- fixed values: marks that prose has few of ---
MARKS = "#$%&*|<>{}[]\\^~=_@+"

GOOD, BAD, NOTHING = 1, 0, 2


#: Belief, before any vote, in how labellers vote on good documents: this share is called bad, with the weight of so many
#: votes, whatever the number of documents.
PRIOR_WRONG, PRIOR_VOTES = 0.1, 20.0


class Stats(NamedTuple):
    """What labellers look at, each but ``words`` a share of words."""

    words: int
    marks: float
    marked: float
    upper: float
    bangs: float
    table: float
    stutter: float
    distinct: float
    top: float
    ends: float
    length: float


# A labeller is (measure, good from, good to, bad below, bad above, fewest words); in between it says nothing.
LABELLERS = {
    "marks": ("marks", 0.0, 0.03, -1.0, 0.15, 1),
    "marked": ("marked", 0.0, 0.02, -1.0, 0.1, 5),
    "upper": ("upper", 0.0, 0.05, -1.0, 0.25, 5),
    "bangs": ("bangs", 0.0, 0.02, -1.0, 0.15, 5),
    "table": ("table", 0.0, 0.02, -1.0, 0.15, 5),
    "stutter": ("stutter", 0.0, 0.05, -1.0, 0.2, 10),
    "variety": ("distinct", 0.4, 1.0, 0.2, 9.0, 50),
    "top_word": ("top", 0.0, 0.1, -1.0, 0.25, 30),
    "sentences": ("ends", 0.02, 0.3, 0.005, 0.6, 50),
    "word_length": ("length", 3.5, 7.0, 2.0, 12.0, 20),
}


def _shapes(word: str, _found={}) -> tuple[int, ...]:  # noqa: B006
    """Buckets of a word's shape: runs of lower, upper, digits as one sign each, marks as they are.

    The whole word is read: every ``SHAPE_SIGNS`` signs of its shape are a bucket. A worker remembers the shapes of short
    words, and starts anew when it knows very many.
    """
    buckets = _found.get(word)
    if buckets is None:
        shape = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "a" if c.isalpha() else c for c in word)
        shape = re.sub(r"(.)\1+", r"\1", shape)
        buckets = tuple(bucket_of("shape " + shape[k : k + SHAPE_SIGNS]) for k in range(0, len(shape), SHAPE_SIGNS))
        if len(_found) > 300_000:
            _found.clear()
        if len(word) <= 64:
            _found[word] = buckets
    return buckets


def bucket_of(feature: str) -> int:
    from zlib import crc32

    return crc32(feature.encode()) % BUCKETS


def read_text(text: str | None) -> tuple[Stats, Counter]:
    words = (text or "").split()
    counts = Counter(words)
    n = len(words)
    if not n:
        return Stats(0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0), counts
    upper = sum(k for w, k in counts.items() if len(w) > 2 and w.isupper())
    ends = sum(k for w, k in counts.items() if w[-1] in ".!?")
    marked = sum(k for w, k in counts.items() if w[-1] in MARKS or w[0] in MARKS)
    stats = Stats(
        n, sum(map(text.count, MARKS)) / n, marked / n, upper / n, text.count("!!") / n, text.count("|") / n,
        sum(map(eq, words, words[1:])) / n, len(counts) / n, max(counts.values()) / n, ends / n,
        sum(map(len, words)) / n,
    )
    return stats, counts


def votes(stats: Stats) -> int:
    """The labellers' votes as one number, a base-3 digit each, the first labeller's lowest."""
    pattern = 0
    for k, (name, good_from, good_to, bad_below, bad_above, fewest) in enumerate(LABELLERS.values()):
        value = getattr(stats, name)
        if stats.words < fewest:
            vote = NOTHING
        elif value < bad_below or value > bad_above:
            vote = BAD
        else:
            vote = GOOD if good_from <= value <= good_to else NOTHING
        pattern += vote * 3**k
    return pattern


def features(stats: Stats, counts: Counter) -> dict[int, float]:
    """Hashed feature vector: shares of word shapes, of repeats and of distinct words."""
    found: dict[int, float] = {}
    for word, k in counts.items():
        for b in _shapes(word):
            found[b] = found.get(b, 0.0) + k
    for name, share in (("stutter", stats.stutter), ("distinct", stats.distinct), ("top", stats.top)):
        b = bucket_of("measure " + name)
        found[b] = found.get(b, 0.0) + share * stats.words
    return {b: v / (stats.words + DAMPING) for b, v in found.items()}


class Weighed(NamedTuple):
    """What EM found: the share of good documents, ``accuracy[class, labeller, vote]`` and the patterns' posteriors."""

    good: float
    accuracy: np.ndarray
    posterior: dict[int, float]


def estimate(patterns: dict[int, int], rounds: int = 200) -> Weighed:
    """EM on the pattern counts: two classes, and each labeller has its own accuracy on each.

    Accuracies come from the documents a labeller votes on: saying nothing is no evidence. A labeller sees one kind of
    fault, so it may call most bad documents good; that it is seldom wrong on good ones is a belief of ``PRIOR_VOTES``
    votes that a few dozen documents outweigh. The start, any bad vote means a bad document, tells the classes apart.
    """
    codes = np.array(sorted(patterns), np.int64)
    n = np.array([patterns[c] for c in codes], float)
    digit = np.stack([codes // 3**k % 3 for k in range(len(LABELLERS))], axis=1)
    said = np.stack([digit == v for v in (BAD, GOOD)], axis=2).astype(float)
    prior_votes = np.array([[[1.0, 1.0]], [[PRIOR_WRONG * PRIOR_VOTES, (1 - PRIOR_WRONG) * PRIOR_VOTES]]])
    p = np.where(said[:, :, BAD].any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        mass = np.stack([n * (1 - p), n * p])
        prior = (mass.sum(1) + 1) / (n.sum() + 2)
        shares = np.einsum("cp,plv->clv", mass, said) + prior_votes
        shares /= shares.sum(axis=2, keepdims=True)
        score = np.log(prior)[:, None] + np.einsum("plv,clv->cp", said, np.log(shares))
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        done = not len(n) or np.abs(new - p).max() < 1e-9
        p = new
        if done:
            break
    return Weighed(float(prior[GOOD]), shares, {int(c): float(x) for c, x in zip(codes, p)})


def weigh_votes(patterns: dict[int, int]) -> dict[int, float]:
    """Probability of good for each pattern."""
    return estimate(patterns).posterior


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float

    def probability(self, found: dict[int, float]) -> float:
        z = self.bias + sum(self.weights[b] * v for b, v in found.items())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit_scorer(rows: list[tuple[list[int], list[float], float]], steps: int = 400, rate: float = 0.3, ridge: float = 1e-5) -> Scorer:
    """Logistic regression on soft labels, by Adam over the whole sample."""
    w, b = np.zeros(BUCKETS), 3.0
    if not rows:
        return Scorer(w, b)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    col = np.array([i for r in rows for i in r[0]], dtype=np.int64)
    val = np.array([v for r in rows for v in r[1]])
    y = np.array([r[2] for r in rows])
    m, s = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, w[col] * val, len(rows))
        slope = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(rows)
        g = np.append(np.bincount(col, val * slope[row], BUCKETS) + ridge * w, slope.sum())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-10)
        w, b = w - step[:-1], b - step[-1]
    return Scorer(w, float(b))


@F.pandas_udf(T.IntegerType())
def vote_pattern(text: pd.Series) -> pd.Series:
    return pd.Series([votes(read_text(t)[0]) for t in text], dtype="int32")


_SAMPLE = (
    T.StructType()
    .add("pattern", T.IntegerType())
    .add("bucket", T.ArrayType(T.IntegerType()))
    .add("share", T.ArrayType(T.DoubleType()))
)


@F.pandas_udf(_SAMPLE)
def sample_row(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        stats, counts = read_text(t)
        found = features(stats, counts)
        rows.append((votes(stats), list(found), list(found.values())))
    return pd.DataFrame(rows, columns=["pattern", "bucket", "share"])


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """``doc_id, text`` -> the scorer. Votes are counted over all rows; the sample is about ``sample_rows`` of them."""
    bounded_batches(docs.sparkSession)
    counted = docs.groupBy(vote_pattern("text").alias("pattern")).count().collect()
    patterns = {r["pattern"]: r["count"] for r in counted}
    posterior = weigh_votes(patterns)
    share = min(1.0, sample_rows / max(1, sum(patterns.values())))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = docs.where(drawn).select(sample_row("text").alias("r")).select("r.*").toArrow().to_pylist()
    return fit_scorer([(r["bucket"], r["share"], posterior.get(r["pattern"], 0.5)) for r in sample])


def score_column(scorer: Scorer, text: str = "text") -> Column:
    """Probability that a text is good, from the text alone. The scorer has a fixed size and goes with the task."""

    @F.pandas_udf(T.DoubleType())
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series([scorer.probability(features(*read_text(t))) for t in texts], dtype="float64")

    return probability(F.col(text))


def classify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, score, kept``."""
    scored = docs.select("doc_id", score_column(fit(docs, sample_rows)).alias("score"))
    return scored.withColumn("kept", F.col("score") >= keep_from)


def keep_good(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` without the rows the scorer rejects, columns as they are; no shuffle of texts."""
    return docs.where(score_column(fit(docs, sample_rows)) >= keep_from)
