"""Language of a text by a mixture over its parts: EM on n-gram likelihoods, the set of languages by a penalty.

The model is a table of hashed character trigram counts per language, learnt from labelled documents (about
``ROWS_PER_LANGUAGE`` of each language, drawn by hash; a parameter). A text is cut into windows of trigrams; each
window has a likelihood under each language, and EM estimates the text's proportions of languages. Languages are then
taken out one by one, the least first; the set with the best likelihood less ``PENALTY`` per language (scaled by the
log of the number of windows) is the text's, and its largest share is the prediction.

Defined cases: a null text and a text without letters are ``und`` with score 0; equal shares go to the language first
by name; without any labelled text every prediction is ``und``; repeated rows count and are predicted each; an empty
table gives no rows; other columns are not looked at, and a prediction sees the text only.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamdex.llm.common import bounded_batches

BUCKETS = 1 << 15
ROWS_PER_LANGUAGE = 5_000
WINDOW = 48
PENALTY = 1.0
UNKNOWN = "und"
EM_ROUNDS = 15
SMOOTHING = 0.5
# Code points worked on at once.
_SLICE = 1 << 20
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, a space for all others. Made once per worker."""
    table = np.full(sys.maxunicode + 1, _SPACE, np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of a text's trigrams, -1 for those without a letter, in slices."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    for at in range(0, max(1, len(codes)), _SLICE):
        some = _letters()[codes[max(0, at - 1) : at + _SLICE + 1]]
        if at == 0:
            some = np.concatenate([[np.uint32(_SPACE)], some])
        if at + _SLICE >= len(codes):
            some = np.concatenate([some, [np.uint32(_SPACE)]])
        a, b, c = some[:-2], some[1:-1], some[2:]
        mixed = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77) ^ c * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        found = (mixed >> np.uint32(17)).astype(np.int32)
        found[(a == _SPACE) & (b == _SPACE) & (c == _SPACE)] = -1
        yield found


class Model(NamedTuple):
    languages: list[str]
    log_p: np.ndarray  # buckets + 1 rows, the last for trigrams without a letter


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """``doc_id, text, lang`` -> the model. Rows without a language or a text teach nothing."""
    bounded_batches(labelled.sparkSession)
    known = labelled.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32))
    cut = F.create_map(*[F.lit(x) for l in languages for x in (l, int(min(1, rows_per_language / sizes[l]) * (1 << 30)))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    drawn = known.where(place < F.element_at(cut, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for found in trigrams(text):
                    total += np.bincount(found[found >= 0], minlength=BUCKETS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                ["lang", "bucket", "n"],
            )

    counted = drawn.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    of = {l: k for k, l in enumerate(languages)}
    at = np.array([of[l] for l in rows.column("lang").to_pylist()], dtype=np.int64)
    counts[rows.column("bucket").to_numpy(), at] += rows.column("n").to_numpy()
    log_p = np.log(counts / counts.sum(axis=0))
    return Model(languages, np.vstack([log_p, np.zeros((1, len(languages)))]).astype(np.float32))


def windows(model: Model, text: str | None) -> np.ndarray:
    """Log-likelihood of each window of a text (rows) under each language; none where it has no letter."""
    parts = []
    for found in trigrams(text):
        found = found[found >= 0]
        if len(found):
            parts.append(np.add.reduceat(model.log_p[found], np.arange(0, len(found), WINDOW), axis=0))
    return np.concatenate(parts) if parts else np.zeros((0, len(model.languages)), np.float32)


def _em(like: np.ndarray, peak: np.ndarray, of: np.ndarray, starts: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each text, from a start whose zeros stay zero."""
    n = np.add.reduceat(np.ones(len(of)), starts)[:, None]
    for _ in range(EM_ROUNDS):
        weighed = like * share[of]
        weighed /= np.maximum(weighed.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(weighed, starts, axis=0) / n
    total = np.log(np.maximum((like * share[of]).sum(axis=1), 1e-300)) + peak
    return share, np.add.reduceat(total, starts)


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and its share of each text. Texts of one call are worked on together."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    found = [windows(model, t) if model.languages else np.zeros((0, 0)) for t in texts]
    ids = [i for i, w in enumerate(found) if len(w)]
    if not ids:
        return out
    sizes = np.array([len(found[i]) for i in ids])
    starts, of = np.append(0, np.cumsum(sizes)[:-1]), np.repeat(np.arange(len(ids)), sizes)
    log_like = np.concatenate([found[i] for i in ids]).astype(np.float64)
    peak = log_like.max(axis=1)
    like = np.exp(log_like - peak[:, None])
    k = len(model.languages)
    share, total = _em(like, peak, of, starts, np.full((len(ids), k), 1.0 / k))
    penalty = PENALTY * np.log(sizes + 1)
    # Shares may reach zero by themselves: the penalty counts the languages that are left, and none is taken out for them.
    best, best_share = total - penalty * (share > 0).sum(axis=1), share.copy()
    for left in range(k - 1, 0, -1):
        many = np.flatnonzero((share > 0).sum(axis=1) > left)
        least = np.where(share > 0, share, np.inf).argmin(axis=1)
        share = share.copy()
        share[many, least[many]] = 0
        share /= share.sum(axis=1, keepdims=True)
        share, total = _em(like, peak, of, starts, share)
        value = total - penalty * (share > 0).sum(axis=1)
        better = value > best
        best, best_share[better] = np.where(better, value, best), share[better]
    top = best_share.argmax(axis=1)
    for j, i in enumerate(ids):
        out[i] = (model.languages[top[j]], float(min(1.0, best_share[j, top[j]])))
    return out


def language_column(model: Model, text: str = "text") -> Column:
    """Struct ``lang, score`` of a text. The model has a size fixed by its buckets and languages."""

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for at in range(0, len(texts), 256):
            rows += predict(model, [t for t in texts.iloc[at : at + 256]])
        return pd.DataFrame(rows, columns=["lang", "score"])

    return run(F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of documents that is never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """``doc_id, text, lang`` -> ``doc_id, held_out, lang_pred, score``."""
    model = fit(docs.where(~held_out()), rows_per_language)
    marked = docs.select("doc_id", held_out().alias("held_out"), language_column(model).alias("found"))
    return marked.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")
