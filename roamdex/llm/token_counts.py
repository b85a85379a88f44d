"""Token counts by a two-tier lookup, inside map tasks.

Every text is cut into the tokenizer's pre-tokens. Each is looked up first in a broadcast table of frequent pre-tokens and
their token counts, then in a bounded cache that a Python worker keeps over its tasks; only a miss of both is encoded. No
pre-token is shuffled.

The table holds the pre-tokens that are entries of the vocabulary and the ``SAMPLE_WORDS`` commonest others of about
``SAMPLE_ROWS`` documents, so vocabulary and parameters bound it. The sample decides what is looked up where, never a count.

Special strings inside a text are one token each, and the text is cut there first, as the library does. Texts made of
the characters below are cut by pattern, any other text (rare scripts, control characters) by the tokenizer's own
pre-tokenizer; both give the same pieces.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows are counted each; an empty table gives
no rows; other columns are kept out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamdex.llm.common import bounded_batches

CACHE_ENTRIES = 400_000
SAMPLE_ROWS = 1_000
#: Commonest pre-tokens that a task of the sample hands on, and that the table takes from all of them.
TASK_WORDS, SAMPLE_WORDS = 200, 20_000
#: Longer pre-tokens are never remembered.
LONGEST_KEPT = 64
LIMIT = 1024

# --- fixed values: the byte-level pre-token pattern, for texts that hold none of OTHER ---
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?[^\W\d_]+"
    r"| ?\d+"
    r"| ?(?:[^\s\w]|_)+"
    r"|\s+(?!\S)|\s+"
)
# Characters whose class (letter, digit, space, other) is the same in the tokenizer and in ``re``: Latin and common
# punctuation. Superscript digits and fractions are left out, as are the separators 1C to 1F.
OTHER = "[^\t\n\x0b\x0c\r\x20-\x7e\x80-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞]"


class _Lengths(dict):
    """Pre-token -> tokens; a pre-token that is missing is encoded and kept."""

    def __init__(self, tokenizer, frequent: dict[str, int], entries: int) -> None:
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.entries = tokenizer, frequent, entries + len(frequent)

    def __missing__(self, part: str) -> int:
        n = len(self.tokenizer.encode(part, add_special_tokens=False).ids)
        if len(self) >= self.entries:
            self.clear()
            self.update(self.frequent)
        if len(part) <= LONGEST_KEPT:
            self[part] = n
        return n


class _Cutter:
    """Text -> its pre-tokens, and the number of special strings between them."""

    def __init__(self, tokenizer) -> None:
        added = tokenizer.get_added_tokens_decoder().values()
        if tokenizer.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("a tokenizer without normalizer and with plain special strings is needed")
        special = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.odd = re.compile(OTHER).search
        self.by_pattern = re.compile(PRE_TOKEN).findall
        self.by_tokenizer = tokenizer.pre_tokenizer.pre_tokenize_str

    def pieces(self, text: str) -> list[str]:
        if not self.odd(text):
            return self.by_pattern(text)
        return [text[a:b] for _, (a, b) in self.by_tokenizer(text)]

    def __call__(self, text: str) -> tuple[list[str], int]:
        stretches = self.special.split(text)
        if len(stretches) == 1:
            return self.pieces(text), 0
        return [p for s in stretches for p in self.pieces(s)], len(stretches) - 1


def sampled_words(docs: DataFrame, json: str, rows: int = SAMPLE_ROWS) -> list[str]:
    """The commonest pre-tokens of about ``rows`` documents; each task hands on a bounded list, so no row depends on texts."""
    n = docs.count()

    def commonest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        cut, found = _Cutter(Tokenizer.from_str(json)), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(p for p in cut(text or "")[0] if len(p) <= LONGEST_KEPT)
        best = sorted(found.items(), key=lambda w: (-w[1], w[0]))[:TASK_WORDS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in best], pa.string()), pa.array([k for _, k in best], pa.int64())], ["word", "n"]
        )

    sample = docs.sample(min(1.0, rows / max(n, 1)), seed=4).select("text")
    total: Counter = Counter()
    for r in sample.mapInArrow(commonest, "word string, n bigint").toLocalIterator():
        total[r["word"]] += r["n"]
    return [w for w, _ in sorted(total.items(), key=lambda w: (-w[1], w[0]))[:SAMPLE_WORDS]]


def frequent_lengths(tokenizer, words: list[str]) -> dict[str, int]:
    """Tokens of ``words`` and of each pre-token that is an entry of the vocabulary, as its own encoder counts them."""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ids = sorted(tokenizer.get_vocab(with_added_tokens=False).values())
    texts = {*tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False), *words}
    # Only what is cut out alone is an entry: a run of spaces is cut before a word, and parts of characters are no text.
    cut = _Cutter(tokenizer)
    texts = sorted(t for t in texts if t and t not in special and "\ufffd" not in t and cut.pieces(t) == [t])
    return {t: len(e.ids) for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False))}


_WORKER: dict[int, tuple] = {}


def _worker_lengths(key: int, json: str, frequent: dict[str, int], entries: int) -> tuple:
    """Cutter and cache of this Python worker; they live as long as it does."""
    if key not in _WORKER:
        from tokenizers import Tokenizer

        _WORKER.clear()
        tokenizer = Tokenizer.from_str(json)
        _WORKER[key] = (_Cutter(tokenizer), _Lengths(tokenizer, frequent, entries))
    return _WORKER[key]


def count_tokens(docs: DataFrame, tokenizer_file: str, cache_entries: int = CACHE_ENTRIES, limit: int = LIMIT) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_bytes, n_tokens, over_limit``.

    The tokenizer's own file (a ``.json`` of the tokenizers library, byte-level pre-tokens) is read on the driver and
    broadcast with the table: two objects of a size that the vocabulary bounds.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        json = f.read()
    tokenizer = Tokenizer.from_str(json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    json = tokenizer.to_str()
    shared = spark.sparkContext.broadcast((json, frequent_lengths(tokenizer, sampled_words(docs, json))))
    key = hash((json, cache_entries))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, lengths = _worker_lengths(key, *shared.value, cache_entries)
        of = lengths.__getitem__
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode()))
                pieces, special = cut(text)
                n_tokens.append(sum(map(of, pieces)) + special)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = docs.select("doc_id", "text").mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
