"""SimHash near-duplicates, found over anchor points of a covering code.

Fingerprints at 3 or fewer differing bits differ in at most one bit of their low or of their high half. So each half
is covered by itself, with threshold 1. The anchors of a half are the code words of the perfect code of length 31
(covering radius 1) on its lower 31 bits: every value is at home at exactly one anchor, within radius 1, and two
values one bit apart are never more than 2 from each other's anchor. A fingerprint is sent to its home, and as a
visitor to every anchor within radius plus threshold (16 at most); homes meet visitors per anchor and each pair is
verified on all 64 bits. The search is exact: no pair within 3 bits is missed.

Documents with one fingerprint are one class, linked by its smallest document; pairs are made between classes only.
A fingerprint has at most 43,744 others within 3 bits, however large the input, so no class can have more partners.

Defined cases: a null text counts as empty, and texts without words have fingerprint zero and link like any other;
rows with a null ``doc_id`` get a fingerprint and, where their class has no other row, a null component; repeated
rows fall into one class; an empty table gives no rows; other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamdex.llm.common import bounded_batches, fresh, stored
from roamdex.llm.components import components

SHINGLE = 3
SEED = 42
MOST_BITS = 3

_LANES = np.uint64(0x0101010101010101)
# Shingles hashed at once; a longer text adds up its bit counts over several such blocks.
_BLOCK = 255 * 512


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set, lowest first.

    Eight lanes of one byte each are counted at once; 255 rows fit a lane.
    """
    n = -(-len(hashes) // 255) * 255
    rows = np.zeros(n, np.uint64)
    rows[: len(hashes)] = hashes
    rows = rows.reshape(-1, 255)
    out = np.empty((8, 8), np.int64)
    for k in range(8):
        lanes = ((rows >> np.uint64(k)) & _LANES).sum(axis=1, dtype=np.uint64)
        out[:, k] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.reshape(64)


def _streams(hashes: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The hashes, then as many further 64-bit hashes made of them (splitmix) as are asked for."""
    yield hashes
    for k in range(1, words):
        z = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        yield z ^ (z >> np.uint64(31))


def _hash_blocks(tokens: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of a text with words, in blocks; fewer words than a shingle has are one."""
    import xxhash

    for at in range(0, max(1, len(tokens) - shingle + 1), _BLOCK):
        some = tokens[at : at + _BLOCK + shingle - 1]
        ends = np.cumsum([len(w) + 1 for w in some])
        joined = b" ".join(some)
        n = max(1, len(some) - shingle + 1)
        starts = [0, *ends[: n - 1].tolist()]
        stops = (ends[min(shingle, len(some)) - 1 :] - 1).tolist()
        parts = [joined[a:b] for a, b in zip(starts, stops)]
        yield np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)


def _simhash(blocks: list[np.ndarray], words: int) -> list[int]:
    if not blocks:
        return [0] * words
    counts, total = np.zeros((words, 64), np.int64), sum(map(len, blocks))
    for hashes in blocks:
        for k, stream in enumerate(_streams(hashes, words)):
            counts[k] += _bit_counts(stream)
    return np.packbits(counts * 2 > total, axis=1, bitorder="little").view(np.int64).ravel().tolist()


def fingerprint(text: bytes | None, shingle: int = SHINGLE, words: int = 1) -> list[int]:
    """SimHash of a UTF-8 text, as ``words`` numbers of 64 bits.

    A-Z to lower case, words by ASCII white space, shingles hashed by XXH64 with seed 42; the first number is their
    plain SimHash, the others those of further hashes made of it.
    """
    tokens = (text or b"").lower().split()
    return _simhash(list(_hash_blocks(tokens, shingle)) if tokens else [], words)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, words: int = 1) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, fp`` (array of bigint, 64 bits each)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fps = pa.array([fingerprint(t, shingle, words) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp array<bigint>")


_CODE_BITS = 31
# Check j of the code is over the places whose number (from 1) has bit j set.
_CHECKS = [sum(1 << (p - 1) for p in range(1, _CODE_BITS + 1) if p >> j & 1) for j in range(5)]


def _syndrome(x: Column) -> Column:
    """Number of the place whose flip makes ``x`` a code word; 0 where it is one."""
    s = F.lit(0)
    for j, check in enumerate(_CHECKS):
        s = s + F.shiftleft(F.bit_count(x.bitwiseAND(F.lit(check))).bitwiseAND(F.lit(1)), j)
    return s


def _flip(x: Column, place: Column) -> Column:
    return x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place - 1))


def _anchors(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Homes and visits: ``half, anchor, fp, rep``, for both halves of every word of a fingerprint.

    A visit says whether it is one to the home.
    """
    low = F.lit((1 << _CODE_BITS) - 1)
    words = F.transform(
        "fp",
        lambda w, i: F.array(
            F.struct((2 * i).alias("half"), w.bitwiseAND(low).alias("x")),
            F.struct((2 * i + 1).alias("half"), F.shiftrightunsigned(w, 32).bitwiseAND(low).alias("x")),
        ),
    )
    split = classes.select("fp", "rep", F.inline(F.flatten(words))).withColumn("s", _syndrome(F.col("x")))
    home = F.when(F.col("s") == 0, F.col("x")).otherwise(_flip(F.col("x"), F.col("s")))
    homes = split.select("half", home.alias("anchor"), F.col("fp").alias("home_fp"), F.col("rep").alias("home_rep"))
    # Two flips reach a code word where the numbers of their places make up the syndrome.
    pairs = F.filter(
        F.sequence(F.lit(1), F.lit(_CODE_BITS)),
        lambda i: (F.col("s") > 0) & (i < i.bitwiseXOR(F.col("s"))),
    )
    two = F.transform(pairs, lambda i: _flip(_flip(F.col("x"), i), i.bitwiseXOR(F.col("s"))))
    visited = F.posexplode(F.concat(F.array(home), two)).alias("place", "anchor")
    visits = split.select("half", visited, "fp", "rep")
    return homes, visits.withColumn("at_home", F.col("place") == 0).drop("place")


def class_links(classes: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``fp, rep`` (one row per fingerprint of one word) -> ``u, v``: the reps of any two within ``most_bits``."""
    if not 0 <= most_bits <= 3:
        raise ValueError("two halves with threshold 1 cover up to 3 differing bits")
    one = F.col("fp")[0].alias("fp")
    homes, visits = _anchors(classes)
    homes = homes.select("half", "anchor", F.col("home_fp")[0].alias("home_fp"), "home_rep")
    near = homes.join(visits.select("half", "anchor", one, "rep"), ["half", "anchor"]).where(
        (F.col("home_fp") != F.col("fp")) & (F.bit_count(F.col("home_fp").bitwiseXOR(F.col("fp"))) <= most_bits)
    )
    return near.select(F.least("home_rep", "rep").alias("u"), F.greatest("home_rep", "rep").alias("v")).distinct()


def _classes(marked: DataFrame) -> DataFrame:
    return stored(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")))


def _of_rows(marked: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every row, from the links of the classes."""
    linked = components(links)
    of_class = stored(
        classes.join(linked, classes["rep"] == linked["node"], "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id")
        )
    )
    return marked.join(of_class, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    marked = stored(fingerprints(docs, shingle))
    classes = _classes(marked)
    found = _of_rows(marked, classes, class_links(classes.where("rep is not null"), most_bits))
    digits = F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; columns as they are.

    Of rows that share a ``doc_id`` the first in the order of all columns stays. Rows without an id all stay.
    """
    found = stored(near_duplicates(docs, shingle, most_bits).select("doc_id", "component_id"))
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = stored(found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    order = Window.partitionBy("doc_id").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"], "doc_id")
    n = fresh(docs, "n")
    first = left.join(repeated, "doc_id", "left_semi").withColumn(n, F.row_number().over(order)).where(F.col(n) == 1)
    return left.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))
