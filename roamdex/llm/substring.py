"""Substring dedup by hashing units of text: of equal units in the whole table the first stays, the rest are cut out.

Units are the sentences of a text's lines: it is cut after line ends and after sentence ends (. ! ? before white space).
A unit of more than ``LONG_UNIT`` words is cut further, after each word whose hash says so (one word in eight), so that
both copies of a passage without sentence ends are cut alike, whatever stands around them. A unit is normalised (A-Z to
lower case, runs of ASCII white space to one space, ends trimmed) and stands for its digest. The order of occurrences is
document id (null last), then place in the text.

A repeated unit is cut out where it lies in a run of repeated units of ``min_words`` words together, or where all units
of its line are repeated, however short. So a passage is found from its first whole unit to its last one. What is cut is
told by its original offsets.

Units are counted by 64-bit hashes first; those that occur twice or more go to the tasks as a Bloom filter of at most
``FILTER_BYTES``, and only their places are shuffled to find the first of each, by 128-bit digests. A false positive of
the filter adds a place, which the exact grouping drops. Texts move once, to meet what is cut out of them.

Defined cases: null and empty texts pass unchanged; rows that repeat a ``doc_id`` are read as one document's copies
and ranked among each other by text digest, rows equal in both keep their units alike; an empty table gives no rows;
other columns pass through, also where their names equal those added here, which are given as parameters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamdex.llm import bloom
from roamdex.llm.common import bounded_batches, fresh, stored, written

MIN_WORDS = 10
LONG_UNIT = 25
FILTER_BYTES = 32 * 1024 * 1024

# A-Z to lower case and all white space but line ends to blanks, byte by byte, so that places stay.
_NORMAL = bytes.maketrans(bytes(range(65, 91)) + b"\t\x0b\x0c\r", bytes(range(97, 123)) + b"    ")
_UNIT_END = re.compile(rb"[.!?\n](?:(?<=\n)| +)")
_TOKEN = re.compile(rb"[ \n]*[^ \n]+[ \n]*")


class _Cuts(dict):
    """Whether a long unit is cut after a word: the first digit of its digest is 0 or 8. Kept for many words, not for all."""

    def __missing__(self, token: bytes) -> bool:
        if len(self) > 400_000:
            self.clear()
        cut = md5(token.strip()).digest()[0] & 0x70 == 0
        if len(token) <= 64:
            self[token] = cut
        return cut


_cuts = _Cuts()


def unit_ends(normal: bytes) -> list[int]:
    """Where the units of a text end, read off its ``_NORMAL`` form."""
    ends, at = [], 0
    for end in [*(m.end() for m in _UNIT_END.finditer(normal)), len(normal)]:
        if normal.count(b" ", at, end) >= LONG_UNIT and len(normal[at:end].split()) > LONG_UNIT:
            for token in _TOKEN.findall(normal, at, end):
                at += len(token)
                if at < end and _cuts[token]:
                    ends.append(at)
            ends.append(end)
        elif end > at:
            ends.append(end)
        at = end
    return ends


def units(text: bytes) -> list[bytes]:
    """A UTF-8 text cut into its units; put together they are the text."""
    ends = unit_ends(text.translate(_NORMAL))
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def unit_digests(text: bytes) -> list[bytes | None]:
    """Digest of each unit's words with single blanks between; none for a unit without words."""
    from xxhash import xxh3_128_digest

    normal = text.translate(_NORMAL)
    ends = unit_ends(normal)
    out: list[bytes | None] = []
    for a, b in zip([0, *ends], ends):
        unit = normal[a:b].strip()
        if b"  " in unit:
            unit = b" ".join(unit.split())
        out.append(xxh3_128_digest(unit) if unit else None)
    return out


def _digests(batch: pa.RecordBatch, copies: bool = True) -> Iterator[tuple]:
    """Id, digest of the whole text, and the units' digests, of every row with a text."""
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
        if text:
            yield doc_id, md5(text).digest()[:8] if copies else None, unit_digests(text)


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), np.uint64)


def repeated_filter(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> bloom.Filter:
    """Filter of the units that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = np.unique(_keys([d for *_, ds in _digests(batch, False) for d in ds if d]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    counts = docs.select("doc_id", "text").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    repeated = stored(counts.where("n > 1").select("key", F.lit(1).cast("tinyint").alias("level")))
    return bloom.build(repeated, bloom.blocks_for(2 * repeated.count(), filter_bytes))


def unit_places(docs: DataFrame, repeated: bloom.Filter) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, copy, unit, digest`` of every unit that the filter holds.

    ``copy`` is a digest of the whole text, to tell rows with one ``doc_id`` apart.
    """
    shared = docs.sparkSession.sparkContext.broadcast(repeated)
    kinds = [("doc_id", pa.int64()), ("copy", pa.binary()), ("unit", pa.int32()), ("digest", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, copy, k, d) for i, copy, ds in _digests(batch) for k, d in enumerate(ds) if d]
            hit = np.flatnonzero(shared.value.has(_keys([r[3] for r in rows]))).tolist()
            columns = zip(*[rows[k] for k in hit]) if hit else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, copy binary, unit int, digest binary")


def repeated_units(places: DataFrame) -> DataFrame:
    """``doc_id, copy, units``: the numbers of the units that are not the first of their kind, for documents with some.

    The first occurrence of each digest is found by a minimum with map-side combine, over digests that occur twice or
    more. The join back has the hot units on one side only, whose partitions the skew join splits.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "copy", "unit")
    firsts = stored(
        places.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    )
    later = places.join(firsts, "digest").where(
        ~(
            F.col("first.doc_id").eqNullSafe(F.col("doc_id"))
            & (F.col("first.copy") == F.col("copy"))
            & (F.col("first.unit") == F.col("unit"))
        )
    )
    # A document's own units come together here, as they do in its text. Rows equal in id and text count once.
    return later.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_set("unit")).alias("units"))


def cut_units(text: str, repeated: list[int], min_words: int = MIN_WORDS) -> tuple[str, list[dict]]:
    """Text without the repeated units that fill a line or lie in a run of ``min_words`` words; code point spans cut out."""
    raw = text.encode()
    normal, again = raw.translate(_NORMAL), set(repeated)
    ends = unit_ends(normal)
    parts = [normal[a:b] for a, b in zip([0, *ends], ends)]
    # Words are counted where they matter; elsewhere only whether there are any.
    words = [len(p.split()) if k in again else int(not p.isspace()) for k, p in enumerate(parts)]
    places = ends if text.isascii() else np.cumsum([len(raw[a:b].decode()) for a, b in zip([0, *ends], ends)]).tolist()
    gone: set[int] = set()

    def take(run: list[int], least: int) -> None:
        if run and sum(words[k] for k in run) >= least:
            gone.update(run)

    run: list[int] = []
    line: list[int] = []
    for k, part in enumerate(parts):
        # Units without words neither make a run nor end it.
        if words[k] == 0 or k in again:
            run.append(k)
        else:
            take(run, min_words)
            run = []
        line.append(k)
        if part.endswith(b"\n") or k == len(parts) - 1:
            if all(words[i] == 0 or i in again for i in line):
                take(line, 1)
            line = []
    take(run, min_words)
    spans: list[dict] = []
    for k in sorted(gone):
        start = places[k - 1] if k else 0
        if spans and spans[-1]["end"] == start:
            spans[-1]["end"] = places[k]
        else:
            spans.append({"start": start, "end": places[k]})
    # What stays before a cut within a line keeps its line end.
    for span in spans:
        if span["start"] and text[span["start"] - 1] != "\n" and text[span["end"] - 1] == "\n":
            span["end"] -= 1
    spans = [s for s in spans if s["start"] < s["end"]]
    starts, ends = [s["start"] for s in spans], [s["end"] for s in spans]
    return "".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)])), spans


def dedup_units(
    docs: DataFrame, min_words: int = MIN_WORDS, kept_column: str = "kept_text", spans_column: str = "removed"
) -> DataFrame:
    """``docs`` with the text that stays and the spans (start, end) removed, both by code points of the whole text."""
    bounded_batches(docs.sparkSession)
    places = written(unit_places(docs, repeated_filter(docs)), "units")
    cuts = stored(repeated_units(places))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id", F.unhex(F.substring(F.md5(F.col("text").cast("binary")), 1, 16)).alias("copy"),
    )
    names = [F.col("cut_id"), F.col("cut_copy")]
    cuts = cuts.select(F.col("doc_id").alias("cut_id"), F.col("copy").alias("cut_copy"), "units")
    met = keyed.join(cuts, F.col("doc_id").eqNullSafe(names[0]) & (F.col("copy") == names[1]), "left")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            found = [
                cut_units(text, repeated, min_words) if repeated else (text, [])
                for text, repeated in zip(row.field("text").to_pylist(), batch.column("units").to_pylist())
            ]
            columns = [row, pa.array([t for t, _ in found], pa.string()), pa.array([s for _, s in found], span)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "kept", "spans"])

    spans_kind = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
    kinds = T.StructType([keyed.schema["row"]]).add("kept", "string").add("spans", spans_kind)
    cut = met.select("row", "units").mapInArrow(run, kinds)
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in (kept_column, spans_column)]
    return cut.select(*kept, F.col("kept").alias(kept_column), F.col("spans").alias(spans_column))


def keep_first_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated lines and runs of units cut out of ``text`` and ``n_chars`` brought up to date; columns as they are.

    A document of which nothing is left has the empty text.
    """
    kept = fresh(docs, "kept")
    cut = dedup_units(docs, min_words, kept, fresh(docs, "spans")).withColumn("text", F.col(kept))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length(kept).cast(docs.schema["n_chars"].dataType))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])
