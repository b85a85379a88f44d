"""Fill-in-middle transformation by a secondary sort of pieces.

A text is cut into units (runs of ASCII letters, any other character by itself), and at two units drawn by a hash of its
id into prefix, middle and suffix. It is emitted as pieces of at most ``CHUNK_UNITS`` units and ``PIECE_BYTES`` bytes, keyed by
document and by the piece's position in the output, sentinels being pieces of their own. Pieces are dealt by document
and sorted by (document, output position) within partitions; a task streams them into a digest of the output. The same
stream, read by its sentinels and the form alone, gives each piece its position in the text; sorted again by that within
the same partitions, without another shuffle, the pieces stream into the digest of the restored text. No task holds a
document whole after it was cut, and sorts spill.

Defined cases: a null text counts as empty; a null ``doc_id`` is drawn for as the empty text; rows equal in id and text are
assembled once (once per batch they come in, before the shuffle) and given as often as they occur; an empty table gives no
rows; other columns are kept out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roamdex.llm.common import bounded_batches
from roamdex.llm.ngrams import byte_class

CHUNK_UNITS = 4096
PIECE_BYTES = 64 * 1024
SCAN_BYTES = 1 << 20

# --- fixed values: sentinels, and the shares of the forms ---
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100

_LETTERS = byte_class(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def draws(doc_id: int | None) -> list[int]:
    """The four numbers that decide a document's cuts and form."""
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


class Units:
    """Where the units of a UTF-8 text begin, in bytes; read in blocks, so that only counts are kept."""

    def __init__(self, text: bytes) -> None:
        self.data = np.frombuffer(text, np.uint8)
        self.before = [0]
        marks = []
        for at in range(0, len(self.data), SCAN_BYTES):
            starts = self._starts(at)
            first = -self.before[-1] % CHUNK_UNITS
            marks.append(starts[first::CHUNK_UNITS] + at)
            self.before.append(self.before[-1] + len(starts))
        #: The start of every CHUNK_UNITS-th unit.
        self.marks = np.concatenate(marks) if marks else np.zeros(0, np.int64)

    def __len__(self) -> int:
        return self.before[-1]

    def _starts(self, at: int) -> np.ndarray:
        block = self.data[at : at + SCAN_BYTES]
        letter = _LETTERS[block]
        inner = letter.copy()
        inner[1:] &= letter[:-1]
        inner[0] &= at > 0 and bool(_LETTERS[self.data[at - 1]])
        return np.flatnonzero(~inner & ((block & 0xC0) != 0x80))

    def start(self, unit: int) -> int:
        """Byte at which a unit begins; the end of the text for the number of units."""
        if unit >= len(self):
            return len(self.data)
        k = int(np.searchsorted(self.before, unit, "right")) - 1
        return k * SCAN_BYTES + int(self._starts(k * SCAN_BYTES)[unit - self.before[k]])

    def chars(self, a: int, b: int) -> int:
        """Code points between two bytes."""
        return sum(int(np.count_nonzero((self.data[i : min(b, i + SCAN_BYTES)] & 0xC0) != 0x80)) for i in range(a, b, SCAN_BYTES))

    def pieces(self, a: int, b: int) -> Iterator[bytes]:
        cuts = [a, *self.marks[(self.marks > a) & (self.marks < b)].tolist(), b]
        for x, y in zip(cuts, cuts[1:]):
            for i in range(x, y, PIECE_BYTES):
                yield self.data[i : min(y, i + PIECE_BYTES)].tobytes()


def transformed(doc_id: int | None, text: bytes) -> tuple[dict, Iterator[bytes]]:
    """Facts of one document, and its output in pieces."""
    units = Units(text)
    n = len(units)
    h1, h2, h3, h4 = draws(doc_id)
    if n == 0 or h3 % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None}, units.pieces(0, len(text))
    low, high = sorted((units.start(h1 % (n + 1)), units.start(h2 % (n + 1))))
    parts = {PREFIX: (0, low), MIDDLE: (low, high), SUFFIX: (high, len(text))}
    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    facts = {"n": n, "form": form, "prefix_chars": units.chars(0, low), "middle_chars": units.chars(low, high)}
    return facts, (p for s in order for p in (s, *units.pieces(*parts[s])))


_FACTS = "n bigint, form string, prefix_chars bigint, middle_chars bigint"
_FACT_KINDS = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
_KEY_KINDS = {"copy": pa.binary(), "doc_id": pa.int64()}


class _Rows:
    """Rows of one schema, given out as batches of a bounded size."""

    def __init__(self, kinds: dict[str, pa.DataType]) -> None:
        self.kinds, self.rows, self.size = kinds, [], 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size + 64

    def full(self) -> bool:
        return self.size > 8 * 1024 * 1024

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[] for _ in self.kinds]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.kinds.values())], list(self.kinds))
        self.rows, self.size = [], 0
        return out


def output_pieces(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``copy, doc_id, place, body`` with the facts and number of copies in the row of place 0.

    ``copy`` is the text's digest, which tells rows with one ``doc_id`` apart.
    """
    bounded_batches(docs.sparkSession)
    kinds = {**_KEY_KINDS, "place": pa.int64(), "body": pa.binary(), **_FACT_KINDS, "copies": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(kinds)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            equal = Counter(zip(batch.column("doc_id").to_pylist(), texts))
            for (doc_id, text), copies in equal.items():
                key = (md5(text).digest(), doc_id)
                facts, pieces = transformed(doc_id, text)
                rows.add((*key, 0, b"", *facts.values(), copies))
                for place, body in enumerate(pieces, 1):
                    rows.add((*key, place, body, None, None, None, None, None), len(body))
                    if rows.full():
                        yield rows.batch()
        yield rows.batch()

    schema = f"copy binary, doc_id bigint, place bigint, body binary, {_FACTS}, copies bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each output (a row of part -1), and its pieces with the part of the text that each belongs to."""
    kinds = {**_KEY_KINDS, "part": pa.int64(), "place": pa.int64(), "body": pa.binary(), **_FACT_KINDS, "copies": pa.int64()}
    rows = _Rows(kinds)
    key, place, part, facts, copies, digest = None, 0, 0, (), 0, sha256()
    number = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(4)]
        heads = batch.select(["n", "form", "prefix_chars", "middle_chars", "copies"])
        for i, (copy, doc_id, at, body) in enumerate(zip(*columns)):
            if (copy, doc_id) != key:
                if key is not None:
                    rows.add((*key, -1, 0, digest.digest(), *facts, copies))
                key, place, part, copies, digest = (copy, doc_id), -1, 0, 0, sha256()
            if at == 0:
                *facts, more = [c[i].as_py() for c in heads.columns]
                copies += more
            if at == place:
                continue  # the same piece, from rows equal in id and text
            place = at
            if at == 0:
                continue
            digest.update(body)
            if facts[1] != "plain" and body in number:
                part = number[body]
                continue
            rows.add((*key, part, at, body, None, None, None, None, None), len(body))
            if rows.full():
                yield rows.batch()
    if key is not None:
        rows.add((*key, -1, 0, digest.digest(), *facts, copies))
    yield rows.batch()


_RESULT = {
    "doc_id": pa.int64(), **_FACT_KINDS, "output_sha256": pa.string(), "restored_sha256": pa.string(),
}


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from its pieces in the order of the text, which the digest of its output precedes."""
    rows = _Rows(_RESULT)
    head, digest = None, sha256()

    def done() -> Iterator[pa.RecordBatch]:
        for _ in range(head[-1]):
            rows.add((head[0], *head[2:-1], head[1], digest.hexdigest()))
            if rows.full():
                yield rows.batch()

    for batch in batches:
        heads = batch.select(["doc_id", "body", "n", "form", "prefix_chars", "middle_chars", "copies"])
        for i, (part, body) in enumerate(zip(batch.column("part").to_pylist(), batch.column("body").to_pylist())):
            if part >= 0:
                digest.update(body)
                continue
            if head is not None:
                yield from done()
            head, digest = [c[i].as_py() for c in heads.columns], sha256()
            head[1] = head[1].hex()
    if head is not None:
        yield from done()
    yield rows.batch()


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``."""
    dealt = output_pieces(docs).repartition("copy", "doc_id").sortWithinPartitions("copy", "doc_id", "place")
    schema = f"copy binary, doc_id bigint, part bigint, place bigint, body binary, {_FACTS}, copies bigint"
    again = dealt.mapInArrow(_assembled, schema).sortWithinPartitions("copy", "doc_id", "part", "place")
    return again.mapInArrow(_restored, f"doc_id bigint, {_FACTS}, output_sha256 string, restored_sha256 string")
