"""Words of whole batches of texts as 64-bit hashes, in numpy: what the operators on word sequences share.

The texts of a batch are joined by line feeds and lower-cased (A-Z) in one go. A word's hash is a polynomial in its bytes
modulo 2^64, read off one running sum over the joined bytes, so its cost does not depend on the number of words.
Memory beside the bytes is bounded by the chunk, which is cut between words; one longer word makes its own chunk longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SLICE_BYTES = 4 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix's finaliser: a bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs of hashes."""
    return mix(a * np.uint64(_MULTIPLIER) + mix(b + np.uint64(0x632BE59BD9B4E019)))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


@cache
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _powers_to(base: int, n: int) -> np.ndarray:
    return _powers(base, max(CHUNK, 1 << (n - 1).bit_length()))[:n]


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def byte_class(some: bytes) -> np.ndarray:
    """Which of the 256 byte values are among ``some``."""
    found = np.zeros(256, bool)
    found[list(some)] = True
    return found


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``SLICE_BYTES`` of text, so that arrays over their words stay small."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def joined(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The batch's texts, lower-cased, each with a line feed after it; where each begins, and the end of all."""
    parts = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return b"\n".join([*parts, b""]).lower(), starts


def words(buffer: bytes, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every run of bytes that are not ``breaks``. The buffer ends with a break."""
    data = np.frombuffer(buffer, np.uint8)
    starts, ends, hashes, at = [], [], [], 0
    while at < len(data):
        size = CHUNK
        while True:
            chunk = data[at : at + size]
            gaps = breaks[chunk]
            if at + len(chunk) >= len(data):
                break
            last = len(chunk) - 1 - int(np.argmax(gaps[::-1]))
            if gaps[last]:
                chunk, gaps = chunk[: last + 1], gaps[: last + 1]
                break
            size *= 2
        edges = np.diff(gaps.view(np.int8), prepend=np.int8(1), append=np.int8(1))
        a, b = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        sums = np.zeros(len(chunk) + 1, np.uint64)
        np.cumsum(_BYTES[chunk] * _powers_to(_MULTIPLIER, len(chunk)), out=sums[1:])
        h = (sums[b] - sums[a]) * _powers_to(_INVERSE, len(chunk))[a]
        hashes.append(mix(h + (b - a).astype(np.uint64)))
        starts.append(a + at)
        ends.append(b + at)
        at += len(chunk)
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)
