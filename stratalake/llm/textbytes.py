"""Whole texts of an Arrow batch as one byte array: words, word shingles and 64-bit hashes, without per-row Python.

Texts are UTF-8. White space of words is ASCII, so words can be cut on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: A batch is worked on in slices of about this many bytes, so that a task's memory does not follow the batch.
SLICE_BYTES = 2_000_000

_random = np.random.default_rng(20_240_229)
_BYTE_VALUES = _random.integers(1, 2**63, size=(2, 256), dtype=np.uint64)
_BASES = [U64(int(x) | 5) for x in _random.integers(2**60, 2**63, size=2)]
_PLACES = _random.integers(1, 2**63, size=64, dtype=np.uint64) | U64(1)

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over all output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers_up_to(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, kept per worker."""
    known = _powers.get(which)
    if known is None or len(known[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        base = _BASES[which]
        inverse = U64(pow(int(base), -1, 2**64))
        known = tuple(
            np.concatenate([np.ones(1, U64), np.multiply.accumulate(np.full(size - 1, b, U64))]) for b in (base, inverse)
        )
        _powers[which] = known
    return known


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents [i, j) of about `limit` bytes; a longer document stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each data[start:end]; two independent families by `which`."""
    powers, inverses = _powers_up_to(len(data) + 1, which)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUES[which][data] * powers[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(h + (ends - starts).astype(U64) * _PLACES[63])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of all words `[^\\x20\\x09-\\x0D]+`."""
    solid = ~SEPARATOR[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]  # words do not cross documents
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word in order."""
    if lower:
        data = LOWER[data]
    starts, ends, doc = word_bounds(data, offsets)
    return segment_hashes(data, starts, ends), doc


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of k words; a document of fewer words has one, its whole sequence."""
    n = len(words)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    values, owner = [], []
    if n >= k:
        whole = doc[: n - k + 1] == doc[k - 1 :]
        h = words[: n - k + 1] * _PLACES[0]
        for j in range(1, k):
            h = h + words[j : n - k + 1 + j] * _PLACES[j]
        values.append(mix(h[whole]))
        owner.append(doc[: n - k + 1][whole])
    counts = np.bincount(doc, minlength=n_docs)
    short = (counts > 0) & (counts < k)
    if short.any():
        at = np.concatenate([[0], np.cumsum(counts)[:-1]])
        picked = np.flatnonzero(short[doc])
        part = words[picked] * _PLACES[picked - at[doc[picked]]]
        who, first = np.unique(doc[picked], return_index=True)
        values.append(mix(np.add.reduceat(part, first) + counts[who].astype(U64) * _PLACES[62]))
        owner.append(who)
    h, o = np.concatenate(values), np.concatenate(owner)
    if short.any():
        order = np.argsort(o, kind="stable")
        h, o = h[order], o[order]
    return h, o


def distinct_by_document(values: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, flat, with offsets. `doc` ascends."""
    bounds = np.searchsorted(doc, np.arange(n_docs + 1))
    parts = [np.unique(values[a:b]) if b > a + 1 else values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.fromiter((len(p) for p in parts), np.int64, n_docs)
    flat = np.concatenate(parts) if parts else np.zeros(0, U64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for each i, modulo 2^64 for integers; 0 for an empty run."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[offsets[1:]] - total[offsets[:-1]]
