"""Words of an Arrow string column as numpy arrays, without Python strings.

A word's 64-bit hash is a polynomial over its bytes; prefix sums give the hash
of every word, and of every run of k words, in a few passes over the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_MASK = (1 << 64) - 1

#: Bytes that end a word: space and the control characters from tab to return.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Powers are products of two short tables, so nothing that grows with a text is kept.
_ROW = 4096
# Bytes hashed at a time.
_PIECE = 1 << 20


@lru_cache(maxsize=8)
def _row(base: int) -> np.ndarray:
    """base**i modulo 2**64 for i < _ROW."""
    out = np.full(_ROW, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _heads(base: int, n: int) -> np.ndarray:
    """base**(_ROW * i) for as many i as n places need."""
    out = np.full(-(-n // _ROW) or 1, pow(base, _ROW, 1 << 64), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, first: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for first <= i < first + n; first is a multiple of _ROW."""
    return np.multiply.outer(_heads(base, first + n)[first // _ROW:], _row(base)).ravel()[:n]


def powers_at(base: int, places: np.ndarray) -> np.ndarray:
    """base**i modulo 2**64 for every place i."""
    heads = _heads(base, int(places.max()) + 1 if len(places) else 0)
    return _row(base)[places % _ROW] * heads[places // _ROW]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _prefix_sums(values: np.ndarray, base: int, add: int = 0) -> np.ndarray:
    """Sums of (values[j] + add) * base**j for j < i, for every i."""
    sums = np.zeros(len(values) + 1, np.uint64)
    for at in range(0, len(values), _PIECE):
        piece = values[at:at + _PIECE].astype(np.uint64)
        if add:
            piece += np.uint64(add)
        piece *= powers(base, at, len(piece))
        piece[:1] += sums[at:at + 1]
        np.cumsum(piece, out=sums[at + 1:at + 1 + len(piece)])
    return sums


#: Bytes of a batch turned into Python strings, or handed on, at a time.
SLICE_BYTES = 8_000_000


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hands freed memory back to the machine. A Python worker lives through many stages,
    and what it keeps of one is missing in the next."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Halves a batch until no part but one of a single row exceeds the bytes. Once all
    parts are done, what they took is given back."""
    yield from _halves(batch, most)
    give_back()


def _halves(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows > 1 and batch.nbytes > most:
        half = batch.num_rows // 2
        yield from _halves(batch.slice(0, half), most)
        yield from _halves(batch.slice(half), most)
    elif batch.num_rows:
        yield batch


@dataclass
class Words:
    """starts, ends: byte places in `data`; bounds[d]:bounds[d+1] are the words
    of text d; hashes: of each word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words_of(texts: pa.Array, ends_word: np.ndarray = WHITE_SPACE, fold: np.ndarray = IDENTITY) -> Words:
    texts = texts.fill_null("")
    offset_type = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], offset_type)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    if n == 0:
        nothing = np.zeros(0, np.int64)
        return Words(data, nothing, nothing, np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64))
    data = fold[data]
    inside = ~ends_word[data]
    fresh = np.zeros(n + 1, bool)
    fresh[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | fresh[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sums = _prefix_sums(data, _BYTE_BASE, 1)
    hashes = mix((sums[ends] - sums[starts]) * powers_at(_inverse(_BYTE_BASE), starts) + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hashes)


def runs_of(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of every k consecutive words, text bounds not regarded."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    own = mix(hashes + np.uint64(salt)) if salt else hashes
    sums = _prefix_sums(own, _WORD_BASE)
    return mix((sums[k:] - sums[:n - k + 1]) * powers(_inverse(_WORD_BASE), 0, n - k + 1) + np.uint64(k))


def runs_inside(bounds: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which of the runs of k words lie in one text."""
    if total < k:
        return np.zeros(0, bool)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return text[:total - k + 1] == text[k - 1:]
