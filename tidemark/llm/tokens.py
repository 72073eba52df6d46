"""Words and word shingles of Arrow text columns as 64-bit hashes, vectorised with numpy.

A word's hash is a polynomial over its bytes, computed for all words of a block of texts at once, then mixed. Equal
words have equal hashes everywhere; two words collide with probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19       # texts are handled in blocks of this size; a longer text is a block of its own

_random = np.random.default_rng(571)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARK = _SPACE.copy()           # ASCII characters that are neither letters nor digits separate plain words
_MARK[[i for i in range(128) if not chr(i).isalnum()]] = True
_LETTER = np.array([i < 128 and chr(i).isalpha() for i in range(256)])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = _random.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words(NamedTuple):
    """Words of a block of texts: hashes and byte positions; text i has words first[i] to first[i + 1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    data: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True, plain: bool = False, cut: bool = False) -> Words:
    """The words of texts that lie one after the other in ``data``; ``plain``: without ASCII punctuation; ``cut``: a
    full stop or comma that ends a word after an ASCII letter is a word of its own.
    """
    separates = _MARK if plain else _SPACE
    values = np.where(separates, 0, _BYTE)
    values = values[_LOWER] if lower else values
    inside = ~separates[data]
    opens = np.empty(len(data), dtype=bool)
    closes = np.empty(len(data), dtype=bool)
    if len(data):
        opens[0], closes[-1] = True, True
        opens[1:] = ~inside[:-1]
        closes[:-1] = ~inside[1:]
        at = offsets[(offsets > 0) & (offsets < len(data))]
        opens[at], closes[at - 1] = True, True
    if cut and len(data):
        last = np.flatnonzero(closes & inside & ~opens)
        last = last[((data[last] == 46) | (data[last] == 44)) & _LETTER[data[last - 1]]]
        opens[last], closes[last - 1] = True, True
    starts = np.flatnonzero(opens & inside)
    ends = np.flatnonzero(closes & inside) + 1
    if len(starts):
        terms = values[data]
        terms *= powers(_BASE, len(data))
        sums = np.add.reduceat(terms, starts)
        sums *= powers(_INVERSE, len(data))[starts]
        hashes = mix(sums)
    else:
        hashes = np.zeros(0, dtype=np.uint64)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), data)


def blocks(column: pa.Array, lower: bool = True, plain: bool = False, cut: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(from row, to row, words) for runs of rows of a string or binary column; nulls have no words."""
    n = len(column)
    if n == 0:
        return
    size = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=size)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1
        to = min(n, max(row + 1, to))
        yield row, to, words_of(data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row], lower, plain, cut)
        row = to


def word_bytes(words: Words, chosen: np.ndarray, lower: bool) -> pa.Array:
    """The bytes of some words as an Arrow column."""
    begin, sizes = words.starts[chosen], (words.ends - words.starts)[chosen]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = words.data[np.repeat(begin - offsets[:-1], sizes) + np.arange(offsets[-1])]
    data = _LOWER[data].astype(np.uint8) if lower else data
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(chosen), buffers)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): all k-word shingles of each text in order; a text of fewer words is one shingle."""
    h, first = words.hashes, words.first
    counts = np.diff(first)
    n_out = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(n_out)])
    out = np.zeros(out_first[-1], dtype=np.uint64)
    whole = np.zeros(max(len(h) - k + 1, 0), dtype=np.uint64)
    if len(whole):
        for j in range(k):
            whole += h[j:len(h) - k + 1 + j] * _PLACES[j]
        long = np.repeat(counts >= k, n_out)
        begin = np.repeat(first[:-1] - out_first[:-1], n_out) + np.arange(len(out))
        out[long] = mix(whole[begin[long]])
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        own = h[first[i]:first[i + 1]]
        out[out_first[i]] = mix((own * _PLACES[k + 1:k + 1 + len(own)]).sum(keepdims=True) + np.uint64(len(own)))[0]
    return out, out_first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each run, and where the runs begin."""
    parts = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        own = np.sort(values[lo:hi])
        parts.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if hi - lo > 1 else own)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    joined = np.concatenate(parts) if parts else values[:0]
    return joined, np.concatenate([[0], np.cumsum(sizes)])
