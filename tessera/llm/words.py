"""Word tables of Arrow text columns: byte-class splitting and word hashes, vectorised.

Texts are cut into words on their UTF-8 bytes. Every separator used here is an
ASCII byte, so cutting bytes equals cutting characters. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# separators of the two word definitions: [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

SLICE_BYTES = 4 << 20
# arbitrary odd 64-bit multipliers of the two hash families
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Words(NamedTuple):
    """Words of a run of texts: concatenated bytes, word offsets (n + 1), word bounds of each text."""

    data: np.ndarray
    offsets: np.ndarray
    bounds: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def array(self) -> pa.Array:
        """The words as an Arrow binary array."""
        return pa.Array.from_buffers(pa.large_binary(), len(self.offsets) - 1,
                                     [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)])

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def distinct(self) -> tuple[np.ndarray, list[bytes]]:
        """(code of each word, distinct words)."""
        words = self.array()
        enc = (words.cast(pa.binary()) if len(self.data) < 1 << 31 else words).dictionary_encode()
        return enc.indices.to_numpy(zero_copy_only=False), enc.dictionary.to_numpy(zero_copy_only=False).tolist()


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array, separators: np.ndarray, lower: bool = False) -> Words:
    data, offsets = byte_view(texts)
    if lower:
        data = ASCII_LOWER[data]
    n = len(data)
    if n == 0:
        return Words(data, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    edge = np.empty(n, dtype=bool)
    edge[0] = True
    np.logical_not(inside[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(inside & edge)
    np.logical_not(inside[1:], out=edge[:-1])
    edge[-1] = True
    last = offsets[1:] - 1
    edge[last[last >= 0]] = True
    ends = np.flatnonzero(inside & edge) + 1
    word_offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=word_offsets[1:])
    return Words(data[inside], word_offsets, np.searchsorted(starts, offsets).astype(np.int64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(multiplier)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES)
        out = []
        for base in (multiplier, pow(multiplier, -1, 1 << 64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if n > 4 * SLICE_BYTES:  # do not keep tables made for one huge text
            return out[0], out[1]
        have = _POWERS[multiplier] = (out[0], out[1])
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """64-bit hash of each byte span data[start:end]: a polynomial over the bytes, mixed."""
    up, down = _powers(MULTIPLIERS[family], len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts])


def word_hashes(words: Words, family: int = 0) -> np.ndarray:
    return span_hashes(words.data, words.offsets[:-1], words.offsets[1:], family)


def window_hashes(hashes: np.ndarray, size: int, family: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes (runs may cross texts)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    m = np.uint64(MULTIPLIERS[family])
    out = hashes[:n].copy()
    for j in range(1, size):
        out *= m
        out += hashes[j:j + n]
    return mix64(out)


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Mask over the first ``n - size + 1`` words: does a window starting here stay in its text?"""
    n = int(bounds[-1]) - size + 1
    if n <= 0:
        return np.empty(0, bool)
    ok = np.ones(n, dtype=bool)
    for back in range(1, size):  # a window that starts fewer than ``size`` words before an end crosses it
        at = bounds[1:] - back
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start + 1, ... of each (start, length)."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def text_slices(batch: pa.RecordBatch, column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch holding at most ``max_bytes`` of text each (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < n:
        base = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + max_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to
