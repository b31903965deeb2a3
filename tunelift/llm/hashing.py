"""Vectorised 64-bit hashes of words and word runs, over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2 ** 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_POWERS: list[np.ndarray] = []
SLICE_BYTES = 512 << 10    # bytes hashed at a time, so that the arrays stay small


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse modulo 2**64, for i < n at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size, b, dtype=np.uint64)], dtype=np.uint64)
                      for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``most`` bytes; nulls are
    empty.  A longer text is a run of its own."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """starts, ends of the words, and the first word of each text (one more: their number).
    A word is a run of bytes other than the six ASCII white spaces within one text."""
    gap = SEPARATOR[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    before = np.r_[True, gap] | first
    after = np.r_[gap, True] | first
    starts = np.flatnonzero(~gap & before[:-1])
    ends = np.flatnonzero(~gap & after[1:]) + 1 if len(raw) else starts
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial over random values of its bytes, mixed."""
    power, inverse = powers(len(raw))
    total = np.r_[np.uint64(0), np.cumsum(_BYTE[raw] * power[:len(raw)], dtype=np.uint64)]
    h = (total[ends] - total[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(hashes: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and the first run of each text (one more: their
    number).  A text with fewer than k words, but one at least, has them all as one run."""
    n = np.diff(firsts)
    runs = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.r_[0, np.cumsum(runs)]
    at = np.repeat(firsts[:-1] - begin[:-1], runs) + np.arange(begin[-1])
    size = np.repeat(np.minimum(n, k), runs)
    h = size.astype(np.uint64)
    for i in range(k):
        inside = size > i
        word = hashes[np.where(inside, at + i, 0)] if len(hashes) else h
        h = np.where(inside, mix(h * np.uint64(0x9FB21C651E98DF25) + word), h)
    return h, begin
