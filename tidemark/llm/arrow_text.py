"""Words of text columns as numpy arrays, a chunk of rows at a time.

Everything works on the UTF-8 bytes of a whole chunk at once: word bounds come
from a table of white-space bytes, and word hashes from eight bytes of all
words at a time, so no row and, but for very long ones, no word is touched singly.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
# Space and the control characters from tab to carriage return end a word.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Or every ASCII character that is no letter or digit, for words without punctuation.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP, _SIZE = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
# Slices of more bytes than this are hashed one by one.
_LONG = 64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Hasher:
    """64-bit hashes of any slices of ``data`` (bytes as uint8), eight bytes of all slices at a time."""

    def __init__(self, data: np.ndarray):
        self.data = np.zeros(len(data) + 8, dtype=np.uint8)
        self.data[: len(data)] = data
        self.view = np.ndarray((len(data) + 1,), dtype="<u8", buffer=self.data, strides=(1,))

    def _eights(self, starts: np.ndarray, size: np.ndarray, nth: int) -> np.ndarray:
        """Bytes 8 * nth and on of each slice as one number, zero beyond its end."""
        left = np.minimum(size - 8 * nth, 8).astype(np.uint64)
        return self.view[starts + 8 * nth] & (np.uint64(2**64 - 1) >> (np.uint64(64) - left * np.uint64(8)))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - starts
        h = mix(self._eights(starts, size, 0) ^ (size.astype(np.uint64) * _SIZE))
        for nth in range(1, _LONG // 8):
            left = np.flatnonzero(size > 8 * nth)
            if not len(left):
                return h
            h[left] = mix((h[left] * _STEP) ^ self._eights(starts[left], size[left], nth))
        for i in np.flatnonzero(size > _LONG).tolist():
            whole = hashlib.blake2b(self.data[starts[i] : ends[i]], digest_size=8).digest()
            h[i] = np.frombuffer(whole, dtype=np.uint64)[0]
        return h

    def same(self, starts: np.ndarray, ends: np.ndarray, of: np.ndarray, others: np.ndarray) -> bool:
        """Whether the slices ``of`` hold the same bytes as the slices ``others``, each as its own."""
        size = ends[of] - starts[of]
        if not np.array_equal(size, ends[others] - starts[others]):
            return False
        a, b = starts[of], starts[others]
        for nth in range(_LONG // 8):
            if not np.array_equal(self._eights(a, size, nth), self._eights(b, size, nth)):
                return False
            more = size > 8 * (nth + 1)
            a, b, size = a[more], b[more], size[more]
            if not len(a):
                return True
        spans = zip(a.tolist(), b.tolist(), size.tolist(), strict=True)
        return all(np.array_equal(self.data[x : x + n], self.data[y : y + n]) for x, y, n in spans)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, dtype=np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]))


def release() -> None:
    """Give freed memory back to the system; workers live on between tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets into the bytes); null is empty.

    A chunk holds at most ``limit`` bytes or a single row.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.null_count and np.diff(offsets)[texts.is_null().to_numpy(zero_copy_only=False)].any():
        yield from chunks(texts.fill_null(""), limit)  # bytes behind a null, which Spark never sends
        return
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    release()


def lowered(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[raw]


class Words:
    """Lower-cased words of a chunk: ``starts``, ``ends``, and each row's word range."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE):
        self.data = _LOWER[raw]
        space = separators[raw]
        n = len(raw)
        edges = offsets[(offsets > 0) & (offsets < n)]
        before = np.empty(n, dtype=bool)
        before[:1] = True
        before[1:] = space[:-1]
        before[edges] = True
        after = np.empty(n, dtype=bool)
        after[-1:] = True
        after[:-1] = space[1:]
        after[edges - 1] = True
        solid = ~space
        self.starts = np.flatnonzero(solid & before)
        self.ends = np.flatnonzero(solid & after) + 1
        self.rows = np.searchsorted(self.starts, offsets)
        self.hasher = Hasher(self.data)
        self.hashes = self.hasher(self.starts, self.ends)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``k``-word shingles.

    A row with fewer words has its whole word sequence as its one shingle, a
    row without words has none.
    """
    words = Words(raw, offsets)
    w = words.hashes
    joined = w[: max(0, len(w) - k + 1)].copy()
    for j in range(1, k):
        joined *= np.uint64(0x9FB21C651E98DF25)
        joined += w[j : j + len(joined)]
    mix(joined)
    found = []
    for start, end in zip(words.rows[:-1].tolist(), words.rows[1:].tolist(), strict=True):
        if end - start >= k:
            row = np.sort(joined[start : end - k + 1])
            keep = np.empty(len(row), dtype=bool)
            keep[0] = True
            np.not_equal(row[1:], row[:-1], out=keep[1:])
            found.append(row[keep])
        elif end > start:
            h = np.uint64(end - start)
            for word in w[start:end]:
                h = np.uint64((int(h) * 0x9FB21C651E98DF25 + int(word)) & 0xFFFFFFFFFFFFFFFF)
            found.append(mix(np.array([h], dtype=np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))
        else:
            found.append(w[:0])
    return found
