"""Word and word-shingle hashing over raw UTF-8 buffers, vectorised with numpy.

A batch's texts are one byte buffer with offsets. Delimiters are ASCII bytes, which never occur inside a
multi-byte character, so words can be cut on bytes. Hashes have 64 bits and depend on the word alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of texts hashed at a time: bounds the memory of a worker whatever the length of texts.
SEGMENT = 1 << 20

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
MULTS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=np.uint64)

WHITESPACE = np.zeros(256, bool)
WHITESPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but digits and lower-case letters.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> U(30))
    x = x * MULTS[0]
    x ^= x >> U(27)
    x *= MULTS[1]
    return x ^ (x >> U(31))


with np.errstate(over="ignore"):
    TABLE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, SEGMENT + 4096)
        inverse = U(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))]) for b in (BASE, inverse)]
    return _powers[0], _powers[1]


def buffers(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes and each text's offsets; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return (LOWER[buf] if lower else buf), offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most limit bytes each, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def cuts(buf: np.ndarray, delimiter: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of one text, cut at delimiters, of limit bytes and what is left of a word there."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + limit)
        while end < n:
            stops = np.flatnonzero(delimiter[buf[end : end + limit]])
            if len(stops):
                end += int(stops[0])
                break
            end = min(n, end + limit)
        yield at, end
        at = end


def words(buf: np.ndarray, offsets: np.ndarray, delimiter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the index of its first word (one more at the end)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~delimiter[buf]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
            lo, hi = int(starts[i]), int(ends[j - 1])
            up, down = powers(hi - lo + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(TABLE[buf[lo:hi]] * up[: hi - lo], out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * MULTS[2])
            i = j
    return out


def combine(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k consecutive words, over text bounds too: len(hashes) - k + 1 values."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(m, U(k), np.uint64)
        for i in range(k):
            out = mix(out * MULTS[3] + hashes[i : i + m] * MULTS[(i + 4) % 8])
    return out


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """A text's distinct k-word shingles, sorted; with fewer words the whole sequence as one; none without words."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(combine(hashes, min(k, len(hashes))))


def each_text(texts: pa.Array, delimiter: np.ndarray, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each text."""
    buf, offsets = buffers(texts)
    for i, j in blocks(offsets):
        part, at = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        part = LOWER[part] if lower else part
        starts, ends, first = words(part, at, delimiter)
        hashes = word_hashes(part, starts, ends)
        for r in range(i, j):
            yield r, hashes[first[r - i] : first[r - i + 1]]
