"""Vectorised text helpers used inside Arrow tasks: words, word hashes and window hashes.

Texts are handled as one UTF-8 buffer per batch; a null text counts as empty. Hashes are 64-bit
polynomials with wrap-around, mixed at the end, and depend on the bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text handled at once inside a task; one longer text is one slice of its own.
SLICE_BYTES = 1 << 21
WORDS_AT_ONCE = 1 << 18

# Odd multipliers of the two independent hashes: bytes of a word, words of a window.
BYTE_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WORD_FACTORS = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: every byte but white space belongs to a word
NOT_SPACE = ~ASCII_SPACE
#: digits, letters and everything beyond ASCII
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def text_array(column) -> pa.Array:
    """The batch's texts as one large string array, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about `limit` bytes."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        lo, hi = int(offsets[first]), int(offsets[end])
        yield first, end, data[lo:hi], offsets[first : end + 1] - lo
        first = end
    # the pool would keep this batch's buffers beside those of the next
    pa.default_memory_pool().release_unused()


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the index of each text's first word (one more at the end)."""
    inside = kind[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[:1] = False
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    before[:-1] = inside[1:]
    before[-1:] = False
    before[edges - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    powers = _powers(BYTE_FACTORS[which], int((ends - starts).max()) + 1)
    for a in range(0, len(starts), WORDS_AT_ONCE):
        s, e = starts[a : a + WORDS_AT_ONCE], ends[a : a + WORDS_AT_ONCE]
        lengths = e - s
        total = np.cumsum(lengths)
        within = np.arange(total[-1]) - np.repeat(total - lengths, lengths)
        values = (data[np.repeat(s, lengths) + within].astype(np.uint64) + np.uint64(1)) * powers[within]
        out[a : a + len(s)] = np.add.reduceat(values, total - lengths)
    return mix(out ^ (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """The hash of each run of `width` consecutive words, by first word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = np.uint64(WORD_FACTORS[which])
    h = words[:n].copy()
    for i in range(1, width):
        h *= factor
        h += words[i : n + i]
    return mix(h)


def within_text(first: np.ndarray, width: int) -> np.ndarray:
    """True for each window start whose window stays in its text (window starts of the whole slice)."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return text[:n] == text[width - 1 :]


def numbering(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the slice: its text and its place in the text."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    return text, np.arange(int(first[-1])) - first[:-1][text]


def runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. n-1 for each n of `lengths`, one after the other."""
    total = np.cumsum(lengths)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - lengths, lengths)
