"""Word shingles of whole texts as 64-bit hashes, vectorised over the bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ROWS_BYTES = 250_000  # bytes of text looked at together; numbers made of them take some 50 times as much
_random = np.random.default_rng(5)
_CODE = _random.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_CODE[65:91] = _CODE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers 0..n-1 of the step and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, step in enumerate((_STEP, _STEP_BACK)):
            table, at = np.ones(size, np.uint64), 1
            while at < size:
                table[at:2 * at] = table[:at] * np.uint64(pow(step, at, 1 << 64))
                at *= 2
            _powers[i] = table
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def word_hashes(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words before each offset); ``data`` starts at ``offsets[0]`` = 0.

    A word is a run of bytes that ``letters`` marks (all but white space by default).  Its hash is a
    polynomial over its bytes' random codes: differences of one running sum.
    """
    n = len(data)
    forward, back = _power_tables(n + 1)
    word = (~_SPACE if letters is None else letters)[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * forward[:n], out=running[1:])
    hashes = (running[ends] - running[starts]) * back[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text, the ascending distinct hashes of its ``k``-word shingles.

    A text with fewer words has the whole sequence as its one shingle, a text
    without words the empty set.
    """
    data, offsets = text_bytes(texts)
    rows, start = len(offsets) - 1, 0
    while start < rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + ROWS_BYTES, "right")) - 1)
        stop = min(stop, rows)
        words, before = word_hashes(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start])
        joined = np.zeros(len(words), np.uint64)
        full = max(0, len(words) - k + 1)
        for j in range(k):
            joined[:full] = joined[:full] * np.uint64(0xD6E8FEB86659FD93) + words[j:j + full]
        joined = mix(joined)
        for i in range(stop - start):
            a, b = before[i], before[i + 1]
            if b - a >= k:
                yield np.unique(joined[a:b - k + 1])
            elif b > a:
                short = np.uint64(b - a)
                for h in words[a:b]:
                    short = mix(np.array([short]) * np.uint64(0xD6E8FEB86659FD93) + h)[0]
                yield np.array([short], np.uint64)
            else:
                yield np.zeros(0, np.uint64)
        start = stop
