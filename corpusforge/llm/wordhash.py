"""64-bit hashes of the words of a batch of texts, computed on the Arrow buffer without making a Python object for a word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_ALL = (1 << 64) - 1
#: Bytes that part words: the blank and \t \n \v \f \r.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Texts are hashed in stretches of about so many bytes; a longer text is a stretch of its own.
STRETCH = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit hangs on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A random-looking 64-bit value for each byte; A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    values[65:91] = values[97:123]
    return values


_VALUES = _byte_values()
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base and of its inverse


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n, STRETCH * 2), base & _ALL, np.uint64)]))
    return _POWERS


def separators(word_bytes: str = "non-blank") -> np.ndarray:
    """Which bytes part words: blanks only, or everything but ASCII letters, digits and bytes of other scripts."""
    table = np.zeros(256, bool)
    if word_bytes == "non-blank":
        table[list(BLANKS)] = True
    else:
        table[:128] = True
        table[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    return table


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of strings, and the border of each row in them; null rows are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    borders = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[borders[0] : borders[-1]], borders - borders[0]


def stretches(borders: np.ndarray, most: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `most` bytes."""
    start, n = 0, len(borders) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(borders, borders[start] + most, "right")) - 1)
        yield start, min(end, n)
        start = end


def word_hashes(raw: np.ndarray, borders: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each row the index of its first word (one entry more than rows). Equal words (A-Z as a-z) have equal hashes."""
    n = len(raw)
    rows = len(borders) - 1
    if not n:
        return np.empty(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = ~parts[raw]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    edges = borders[1:-1][(borders[1:-1] > 0) & (borders[1:-1] < n)]
    starts_here[edges] |= inside[edges]
    starts = np.flatnonzero(starts_here)
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    ends_here[edges - 1] |= inside[edges - 1]
    ends = np.flatnonzero(ends_here) + 1
    up, down = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[raw] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return hashes, np.searchsorted(starts, borders)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its `size`-word shingles; with fewer words the whole sequence is one; without words there are none."""
    factors = mix(np.arange(11, 11 + size, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    n = max(0, len(words) - size + 1)
    joined = np.zeros(n, np.uint64)
    for k in range(size):
        joined += words[k : k + n] * factors[k]
    joined = mix(joined)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            ordered = np.sort(joined[a : b - size + 1])
            if len(ordered) > 1:
                ordered = ordered[np.append(True, ordered[1:] != ordered[:-1])]
            yield ordered
        elif b > a:
            short = np.uint64(b - a)
            for k in range(a, b):
                short = mix(np.array([short], np.uint64) * np.uint64(_BASE) + words[k])[0]
            yield np.array([short], np.uint64)
        else:
            yield np.empty(0, np.uint64)
