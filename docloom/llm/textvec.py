"""Words and their hashes for whole Arrow batches at once, in numpy over the UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64; kept for the next call."""
    if len(_powers.get(1, ())) < n:
        n = max(n, 1 << 20)
        for sign, base in ((1, _BASE), (-1, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[sign] = np.cumprod(steps, dtype=np.uint64)
    return _powers[1], _powers[-1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64); h is overwritten."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Texts:
    """Some texts as one byte array; text i is data[offsets[i] : offsets[i + 1]], a null one is empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and where each text's words begin (one more than there are texts)."""
        n, at = len(self.data), self.offsets
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(at), np.int64)
        black = ~IS_SPACE[self.data]
        inner = at[(at > 0) & (at < n)]
        first, last = black.copy(), black.copy()
        first[1:] &= ~black[:-1]
        first[inner] = black[inner]
        last[:-1] &= ~black[1:]
        last[inner - 1] = black[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, at)

    def sums(self, lower: bool = True) -> np.ndarray:
        """Prefix sums from which hashed() takes the hash of any span."""
        data = LOWER[self.data] if lower else self.data
        up, _ = powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= up[: len(data)]
        np.cumsum(terms, out=out[1:])
        return out


def hashed(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    _, down = powers(len(sums))
    h = sums[ends] - sums[starts]
    h *= down[starts]
    return mix(h)


def pieces(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int, Texts]]:
    """Cut a string or binary column into runs of rows of about `most` bytes (one row at least): (from, to, texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, np.int64 if large else np.int32, n + 1 + column.offset)[column.offset :].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, Texts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j
