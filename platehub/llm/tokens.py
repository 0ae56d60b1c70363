"""Words and shingles of whole texts as 64-bit hashes, computed with numpy on
the UTF-8 bytes of Arrow columns.

A word is a maximal run of bytes other than 0x20 and 0x09 to 0x0D.  A to Z count
as a to z.  Hashes are polynomials over the bytes modulo 2**64, finished by a
mixer; different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = U(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint64) + U(1)
_LOWER[65:91] = _LOWER[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finisher)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, U(base))
            step[0] = U(1)
            _powers[k] = np.cumprod(step, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def byte_views(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text, without a copy; null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_binary(column.type) and not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type) else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for k in range(len(column)):
        yield raw[at[k] : at[k + 1]] if valid is None or valid[k] else raw[:0]


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    inside = np.empty(len(text) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[text]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


class Prefix:
    """Hashes of any spans of a text; ``values`` gives each byte its number."""

    def __init__(self, text: np.ndarray, values: np.ndarray):
        up, self._down = powers(len(text) + 1)
        self._total = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(values[text] * up[: len(text)], out=self._total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._total[end] - self._total[start]) * self._down[start] + (end - start).astype(np.uint64) * _STEP)

    def every(self, width: int) -> np.ndarray:
        """The hashes of the spans of ``width`` bytes from each place on."""
        return mix((self._total[width:] - self._total[:-width]) * self._down[: max(0, len(self._total) - width)] + U(width * int(_STEP) & (1 << 64) - 1))


#: Numbers of the bytes: as they are, and from a second family of hashes.
PLAIN = np.arange(256, dtype=np.uint64) + U(1)
SECOND = mix(PLAIN)


def word_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of the words, A to Z as a to z."""
    return Prefix(text, _LOWER)(*word_spans(text))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct hashes of n-word shingles; with fewer words, of the
    whole sequence; without words, none."""
    if not len(words):
        return words
    width = min(n, len(words))
    h = np.full(len(words) - width + 1, U(width))
    for k in range(width):
        h = h * _STEP + words[k : len(words) - width + 1 + k]
    return np.unique(mix(h))
