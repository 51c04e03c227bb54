"""Rolling hashes of byte strings as numpy arrays.

The hash of ``b[i:j]`` is a polynomial in an odd base modulo 2**64. Prefix sums
give it for any window at the cost of one subtraction and one product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of a 64-bit hash over all of its bits."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class Roller:
    """Hashes windows of byte arrays; a seed picks the base and the byte values."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self._values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self._base = int(rng.integers(1 << 61, 1 << 63, dtype=np.uint64)) | 5
        self._up = self._down = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self._up) <= n:
            size = max(n + 1, 1 << 16)
            one = np.ones(1, np.uint64)
            inverse = pow(self._base, -1, 1 << 64)
            self._up = np.cumprod(np.concatenate([one, np.full(size, self._base, np.uint64)]))
            self._down = np.cumprod(np.concatenate([one, np.full(size, inverse, np.uint64)]))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of ``data``, to be given to ``of``."""
        self._reach(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._values[data] * self._up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the windows ``[start, stop)``."""
        return mix((sums[stop] - sums[start]) * self._down[start])

    def every(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all windows of one width."""
        n = max(len(sums) - width, 0)
        return mix((sums[width : width + n] - sums[:n]) * self._down[:n])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(column.buffers()[2], np.uint8)[first:last], offsets - first


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x
