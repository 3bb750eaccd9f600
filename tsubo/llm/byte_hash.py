"""Hashes of many byte ranges at once, with numpy over one buffer.

A range's hash is a polynomial over 2**64 of randomly replaced byte values,
taken from prefix sums, so any number of ranges of any length costs a few
vector operations.  The same bytes give the same hash in every process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_table(which: str, n: int) -> np.ndarray:
    """Powers 0..n of the multiplier or its inverse (kept and grown)."""
    table = _powers[which]
    if len(table) <= n:
        base = _MULTIPLIER if which == "up" else _INVERSE
        table = np.full(1 << max(n.bit_length(), 16), base, np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[which] = table
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Hashes of ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _power_table("up", len(data))[: len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _power_table("down", len(self.sums))
        return mix((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every range of one width."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * _power_table("down", n)[:n])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a binary or string column; NULL is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    out, row, n = [], 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), n)
        out.append((row, end))
        row = end
    return out
