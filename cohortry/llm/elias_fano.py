"""Elias-Fano code for non-decreasing integers, with select.

A value below ``universe`` is cut into ``low_bits`` low bits, stored plainly, and
a high part, stored as a one at place ``high + index`` of a bit vector.  That
takes about ``2 + log2(universe / n)`` bits a value.  The place of every
``SAMPLE``-th one is kept, so that ``select`` reads a few bytes only.

Layout, little-endian: count u32, low_bits u8, bytes of the high part u32, low
bits, high bits, samples u32 each.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<IBI")


def encode(values: np.ndarray) -> bytes:
    """The code of a non-decreasing array of non-negative integers."""
    values = np.asarray(values, dtype=np.int64)
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0)
    if values[0] < 0 or (np.diff(values) < 0).any():
        raise ValueError("values must be non-negative and non-decreasing")
    low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
    lows = (values[:, None] >> np.arange(low_bits)) & 1
    places = (values >> low_bits) + np.arange(n)
    high = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
    high[places] = 1
    high = np.packbits(high, bitorder="little").tobytes()
    low = np.packbits(lows.astype(np.uint8).ravel(), bitorder="little").tobytes()
    samples = places[::SAMPLE].astype("<u4").tobytes()
    return _HEAD.pack(n, low_bits, len(high)) + low + high + samples


class EliasFano:
    """Reads a code made by ``encode``."""

    def __init__(self, code: bytes):
        self.count, self._low_bits, high_bytes = _HEAD.unpack_from(code)
        low_bytes = (self.count * self._low_bits + 7) // 8
        start = _HEAD.size
        self._low = np.frombuffer(code, np.uint8, low_bytes, start)
        self._high = np.frombuffer(code, np.uint8, high_bytes, start + low_bytes)
        self._samples = np.frombuffer(
            code, "<u4", -(-self.count // SAMPLE), start + low_bytes + high_bytes
        )

    def _lows(self, first: int, count: int) -> np.ndarray:
        bits = self._low_bits
        if bits == 0:
            return np.zeros(count, dtype=np.int64)
        begin, end = first * bits, (first + count) * bits
        flat = np.unpackbits(self._low[begin // 8 : -(-end // 8)], bitorder="little")
        flat = flat[begin % 8 : begin % 8 + count * bits].reshape(count, bits)
        return (flat.astype(np.int64) << np.arange(bits)).sum(axis=1)

    def select(self, index: int) -> int:
        """The value at ``index``, from the nearest sample on."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        sample = int(self._samples[index // SAMPLE])
        byte, wanted = sample // 8, index % SAMPLE
        # Ones before the sampled one in its byte are counted as well.
        wanted += int(np.bitwise_count(self._high[byte] & ((1 << sample % 8) - 1)))
        while True:
            window = self._high[byte : byte + 64]
            ones = np.flatnonzero(np.unpackbits(window, bitorder="little"))
            if wanted < len(ones):
                place = byte * 8 + int(ones[wanted])
                break
            wanted -= len(ones)
            byte += len(window)
        return ((place - index) << self._low_bits) | int(self._lows(index, 1)[0])

    def values(self) -> np.ndarray:
        """All values."""
        places = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))
        high = places - np.arange(self.count)
        return (high << self._low_bits) | self._lows(0, self.count)
