"""Elias-Fano code of a non-decreasing sequence, with a select structure.

n values up to u take about 2 + log2(u / n) bits each: the low bits of every
value side by side, the high bits as a unary bit vector in which the i-th one
stands at ``(value >> low) + i``. ``select`` finds that one from a 32-bit
sample of every ``SAMPLE``-th position, so no table of 64-bit offsets is kept.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 128
HEAD = struct.Struct("<QQBQ")


def encode(values: np.ndarray) -> bytes:
    """The code of ``values`` (non-decreasing, not negative)."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    low_bits = (values[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    if n and int(ones[-1]) >= 1 << 32:
        raise ValueError("more than 2**32 bits in one sequence: cut it into shards")
    parts = (np.packbits(low_bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype("<u4"))
    return HEAD.pack(n, len(high), low, len(parts[0])) + b"".join(p.tobytes() for p in parts)


class EliasFano:
    """Random and sequential access to an encoded sequence."""

    def __init__(self, code: bytes):
        self.n, size, self.low, low_bytes = HEAD.unpack_from(code)
        raw = np.frombuffer(code, np.uint8)
        at = HEAD.size
        self.low_bytes = raw[at : at + low_bytes]
        at += low_bytes
        self.high_bytes = raw[at : at + (size + 7) // 8]
        at += (size + 7) // 8
        self.samples = np.frombuffer(code, "<u4", count=-(-self.n // SAMPLE), offset=at)
        self.size = at + 4 * len(self.samples)

    def low_part(self, first: int, last: int) -> np.ndarray:
        """Low bits of values first .. last - 1."""
        bits = np.arange(first * self.low, last * self.low)
        ones = self.low_bytes[bits >> 3] >> (bits & 7) & 1
        weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
        return (ones.reshape(last - first, self.low).astype(np.uint64) * weights).sum(1, dtype=np.uint64)

    def between(self, first: int, last: int) -> np.ndarray:
        """Values first .. last - 1: select from the nearest sample on."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last, self.n))
        if first == last:
            return np.zeros(0, np.uint64)
        sample = first // SAMPLE
        start = int(self.samples[sample]) >> 3
        after = -(-last // SAMPLE)
        end = (int(self.samples[after]) >> 3) + 1 if after < len(self.samples) else len(self.high_bytes)
        bits = np.unpackbits(self.high_bytes[start:end], bitorder="little")
        bits[: int(self.samples[sample]) - 8 * start] = 0
        ones = np.flatnonzero(bits)[first - sample * SAMPLE : last - sample * SAMPLE] + 8 * start
        high = (ones - np.arange(first, last)).astype(np.uint64)
        return high << np.uint64(self.low) | self.low_part(first, last)

    def select(self, i: int) -> int:
        """Value i."""
        return int(self.between(i, i + 1)[0])
