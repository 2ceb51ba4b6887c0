"""Golomb coding of sorted numbers, whole lists at a time.

The code of a gap has a quotient in unary and a remainder of ``k`` bits (Golomb's code with
a divisor of 2^k). Quotients and remainders are kept in two bit strings, so that both
directions are array operations. A code starts with the count (8 bytes), k (1 byte) and
the length of the quotient string (8 bytes).
"""

import struct

import numpy as np

_HEAD = struct.Struct("<QBQ")


def encode(values: np.ndarray) -> bytes:
    """``values``: ascending numbers below 2^63, as uint64. Equal ones may follow one another."""
    if not len(values):
        return _HEAD.pack(0, 0, 0)
    gaps = np.diff(values, prepend=np.uint64(0))
    k = max(0, int(np.log2(max(1.0, float(values[-1]) / len(values)) * 0.69 + 1e-9)))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(ends[-1], np.uint8)
    unary[ends - 1] = 1
    unary_bytes = np.packbits(unary).tobytes()
    # the lower k bits of each gap, written out from the highest on
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    remainders = bits[:, 64 - k :]
    return (
        _HEAD.pack(len(values), k, len(unary_bytes))
        + unary_bytes
        + np.packbits(remainders).tobytes()
    )


def decode(code: bytes) -> np.ndarray:
    count, k, length = _HEAD.unpack_from(code)
    if not count:
        return np.zeros(0, np.uint64)
    start = _HEAD.size
    unary = np.unpackbits(np.frombuffer(code, np.uint8, length, start))
    quotients = np.diff(np.flatnonzero(unary)[:count], prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    if k:
        packed = np.frombuffer(code, np.uint8, -1, start + length)
        bits = np.zeros((count, 64), np.uint8)
        bits[:, 64 - k :] = np.unpackbits(packed, count=count * k).reshape(count, k)
        gaps += np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)
