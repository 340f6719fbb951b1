"""Compact byte forms of numpy arrays, for what tasks send each other."""

from __future__ import annotations

import numpy as np


def narrow(values: np.ndarray) -> bytes:
    """Numbers from zero in the smallest width that holds them; the width comes first."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def gaps(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by their differences, in as many bytes as the largest needs."""
    d = np.diff(keys, prepend=np.uint64(0))
    d[0] = 0
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    return np.uint64(keys[0]).tobytes() + bytes([width]) + d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def ungapped(data: bytes) -> np.ndarray:
    width = data[8]
    d = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    out = np.zeros((len(d), 8), np.uint8)
    out[:, :width] = d
    out = out.view("<u8").ravel()
    out[0] = np.frombuffer(data, "<u8", 1)[0]
    return np.cumsum(out, dtype=np.uint64)


def small(values: np.ndarray) -> bytes:
    """Counts in a byte each; larger ones as 255 and eight bytes more."""
    large = values >= 255
    return np.uint32(len(values)).tobytes() + np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<u8").tobytes()


def unsmall(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    out = np.frombuffer(data, np.uint8, n, 4).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", offset=4 + n).astype(np.int64)
    return out


def packed(values: np.ndarray, size: int) -> bytes:
    """Sorted numbers below ``size``: the low bits as they are, the high parts as a bit for each step and number."""
    n = len(values)
    low = max(0, (size // max(1, n)).bit_length() - 1)
    bits = values[:, None] >> np.arange(low) & 1
    marks = np.zeros((size >> low) + n + 1, bool)
    marks[(values >> low) + np.arange(n)] = True
    return np.uint32(n).tobytes() + np.uint64(size).tobytes() + np.packbits(bits.astype(bool).ravel()).tobytes() + np.packbits(marks).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n, size = int(np.frombuffer(data, "<u4", 1)[0]), int(np.frombuffer(data, "<u8", 1, 4)[0])
    low = max(0, (size // max(1, n)).bit_length() - 1)
    split = 12 + (n * low + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, split - 12, 12), count=n * low).reshape(n, low).astype(np.int64)
    marks = np.unpackbits(np.frombuffer(data, np.uint8, offset=split))
    return (np.flatnonzero(marks) - np.arange(n) << low) + (bits << np.arange(low)).sum(axis=1)
