"""Words of Arrow text columns as numpy arrays: positions, hashes, windows.

Everything works on the UTF-8 bytes of a few megabytes of rows at a time; a row is never
cut. Both kinds of word end at ASCII bytes, so bytes split exactly where characters do.
Hashes are 64 bits; where a decision needs more, two lanes with different seeds are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20

_bytes = np.arange(256)
#: Bytes of ``[^\x20\x09-\x0D]+``.
SPACED = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing).
ALNUM = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
#: Lower-cases A-Z only.
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 0x20, _bytes).astype(np.uint8)

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)
SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


def text_chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``most`` bytes of text, at least one row each."""
    col = batch.column(column)
    if not len(col):
        return
    width = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], width)[col.offset : col.offset + len(col) + 1]
    at = 0
    while at < len(col):
        to = int(np.searchsorted(offs, offs[at] + most, "right")) - 1
        to = min(len(col), max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the row offsets into them; a null row is empty."""
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], width)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def split_words(data: np.ndarray, offs: np.ndarray, table: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the word offsets of the rows."""
    word = table[data]
    edges = offs[1:-1]
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    before[edges[edges < len(data)]] = False
    after = np.empty_like(word)
    after[-1:] = False
    after[:-1] = word[1:]
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return start, end, np.searchsorted(start, offs)


def _stir(x: np.ndarray) -> np.ndarray:
    x = x * _M2
    x ^= x >> np.uint64(31)
    return x


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,))
    size = end - start
    out = SEEDS[lane] ^ (size.astype(np.uint64) * _M1)
    todo = np.arange(len(start))
    done = 0
    while len(todo):
        left = size[todo] - done
        x = eight[start[todo] + done]
        short = left < 8
        x[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[todo] = _stir((out[todo] ^ x) * _M1)
        done += 8
        todo = todo[left > 8]
    out *= _M3
    out ^= out >> np.uint64(29)
    return out


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the sequence ``a`` then ``b``."""
    x = a * _M1 + b
    x ^= x >> np.uint64(32)
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of ``h[i : i + n]`` for each i that has so many words after it, rows not regarded."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    size, power, out, taken = 1, h, None, 0
    while True:
        if n & size:
            if out is None:
                out = power
            else:
                m = len(h) - taken - size + 1
                out = pair(out[:m], power[taken : taken + m])
            taken += size
        if size * 2 > n:
            return out[: len(h) - n + 1]
        power = pair(power[:-size], power[size:])
        size *= 2


def inside(word_offs: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` words that stay in their row."""
    total = int(word_offs[-1])
    ok = np.zeros(total + 1, np.int64)
    lo, hi = word_offs[:-1], np.maximum(word_offs[1:] - n + 1, word_offs[:-1])
    np.add.at(ok, lo, 1)
    np.add.at(ok, hi, -1)
    return np.flatnonzero(np.cumsum(ok)[:total] > 0)


def cover(starts: np.ndarray, lengths: np.ndarray | int, total: int) -> np.ndarray:
    """Which of ``total`` positions lie in any span."""
    d = np.zeros(total + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + lengths, -1)
    return np.cumsum(d[:total]) > 0


def per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each row."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, keep: np.ndarray, word_offs: np.ndarray) -> list[bytes]:
    """The kept words of each row, joined by one space."""
    at = np.flatnonzero(keep)
    s, size = start[at], end[at] - start[at]
    rows = np.searchsorted(at, word_offs)
    before = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(int(before[-1]), 0x20, np.uint8)
    if len(at):
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(before[:-1], size) + inner] = data[np.repeat(s, size) + inner]
    whole = out.tobytes()
    return [whole[before[a] : max(before[a], before[b] - 1)] for a, b in zip(rows[:-1], rows[1:])]


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with ``new`` columns behind; a column of the same name is replaced."""
    names = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in names] + list(new.values()), names=names + list(new))
