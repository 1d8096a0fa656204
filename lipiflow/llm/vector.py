"""Array code shared by the Arrow stages: texts cut into words and hashed without a Python loop per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once.  A longer text is a piece of its own, always whole.
PIECE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: Bytes of a word: ASCII letters and digits, and every byte of a character beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: A-Z lowered, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        step = np.full(max(n, PIECE_BYTES + 1024), _BASE if kind == "up" else _INVERSE, np.uint64)
        step[0] = 1
        have = _powers[kind] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def pieces(batch: pa.RecordBatch, column: str, most_rows: int = 4096, most_bytes: int = PIECE_BYTES):
    """Slices of a batch with a bounded number of text bytes, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        limit = (ends[at - 1] if at else 0) + most_bytes
        end = min(max(int(np.searchsorted(ends, limit, "right")), at + 1), at + most_rows)
        yield batch.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = np.asarray(x, np.uint64)
    if not x.ndim:  # numpy warns of overflow in single numbers only
        return mix(x[None])[0]
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start byte, end byte, bytes) of every word of the texts, in order; starts count from the first text's."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = WORD_BYTES[data]
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    borders = offsets[1:-1]
    borders = borders[borders < len(data)]
    first[borders] |= inside[borders]
    starts = np.flatnonzero(first)
    after = ~inside[1:]
    after[borders[borders > 0] - 1] = True
    ends = np.flatnonzero(inside[:-1] & after) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power("down", len(data) + 1)[starts])
    return hashes, rows, starts, ends, data


class Counter:
    """Counts of 64-bit keys in several columns, kept sorted and merged in batches."""

    def __init__(self, columns: int, most: int = 1 << 20):
        self.columns, self.most, self.parts, self.size = columns, most, [], 0

    def add(self, keys: np.ndarray, values: list[np.ndarray]) -> None:
        if len(keys):
            self.parts.append((keys, values))
            self.size += len(keys)
            if self.size > 2 * self.most:
                self.merge()

    def merge(self) -> tuple[np.ndarray, list[np.ndarray]]:
        if not self.parts:
            return np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * self.columns
        keys = np.concatenate([k for k, _ in self.parts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        values = [np.add.reduceat(np.concatenate([v[c] for _, v in self.parts])[order], at) for c in range(self.columns)]
        self.parts, self.size = [(keys[at], values)], len(at)
        return self.parts[0]

    def full(self) -> bool:
        """Whether even merged there is too much to hold; the caller then emits it and starts anew."""
        return self.size > self.most and len(self.merge()[0]) > self.most

    def take(self) -> tuple[np.ndarray, list[np.ndarray]]:
        out = self.merge()
        self.parts, self.size = [], 0
        return out


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of keys in a sorted table, -1 where absent."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return np.where(table[at] == keys, at, -1)
