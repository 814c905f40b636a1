"""Hashes of byte windows and word shingles, whole blocks of texts at a time.

A block is the concatenation of some whole texts. Prefix sums of `weight[byte] * BASE**i` modulo
2**64 give the hash of any window by one subtraction and one multiplication, so nothing loops
over bytes or words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
SHINGLE_WORDS = 5

_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class Roller:
    """Window hashes of byte blocks under one odd base."""

    def __init__(self, seed: int):
        self.weight = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.base = int(mix(np.array([seed + 12345], dtype=np.uint64))[0]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.powers) < n:
            size = len(self.powers)
            step = np.uint64(pow(self.base, size, 1 << 64))
            back = np.uint64(pow(self.inverse, size, 1 << 64))
            self.powers = np.concatenate([self.powers, self.powers * step])
            self.inverses = np.concatenate([self.inverses, self.inverses * back])

    def prefix(self, block: np.ndarray) -> np.ndarray:
        n = len(block)
        self._grow(n + 1)
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.weight[block] * self.powers[:n], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of block[start:end], element by element."""
        return (prefix[end] - prefix[start]) * self.inverses[start]

    def fixed(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all windows of k bytes."""
        n = len(prefix) - k
        return (prefix[k:] - prefix[:n]) * self.inverses[:n] if n > 0 else prefix[:0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of runs of whole texts of about `limit` bytes.

    A null text counts as an empty one; a longer text makes a run of its own.
    """
    column = column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    if column.null_count:  # the bytes behind a null are not defined
        valid = np.asarray(column.is_valid())
        lengths = np.where(valid, np.diff(offsets), 0)
    else:
        lengths = np.diff(offsets)
    first = 0
    while first < n:
        last, size = first, 0
        while last < n and (last == first or size + lengths[last] <= limit):
            size += int(lengths[last])
            last += 1
        own = np.zeros(last - first + 1, dtype=np.int64)
        np.cumsum(lengths[first:last], out=own[1:])
        if column.null_count:
            parts = [data[offsets[i] : offsets[i] + lengths[i]] for i in range(first, last)]
            block = np.concatenate(parts) if parts else data[:0]
        else:
            block = data[offsets[first] : offsets[last]]
        yield first, last, block, own
        first = last


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORDS = Roller(7)
_FACTORS = [np.uint64(int(x) | 1) for x in mix(np.arange(101, 101 + SHINGLE_WORDS, dtype=np.uint64))]


def words(block: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, hash and text number of each word `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased."""
    inside = ~_SPACE[block]
    edge = np.zeros(len(block) + 1, dtype=bool)
    edge[offsets] = True  # a text's end ends its last word
    before = np.empty(len(block), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(block), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    hashes = mix(_WORDS.windows(_WORDS.prefix(_LOWER[block]), start, end) + (end - start).astype(np.uint64))
    text = np.searchsorted(offsets, start, side="right") - 1
    return start, end, hashes, text


def shingles(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each text in word order, and the text number of each.

    Five words make a shingle; a text of one to four words has its whole sequence as the only one.
    """
    n = len(hashes)
    k = SHINGLE_WORDS
    if n >= k:
        whole = text[k - 1 :] == text[: n - k + 1]
        total = hashes[: n - k + 1] * _FACTORS[0]
        for i in range(1, k):
            total = total + hashes[i : n - k + 1 + i] * _FACTORS[i]
        out, owner = mix(total[whole]), text[: n - k + 1][whole]
    else:
        out, owner = hashes[:0], text[:0]
    count = np.bincount(text, minlength=n_texts)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        first = np.cumsum(count) - count
        extra = []
        for i in short:
            total = np.uint64(count[i])  # a short sequence never equals a full shingle's sum by form
            for j, h in enumerate(hashes[first[i] : first[i] + count[i]]):
                total = np.uint64((int(total) * 31 + int(h) * int(_FACTORS[j])) & _MASK)
            extra.append(total)
        out = np.concatenate([out, mix(np.array(extra, dtype=np.uint64))])
        owner = np.concatenate([owner, short])
    return out, owner


def distinct_shingles(block: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, shingle hash), sorted by both."""
    _, _, hashes, text = words(block, offsets)
    value, owner = shingles(hashes, text, len(offsets) - 1)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[new], owner[new]
    return owner, value
