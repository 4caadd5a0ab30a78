"""Columns of text as byte buffers: word spans, word hashes and window hashes for a whole block at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed 64-bit values, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + mix(np.array([seed], U64))[0])


BYTE_VALUES = seeded(256, 11)
LOWERED_VALUES = BYTE_VALUES.copy()
LOWERED_VALUES[65:91] = BYTE_VALUES[97:123]
STEP = U64(0x9FB21C651E98DF25)

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), STEP, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without nulls; offsets start at 0."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offs, data = texts.buffers()
    n = len(texts)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a block: byte span of each, and for each text the range of its words."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # len(texts) + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    """Maximal runs of non-separator bytes; no run crosses the border of two texts."""
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    begins[border] = inside[border]
    ends[border - 1] = inside[border - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of the bytes of each non-empty span."""
    if not len(start):
        return np.zeros(0, U64)
    lens = end - start
    begin = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(begin, lens)
    terms = values[data[place + np.repeat(start, lens)]] * powers(int(lens.max()))[place]
    return mix(np.add.reduceat(terms, begin) + lens.astype(U64))


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first item, text) of every run of ``size`` items that stays within one text; ``first`` are the texts' ranges."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n), text


def window_hashes(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """An order-sensitive hash of the ``size`` hashes from each place."""
    out = np.zeros(len(at), U64)
    for k in range(size):
        out = out * STEP + hashes[at + k]
    return mix(out + U64(size))
