"""Quality rules: word counts and compression bands.

A text that zstandard shrinks far more than prose of its length is repetitive; one that it hardly shrinks is noise. Both
are judged over the whole text and over its fixed chunks, against limits that depend on the length judged, because a
short text has no history to draw on and compresses less.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tickbars.llm.shared import blocks, mapped, texts_of
from tickbars.llm.spans import SPACES, buffers, find_words, span_hashes, window_hashes, windows

SYMBOLS = b"#*$%&|<>"
SPACE_BYTES = bytes(np.flatnonzero(SPACES).tolist())

SCHEMA = (
    "n_words long; word_chars long; n_symbols long; n_dup_lines long; n_repeat_words long; whole_ratio double; "
    "repetitive_bytes long; incompressible_bytes long; base_failed boolean; kept boolean; reason string"
)


@dataclass(frozen=True)
class Bands:
    """From each length in bytes on: the ratio (raw to compressed bytes) below and above which a text is out of band."""

    lengths: tuple[int, ...] = (0, 256, 512, 1024, 4096, 16384)
    low: tuple[float, ...] = (0.0, 1.05, 1.2, 1.38, 1.45, 1.5)
    high: tuple[float, ...] = (2.5, 3.0, 3.2, 3.4, 3.8, 4.2)

    def judge(self, length: int, packed: int) -> int:
        """1 too repetitive, -1 incompressible, 0 in band."""
        k = int(np.searchsorted(self.lengths, length, "right")) - 1
        ratio = length / packed
        return 1 if ratio > self.high[k] else -1 if ratio < self.low[k] else 0


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    repeat_window: int = 5
    bands: Bands = Bands()
    chunk_bytes: int = 4096
    max_chunk_percent: int = 50
    level: int = 3


def _sums(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[first[1:]] - total[first[:-1]]


def repeat_words(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """For each text the words inside a window of ``size`` words that the text holds twice or more."""
    at, text = windows(first, size)
    if not len(at):
        return np.zeros(len(first) - 1, np.int64)
    keys = window_hashes(hashes, at, size) + window_hashes(text.astype(np.uint64), np.arange(len(text)), 1)
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    hit = at[counts[inverse] > 1]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + size, -1)
    return _sums(np.cumsum(cover[:-1]) > 0, first)


def _judge(rules: Rules):
    kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        for block in blocks(batches):
            data, offsets = buffers(texts_of(block))
            words = find_words(data, offsets)
            n = words.counts
            repeats = repeat_words(span_hashes(data, words.start, words.end), words.first, rules.repeat_window)
            word_chars = _sums(((data & 0xC0) != 0x80) & ~SPACES[data], offsets)
            raw = data.tobytes()
            rows = []
            for i in range(len(n)):
                text = raw[offsets[i] : offsets[i + 1]]
                lines = [x for x in text.split(b"\n") if x.strip()]
                symbols = len(text) - len(text.translate(None, SYMBOLS))
                too = {1: 0, -1: 0, 0: 0}
                ratio, whole = 0.0, 0
                if text:
                    packed = len(packer.compress(text))
                    ratio, whole = len(text) / packed, rules.bands.judge(len(text), packed)
                    for k in range(0, len(text), rules.chunk_bytes):
                        part = text[k : k + rules.chunk_bytes]
                        too[rules.bands.judge(len(part), len(packer.compress(part)))] += len(part)
                base = "few_words" if n[i] < rules.min_words else ""
                if not base and 100 * repeats[i] > rules.max_repeat_percent * n[i]:
                    base = "repeated_words"
                over = [100 * too[k] > rules.max_chunk_percent * len(text) for k in (1, -1)]
                reason = base or {1: "repetitive", -1: "incompressible", 0: ""}[whole]
                reason = reason or ("repetitive_chunks" if over[0] else "incompressible_chunks" if over[1] else "")
                dup_lines = len(lines) - len(set(lines))
                counts = (int(n[i]), int(word_chars[i]), symbols, dup_lines, int(repeats[i]))
                rows.append((*counts, ratio, too[1], too[-1], bool(base), not reason, reason or None))
            yield block, [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]

    return run


def judge_quality(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    rules: Rules = Rules(),
    prefix: str = "",
    only_kept: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every row, then the measures and verdict of its text, each name after ``prefix``.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, whole_ratio, repetitive_bytes, incompressible_bytes,
    base_failed, kept, reason``. A text is kept if it has ``min_words`` words, no more than ``max_repeat_percent`` of
    them in repeated windows, a ratio in band, and no more than ``max_chunk_percent`` of its bytes in chunks that are
    out of band on one side. With ``only_kept`` rejected rows are left out.

    Rows are judged one by one, without a shuffle: repeated rows and ties get equal verdicts, null or empty texts have no
    words and fail, texts of any length are judged whole, nulls elsewhere pass through, other columns are ignored, an empty table gives no rows.
    """
    return mapped(docs, keep, text_col, SCHEMA, _judge(rules), prefix, "kept" if only_kept else None)
