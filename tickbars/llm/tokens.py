"""Token counts with a whole-token shortcut.

Byte-level BPE splits a text into pre-tokens and merges each on its own. Most pre-tokens of ordinary text are strings of
the vocabulary, and nearly all of those come out of the merges as one token. Which do is proved once per vocabulary, by
running the merges on every vocabulary string; counting then needs a set look-up for them, and the merges for the rest
only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from tickbars.llm.shared import blocks, mapped, texts_of

#: Pre-token rules of the vocabulary; the second form is the same for texts of ASCII characters.
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
ASCII_PATTERN = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+""")
#: Beyond these blocks, Unicode tables of ``regex`` and ``tokenizers`` may be of different age: the library splits then.
OUTSIDE = re.compile("[^\x00-ԯḀ-⁯぀-ヿ一-龥가-힣]")

#: Merged counts a worker remembers; beyond it the older half is dropped.
REMEMBERED = 200_000


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary: its merges, special strings, and the pre-tokens proved to be one token."""

    def __init__(self, source: str):
        spec = json.loads(source)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or spec["model"].get("ignore_merges"):
            raise ValueError("a byte-level BPE without normalizer and prefix space is asked for")
        self.source = source
        self.model: models.BPE = Tokenizer.from_str(source).model
        specials = [x["content"] for x in spec["added_tokens"]]
        if any(x[k] for x in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("special strings with strip rules aren't handled")
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.letters = {chr(b): letter for b, letter in enumerate(byte_letters())}
        self.table = str.maketrans(self.letters)
        self.vocabulary = spec["model"]["vocab"]

    def merged(self, piece: str) -> int:
        """Tokens of a pre-token by the merges."""
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.table)))

    def prove(self) -> list[str]:
        """The vocabulary strings, as text, that the merges turn into one token."""
        back = {letter: b for b, letter in enumerate(byte_letters())}
        proved = []
        for entry in self.vocabulary:
            if len(self.model.tokenize(entry)) == 1 and all(c in back for c in entry):
                try:
                    proved.append(bytes(back[c] for c in entry).decode())
                except UnicodeDecodeError:
                    continue  # part of a character: never a pre-token
        return proved


class Counter:
    """Counts tokens of texts; one per task."""

    def __init__(self, vocabulary: Vocabulary, proved: list[str]):
        self.vocabulary = vocabulary
        self.whole = dict.fromkeys(proved, 1)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _rest(self, piece: str) -> int:
        n = self.young.get(piece)
        if n is None:
            n = self.old.get(piece) or self.vocabulary.merged(piece)
            if len(piece) <= 64:
                if len(self.young) * 2 >= REMEMBERED:
                    self.old, self.young = self.young, {}
                self.young[piece] = n
        return n

    def _plain(self, text: str) -> tuple[int, int]:
        if text.isascii():
            pieces = ASCII_PATTERN.findall(text)
        elif OUTSIDE.search(text):
            pieces = [text[a:b] for _, (a, b) in self.vocabulary.splitter.pre_tokenize_str(text)]
        else:
            pieces = PATTERN.findall(text)
        whole = self.whole
        rest = [p for p in pieces if p not in whole]
        return len(pieces) - len(rest), sum(map(self._rest, rest))

    def count(self, text: str) -> tuple[int, int]:
        """(tokens by the shortcut, tokens by merging and special strings)."""
        special = self.vocabulary.special
        if special is None or not special.search(text):
            return self._plain(text)
        parts = special.split(text)
        counts = [self._plain(p) for p in parts]
        return sum(a for a, _ in counts), sum(b for _, b in counts) + len(parts) - 1


def _count(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        source, proved = shared.value
        counter = Counter(Vocabulary(source), proved)
        for block in blocks(batches):
            texts = texts_of(block)
            counts = [counter.count(t) for t in texts.to_pylist()]
            size = pa.compute.binary_length(texts).cast(pa.int64())
            yield block, [size, pa.array([a + b for a, b in counts], pa.int64()), pa.array([a for a, _ in counts], pa.int64())]

    return run


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, n_whole`` for every row; ``n_whole`` tokens came from the shortcut.

    Counts equal the ``tokenizers`` library's for a byte-level BPE file, without added tokens, truncation or padding;
    special strings inside texts are one token each, as its default is. The vocabulary (a file of fixed size) is read
    and proved on the driver and broadcast.

    Rows are counted one by one, without a shuffle: repeated rows and ids give repeated results, null and empty texts
    have 0 bytes and tokens, null ids stay, texts of any length are counted whole, other columns are ignored, an empty table
    gives no rows. A text's count depends on nothing else, so ties can't arise.
    """
    source = Path(vocabulary_path).read_text()
    proved = Vocabulary(source).prove()
    shared = docs.sparkSession.sparkContext.broadcast((source, proved))
    return mapped(docs, (id_col,), text_col, "n_bytes long; n_tokens long; n_whole long", _count(shared))
