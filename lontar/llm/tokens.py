"""Token ids of texts by a public byte-level BPE vocabulary.

Method. Encoding is a fold over a monoid. A text is halved until its parts fit a leaf; the
leaves are encoded on their own and neighbours are joined up the tree. A join re-encodes a
window around the border. Pre-tokens are matched from left to right, each depends only on
its own characters and the one behind it, and a merge never crosses a pre-token; so tokens
before the last pre-tokens of the left part cannot change, and once a border of the
window's pre-tokens falls on a border of the right part's own, nothing after it can. The
window grows until such a border is found. Decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache, partial

import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed value: pre-tokens of the vocabulary
LEAF = 512  # characters encoded at once
WINDOW = 64  # characters of the right part that a join looks at first

_pretoken = regex.compile(PATTERN)


@cache
def encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary if os.path.exists(vocabulary) else SparkFiles.get(os.path.basename(vocabulary)), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("lontar", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ship(df: DataFrame, vocabulary: str) -> None:
    """Send the vocabulary to the executors that do not hold it at its path."""
    if os.path.exists(vocabulary):
        df.sparkSession.sparkContext.addFile(vocabulary)


def _starts(text: str) -> list[int]:
    return [m.start() for m in _pretoken.finditer(text)]


class Part:
    """A stretch of text with its ids; the element of the monoid."""

    __slots__ = ("text", "ids", "coder")

    def __init__(self, text: str, ids: list[int], coder):
        self.text, self.ids, self.coder = text, ids, coder

    def join(self, other: Part) -> Part:
        if not self.text or not other.text:
            return self if self.text else other
        keep, tail = self._stable()
        width = WINDOW
        while True:
            window = tail + other.text[:width]
            if width >= len(other.text):
                return Part(self.text + other.text, keep + self.coder.encode_ordinary(window), self.coder)
            own = {len(tail) + s for s in _starts(other.text[:width])}
            # a border that text behind the window cannot move (a contraction reads two characters
            # on), and behind which a cut leaves the pre-token before it as it is
            sure = (s for s in _starts(window) if len(tail) <= s <= len(window) - 3 and s in own and s and not window[s - 1].isspace())
            meet = next(sure, None)
            if meet is not None:
                cut = meet - len(tail)
                drop = len(self.coder.encode_ordinary(other.text[:cut]))
                return Part(self.text + other.text, keep + self.coder.encode_ordinary(window[:meet]) + other.ids[drop:], self.coder)
            width *= 2

    def _stable(self) -> tuple[list[int], str]:
        """The ids that no text behind can change, and the text of the others."""
        width = WINDOW
        while True:
            if width >= len(self.text):
                return [], self.text
            at = len(self.text) - width
            # a pre-token border inside a run of letters is unknown from here: begin at one that is certain
            starts = [at + m.start() for m in _CERTAIN.finditer(self.text[at:])]
            ends = _starts(self.text[starts[0] :]) if starts else []
            if len(ends) > 3:
                cut = starts[0] + ends[-3]
                drop = len(self.coder.encode_ordinary(self.text[cut:]))
                return self.ids[: len(self.ids) - drop], self.text[cut:]
            width *= 2


# A letter behind one space behind a letter: a pre-token begins at the space, whatever came before.
_CERTAIN = regex.compile(r"(?<=\p{L}) (?=\p{L})")


def encode(text: str | None, coder, leaf: int = LEAF) -> list[int]:
    """Ids of a text; null and empty texts have none. Surrogates that cannot be written as
    UTF-8 count as U+FFFD."""
    if not text:
        return []
    if len(text) <= leaf:
        return coder.encode_ordinary(text)
    return _tree(text, coder, leaf).ids


def _tree(text: str, coder, leaf: int) -> Part:
    if len(text) <= leaf:
        return Part(text, coder.encode_ordinary(text), coder)
    half = len(text) // 2
    return _tree(text[:half], coder, leaf).join(_tree(text[half:], coder, leaf))


def decode(ids: list[int], coder) -> str:
    """The text of ids, bytes concatenated in order."""
    return coder.decode_bytes(ids).decode("utf-8", "replace")


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: str, count: bool) -> Iterator[pa.RecordBatch]:
    coder = encoding(vocabulary)
    for b in batches:
        ids = [encode(t, coder) for t in b.column("text").to_pylist()]
        made = pa.array([len(x) for x in ids], pa.int64()) if count else pa.array(ids, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([b.column("key"), made], names=["key", "n_tokens" if count else "ids"])


def token_ids(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """key bigint, ids array<int>: one row for each row of ``df``. Null, and empty texts have
    an empty list, text that spells a special token is ordinary text, null keys and repeated
    rows are kept as they are, an empty table gives an empty result."""
    ship(df, vocabulary)
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode, vocabulary=vocabulary, count=False), "key long, ids array<int>")


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """key bigint, n_tokens bigint: the number of ids of each row."""
    ship(df, vocabulary)
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode, vocabulary=vocabulary, count=True), "key long, n_tokens long")


def _decode(batches: Iterator[pd.DataFrame], vocabulary: str) -> Iterator[pd.DataFrame]:
    coder = encoding(vocabulary)
    for d in batches:
        yield pd.DataFrame({"key": d["key"], "text": [decode(list(x), coder) for x in d["ids"]]})


def token_texts(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """key bigint, text string of rows with key and ids."""
    ship(df, vocabulary)
    return df.select("key", "ids").mapInPandas(partial(_decode, vocabulary=vocabulary), "key long, text string")
