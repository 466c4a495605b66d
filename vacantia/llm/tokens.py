"""Byte-pair encoding by backtracking: exact merges in time linear in the text.

A piece of text is covered from the left with the longest vocabulary entry at each place (found for all places in one
Aho-Corasick pass); a cover stands only where neighbouring tokens are a pair that merging itself would leave apart.
Where it doesn't, the last token is shortened to its next longest prefix that is a token, or given up.
"""

from __future__ import annotations

import base64
import itertools
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vacantia.session import spread

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that cuts text into pieces before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What it says of ASCII text, for the faster engine.
_ASCII = re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", "[^\\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]"), re.ASCII)


def read_ranks(path: str = DEFAULT_RANKS) -> list[bytes]:
    """Vocabulary entries in rank order from a file of lines "base64 rank"."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for text, rank in pairs:
        out[int(rank)] = base64.b64decode(text)
    return out


class Encoder:
    """Encodes and decodes with one vocabulary; keeps the ids of pieces it has seen, up to ``remember`` of them."""

    def __init__(self, entries: list[bytes], pattern: str = PATTERN, remember: int = 200_000) -> None:
        self.entries, self.remember = entries, remember
        self.pieces = regex.compile(pattern)
        self.ascii = _ASCII if pattern == PATTERN else self.pieces
        by_bytes = {e: i for i, e in enumerate(entries)}
        self.lengths = [len(e) for e in entries]
        # Decoding table: all entries in one buffer with their offsets.
        self.buffer = b"".join(entries)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)]).tolist()
        self.shorter = [-1] * len(entries)
        for i, e in enumerate(entries):
            for cut in range(len(e) - 1, 0, -1):
                if (p := by_bytes.get(e[:cut])) is not None:
                    self.shorter[i] = p
                    break
        self.merged: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(len(entries))), list(range(len(entries)))
        for i, e in enumerate(entries):
            a = self.shorter[i]
            while a >= 0:
                b = by_bytes.get(e[self.lengths[a] :])
                if b is not None and a < i and b < i and self._apart(a, b):
                    self.merged[a, b] = i
                    self.left[i], self.right[i] = a, b
                    break
                a = self.shorter[a]
        self.apart: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i, e in enumerate(entries):
            self.automaton.add_word(e.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.known: dict[str, list[int]] = {}

    def _apart(self, a: int, b: int) -> bool:
        """Whether merging would leave a and b, side by side, as they are.

        Both are taken apart in the reverse order of their merges along the seam; they don't stand if some pair that
        met at the seam would have merged earlier than the merge that is being undone.
        """
        before = 1 << 62
        while True:
            if self.merged.get((a, b), before) < before:
                return False
            if a > b:
                before, a = a, self.right[a]
                if a == before:
                    before, b = b + 1, self.left[b]
                    if b + 1 == before:
                        return True
            else:
                before, b = b + 1, self.left[b]
                if b + 1 == before:
                    before, a = a, self.right[a]
                    if a == before:
                        return True

    def _stands(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > self.remember:
                self.apart.clear()
            known = self.apart[key] = self._apart(a, b)
        return known

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        n, lengths, shorter = len(data), self.lengths, self.shorter
        longest = [-1] * n
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end - lengths[token] + 1] = token  # later ends are longer tokens from the same start
        reachable = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0] if n else -1
        while at < n:
            while True:
                end = at + lengths[token]
                if reachable[end] and (not out or self._stands(out[-1], token)):
                    out.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    break
                if shorter[token] >= 0:
                    token = shorter[token]
                    continue
                reachable[at] = 0
                token = out.pop()
                at -= lengths[token]
                break
        return out

    def cut(self, text: str) -> list[str]:
        """The pieces of a text, within which merges happen; together they are the text."""
        return (self.ascii if text.isascii() else self.pieces).findall(text)

    def ids_of(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.piece(piece.encode())
            if len(piece) <= 64:
                if len(self.known) >= self.remember:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; of null and empty text, none."""
        return list(itertools.chain.from_iterable(map(self.ids_of, self.cut(text)))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(len, map(self.ids_of, self.cut(text)))) if text else 0

    def decode(self, ids: list[int]) -> str:
        """Text of ids, by slices of the one buffer."""
        o, b = self.offsets, self.buffer
        return b"".join(b[o[i] : o[i + 1]] for i in ids).decode("utf-8", errors="replace")


_ENCODERS: dict[int, Encoder] = {}


def encoder_factory(spark: SparkSession, path: str = DEFAULT_RANKS) -> Callable[[], Encoder]:
    """A function for workers that gives the encoder of a rank file, built once per worker process.

    The driver reads the file and broadcasts its entries; a vocabulary doesn't grow with the data (here 0.4 MB).
    """
    shared = spark.sparkContext.broadcast(read_ranks(path))

    def get() -> Encoder:
        key = hash(path)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(shared.value)
        return _ENCODERS[key]

    return get


def encode_table(df: DataFrame, id_col: str, text_col: str, path: str = DEFAULT_RANKS) -> DataFrame:
    """(id_col, ids ARRAY<INT>) of every row: ids of the text, an empty list for null and empty text.

    Repeated rows stay; blank text has the ids of its white space; very long texts are encoded whole. Only the two
    columns are read. An empty table gives no rows.
    """
    get = encoder_factory(df.sparkSession, path)
    schema = T.StructType([df.select(id_col).schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = get()
        for batch in batches:
            for part in _slices(batch):
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return spread(df.select(id_col, text_col)).mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, column: int = 1, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about so many bytes of text at most, so that long texts don't add up in a worker."""
    size = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for k, n in enumerate(size):
        if total and total + n > chars:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def decode_table(df: DataFrame, id_col: str, ids_col: str = "ids", path: str = DEFAULT_RANKS) -> DataFrame:
    """(id_col, text): the text of each list of ids; null for a null list."""
    get = encoder_factory(df.sparkSession, path)
    schema = T.StructType([df.select(id_col).schema[0], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = get()
        for batch in batches:
            texts = [None if ids is None else enc.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, schema)


def count_table(df: DataFrame, text_col: str, path: str = DEFAULT_RANKS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and n_tokens (BIGINT, 0 for null and empty text)."""
    keep = keep or [c for c in df.columns if c not in (text_col, "n_tokens")]
    get = encoder_factory(df.sparkSession, path)
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = get()
        for batch in batches:
            for part in _slices(batch, len(keep)):
                n = pa.array([enc.count(t) for t in part.column(len(keep)).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], n], names=[*keep, "n_tokens"])

    return spread(df.select(*keep, text_col)).mapInArrow(run, schema)
