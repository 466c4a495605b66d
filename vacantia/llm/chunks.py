"""Cutting oversized texts into pieces under a token limit, at natural boundaries, with overlap.

A text is read as a tree: headings by rank, elements of markup as they are nested, paragraphs, list items by their
indent, lines, sentences, clauses, words. Packing goes down only into nodes above the limit and merges neighbouring packed parts on the way up.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vacantia.llm.tokens import DEFAULT_RANKS, Encoder, _slices, encoder_factory
from vacantia.session import spread

#: A heading's rank, 1 to 6, is its level of the tree; its start is the boundary.
_HEADING = regex.compile(r"(?m)^(#{1,6})\s|<h([1-6])[\s>]", regex.I)
#: Markup that holds text or other markup, and blank lines; their level follows how deep they stand. Some tags may go unclosed.
_ELEMENT = regex.compile(r"<(/?)(p|div|section|article|table|ul|ol|dl|li|dd|dt|tr|blockquote)\b[^<>]*>\s*|\n[^\S\n]*\n\s*", regex.I)
#: Elements within more others than this are on one level.
_DEEP = 60
_UNCLOSED = {"p", "li", "dd", "dt", "tr"}
#: Items of plain lists; their level follows their indent.
_ITEM = regex.compile(r"(?m)^([ \t]*)(?:[-*+•]|\d{1,3}[.)])\s")
#: Levels below with their patterns, whose ends are boundaries.
_BLOCK, _LINE = 7, 9
_BOUNDARIES = [
    ((_BLOCK, 0), regex.compile(r"</h[1-6]>\s*", regex.I)),
    ((_LINE, 0), regex.compile(r"\n\s*|<br\s*/?>\s*", regex.I)),
    ((10, 0), regex.compile(r"[.!?…。！？]+[\"'”’)\]]*(?=\s|<|$)|[。！？]+")),
    ((11, 0), regex.compile(r"[;:,|、，；](?=\s)|[、，；]")),
]
_WORD, _INSIDE = (12, 0), (13, 0)
#: A piece of more tokens, or of more than a part has room for, is taken apart.
_LONG_PIECE = 16


def _atoms(enc: Encoder, text: str, longest: int) -> tuple[list[int], list[int], set[int]]:
    """Starts and token counts of the smallest units, and which of them start inside a word.

    Units are the tokenizer's pieces; a piece of many tokens (a word without end) is taken apart at tokens that start a
    character. Counts add up, but for white space at a cut, which is tokenized together when nothing follows it.
    """
    pieces = enc.cut(text)
    all_ids = list(map(enc.ids_of, pieces))
    counts = list(map(len, all_ids))
    starts = [0, *itertools.accumulate(map(len, pieces))][:-1]
    if max(counts, default=0) <= longest:
        return starts, counts, set()
    whole, starts, counts, inside = starts, [], [], set()
    for begin, ids in zip(whole, all_ids):
        if len(ids) <= longest:
            starts.append(begin)
            counts.append(len(ids))
            continue
        at, pending, raw = begin, 0, b""
        for k, i in enumerate(ids):
            raw += enc.entries[i]
            pending += 1
            nxt = enc.entries[ids[k + 1]][0] if k + 1 < len(ids) else 0
            if nxt & 0xC0 != 0x80:  # the next token starts a character
                if at != begin:
                    inside.add(len(starts))
                starts.append(at)
                counts.append(pending)
                at, pending, raw = at + len(raw.decode()), 0, b""
    return starts, counts, inside


def _edges(text: str) -> Iterator[tuple[tuple[int, int], int]]:
    """(level, place) of the boundaries of the text's tree; a smaller level is higher up.

    Elements lie between headings and lines: where one opens or ends, the level is the number of elements that stay open
    around it, so an inner list comes apart only after the one that holds it. An item's level follows its indent.
    """
    for m in _HEADING.finditer(text):
        yield (len(m[1]) if m[1] else int(m[2]), 0), m.start()
    around: list[str] = []
    for m in _ELEMENT.finditer(text):
        tag = (m[2] or "").lower()
        if not tag:
            yield (_BLOCK, min(len(around), _DEEP)), m.end()
        elif m[1]:
            if tag in around:
                while around.pop() != tag:
                    pass
            yield (_BLOCK, min(len(around), _DEEP)), m.end()
        else:
            if around and around[-1] == tag and tag in _UNCLOSED:
                around.pop()
            yield (_BLOCK, min(len(around), _DEEP)), m.start()
            around.append(tag)
    for m in _ITEM.finditer(text):
        yield (_LINE - 1, len(m[1].expandtabs(4))), m.start()
    for rank, pattern in _BOUNDARIES:
        for m in pattern.finditer(text):
            yield rank, m.end()


def split_text(enc: Encoder, text: str | None, limit: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(start, core_start, end, n_tokens) of the pieces of a text, characters from 0; one piece if it fits, none if empty.

    Cores follow each other without gap from the first character to the last. A piece is its core with as many whole
    units before it as fit into ``overlap`` tokens. No piece has more than ``limit`` tokens.
    """
    if not text:
        return []
    if not 0 <= overlap < limit / 2 or limit < 8:
        raise ValueError("limit of at least 8 and overlap under half of it expected")
    if (whole := enc.count(text)) <= limit:
        return [(0, 0, len(text), whole)]
    starts, counts, inside = _atoms(enc, text, min(_LONG_PIECE, limit - overlap))
    n = len(starts)
    cum = [0, *itertools.accumulate(counts)]
    level = [_WORD] * n
    for k in inside:
        level[k] = _INSIDE
    for rank, at in _edges(text):
        k = bisect.bisect_left(starts, at)
        if 0 < k < n and level[k] > rank:
            level[k] = rank
    ranks = {rank: i for i, rank in enumerate(sorted(set(level)))}
    cuts: list[list[int]] = [[] for _ in ranks]
    for k in range(1, n):
        cuts[ranks[level[k]]].append(k)
    room = limit - overlap

    def pack(i: int, j: int, depth: int) -> list[tuple[int, int]]:
        """Parts of the node [i, j) under the room, cut as high in the tree as possible."""
        if cum[j] - cum[i] <= room or j - i == 1:
            return [(i, j)]
        inner: list[int] = []
        while depth < len(cuts):
            own = cuts[depth]
            inner = own[bisect.bisect_right(own, i) : bisect.bisect_left(own, j)]
            depth += 1
            if inner:
                break
        parts: list[tuple[int, int]] = []
        for a, b in zip([i, *inner], [*inner, j]):
            for part in pack(a, b, depth):
                if parts and cum[part[1]] - cum[parts[-1][0]] <= room:
                    parts[-1] = (parts[-1][0], part[1])
                else:
                    parts.append(part)
        return parts

    out = []
    for i, j in pack(0, n, 0):
        before = max(bisect.bisect_left(cum, cum[i] - overlap), 0) if i else 0
        end = starts[j] if j < n else len(text)
        size, k = cum[j] - cum[before], j
        while k > before and text[starts[k - 1] : end].isspace():
            k -= 1
        if k < j:  # white space at a cut is tokenized together when nothing follows it
            size = cum[k] - cum[before] + enc.count(text[starts[k] : end])
        out.append((starts[before], starts[i], end, size))
    return out


def split_table(df: DataFrame, id_col: str, text_col: str, limit: int = 512, overlap: int = 48, path: str = DEFAULT_RANKS, oversized_only: bool = True) -> DataFrame:
    """Ordered pieces of the texts above ``limit`` tokens (of all texts if not ``oversized_only``).

    Columns: id_col, piece_no from 1, n_pieces, char_start and char_end (characters, start from 1, end inclusive),
    core_start (where the part that is not overlap begins), n_tokens, piece. The cores of a document, put together,
    are its text. n_tokens is what the tokenizer says of the piece on its own.

    Null and empty texts have no pieces, blank ones count by their tokens; repeated rows are each cut on their own;
    other columns are ignored; an empty table gives no rows.
    """
    get = encoder_factory(df.sparkSession, path)
    schema = T.StructType(
        [df.select(id_col).schema[0]]
        + [T.StructField(c, T.IntegerType()) for c in ("piece_no", "n_pieces", "char_start", "char_end", "core_start", "n_tokens")]
        + [T.StructField("piece", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = get()
        for batch in batches:
            for part in _slices(batch):
                ids, rows = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    pieces = split_text(enc, text, limit, overlap)
                    if len(pieces) < 2 and oversized_only:
                        continue
                    slack = 0
                    while max((p[3] for p in pieces), default=0) > limit:  # white space at a cut took more tokens
                        slack += 1
                        pieces = split_text(enc, text, limit - slack, overlap)
                    for no, (start, core, end, count) in enumerate(pieces, 1):
                        ids.append(k)
                        rows.append((no, len(pieces), start + 1, end, core + 1, count, text[start:end]))
                cols = list(zip(*rows)) or [()] * 7
                arrays = [part.column(0).take(pa.array(ids, pa.int64()))] + [pa.array(c, pa.int32()) for c in cols[:6]] + [pa.array(cols[6], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return spread(df.select(id_col, text_col)).mapInArrow(run, schema)
