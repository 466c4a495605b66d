"""Near-duplicate records by overlap of word sequences: a size-aware heavy-light join.

Exact copies become one class first. Sets below a size boundary enumerate all subsets of SUBSET of their rarest members;
sets from it on scan inverted lists; the boundary is where the two costs add up to the least. Either way is certain to
meet every pair, whatever the number of sets and the frequency of their members. Every candidate passes an exact bound
on its difference and is then verified on the whole sets, so no pair is reported in error.
"""

from __future__ import annotations

import functools
import itertools
import math
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.llm.tokens import _slices
from vacantia.session import cut, spread

#: Members of an enumerated subset.
SUBSET = 3
#: Cost of an enumerated subset, which is shuffled and sorted, in pairs of an inverted list that are looked at.
SUBSET_COST = 200
#: Counters of member frequency; their number is fixed, so that the table can go to every worker.
COUNTERS = 1 << 20
#: Sets of an inverted list in one piece, about; a longer list is cut and its pieces are paired, so that it is no task of its own.
PIECE = 16384
#: Candidates whose sets are told by a broadcast of their hashes (16 bytes a pair).
FEW = 500_000
#: Pairs that are looked at in one step.
STEP = 1 << 17
#: Sets from which a list's pairs are looked at as a product of matrices, rows and columns of a tile of it; beyond LARGE members a
#: set's figures would not be exact there.
DENSE, TILE, LARGE = 128, (256, 512), 1 << 20
#: Buckets of a partition of the lists, at least, and rows of one, about: a bucket is held at once.
BUCKETS, BUCKET_ROWS = 1, 1 << 20


# Whether a character is a letter or digit, filled in as characters turn up; 2: not seen yet.
_WORDLY = np.full(0x110000, 2, dtype=np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(seed)) * _MIX
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each word of each text, in order: maximal runs of letters and digits of lower-cased text."""
    # A line end is no part of a word, so texts can be read as one.
    code = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    wordly = _WORDLY[code]
    if (wordly == 2).any():
        for c in np.unique(code[wordly == 2]):
            _WORDLY[c] = unicodedata.category(chr(c))[0] in "LN"
        wordly = _WORDLY[code]
    inside = np.flatnonzero(wordly)
    if not len(inside):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    start = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    length = np.diff(np.append(start, len(inside)))
    place = np.arange(len(inside)) - np.repeat(start, length)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(length.max()), 0x100000001B3, dtype=np.uint64))
        words = np.add.reduceat(_mixed(code[inside].astype(np.uint64)) * powers[place], start)
    line = np.concatenate([[0], np.flatnonzero(code == 10)])  # texts may have line ends of their own
    if len(line) > len(texts):
        ends = np.cumsum([len(t.lower()) + 1 for t in texts])
        return np.searchsorted(ends, inside[start], side="right"), _mixed(words)
    return np.searchsorted(line[1:], inside[start], side="right"), _mixed(words)


def shingle_sets(fields: Sequence[Sequence[str]], counted: int, min_words: int, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, size, members) of records with at least ``min_words`` words in field ``counted`` and one sequence or more: hashes of
    the sequences of ``shingle`` words over all fields, each once, in order. ``fields``: the texts of each field.
    """
    n = len(fields[0])
    text, word = word_hashes([t for row in zip(*fields) for t in row])
    record = text // len(fields)
    enough = np.bincount(record[text % len(fields) == counted], minlength=n) >= min_words
    runs = len(word) - shingle + 1
    if runs <= 0:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.int64),)
    own = np.flatnonzero((record[:runs] == record[shingle - 1 :]) & enough[record[:runs]])
    h = np.full(len(own), shingle, dtype=np.uint64)
    for k in range(shingle):
        h = _mixed(h ^ word[own + k])
    h, record = h.view(np.int64), record[own]
    order = np.lexsort((h, record))
    h, record = h[order], record[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (record[1:] != record[:-1])
    h, record = h[first], record[first]
    which, size = np.unique(record, return_counts=True)
    return which, size, h


def record_sets(df: DataFrame, id_col: str, columns: Sequence[str], count_col: str, min_words: int, shingle: int) -> DataFrame:
    """(id, h1, h2, n, members): the set of hashes of word sequences of each record, sorted, with two hashes of it."""
    fields = list(dict.fromkeys([*columns, count_col]))
    rows = spread(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"f{k}") for k, c in enumerate(fields)]))
    schema = T.StructType([rows.schema[0], *[T.StructField(c, T.LongType()) for c in ("h1", "h2")], T.StructField("n", T.IntegerType()), T.StructField("members", T.ArrayType(T.LongType()))])
    counted, used = fields.index(count_col), len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, counted + 1, 500_000):
                texts = [part.column(k + 1).to_pylist() for k in range(len(fields))]
                # A counted field that isn't compared only decides which records take part.
                which, size, members = shingle_sets(texts[:used], counted, min_words, shingle) if counted < used else shingle_sets(texts[:used], 0, 0, shingle)
                if counted >= used:
                    enough = np.bincount(word_hashes(texts[counted])[0], minlength=part.num_rows)[which] >= min_words
                    members, which, size = members[np.repeat(enough, size)], which[enough], size[enough]
                if not len(which):
                    continue
                at = np.cumsum(size) - size
                with np.errstate(over="ignore"):
                    h1, h2 = (_mixed(np.add.reduceat(_mixed(members.view(np.uint64), k), at) ^ size.astype(np.uint64), k).view(np.int64) for k in (1, 2))
                lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(members)).astype(np.int32)), pa.array(members))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(which)), pa.array(h1), pa.array(h2), pa.array(size.astype(np.int32)), lists], names=schema.names)

    return rows.mapInArrow(run, schema)


@functools.lru_cache(maxsize=32)
def _subsets(n: int) -> np.ndarray:
    """Subsets of SUBSET of n places."""
    return np.array(list(itertools.combinations(range(n), SUBSET)), dtype=np.int32).reshape(-1, SUBSET)


@dataclass(frozen=True)
class Prefixes:
    """Prefixes of a batch of sets: row k is ``members[start[k] : start[k] + length[k]]`` of set ``of[k]``."""

    of: np.ndarray
    start: np.ndarray
    length: np.ndarray
    members: np.ndarray
    counts: np.ndarray


@dataclass(frozen=True)
class Ordered:
    """Sets with their members by frequency, rarest first: members, their counts, sizes, and how many of each set occur in no other."""

    members: np.ndarray
    counts: np.ndarray
    sizes: np.ndarray
    single: np.ndarray


def _ordered(sizes: np.ndarray, flat: np.ndarray, counters: np.ndarray) -> Ordered:
    """Members of each set come sorted, so that equal frequencies stay in one order for all sets."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    n = counters[(flat >> 8) & (len(counters) - 1)]
    order = np.argsort((of << 40) + n, kind="stable")
    n = n[order]
    return Ordered(flat[order], n, sizes, np.bincount(of, weights=n <= 1, minlength=len(sizes)).astype(np.int64))


def _prefixes(o: Ordered, ratio: float, common: int) -> Prefixes:
    """The rarest members of each set: as many as must hold ``common`` common ones if the share ``ratio`` is common.

    All sets have their members in the same order, so of two partners the ``common`` first common members are in both
    prefixes. Members that occur in no other set can't be common and are left out; sets with too few others have no row.
    """
    own, need = o.sizes - o.single, np.ceil(ratio * o.sizes - 1e-9).astype(np.int64)
    length = own - need + common
    good = np.flatnonzero((own >= np.maximum(need, common)) & (own > 0))
    return Prefixes(good, (np.cumsum(o.sizes) - o.sizes + o.single)[good], np.minimum(length, own)[good], o.members, o.counts)


def _step(h: np.ndarray, member: np.ndarray) -> np.ndarray:
    h = (h ^ member.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _signatures(p: Prefixes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of the prefixes, hash, count of its rarest member) of all subsets of SUBSET."""
    for n in np.unique(p.length):
        subsets = _subsets(int(n))
        all_rows = np.flatnonzero(p.length == n)
        for rows in np.array_split(all_rows, max(1, len(all_rows) * len(subsets) // 200_000)):
            at = p.start[rows, None] + np.arange(n)
            h = np.ones((len(rows), len(subsets)), dtype=np.uint64)
            for k in range(SUBSET):
                h = _step(h, p.members[at][:, subsets[:, k]])
            yield np.repeat(rows, len(subsets)), h.ravel(), p.counts[at][:, subsets[:, 0]].ravel()


def _sets_of(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and members, one after the other, of a batch's sets."""
    lists = batch.column(column)
    return pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)


def _frequencies(classes: DataFrame) -> np.ndarray:
    """How often members of each counter occur over all classes: a fixed number of counters, summed in the cluster."""
    number = COUNTERS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(number, dtype=np.int64)
        for batch in batches:
            members = batch.column(0).flatten().to_numpy()
            total += np.bincount((members >> 8) & (number - 1), minlength=number)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": at, "n": total[at]})

    counts = classes.select("members").mapInArrow(add, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(number, dtype=np.int64)
    out[counts["at"].to_numpy()] = counts["n"].to_numpy()
    return out


def _boundary(classes: DataFrame, counters, ratio: float) -> tuple[int, int]:
    """The set size from which scanning inverted lists costs less, in all, than enumerating subsets; and a size that no set is below.

    Costs are summed by size to one row per 16 sizes; sizes above 2**20 share a row.
    """
    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, flat = _sets_of(batch, 0)
            enum, scan = np.zeros(len(sizes)), np.zeros(len(sizes))
            o = _ordered(sizes, flat, counters.value)
            p = _prefixes(o, ratio, SUBSET)
            enum[p.of] = [float(SUBSET_COST * math.comb(int(n), SUBSET)) for n in p.length]
            p = _prefixes(o, ratio, 1)
            sums = np.concatenate([[0], np.cumsum(p.counts)])
            scan[p.of] = (sums[p.start + p.length] - sums[p.start]) / 2
            size, at = np.unique(np.minimum(sizes, 1 << 20) // 16, return_inverse=True)
            totals = [np.bincount(at, weights=x, minlength=len(size)) for x in (enum, scan)]
            yield pa.RecordBatch.from_pydict({"size": size.astype(np.int64), "enum": totals[0], "scan": totals[1]})

    rows = classes.select("members").mapInArrow(cost, "size long, enum double, scan double").groupBy("size").agg(F.sum("enum").alias("enum"), F.sum("scan").alias("scan")).orderBy("size").collect()
    best, at, enum, scan = None, 0, 0.0, sum(r.scan for r in rows)
    for r in [None, *rows]:
        if r is not None:
            enum, scan = enum + r.enum, scan - r.scan
        if best is None or enum + scan < best:
            best, at = enum + scan, 0 if r is None else 16 * (r["size"] + 1)
    return at, 16 * rows[0]["size"] if rows else 0


#: Longs of parities in the lists, and in the check of sets as a whole.
LIST_LONGS = 6
#: Columns of a list, of a member or of a subset: the list or pair of its pieces; the set's size, its members before this one and
#: the piece (0: one only) in one number, which sorts by size; the set; parities of its members from here on.
COLUMNS = 3 + LIST_LONGS


def _cells(key: np.ndarray, count: np.ndarray, ids: np.ndarray, sizes: np.ndarray, before: np.ndarray, bits: np.ndarray, piece: int, buckets: int) -> pa.RecordBatch:
    """Lists' rows: one for each set and key; where ``count``, the most sets that can have the key, makes several pieces, one for each pair of pieces that has the set's own.

    Rows of one bucket are packed into one value: Spark moves few values, and the bucket's task sorts them. A set's rows stand
    one after the other, most of their parities equal, which compresses.
    """
    pieces = count // piece + 1
    again = np.repeat(np.arange(len(key)), pieces)
    other = np.arange(len(again)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    key, pieces, ids, sizes, before = key[again], pieces[again], ids[again], sizes[again], before[again]
    # The hash of the set alone may follow the order in which rows are dealt to tasks; it is mixed once more.
    own = (_step(np.full(len(key), 7, np.uint64), ids) % pieces.astype(np.uint64)).astype(np.int64)
    low, high = np.minimum(own, other), np.maximum(own, other)
    cell = _step(_step(_step(np.ones(len(key), np.uint64), key), low), high).view(np.int64)
    side = np.where(own == other, 0, np.where(own < other, 1, 2))
    key = np.where(pieces > 1, cell, key)
    bucket = (_mixed(key.view(np.uint64), 3) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, again = bucket[order], again[order]
    rows = np.column_stack([key[order], (sizes << 33 | before << 2 | side)[order], ids[order], bits[again]])
    first = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
    packed = [rows[i:k].tobytes() for i, k in zip(first, np.append(first[1:], len(bucket)))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array(packed, pa.binary())], names=["bucket", "rows"])


def _listed(ids: np.ndarray, sizes: np.ndarray, flat: np.ndarray, counters: np.ndarray, ratio: float, piece: int, buckets: int) -> pa.RecordBatch:
    """Each set in the lists of its prefix."""
    p = _prefixes(_ordered(sizes, flat, counters), ratio, 1)
    row = np.repeat(np.arange(len(p.length)), p.length)
    at = p.start[row] + np.arange(len(row)) - np.repeat(np.cumsum(p.length) - p.length, p.length)
    base = (np.cumsum(sizes) - sizes)[p.of][row]
    own = sizes[p.of[row]]
    return _cells(p.members[at], p.counts[at], ids[p.of[row]], own, at - base, _suffix_parities(p.members, at, base + own, LIST_LONGS), piece, buckets)


def _enumerated(ids: np.ndarray, sizes: np.ndarray, flat: np.ndarray, counters: np.ndarray, ratio: float, piece: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each set in the lists of all subsets of SUBSET of its prefix."""
    p = _prefixes(_ordered(sizes, flat, counters), ratio, SUBSET)
    end = np.cumsum(sizes)
    bits = _suffix_parities(p.members, end - sizes, end, LIST_LONGS)
    for rows, h, least in _signatures(p):
        of = p.of[rows]
        yield _cells(h.view(np.int64), least, ids[of], sizes[of], np.zeros(len(of), dtype=np.int64), bits[of], piece, buckets)


def _suffix_parities(members: np.ndarray, at: np.ndarray, end: np.ndarray, longs: int) -> np.ndarray:
    """Some longs of bits for each run members[at:end]: each bit the parity of the members that fall on it."""
    bit = ((members >> 32) & 0xFFFFFF) % (64 * longs)
    one = np.uint64(1) << (bit & 63).astype(np.uint64)
    out = np.empty((len(at), longs), dtype=np.uint64)
    for k in range(longs):
        sums = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(np.where(bit >> 6 == k, one, np.uint64(0)))]) if len(members) else np.zeros(1, np.uint64)
        out[:, k] = sums[end] ^ sums[at]
    return out.view(np.int64)


@dataclass(frozen=True)
class Lists:
    """Lists one after the other, each by size: sizes, how many must be common, members before, piece, set, parities, and the row up to which a set's partners can stand."""

    n: np.ndarray
    need: np.ndarray
    before: np.ndarray
    side: np.ndarray
    c: np.ndarray
    bits: np.ndarray
    end: np.ndarray

    def able(self, x: np.ndarray, y: np.ndarray, boundary: int) -> tuple[np.ndarray, np.ndarray]:
        """Of rows x < y of one list those that can have enough in common, with a set from ``boundary`` on."""
        # The greater set is y: how much more may differ.
        room = self.n[x] + self.n[y] - 2 * self.need[y] - self.before[x] - self.before[y]
        keep = np.flatnonzero((room >= 0) & (self.n[y] >= boundary))
        for own in self.bits:
            x, y, room = x[keep], y[keep], room[keep]
            room -= np.bitwise_count(own[x] ^ own[y])
            keep = np.flatnonzero(room >= 0)
        x, y = x[keep], y[keep]
        keep = (self.c[x] != self.c[y]) & ((self.side[x] ^ self.side[y] == 3) | (self.side[x] + self.side[y] == 0))
        return x[keep], y[keep]


def _few_longs(room: float, spread: float, differ: float) -> int:
    """Longs of parities with which pairs are looked at for the least, if ``room``, give or take the root of ``spread``, may differ and ``differ`` members do.

    Each long costs its share of the product; a pair that is left over costs about as much as 16 longs.
    """
    def cost(k: int) -> float:
        left = 32 * k * (1 - math.exp(-differ / (32 * k))) - room
        return k + 8 * math.erfc(left / math.sqrt(2 * (16 * k + spread)))

    return min(range(1, LIST_LONGS + 1), key=cost)


def _dense(lists: Lists, xs: np.ndarray, ys: np.ndarray, boundary: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a row of ``xs`` and a later one of ``ys``, rows of one list, that can have enough in common.

    What may differ and the number of parities that differ are a product of two vectors, one of either set: with parities
    as +1 and -1, half of it counts those equal less those that differ. All numbers are halves below 2**23, so exact.
    """
    ys = ys[lists.n[ys] >= boundary]
    if not len(xs) or not len(ys):
        return
    left, right = (lists.n - lists.before)[xs], (lists.n - 2 * lists.need - lists.before)[ys]
    longs = _few_longs(left.mean() + right.mean(), left.var() + right.var(), 1.6 * left.mean())

    def signs(rows: np.ndarray) -> np.ndarray:
        bits = np.ascontiguousarray(lists.bits[:longs, rows].T).view(np.uint8)
        return 1 - 2 * np.unpackbits(bits, axis=1).astype(np.float32)

    a = np.column_stack([signs(xs) / 2, left.astype(np.float32), np.ones(len(xs), np.float32)])
    b = np.ascontiguousarray(np.column_stack([signs(ys), np.ones(len(ys), np.float32), right.astype(np.float32) - 32 * longs]).T)
    for i in range(0, len(xs), TILE[0]):
        rows = xs[i : i + TILE[0]]
        to = int(np.searchsorted(ys, lists.end[rows].max()))
        for k in range(int(np.searchsorted(ys, rows[0], side="right")), to, TILE[1]):
            width = min(TILE[1], to - k)
            room = (a[i : i + TILE[0]] @ b[:, k : k + width]).ravel()
            at = np.flatnonzero(room >= 0)
            if not len(at):
                continue
            x, y = at // width, at % width + k
            x, y, room = rows[x], ys[y], room[at]
            keep = np.flatnonzero((y > x) & (y < lists.end[x]))
            for own in lists.bits[longs:]:
                x, y, room = x[keep], y[keep], room[keep]
                room -= np.bitwise_count(own[x] ^ own[y])
                keep = np.flatnonzero(room >= 0)
            x, y = x[keep], y[keep]
            keep = lists.c[x] != lists.c[y]
            if keep.any():
                yield x[keep], y[keep]


def _met(rows: np.ndarray, boundary: int, ratio: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets of one bucket's lists, as in _scan."""
    rows = np.ascontiguousarray(rows[np.lexsort((rows[:, 1], rows[:, 0]))].T)
    key, place = rows[:2]
    n, before = place >> 33, (place >> 2) & 0x7FFFFFFF
    starts = np.diff(key, prepend=key[0]) != 0
    starts[0] = True
    group = np.cumsum(starts) << 32
    end = np.searchsorted(group + n, group + np.floor((n - before) / ratio + 1e-9).astype(np.int64), side="right")
    lists = Lists(n, np.ceil(ratio * n - 1e-9).astype(np.int64), before, place & 3, rows[2], rows[3:].view(np.uint64), end)
    partners = np.maximum(end - np.arange(len(key)) - 1, 0)
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(key))
    for i, k in zip(first[last - first >= DENSE], last[last - first >= DENSE]):
        if n[k - 1] >= LARGE:
            continue
        partners[i:k] = 0
        of = [i + np.flatnonzero(lists.side[i:k] == side) for side in range(3)]
        for xs, ys in ((of[0], of[0]),) if len(of[0]) else ((of[1], of[2]), (of[2], of[1])):
            for x, y in _dense(lists, xs, ys, boundary):
                yield lists.c[x], lists.c[y]
    # The others pair by pair, those without a partner left out.
    some = np.flatnonzero(partners)
    total = np.concatenate([[0], np.cumsum(partners[some])])
    k = 0
    while k < len(some):
        to = max(k + 1, int(np.searchsorted(total, total[k] + STEP, side="right")) - 1)
        times = partners[some[k:to]]
        x = np.repeat(some[k:to], times)
        y = x + 1 + np.arange(len(x)) - np.repeat(total[k:to] - total[k], times)
        k = to
        x, y = lists.able(x, y, boundary)
        if len(x):
            yield lists.c[x], lists.c[y]


def _scan(batches: Iterator[pa.RecordBatch], boundary: int, ratio: float) -> Iterator[pa.RecordBatch]:
    """(a, b) with a < b from packed lists sorted by bucket: pairs with a set from ``boundary`` on that can have enough in common.

    A pair is looked at as if this were its first common member; it is one of its lists, so no pair is lost. Then the
    smaller set's members from here on must be as many as must be common, which bounds the partner's size; and the
    members before differ, as do at least those whose parities differ.
    """
    each = ((bucket, np.frombuffer(rows.as_buffer(), dtype=np.int64).reshape(-1, COLUMNS)) for batch in batches for bucket, rows in zip(batch.column(0).to_pylist(), batch.column(1)))
    for _, packed in itertools.groupby(each, key=lambda x: x[0]):
        found, n = [], 0
        for pair in itertools.chain(_met(np.concatenate([rows for _, rows in packed]), boundary, ratio), [None]):
            if pair is not None:
                found.append(pair)
                n += len(pair[0])
            if found and (pair is None or n >= STEP):
                a, b = (np.concatenate(x) for x in zip(*found))
                a, b = np.minimum(a, b), np.maximum(a, b)
                order = np.lexsort((b, a))
                a, b = a[order], b[order]
                new = (np.diff(a, prepend=~a[0]) != 0) | (np.diff(b, prepend=b[0]) != 0)
                yield pa.RecordBatch.from_pydict({"a": a[new], "b": b[new]})
                found, n = [], 0


def _candidates(classes: DataFrame, ratio: float) -> DataFrame:
    """(a, b) with a < b: hashes of two sets that share SUBSET of their rarest members, or are both in an inverted list.

    Sets that share a key stand together in one list; a list that can be long is cut into pieces, so neither a hot member
    nor a hot subset is a task of its own.
    """
    spark = classes.sparkSession
    total = _frequencies(classes)
    counters = spark.sparkContext.broadcast(total)
    (boundary, least), piece = _boundary(classes, counters, ratio), PIECE
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # As many buckets that one has about BUCKET_ROWS rows, if each member were listed.
    buckets = partitions * max(BUCKETS, math.ceil(float(np.dot(total, total // piece + 1)) / BUCKET_ROWS / partitions))

    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for k in range(0, batch.num_rows, 512):
                yield from _enumerated(ids[k : k + 512], *_sets_of(batch.slice(k, 512), 1), counters.value, ratio, piece, buckets)

    def list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for k in range(0, batch.num_rows, 1024):
                yield _listed(ids[k : k + 1024], *_sets_of(batch.slice(k, 1024), 1), counters.value, ratio, piece, buckets)

    def scanned(which: str, make, from_size: int) -> DataFrame:
        lists = classes.where(which).select("h1", "members").mapInArrow(make, "bucket int, rows binary")
        return lists.repartitionById(partitions, F.pmod("bucket", F.lit(partitions))).sortWithinPartitions("bucket").mapInArrow(lambda batches: _scan(batches, from_size, ratio), "a long, b long")

    # Inverted lists: a set at or above the boundary against all sets that can be its partner.
    out = scanned(f"n >= {math.floor(boundary * ratio)}", list_members, boundary)
    if least < boundary:
        out = out.unionByName(scanned(f"n < {boundary}", enumerate_subsets, 0))
        if least * ratio <= SUBSET - 1:
            # Sets so small that fewer than SUBSET common members are enough meet in inverted lists as well.
            out = out.unionByName(scanned(f"n <= {math.floor((SUBSET - 1) / ratio + 1e-9)}", list_members, 0))
    return out.distinct()


def class_pairs(classes: DataFrame, num: int, den: int) -> DataFrame:
    """(a1, a2, b1, b2): hashes of each two different sets of which den * common >= num * size holds for both sizes."""
    kept = cut(_candidates(classes, num / den))
    if kept.count() <= FEW:
        # Few pairs: only their sets are shuffled. At most twice as many hashes are broadcast.
        both = kept.select("a").unionByName(kept.select(F.col("b").alias("a"))).distinct()
        classes = classes.join(F.broadcast(both), F.col("h1") == F.col("a"), "left_semi")
    x = classes.select(F.col("h1").alias("a"), F.col("h2").alias("a2"), F.col("members").alias("ma"))
    y = classes.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), F.col("members").alias("mb"))
    common = F.size(F.array_intersect("ma", "mb"))
    verified = kept.join(x.hint("merge"), "a").join(y.hint("merge"), "b").where((den * common >= num * F.size("ma")) & (den * common >= num * F.size("mb")))
    return verified.select(F.col("a").alias("a1"), "a2", F.col("b").alias("b1"), "b2")


def near_duplicates(
    df: DataFrame, id_col: str, columns: Sequence[str], count_col: str, min_words: int = 0, shingle: int = 5, num: int = 4, den: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(members, links): each record with its class (h1, h2) of equal sets, and each link between different classes once.

    Records are compared by the set of their sequences of ``shingle`` words over ``columns``, joined by spaces (null is
    empty); two classes are linked if den times the common sequences is at least num times either number of sequences.
    Only records with at least ``min_words`` words in ``count_col`` and a non-null id take part; texts under
    ``shingle`` words have no sequence and no link. Long texts count as a whole. Repeated rows and copies are members
    of one class: nothing is expanded within a group of copies. Other columns are ignored; empty tables give no rows.
    """
    sets = cut(record_sets(df, id_col, columns, count_col, min_words, shingle))
    classes = cut(sets.select("h1", "h2", "n", "members").dropDuplicates(["h1", "h2"]))
    return sets.select("id", "h1", "h2"), class_pairs(classes, num, den)


def record_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id_a, id_b), a < b: all pairs of different records, within a class of copies and across linked classes."""
    m = members.distinct()
    left, right = m.select(F.col("id").alias("ia"), F.col("h1").alias("a1"), F.col("h2").alias("a2")), m.select(F.col("id").alias("ib"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    within = left.join(right, (F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2")) & (F.col("ia") < F.col("ib"))).select("ia", "ib")
    across = links.join(left, ["a1", "a2"]).join(right, ["b1", "b2"]).where("ia <> ib").select("ia", "ib")
    pairs = within.unionByName(across).select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))
    # A pair can come twice only if one of its ids is in several classes.
    several = members.groupBy("id").agg(*[f(h).alias(f"{f.__name__}_{h}") for f in (F.min, F.max) for h in ("h1", "h2")]).where("min_h1 <> max_h1 or min_h2 <> max_h2")
    return pairs if several.isEmpty() else pairs.distinct()


def record_links(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class_id, n_copies, n_links): per record its class (its smallest id), the records in it and the records linked to it in other classes."""
    m = members.distinct()
    sizes = m.groupBy("h1", "h2").agg(F.count("*").alias("n_copies"), F.min("id").alias("class_id"))
    both = links.select("a1", "a2", "b1", "b2").unionByName(links.select(F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2")))
    to = sizes.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), "n_copies")
    n = both.join(to, ["b1", "b2"]).groupBy(F.col("a1").alias("h1"), F.col("a2").alias("h2")).agg(F.sum("n_copies").alias("n_links"))
    return m.join(sizes.join(n, ["h1", "h2"], "left"), ["h1", "h2"]).select("id", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
