"""Freely typed values mapped to a reference list: a trie of names and aliases searched with Levenshtein automata."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vacantia.session import spread

#: Largest reference list that is sent to the workers; a longer one is refused.
MAX_ENTRIES = 200_000


def allowed(length: int) -> int:
    """Edits allowed for a name of so many letters without spaces: none up to 3, then 1, from 8 on 2, from 14 on 3."""
    return 0 if length <= 3 else 1 if length <= 7 else 2 if length <= 13 else 3


def plain(text: str) -> str:
    """Lower case without diacritics."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


class Automaton:
    """Levenshtein automaton of a word with edits and neighbour swaps, as a set of (position, edits, swap) states.

    Deterministic steps are made when first needed and kept.
    """

    def __init__(self, word: str, edits: int) -> None:
        self.word, self.edits, self.n = word, edits, len(word)
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.start = frozenset([(0, 0, False)])

    def step(self, states: frozenset, c: str) -> frozenset:
        key = (states, c)
        if key in self.steps:
            return self.steps[key]
        w, n, k, out = self.word, self.n, self.edits, set()
        for i, e, swap in states:
            if swap:
                if w[i] == c:
                    out.add((i + 2, e, False))
                continue
            if i < n and w[i] == c:
                out.add((i + 1, e, False))
            if e < k:
                out.add((i, e + 1, False))
                if i < n:
                    out.add((i + 1, e + 1, False))
                if i + 1 < n and w[i + 1] == c:
                    out.add((i, e + 1, True))
                for d in range(1, k - e + 1):
                    if i + d < n and w[i + d] == c:
                        out.add((i + d + 1, e + d, False))
        found = self.steps[key] = frozenset(out)
        return found

    def distance(self, states: frozenset) -> int | None:
        best = min((e + self.n - i for i, e, swap in states if not swap), default=self.edits + 1)
        return best if best <= self.edits else None


class Reference:
    """Trie over names and aliases without spaces; a path ends in the entries that bear that name."""

    def __init__(self, entries: Sequence[tuple[int, str, str | None, str | None, str, Sequence[str] | None]], remember: int = 200_000) -> None:
        """entries: (id, kind, province, country, name, aliases)."""
        self.root: dict = {}
        self.info = {}
        self.longest = 0
        self.numbered = False
        self.remember = remember
        self.known: dict[str, list[tuple[int, int]]] = {}
        self.values: dict[tuple[str, tuple[str, ...]], int] = {}
        for id_, kind, province, country, name, aliases in entries:
            self.info[id_] = (kind, province, country)
            for path in [name, *(aliases or [])]:
                word = re.sub(r"[\W_]+", "", plain(path or ""))
                if not word:
                    continue
                node = self.root
                for c in word:
                    node = node.setdefault(c, {})
                node.setdefault("", []).append(id_)
                self.longest = max(self.longest, len(word))
                self.numbered |= any(c.isdigit() for c in word)

    def search(self, word: str) -> list[tuple[int, int]]:
        """(distance, entry) of all entries within the distance allowed for their length, closest first; an entry's closest name counts."""
        if word in self.known:
            return self.known[word]
        auto = Automaton(word, allowed(len(word) + 1) if len(word) > 2 else 0)
        best: dict[int, int] = {}
        stack = [(self.root, auto.start, 0)]
        while stack:
            node, states, depth = stack.pop()
            for c, below in node.items():
                if c == "":
                    d = auto.distance(states)
                    if d is not None and d <= allowed(depth) and d <= allowed(len(word) + 1):
                        best |= {i: min(d, best.get(i, d)) for i in below}
                elif nxt := auto.step(states, c):
                    stack.append((below, nxt, depth + 1))
        found = sorted((d, i) for i, d in best.items())
        if len(self.known) >= self.remember:
            self.known.clear()
        self.known[word] = found
        return found

    def lookup(self, value: str, kinds: tuple[str, ...]) -> int:
        """The entry meant by a value, -1 if none: see map_values."""
        key = (value, kinds)
        if key not in self.values:
            if len(self.values) >= self.remember:
                self.values.clear()
            self.values[key] = self._lookup(value, kinds)
        return self.values[key]

    def _lookup(self, value: str, kinds: tuple[str, ...]) -> int:
        text = plain(html.unescape(re.sub(r"<[^>]*>", " , ", value)))
        hits = []  # (distance, -length, start, end, ids)
        at = 0
        for part in re.split(r"[,;/|()&<>\[\]:]|\bor\b|\band\b", text):
            words = re.findall(r"[^\W_]+", part)
            for i in range(len(words)):
                joined = ""
                for j in range(i, len(words)):
                    if words[j].isdigit() and not self.numbered:
                        break
                    joined += words[j]
                    if len(joined) > self.longest + 3:
                        break
                    # Only entries of kinds that can be meant, or say where, compete; of these the closest.
                    own = [(d, k) for d, k in self.search(joined) if self.info[k][0] in kinds or kinds[0] == "city"]
                    if own:
                        hits.append((own[0][0], -len(joined), at + i, at + j + 1, tuple(k for d, k in own if d == own[0][0])))
            at += len(words) + 1
        chosen = []
        for hit in sorted(hits):
            if all(hit[3] <= other[2] or hit[2] >= other[3] for other in chosen):
                chosen.append(hit)
        chosen.sort(key=lambda h: h[2])
        named = [[i for i in h[4]] for h in chosen]
        regions = {self.info[i][1] for ids in named for i in ids if self.info[i][0] == "province"}
        countries = {self.info[i][2] for ids in named for i in ids if self.info[i][0] == "country"}
        for kind in kinds:
            for ids in named:
                own = [i for i in ids if self.info[i][0] == kind]
                if own:
                    return min(own, key=lambda i: (bool(regions) and self.info[i][1] not in regions, bool(countries) and self.info[i][2] not in countries, i))
        return -1


def map_values(df: DataFrame, value: str, keep: Sequence[str], places: DataFrame, kinds: Sequence[str] = ("city", "province", "country")) -> DataFrame:
    """The columns ``keep`` and place_id for each row whose value has a letter; -1 where the list has no such entry.

    A value is freed of markup, diacritics and case and cut at commas, slashes, brackets and the like; every run of its
    words, joined without spaces (spaces are lost and gained in typing), is searched in the trie of names and aliases,
    with as many edits (insertion, deletion, substitution, swap of neighbours) as the name's length allows. Of the
    entries within that distance those of ``kinds`` compete (with cities, provinces and countries also, which tell
    cities of one name apart). Of overlapping hits the closest stays, then the longest. The first entry of the most exact kind counts, in the order
    of ``kinds``; of entries with one name that of the province or country named beside it, else the smallest id.

    There is no shuffle: each task maps its rows and keeps what it has seen, up to a bound. The reference list goes to
    the workers as a whole and is refused above MAX_ENTRIES. Null values and values without letters give no row;
    repeated rows stay; a very long value is searched whole; entries with null or blank names and aliases are skipped;
    an empty list gives -1 everywhere; an empty table gives no rows.
    """
    listed = places.select("place_id", "kind", "province", "country", "name", "aliases").where("place_id is not null").limit(MAX_ENTRIES + 1).collect()
    if len(listed) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} entries")
    shared = df.sparkSession.sparkContext.broadcast([tuple(r) for r in listed])
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField("place_id", T.IntegerType())])
    order = tuple(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference = Reference(shared.value)
        for batch in batches:
            ids = [reference.lookup(v, order) if v and any(c.isalpha() for c in v) else None for v in batch.column(len(keep)).to_pylist()]
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.int32())], names=[*keep, "place_id"])
            yield out.filter(out.column(len(keep)).is_valid())

    return spread(df.select(*keep, value)).mapInArrow(run, schema)
