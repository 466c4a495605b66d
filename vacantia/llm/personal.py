"""Personal information in free text: found by a skip-chain conditional random field, replaced by typed placeholders.

Every word, number and mark of a text is a token with a label: outside, or the first or a further token of a name, e-mail
address, phone number, identity number or street address. A chain over each sentence scores the labels from the words
around a token; what looks like an address or a number is one feature among them and decides nothing by itself. Words of
one document that are alike are tied over any distance, and loopy message passing makes their labels agree. The weights,
the tie's among them, are trained here, on a bounded sample whose labels come from shapes, the list of given names and titles.

A batch of texts is read as arrays: features, scores and messages of all its sentences are computed at once.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.llm.tokens import _slices
from vacantia.session import spread

KINDS = ("name", "email", "phone", "id_number", "address")
#: Label 0 is outside, 2k + 1 the first and 2k + 2 a further token of kind k.
LABELS = 1 + 2 * len(KINDS)
PLACEHOLDER = {k: f"[{k.upper()}]" for k in KINDS}
#: Texts that the weights are trained on, at most, and characters of such a text, at most; longer ones aren't trained on.
TRAIN_TEXTS, TRAIN_CHARS = 4000, 20_000
#: Weights of hashed features; their number is fixed. The last one belongs to no feature and stays 0.
WIDTH = 1 << 17
#: Largest list of given names that is taken; a longer one is refused.
MAX_NAMES = 200_000
#: Bytes of text that are read at a time; a longer text is read whole.
BATCH = 1_000_000

_TITLES = {"mr", "mrs", "ms", "miss", "dr", "prof", "adv", "rev", "mnr", "mev", "mej", "sir"}
_PARTICLES = {"van", "von", "der", "den", "de", "du", "la", "le", "da", "dos", "bin", "al", "ter", "ten"}
_STREETS = "road rd street str st avenue ave lane ln drive dr close crescent cres boulevard blvd way place pl square sq terrace court ct grove row circle".split()
_STREET_ENDS = ("weg", "laan", "straat", "singel", "plein")
_UNIT = r"(?:unit|flat|suite|block|apartment|apt|office|shop|house|no\.?)\s+(?:[a-z]?-?\d+[a-z]?|(?-i:[A-Z]))(?:\s*,\s*|\s+)"
_CAP = r"(?-i:\p{Lu}[\p{L}'’]*)"
_NUMBER = r"\b\d{1,5}\s?[a-z]?(?:\s?[-–]\s?\d{1,5}[a-z]?)?"
_PLACE = rf"(?:,\s*{_CAP}(?:[ -]{_CAP})*)?(?:,\s*\d{{4}}\b)?"
_ADDRESS = regex.compile(
    rf"(?:(?:{_UNIT})?{_NUMBER}\s+(?:(?:{_CAP}|{'|'.join(_PARTICLES)})\s+)+?(?:{'|'.join(_STREETS)})\b\.?(?!\s(?-i:\p{{Lu}}\p{{Ll}}))"
    rf"|(?:{_UNIT})?(?-i:\p{{Lu}})\p{{L}}+(?:{'|'.join(_STREET_ENDS)})\s+\d{{1,5}}[a-z]?\b(?:\s?[-–]\s?\d{{1,5}})?"
    rf"|p\.?\s?o\.?\s?box\s+\d+){_PLACE}",
    regex.I,
)
_AT = re.compile(r"@|[(\[{]at[)\]}]|\sat\s", re.I)
_HOST = regex.compile(
    r"\s?(?:@|[(\[{]at[)\]}])\s?[\p{L}\d-]+(?:(?:\.|\s?[(\[{]dot[)\]}]\s?|\sdot\s)[\p{L}\d-]+)+|\sat\s[\p{L}\d-]+(?:\.[\p{L}\d-]+)*\sdot\s[\p{L}\d-]+(?:(?:\.|\sdot\s)[\p{L}\d-]+)*",
    regex.I,
)
_DIGITS = regex.compile(
    r"(?P<id_number>(?<![\p{L}\d.-])(?:\d{6}[ -]?\d{4}[ -]?\d{2} ?\d|[A-Z]{1,2}\d{7,9})(?![\d-]|[.]\d))"
    r"|(?P<phone>(?<![\p{L}\d.])(?:\+\d{1,3}|00\d{2}|\(0\d{1,3}\)|\(\d{3}\)|0\d{1,4})(?:[ .\-/]?\(0\)|[ .\-/]?\(\d{1,4}\))?(?:[ .\-/]?\d{2,9}){1,5}(?!\d|[.-]\d))"
)


def _plausible(kind: str, text: str) -> bool:
    """Shape checks a pattern can't say: a birth date in front of an identity number, 9 to 14 digits of a phone."""
    digits = re.sub(r"\D", "", text)
    if kind == "id_number" and text[0].isdigit():
        return 1 <= int(digits[2:4]) <= 12 and 1 <= int(digits[4:6]) <= 31
    return kind != "phone" or 9 <= len(digits) <= 14


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _shape(word: str) -> str:
    if word[0].isdigit():
        return f"d{min(len(word), 14)}{'z' if word[0] == '0' else ''}"
    if not word[0].isalpha():
        return word
    core = word.replace("'", "").replace("’", "")
    if len(core) == 1:
        return "A" if core.isupper() else "a"
    if core.isupper():
        return "AA-A" if "-" in core else "AA" if len(core) < 4 else "AAAA"
    if core[0].isupper():
        return "Aa-A" if "-" in core else "Aa" if core[1:].islower() else "AaA"
    return "a-a" if "-" in core else "aa"


def tie_key(word: str) -> str:
    """What similar words have in common: no case, diacritics, hyphens and apostrophes, no possessive ending."""
    bare = re.sub(r"['’]s?$", "", unicodedata.normalize("NFKD", word).casefold())
    return "".join(c for c in bare if c.isalpha())


# Kinds of characters, filled in as characters turn up: 0 space, 1 letter, 2 digit, 3 other, 9 not seen yet.
_CHARS = np.full(0x110000, 9, dtype=np.uint8)
# Characters of the part of an e-mail address before its sign.
_LOCAL = np.zeros(0x110000, dtype=bool)


def _classes(code: np.ndarray) -> np.ndarray:
    out = _CHARS[code]
    for c in np.unique(code[out == 9]):
        x = chr(c)
        kind = unicodedata.category(x)[0]
        _CHARS[c] = 0 if x.isspace() else 1 if kind in "LM" else 2 if kind == "N" and x.isdecimal() else 3
        _LOCAL[c] = kind == "L" or x.isdecimal() or x in "._%+-"
    return _CHARS[code]


@dataclass
class Tokens:
    """Tokens of a batch of texts, joined by line ends in ``text``; ``base`` is where each text begins.

    start, end; word: index into ``words``; gap: before the token is 0 nothing, 1 a space, 2 a line end; doc; first:
    whether a sentence begins.
    """

    text: str
    base: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: np.ndarray
    words: list[str]
    gap: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    local: np.ndarray


def read(texts: Sequence[str]) -> Tokens:
    """Tokens are runs of letters (with hyphens and apostrophes inside), runs of digits, and single marks.

    A sentence ends at a line end, unless after a comma, and at a mark .!? before white space; a period does so only
    after a word in lower case of three letters or more, one in upper case of four or more, a digit or a mark.
    """
    text = "\n".join(texts)
    base = np.cumsum([0, *(len(t) + 1 for t in texts)])
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _classes(code)
    around = np.pad(kind, 1)
    inner = np.isin(code, (39, 45, 8217)) & (around[:-2] == 1) & (around[2:] == 1)
    kind = np.where(inner, 1, kind).astype(np.uint8)
    before = np.concatenate([[0], kind[:-1]]) if len(kind) else kind
    begin = (kind != 0) & ((kind != before) | (kind == 3))
    start = np.flatnonzero(begin)
    after = np.concatenate([kind[1:], [0]]) if len(kind) else kind
    end = np.flatnonzero((kind != 0) & ((kind != after) | (kind == 3))) + 1
    index: dict[str, int] = {}
    words = [text[a:b] for a, b in zip(start.tolist(), end.tolist())]
    word = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    lines = np.concatenate([[0], np.cumsum(code == 10)])
    last = np.concatenate([[0], end[:-1]]) if len(end) else end
    gap = np.where(lines[start] > lines[last], 2, np.where(start > last, 1, 0))
    doc = np.searchsorted(base, start, side="right") - 1
    names = list(index)
    ends = np.array([1 if w in "!?" else 2 if w == "." else 3 if w == "," else 0 for w in names] or [0])[word]
    closed = np.array([not w[0].isalpha() or len(w) > 2 and w.islower() or len(w) > 3 and w.isupper() for w in names] or [False])[word]
    first = np.ones(len(start), dtype=bool)
    if len(start) > 1:
        mark, prior = ends[:-1], np.concatenate([[False], closed[:-2]])
        first[1:] = (doc[1:] != doc[:-1]) | (gap[1:] > 0) & ((gap[1:] == 2) & (mark != 3) | (mark == 1) | (mark == 2) & prior)
    outer = np.where(_LOCAL[code], -1, np.arange(len(code)))
    return Tokens(text, base, start, end, word, names, gap, doc, first, np.maximum.accumulate(outer) + 1 if len(code) else outer)


def lookalikes(t: Tokens, others: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(start, end, kind) of what has the shape of an e-mail address, a number or a street address, in order; overlaps stay.

    Patterns are tried only around what each needs: a sign for "at", many digits, a word for a street. ``others`` takes
    the places of seven digits or more that have no such shape.
    """
    out: list[tuple[int, int, int]] = []
    for m in _AT.finditer(t.text):
        at = m.start()
        spaced = at > 0 and not t.text[at].isspace() and t.text[at - 1].isspace()
        edge = at - spaced  # the part before the sign ends here
        begin = int(t.local[edge - 1]) if edge else 0
        if begin < edge:
            while begin < edge and not t.text[begin].isalnum():
                begin += 1
            if begin < edge and t.text[edge - 1].isalnum() and (found := _HOST.match(t.text, edge)):
                out.append((begin, found.end(), 1))
    digit = np.array([w[0].isdecimal() for w in t.words] or [False])[t.word]
    runs = np.flatnonzero(digit)
    if len(runs):
        apart = np.flatnonzero(t.start[runs[1:]] - t.end[runs[:-1]] > 3) + 1
        for group in np.split(runs, apart):
            if (t.end[group] - t.start[group]).sum() < 7:
                continue
            low, high = int(t.start[group[0]]), int(t.end[group[-1]])
            own = [(m.start(), m.end(), KINDS.index(m.lastgroup)) for m in _DIGITS.finditer(t.text, max(0, low - 4), min(len(t.text), high + 2)) if _plausible(m.lastgroup, m.group())]
            out += own
            if others is not None and not own:
                others.append((low, high))
    lows = [w.lower() for w in t.words]
    listed = set(_STREETS)
    street = np.array([w in listed or w == "box" or w.endswith(_STREET_ENDS) for w in lows] or [False])[t.word]
    done = prior = 0
    for k in np.flatnonzero(street).tolist():
        # Number, unit and the street's name (capitalised words and particles) stand before the word; what stands before
        # an earlier such word is looked at there.
        low = k
        while low > prior and t.doc[low - 1] == t.doc[k] and (k - low < 12 or t.words[t.word[low - 1]][0].isupper() or lows[t.word[low - 1]] in _PARTICLES):
            low -= 1
        prior = k
        for j in range(low, k + 1):
            if t.start[j] >= done and (m := _ADDRESS.match(t.text, int(t.start[j]), int(t.base[t.doc[k] + 1]) - 1)) and m.end() > t.start[k]:
                done = m.end()
                out.append((m.start(), done, 4))
                break
    return sorted(out)


def sentence_bounds(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(first token, number of tokens) of each sentence."""
    begin = np.flatnonzero(t.first)
    return begin, np.diff(np.append(begin, len(t.start)))


def covered(t: Tokens, spans: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """Labels of tokens under spans (start, end, kind): of spans that overlap the first one stands."""
    out = np.zeros(len(t.start), dtype=np.int8)
    if not spans:
        return out
    low = np.searchsorted(t.end, [s[0] for s in spans], side="right")
    high = np.searchsorted(t.start, [s[1] for s in spans], side="left")
    done = 0
    for (_, _, kind), a, b in zip(spans, low.tolist(), high.tolist()):
        if a >= done and b > a:
            out[a] = 2 * kind + 1
            out[a + 1 : b] = 2 * kind + 2
            done = b
    return out


class Model:
    """Hashed feature weights (WIDTH x labels), steps from label to label, the tie's weight, given names, ordinary words."""

    #: Message passing ends when no message moves by SETTLED, or after ROUNDS, as a graph with loops need not settle.
    SETTLED, ROUNDS = 1e-3, 100

    def __init__(self, given: Sequence[str]) -> None:
        self.weights = np.zeros((WIDTH, LABELS), dtype=np.float32)
        self.steps = np.zeros((LABELS, LABELS), dtype=np.float32)
        self.tie = 1.0
        self.given = {g.lower() for g in given if g}
        self.ordinary: frozenset[str] = frozenset()
        self.cache: dict[str, tuple[int, int, int, int]] = {}

    def codes(self, word: str) -> tuple[int, int, int, int]:
        """Hashes of word, shape, ending and listed flags."""
        if word not in self.cache:
            if len(self.cache) > 200_000:
                self.cache.clear()
            low = re.sub(r"\d", "0", word) if word[0].isdecimal() else word.lower()
            flags = "".join(c for c, own in zip("gotps", (self.given, self.ordinary, _TITLES, _PARTICLES, _STREETS)) if low in own)
            self.cache[word] = (_hash(low), _hash("s" + _shape(word)), _hash("e" + low[-3:]), _hash("f" + flags))
        return self.cache[word]


_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _slot(column: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((column + np.uint64(k + 1)) * _GOLD) >> np.uint64(40)).astype(np.int64) % (WIDTH - 1)


def _pair(*columns: np.ndarray) -> np.ndarray:
    out = columns[0]
    with np.errstate(over="ignore"):
        for c in columns[1:]:
            out = (out * _GOLD) ^ (c + (out >> np.uint64(31)))
    return out


class Features:
    """Rows of the weights for each token: those of the word and its neighbours (by distinct word), of pairs, of shapes around."""

    def __init__(self, model: Model, t: Tokens, shapes: np.ndarray) -> None:
        n = len(t.start)
        codes = np.array([*(model.codes(w) for w in t.words), (11, 12, 13, 14)], dtype=np.uint64)
        w, s, e, f = (codes[:, k] for k in range(4))
        sentence = np.cumsum(t.first)

        def shifted(d: int) -> np.ndarray:
            out = np.full(n, len(t.words), dtype=np.int64)
            if n > abs(d):
                a, b = (slice(d, None), slice(None, -d)) if d > 0 else (slice(None, d), slice(-d, None))
                out[b] = np.where(sentence[a] == sentence[b], t.word[a], len(t.words))
            return out

        at = {d: shifted(d) for d in (-3, -2, -1, 1, 2)} | {0: t.word}
        #: (word at each token, rows of weights by word)
        self.unary = [(at[0], np.stack([_slot(c, k) for k, c in enumerate((w, s, e, f, _pair(s, f)))], axis=1))]
        for j, d in enumerate((-1, 1)):
            self.unary.append((at[d], np.stack([_slot(c, 8 + 4 * j + k) for k, c in enumerate((w, s, f))], axis=1)))
        for j, d in enumerate((-2, 2)):
            self.unary.append((at[d], np.stack([_slot(c, 16 + 4 * j + k) for k, c in enumerate((w, f))], axis=1)))
        gap = t.gap.astype(np.uint64)
        after = np.append(gap[1:], 0).astype(np.uint64) if n else gap
        s0, sb, sa, wb, wa, w2 = s[at[0]], s[at[-1]], s[at[1]], w[at[-1]], w[at[1]], w[at[-2]]
        pairs = (_pair(s0, wb), _pair(s0, wa), _pair(s0, sb, sa), _pair(f[at[0]], f[at[1]]), _pair(f[at[0]], f[at[-1]]), _pair(s0, sb, w2), _pair(s0, gap, after), _pair(wb, w2))
        self.pairs = [_slot(c, 32 + k) for k, c in enumerate(pairs)]
        # Shapes: the tokens that have one, and rows for its kind and place, alone and with words before it.
        self.at = np.flatnonzero(shapes)
        own = shapes[self.at].astype(np.uint64)
        begin = np.maximum.accumulate(np.where(shapes % 2 == 1, np.arange(n), 0))[self.at] if n else self.at
        before = [_slot(_pair(own, w[at[d][begin]]), 48) for d in (-1, -2, -3)]
        self.shapes = np.stack([_slot(own, 47), *before, _slot(_pair(own, s0[self.at]), 49), _slot(_pair(own, wa[self.at]), 50)], axis=1)

    def rows(self) -> np.ndarray:
        """(tokens, features), for training."""
        shapes = np.full((len(self.unary[0][0]), self.shapes.shape[1]), WIDTH - 1)
        shapes[self.at] = self.shapes
        return np.concatenate([*(rows[word] for word, rows in self.unary), np.stack(self.pairs, axis=1), shapes], axis=1)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sums of the weights for each token and label; what depends on a word alone is summed once per word."""
        out = np.zeros((len(self.unary[0][0]), weights.shape[1]), dtype=np.float32)
        for word, rows in self.unary:
            out += weights[rows].sum(axis=1)[word]
        for rows in self.pairs:
            out += weights[rows]
        out[self.at] += weights[self.shapes].sum(axis=1)
        return out


def step_factors(steps: np.ndarray) -> np.ndarray:
    """Factors of label pairs; a further token only follows a token of its kind."""
    out = np.exp(steps.astype(np.float64))
    for k in range(len(KINDS)):
        out[[i for i in range(LABELS) if i not in (2 * k + 1, 2 * k + 2)], 2 * k + 2] = 0.0
    return out


class Chains:
    """Forward-backward over many chains of different lengths at once: step t runs over all chains with more than t tokens."""

    def __init__(self, begin: np.ndarray, length: np.ndarray) -> None:
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        more = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1 if len(length) else 1), side="right")
        self.steps = [begin[:n] + k for k, n in enumerate(more)]

    def beliefs(self, factors: np.ndarray, steps: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Label probabilities of the chains' tokens (other rows are undefined), and expected label pairs if asked for."""
        ahead = np.empty_like(factors)
        back = np.ones_like(factors)
        starts = np.ones(LABELS)
        starts[2::2] = 0.0
        now = starts
        for k, at in enumerate(self.steps):
            now = factors[at] * (starts if not k else now[: len(at)] @ steps)
            now /= now.sum(axis=1, keepdims=True)
            ahead[at] = now
        expected = np.zeros_like(steps) if pairs else None
        for k in range(len(self.steps) - 1, 0, -1):
            at, prior = self.steps[k], self.steps[k - 1][: len(self.steps[k])]
            seen = factors[at] * back[at]
            if pairs:
                seen = seen / ((ahead[prior] @ steps) * seen).sum(axis=1, keepdims=True)
                expected += steps * (ahead[prior].T @ seen)
            seen = seen @ steps.T
            back[prior] = seen / seen.sum(axis=1, keepdims=True)
        out = ahead * back
        out /= np.maximum(out.sum(axis=1, keepdims=True), 1e-300)
        return out, expected


def factors_of(scores: np.ndarray) -> np.ndarray:
    """Factors from scores, the greatest of a token 1, none under e**-40."""
    return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True, initial=-np.inf), -40.0).astype(np.float64))


def train(model: Model, rows: np.ndarray, gold: np.ndarray, begin: np.ndarray, length: np.ndarray, epochs: int = 6, rate: float = 0.2) -> None:
    """Maximum likelihood of the chains by AdaGrad: gradients are expected labels and label pairs less those that are there."""
    rng = np.random.default_rng(3)
    seen, seen_steps = np.full(model.weights.shape, 0.1, dtype=np.float32), np.full(model.steps.shape, 0.1)
    width = rows.shape[1]
    batches = []
    for part in np.array_split(rng.permutation(len(begin)), max(1, len(begin) // 200)):
        n = length[part]
        own = np.cumsum(n) - n
        at = np.repeat(begin[part] - own, n) + np.arange(int(n.sum()))
        flat = rows[at].ravel()
        order = np.argsort(flat, kind="stable")
        cells, bounds = np.unique(flat[order], return_index=True)
        label = gold[at].astype(np.int64)
        follows = np.ones(len(at), dtype=bool)
        follows[own] = False
        there = np.zeros_like(seen_steps)
        np.add.at(there, (label[np.flatnonzero(follows) - 1], label[follows]), 1.0)
        batches.append((rows[at], label, Chains(own, n), order // width, cells, bounds, there))
    for _ in range(epochs):
        for k in rng.permutation(len(batches)):
            own, label, chains, token, cells, bounds, there = batches[k]
            grad, pairs = chains.beliefs(factors_of(model.weights[own].sum(axis=1)), step_factors(model.steps), True)
            grad[np.arange(len(label)), label] -= 1.0
            sums = np.add.reduceat(grad.astype(np.float32)[token], bounds, axis=0) + 1e-3 * model.weights[cells]
            seen[cells] += sums**2
            model.weights[cells] -= rate * sums / np.sqrt(seen[cells])
            model.weights[-1] = 0.0
            change = pairs - there + 1e-3 * model.steps
            seen_steps += change**2
            model.steps -= (rate * change / np.sqrt(seen_steps)).astype(np.float32)


class Ties:
    """Similar capitalised words of a document, each tied to the next: (token, place in its group) in order of groups."""

    def __init__(self, t: Tokens) -> None:
        key = np.array([_hash(k) if w[0].isupper() and len(k := tie_key(w)) > 2 else -1 for w in t.words] or [-1], dtype=np.int64)[t.word]
        at = np.flatnonzero(key >= 0)
        at = at[np.lexsort((at, key[at], t.doc[at]))]
        new = np.ones(len(at), dtype=bool)
        if len(at):
            new[1:] = (key[at][1:] != key[at][:-1]) | (t.doc[at][1:] != t.doc[at][:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(at)))
        kept = np.repeat(size > 1, size)
        self.at = at[kept]
        self.size = size[size > 1]
        self.begin = np.cumsum(self.size) - self.size


def _classed(beliefs: np.ndarray) -> np.ndarray:
    """Probabilities of outside, name, anything else."""
    return np.stack([beliefs[:, 0], beliefs[:, 1] + beliefs[:, 2], beliefs[:, 3:].sum(axis=1)], axis=1)


def tie_factors(weight: float) -> np.ndarray:
    """Factors of tied classes: agreeing on name or outside is favoured; a word of an address or an e-mail says nothing of the others."""
    e = np.exp(weight)
    return np.array([[e, 1.0, np.sqrt(e)], [1.0, e, np.sqrt(e)], [np.sqrt(e), np.sqrt(e), np.sqrt(e)]])


def propagate(model: Model, t: Tokens, factors: np.ndarray) -> np.ndarray:
    """Label probabilities of each token by loopy message passing over chains and ties.

    Each round sweeps forward and backward along the ties of each group, so evidence reaches all its occurrences, and
    then scores anew the sentences whose messages moved. A group whose words are all certain, each to SETTLED, and agree
    sends no message: it could move no belief by more.
    """
    begin, length = sentence_bounds(t)
    if not len(begin):
        return factors
    steps = step_factors(model.steps)
    beliefs = Chains(begin, length).beliefs(factors, steps)[0]
    ties, agree = Ties(t), tie_factors(model.tie)
    if not len(ties.at):
        return beliefs
    sentence = np.cumsum(t.first) - 1
    at = ties.at
    ahead, back = np.full((len(at), 3), 1 / 3), np.full((len(at), 3), 1 / 3)
    sent = np.zeros(len(ties.size), dtype=bool)
    for turn in range(model.ROUNDS):
        own = _classed(beliefs[at])
        low, high = np.minimum.reduceat(own[:, 1], ties.begin), np.maximum.reduceat(own[:, 1], ties.begin)
        sent |= (high >= model.SETTLED) & (low <= 1 - model.SETTLED)
        groups = np.flatnonzero(sent)
        if not len(groups):
            break
        groups = groups[np.argsort(-ties.size[groups], kind="stable")]
        rest = own / (ahead * back)
        rest /= rest.sum(axis=1, keepdims=True)
        size = ties.size[groups]
        more = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
        new_ahead, new_back = ahead.copy(), back.copy()
        for k in range(1, len(more)):
            here = ties.begin[groups[: more[k]]] + k
            way = (rest[here - 1] * new_ahead[here - 1]) @ agree
            new_ahead[here] = way / way.sum(axis=1, keepdims=True)
        for k in range(len(more) - 1, 0, -1):
            here = ties.begin[groups[: more[k]]] + k
            way = (rest[here] * new_back[here]) @ agree
            new_back[here - 1] = way / way.sum(axis=1, keepdims=True)
        step = np.maximum(np.abs(np.log(new_ahead / ahead)).max(axis=1), np.abs(np.log(new_back / back)).max(axis=1))
        moved = step > model.SETTLED
        if not moved.any():
            break
        if turn >= 10:  # halved steps quieten messages that go to and fro
            new_ahead, new_back = (np.sqrt(x * y) for x, y in ((new_ahead, ahead), (new_back, back)))
        ahead[moved], back[moved] = new_ahead[moved], new_back[moved]
        again = np.unique(sentence[at[moved]])
        member = np.zeros(len(begin), dtype=bool)
        member[again] = True
        touched = member[sentence[at]]
        scaled = (ahead * back)[touched]
        extra = factors.copy()
        extra[at[touched]] *= np.concatenate([scaled[:, :1], scaled[:, 1:2], scaled[:, 1:2], np.repeat(scaled[:, 2:], LABELS - 3, axis=1)], axis=1)
        tokens = np.flatnonzero(member[sentence])
        beliefs[tokens] = Chains(begin[again], length[again]).beliefs(extra, steps)[0][tokens]
    return beliefs


def labels_of(model: Model, t: Tokens) -> np.ndarray:
    """The likeliest label of each token."""
    shapes = covered(t, lookalikes(t))
    return propagate(model, t, factors_of(Features(model, t, shapes).scores(model.weights))).argmax(axis=1)


def spans_of(t: Tokens, labels: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of the findings of each text, characters from 0: tokens of one kind up to the next first one.

    Marks behind the last word of a name don't belong to it, but for the period of an initial.
    """
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(t.base) - 1)]
    kind = (labels + 1) // 2
    inside = kind > 0
    follows = np.zeros(len(kind), dtype=bool)
    if len(kind) > 1:
        follows[1:] = inside[1:] & (kind[1:] == kind[:-1]) & (labels[1:] % 2 == 0) & (t.doc[1:] == t.doc[:-1]) & ~t.first[1:]
    begin = np.flatnonzero(inside & ~follows)
    stop = np.flatnonzero(inside & ~np.append(follows[1:], False)) + 1 if len(kind) else begin
    for a, b in zip(begin.tolist(), stop.tolist()):
        what = KINDS[kind[a] - 1]
        if what == "name":
            while b > a and not t.words[t.word[b - 1]][0].isalnum() and not (t.words[t.word[b - 1]] == "." and b - a > 1 and len(t.words[t.word[b - 2]]) == 1):
                b -= 1
            while a < b and not t.words[t.word[a]][0].isalnum():
                a += 1
            if a == b:
                continue
        off = int(t.base[t.doc[a]])
        out[t.doc[a]].append((what, int(t.start[a]) - off, int(t.end[b - 1]) - off))
    return out


def find_all(model: Model, texts: Sequence[str | None]) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of each finding in each text, characters from 0, in order; none in a null."""
    t = read([x or "" for x in texts])
    return spans_of(t, labels_of(model, t))


def find(model: Model, text: str | None) -> list[tuple[str, int, int]]:
    return find_all(model, [text])[0]


def redact(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """The text with each finding replaced by its placeholder; all else stays."""
    if text is None:
        return None
    parts, at = [], 0
    for kind, start, end in found:
        parts += [text[at:start], PLACEHOLDER[kind]]
        at = end
    return "".join([*parts, text[at:]])


Coarse = tuple[str, str, int, int]


def coarse(t: Tokens, spans: Sequence[tuple[int, int, int]]) -> list[list[Coarse]]:
    """Sentences of (word, number, mark or kind; text; start; end) for labelling: what has a shape is one piece."""
    shapes = covered(t, spans).tolist()
    out: list[list[Coarse]] = []
    for k, (a, b, w, first) in enumerate(zip(t.start.tolist(), t.end.tolist(), t.word.tolist(), t.first.tolist())):
        if shapes[k] and shapes[k] % 2 == 0:
            kind, _, start, _ = out[-1][-1]
            out[-1][-1] = (kind, t.text[start:b], start, b)
            continue
        if first:
            out.append([])
        word = t.words[w]
        kind = KINDS[shapes[k] // 2] if shapes[k] else "word" if word[0].isalpha() else "number" if word[0].isdecimal() else "mark"
        out[-1].append((kind, word, a, b))
    return out


def foreign_words(sentences: list[list[Coarse]], others: Sequence[tuple[int, int]]) -> set[str]:
    """Words that stand up to three places before numbers which are nobody's: more often before such as no shape fits."""
    misses, hits = Counter(), Counter()
    starts = {a for a, _ in others}
    for s in sentences:
        for k, (kind, _, start, _) in enumerate(s):
            if start in starts or kind in ("phone", "id_number"):
                (misses if start in starts else hits).update({w.lower() for what, w, _, _ in s[max(0, k - 3) : k] if what == "word"})
    return {w for w, n in misses.items() if n >= 3 and n > hits[w]}


def weak_labels(t: Tokens, given: Sequence[str]) -> tuple[np.ndarray, frozenset[str]]:
    """Training labels of tokens, and words known to be ordinary.

    A word belongs to names as often as it stands next to a listed given name or after a title; words for which that is
    so in at least a fifth of their capitalised uses pass it on to the capitalised words next to them, three times over.
    Runs of such words, initials and particles are names. Shapes are what they look like, but for numbers after words
    that more often stand before numbers of no such shape (foreign_words).
    """
    others: list[tuple[int, int]] = []
    spans = lookalikes(t, others)
    sentences = coarse(t, spans)
    foreign = foreign_words(sentences, others)
    listed = {g.lower() for g in given if g}
    lower: Counter = Counter(w for s in sentences for k, w, _, _ in s if k == "word" and w.islower())
    is_cap = lambda x: x[0] == "word" and x[1][0].isupper() and len(x[1]) > 1 and lower[x[1].lower()] < 3 and x[1].lower() not in _TITLES
    initial = lambda x: x[0] == "word" and len(x[1]) <= 2 and x[1].isupper()
    uses: Counter = Counter(x[1].lower() for s in sentences for x in s[1:] if is_cap(x))
    names = set(listed)

    def near(s: list[Coarse], k: int) -> Iterator[int]:
        """Places that may belong to the name that place k belongs to, skipping initials, particles, a comma."""
        for step in (-1, 1):
            j, commas = k + step, 0
            while 0 <= j < len(s):
                if s[j][1].lower() in _PARTICLES or initial(s[j]) or s[j][1] == "." and j and len(s[j - 1][1]) <= 2:
                    j += step
                elif s[j][1] == "," and not commas and s[j - 1][0] == "word" and s[j - 1][1].isupper():
                    commas += 1
                    j += step
                else:
                    yield j
                    break

    for _ in range(3):
        hits: Counter = Counter()
        for s in sentences:
            for k in range(1, len(s)):  # any word is capitalised in front
                if not is_cap(s[k]):
                    continue
                titled = s[k - 1][1].lower() in _TITLES or s[k - 1][1] == "." and k > 1 and s[k - 2][1].lower() in _TITLES
                if titled or s[k][1].lower() in listed or any(is_cap(s[j]) and s[j][1].lower() in names for j in near(s, k)):
                    hits[s[k][1].lower()] += 1
        names = listed | {w for w, n in hits.items() if n >= 0.2 * uses[w]}

    found: list[tuple[int, int, int]] = []
    for s in sentences:
        k = 0
        while k < len(s):
            if s[k][0] in KINDS:
                if s[k][0] not in ("phone", "id_number") or not any(w.lower() in foreign for _, w, _, _ in s[max(0, k - 3) : k]):
                    found.append((s[k][2], s[k][3], KINDS.index(s[k][0])))
            elif is_cap(s[k]) and s[k][1].lower() in names:
                i = j = k
                while i and (s[i - 1][1].lower() in _PARTICLES or initial(s[i - 1]) or s[i - 1][1] == "." and i > 1 and initial(s[i - 2]) and s[i - 2][1].lower() not in _TITLES):
                    i -= 1
                while j + 1 < len(s):
                    nxt, ahead = s[j + 1], s[j + 2] if j + 2 < len(s) else None
                    if is_cap(nxt) and nxt[1].lower() in names or nxt[1].lower() in _PARTICLES and ahead and ahead[1][0].isupper():
                        j += 1
                    elif initial(nxt) and ahead and (ahead[1] == "." or ahead[1][0].isupper()):
                        j += 1
                    elif nxt[1] == "." and len(s[j][1]) <= 2 and s[j][1].isupper():
                        j += 1
                    elif nxt[1] == "," and s[j][1].isupper() and len(s[j][1]) > 2 and ahead and (is_cap(ahead) and ahead[1].lower() in names or len(ahead[1]) == 1 and ahead[1].isupper()):
                        j += 1
                    else:
                        break
                found.append((s[i][2], s[j][3], 0))
                k = j
            k += 1
    labels = covered(t, sorted(found))
    lows = [w.lower() for w in t.words]
    named = {lows[w] for w in t.word[(labels == 1) | (labels == 2)].tolist()}
    plain = Counter(lows[w] for w in t.word[labels == 0].tolist())
    return labels, frozenset(w for w, n in plain.items() if n >= 3 and w[0].isalpha() and w not in named and w not in names)


def fit_tie(model: Model, t: Tokens, features: Features, labels: np.ndarray, held: np.ndarray) -> float:
    """The tie's weight by pseudo-likelihood on texts the chain wasn't trained on: each tied word given the chain's own belief and its tied neighbours' labels.

    One weight, by Newton's method, with a normal prior of deviation 2: rare disagreements alone must not make it endless.
    """
    ties = Ties(t)
    begin, length = sentence_bounds(t)
    if not len(ties.at) or not held.any():
        return 1.0
    own = _classed(Chains(begin, length).beliefs(factors_of(features.scores(model.weights)), step_factors(model.steps))[0])[ties.at]
    odds = np.log(np.maximum(own[:, 1], 1e-6)) - np.log(np.maximum(own[:, 0], 1e-6))
    label = labels[ties.at]
    side = np.where(label == 0, -1.0, np.where(label <= 2, 1.0, 0.0))
    group = np.repeat(np.arange(len(ties.size)), ties.size)
    beside = np.zeros(len(side))
    same = group[1:] == group[:-1]
    beside[1:] += np.where(same, side[:-1], 0.0)
    beside[:-1] += np.where(same, side[1:], 0.0)
    used = held[t.doc[ties.at]] & (side != 0) & (beside != 0)
    x, y, odds = beside[used], side[used] > 0, odds[used]
    weight = 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-(odds + weight * x)))
        slope, bend = (x * (y - p)).sum() - weight / 4, (x * x * p * (1 - p)).sum() + 1 / 4
        weight = min(max(weight + np.clip(slope / bend, -1, 1), 0.0), 8.0)
    return float(weight)


def train_model(texts: Sequence[str], given: Sequence[str]) -> Model:
    """Weights from texts: chains from four texts of five, the sentences that have a finding or a shape and as many others; the tie from the fifth."""
    model = Model(given)
    t = read(list(texts))
    if not len(t.start):
        return model
    labels, model.ordinary = weak_labels(t, given)
    shapes = covered(t, lookalikes(t))
    features = Features(model, t, shapes)
    begin, length = sentence_bounds(t)
    held = np.arange(len(texts)) % 5 == 4
    if len(texts) < 5:
        held[:] = False
    telling = np.add.reduceat(((labels > 0) | (shapes > 0)).astype(np.int64), begin) > 0
    own = np.flatnonzero(telling & ~held[t.doc[begin]])
    rest = np.flatnonzero(~telling & ~held[t.doc[begin]])
    chosen = np.sort(np.concatenate([own, rest[:: max(1, len(rest) // (len(own) + 1))]]))
    train(model, features.rows(), labels, begin[chosen], length[chosen])
    model.tie = fit_tie(model, t, features, labels, held)
    return model


def listed_names(names: DataFrame, column: str) -> list[str]:
    """The distinct names of a reference list, null and blank ones left out."""
    rows = names.where(F.trim(column) != "").select(F.trim(column).alias("n")).distinct().orderBy("n").limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} given names")
    return [r.n for r in rows]


def fit(texts: DataFrame, given: Sequence[str], train_texts: int = TRAIN_TEXTS) -> Model:
    """A model from ``train_texts`` of the distinct texts at most: those with the smallest hashes, a fair sample.

    A bound on the hash, from the number of rows, keeps nearly all of the others from leaving their tasks; the sample,
    of texts up to TRAIN_CHARS, then goes to the driver. Its size doesn't follow the data. ``texts`` has one column, text.
    """
    share = min(1.0, 2.0 * train_texts / max(texts.count(), 1))
    bound = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    rows = texts.where((F.col("text") != "") & (F.length("text") <= TRAIN_CHARS)).select(F.xxhash64("text").alias("h"), "text")
    sample = rows.where(F.col("h") <= bound).dropDuplicates(["h"]).orderBy("h").limit(train_texts).collect()
    return train_model([r.text for r in sample], given)


def find_in(df: DataFrame, keep: Sequence[str], text: str, model: Model, redacted: bool = True) -> DataFrame:
    """The columns ``keep``, redacted (STRING, if asked for) and found (ARRAY<STRUCT<pii_kind, start_pos, end_pos>>) for each row.

    start_pos and end_pos are the first and last character, from 1. Null text gives null and no findings, empty and
    blank text themselves; very long texts are read whole; repeated rows stay; an empty table gives no rows. The model
    (weights of fixed size, and the words of the sample) is broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    item = T.StructType([T.StructField("pii_kind", T.StringType()), T.StructField("start_pos", T.IntegerType()), T.StructField("end_pos", T.IntegerType())])
    more = [T.StructField("redacted", T.StringType())] if redacted else []
    schema = T.StructType([*df.select(*keep).schema.fields, *more, T.StructField("found", T.ArrayType(item))])
    kind = pa.list_(pa.struct([("pii_kind", pa.string()), ("start_pos", pa.int32()), ("end_pos", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in _slices(batch, len(keep), BATCH):
                texts = part.column(len(keep)).to_pylist()
                found = find_all(own, texts)
                listed = [[{"pii_kind": k, "start_pos": a + 1, "end_pos": b} for k, a, b in f] for f in found]
                columns = [pa.array(list(map(redact, texts, found)), pa.string())] if redacted else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns, pa.array(listed, kind)], names=schema.names)

    return spread(df.select(*keep, text)).mapInArrow(run, schema)
