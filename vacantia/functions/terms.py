"""Rule tables against texts, in one Arrow pass per row: an automaton finds the terms that may match, only their patterns run.

A rule has a number; a scan gives for each row a map from the numbers of the rules that match to what they matched. Labels
and evidence are expressions over that small map, so no pattern runs twice and plans stay small.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rule_tables as R
from vacantia.functions.rules import anchor, java


@dataclass(frozen=True)
class View:
    """A text made of a row's columns: joined (null counts as empty), perhaps without the empty ones, white space collapsed, ends cut."""

    columns: tuple[str, ...]
    joint: str = " "
    filled: bool = False
    tidy: bool = False
    stripped: bool = False

    def text(self, row: dict[str, str | None]) -> str:
        parts = [row[c] or "" for c in self.columns]
        out = self.joint.join(p for p in parts if p or not self.filled)
        return " ".join(out.split()) if self.tidy else out.strip() if self.stripped else out


_TITLE, _TEXT = View(("title",)), View(("description",))
#: Name: the text that its rules read, and the rules, each ending with its terms.
FAMILIES: dict[str, tuple[View, list[tuple]]] = {
    "city": (View(("location",), tidy=True), R.CITIES), "country": (View(("location",), tidy=True), R.COUNTRIES), "remote_home": (_TEXT, [("", R.REMOTE_HOME)]),
    "workplace": (View(("title", "location", "description")), R.WORKPLACES),
    "title_level": (_TITLE, [("senior", R.SENIOR_TITLE), *R.EARLY_TITLE]), "source_level": (View(("explicit",), tidy=True), R.SOURCE_LEVEL), "text_level": (_TEXT, R.DESCRIPTION_LEVEL),
    "veto": (_TITLE, [("", R.TECH_VETO)]), "tech_title": (_TITLE, R.TECH_TITLE), "generic": (_TITLE, [("", R.GENERIC_EARLY)]), "tech_text": (View(("department", "description"), filled=True), R.TECH_DESCRIPTION),
    "score_title": (_TITLE, R.SCORE_TITLE), "score_source": (View(("explicit",)), R.SCORE_SOURCE), "score_text": (_TEXT, R.SCORE_DESCRIPTION), "pool": (View(("title", "description")), [("", R.TALENT_POOL)]),
    "audit_early": (_TITLE, [("", R.AUDIT_EARLY)]), "audit_senior": (_TITLE, [("", R.AUDIT_SENIOR)]), "audit_mid": (_TITLE, [("", R.AUDIT_MID)]),
    "skill": (View(("title", "description"), joint="\n", stripped=True), R.SKILLS), "degree": (_TEXT, [("", R.DEGREE_REQUIRED)]), "field": (_TEXT, R.DEGREE_FIELDS), "soft": (_TEXT, R.SOFT_SKILLS),
}
_FIRST: dict[str, int] = {}
for _name, (_, _rules) in FAMILIES.items():
    _FIRST[_name] = sum(len(FAMILIES[n][1]) for n in _FIRST)


@functools.cache
def _engine(names: tuple[str, ...]) -> list[tuple[View, ahocorasick.Automaton, list[tuple[int, re.Pattern]], list[int]]]:
    """Per text: the automaton of anchors with the terms of each, (rule, pattern) of each term, and the terms without an anchor."""
    out = []
    for view in dict.fromkeys(FAMILIES[n][0] for n in names):
        terms: list[tuple[int, re.Pattern]] = []
        by_anchor: dict[str, list[int]] = {}
        for n in names:
            if FAMILIES[n][0] == view:
                for k, rule in enumerate(FAMILIES[n][1]):
                    for term in rule[-1]:
                        by_anchor.setdefault(anchor(term), []).append(len(terms))
                        terms.append((_FIRST[n] + k, re.compile(java(term), re.I)))
        auto = ahocorasick.Automaton()
        always = by_anchor.pop("", [])
        for a, own in by_anchor.items():
            auto.add_word(a, own)
        auto.make_automaton()
        out.append((view, auto, terms, always))
    return out


def scan_row(names: tuple[str, ...], row: dict[str, str | None]) -> dict[int, list[str]]:
    """Rule number -> matched texts, in the order of terms, then places; rules that don't match are left out."""
    out: dict[int, list[str]] = {}
    for view, auto, terms, always in _engine(names):
        text = view.text(row)
        near = set(always)
        if len(auto):
            for _, own in auto.iter(text.casefold()):
                near.update(own)
        for k in sorted(near):
            rule, pattern = terms[k]
            if found := [m.group() for m in pattern.finditer(text)]:
                out.setdefault(rule, []).extend(found)
    return out


def scan(df: DataFrame, names: Sequence[str], name: str = "_terms", **columns: Column) -> DataFrame:
    """``df`` with a map of the rules of some families that match; ``columns``: title, location, description, explicit, department, as needed."""
    wanted, fields = tuple(names), list(columns)
    if missing := {c for n in wanted for c in FAMILIES[n][0].columns} - set(fields):
        raise ValueError(f"columns needed: {', '.join(sorted(missing))}")
    kind = pa.map_(pa.int32(), pa.list_(pa.string()))

    @F.arrow_udf("map<int,array<string>>")
    def found(*arrays: pa.Array) -> pa.Array:
        rows = zip(*(a.to_pylist() for a in arrays))
        return pa.array([list(scan_row(wanted, dict(zip(fields, r))).items()) for r in rows], kind)

    return df.withColumn(name, found(*[c.cast("string") for c in columns.values()]))


def sql_literal(value: str | int) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Found:
    """Expressions over a scan's map."""

    def __init__(self, name: str = "_terms") -> None:
        self.map = F.col(name)

    def _range(self, family: str) -> tuple[int, int]:
        return _FIRST[family], _FIRST[family] + len(FAMILIES[family][1])

    def numbers(self, family: str) -> Column:
        """Numbers of the family's rules that match, in the order of the rules."""
        low, high = self._range(family)
        return F.array_sort(F.filter(F.map_keys(self.map), lambda k: (k >= low) & (k < high)))

    def first(self, family: str) -> Column:
        low, high = self._range(family)
        return F.array_min(F.filter(F.map_keys(self.map), lambda k: (k >= low) & (k < high)))

    def any(self, family: str) -> Column:
        return self.first(family).isNotNull()

    def label(self, family: str, number: Column | None = None, at: int = 0) -> Column:
        """Entry ``at`` of a rule, by default of the first that matches; null if none does."""
        # As text: one expression to hand over instead of one per rule.
        values = F.expr("array(" + ", ".join(sql_literal(rule[at]) for rule in FAMILIES[family][1]) + ")")
        return F.get(values, (self.first(family) if number is None else number) - _FIRST[family])

    def texts(self, number: Column) -> Column:
        return F.coalesce(F.try_element_at(self.map, number), F.array().cast("array<string>"))

    def evidence(self, family: str) -> Column:
        """What the first rule that matches has matched."""
        return self.texts(self.first(family))

    def labels(self, family: str) -> Column:
        return F.transform(self.numbers(family), lambda k: self.label(family, k))
