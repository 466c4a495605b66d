"""Term rules: a small notation compiled to Java, RE2 (for SQL checks) and Python patterns.

Notation: a blank is white space, _ optional white space, - a hyphen or blank, = a hyphen, ~ an optional hyphen or blank, (x) an
optional part, {a|b} a choice; all else is itself. A term stands between word boundaries. With a prefix "!x!" the
characters before and after it must be neither word characters nor one of x.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

_PIECES = {" ": r"\s+", "_": r"\s*", "-": "[- ]", "=": "-", "~": "[- ]?", "(": "(?:", ")": ")?", "{": "(?:", "}": ")", "|": "|"}


def _body(term: str) -> str:
    return "".join(_PIECES.get(c, re.escape(c) if not c.isalnum() and c not in "'#/" else c) for c in term)


def _split(term: str) -> tuple[str | None, str]:
    m = re.fullmatch(r"!([^!]*)!(.*)", term)
    return (m[1], m[2]) if m else (None, term)


def java(term: str) -> str:
    edge, rest = _split(term)
    if edge is None:
        return rf"\b{_body(rest)}\b"
    chars = rf"[\w{re.escape(edge)}]" if edge else r"\w"
    return rf"(?<!{chars}){_body(rest)}(?!{chars})"


def java_any(terms: Sequence[str]) -> str:
    """One pattern for all terms; Unicode-aware and case-insensitive like Python's."""
    return "(?iU)" + "|".join(f"(?:{java(t)})" for t in terms)


def re2_any(terms: Sequence[str]) -> str:
    """The same for RE2, which has no look-around: boundaries take part in the match, so use it for presence only."""
    out = []
    for term in terms:
        edge, rest = _split(term)
        chars = r"\pL\pN_" + re.escape(edge or "")
        out.append(rf"(?:^|[^{chars}])(?:{_body(rest)})(?:$|[^{chars}])")
    return "|".join(out)


def re2_values(term: str) -> str:
    """One term for RE2 with what it matches as group 1."""
    edge, rest = _split(term)
    chars = r"\pL\pN_" + re.escape(edge or "")
    return rf"(?:^|[^{chars}])({_body(rest)})(?:$|[^{chars}])"


def python_any(terms: Sequence[str]) -> re.Pattern:
    return re.compile("|".join(f"(?:{java(t)})" for t in terms), re.IGNORECASE)


def anchor(term: str) -> str:
    """The longest part, in lower case, that every match of a term contains; empty if there is none.

    One automaton finds the anchors of all terms, which is many times cheaper than patterns that seldom match.
    """
    _, rest = _split(term)
    while (flat := re.sub(r"\([^(){}]*\)|\{[^(){}]*\}", "\0", rest)) != rest:
        rest = flat
    return max(re.split(r"[\0 _\-=~]", rest), key=len).lower()


def sql_has(expr: str, terms: Sequence[str]) -> str:
    pattern = re2_any(terms).replace("'", "''")
    return f"coalesce(regexp_matches({expr}, '{pattern}', 'i'), false)"


def sql_first(expr: str, rules: Sequence[tuple], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {sql_has(expr, terms)} THEN '{label}'" for label, *_, terms in rules) + f" ELSE {default} END"
