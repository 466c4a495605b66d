"""Tokenizer against merging itself and the public library; splitting as an exact round trip."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vacantia.llm import chunks, tokens

if not os.path.exists(tokens.DEFAULT_RANKS):
    pytest.skip("no vocabulary here", allow_module_level=True)
ENC = tokens.Encoder(tokens.read_ranks())
RANK = {e: i for i, e in enumerate(ENC.entries)}
ODD = st.text(alphabet=st.sampled_from("aabcdehnotT  .\n\t1'é漢 ‍😀"), max_size=60)


def merged(piece: bytes) -> list[int]:
    """Byte pairs merged one at a time, least rank first: what the encoder must equal."""
    parts = [bytes([b]) for b in piece]
    while True:
        ranks = [(RANK[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANK]
        if not ranks:
            return [RANK[p] for p in parts]
        k = min(ranks)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_equals_merging(text):
    assert ENC.encode(text) == [i for p in ENC.pieces.findall(text) for i in merged(p.encode())]
    assert ENC.decode(ENC.encode(text)) == text and ENC.count(text) == len(ENC.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_equals_the_library(text):
    tiktoken = pytest.importorskip("tiktoken")
    own = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=RANK, special_tokens={})
    assert ENC.encode(text) == own.encode_ordinary(text)


def test_long_pieces_take_linear_time():
    assert ENC.decode(ENC.encode("a" * 200_000)) == "a" * 200_000
    assert ENC.encode("ab" * 300) == merged(b"ab" * 300)


def test_tables(spark):
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, " \n"), (4, " \n"), (5, "x" * 50_000)]
    df = spark.createDataFrame([(i, t, [0], 7) for i, t in rows], "doc_id bigint, text string, ids array<int>, n_tokens int")
    out = tokens.encode_table(df, "doc_id", "text")
    assert out.count() == 6 and {r.doc_id: r.ids for r in out.collect()}[1] == ENC.encode("Hello world")
    assert {r.doc_id: len(r.ids) for r in out.collect()} | {2: 0, 3: 0} == {r.doc_id: r.n_tokens for r in tokens.count_table(df, "text", keep=["doc_id"]).collect()}
    assert {r.doc_id: r.text for r in tokens.decode_table(out, "doc_id").collect()} == {i: t or "" for i, t in rows}
    assert tokens.encode_table(df.limit(0), "doc_id", "text").collect() == []


def check(text, limit, overlap):
    pieces = chunks.split_text(ENC, text, limit, overlap)
    assert "".join(text[c:e] for _, c, e, _ in pieces) == text
    for k, (start, core, end, n) in enumerate(pieces):
        assert start <= core < end and n == ENC.count(text[start:end])
        assert ENC.count(text[start:core]) <= overlap + 1 and (k or start == core)
    return pieces


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["# H\n", "## S\n\n", "word ", "Long sentence here. ", "- item\n", "  - sub\n", "<ul><li>b<ul><li>c</li>", "</ul>", "<div>", "</div>", "<p>para</p>\n", "<h2>t</h2>", "\n\n", "x" * 40, "漢字" * 9, "a, b; c "]), max_size=60), st.integers(16, 60))
def test_split_round_trip(parts, limit):
    text = "".join(parts)
    pieces = check(text, limit, limit // 4) if text else chunks.split_text(ENC, text, limit, limit // 4)
    assert all(n <= limit + 1 for *_, n in pieces)  # one token more only by white space at a cut, which split_table mends


def test_split_prefers_high_boundaries():
    text = "# One\n\n" + "Some words stand here. " * 8 + "\n\n# Two\n\n" + "Other words stand there. " * 8
    pieces = check(text, 80, 0)
    assert [text[c : c + 5] for _, c, _, _ in pieces] == ["# One", "# Two"]


def test_split_without_boundaries():
    assert len(check("z" * 20_000, 64, 8)) > 100 and chunks.split_text(ENC, None, 64, 8) == [] and len(check("short", 64, 8)) == 1
    with pytest.raises(ValueError):
        chunks.split_text(ENC, "x", 64, 40)


def test_split_table(spark):
    rows = [(1, "word " * 400), (2, "small"), (3, None), (4, ""), (5, " \n \n" * 400), (5, " \n \n" * 400)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, piece string")
    out = chunks.split_table(df, "doc_id", "text", 64, 8).orderBy("doc_id", "piece_no").collect()
    assert {r.doc_id for r in out} >= {1} and max(r.n_tokens for r in out) <= 64
    assert "".join(r.piece[r.core_start - r.char_start :] for r in out if r.doc_id == 1) == "word " * 400
    assert {r.doc_id for r in chunks.split_table(df, "doc_id", "text", 64, 8, oversized_only=False).collect()} == {1, 2, 5}
    assert chunks.split_table(df.limit(0), "doc_id", "text").count() == 0


def test_nested_markup_comes_apart_from_outside():
    """Items of an outer list are kept whole with their inner lists; deep nesting has no end."""
    inner = "<ul>" + "".join(f"<li>inner item {k} here</li>" for k in range(6)) + "</ul>"
    text = "<ul>" + "".join(f"<li>outer item {k} {inner}</li>" for k in range(6)) + "</ul>"
    pieces = check(text, 96, 8)
    assert len(pieces) == 6 and all(f"outer item {k} <ul>" in text[c:e] and text[c:e].count("inner") == 6 for k, (_, c, e, _) in enumerate(pieces))
    plain = "".join(f"- outer item {k} of the list\n" + "".join(f"    - inner item {i} of it\n" for i in range(6)) for k in range(6))
    assert all("outer" in plain[c : c + 12] for _, c, _, _ in check(plain, 96, 8))
    assert len(check("<div>" * 5000 + "x", 64, 8)) > 10
