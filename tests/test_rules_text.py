"""Rule notation in three dialects, and text expressions against plain Python."""

import hashlib
import html.parser  # noqa: F401
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from vacantia.functions import rule_tables as R
from vacantia.functions import text as X
from vacantia.functions.html import detail_fields, page_links, posting_json, visible_text
from vacantia.functions.rules import anchor, java, python_any, re2_any
from vacantia.functions.terms import FAMILIES, Found, scan, scan_row

ALL_TERMS = [t for _, _, ts in R.SKILLS for t in ts] + [t for *_, ts in R.TECH_TITLE + R.EARLY_TITLE + R.DESCRIPTION_LEVEL + R.CITIES for t in ts]
WORDS = ["java", "javascript", "Java Script", "C", "C#", "c ++", "C+", ".NET", "asp.net", "ASPnet", "dbt", "x.python", "Python,", "go", "golang", "React.js", "reactjs", "vue", "entry-level", "entry level", "entry_level", "0-2 years", "0 – 1 year", "front-end", "frontend", "front end", "intern", "internship", "internal", "R", "using r", "Port  Elizabeth", "CPT", "capetown", "node.js", "CI / CD", "k8s", "no prior experience required", "bi analyst"]


def test_dialects_agree_on_presence():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 5))) for _ in range(400)]
    groups = [[t] for t in ALL_TERMS[::4]] + [["!.!java"], ["!!c_#"], ["!+#!c"], ["!!.net"], R.SENIOR_TITLE]
    con = duckdb.connect()
    con.execute("create table x(id int, t varchar)")
    con.executemany("insert into x values (?, ?)", list(enumerate(texts)))
    for g in groups:
        want = [bool(python_any(g).search(t)) for t in texts]
        pattern = re2_any(g).replace("'", "''")
        assert [r[0] for r in con.execute(f"select regexp_matches(t, '{pattern}', 'i') from x order by id").fetchall()] == want, g


def test_scan_equals_every_pattern_on_its_own(spark):
    """The automaton lets no match through: the same as all patterns tried one by one on the whole text."""
    rng = random.Random(8)
    words = [*WORDS, "Senior", "intern", "Cape Town", "south africa-based", "remote in", "hybrid", "İ", "ﬁ", "0 - 2 years of experience", "\u00a0", "QA", "no experience required", None]
    names = tuple(FAMILIES)
    fields = ("title", "location", "description", "explicit", "department")
    rows = [{f: " ".join(w for w in rng.choices(words, k=rng.randint(0, 8)) if w) or None for f in fields} for _ in range(300)]
    for row in rows:
        want = {}
        for n in names:
            view, rules = FAMILIES[n]
            for k, rule in enumerate(rules):
                hits = [m.group() for term in rule[-1] for m in re.compile(java(term), re.I).finditer(view.text(row))]
                if hits:
                    want[n, k] = hits
        got = scan_row(names, row)
        assert list(got.values()) and len(got) == len(want) or not want and not got
        assert sorted(got.values()) == sorted(want.values())
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{f} string" for f in fields))
    out = scan(df, names, **{f: F.col(f) for f in fields}).select("_terms").collect()
    assert [r[0] for r in out] == [scan_row(names, r) for r in rows]


def test_anchor_is_in_every_match():
    for term in ALL_TERMS:
        for w in WORDS:
            if m := python_any([term]).search(w):
                assert anchor(term) in m.group().lower()


def test_matches_keep_order_and_case(spark):
    df = spark.createDataFrame([("Node.js and NODEJS, React", None), (None, None)], "title string, description string")
    f = Found()
    rows = scan(df, ("skill",), title=F.col("title"), description=F.col("description")).select(f.labels("skill").alias("s"), f.evidence("skill").alias("e"), f.any("skill").alias("a")).collect()
    assert rows[0].s == ["Node.js", "React"] and rows[0].e == ["Node.js", "NODEJS"] and rows[0].a and rows[1].s == [] and rows[1].e == [] and not rows[1].a
    assert java("!+#!c") == r"(?<![\w\+\#])c(?![\w\+\#])"
    with pytest.raises(ValueError, match="description"):
        scan(df, ("skill",), title=F.col("title"))


def test_text_expressions(spark):
    rows = [("  A \t b c\n", "Senior C++ / C# Dev!"), (None, None), ("", "é")]
    out = spark.createDataFrame(rows, "a string, b string").select(X.normalize_whitespace(F.col("a")).alias("w"), X.normalized_key(F.col("b")).alias("k"), X.job_text_sha256(F.col("b"), F.col("a")).alias("h"), X.label(F.col("a")).alias("l")).collect()
    assert [r.w for r in out] == ["A b c", "", ""]
    assert [r.k for r in out] == ["senior c++ c# dev", "", ""]
    assert out[1].h == hashlib.sha256(b"").hexdigest() and out[0].h == hashlib.sha256("Senior C++ / C# Dev!\n  A \t b c".encode()).hexdigest()
    assert [r.l for r in out] == ["A \t b c", "unspecified", "unspecified"]


def test_unique_values(spark):
    row = spark.createDataFrame([(["B", "a", "b", "A", " ", "c"], None)], "x array<string>, y array<string>").select(X.unique_ci(F.col("x")).alias("u"), X.strings(F.col("x")).alias("s"), X.strings(F.col("y")).alias("n")).first()
    assert row.u == ["B", "a", " ", "c"] and row.s == ["a", "B", "c"] and row.n == []


def test_stable_key_branches(spark):
    rows = [("7", "u", "d"), (None, "https://x/1", "d"), (" ", "", "text")]
    df = spark.createDataFrame(rows, "i string, u string, d string").select(X.stable_key(F.lit("p"), F.lit("t"), F.col("i"), F.col("u"), F.lit("N"), F.lit("T"), F.lit("L"), F.col("d")).alias("k"))
    keys = [r.k for r in df.collect()]
    assert keys[0] == "p:t:7" and keys[1] == "p:t:url-" + hashlib.sha256(b"https://x/1").hexdigest()[:24]
    assert keys[2] == "p:t:content-" + hashlib.sha256(b"N|t|l|text").hexdigest()[:24]


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("&lt;p&gt;Hi &amp;amp; bye&lt;/p&gt;<script>x<b></script><style>y</style>", "Hi & bye"),
        ("<b>a</b>b", "a b"),
        ("<ul><li>one</li><li>two</li></ul>", "one two"),
        (None, ""),
        ("", ""),
    ],
)
def test_visible_text(markup, text):
    assert visible_text(markup) == text


def test_html_fields():
    page = "<h1>Dev</h1><div class='jobGeoLocation'>Location: Durban</div><p>Date: 3 Aug 2026</p><div class='jobdescription'>Do <script>x</script>it<form>apply</form></div>"
    assert detail_fields(page) == ("Dev", "Durban", "3 Aug 2026", "Do it")
    assert detail_fields(None) == ("", "", "", "")
    assert page_links("<a href='/job/1?x'>A</a><a href='/job/1#y'>B</a><a href='/z'>C</a>", "/job/") == [("/job/1", "A")]
    assert posting_json("<script type='application/ld+json'>[{\"@type\":\"JobPosting\",\"title\":\"T\"}]</script>")["title"] == "T"
    assert posting_json("<script type='application/ld+json'>broken</script>") is None


def test_dates(spark):
    rows = ["2026-07-22T08:00:00Z", "2026-07-22T08:00:00+02:00", "2026-07-22", "2026", "T12", "22 Jul 2026", "22 July 2026", "2026-02-30", None]
    out = spark.createDataFrame([(r,) for r in rows], "x string").select(F.unix_micros(X.iso_instant(F.col("x"))).alias("i"), F.unix_micros(X.source_date(F.col("x"))).alias("s")).collect()
    assert [r.i is not None for r in out] == [True, True, True, False, False, False, False, False, False]
    assert out[0].i - out[1].i == 7200 * 10**6 and out[5].s == out[6].s == out[2].i
