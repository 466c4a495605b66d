"""Joins, pairs, representatives, places, mixes and personal data against brute force and stated results."""

import itertools
import math
import random
import re
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.llm import golden, mix, nearjoin, pairs, personal, places

WORD = re.compile(r"[^\W_]+")


def shingles(text, k):
    w = WORD.findall(text.lower())
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, num, den):
    sets = {i: shingles(t or "", k) for i, t in rows if i is not None}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * max(len(sets[a]), len(sets[b]))}


def documents(seed, n, low, high, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(low, high))]
        rows.append((f"d{i:03}", " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "low", "high", "k", "num", "den"), [(1, 3, 12, 3, 3, 5), (2, 20, 60, 3, 3, 5), (3, 80, 160, 3, 3, 5), (4, 150, 400, 5, 4, 5)])
def test_near_duplicates_equal_brute_force(spark, seed, low, high, k, num, den):
    rows = documents(seed, 150, low, high, max(2, low // 12))
    rows += [("copy1", rows[0][1]), ("copy2", rows[0][1].upper()), ("none", None), ("blank", " "), (None, rows[0][1])]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "key string, text string, members string")
    members, links = nearjoin.near_duplicates(df, "key", ["text"], "text", 0, k, num, den)
    got = {(r.id_a, r.id_b) for r in nearjoin.record_pairs(members, links).collect()}
    assert got == brute(rows, k, num, den)
    counts = {r.id: r.n_links + r.n_copies - 1 for r in nearjoin.record_links(members, links).collect()}
    want = Counter(x for p in got for x in p)
    assert {i: n for i, n in counts.items() if n} == dict(want)


def test_near_duplicates_by_either_way(spark, monkeypatch):
    """Enumerating subsets and scanning inverted lists find the same pairs."""
    rows = documents(9, 120, 40, 90, 6)
    df = spark.createDataFrame(rows, "key string, text string")
    found = []
    for boundary in (0, 60, 1 << 30):
        monkeypatch.setattr(nearjoin, "_boundary", lambda *_, b=boundary: (b, 0))
        found.append({tuple(r) for r in nearjoin.record_pairs(*nearjoin.near_duplicates(df, "key", ["text"], "text", 0, 3, 3, 5)).collect()})
    assert found[0] == found[1] == found[2] == brute(rows, 3, 3, 5)


def test_words_are_counted_in_one_field_and_compared_in_others(spark):
    rows = [("a", "x y z w", "one two three"), ("b", "X, y; z w!", "one two three four"), ("c", "x y z w", "one"), ("d", None, "one two three"), ("e", "line\nend x y z w", None)]
    df = spark.createDataFrame(rows, "key string, t string, counted string")
    pairs_of = lambda columns, n: sorted(tuple(r) for r in nearjoin.record_pairs(*nearjoin.near_duplicates(df, "key", columns, "counted", n, 3, 3, 5)).collect())
    assert pairs_of(["t"], 3) == [("a", "b")] and pairs_of(["t"], 1) == [("a", "b"), ("a", "c"), ("b", "c")] and pairs_of(["t", "counted"], 3) == [("a", "b")]
    text, word = nearjoin.word_hashes(["Ab c", "", "c\nab-Ω1", "ω1"])
    assert text.tolist() == [0, 0, 2, 2, 2, 3] and word[0] == word[3] and word[1] == word[2] and word[4] == word[5] and len(set(word.tolist())) == 3


def test_near_duplicates_by_subsets_in_pieces(spark, monkeypatch):
    """Hot subsets are cut into pieces like hot members: no pair is lost between them."""
    rows = documents(11, 120, 15, 30, 4)
    df = spark.createDataFrame(rows, "key string, text string")
    monkeypatch.setattr(nearjoin, "_boundary", lambda *_: (1 << 30, 0))
    monkeypatch.setattr(nearjoin, "PIECE", 6)
    got = {tuple(r) for r in nearjoin.record_pairs(*nearjoin.near_duplicates(df, "key", ["text"], "text", 0, 3, 3, 5)).collect()}
    assert got == brute(rows, 3, 3, 5)


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "key string, text string")
    members, links = nearjoin.near_duplicates(df, "key", ["text"], "text")
    assert nearjoin.record_pairs(members, links).count() == 0 and nearjoin.record_links(members, links).count() == 0
    one = spark.createDataFrame([("a", "x y z " * 20), ("b", "x y z " * 20), ("b", "x y z " * 20)], "key string, text string")
    assert [tuple(r) for r in nearjoin.record_pairs(*nearjoin.near_duplicates(one, "key", ["text"], "text")).collect()] == [("a", "b")]


def threshold_sets(seed, n_pairs, size, share):
    """Pairs of sets right at 3 of 5 in common, the common members held by ``share`` of all sets, the other ones by few sets."""
    rng = np.random.default_rng(seed)
    common = size * 3 // 5
    often, seldom = (rng.integers(-(1 << 62), 1 << 62, k) for k in (round(common / share), n_pairs * (size - common) // 2))
    out = []
    for _ in range(n_pairs):
        both, rare = rng.choice(often, common, False), rng.choice(seldom, 2 * (size - common), False)
        out += [np.concatenate([both, rare[: size - common]]), np.concatenate([both, rare[size - common :]])]
    return [sorted(map(int, s)) for s in out]


@pytest.mark.parametrize(("size", "share"), [(100, 0.05), (150, 0.33), (250, 0.2)])
@pytest.mark.parametrize(("boundary", "piece"), [(None, None), (0, 20)])
def test_near_duplicates_at_the_threshold_of_frequent_members(spark, monkeypatch, size, share, boundary, piece):
    """No pair is lost whose common members are all frequent, in long lists cut into pieces either."""
    if piece:
        monkeypatch.setattr(nearjoin, "PIECE", piece)
    if boundary is not None:
        monkeypatch.setattr(nearjoin, "_boundary", lambda *_: (boundary, 0))
    sets = threshold_sets(size, 300, size, share)
    df = spark.createDataFrame([(k, -k, len(m), m) for k, m in enumerate(sets)], "h1 long, h2 long, n int, members array<long>")
    got = {(r.a1, r.b1) for r in nearjoin.class_pairs(df, 3, 5).collect()}
    held = [frozenset(m) for m in sets]
    assert got == {(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 5 * len(held[a] & held[b]) >= 3 * size}


@pytest.mark.parametrize(("counters", "others"), [(1 << 20, 0), (1 << 6, 0), (1 << 20, 3000)])
def test_near_duplicates_do_not_depend_on_the_number_of_sets(spark, monkeypatch, counters, others):
    """The same pairs come out of a small and a large collection, and if there are far more members than counters."""
    monkeypatch.setattr(nearjoin, "COUNTERS", counters)
    sets = threshold_sets(7, 300, 150, 0.33)
    rng = np.random.default_rng(8)
    often = sorted({m for s in sets[:20] for m in s})
    sets += [sorted(map(int, rng.choice(often, 60, False))) for _ in range(others)]
    df = spark.createDataFrame([(k, -k, len(m), m) for k, m in enumerate(sets)], "h1 long, h2 long, n int, members array<long>")
    got = {(r.a1, r.b1) for r in nearjoin.class_pairs(df, 3, 5).collect()}
    assert {(a, b) for a, b in got if b < 600} == {(2 * k, 2 * k + 1) for k in range(300)}


@pytest.mark.parametrize(("piece", "boundary", "large"), [(1 << 20, 0, 1 << 20), (40, 0, 1 << 20), (1 << 20, 105, 1 << 20), (1 << 20, 0, 50)])
def test_long_lists_are_met_as_products(monkeypatch, piece, boundary, large):
    """Lists of hundreds of sets give the pairs that looking at each pair gives, without doing so unless sets are too large."""
    rng = np.random.default_rng(5)
    often, sets = rng.integers(-(1 << 62), 1 << 62, 400), []
    for _ in range(500):
        size = int(rng.integers(90, 120))
        sets.append(np.sort(np.concatenate([rng.choice(often, 80, False), rng.integers(-(1 << 62), 1 << 62, size - 80)])))
        if rng.random() < 0.3:
            sets.append(np.sort(np.concatenate([rng.choice(sets[-1], size - 25, False), rng.choice(often, 10, False)])))
    sets = [np.unique(x) for x in sets]
    sizes, flat, ids = np.array([len(x) for x in sets]), np.concatenate(sets), np.arange(len(sets)) * 7919
    counters = np.bincount((flat >> 8) & (nearjoin.COUNTERS - 1), minlength=nearjoin.COUNTERS)
    packed = nearjoin._listed(ids, sizes, flat, counters, 0.6, piece, 3)
    monkeypatch.setattr(nearjoin, "LARGE", large)
    looked, able = [], nearjoin.Lists.able
    monkeypatch.setattr(nearjoin.Lists, "able", lambda self, x, y, b: looked.append(len(x)) or able(self, x, y, b))
    out = []
    for dense in (16, 1 << 30):
        looked.clear()
        monkeypatch.setattr(nearjoin, "DENSE", dense)
        order = packed.sort_by("bucket")
        out.append(({(a, b) for x in nearjoin._scan(iter([order]), boundary, 0.6) for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())}, sum(looked)))
    (found, few), (want, all_) = out
    assert found == want and (few < all_ / 2 if large > 50 else few == all_)
    held = {int(i): set(x.tolist()) for i, x in zip(ids, sets)}
    true = {(a, b) for a, b in itertools.combinations(held, 2) if len(held[a] & held[b]) >= 0.6 * max(len(held[a]), len(held[b])) and max(len(held[a]), len(held[b])) >= boundary}
    assert true and true <= found


def test_pairs_of_records_are_told_apart_only_where_an_id_is_in_several_classes(spark):
    """Pairs are not sorted out again unless they can come twice."""
    rows = [("a", "x y z w " * 9), ("b", "x y z w " * 9), ("c", "x y z w " * 9 + "v"), ("b", "x y z w " * 9)]
    df = spark.createDataFrame(rows, "key string, text string")
    once = nearjoin.record_pairs(*nearjoin.near_duplicates(df, "key", ["text"], "text", 0, 3, 3, 5))
    more = nearjoin.record_pairs(*nearjoin.near_duplicates(df.unionByName(spark.createDataFrame([("a", rows[2][1])], df.schema)), "key", ["text"], "text", 0, 3, 3, 5))
    for pairs, distinct in ((once, False), (more, True)):
        assert sorted(tuple(r) for r in pairs.collect()) == [("a", "b"), ("a", "c"), ("b", "c")]
        top = pairs._jdf.queryExecution().optimizedPlan().nodeName()
        assert (top == "Aggregate") == distinct


@pytest.mark.parametrize("piece", [4096, 3])
def test_item_pairs_equal_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(pairs, "RUN", 50)
    monkeypatch.setattr(pairs, "PIECE", piece)
    rng = random.Random(2)
    rows = [(f"b{rng.randint(0, 80) if rng.random() < 0.7 else 0}", rng.choice(["A", "a ", "B", "c", "d", "e", "F", "\tg", None, "", "  "])) for _ in range(900)] + [(None, "a"), ("solo", "zz")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "basket string, item string, n int").withColumnRenamed("basket", "key").withColumnRenamed("n", "basket")
    sets = {}
    for b, i in rows:
        if b is not None and i and i.strip():
            sets.setdefault(b, set()).add(i.strip().lower())
    both, single = Counter(), Counter(x for s in sets.values() for x in s)
    for s in sets.values():
        both.update(itertools.combinations(sorted(s), 2))
    got = {(r.item_a, r.item_b): r for r in pairs.item_pairs(df, "key", "item").collect()}
    assert {k: r.n_both for k, r in got.items()} == dict(both)
    for (a, b), r in got.items():
        n11, n10, n01, n = r.n_both, single[a] - r.n_both, single[b] - r.n_both, len(sets)
        assert (r.n_a, r.n_b, r.n_baskets) == (single[a], single[b], n) and r.lift == pytest.approx(n11 * n / (single[a] * single[b]))
        assert r.log_odds == pytest.approx(math.log((n11 + 0.5) * (n - n11 - n10 - n01 + 0.5) / ((n10 + 0.5) * (n01 + 0.5))))
    assert pairs.item_pairs(df.limit(0), "key", "item").count() == 0


T = lambda d: datetime(2026, 7, d)
GOLD = "row_id bigint, key string, seen timestamp, support bigint, text string, level string, city string, currency string"


def gold(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], GOLD)
    return {r.group_key: r for r in golden.representatives(df, "key", "row_id", "seen", "support", "text", ["level", "city"], learned="level").collect()}


def test_representatives(spark):
    rows = [
        (1, "A:1", T(1), 5, " long text ", "junior", None), (2, "a: 1", T(3), 5, "long text", "senior", " "), (3, "A:1 ", T(3), 5, "long text", "senior", "Durban"),
        (4, "b", T(1), 9, "x", None, "p"), (5, "B", T(2), 1, "xx", None, None), (6, "c", None, None, None, None, None), (7, "C", None, None, "", "x", None),
        (8, None, T(1), 1, "t", None, None), (9, " ", T(1), 1, "t", None, None), (10, "d", T(1), 1, "y" * 100_000, None, None),
    ]
    out = gold(spark, rows)
    assert set(out) == {"a:1", "b", "c", "d"}
    assert out["a:1"].best_id == 2 and out["a:1"].n_records == 3 and out["a:1"].city == "Durban" and out["a:1"].level == "senior"
    assert out["b"].best_id is None and out["b"].seen == T(2) and out["b"].support == 9 and out["b"].text == "xx"
    assert out["c"].best_id == 6 and out["d"].best_id == 10
    assert gold(spark, []) == {}


def test_currency_of_rows_without_time(spark):
    history = [(10 * g + k, f"g{g}", T(1 + k), 1, "t", level, None) for g in range(5) for k, level in enumerate(["junior", "senior"])]
    out = gold(spark, history + [(90, "new", None, 1, "t", "senior", "late"), (91, "new", None, 9, "t", "junior", "early")])
    assert out["new"].level == "senior" and out["new"].city == "late"


def test_levels():
    assert golden.levels([("a", "b"), ("b", "c"), ("a", "c"), ("x", "c")]) == {"a": 0, "x": 0, "b": 1, "c": 2}
    cycle = golden.levels([("a", "b"), ("b", "c"), ("c", "a"), ("z", "a"), ("c", "d"), ("e", "f"), ("f", "e")])
    assert cycle == {"z": 0, "a": 1, "b": 1, "c": 1, "d": 2, "e": 0, "f": 0}
    assert golden.levels([(f"{k:05}", f"{k + 1:05}") for k in range(5000)])["05000"] == 5000 and golden.levels([]) == {}


def test_currency_is_an_order_among_the_values_of_a_group(spark):
    """junior went to mid ten times, mid to senior once; the field's own order counts before the learned one's."""
    steps = [("junior", "mid", "Paarl", "Durban")] * 10 + [("mid", "senior", None, None)] + [("p", "q", None, None), ("q", "r", None, None), ("r", "p", None, None)] * 2
    history = [row for g, (a, b, c, d) in enumerate(steps) for row in [(2 * g, f"h{g}", T(1), 1, "t", a, c), (2 * g + 1, f"h{g}", T(2), 1, "t", b, d)]]
    rows = [(90, "new", None, 9, "t", "mid", "Durban"), (91, "new", None, 1, "t", "senior", "Paarl"), (92, "turn", None, 3, "t", "q", None), (93, "turn", None, 5, "t", "p", None), (94, "turn", None, 4, "t", "r", None), (95, "same", T(4), 9, "t", "junior", "x"), (96, "same", T(4), 1, "t", "mid", "y")]
    out = gold(spark, history + rows)
    assert out["new"].level == "senior" and out["new"].city == "Durban"
    assert out["turn"].level == "p" and out["same"].level == "mid" and out["same"].city == "y"


PLACES = [(1, "province", "North Cape", "North Cape", "Land", ["NC"]), (2, "city", "Klipdrift", "North Cape", "Land", []), (3, "city", "Klipdrift", "South Cape", "Land", None), (4, "province", "South Cape", "South Cape", "Land", ["SC"]), (5, "country", "Land", None, "Land", ["LD", " "]), (6, "city", "Môrelig Bay", "South Cape", "Land", ["MLB"]), (7, "city", None, None, "Land", None)]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Klipdrift", 2), ("Klipdrift, South Cape", 3), ("klipdrfit (SC)", 3), ("M O R E L I G bay 7299", 6), ("<b>Morelig-Bay</b>", 6), ("Morelg Bay or Klipdrift", 6), ("MLB", 6), ("mlbb", -1),
        ("Anywhere in NORTH CAPE", 1), ("Nrth Cpae", 1), ("Land", 5), ("Remote", -1), ("see " * 3000, -1), ("N.C.", 1),
    ],
)
def test_places(value, want):
    reference = places.Reference([(p[0], p[1], p[3], p[4], p[2], p[5]) for p in PLACES])
    assert reference.lookup(value, ("city", "province", "country")) == want
    if want in (2, 3, 6):
        assert reference.lookup(value, ("province",)) in (-1, 4)


def test_automaton_is_edit_distance():
    def distance(a, b):  # edits with swaps of neighbours, no edit inside a swap
        d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
        for i in range(len(a)):
            for j in range(len(b)):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
                if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    rng = random.Random(1)
    for _ in range(1500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(2))
        for k in (0, 1, 2):
            auto = places.Automaton(a, k)
            states = auto.start
            for c in b:
                states = auto.step(states, c)
            assert auto.distance(states) == (distance(a, b) if distance(a, b) <= k else None), (a, b, k)


def test_map_values(spark):
    df = spark.createDataFrame([(1, "Klipdrift"), (2, None), (3, " - 7"), (4, "nowhere"), (4, "nowhere")], "k int, v string").withColumn("place_id", F.lit("clash"))
    listed = spark.createDataFrame([(p[0], p[1], p[2], p[3], p[4], p[5]) for p in PLACES], "place_id int, kind string, name string, province string, country string, aliases array<string>")
    assert sorted((r.k, r.place_id) for r in places.map_values(df, "v", ["k"], listed).collect()) == [(1, 2), (4, -1), (4, -1)]
    assert {r.place_id for r in places.map_values(df, "v", ["k"], listed.limit(0)).collect()} == {-1}
    assert places.map_values(df.limit(0), "v", ["k"], listed).count() == 0


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 400, 3000).astype(float)
    pi = np.full(3000, 0.37)
    out = mix.flight(pi, size, rng)
    left = (out > 0) & (out < 1)
    assert left.sum() <= 2 and abs(out.sum() - pi.sum()) < 1e-4 and abs(out @ size - pi @ size) < 1e-2
    assert np.mean([mix.flight(np.full(9, 0.5), np.ones(9), np.random.default_rng(s))[0] for s in range(400)]) == pytest.approx(0.5, abs=0.08)


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mix, "BLOCK", 64)
    rng = random.Random(4)
    rows = [(i, "big", rng.randint(1, 60)) for i in range(3000)] + [(5000 + i, "small", rng.randint(1, 60)) for i in range(200)] + [(7000, None, 9), (7001, "other", 9), (7002, "big", 0), (7003, "small", None)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id bigint, source string, n_tokens bigint, copies int")
    weights = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("empty", 0.1, 2), (None, 0.3, 1)], "source string, target_share double, max_repeats int")
    got = mix.mix_sources(df, weights, "doc_id", "source").cache()
    shares = {r.source: r for r in mix.mix_shares(got, weights, "source").collect()}
    assert shares["big"].actual_share == pytest.approx(5 / 9, abs=0.01) and shares["small"].actual_share == pytest.approx(4 / 9, abs=0.01)
    assert shares["small"].most_copies <= 3 and shares["big"].most_copies == 1 and shares["empty"].docs == 0 and len(shares) == 3
    assert got.groupBy("doc_id").count().where("count > 1").count() == 0
    fixed = {r.source: r.tokens for r in mix.mix_shares(mix.mix_sources(df, weights, "doc_id", "source", total_tokens=9000), weights, "source").collect()}
    assert fixed["big"] == pytest.approx(5000, rel=0.03) and fixed["small"] == pytest.approx(4000, rel=0.03)
    assert mix.mix_sources(df.limit(0), weights, "doc_id", "source").count() == 0 and mix.mix_sources(df, weights.limit(0), "doc_id", "source").count() == 0


GIVEN = ["Amarella", "Borvane", "Cestine", "Dulvina"]
FAMILY = ["Okterwald", "Prinsburn", "Vantessel", "Zubekira", "Molhagen"]


def letters(seed, n, given):
    """Texts with their true findings, from patterns of our own."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        g, f = rng.choice(given), rng.choice(FAMILY)
        name = rng.choice([f"{g} {f}", f"{g[0]}. {f}", f"{f.upper()}, {g}", f"{g} van {f}"])
        phone = rng.choice(["055 123 4567", "+27 (0)59 381-5379", "(415) 555-0174", "0551234567"])
        mail, where = rng.choice(["a.b@mail.site.example", "hr(at)site(dot)example"]), rng.choice(["12b Oak Road", "Unit 4, 77 Elm St.", "Akkerlaan 31"])
        number = rng.choice(["390923 5100 18 6", "3109235100186", "A00123573"])
        parts = [("Please contact Ms ", ""), (name, "name"), (" about the work, or call ", ""), (phone, "phone"), (". We build Kafka pipelines in Python. Write to ", ""), (mail, "email"), (" today. The office is at ", ""), (where, "address"), (". Ticket 8128319 is open. The file of ", ""), (name, "name"), (", ID number ", ""), (number, "id_number"), (", was closed.", "")]
        text, found = "", []
        for p, kind in parts:
            if kind:
                found.append((kind, len(text)))
            text += p
        out.append((text, found))
    return out


def test_personal_information_on_held_out_texts():
    model = personal.train_model([t for t, _ in letters(1, 300, GIVEN)], GIVEN[:3])
    hit = want = got = 0
    for text, truth in letters(2, 150, [*GIVEN, "Evarild"]):
        found = {(k, a) for k, a, _ in personal.find(model, text)}
        hit, want, got = hit + len(found & set(truth)), want + len(truth), got + len(found)
    assert hit / want > 0.95 and hit / got > 0.95


def enumerated(factors, steps, ties, agree):
    """Label probabilities of each token by summing over all labellings: one chain, ties between places."""
    n, k = factors.shape
    classes = [0, 1, 1] + [2] * (k - 3)
    out, pairs = np.zeros((n, k)), np.zeros((k, k))
    for y in itertools.product(range(k), repeat=n):
        p = math.prod(factors[i, v] for i, v in enumerate(y)) * math.prod(steps[v, u] for v, u in itertools.pairwise(y)) * (y[0] == 0 or y[0] % 2 == 1)
        p *= math.prod(agree[classes[y[i]], classes[y[j]]] for i, j in ties)
        for i, v in enumerate(y):
            out[i, v] += p
        for v, u in itertools.pairwise(y):
            pairs[v, u] += p
    z = out[0].sum()
    return out / z, pairs / z


def test_chains_equal_enumeration():
    rng = np.random.default_rng(1)
    factors = rng.uniform(0.1, 1, (9, personal.LABELS))
    steps = personal.step_factors(rng.normal(size=(personal.LABELS, personal.LABELS)))
    begin, length = np.array([0, 4, 5]), np.array([4, 1, 4])
    got, pairs = personal.Chains(begin, length).beliefs(factors, steps, True)
    want = [enumerated(factors[a : a + n], steps, [], None) for a, n in zip(begin, length)]
    assert np.allclose(got, np.concatenate([w for w, _ in want])) and np.allclose(pairs, sum(p for _, p in want))


def test_ties_equal_enumeration():
    """Where chains and ties have no loop, message passing is exact: two sentences, one tie, as one chain with free steps between."""
    rng = np.random.default_rng(2)
    model = personal.Model([])
    model.steps = rng.normal(size=model.steps.shape)
    model.tie = 1.3
    t = personal.read(["ask Xandra\nXandra’s"])
    assert t.words == ["ask", "Xandra", "Xandra’s"] and t.first.tolist() == [True, False, True]
    factors = rng.uniform(0.1, 1, (3, personal.LABELS))
    got = personal.propagate(model, t, factors)
    steps, agree = personal.step_factors(model.steps), personal.tie_factors(1.3)
    classes = np.array([0, 1, 1] + [2] * (personal.LABELS - 3))
    start = np.arange(personal.LABELS)
    start = (start == 0) | (start % 2 == 1)
    joint = (factors[0] * start)[:, None, None] * steps[:, :, None] * factors[1][None, :, None] * agree[classes][:, classes][None] * (factors[2] * start)[None, None]
    want = np.stack([joint.sum(axis=(1, 2)), joint.sum(axis=(0, 2)), joint.sum(axis=(0, 1))])
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-3)


def test_ties_reach_all_occurrences_and_similar_forms():
    """One marked name, then bare ones that nothing but the ties says anything of; the marked one first, last or amid."""
    for forms in (["Xandra"] * 10, ["Xandra", "Xandra's", "XANDRA", "Xan-dra", "Xandrá’s"] * 2):
        for marked in (0, 4, 9):
            model = personal.Model([])
            t = personal.read(["\n".join(forms)])
            assert len(t.start) == 10 and t.first.all()
            scores = np.full((10, personal.LABELS), -30.0)
            scores[:, :2] = 0.0
            scores[marked, 1] = 8.0
            model.tie = 1.0
            assert propagated(model, t, scores) == [1] * 10
            model.tie = 0.0
            assert sum(propagated(model, t, scores)) == 1


def propagated(model, t, scores):
    return personal.propagate(model, t, personal.factors_of(scores)).argmax(axis=1).tolist()


def bare(seed, n):
    """Texts with a name of no list that a title marks once, and that stands bare where other capitalised words stand as well."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        who, tool = (rng.choice("BCDFGKLMNPRSTVWZ") + "".join(rng.choice("aeiou") + rng.choice("bdgklmnprstvz") for _ in range(3)) for _ in range(2))
        parts = [("Please ask Ms ", 0), (who, 1), (f" about {tool} first.\nThe work with ", 0), (who, 1), (" starts soon.\nThe work with ", 0), (tool, 0), (" starts soon.", 0)]
        text, found = "", []
        for p, is_name in parts:
            if is_name:
                found.append(("name", len(text)))
            text += p
        out.append((text, found))
    return out


def test_without_ties_findings_are_lost():
    model = personal.train_model([t for t, _ in bare(1, 400)] + [t for t, _ in letters(1, 100, GIVEN)], GIVEN)

    def hits():
        return sum({(k, a) for k, a, _ in f} == set(truth) for (_, truth), f in zip(tests, personal.find_all(model, [t for t, _ in tests])))

    tests = bare(2, 200)
    assert model.tie > 1
    with_ties, model.tie = hits(), 0.0
    assert with_ties > 150 and hits() < 0.7 * with_ties


def test_the_field_overrules_a_shape():
    """A number with the shape of an identity number is none where the words before it are those of other numbers."""
    rng = random.Random(6)
    codes = [f"Campaign code {rng.randint(10**12, 10**13 - 1)} applies to this advert." for _ in range(60)]
    texts = [t for t, _ in letters(1, 300, GIVEN)]
    model = personal.train_model([x for pair in zip(texts, codes * 5) for x in pair], GIVEN)
    shaped = "Campaign code 3109235100186 applies to this advert."
    t = personal.read([shaped])
    assert personal.lookalikes(t) == [(14, 27, personal.KINDS.index("id_number"))]
    assert personal.find(model, shaped) == []
    assert [k for k, _, _ in personal.find(model, "The file of Ms Amarella Prinsburn, ID number 3109235100186, was closed.")] == ["name", "id_number"]


def test_shapes_have_no_bounds():
    def shapes(text):
        return [(a, b, personal.KINDS[k]) for a, b, k in personal.lookalikes(personal.read([text]))]

    long = "a" * 5000
    assert shapes(f"x {long}@mail.example y") == [(2, 5015, "email")]
    names = "Old " * 9
    assert shapes(f"at 15 {names}Mill Road.") == [(3, 3 + 3 + len(names) + 10, "address")]
    assert shapes("15 Jan van der Merwe Street") == [(0, 27, "address")]
    assert shapes("456 Marula Road Map items") == [] and shapes("fuzzy at dot") == [] and shapes("") == []
    assert [k for *_, k in shapes("jan at site dot co dot example, hr [at] a.example, jo @ b.example")] == ["email"] * 3


def test_redaction(spark):
    model = personal.train_model([t for t, _ in letters(1, 200, GIVEN)], GIVEN)
    text = letters(3, 1, GIVEN)[0][0]
    rows = [(1, text), (2, None), (3, ""), (4, "plain words only"), (4, "plain words only"), (5, "a.b." * 40_000), (6, "9" * 60_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "k int, text string, found string")
    out = {r.k: r for r in personal.find_in(df, ["k"], "text", model).collect()}
    assert out[1].redacted.count("[NAME]") == 2 and "[PHONE]" in out[1].redacted and "[EMAIL]" in out[1].redacted and "[ADDRESS]" in out[1].redacted and "[ID_NUMBER]" in out[1].redacted
    assert out[1].redacted.startswith("Please contact Ms [NAME] about the work")
    assert out[2].redacted is None and out[3].redacted == "" and out[4].redacted == "plain words only" and out[2].found == []
    assert personal.find_in(df.limit(0), ["k"], "text", model).count() == 0
    assert personal.find(personal.train_model([], []), "Mail x@y.example") is not None
