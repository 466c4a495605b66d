"""Combining sources to target shares of the total size, by balanced sampling with the cube method."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.tokens import DEFAULT_RANKS, count_table
from vacantia.session import cut

#: Documents that one flight handles at once.
BLOCK = 4096
#: A document with at least this part of its source's tokens is drawn first, so that the others can make up for it.
GIANT = 1 / 1000
_EPS = 1e-9


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase of the cube method with two balancing totals: number of documents and tokens.

    Three undecided documents at a time have a direction that keeps both totals: (t3-t2, t1-t3, t2-t1). Their
    probabilities move along it, one way or the other at random so that expectations stay, until one is 0 or 1. At most
    two documents stay undecided.
    """
    pi = pi.astype(float).copy()
    open_ = [k for k in range(len(pi)) if _EPS < pi[k] < 1 - _EPS]
    coins = rng.random(len(open_) + 1)
    held: list[int] = []
    for step, k in enumerate(open_):
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if not any(u):
            u = (1.0, -1.0, 0.0)  # equal sizes: two of them trade places
        up = min((1 - pi[i]) / d if d > 0 else -pi[i] / d for i, d in zip(held, u) if d)
        down = min(pi[i] / d if d > 0 else (pi[i] - 1) / d for i, d in zip(held, u) if d)
        move = up if coins[step] < down / (up + down) else -down
        for i, d in zip(held, u):
            pi[i] += move * d
        held = [i for i in held if _EPS < pi[i] < 1 - _EPS]
    return np.where(pi < _EPS, 0.0, np.where(pi > 1 - _EPS, 1.0, pi))


def _landing(pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The few documents left undecided are drawn by their probabilities, in one systematic draw."""
    ends = np.floor(np.concatenate([[0.0], np.cumsum(pi)]) + rng.random())
    return np.diff(ends)


def mix_plan(sizes: DataFrame, weights: DataFrame, source: str, total_tokens: int | None = None) -> list[dict]:
    """Per listed source: its tokens, documents and the expected copies of each of its documents.

    One row per listed source comes to the driver; the list of weights doesn't grow with the data. Without
    ``total_tokens`` the total is the largest at which every listed source that has tokens meets its share within
    max_repeats. With it, a source that can't reach its share stands at max_repeats.
    """
    totals = sizes.groupBy(source).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    listed = weights.select(F.col("source").alias("_s"), "target_share", "max_repeats").where("_s is not null and target_share > 0 and max_repeats > 0").dropDuplicates(["_s"])
    rows = [r.asDict() for r in listed.join(totals, F.col("_s") == F.col(source), "left").select("_s", "target_share", "max_repeats", "tokens", "docs").collect()]
    have = [r for r in rows if r["tokens"]]
    whole = sum(r["target_share"] for r in have)
    if not have:
        return []
    largest = min(r["max_repeats"] * r["tokens"] * whole / r["target_share"] for r in have)
    total = largest if total_tokens is None else float(total_tokens)
    for r in have:
        r["copies"] = min(float(r["max_repeats"]), total * r["target_share"] / whole / r["tokens"])
    return have


def mix_sources(sizes: DataFrame, weights: DataFrame, doc_id: str, source: str, total_tokens: int | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, source, n_tokens, copies): how often each document enters the mix; documents with 0 copies are left out.

    Every document of a source has the same expected number of copies; its whole part is given to all, the rest is
    sampled by the cube method, balanced on documents and tokens. Each flight decides a block of documents and leaves
    at most two; what all blocks leave flies again in fewer blocks until one block per source is left, whose one or two
    documents are landed by a draw. So no task sees a whole source, however large.

    The few documents that hold a thousandth of their source each (at most a thousand per source, one task each) are
    drawn first by the same method; the others' copies then make up for the difference, so that a very long document
    doesn't spoil its source's share.

    Documents of null or unlisted sources, and those without tokens (null and empty texts), stay out; listed sources
    without documents get nothing, and the shares of the others are scaled to one. Repeated rows are documents of their
    own. Other columns are ignored. An empty table or list of weights gives no rows.
    """
    spark = sizes.sparkSession
    schema = f"{doc_id} {dict(sizes.dtypes)[doc_id]}, {source} string, n_tokens long, copies int"
    own = cut(sizes.where("n_tokens > 0").select(doc_id, source, "n_tokens"))
    plan = mix_plan(own, weights, source, total_tokens)
    if not plan:
        return spark.createDataFrame([], schema)
    of = lambda key: F.create_map(*[F.lit(x) for r in plan for x in (r["_s"], r[key])])[F.col(source)]
    giant = F.col("n_tokens") >= of("tokens") * GIANT
    hashed = own.select(doc_id, source, "n_tokens", F.xxhash64(F.lit(seed), doc_id, source).alias("_h"))

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        """Copies of a source's giants, a thousand rows at most."""
        pdf = pdf.sort_values(["_h", doc_id]).reset_index(drop=True)
        share, rng = float(pdf._copies.iloc[0]), np.random.default_rng([seed, len(pdf)])
        whole = int(share + _EPS)
        pi = flight(np.full(len(pdf), max(0.0, share - whole)), pdf.n_tokens.to_numpy(dtype=float), rng)
        left = np.flatnonzero((pi > 0) & (pi < 1))
        pi[left] = _landing(pi[left], rng)
        return pdf[[doc_id, source, "n_tokens"]].assign(copies=(whole + pi).astype(int))

    drawn = cut(hashed.where(giant).withColumn("_copies", of("copies")).groupBy(source).applyInPandas(draw, schema))
    taken = {r[source]: r for r in drawn.groupBy(source).agg(F.sum("n_tokens").alias("size"), F.sum(F.col("n_tokens") * F.col("copies")).alias("taken")).collect()}
    for r in plan:
        t = taken.get(r["_s"])
        rest = r["tokens"] - (t.size if t else 0)
        r["rest"] = min(float(r["max_repeats"]), max(0.0, (r["copies"] * r["tokens"] - (t["taken"] if t else 0)) / rest)) if rest else 0.0
    rows = hashed.where(F.col(source).isin([r["_s"] for r in plan]) & ~giant).withColumn("_c", of("rest"))
    rows = rows.select(doc_id, source, "n_tokens", "_c", F.floor(F.col("_c") + _EPS).cast("int").alias("_whole"), "_h")
    rows = rows.withColumn("_pi", F.greatest(F.lit(0.0), F.col("_c") - F.col("_whole"))).drop("_c")
    state = "{0} {1}, {2} string, n_tokens long, _whole int, _h long, _pi double, _docs long".format(doc_id, dict(sizes.dtypes)[doc_id], source)

    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", doc_id]).reset_index(drop=True)
        rng = np.random.default_rng([seed, int(pdf._h.iloc[0]) & 0x7FFFFFFF, len(pdf)])
        pi = flight(pdf._pi.to_numpy(), pdf.n_tokens.to_numpy(dtype=float), rng)
        if pdf._docs.iloc[0] <= BLOCK:  # the source's only block
            left = np.flatnonzero((pi > 0) & (pi < 1))
            pi[left] = _landing(pi[left], rng)
        return pdf.assign(_pi=pi)

    todo = rows.withColumn("_docs", of("docs").cast("long"))
    done = None
    largest = max(int(r["docs"]) for r in plan)
    while True:
        blocks = F.ceil(F.col("_docs") / BLOCK)
        flown = todo.groupBy(source, F.pmod("_h", blocks).alias("_b")).applyInPandas(fly, state)
        if largest <= BLOCK:
            done = flown if done is None else done.unionByName(flown)
            break
        flown = cut(flown)
        settled = "_pi = 0 or _pi = 1"
        decided = flown.where(settled)
        done = decided if done is None else done.unionByName(decided)
        todo = flown.where(f"not ({settled})").withColumn("_docs", 2 * F.ceil(F.col("_docs") / BLOCK))
        largest = 2 * -(-largest // BLOCK)
    sampled = done.select(doc_id, source, "n_tokens", (F.col("_whole") + F.col("_pi")).cast("int").alias("copies")).where("copies > 0")
    return sampled.unionByName(drawn.where("copies > 0"))


def mix_shares(mix: DataFrame, weights: DataFrame, source: str) -> DataFrame:
    """(source, target_share, max_repeats, docs, entries, tokens, most_copies, actual_share) for every listed source.

    A source without documents in the mix has zeros; of a repeated source one row of weights counts; null sources don't.
    """
    by = mix.groupBy(source).agg(F.count("*").alias("docs"), F.sum("copies").alias("entries"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.max("copies").alias("most_copies"))
    by = cut(by)
    total = by.agg(F.sum("tokens").alias("n")).first().n or 1  # one number
    w = weights.where("source is not null").dropDuplicates(["source"]).select(F.col("source").alias("_s"), "target_share", "max_repeats")
    out = w.join(by, F.col("_s") == F.col(source), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(F.col("_s").alias("source"), "target_share", "max_repeats", zero("docs"), zero("entries"), zero("tokens"), zero("most_copies"), F.coalesce(F.col("tokens") / F.lit(total), F.lit(0.0)).alias("actual_share"))


def document_sizes(documents: DataFrame, path: str = DEFAULT_RANKS) -> DataFrame:
    """(doc_id, source, n_tokens) of documents."""
    return count_table(documents, "text", path, keep=["doc_id", "source"])

