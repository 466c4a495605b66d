"""Items that stand together in one record: pair counts and association beyond chance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacantia.session import cut

#: Packed codes held in a run before it is sorted, counted and spilled to the shuffle.
RUN = 1 << 20
#: Items of a basket in one piece, about; a larger basket is cut and its pieces are paired, each pair a row of its own.
PIECE = 4096


def clean_items(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct (basket, item): items trimmed and lower-cased; null or blank items and null baskets drop out."""
    name = F.lower(F.regexp_replace(F.col(item), r"(?U)^\s+|\s+$", ""))
    return df.select(F.col(basket).cast("string").alias("basket"), name.alias("item")).where("basket is not null and item <> ''").distinct()


def number_items(pairs: DataFrame) -> DataFrame:
    """(item, item_id, n_item): ids are dense 32-bit ranks in item order, made without one task seeing all items.

    Items are range-sorted over the tasks; each task numbers its own, and only the size of each task's share goes to
    the driver. The table is checkpointed, so that ids stay the same when an executor is lost.
    """
    counts = pairs.groupBy("item").agg(F.count("*").alias("n_item"))
    n = pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = cut(counts.repartitionByRange(int(n), "item").sortWithinPartitions("item").select("*", F.spark_partition_id().alias("part")))
    sizes = {r.part: r.n for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for part in sorted(sizes):
        offsets += [F.lit(part), F.lit(total)]
        total += sizes[part]
    if total >= 1 << 32:
        raise ValueError("more items than 32-bit ids")
    offset = F.create_map(*offsets)[F.col("part")] if offsets else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("part").orderBy("item")) - 1
    return placed.select("item", (offset + rank).cast("long").alias("item_id"), "n_item")


def _packed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack the id pairs of rows (ids, others, weight) into 64-bit codes: pairs within ids where others is null, else each of ids with each of others.

    Emits sorted, run-length-counted runs of at most about RUN codes.
    """
    held: list[np.ndarray] = []
    weights: list[np.ndarray] = []
    size = 0

    def spill() -> pa.RecordBatch:
        codes, w = np.concatenate(held), np.concatenate(weights)
        order = np.argsort(codes, kind="stable")
        codes, w = codes[order], w[order]
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        return pa.RecordBatch.from_pydict({"code": codes[starts], "n": np.add.reduceat(w, starts)})

    for batch in batches:
        for ids, others, w in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
            own = np.sort(ids.values.to_numpy(zero_copy_only=False))
            beside = others.values.to_numpy(zero_copy_only=False) if others.is_valid else None
            for k in range(len(own) - (beside is None)):  # one row of the triangle at a time: memory follows the basket, not its square
                rest = own[k + 1 :] if beside is None else beside
                held.append((np.minimum(own[k], rest) << 32) | np.maximum(own[k], rest))
                weights.append(np.full(len(rest), w, dtype=np.int64))
                size += len(rest)
                if size >= RUN:
                    yield spill()
                    held, weights, size = [], [], 0
    if size:
        yield spill()


def pieced(sets: DataFrame, sizes: DataFrame, piece: int) -> DataFrame:
    """(ids, others, w) of baskets with more than ``piece`` items: their pieces and each pair of them; no row is a whole such basket.

    sets: (basket, item_id); sizes: (basket, k) of these baskets.
    """
    rows = sets.join(sizes, "basket").withColumn("_p", F.ceil(F.col("k") / piece).cast("long"))
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("item_id"), "_p"))
    rows = rows.select("basket", "item_id", "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_p") - 1)).alias("_other"))
    rows = rows.select("basket", "item_id", "_own", F.least("_own", "_other").alias("_a"), F.greatest("_own", "_other").alias("_b"))
    mine = lambda side: F.collect_list(F.when(F.col("_own") == F.col(side), F.col("item_id")))
    lists = rows.groupBy("basket", "_a", "_b").agg(mine("_a").alias("ids"), mine("_b").alias("more"))
    return lists.select("ids", F.when(F.col("_a") != F.col("_b"), F.col("more")).alias("others"), F.lit(1).cast("long").alias("w"))


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run-length count over codes that arrive sorted; a run open at the end of a batch is carried on."""
    code, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, w = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        keys, sums = codes[starts], np.add.reduceat(w, starts)
        if code is not None:
            if keys[0] == code:
                sums[0] += n
            else:
                keys, sums = np.r_[code, keys], np.r_[n, sums]
        code, n = keys[-1], sums[-1]
        if len(keys) > 1:
            yield pa.RecordBatch.from_pydict({"code": keys[:-1], "n": sums[:-1]})
    if code is not None:
        yield pa.RecordBatch.from_pydict({"code": np.array([code]), "n": np.array([n])})


def item_pairs(df: DataFrame, basket: str, item: str) -> DataFrame:
    """(item_a, item_b, n_both, n_a, n_b, n_baskets, lift, log_odds) for each pair in at least one basket; a < b.

    Baskets become sorted sets of dense ids; equal sets are counted once with their number of baskets as weight; baskets
    of more than PIECE items are cut into pieces, each pair of which is a row of its own. Pairs
    are packed into 64-bit codes, sorted and counted in bounded runs within each task (so that a frequent pair leaves a
    task once per run), and the runs are brought together by code with an external merge sort and run-length counted.
    log_odds is the logarithm of the odds ratio with 0.5 added to each cell (continuity correction).

    Items are trimmed of white space and lower-cased; null and blank items and null baskets don't count; repeats in a
    basket count once; n_baskets is the number of baskets with any item. Baskets of one item give no pair. Other
    columns are ignored. An empty table gives no rows.
    """
    pairs = cut(clean_items(df, basket, item))
    items = number_items(pairs)
    sizes = pairs.groupBy("basket").agg(F.count("*").alias("k"))
    total, large = sizes.agg(F.count("*"), F.count_if(F.col("k") > PIECE)).first()  # two numbers
    sets, more = pairs.join(items.select("item", "item_id"), "item").select("basket", "item_id"), None
    if large:
        sizes = sizes.where(F.col("k") > PIECE)
        more, sets = pieced(sets, sizes, PIECE), sets.join(sizes, "basket", "left_anti")
    sets = sets.groupBy("basket").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    weighted = sets.where(F.size("ids") > 1).groupBy("ids").agg(F.count("*").alias("w")).select("ids", F.lit(None).cast("array<long>").alias("others"), "w")
    weighted = weighted if more is None else weighted.unionByName(more)
    runs = weighted.mapInArrow(_packed_runs, "code long, n long")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = runs.repartition(n, "code").sortWithinPartitions("code").mapInArrow(_merge_runs, "code long, n long")
    a = items.select(F.col("item_id").alias("id_a"), F.col("item").alias("item_a"), F.col("n_item").alias("n_a"))
    b = items.select(F.col("item_id").alias("id_b"), F.col("item").alias("item_b"), F.col("n_item").alias("n_b"))
    out = (
        counted.select(F.shiftrightunsigned("code", 32).alias("id_a"), F.col("code").bitwiseAND((1 << 32) - 1).alias("id_b"), F.col("n").alias("n_both"))
        .join(a, "id_a")
        .join(b, "id_b")
        .withColumn("n_baskets", F.lit(total).cast("long"))
    )
    both, na, nb, nn = (F.col(c).cast("double") for c in ("n_both", "n_a", "n_b", "n_baskets"))
    odds = (both + 0.5) * (nn - na - nb + both + 0.5) / ((na - both + 0.5) * (nb - both + 0.5))
    return out.select("item_a", "item_b", "n_both", "n_a", "n_b", "n_baskets", (both * nn / (na * nb)).alias("lift"), F.log(odds).alias("log_odds"))
