"""Changes between consecutive full snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row's compared columns in which null differs from every value, by position."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.col(c), F.col(c).isNull()]
    return F.xxhash64(*parts)


def snapshot_changes(df: DataFrame, key: str, snapshot: str, version: str, compare: Sequence[str]) -> DataFrame:
    """Rows (snapshot, key, change_kind): added, removed or changed against the snapshot number before.

    Each row is tagged twice, as the new side of its own number and as the old side of the next one; one aggregation
    by (key, number) keeps per side the row hash of the latest version and classifies the pair. The partial aggregate
    runs before the only shuffle, so a key with very many rows shrinks to one row per task first.

    Of several rows of one snapshot and key the latest ``version`` counts (null is oldest; equal versions: the larger
    hash). Rows with a null key or snapshot number have no identity and take no part; text is compared exactly, blank
    and very long text included, and null differs from any text. Other columns of ``df`` are ignored. An empty table
    gives no rows, as does a table with one snapshot.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull()).select(
        F.col(snapshot).cast("int").alias("_n"),
        F.col(key).alias("_key"),
        F.struct(F.col(version).alias("v"), row_hash(compare).alias("h")).alias("_row"),
    )
    span = rows.agg(F.min("_n").alias("lo"), F.max("_n").alias("hi")).first()
    lo, hi = (span.lo, span.hi) if span.lo is not None else (0, 0)
    sides = rows.select(
        "_key",
        F.explode(F.array(F.struct(F.col("_n").alias("n"), F.lit(True).alias("new")), F.struct((F.col("_n") + 1).alias("n"), F.lit(False).alias("new")))).alias("_side"),
        "_row",
    ).where(F.col("_side.n").between(lo + 1, hi))
    pairs = sides.groupBy(F.col("_side.n").alias("_n"), "_key").agg(
        F.max(F.when(F.col("_side.new"), F.col("_row"))).alias("_new"),
        F.max(F.when(~F.col("_side.new"), F.col("_row"))).alias("_old"),
    )
    kind = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old.h") != F.col("_new.h"), "changed")
    )
    return pairs.select(F.col("_n").alias(snapshot), F.col("_key").alias(key), kind.alias("change_kind")).where("change_kind is not null")
