"""One surviving record per group of duplicates, by currency reasoning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def identity(key: Column) -> Column:
    """A key without white space and letter case."""
    return F.lower(F.regexp_replace(key, r"(?U)\s+", ""))


def text_size(text: Column) -> Column:
    """Length without outer white space; null is 0."""
    return F.coalesce(F.length(F.regexp_replace(text, r"(?U)^\s+|\s+$", "")), F.lit(0))


def _filled(value: Column) -> Column:
    return value.isNotNull() & (F.trim(value.cast("string")) != "")


def field_values(df: DataFrame, group: str, fields: Sequence[str], time: str) -> DataFrame:
    """(group, field, value, at): each value of each field that a group has, as text, with its first time (null: none).

    Rows shrink to these within each task, so a group with very many rows costs no more than its number of values. Null
    and blank values take no part.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    rows = df.select(F.col(group).alias("group"), F.col(time).alias("at"), cells.alias("c")).select("group", "c.field", "c.value", "at")
    return rows.where(_filled(F.col("value"))).groupBy("group", "field", "value").agg(F.min("at").alias("at"))


def precedence(values: DataFrame) -> DataFrame:
    """(field, lo, hi, net), lo < hi: groups whose value of the field went from lo to hi, less those that went back; 0 is left out."""
    w = Window.partitionBy("group", "field").orderBy("at", "value")
    steps = values.where("at is not null").select("field", F.lag("value").over(w).alias("v_from"), F.col("value").alias("v_to")).where("v_from is not null")
    sign = F.when(F.col("v_from") < F.col("v_to"), 1).otherwise(-1)
    return steps.groupBy("field", F.least("v_from", "v_to").alias("lo"), F.greatest("v_from", "v_to").alias("hi")).agg(F.sum(sign).alias("net")).where("net <> 0")


def levels(edges: Sequence[tuple[str, str]]) -> dict[str, int]:
    """How late each value stands in the partial order of (earlier, later) edges: the longest chain of values before it.

    Values on a cycle have no order among each other and stand as one: they share a level.
    """
    after: dict[str, list[str]] = {}
    for a, b in edges:
        after.setdefault(a, []).append(b)
        after.setdefault(b, [])
    number: dict[str, int] = {}
    low: dict[str, int] = {}
    part: dict[str, int] = {}
    parts: list[list[str]] = []  # those that come later are closed first
    stack: list[str] = []
    for root in sorted(after):
        if root in number:
            continue
        number[root] = low[root] = len(number)
        stack.append(root)
        path = [(root, iter(after[root]))]
        while path:
            v, rest = path[-1]
            for u in rest:
                if u not in number:
                    number[u] = low[u] = len(number)
                    stack.append(u)
                    path.append((u, iter(after[u])))
                    break
                if u not in part:
                    low[v] = min(low[v], number[u])
            else:
                path.pop()
                if path:
                    low[path[-1][0]] = min(low[path[-1][0]], low[v])
                if low[v] == number[v]:
                    at = stack.index(v)
                    part |= dict.fromkeys(stack[at:], len(parts))
                    parts.append(stack[at:])
                    del stack[at:]
    level = [0] * len(parts)
    for k in range(len(parts) - 1, -1, -1):
        for u in (u for v in parts[k] for u in after[v] if part[u] != k):
            level[part[u]] = max(level[part[u]], level[k] + 1)
    return {v: level[k] for v, k in part.items()}


def currency_levels(df: DataFrame, group: str, fields: Sequence[str], time: str) -> DataFrame:
    """(group, levels): for each group with two values of a field that a learned precedence holds between, field -> value -> level.

    A value precedes another when more groups went from it to the other than back. The order is built among the group's
    own values, transitive over them.
    """
    values = field_values(df, group, fields, time)
    x, y = values.alias("x"), values.alias("y")
    own = x.join(y, (F.col("x.group") == F.col("y.group")) & (F.col("x.field") == F.col("y.field")) & (F.col("x.value") < F.col("y.value")))
    own = own.select("x.group", "x.field", F.col("x.value").alias("lo"), F.col("y.value").alias("hi")).join(precedence(values), ["field", "lo", "hi"])
    edge = F.when(F.col("net") > 0, F.struct(F.col("lo").alias("a"), F.col("hi").alias("b"))).otherwise(F.struct(F.col("hi").alias("a"), F.col("lo").alias("b")))
    order = F.udf(lambda edges: levels([(e.a, e.b) for e in edges]), "map<string, int>")
    by_field = own.groupBy("group", "field").agg(F.collect_list(edge).alias("edges")).select("group", "field", order("edges").alias("levels"))
    return by_field.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("field", "levels"))).alias("levels"))


def representatives(
    df: DataFrame, key: str, row_id: str, time: str, support: str, text: str, fields: Sequence[str], learned: str | None = None
) -> DataFrame:
    """One row per group of records with the same key apart from case and white space.

    group_key, n_records; best_id: the record that no record of the group exceeds in ``time``, ``support`` or length of
    ``text`` (null is lowest; of several the smallest row_id), null where no record leads in all three; then the
    surviving values field by field: the newest time, the highest support, the longest text, and for each of ``fields``
    the current value: non-null and non-blank before null, by time, and between rows without time or of the same time
    the value that stands latest in the group's order of the field's own values (``currency_levels``, from value
    transitions over the rows with timestamps), then of the ``learned`` field's values; values that no order tells apart,
    a cycle's among them, by support, text length and smallest row_id. Without ``learned`` nothing is learned.

    All of it is one aggregation by key over structs, pre-aggregated within tasks, so a group with a third of all rows
    is no task of its own; the orders are joined to the rows before. A record that leads in all three criteria is the greatest in (time, support, length): so the
    greatest is looked at, and kept as best_id if it also has the highest support and length.

    Null and blank keys have no identity and drop out; repeated rows count; other columns are ignored; an empty table
    gives no rows.
    """
    used = dict.fromkeys([key, row_id, time, support, text, *fields, *([learned] if learned else [])])
    rows = df.select(*used, identity(F.col(key)).alias("_g"), text_size(F.col(text)).alias("_len")).where("_g <> ''")
    if learned:
        rows = rows.join(currency_levels(rows, "_g", list(dict.fromkeys([*fields, learned])), time).withColumnsRenamed({"group": "_g", "levels": "_levels"}), "_g", "left")
    else:
        rows = rows.withColumn("_levels", F.lit(None).cast("map<string, map<string, int>>"))

    def level(field: str | None) -> Column:
        known = F.try_element_at(F.try_element_at("_levels", F.lit(field)), F.col(field).cast("string")) if field else F.lit(None)
        return F.coalesce(known, F.lit(0))

    order = [level(learned), F.col(support), F.col("_len"), -F.col(row_id)]
    lead = F.struct(F.col(time).alias("a"), F.col(support).alias("b"), F.col("_len").alias("c"), (-F.col(row_id)).alias("d"))
    kept = []
    for f in fields:
        own = [F.col(time), level(f), *order]
        kept.append(F.max(F.when(_filled(F.col(f)), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(own)], F.col(f).alias("v")))).alias(f"_f_{f}"))
    fullest = F.max(F.struct("_len", F.col(time).alias("t"), (-F.col(row_id)).alias("d"), F.col(text).alias("v"))).alias("_text")
    agg = rows.groupBy("_g").agg(F.count("*").alias("n_records"), F.max(lead).alias("_lead"), F.max(support).alias("_support"), F.max("_len").alias("_longest"), F.max(time).alias("_time"), fullest, *kept)
    leads = F.col("_lead.b").eqNullSafe(F.col("_support")) & (F.col("_lead.c") == F.col("_longest"))
    return agg.select(
        F.col("_g").alias("group_key"),
        "n_records",
        F.when(leads, -F.col("_lead.d")).alias("best_id"),
        F.col("_time").alias(time),
        F.col("_support").alias(support),
        F.col("_text.v").alias(text),
        *[F.col(f"_f_{f}.v").alias(f) for f in fields if f not in (time, support, text)],
    )
