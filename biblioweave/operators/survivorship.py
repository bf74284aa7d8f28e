"""Ordered folds: many records of one key become one, by a rule for each column.

All rules are aggregates with partial aggregation before the shuffle and carry an explicit order, so results don't depend
on how rows are spread. Rules: ``first_row`` (value of the first row, null or not), ``first`` (first that isn't null),
``max``, ``min``, ``any`` (or), ``set`` (sorted union of arrays), ``union`` (union of arrays in order, distinct),
``concat`` (arrays in order, with repeats), ``best:<high>medium>low>`` (value of the best of ranked labels).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rule_of(name: str, rule: str, order: Column) -> Column:
    """The aggregate of a column by a rule."""
    c = F.col(name)
    if rule == "first_row":
        return F.min_by(F.struct(c.alias("x")), order)["x"]
    if rule == "first":
        # the order counts only where there is a value
        return F.min_by(c, F.when(c.isNotNull(), order))
    if rule in ("max", "min"):
        return getattr(F, rule)(c)
    if rule == "any":
        return F.bool_or(c)
    if rule == "set":
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    if rule in ("union", "concat"):
        ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), c.alias("x")))), lambda e: e["x"]))
        kept = F.array_compact(ordered)
        return F.array_distinct(kept) if rule == "union" else kept
    if rule.startswith("best:"):
        labels = rule[5:].split(">")
        rank = F.lit(len(labels))
        for k, label in enumerate(labels):
            rank = F.when(c == label, F.lit(k)).otherwise(rank)
        return F.min_by(c, F.when(c.isNotNull(), rank))
    raise ValueError(f"{rule} is no rule")


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """One row for each key."""
    by = F.struct(*[F.col(o) for o in order])
    ready = df
    for n in (n for n, r in rules.items() if r in ("set", "union", "concat")):
        ready = ready.withColumn(n, F.coalesce(F.col(n), F.expr(f"cast(array() as {df.schema[n].dataType.simpleString()})")))
    return ready.groupBy(*keys).agg(*[rule_of(n, r, by).alias(n) for n, r in rules.items()])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, and how many later ones it hides (``n_later``)."""
    by = F.struct(*[F.col(o) for o in order])
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("_r"), (F.count("*") - 1).alias("n_later"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest], "n_later")


def conflicts(df: DataFrame, keys: Sequence[str], order: Sequence[str], compared: Sequence[str], backfilled: bool = True) -> DataFrame:
    """Later rows that differ from what came before in a compared column, both known; ``n_conflicts`` for each key.

    Backfilled: what came before is the first known value of the earlier rows; else it is the first row's.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    differs = F.lit(False)
    for c in compared:
        earlier = F.first(c, ignorenulls=backfilled).over(w)
        differs = differs | F.coalesce(earlier != F.col(c), F.lit(False))
    return df.select(*keys, differs.alias("_d")).groupBy(*keys).agg(F.count_if("_d").alias("n_conflicts"))


def representative(df: DataFrame, keys: Sequence[str], best: Sequence[Column], row_id: str) -> DataFrame:
    """For each key the id of the row with the largest tuple."""
    return df.groupBy(*keys).agg(F.max_by(F.col(row_id), F.struct(*best, F.col(row_id))).alias(row_id))


def most_common(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """For each key the most frequent known value; of equally frequent ones, the one seen first."""
    by = F.struct(*[F.col(o) for o in order])
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(by).alias("_o"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct((-F.col("_n")).alias("n"), F.col("_o").alias("o"))).alias(value))


def density(*cs: Column) -> Column:
    """How many of the values are known."""
    out = F.lit(0)
    for c in cs:
        out = out + F.when(c.isNotNull(), 1).otherwise(0)
    return out
