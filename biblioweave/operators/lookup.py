"""Lookups that say no when they are not sure: by unique keys in order, by ranked aliases, in cascade, with a margin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_lookup(asked: DataFrame, index: DataFrame, within: Sequence[str], asked_id: Sequence[str], owner: str) -> DataFrame:
    """The owner of the first key of each asked thing that exactly one owner has, within the same group.

    ``asked``: within, asked_id, key, priority (small first), and what the caller wants back in ``rule``; ``index``:
    within, key, owner. Uniqueness is decided before priority. Things without such a key drop out.
    """
    unique = index.where(F.col("key").isNotNull()).groupBy(*within, "key").agg(F.min(owner).alias(owner), F.max(owner).alias("_hi")).where(F.col(owner) == F.col("_hi")).drop("_hi")
    hits = asked.where(F.col("key").isNotNull()).join(unique, [*within, "key"])
    best = F.min_by(F.struct(owner, "rule", "priority"), F.col("priority"))
    return hits.groupBy(*within, *asked_id).agg(best.alias("_b")).select(*within, *asked_id, F.col(f"_b.{owner}").alias(owner), F.col("_b.rule").alias("rule"))


def ranked_alias_lookup(asked: DataFrame, entries: DataFrame, asked_id: str, rank: str = "rank") -> DataFrame:
    """The rank of the first alias of each asked thing that the list knows.

    ``asked``: asked_id, aliases (array, in order of trust), country (or null); ``entries``: alias, country, rank. An
    alias counts if the country agrees; without a country, if the list has it in one country only.
    """
    long = asked.select(asked_id, "country", F.posexplode("aliases").alias("pos", "alias"))
    known = entries.where(F.col("alias").isNotNull()).select("alias", F.col("country").alias("_c"), F.col(rank).alias("_rank"))
    hits = long.join(known, "alias").groupBy(asked_id, "pos").agg(
        F.min(F.when(F.col("_c") == F.col("country"), F.col("_rank"))).alias("same"),
        F.min("_rank").alias("any"),
        F.min("_c").alias("lo"),
        F.max("_c").alias("hi"),
        F.bool_or(F.col("country").isNull()).alias("free"),
    )
    value = F.when(~F.col("free"), F.col("same")).when(F.col("lo") == F.col("hi"), F.col("any"))
    found = hits.withColumn("_v", value)
    # the first alias that the list knows decides, even if its entries are in other countries
    return found.groupBy(asked_id).agg(F.min_by(F.struct(F.col("_v").alias("x")), F.col("pos")).alias("_b")).select(asked_id, F.col("_b.x").alias(rank))


def best_rank(df: DataFrame, key: str, ranks: Sequence[str]) -> DataFrame:
    """The smallest known rank of each key over several columns."""
    return df.groupBy(key).agg(F.min(F.least(*ranks) if len(ranks) > 1 else F.col(ranks[0])).alias("best_rank"))


def top_with_margin(scored: DataFrame, within: Sequence[str], candidate: str, score: str, least: float = 0.9, margin: float = 0.08, sure: float = 0.97) -> DataFrame:
    """The best candidate of each group, unless it is below ``least`` or too close to the next one and not ``sure``.

    Equal scores go to the larger candidate.
    """
    w = Window.partitionBy(*within).orderBy(F.desc(score), F.desc(candidate))
    ranked = scored.where(F.col(score) > 0).withColumn("_r", F.row_number().over(w)).withColumn("_next", F.coalesce(F.lead(score).over(w), F.lit(0.0)))
    top = ranked.where(F.col("_r") == 1).drop("_r")
    return top.where((F.col(score) >= least) & ((F.col(score) - F.col("_next") >= margin) | (F.col(score) >= sure))).drop("_next")


def cascade_lookup(asked: DataFrame, steps: Sequence[tuple[str, DataFrame, str, str]], result: str) -> DataFrame:
    """The first of several lookups that answers: (asked column, table, its key, its value) each; others drop out."""
    out, answers = asked, []
    for k, (column, table, key, value) in enumerate(steps):
        name = f"_a{k}"
        out = out.join(table.select(F.col(key).alias(f"_k{k}"), F.col(value).alias(name)), F.col(column) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
        answers.append(F.col(name))
    return out.withColumn(result, F.coalesce(*answers)).drop(*[f"_a{k}" for k in range(len(steps))]).where(F.col(result).isNotNull())


def lookup_or_make(asked: DataFrame, by: str, table: DataFrame, on: str, key: str, made: Column) -> DataFrame:
    """Every match of each asked row (all that share the value), or a made key where there is none (``is_made``)."""
    known = table.select(F.col(on).alias("_on"), F.col(key).alias("_key"))
    out = asked.join(known, F.col(by) == F.col("_on"), "left")
    return out.withColumn(key, F.coalesce("_key", made)).withColumn("is_made", F.col("_key").isNull()).drop("_on", "_key")


def token_index(df: DataFrame, row_id: str, keys: Sequence[tuple[str, Column]]) -> DataFrame:
    """Long form of several keys of a row: row_id, kind, key."""
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), c.alias("key")) for kind, c in keys])
    return df.select(row_id, F.explode(each).alias("_k")).select(row_id, "_k.kind", "_k.key").where(F.col("key").isNotNull())
