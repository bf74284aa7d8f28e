"""Connected components of an edge table, and how many components each phase of edges joins.

Large-star and small-star steps alternate until no edge changes: a node links its larger neighbours to its smallest one,
then its smaller ones. Every round is two aggregations and joins, and its result is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, drop_cut


def _both(edges: DataFrame) -> DataFrame:
    pair = F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u"))))
    return edges.select(pair.alias("p")).select("p.v", "p.u")


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node that each node of an edge of two different ones is linked to."""
    clean = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = cut(clean.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "components")
    before = None
    for _ in range(max_rounds):
        ends = _both(now)
        least = ends.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = ends.join(least, "v").where("u > v").select(F.col("u").alias("b"), F.col("m").alias("a")).distinct()
        # small star: of the links to smaller nodes, the smallest takes the others and the node itself
        small_least = large.groupBy("b").agg(F.min("a").alias("m"))
        linked = large.join(small_least, "b")
        small = linked.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(small_least.select(F.col("m").alias("a"), "b")).distinct()
        after = cut(small, "components")
        drop_cut(now)
        now = after
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components aren't stable after {max_rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def star_edges(df: DataFrame, row_id: str, key: str) -> DataFrame:
    """For every key that several rows share, links from its smallest row to the others."""
    plain = df.select(F.col(row_id).alias("b"), F.col(key).alias("_key")).where(F.col("_key").isNotNull())
    least = plain.groupBy("_key").agg(F.min("b").alias("a"))
    return plain.join(least, "_key").select("a", "b").where("a <> b").distinct()


def phased_merges(nodes: DataFrame, node: str, phases: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(phase, merges): how many components the edges (a, b) of each phase join after those of the phases before."""
    spark = nodes.sparkSession
    total = nodes.select(node).distinct().count()
    edges, rows, left = None, [], total
    for name, phase in phases:
        edges = phase.select("a", "b") if edges is None else edges.union(phase.select("a", "b"))
        linked = components(edges, "a", "b").agg(F.count("*").alias("n"), F.count_distinct("component").alias("c")).first()
        now = total - linked["n"] + linked["c"]
        rows.append((name, left - now))
        left = now
    return spark.createDataFrame(rows, "phase string, merges bigint")
