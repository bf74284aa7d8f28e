"""Problem 6: connected components of pairwise matches by hash-to-min.

State: pairs (node, member), every node's cluster set as rows. A round sends a node's whole set to its minimum member
and that minimum to all members, until nothing changes; then each node's minimum is its component. Sets are rows, never
arrays, so a component with a third of all nodes is spread over tasks: the minimum of a node comes from a partial
aggregation, and the join with it lets adaptive execution split a hot node. Each round is written to the shared folder.

Defined cases: null ends and pairs of a record with itself link nothing; repeated pairs, in either direction, count
once; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, drop_cut


def hash_to_min(pairs: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(node, component): for every node of a pair of two different ones, the smallest node of its component."""
    edges = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u")), F.struct(F.col("a").alias("v"), F.col("a").alias("u")), F.struct(F.col("b").alias("v"), F.col("b").alias("u"))))
    state = cut(edges.select(both.alias("p")).select("p.v", "p.u").distinct(), "h2m")
    seen = None
    for _ in range(max_rounds):
        least = state.groupBy("v").agg(F.min("u").alias("m"))
        sent = F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))
        after = cut(state.join(least, "v").select(sent.alias("p")).select("p.v", "p.u").distinct(), "h2m")
        drop_cut(state)
        state = after
        # the same pairs as before: stable
        now = state.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"hash-to-min isn't stable after {max_rounds} rounds")
    return state.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("node"), F.col("m").alias("component"))


def merged_persons(audit: DataFrame) -> DataFrame:
    """(group_id, person_id) of all persons that merge decisions link."""
    groups = hash_to_min(audit.where(F.col("decision") == "merge"), "candidate_a_id", "candidate_b_id")
    return groups.select(F.col("component").alias("group_id"), F.col("node").alias("person_id"))


def group_report(groups: DataFrame, person: DataFrame) -> DataFrame:
    """Each group's size, the sizes the earlier run had recorded, and how many of its canonical ids the group joins."""
    rows = person.select("person_id", "canonical_person_id", "cluster_size", "match_methods").dropDuplicates(["person_id"])
    joined = groups.join(rows, "person_id", "left")
    per = joined.groupBy("group_id").agg(
        F.count("*").alias("members"),
        F.count("canonical_person_id").alias("matched_before"),
        F.min("canonical_person_id").alias("first_canonical_id"),
        F.min("cluster_size").alias("least_recorded_size"),
        F.max("cluster_size").alias("largest_recorded_size"),
    )
    return per.withColumn("size_is_stale", F.coalesce((F.col("least_recorded_size") != F.col("members")) | (F.col("largest_recorded_size") != F.col("members")), F.lit(False)))
