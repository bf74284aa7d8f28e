"""Clustering of person records: strong identifiers, blocks, pair decisions, components, one record for each cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import agreement_keys, name_aliases, name_parts, name_score
from ..functions.text import normalize_text
from .graph import components, star_edges

#: A name pair must score at least this. Fixed value.
STRONG_NAME = 0.93


def _norm_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.coalesce(c, F.array().cast("array<string>")), normalize_text))))


def nodes_of_persons(person: DataFrame) -> DataFrame:
    """Match nodes: name parts, aliases, and the sets of identifiers, institutions and countries of each record."""
    one = person.dropDuplicates(["person_id"])
    empty = F.array().cast("array<string>")
    return one.select(
        F.col("person_id").alias("node"),
        name_parts(F.col("name_original")).alias("name"),
        _norm_set(F.concat(F.coalesce("name_aliases", empty), name_aliases(F.col("name_original")))).alias("aliases"),
        F.array_compact(F.array("orcid")).alias("orcids"),
        F.coalesce("researcher_ids", empty).alias("rids"),
        F.array_distinct(F.transform(F.array_compact(F.concat(F.array("primary_email"), F.coalesce("emails", empty))), F.lower)).alias("emails"),
        _norm_set(F.concat(F.coalesce("affiliations", empty), F.array_compact(F.array("current_affiliation")))).alias("institutions"),
        _norm_set(F.concat(F.coalesce("countries_observed", empty), F.array_compact(F.array("country")))).alias("countries"),
        F.coalesce("source_systems", empty).alias("source_systems"),
        *[F.col(c) if c in one.columns else F.lit(None).cast(kind).alias(c) for c, kind in (("name_original", "string"), ("publication_ids", "array<string>"), ("qs_top200_rank", "int"), ("world_top500_rank", "int"), ("created_at", "timestamp"), ("updated_at", "timestamp"))],
    )


def strong_edges(nodes: DataFrame, column: str) -> DataFrame:
    """Star links between the nodes that share a value of an array column."""
    return star_edges(nodes.select("node", F.explode(column).alias("key")), "node", "key")


def block_keys(nodes: DataFrame) -> DataFrame:
    """(node, key): compact name; name signature with each institution; name signature with each country."""
    signature = F.concat_ws("|", F.col("name.surname_norm"), F.col("name.first_initial"))
    ready = F.col("name.surname_norm").isNotNull() & F.col("name.first_initial").isNotNull()
    keys = F.concat(
        F.array(F.concat(F.lit("compact:"), F.col("name.compact_full"))),
        F.when(ready, F.transform("institutions", lambda i: F.concat(F.lit("siginst:"), signature, F.lit("|"), i))).otherwise(F.array().cast("array<string>")),
        F.when(ready, F.transform("countries", lambda i: F.concat(F.lit("sigcountry:"), signature, F.lit("|"), i))).otherwise(F.array().cast("array<string>")),
    )
    return nodes.select("node", F.explode(F.array_compact(keys)).alias("key")).distinct()


def blocked_pairs(keys: DataFrame, most: int | None = 200) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, keys) of nodes that share a block of at most ``most``, and the larger blocks (key, n) left out.

    None pairs all blocks: the work in one grows with its square, and the join splits it over tasks.
    """
    sizes = keys.groupBy("key").agg(F.count("*").alias("n"))
    large = F.col("n") > most if most is not None else F.lit(False)
    usable = keys.join(sizes.where((F.col("n") > 1) & ~large).select("key"), "key", "left_semi")
    l, r = usable.select("key", F.col("node").alias("a")), usable.select("key", F.col("node").alias("b"))
    pairs = l.join(r, "key").where("a < b").groupBy("a", "b").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return pairs, sizes.where(large)


#: Key of the block of pairs that another service delivered as matches. Fixed value.
EXTERNAL = "external_matched"


def with_external(pairs: DataFrame, delivered: DataFrame) -> DataFrame:
    """``pairs`` (a, b, keys) with the delivered ones (a, b, either way round) added under the key ``EXTERNAL``."""
    ends = delivered.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = pairs.unionByName(ends.withColumn("keys", F.array(F.lit(EXTERNAL))))
    return both.groupBy("a", "b").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys"))


def stable_in_publications() -> Column:
    """True for two author records (``l_``, ``r_``) of one compact name and a shared institution that come from different publications."""
    authors = F.array_contains("l_source_systems", "frontiers") & F.array_contains("r_source_systems", "frontiers")
    known = (F.size(F.coalesce("l_publication_ids", F.array())) > 0) & (F.size(F.coalesce("r_publication_ids", F.array())) > 0)
    differ = F.array_sort(F.array_distinct("l_publication_ids")) != F.array_sort(F.array_distinct("r_publication_ids"))
    return F.coalesce(authors & (F.col("l_name.compact_full") == F.col("r_name.compact_full")) & F.arrays_overlap("l_institutions", "r_institutions") & known & differ, F.lit(False))


def decided_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, decision, score, rules_hit, conflict_flags): merge, manual_review or blocked_conflict; others drop out."""
    cols = ["node", "name", "aliases", "orcids", "rids", "institutions", "countries", "source_systems", "publication_ids"]
    l = nodes.select(*[F.col(c).alias(f"l_{c}") for c in cols]).withColumnRenamed("l_node", "a")
    r = nodes.select(*[F.col(c).alias(f"r_{c}") for c in cols]).withColumnRenamed("r_node", "b")
    both = pairs.join(l, "a").join(r, "b")

    def disjoint(c: str) -> Column:
        return (F.size(f"l_{c}") > 0) & (F.size(f"r_{c}") > 0) & ~F.arrays_overlap(f"l_{c}", f"r_{c}")

    def shared(c: str) -> Column:
        return F.coalesce(F.arrays_overlap(f"l_{c}", f"r_{c}"), F.lit(False))

    flags = F.array_compact(F.array(F.when(disjoint("orcids"), F.lit("orcid_conflict")), F.when(disjoint("rids"), F.lit("researcher_id_conflict"))))
    named = name_score(F.col("l_name"), F.col("r_name"), F.col("l_aliases"), F.col("r_aliases"))
    supports = F.array_compact(F.array(F.when(shared("institutions"), F.lit("institution_overlap")), F.when(shared("countries"), F.lit("country_overlap")), F.when(F.array_contains("keys", EXTERNAL), F.lit(EXTERNAL)), F.when(stable_in_publications(), F.lit("publication_stability"))))
    scored = both.select("a", "b", "keys", flags.alias("flags"), named.alias("named"), supports.alias("supports"))
    blocked = F.size("flags") > 0
    decision = F.when(blocked, "blocked_conflict").when(F.coalesce(F.col("named.score"), F.lit(0.0)) < STRONG_NAME, None).when(F.size("supports") >= 2, "merge").when(F.size("supports") == 1, "manual_review")
    out = scored.select(
        "a",
        "b",
        decision.alias("decision"),
        F.when(blocked, F.lit(0.0)).otherwise(F.round("named.score", 4)).alias("score"),
        F.when(blocked, F.col("keys")).otherwise(F.concat(F.array("named.rule"), F.col("supports"))).alias("rules_hit"),
        F.col("flags").alias("conflict_flags"),
    )
    return out.where(F.col("decision").isNotNull())


def canonical_id(orcids: Column, rids: Column, emails: Column, members: Column) -> Column:
    """The only ORCID, else the only researcher id, else the only mailbox, else a hash of the members."""
    return (
        F.when(F.size(orcids) == 1, F.concat(F.lit("orcid:"), F.get(orcids, F.lit(0))))
        .when(F.size(rids) == 1, F.concat(F.lit("rid:"), F.get(rids, F.lit(0))))
        .when(F.size(emails) == 1, F.concat(F.lit("email:"), F.get(emails, F.lit(0))))
        .otherwise(F.concat(F.lit("cluster:"), F.sha1(F.array_join(members, "|"))))
    )


def cluster_fold(nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """One row for each cluster: canonical id, representative and its name, size, the united sets, the best ranks, the first and last time."""
    full = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    filled = F.lit(0)
    for c in ("orcids", "rids", "emails", "institutions", "countries"):
        filled = filled + (F.size(c) > 0).cast("int")
    trusted = F.coalesce(F.arrays_overlap("source_systems", F.array(F.lit("scholars"), F.lit("matched"))), F.lit(False)).cast("int")
    sets = {c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("orcids", "rids", "emails", "institutions", "countries")}
    out = full.groupBy("component").agg(
        F.max_by("node", F.struct(trusted, filled, F.col("node"))).alias("representative"),
        F.count("*").alias("cluster_size"),
        F.array_sort(F.collect_list("node")).alias("members"),
        F.max_by("name_original", F.struct(trusted, filled, F.col("node"))).alias("name_original"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("name_aliases"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_systems")))).alias("source_systems"),
        F.min("qs_top200_rank").alias("qs_top200_rank"),
        F.min("world_top500_rank").alias("world_top500_rank"),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
        *sets.values(),
    )
    return out.withColumn("canonical_person_id", canonical_id(F.col("orcids"), F.col("rids"), F.col("emails"), F.col("members")))


def cluster_persons(person: DataFrame, phases: Sequence[str] = ("orcids", "rids", "emails"), most: int | None = 200, external: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(clusters, decisions, links, skipped): strong identifiers, then merged pairs, then components of them all.

    ``skipped`` lists the blocks (key, n) above ``most`` whose pairs are not compared; with None there are none.
    """
    from ..session import cut

    nodes = cut(nodes_of_persons(person), "nodes")
    pairs, skipped = blocked_pairs(block_keys(nodes), most)
    pairs = with_external(pairs, external) if external is not None else pairs
    decisions = cut(decided_pairs(pairs, nodes), "decisions")
    edges = decisions.where("decision = 'merge'").select("a", "b")
    for column in phases:
        edges = edges.unionByName(strong_edges(nodes, column))
    links = cut(components(edges, "a", "b"), "links")
    return cluster_fold(nodes, links), decisions, links, skipped


def reconcile(persons: DataFrame, relations: DataFrame, by: str, person_id: str, order: Sequence[str], rules: dict[str, str], best: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """Persons that share a value become one under the id of the fullest of them, and relations follow.

    ``relations`` has the person id and other columns; a relation that two of the persons had stays once.
    """
    from .survivorship import fold, representative

    shared = persons.where(F.col(by).isNotNull())
    chosen = representative(shared, [by], best, person_id).withColumnRenamed(person_id, "_into")
    mapped = persons.join(chosen, by, "left").withColumn("_into", F.coalesce("_into", person_id))
    merged = fold(mapped, ["_into"], order, rules).withColumnRenamed("_into", person_id)
    moves = mapped.select(F.col(person_id).alias("_from"), "_into").distinct()
    rest = [c for c in relations.columns if c != person_id]
    followed = relations.join(moves, F.col(person_id) == F.col("_from"), "left").select(F.coalesce("_into", person_id).alias(person_id), *rest).distinct()
    return merged, followed


def evidence_pairs(relations: DataFrame, occurrences: DataFrame, least: float = STRONG_NAME) -> DataFrame:
    """(a, b, keys): scholar and author of a publication that an outside list relates, where the names agree well enough.

    ``relations``: node, publication_id, name (struct) and aliases of the name in the paper, null where it has none; such
    a relation pairs with every author of the paper. ``occurrences``: node, publication_id, name, aliases.
    """
    columns = ["publication_id", "name", "aliases"]
    l, r = relations.select(F.col("node").alias("l_node"), *columns), occurrences.select(F.col("node").alias("r_node"), *columns)

    def keyed(side: DataFrame, node: str) -> DataFrame:
        exploded = side.select(node, "publication_id", F.explode_outer(agreement_keys(F.col("name"), F.col("aliases"), least)).alias("key"))
        return exploded.select(node, F.unhex(F.md5(F.concat("publication_id", F.lit("\u0001"), "key"))).alias("key"))  # 16 bytes instead of both texts

    # names that agree have a key in common, so a paper of many authors isn't paired with itself
    kept = keyed(l, "l_node").join(keyed(r, "r_node"), "key").select("l_node", "r_node")
    unnamed = l.where(F.col("name").isNull()) if least > 0 else l
    if not unnamed.isEmpty():
        kept = kept.unionByName(unnamed.select("l_node", "publication_id").join(r.select("r_node", "publication_id"), "publication_id").select("l_node", "r_node"))
    kept = kept.where("l_node <> r_node")
    return kept.select(F.least("l_node", "r_node").alias("a"), F.greatest("l_node", "r_node").alias("b")).distinct().withColumn("keys", F.array(F.lit("external_matched")))


def match_score(given: Column, name_contained: Column, same_doi: Column) -> Column:
    """Struct (score, confidence) of a delivered match: the given score, else 0.55 and what speaks for it."""
    made = F.lit(0.55) + F.when(name_contained, 0.2).otherwise(0.0) + F.when(same_doi, 0.1).otherwise(0.0)
    score = F.least(F.greatest(F.coalesce(given.cast("double"), made), F.lit(0.0)), F.lit(1.0))
    return F.struct(score.alias("score"), F.when(score >= 0.85, "high").when(score >= 0.65, "medium").otherwise("low").alias("confidence"))
