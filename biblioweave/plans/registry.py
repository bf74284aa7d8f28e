"""Registered queries of the core over whole tables, and the SQL they are held against."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, names, places, text
from ..operators import evidence, graph, lookup, matching, profile, search, survivorship, vectors
from ..operators.packed_fields import split_packed
from ..session import cut, new_path, table
from ..sources import control
from ..streaming import incremental
from . import projection, silver, sql

Query = Callable[[SparkSession, str], DataFrame]
PACKED = ["author_keywords", "keywords_plus", "wos_categories"]
_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


@_query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Values of the packed fields that hold at least two."""
    return split_packed(table(spark, d, "publication"), "publication_id", PACKED, min_items=2)


# structured search


def _entity(df: DataFrame, name: str, key: str, **more) -> search.Entity:
    return search.entity(name, df.schema, key, **more)


def rule(field: str, operator: str, **more) -> dict:
    """A rule of a search tree."""
    return {"type": "rule", "field": field, "operator": operator, **more}


def group(logic: str, *children: dict) -> dict:
    """A group of a search tree."""
    return {"type": "group", "logic": logic, "children": list(children)}


@_query
def search_and_range(spark: SparkSession, d: str) -> DataFrame:
    """A page of orders: AND of a term, a range and a date, most expensive first."""
    df = table(spark, d, "orders")
    tree = group("and", rule("o_orderstatus", "eq", value="O"), rule("o_totalprice", "between", range={"from": 1000, "to": 400000}), rule("o_orderdate", "gte", value=dt.datetime(1995, 1, 1)), rule("", ""))
    out, _ = search.search(df, _entity(df, "orders", "o_orderkey"), search.Request(tree, ["o_orderkey", "o_custkey", "o_totalprice"], [("o_totalprice", "desc")], page_size=100))
    return out


@_query
def search_or_group(spark: SparkSession, d: str) -> DataFrame:
    """Customers of two segments or with a debt."""
    df = table(spark, d, "customer")
    tree = group("or", rule("c_mktsegment", "in", values=["BUILDING", "MACHINERY"]), rule("c_acctbal", "lt", value=0.0))
    return search.matching(df, _entity(df, "customer", "c_custkey"), tree).select("c_custkey", "c_name", "c_acctbal")


@_query
def search_not_in_missing(spark: SparkSession, d: str) -> DataFrame:
    """Persons not of three countries: those without a country are among them."""
    df = table(spark, d, "person")
    tree = group("and", rule("country", "not_in", values=["China", "United States", "France"]), rule("orcid", "neq", value="0000-0000-0000-0000"))
    return search.matching(df, _entity(df, "person", "person_id"), tree).select("person_id", "country")


@_query
def search_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Persons by the start of a name or of one of their aliases."""
    df = table(spark, d, "person")
    tree = group("or", rule("name_norm", "prefix", value="al"), rule("name_aliases", "prefix", value="Al"))
    return search.matching(df, _entity(df, "person", "person_id"), tree).select("person_id", "name_norm")


@_query
def search_match(spark: SparkSession, d: str) -> DataFrame:
    """Documents with any of the words."""
    df = table(spark, d, "documents")
    return search.matching(df, _entity(df, "documents", "doc_id", texts=["text"]), group("and", rule("text", "match", value="Interferometry, nanoindentation"))).select("doc_id", "source")


@_query
def search_match_phrase(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the words next to each other."""
    df = table(spark, d, "documents")
    return search.matching(df, _entity(df, "documents", "doc_id", texts=["text"]), group("and", rule("text", "match_phrase", value="Remote Sensing"))).select("doc_id", "source")


@_query
def search_nested_same_element(spark: SparkSession, d: str) -> DataFrame:
    """Persons with one reference that has both the source system and the row number."""
    df = table(spark, d, "person")
    tree = group("and", rule("source_refs.source_system", "eq", value="scholars"), rule("source_refs.row_index", "gte", value=20000), rule("keywords", "exists"))
    return search.matching(df, _entity(df, "person", "person_id"), tree).select("person_id", F.size("keywords").cast("bigint").alias("n_keywords"))


@_query
def search_offset_page(spark: SparkSession, d: str) -> DataFrame:
    """The third page by number."""
    df = table(spark, d, "events")
    out, _ = search.search(df, _entity(df, "events", "event_id"), search.Request(group("and", rule("event_type", "exists")), ["event_id", "event_type", "value"], [("value", "desc")], page=3, page_size=50))
    return out


@_query
def search_after_page(spark: SparkSession, d: str) -> DataFrame:
    """The page after a row."""
    df = table(spark, d, "events")
    out, _ = search.search(df, _entity(df, "events", "event_id"), search.Request({}, ["event_id", "value"], [("value", "desc")], page_size=200, after=[50.0, 100]))
    return out


@_query
def search_count(spark: SparkSession, d: str) -> DataFrame:
    """How many rows a tree selects."""
    df = table(spark, d, "publication")
    tree = group("and", rule("publication_year", "between", range={"from": 2005, "to": 2015}), group("or", rule("doi", "exists"), rule("language", "neq", value="English")))
    return search.matching(df, _entity(df, "publication", "publication_id"), tree).agg(F.count("*").alias("total"))


# texts, names, ids


@_query
def norm_text(spark: SparkSession, d: str) -> DataFrame:
    """Normalised texts of documents, as hashes."""
    return table(spark, d, "documents").select("doc_id", F.sha1(text.normalize_text(F.col("text"))).alias("norm_sha1"))


@_query
def norm_compact(spark: SparkSession, d: str) -> DataFrame:
    """Compact titles."""
    return table(spark, d, "publication").select("publication_id", text.normalize_compact(F.col("title")).alias("compact"))


@_query
def split_sorted(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct pieces."""
    return table(spark, d, "publication").select("publication_id", F.array_join(text.split_sorted(F.col("wos_categories")), "|").alias("pieces"))


@_query
def split_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Pieces in order, with their number."""
    pieces = text.split_ordered(F.col("author_keywords"))
    return table(spark, d, "publication").select("publication_id", F.size(pieces).cast("bigint").alias("n"), F.array_join(pieces, "|").alias("pieces"))


@_query
def split_top_level(spark: SparkSession, d: str) -> DataFrame:
    """Pieces outside brackets (no SQL: a walk over characters; tested against brute force)."""
    return table(spark, d, "publication").select("publication_id", text.split_top_level(F.col("author_keywords")).alias("pieces"))


@_query
def name_parts(spark: SparkSession, d: str) -> DataFrame:
    """Names of authors taken apart."""
    # taken apart once, then read: a column that is used inline would be computed for each of its fields
    p = table(spark, d, "author_occurrence").select("occurrence_id", names.name_parts(F.col("author_name_raw")).alias("p"))
    return p.select("occurrence_id", F.col("p.surname_norm").alias("surname"), F.col("p.given_names_norm").alias("given"), F.col("p.initials").alias("initials"), F.col("p.compact_full").alias("compact"))


@_query
def name_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Ways to write the names of authors (no SQL; tested against brute force)."""
    return table(spark, d, "author_occurrence").select("occurrence_id", names.name_aliases(F.col("author_name_raw")).alias("aliases"))


@_query
def email_extract(spark: SparkSession, d: str) -> DataFrame:
    """Addresses that have the form of one, by part."""
    e = F.get(names.valid_emails(F.col("primary_email")), F.lit(0))
    return table(spark, d, "person").select("person_id", e.alias("email"), names.email_local(e).alias("local_part"), names.email_domain(e).alias("email_domain")).where(F.col("email").isNotNull())


@_query
def orcid_extract(spark: SparkSession, d: str) -> DataFrame:
    """ORCIDs in upper case."""
    return table(spark, d, "person").select("person_id", names.orcid(F.col("orcid")).alias("orcid")).where(F.col("orcid").isNotNull())


@_query
def registrable_domain(spark: SparkSession, d: str) -> DataFrame:
    """Domains of plain lower-case addresses, as its SQL has it; registrable_domain_whole takes all."""
    p = table(spark, d, "person").select(F.col("primary_email").alias("address"))
    q = table(spark, d, "qs_university").select(F.col("website").alias("address"))
    both = p.unionByName(q).where(F.col("address").rlike(r"^[a-z0-9:/._@-]+$"))
    return both.groupBy(places.registrable_domain(F.col("address")).alias("domain")).agg(F.count("*").alias("n")).where(F.col("domain").isNotNull())


@_query
def registrable_domain_whole(spark: SparkSession, d: str) -> DataFrame:
    """Domains of all addresses of mailboxes and ranked universities, also wrapped, padded and upper-case ones (no SQL; tested on a fixture)."""
    p = table(spark, d, "person").select(F.col("primary_email").alias("address"))
    both = p.unionByName(table(spark, d, "qs_university").select(F.col("website").alias("address")))
    return both.groupBy(places.registrable_domain(F.col("address")).alias("domain")).agg(F.count("*").alias("n")).where(F.col("domain").isNotNull())


@_query
def institution_country(spark: SparkSession, d: str) -> DataFrame:
    """Institution and country of addresses as typed."""
    return table(spark, d, "person").where(F.col("current_affiliation").isNotNull()).select("person_id", places.institution_of(F.col("current_affiliation")).alias("institution"), places.country_of(F.col("current_affiliation")).alias("last_place"))


@_query
def coerce_rank(spark: SparkSession, d: str) -> DataFrame:
    """Ranks as numbers."""
    return table(spark, d, "qs_university").select("qs_id", places.rank_value(F.col("rank_text")).alias("rank"), text.to_int(F.col("rank_text")).alias("plain"), text.to_float(F.col("score").cast("string")).alias("score"))


@_query
def sha1_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids from parts."""
    p = table(spark, d, "publication")
    return p.select("publication_id", ids.hashed_id(F.col("title"), F.col("publication_year"), F.col("source_title")).alias("hashed"), ids.publication_id(F.col("doi"), F.col("ut_wos_id"), F.col("title"), F.col("publication_year"), F.col("source_title")).alias("made_id"))


@_query
def stable_shard(spark: SparkSession, d: str) -> DataFrame:
    """Shards of keys."""
    return table(spark, d, "orders").select("o_orderkey", ids.stable_shard(F.col("o_orderkey").cast("string"), 16).alias("shard"))


@_query
def safe_bulk_id(spark: SparkSession, d: str) -> DataFrame:
    """Ids that fit an index."""
    return table(spark, d, "documents").select("doc_id", ids.safe_id(F.col("text")).alias("safe"))


@_query
def sanitize_doc(spark: SparkSession, d: str) -> DataFrame:
    """Texts without control characters, as hashes."""
    return table(spark, d, "documents").select("doc_id", F.sha1(ids.clean_text(F.col("text"))).alias("clean_sha1"))


@_query
def bulk_ndjson(spark: SparkSession, d: str) -> DataFrame:
    """Bulk lines of authors (no SQL: JSON text)."""
    return ids.bulk_lines(table(spark, d, "author_occurrence"), "occurrence_id", "author_occurrence").select("_id", "line_no", "value")


@_query
def embed_text(spark: SparkSession, d: str) -> DataFrame:
    """Text for embedding of each publication."""
    t = text.embedding_text(F.col("title"), F.col("abstract"), [("Author keywords", F.col("author_keywords")), ("Keywords plus", F.col("keywords_plus"))])
    return table(spark, d, "publication").select("publication_id", t.alias("embedding_text"))


# folds


@_query
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    """The first delivered row of each publication id, and how many later ones it hides."""
    out = survivorship.first_rows(table(spark, d, "publication").select("publication_id", "created_at", "updated_at", "title", "publication_year"), ["publication_id"], ["created_at", "updated_at", "title"])
    return out.select("publication_id", "title", "publication_year", "n_later")


@_query
def coalesce_first(spark: SparkSession, d: str) -> DataFrame:
    """Matched persons folded: first known values, best ranks, or of flags."""
    df = table(spark, d, "person").where(F.col("canonical_person_id").isNotNull())
    rules = {"orcid": "first", "country": "first", "name_original": "first_row", "qs_top200_rank": "min", "matched_by_orcid": "any", "cluster_size": "max", "updated_at": "max"}
    return survivorship.fold(df, ["canonical_person_id"], ["updated_at", "person_id"], rules)


@_query
def max_score_best_decision(spark: SparkSession, d: str) -> DataFrame:
    """Highest score and best decision of each pair."""
    df = table(spark, d, "person_match_audit")
    pair = df.withColumn("a", F.least("candidate_a_id", "candidate_b_id")).withColumn("b", F.greatest("candidate_a_id", "candidate_b_id"))
    return survivorship.fold(pair, ["a", "b"], ["decided_at"], {"score": "max", "decision": "best:merge>manual_review>blocked_conflict"})


@_query
def sorted_set_union(spark: SparkSession, d: str) -> DataFrame:
    """All key words of each matched person."""
    df = table(spark, d, "person").where(F.col("canonical_person_id").isNotNull())
    out = survivorship.fold(df, ["canonical_person_id"], ["person_id"], {"keywords": "set"})
    return out.select("canonical_person_id", F.array_join("keywords", "|").alias("keywords"))


@_query
def ordered_union(spark: SparkSession, d: str) -> DataFrame:
    """Key words of each matched person in the order in which they were delivered."""
    df = table(spark, d, "person").where(F.col("canonical_person_id").isNotNull())
    out = survivorship.fold(df, ["canonical_person_id"], ["updated_at", "person_id"], {"keywords": "union"})
    return out.select("canonical_person_id", F.array_join("keywords", "|").alias("keywords"))


@_query
def min_rank(spark: SparkSession, d: str) -> DataFrame:
    """Best rank of each matched person."""
    return lookup.best_rank(table(spark, d, "person").where(F.col("canonical_person_id").isNotNull()), "canonical_person_id", ["qs_top200_rank", "world_top500_rank"])


@_query
def representative(spark: SparkSession, d: str) -> DataFrame:
    """The fullest record of each matched person."""
    df = table(spark, d, "person").where(F.col("canonical_person_id").isNotNull())
    filled = survivorship.density(*[F.col(c) for c in ("orcid", "country", "current_affiliation", "primary_email", "h_index", "articles")])
    trusted = F.array_contains("source_systems", "scholars").cast("int")
    return survivorship.representative(df, ["canonical_person_id"], [trusted, filled], "person_id")


@_query
def mode_country(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent country of each matched person."""
    df = table(spark, d, "person").where(F.col("canonical_person_id").isNotNull())
    return survivorship.most_common(df, ["canonical_person_id"], "country", ["updated_at", "person_id"])


@_query
def pk_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Records of a matched person that contradict what came before."""
    df = table(spark, d, "person").where(F.col("canonical_person_id").isNotNull())
    return survivorship.conflicts(df, ["canonical_person_id"], ["updated_at", "person_id"], ["country", "orcid", "h_index"]).where("n_conflicts > 0")


@_query
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    """Missing values of each column of persons."""
    return profile.profile(table(spark, d, "person").select("orcid", "country", "current_affiliation", "primary_email", "keywords", "h_index", "average_citations"))


@_query
def type_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """Texts that are no numbers where numbers are expected."""
    return profile.profile(table(spark, d, "publication").select("volume", "issue", "pubmed_id"), {"volume": "int", "issue": "int", "pubmed_id": "bigint"})


@_query
def label_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts by decision."""
    return profile.label_counts(table(spark, d, "person_match_audit"), "decision", ["merge", "manual_review", "blocked_conflict"])


@_query
def known_counts(spark: SparkSession, d: str) -> DataFrame:
    """Known values of the ranks."""
    return profile.hits(table(spark, d, "person"), ["qs_top200_rank", "world_top500_rank", "orcid"])


# lookups and matching


@_query
def unique_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Author of a publication by surname and initials, where one only fits, else by first initial."""
    a = table(spark, d, "author_occurrence").dropDuplicates(["occurrence_id"])
    full, short = F.concat_ws("|", F.lit("i"), "surname_norm", "initials"), F.concat_ws("|", F.lit("f"), "surname_norm", F.substring("initials", 1, 1))
    known = F.col("surname_norm").isNotNull() & F.col("initials").isNotNull()
    long = a.where(known).select("publication_id", "occurrence_id", F.explode(F.array(F.struct(full.alias("key"), F.lit(1).alias("priority"), F.lit("surname_initials").alias("rule")), F.struct(short.alias("key"), F.lit(2).alias("priority"), F.lit("surname_first_initial").alias("rule")))).alias("k")).select("publication_id", "occurrence_id", "k.*")
    return lookup.unique_lookup(long.withColumnRenamed("occurrence_id", "asked_id"), long.select("publication_id", "key", F.col("occurrence_id").alias("owner_id")), ["publication_id"], ["asked_id"], "owner_id")


@_query
def ranked_alias_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Rank of each affiliation by its aliases, where the country agrees or the list leaves no doubt."""
    q = table(spark, d, "qs_university")
    plain = F.regexp_replace("university", r"\([^()]*\)", " ")
    entries = q.select(text.normalize_text(plain).alias("alias"), "country", places.rank_value(F.col("rank_text")).alias("rank"))
    p = table(spark, d, "person").dropDuplicates(["person_id"]).where(F.col("current_affiliation").isNotNull())
    aff = F.col("current_affiliation")
    aliases = F.array_distinct(F.array_compact(F.array(text.normalize_text(aff), text.normalize_text(F.regexp_replace(aff, r"\([^()]*\)", " ")), text.normalize_text(F.substring_index(aff, ",", 1)))))
    listed = q.select("country").distinct()
    asked = p.select("person_id", aliases.alias("aliases"), "country").join(listed.withColumn("known", F.lit(True)), "country", "left").select("person_id", "aliases", F.when(F.col("known"), F.col("country")).alias("country"))
    return lookup.ranked_alias_lookup(asked, entries, "person_id").where(F.col("rank").isNotNull())


@_query
def domain_lookup(spark: SparkSession, d: str) -> DataFrame:
    """University of each mailbox by its domain."""
    q = table(spark, d, "qs_university").groupBy(F.col("domain").alias("email_domain")).agg(F.min(places.rank_value(F.col("rank_text"))).alias("rank"))
    p = table(spark, d, "person").dropDuplicates(["person_id"]).select("person_id", names.email_domain(F.col("primary_email")).alias("email_domain"))
    return p.join(q, "email_domain").select("person_id", "email_domain", "rank")


@_query
def lookup_with_synthesis(spark: SparkSession, d: str) -> DataFrame:
    """Persons of each corresponding author's name, or a made one."""
    a = table(spark, d, "author_occurrence").where("is_corresponding_author").dropDuplicates(["occurrence_id"]).select("occurrence_id", "author_name_norm")
    p = table(spark, d, "person").dropDuplicates(["person_id"])
    out = lookup.lookup_or_make(a, "author_name_norm", p, "name_norm", "person_id", F.sha1(F.concat(F.coalesce("author_name_norm", F.lit("")), F.lit("||"))))
    return out.withColumnRenamed("author_name_norm", "name")


@_query
def cascade_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Publication of each document: by id, else by identifier."""
    p = table(spark, d, "publication")
    by_id = p.groupBy("publication_id").agg(F.min("title").alias("title"))
    by_wos = p.where(F.col("ut_wos_id").isNotNull()).groupBy("ut_wos_id").agg(F.min("title").alias("title"))
    docs = table(spark, d, "documents").select("doc_id", "publication_id")
    return lookup.cascade_lookup(docs, [("publication_id", by_id, "publication_id", "title"), ("publication_id", by_wos, "ut_wos_id", "title")], "matched_title").select("doc_id", "matched_title")


@_query
def margin_top1(spark: SparkSession, d: str) -> DataFrame:
    """The kind of event that stands out for each user."""
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    total = e.groupBy("user_id").agg(F.sum("n").alias("total"))
    scored = e.join(total, "user_id").select("user_id", "event_type", F.round(F.col("n") / F.col("total"), 6).alias("score"))
    return lookup.top_with_margin(scored, ["user_id"], "event_type", "score", least=0.2, margin=0.02, sure=0.4)


@_query
def star_edges(spark: SparkSession, d: str) -> DataFrame:
    """Links between persons with the same ORCID."""
    return graph.star_edges(table(spark, d, "person").select("person_id", names.orcid(F.col("orcid")).alias("key")), "person_id", "key")


def _person_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "person").select(F.col("person_id").alias("node"), F.explode(F.array(F.concat(F.lit("n|"), "name_norm"), F.concat(F.lit("o|"), names.orcid(F.col("orcid"))))).alias("key"))
    return p.where(F.col("key").isNotNull()).distinct()


@_query
def blocked_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of persons that share a block of at most 50, as its SQL has it; blocked_pairs_whole has all."""
    pairs, _ = matching.blocked_pairs(_person_keys(spark, d), most=50)
    return pairs.select("a", "b", F.array_join("keys", ",").alias("keys"))


@_query
def blocked_pairs_whole(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of persons that share a block of any size, with the blocks (no SQL; tested on a fixture)."""
    pairs, _ = matching.blocked_pairs(_person_keys(spark, d), most=None)
    return pairs.select("a", "b", F.array_join("keys", ",").alias("keys"))


@_query
def skipped_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The blocks of more than 200 that pair_decisions and cluster_fold leave out, with their sizes (no SQL; tested on a fixture)."""
    _, large = matching.blocked_pairs(matching.block_keys(matching.nodes_of_persons(table(spark, d, "person"))))
    return large


@_query
def pair_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decisions on all blocked pairs of persons (no SQL; tested on a fixture)."""
    nodes = cut(matching.nodes_of_persons(table(spark, d, "person")), "nodes")
    pairs, _ = matching.blocked_pairs(matching.block_keys(nodes))
    return matching.decided_pairs(pairs, nodes)


@_query
def cluster_fold(spark: SparkSession, d: str) -> DataFrame:
    """Persons clustered by identifiers and decisions (no SQL; tested on a fixture)."""
    clusters, *_ = matching.cluster_persons(table(spark, d, "person"))
    return clusters.select("canonical_person_id", "representative", "cluster_size")


@_query
def components(spark: SparkSession, d: str) -> DataFrame:
    """Components of the merge decisions."""
    return graph.components(table(spark, d, "person_match_audit").where("decision = 'merge'"), "candidate_a_id", "candidate_b_id")


@_query
def phased_merges(spark: SparkSession, d: str) -> DataFrame:
    """How many components merges, then reviews, join."""
    a = table(spark, d, "person_match_audit").select(F.col("candidate_a_id").alias("a"), F.col("candidate_b_id").alias("b"), "decision")
    nodes = table(spark, d, "person").select("person_id").union(a.select("a")).union(a.select("b"))
    return graph.phased_merges(nodes, "person_id", [("merge", a.where("decision = 'merge'")), ("manual_review", a.where("decision = 'manual_review'"))])


@_query
def remap_relations(spark: SparkSession, d: str) -> DataFrame:
    """Author and publication of each matched person by name, each relation once."""
    a = table(spark, d, "author_occurrence").select("publication_id", "author_order", F.col("author_name_norm").alias("name_norm"))
    p = table(spark, d, "person").where(F.col("canonical_person_id").isNotNull() & F.col("name_norm").isNotNull()).groupBy("name_norm").agg(F.min("canonical_person_id").alias("canonical_person_id"))
    r = a.join(p, "name_norm").groupBy("canonical_person_id", "publication_id").agg(F.min("author_order").alias("author_order"))
    return r.select(ids.hashed_id(F.col("canonical_person_id"), F.col("publication_id"), F.lit("author")).alias("relation_id"), "canonical_person_id", "publication_id", "author_order")


@_query
def reconcile_orcid(spark: SparkSession, d: str) -> DataFrame:
    """Persons of one ORCID as one record under the id of the fullest."""
    p = table(spark, d, "person").dropDuplicates(["person_id"]).select("person_id", names.orcid(F.col("orcid")).alias("orcid"), "country", "h_index", "matched_by_orcid", "updated_at")
    filled = survivorship.density(F.col("country"), F.col("h_index"))
    merged, _ = matching.reconcile(p, p.select("person_id"), "orcid", "person_id", ["updated_at", "person_id"], {"orcid": "first", "country": "first", "matched_by_orcid": "any", "updated_at": "max"}, [filled])
    return merged.select("person_id", "orcid", "country", "matched_by_orcid", "updated_at")


@_query
def inferred_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of delivered pairs, made where there is none."""
    m = matching.match_score(F.when(F.col("decision") == "merge", F.col("score")), F.array_contains("rules_hit", "name_compact"), F.array_contains("rules_hit", "shared_institution"))
    return table(spark, d, "person_match_audit").select("candidate_a_id", "candidate_b_id", F.round(m["score"], 6).alias("match_score"), m["confidence"].alias("confidence"))


@_query
def relation_names(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of corresponding authors and all authors of a publication whose names agree (no SQL; names as in name_parts)."""
    a = table(spark, d, "author_occurrence").dropDuplicates(["occurrence_id"])
    full = a.select(F.col("occurrence_id").alias("node"), "publication_id", names.name_parts(F.col("author_name_raw")).alias("name"), F.coalesce("name_aliases", F.array().cast("array<string>")).alias("aliases"), "is_corresponding_author")
    full = cut(full, "named-authors")
    return matching.evidence_pairs(full.where("is_corresponding_author"), full).select("a", "b")


# vectors


@_query
def exact_knn(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    e = table(spark, d, "embeddings")
    near = vectors.nearest(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", k=10)
    return near.select("query_id", "vec_id", F.round("cosine", 4).alias("cosine"))


@_query
def vector_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the vector of their number, where it is whole."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), vectors.checked(F.col("embedding"), 64).alias("v"))
    return table(spark, d, "documents").select("doc_id").join(e, "doc_id", "left").select("doc_id", F.col("v").isNotNull().alias("has_vector"))


@_query
def embed_documents(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of publications from a hash embedder, with errors (no SQL: a pluggable function)."""
    p = table(spark, d, "publication").dropDuplicates(["publication_id"]).select("publication_id", text.embedding_text(F.col("title"), F.col("abstract"), []).alias("t"))
    return vectors.embed(p, "publication_id", "t", vectors.hash_embedder(64), 64)


# contacts and exports


@_query
def anchor_pick(spark: SparkSession, d: str) -> DataFrame:
    """The paper that stands for each author name."""
    a = table(spark, d, "author_occurrence").select("occurrence_id", "publication_id", "author_order", "author_name_norm", "is_corresponding_author").distinct()
    p = table(spark, d, "publication").groupBy("publication_id").agg(F.max("publication_year").alias("publication_year"), F.max("times_cited_wos_core").alias("times_cited"))
    ev = a.join(p, "publication_id").withColumn("similarity", F.lit(None).cast("double")).where(F.col("author_name_norm").isNotNull())
    return evidence.anchors(ev, "author_name_norm", "occurrence_id").select("author_name_norm", "occurrence_id", "n_evidences")


@_query
def contact_group(spark: SparkSession, d: str) -> DataFrame:
    """Contacts by mailbox and name."""
    p = table(spark, d, "person").dropDuplicates(["person_id"]).where(F.col("primary_email").isNotNull())
    key = evidence.contact_key(F.col("primary_email"), F.col("name_norm"))
    return p.groupBy(key.alias("contact")).agg(F.count("*").alias("n"), F.min("person_id").alias("first_id"))


@_query
def export_flat(spark: SparkSession, d: str) -> DataFrame:
    """Persons as an export shows them."""
    return evidence.flat(table(spark, d, "person").select("person_id", "keywords", "matched_by_orcid", "h_index"))


@_query
def email_score(spark: SparkSession, d: str) -> DataFrame:
    """How well each person's mailbox fits the name (no SQL: Ratcliff-Obershelp)."""
    p = table(spark, d, "person").select("person_id", names.name_parts(F.col("name_original")).alias("n"), names.email_local(F.get(names.valid_emails(F.col("primary_email")), F.lit(0))).alias("local")).where("local is not null")
    m = names.mailbox_score(names.mailbox_aliases(F.col("n"), F.lit(False)), F.col("local"), F.lit(False))
    return p.select("person_id", m.alias("m")).select("person_id", F.round("m.score", 4).alias("score"), F.array_join("m.rules", "+").alias("rules"))


@_query
def author_rows(spark: SparkSession, d: str) -> DataFrame:
    """Author lists put together and taken apart again, names with a semicolon included."""
    a = table(spark, d, "author_occurrence").dropDuplicates(["occurrence_id"])
    rows = a.groupBy("publication_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("author_order", "author_name_raw"))), lambda x: x["author_name_raw"]), "; ").alias("names"))
    return silver.authors(rows, "publication_id", "names").select("publication_id", "author_order", "author_name_norm", "surname_norm", "initials")


# from bronze to silver


@_query
def publication_projection(spark: SparkSession, d: str) -> DataFrame:
    """Publications made of export rows; lists are joined for comparison."""
    p = table(spark, d, "publication")
    rows = projection.cells_of(p, projection.PUBLICATION_FIELDS, F.get("source_refs", F.lit(0)))
    made = projection.publications(rows, F.col("updated_at"))
    lists = [c for c, (_, kind) in projection.PUBLICATION_FIELDS.items() if kind == "list"]
    plain = [F.concat_ws("|", c).alias(c) if c in lists else F.col(c) for c in ("publication_id", *projection.PUBLICATION_FIELDS)]
    return made.select(*plain, F.col("source_refs")[0]["source_file"].alias("source_file"), F.size(F.col("source_refs")[0]["raw_keys"]).alias("n_keys"), "updated_at")


@_query
def person_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Person records made of the rows of a profile list."""
    fields = projection.PERSON_FIELDS | {"name_original": ("name", "text"), "orcid": ("orcid", "text")}
    p = table(spark, d, "person").where(F.array_contains("source_systems", "scholars"))
    made = projection.person_seeds(projection.cells_of(p, fields, F.get("source_refs", F.lit(0))), F.col("updated_at"))
    return made.select("person_id", "name_norm", "orcid", "country", "current_affiliation", F.concat_ws("|", "subjects").alias("subjects"), "h_index", "total_citations", "articles", F.size("countries_observed").alias("n_countries"), "updated_at")


@_query
def publication_stability(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of author records of one compact name and one journal in different publications: the support that needs no identifier."""
    a = table(spark, d, "author_occurrence").dropDuplicates(["occurrence_id"])
    p = table(spark, d, "publication").where(F.col("source_title").isNotNull()).groupBy("publication_id").agg(F.min("source_title").alias("source_title"))
    key = text.normalize_compact(F.col("author_name_norm"))
    nodes = a.join(p, "publication_id").where("is_corresponding_author").select("occurrence_id", "publication_id", F.concat_ws("|", key, "source_title").alias("key")).where(key.isNotNull())
    sizes = nodes.groupBy("key").agg(F.countDistinct("publication_id").alias("n_publications"), F.count("*").alias("n_nodes"))
    return sizes.where("n_publications > 1")


# control tables and streams


def _files(df: DataFrame) -> DataFrame:
    refs = df.select(F.explode("source_refs").alias("r")).select("r.source_file", "r.row_index")
    return refs.groupBy(F.col("source_file").alias("path")).agg(F.count("*").alias("size"), F.max("row_index").alias("modified"), F.sha1(F.sum("row_index").cast("string")).alias("sha1"))


@_query
def manifest_diff(spark: SparkSession, d: str) -> DataFrame:
    """Files of all person rows against those of an earlier delivery (the matched ones)."""
    p = table(spark, d, "person")
    return control.manifest_diff(_files(p), _files(p.where(F.col("canonical_person_id").isNotNull()))).select("path", "state", "size")


@_query
def enqueue_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """Jobs to add for changed files when those of one stage exist."""
    p = table(spark, d, "person")
    changes = control.manifest_diff(_files(p), _files(p.where(F.col("canonical_person_id").isNotNull())))
    jobs = changes.select("path", "sha1", F.lit("bronze").alias("stage"))
    return control.enqueue(changes, jobs, ["bronze", "silver"]).select("path", "stage")


@_query
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Publications streamed from their files and folded by id, first known values by time."""
    source, target, checkpoint = (new_path(spark, x) for x in ("delivered", "upserted", "stream"))
    rows = table(spark, d, "publication")
    # three deliveries by a hash of the row: later ones bring earlier rows of known ids
    part = F.pmod(F.xxhash64("publication_id", "created_at", "title"), F.lit(3))
    for k in range(3):
        rows.where(part == k).write.mode("append").parquet(source)
    stream = incremental.new_files(spark, rows.schema, source, per_trigger=1)
    rules = {"title": "first", "publication_year": "first", "times_cited_wos_core": "max", "updated_at": "max"}
    upserted = incremental.Upserted(spark, target, ["publication_id"], ["created_at", "order_key"], rules)
    keyed = stream.withColumn("order_key", F.concat_ws("\u0001", F.coalesce("title", F.lit("")), F.coalesce(F.col("publication_year").cast("string"), F.lit(""))))
    incremental.run_available(keyed, checkpoint, upserted.add)
    return upserted.current().select("publication_id", "title", "publication_year", "times_cited_wos_core", "created_at", "updated_at")


def queries() -> dict[str, Query]:
    """Name -> query."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """Name -> SQL for DuckDB."""
    return dict(sql.ORACLES)
