"""From a delivered row of a publication export to authors and their claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import hashed_id
from ..functions.names import email_domain, email_local, mailbox_aliases, mailbox_score, name_aliases, name_id_pairs, name_parts, orcid, valid_emails
from ..functions.places import address_segments, country_of, institution_of, reprint_segments
from ..functions.text import normalize_compact, normalize_text, split_ordered, split_top_level
from ..operators.lookup import top_with_margin, unique_lookup


def authors(rows: DataFrame, pub: str, names: str) -> DataFrame:
    """One row for each author in order; a name that can't be read drops out and leaves its number unused."""
    each = rows.select(pub, F.posexplode(split_ordered(F.col(names))).alias("p", "author_name_raw"))
    parsed = each.withColumn("name", name_parts(F.col("author_name_raw"))).where(F.col("name.name_norm").isNotNull())
    order = (F.col("p") + 1).cast("int")
    return parsed.select(
        hashed_id(F.col(pub), order, F.col("name.name_norm")).alias("occurrence_id"),
        pub,
        order.alias("author_order"),
        "author_name_raw",
        F.col("name.name_norm").alias("author_name_norm"),
        "name.surname_norm",
        "name.given_names_norm",
        "name.initials",
        "name.first_initial",
        "name.compact_full",
        name_aliases(F.col("author_name_raw")).alias("name_aliases"),
    )


def _keys(parts: Column, aliases: Column) -> Column:
    forms = F.concat(F.array(parts["name_norm"], parts["compact_full"]), F.transform(aliases, normalize_text), F.transform(aliases, normalize_compact))
    exact = F.transform(F.array_distinct(F.array_compact(forms)), lambda k, i: F.struct(F.concat(F.lit("x|"), k).alias("key"), i.alias("priority"), F.lit("exact_name").alias("rule")))
    initials = F.struct(F.concat(F.lit("i|"), parts["surname_norm"], F.lit("|"), parts["initials"]).alias("key"), F.lit(1000).alias("priority"), F.lit("surname_initials").alias("rule"))
    first = F.struct(F.concat(F.lit("f|"), parts["surname_norm"], F.lit("|"), parts["first_initial"]).alias("key"), F.lit(1001).alias("priority"), F.lit("surname_first_initial").alias("rule"))
    return F.concat(exact, F.array(initials, first))


def resolve_names(asked: DataFrame, of: DataFrame, pub: str) -> DataFrame:
    """asked (pub, asked_id, raw_name) with occurrence_id, rule and score: by the first key that one author only has."""
    wanted = asked.withColumn("name", name_parts(F.col("raw_name"))).where(F.col("name.name_norm").isNotNull())
    long = wanted.select(pub, "asked_id", F.explode(_keys(F.col("name"), name_aliases(F.col("raw_name")))).alias("k")).select(pub, "asked_id", "k.key", "k.priority", "k.rule")
    own = F.struct(F.col("author_name_norm").alias("name_norm"), "compact_full", "surname_norm", "initials", "first_initial")
    index = of.select(pub, "occurrence_id", F.explode(_keys(own, F.col("name_aliases"))).alias("k")).select(pub, "k.key", "occurrence_id")
    found = unique_lookup(long, index, [pub], ["asked_id"], "occurrence_id")
    score = F.when(F.col("rule") == "exact_name", 1.0).when(F.col("rule") == "surname_initials", 0.94).otherwise(0.82)
    return asked.join(found, [pub, "asked_id"]).withColumn("score", score)


def identifier_claims(rows: DataFrame, of: DataFrame, pub: str, orcids: str, others: str) -> DataFrame:
    """Identifiers that belong to one author: claim_type, claim_value, rule and score."""
    each = F.concat(F.transform(name_id_pairs(F.col(orcids)), lambda x: F.struct(F.lit("orcid").alias("t"), x["name"].alias("name"), x["id"].alias("id"))), F.transform(name_id_pairs(F.col(others)), lambda x: F.struct(F.lit("researcher_id").alias("t"), x["name"].alias("name"), x["id"].alias("id"))))
    asked = rows.select(pub, F.posexplode(each).alias("asked_id", "x")).select(pub, "asked_id", F.col("x.name").alias("raw_name"), F.col("x.t").alias("claim_type"), F.when(F.col("x.t") == "orcid", orcid(F.col("x.id"))).otherwise(F.col("x.id")).alias("claim_value")).where(F.col("claim_value").isNotNull())
    found = resolve_names(asked, of, pub)
    return found.select(hashed_id(F.col(pub), F.col("occurrence_id"), F.col("claim_type"), F.col("claim_value"), F.col("raw_name"), F.col("rule")).alias("claim_id"), "occurrence_id", pub, "claim_type", "claim_value", F.col("raw_name").alias("matched_name_raw"), F.col("rule").alias("match_rule"), "score", F.when(F.col("score") >= 0.9, "high").otherwise("medium").alias("confidence")).dropDuplicates(["claim_id"])


def affiliation_claims(rows: DataFrame, of: DataFrame, pub: str, addresses: str, reprints: str) -> DataFrame:
    """Addresses of each author, the corresponding one's first: institution, country and where they stand."""
    a = rows.select(pub, F.posexplode(address_segments(split_top_level(F.col(addresses)))).alias("seg", "x")).select(pub, "seg", F.posexplode("x.names").alias("n", "raw_name"), F.col("x.address").alias("address"))
    a = a.select(pub, F.concat(F.lit("a"), "seg", F.lit("_"), "n").alias("asked_id"), "raw_name", "address", F.lit("Addresses").alias("source_field"), F.lit(False).alias("is_reprint"), F.lit(False).alias("is_corresponding"))
    r = rows.select(pub, F.posexplode(reprint_segments(split_top_level(F.col(reprints)))).alias("seg", "x"))
    r = r.select(pub, F.concat(F.lit("r"), "seg").alias("asked_id"), F.col("x.name").alias("raw_name"), F.col("x.address").alias("address"), F.lit("Reprint Addresses").alias("source_field"), F.lit(True).alias("is_reprint"), F.col("x.is_corresponding").alias("is_corresponding"))
    found = resolve_names(a.unionByName(r), of, pub)
    institution = institution_of(F.col("address"))
    return found.select(hashed_id(F.col(pub), F.col("occurrence_id"), F.col("source_field"), F.col("address"), institution).alias("claim_id"), "occurrence_id", pub, "source_field", institution.alias("institution"), F.col("address").alias("address_text"), country_of(F.col("address")).alias("country_norm"), "is_reprint", "is_corresponding", "score", F.when(F.col("score") >= 0.9, "high").otherwise("medium").alias("confidence"))


def email_claims(rows: DataFrame, of: DataFrame, affiliations: DataFrame, pub: str, emails: str) -> DataFrame:
    """Mailboxes bound to authors: the only one to the only corresponding author, else by likeness with a margin."""
    each = rows.select(pub, valid_emails(F.col(emails)).alias("es")).withColumn("n_emails", F.size("es")).select(pub, "n_emails", F.explode("es").alias("email"))
    corresponding = affiliations.where("is_corresponding").select(pub, "occurrence_id").distinct()
    counts = corresponding.groupBy(pub).agg(F.count("*").alias("n_corr"))
    people = of.join(corresponding.withColumn("is_corr", F.lit(True)), [pub, "occurrence_id"], "left").join(counts, pub, "left")
    usable = people.where(F.coalesce("is_corr", F.lit(False)) | F.col("n_corr").isNull())
    both = each.join(usable, pub)
    sole = both.where("n_emails = 1 and n_corr = 1").select(pub, "occurrence_id", "email", F.lit("unique_corresponding_author").alias("binding_rule"), F.lit(0.99).alias("score"))
    parts = F.struct(F.col("compact_full"), "surname_norm", "given_names_norm", "initials", "first_initial")
    rest = both.where("not (n_emails = 1 and coalesce(n_corr, 0) = 1)").withColumn("m", mailbox_score(mailbox_aliases(parts, F.lit(False)), email_local(F.col("email")), F.lit(False)))
    top = top_with_margin(rest.select(pub, "email", "occurrence_id", "author_order", F.col("m.score").alias("score"), F.col("m.rules").alias("rules")), [pub, "email"], "author_order", "score")
    bound = top.select(pub, "occurrence_id", "email", F.array_join("rules", "+").alias("binding_rule"), F.round("score", 4).alias("score"))
    out = sole.unionByName(bound)
    return out.select(hashed_id(F.col(pub), F.col("occurrence_id"), F.lit("email"), F.col("email")).alias("claim_id"), "occurrence_id", pub, "email", email_domain(F.col("email")).alias("email_domain"), "binding_rule", "score", F.when(F.col("score") >= 0.97, "high").otherwise("medium").alias("confidence"))
