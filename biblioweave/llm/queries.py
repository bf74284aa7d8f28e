"""Registered queries of this subpackage, with production parameters over whole tables, and SQL for those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table
from . import abuse, canonical, components, crosslink, ledger, mixing, packing, spellings, survivor

Query = Callable[[SparkSession, str], DataFrame]
PERSON_FIELD_NAMES = ["primary_email", "current_affiliation", "country", "h_index"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The row whose value survives, for each matched person and field."""
    return survivor.surviving_fields(p1_survivors(spark, d), "canonical_person_id", "person_id", PERSON_FIELD_NAMES)


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    """One surviving record for each matched person, each field with the row and the layer it came from."""
    return survivor.person_survivors(table(spark, d, "person"), table(spark, d, "source_system_ref"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Publications that stand in at least two rows."""
    return p2_ledger(spark, d).where("copies > 1").select("keep_id", "copies")


def p2_ledger(spark: SparkSession, d: str) -> DataFrame:
    """All publications with the number of their rows, the smallest id and the earliest time seen."""
    return ledger.publication_ledger(table(spark, d, "publication")).select("keep_id", "copies", "first_at")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one person in one source whose names are written differently."""
    return spellings.spelled_differently(table(spark, d, "person"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one person in different sources."""
    return crosslink.linked_ids(table(spark, d, "person"))


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    """The same with a confidence for each pair."""
    return crosslink.linked_people(table(spark, d, "person"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Entry meant by each typed country and affiliation."""
    return canonical.map_person(table(spark, d, "person"), table(spark, d, "country_ref"), table(spark, d, "qs_university"))


def p5_rates(spark: SparkSession, d: str) -> DataFrame:
    """Matched and unmatched values of each field."""
    return p5_found(spark, d).groupBy("field_name").agg(F.count("*").alias("n_values"), F.count_if(F.col("ref_id") == canonical.UNMATCHED).alias("n_unmatched"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of persons that merge decisions link, directly or through others."""
    return components.merged_persons(table(spark, d, "person_match_audit"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """The groups against what the earlier run recorded."""
    return components.group_report(cut(p6_found(spark, d), "groups"), table(spark, d, "person"))


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    """Documents in containers of each capacity."""
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "container_ref"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Unused space of each kind of container."""
    return packing.fill_report(p8_pack(spark, d))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The selection in which each source makes up its share of all tokens."""
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached."""
    return mixing.shares_report(p9_mix(spark, d), table(spark, d, "mix_target"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are abusive themselves."""
    return abuse.abusive(p10_scores(spark, d)).select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """A score for every document."""
    return abuse.score_texts(table(spark, d, "documents"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates of abusive documents by source."""
    return abuse.rates(p10_scores(spark, d))


def queries() -> dict[str, Query]:
    """Name -> query."""
    names = ["p1_found", "p1_survivors", "p2_found", "p2_ledger", "p3_found", "p4_found", "p4_links", "p5_found", "p5_rates", "p6_found", "p6_report", "p8_pack", "p8_fill", "p9_mix", "p9_shares", "p10_found", "p10_scores", "p10_rates"]
    return {n: globals()[n] for n in names}


def oracle_sql() -> dict[str, str]:
    """Name -> SQL for DuckDB."""
    from . import sql

    return sql.ORACLES
