"""From bronze rows (source_file, sheet, row_index, cells) to the publication and person records of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import hashed_id, publication_id
from ..functions.names import name_aliases, orcid
from ..functions.text import normalize_text, split_sorted, to_float, to_int

#: Field of a publication -> (header of the export, kind): texts as delivered, whole numbers, or values between semicolons.
PUBLICATION_FIELDS = {
    "doi": ("DOI", "text"), "doi_link": ("DOI Link", "text"), "ut_wos_id": ("UT (Unique WOS ID)", "text"), "pubmed_id": ("Pubmed Id", "text"),
    "title": ("Article Title", "text"), "abstract": ("Abstract", "text"), "document_type": ("Document Type", "text"), "publication_type": ("Publication Type", "text"),
    "publication_year": ("Publication Year", "int"), "publication_date_text": ("Publication Date", "text"), "volume": ("Volume", "text"), "issue": ("Issue", "text"),
    "article_number": ("Article Number", "text"), "number_of_pages": ("Number of Pages", "int"), "source_title": ("Source Title", "text"),
    "journal_abbr": ("Journal Abbreviation", "text"), "journal_iso_abbr": ("Journal ISO Abbreviation", "text"), "issn": ("ISSN", "text"), "eissn": ("eISSN", "text"),
    "language": ("Language", "text"), "publisher": ("Publisher", "text"), "publisher_city": ("Publisher City", "text"), "publisher_address": ("Publisher Address", "text"),
    "author_keywords": ("Author Keywords", "list"), "keywords_plus": ("Keywords Plus", "list"), "wos_categories": ("WoS Categories", "list"),
    "research_areas": ("Research Areas", "list"), "web_of_science_index": ("Web of Science Index", "list"), "times_cited_wos_core": ("Times Cited, WoS Core", "int"),
    "times_cited_all_db": ("Times Cited, All Databases", "int"), "usage_180d": ("180 Day Usage Count", "int"), "usage_since_2013": ("Since 2013 Usage Count", "int"),
    "open_access_designation": ("Open Access Designations", "text"), "funding_orgs": ("Funding Orgs", "list"), "funding_text": ("Funding Text", "text"),
}
#: Field of a person -> (header of the profile list, kind).
PERSON_FIELDS = {
    "country": ("countries", "text"), "current_affiliation": ("current_affiliation", "text"), "subjects": ("subjects", "list"), "keywords": ("keywords", "list"),
    "interests": ("interests", "list"), "h_index": ("h_index", "int"), "i10_index": ("i10_index", "int"), "total_citations": ("total_citations", "int"),
    "average_citations": ("average_citations", "float"), "articles": ("articles", "int"), "google_scholar_url": ("google_scholar", "text"), "sci_profile_url": ("sci_profile", "text"),
}


def cell(header: str, kind: str = "text") -> Column:
    """A cell of a bronze row, cast by its kind; what can't be cast is null."""
    raw = F.element_at("cells", F.lit(header))
    return {"text": lambda c: c, "int": to_int, "float": to_float, "list": split_sorted}[kind](raw)


def source_refs(system: str) -> Column:
    """Where a bronze row came from, as an array of one."""
    ref = F.struct(F.lit(system).alias("source_system"), F.col("source_file").alias("source_file"), F.col("sheet").alias("sheet"), F.col("row_index").cast("bigint").alias("row_index"), F.array_sort(F.map_keys("cells")).alias("raw_keys"))
    return F.array(ref)


def publications(rows: DataFrame, at: Column, system: str = "frontiers") -> DataFrame:
    """One publication for each bronze row: id, fields, ``source_refs``, both times. No row drops out; an id may repeat."""
    fields = {name: cell(*of) for name, of in PUBLICATION_FIELDS.items()}
    key = publication_id(*[fields[f] for f in ("doi", "ut_wos_id", "title", "publication_year", "source_title")])
    return rows.select(key.alias("publication_id"), *[c.alias(name) for name, c in fields.items()], source_refs(system).alias("source_refs"), at.alias("created_at"), at.alias("updated_at"))


def person_seeds(rows: DataFrame, at: Column, system: str = "scholars") -> DataFrame:
    """One person for each bronze row of a profile list with a name that has letters or digits; the id is a hash of name, ORCID and country."""
    named = rows.withColumn("_norm", normalize_text(cell("name"))).where(F.col("_norm").isNotNull())
    fields = {name: cell(*of) for name, of in PERSON_FIELDS.items()}
    known = orcid(cell("orcid"))
    none = F.expr("cast(array() as array<string>)")
    key = hashed_id(F.col("_norm"), known, fields["country"])
    return named.select(
        key.alias("person_id"),
        key.alias("canonical_person_id"),
        F.trim(cell("name")).alias("name_original"),
        F.col("_norm").alias("name_norm"),
        name_aliases(cell("name")).alias("name_aliases"),
        F.lit(False).alias("matched_by_orcid"),
        known.alias("orcid"),
        F.when(F.col("cells").isNotNull() & fields["country"].isNotNull(), F.array(fields["country"])).otherwise(none).alias("countries_observed"),
        *[c.alias(name) for name, c in fields.items()],
        F.lit(1).alias("cluster_size"),
        F.array(F.lit(system)).alias("source_systems"),
        source_refs(system).alias("source_refs"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )


def cells_of(df: DataFrame, fields: dict[str, tuple[str, str]], ref: Column) -> DataFrame:
    """Bronze rows made of a table whose columns hold what the headers of ``fields`` would, null cells left out; the way back of a projection."""
    pairs = F.array(*[F.struct(F.lit(h).alias("k"), (F.array_join(c, ";") if kind == "list" and df.schema[c].dataType.simpleString() != "string" else F.col(c).cast("string")).alias("v")) for c, (h, kind) in fields.items()])
    cells = F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))
    return df.select(ref["source_file"].alias("source_file"), ref["sheet"].alias("sheet"), ref["row_index"].alias("row_index"), cells.alias("cells"), "updated_at")
