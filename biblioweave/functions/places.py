"""Addresses, countries, institutions, domains and ranks, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, empty_to_null, normalize_text, split_ordered, strip_space

#: Short forms that institution names are compared in full. Fixed values.
EXPANSIONS = {
    "univ": "university", "inst": "institute", "tech": "technology", "coll": "college", "acad": "academy", "med": "medical",
    "sci": "science", "ctr": "center", "dept": "department", "sch": "school",
}
#: Words that institution names are compared without. Fixed values.
STOPWORDS = ("of", "the", "at", "for", "and")
#: Endings under which a registration has three labels. Fixed values.
PUBLIC_SUFFIXES = (
    "com.cn", "edu.cn", "gov.cn", "org.cn", "ac.uk", "co.uk", "org.uk", "gov.uk", "com.au", "edu.au", "org.au", "com.br",
    "com.mx", "co.jp", "com.sg",
)
#: Normalised country names of rankings and addresses, and the name they stand for. Fixed values.
COUNTRY_NAMES = {
    "united states": "United States", "united states of america": "United States", "peoples r china": "China",
    "people s r china": "China", "china": "China", "中华人民共和国": "China", "中国": "China", "hong kong": "Hong Kong",
    "macao": "Macau", "macau": "Macau", "usa": "United States", "u s a": "United States", "us": "United States",
    "美国": "United States", "uk": "United Kingdom", "u k": "United Kingdom", "england": "United Kingdom",
    "scotland": "United Kingdom", "wales": "United Kingdom", "英国": "United Kingdom", "德国": "Germany", "法国": "France",
    "日本": "Japan", "韩国": "South Korea", "荷兰": "Netherlands", "瑞士": "Switzerland", "瑞典": "Sweden", "加拿大": "Canada",
    "澳大利亚": "Australia", "印度": "India", "新加坡": "Singapore", "沙特阿拉伯": "Saudi Arabia",
    "阿联酋": "United Arab Emirates", "阿拉伯联合酋长国": "United Arab Emirates", "爱尔兰": "Ireland", "西班牙": "Spain",
    "意大利": "Italy", "比利时": "Belgium", "丹麦": "Denmark", "挪威": "Norway", "芬兰": "Finland", "巴西": "Brazil",
    "墨西哥": "Mexico", "土耳其": "Turkey", "泰国": "Thailand", "马来西亚": "Malaysia", "印度尼西亚": "Indonesia",
}


def institution_of(address: Column) -> Column:
    """The text before the first comma."""
    return empty_to_null(F.regexp_replace(F.substring_index(address, ",", 1), r"^[ .]+|[ .]+$", ""))


def country_text(c: Column, names: dict[str, str] | None = None) -> Column:
    """A typed country without postcodes and closing signs, in the list's form where the list knows it."""
    cleaned = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\b\d{4,}\b", " "), r"[.;]+$", ""), r"^[ ,]+|[ ,]+$", "")
    cleaned = strip_space(cleaned)
    known = normalize_text(cleaned)
    if names:
        table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        return F.when(known.isNotNull(), F.coalesce(F.element_at(table, known), cleaned))
    return F.when(known.isNotNull(), empty_to_null(cleaned))


def ranking_country(c: Column) -> Column:
    """The name that ``COUNTRY_NAMES`` has for a typed country, else the text itself, trimmed; null for one without letters or digits."""
    table = F.create_map(*[F.lit(x) for pair in COUNTRY_NAMES.items() for x in pair])
    known = normalize_text(c)
    return F.when(known.isNotNull(), F.coalesce(F.element_at(table, known), strip_space(c)))


def country_of(address: Column, names: dict[str, str] | None = None) -> Column:
    """The last piece of an address that is no postcode, as ``country_text``."""
    pieces = F.transform(F.split(F.translate(address, ";", ","), ","), lambda t: F.regexp_replace(t, r"^[ .]+|[ .]+$", ""))
    kept = F.filter(F.reverse(pieces), lambda t: (t != "") & ~t.rlike(r"(?i)^[A-Z]?\d[\dA-Z -]*$") & country_text(t, names).isNotNull())
    return country_text(F.get(kept, F.lit(0)), names)


def address_segments(segments: Column) -> Column:
    """Array of (names, address) of the segments ``[name; name] address``; others drop out."""
    pattern = r"^\s*\[([^\]]+)\]\s*(.*)$"
    own = F.filter(segments, lambda s: s.rlike(pattern))
    return F.transform(
        own,
        lambda s: F.struct(split_ordered(F.regexp_extract(s, pattern, 1)).alias("names"), F.regexp_replace(F.regexp_extract(s, pattern, 2), r"^[ ,.]+|[ ,.]+$", "").alias("address")),
    )


def reprint_segments(segments: Column) -> Column:
    """Array of (name, address, is_corresponding) of ``name (role), address`` or ``Last, First, address``."""
    role, plain = r"(?s)^([^(]*)\([^)]*\)(.*)$", r"(?s)^\s*([^,]+,\s*[^,]+)\s*,\s*(.*)$"

    def one(s: Column) -> Column:
        with_role = s.rlike(role)
        name = F.when(with_role, F.regexp_extract(s, role, 1)).otherwise(F.regexp_extract(s, plain, 1))
        rest = F.when(with_role, F.regexp_extract(s, role, 2)).otherwise(F.regexp_extract(s, plain, 2))
        trim = r"^[ ,]+|[ ,]+$"
        return F.struct(F.regexp_replace(name, trim, "").alias("name"), F.regexp_replace(rest, trim, "").alias("address"), F.contains(F.lower(s), F.lit("corresponding author")).alias("is_corresponding"))

    return F.filter(F.transform(segments, one), lambda x: x["name"] != "")


def expanded_tokens(c: Column, drop_stopwords: bool = False) -> Column:
    """Normalised words with short forms in full, joined by spaces; optionally without stop words."""
    table = F.create_map(*[F.lit(x) for pair in EXPANSIONS.items() for x in pair])
    tokens = F.transform(F.split(F.coalesce(normalize_text(c), F.lit("")), " "), lambda t: F.coalesce(F.element_at(table, t), t))
    if drop_stopwords:
        tokens = F.filter(tokens, lambda t: ~t.isin(*STOPWORDS))
    return empty_to_null(F.array_join(F.filter(tokens, lambda t: t != ""), " "))


def institution_aliases(c: Column) -> Column:
    """Forms of an institution's name in order of trust: whole, pieces, without and inside brackets, expanded, without stop words."""

    def forms(x: Column) -> Column:
        plain = F.regexp_replace(x, r"\([^()]*\)", " ")
        inside = F.regexp_extract(x, r"\(([^()]*)\)", 1)
        pieces = F.transform(F.split(x, r"[,;\n]"), normalize_text)
        listed = F.array(normalize_text(x), bound(plain, normalize_text), bound(inside, normalize_text), expanded_tokens(x), bound(plain, expanded_tokens), expanded_tokens(x, True), bound(plain, lambda y: expanded_tokens(y, True)))
        return F.array_distinct(F.array_compact(F.concat(F.slice(listed, 1, 1), pieces, F.slice(listed, 2, 6))))

    return bound(c, forms)


def host(c: Column) -> Column:
    """The host of an address of a page or mailbox, in lower case without ``www.``, brackets, quotes and what follows them."""
    t = F.regexp_replace(F.lower(strip_space(c)), r"(?U)^[\s\"'(\[<]+", "")
    t = F.regexp_replace(t, r"^[a-z][a-z0-9+.-]*://", "")
    t = F.regexp_replace(F.regexp_replace(t, r"^[^@/]*@", ""), r"(?Us)[/?#:\s<>()\[\]\"',;].*$", "")
    return empty_to_null(F.regexp_replace(F.regexp_replace(t, r"^www\.", ""), r"^\.+|\.+$", ""))


def registrable_domain(c: Column) -> Column:
    """The last two labels of the host, or three under the endings of ``PUBLIC_SUFFIXES``; null for a single label."""
    labels = F.filter(F.split(host(c), r"\."), lambda x: x != "")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    long = two.isin(*PUBLIC_SUFFIXES) & (F.size(labels) >= 3)
    return F.when(F.size(labels) >= 2, F.when(long, F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), ".")).otherwise(two))


def rank_value(c: Column) -> Column:
    """``=17`` is 17; anything but digits is null."""
    t = F.regexp_replace(strip_space(c), r"^=+\s*", "")
    return F.when(t.rlike(r"^\d{1,9}$"), t.try_cast("int"))
