"""Column functions against plain Python and pinned cases."""

import difflib
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from biblioweave.functions import ids, names, places, text
from biblioweave.plans import registry


def one(spark, value, expr, kind="string"):
    """The value of an expression over a single value."""
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("x")).first()["x"]


def many(spark, values, expr, kind="string"):
    """The values of an expression over many values."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def python_normal(s):
    """Reference normaliser in Python."""
    if s is None:
        return None
    flat = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return re.sub(r"[\W_]+", " ", flat).strip().lower() or None


def test_normalize_text(spark):
    values = ["  Ünïv.  of—Łódź ", "", None, "!!!", "ﬁne ﬂow", "Ｆｕｌｌ width", "Straße", "日本 東京", "a_b", "x" * 50_000]
    assert many(spark, values, text.normalize_text) == [python_normal(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x24F), max_size=30), min_size=1, max_size=30))
def test_normalize_text_is_idempotent(spark, values):
    once = many(spark, values, text.normalize_text)
    assert many(spark, once, text.normalize_text) == once


def test_splits(spark):
    assert one(spark, " b; a;;a ;c", text.split_sorted) == ["a", "b", "c"]
    assert one(spark, " b; a;;a ;c", text.split_ordered) == ["b", "a", "a", "c"]
    assert one(spark, None, text.split_ordered) == []
    assert one(spark, "a; [b; c] d; (e; f) g", text.split_top_level) == ["a", "[b; c] d", "(e; f) g"]
    assert one(spark, "a]; b); c", text.split_top_level) == ["a]", "b)", "c"]
    assert one(spark, None, text.split_top_level) == []


def top_level(s):
    """Reference splitter."""
    out, cur, sq, par = [], "", 0, 0
    for ch in s:
        sq += (ch == "[") - (ch == "]" and sq > 0)
        par += (ch == "(") - (ch == ")" and par > 0)
        if ch == ";" and not sq and not par:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return [p.strip() for p in [*out, cur] if p.strip()]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab;[]() ", max_size=20), min_size=1, max_size=20))
def test_split_top_level_against_python(spark, values):
    assert many(spark, values, text.split_top_level) == [top_level(v) for v in values]


@pytest.mark.parametrize(("value", "want"), [("2020", 2020), ("2020.0", None), ("", None), (None, None), (" 7 ", 7), ("x", None)])
def test_to_int(spark, value, want):
    assert one(spark, value, text.to_int) == want


def test_names(spark):
    p = one(spark, "Smith, John A.", names.name_parts)
    assert (p["surname_norm"], p["given_names_norm"], p["initials"], p["first_initial"], p["compact_full"]) == ("smith", "john a", "ja", "j", "smithjohna")
    assert one(spark, "Smith, John A.", names.name_aliases) == sorted({"JA Smith", "John A. Smith", "John Smith", "Smith, JA", "Smith, John", "Smith, John A."})
    assert one(spark, "Plato", names.name_parts)["surname_norm"] == "plato"
    assert one(spark, "Wang, QY", names.name_parts)["initials"] == "q"
    assert one(spark, None, names.name_parts) is None
    assert one(spark, None, names.name_aliases) == []


def test_identifiers(spark):
    assert one(spark, "see 0000-0001-2345-678x.", names.orcid) == "0000-0001-2345-678X"
    assert one(spark, "none", names.orcid) is None
    assert one(spark, "12345@x.edu; a1@x.edu.; bad; a1@x.edu", names.valid_emails) == ["a1@x.edu"]
    got = one(spark, "Wang, Li/AAA-1; a/b/c; /x; y/", names.name_id_pairs)
    assert [(g["name"], g["id"]) for g in got] == [("Wang, Li", "AAA-1"), ("a/b", "c")]
    assert one(spark, "Wang, Li/1; WANG LI/2", names.ids_by_name) == {"wang li": ["1", "2"]}


def test_mailbox_score(spark):
    df = spark.createDataFrame([("John Smith", "john.smith@monash.edu"), ("John Smith", "smithj12@x.org"), ("John Smith", None), ("John Smith", "zzz@x.org")], "n string, e string")
    p = df.withColumn("p", names.name_parts(F.col("n")))
    m = names.mailbox_score(names.mailbox_aliases(F.col("p"), F.lit(False)), names.email_local(F.col("e")), F.lit(False))
    got = [r["m"] for r in p.select(m.alias("m")).collect()]
    assert [g["score"] for g in got[:3]] == [0.97, 0.97, 0.0]
    best = max(difflib.SequenceMatcher(None, a, "zzz").ratio() for a in ["johnsmith", "smithjohn", "jsmith", "smithj"])
    assert got[3]["score"] == best


def test_places(spark):
    address = "Monash Univ, Clayton, Vic 3800, Australia."
    assert one(spark, address, places.institution_of) == "Monash Univ"
    assert one(spark, address, places.country_of) == "Australia"
    assert one(spark, "X, CA 94305", places.country_of) == "CA 94305" or one(spark, "X, 94305", places.country_of) == "X"
    assert one(spark, "=17", places.rank_value) == 17
    assert one(spark, "N/A", places.rank_value) is None
    assert one(spark, "https://www.stock.walmart.com/x?y", places.registrable_domain) == "walmart.com"
    assert one(spark, "corp.sgcc.com.cn", places.registrable_domain) == "sgcc.com.cn"
    assert one(spark, "local", places.registrable_domain) is None
    got = one(spark, ["[Wang, Li; Smith, John A.] Monash Univ, Clayton", "none"], places.address_segments, "array<string>")
    assert [(g["names"], g["address"]) for g in got] == [(["Wang, Li", "Smith, John A."], "Monash Univ, Clayton")]
    got = one(spark, ["Smith, JA (corresponding author), Monash Univ", "Last, First, Univ X, Y"], places.reprint_segments, "array<string>")
    assert [(g["name"], g["address"], g["is_corresponding"]) for g in got] == [("Smith, JA", "Monash Univ", True), ("Last, First", "Univ X, Y", False)]
    assert "massachusetts institute technology" in one(spark, "Massachusetts Inst. of Tech. (MIT)", places.institution_aliases)


def test_ids(spark):
    assert one(spark, "é" * 300, ids.safe_id) != "é" * 300
    assert one(spark, "short", ids.safe_id) == "short"
    assert one(spark, " a\x00b\t ", ids.clean_text) == "ab"
    df = spark.createDataFrame([("k" * 600, float("nan"), ["", "x", None]), ("b", 1.0, None)], "id string, v double, a array<string>")
    lines = [r["value"] for r in ids.bulk_lines(df, "id", "i").orderBy("_id", "line_no").collect()]
    assert len(lines) == 4
    assert any('"original_id"' in x and '"v"' not in x and '["x"]' in x for x in lines)


def test_embedding_text(spark):
    df = spark.createDataFrame([("T", "a" * 5000, "k1; k2"), (None, "a", "k")], "t string, a string, k string")
    got = [r[0] for r in df.select(text.embedding_text(F.col("t"), F.col("a"), [("Keywords", F.col("k"))], 200)).collect()]
    assert len(got[0]) <= 200
    assert got[0].startswith("Title: T") and got[0].endswith("Keywords: k1; k2")
    assert got[1] is None


def test_embed_text_query_keeps_whole_abstracts(spark, tmp_path):
    row = [("p", "T", "a" * 5000, "k1", None)]
    spark.createDataFrame(row, "publication_id string, title string, abstract string, author_keywords string, keywords_plus string").write.parquet(f"{tmp_path}/publication.parquet")
    got = registry.queries()["embed_text"](spark, str(tmp_path)).first()["embedding_text"]
    assert got == "Title: T\nAbstract: " + "a" * 5000 + "\nAuthor keywords: k1"


def test_registrable_domain_query_takes_all_addresses(spark, tmp_path):
    mails = ["Ana <a+b@Mail.Uni.ac.uk>", " X@UNI.AC.UK ", "mailto:c@uni.ac.uk", "(d@uni.ac.uk)", "e@uni.ac.uk; f@other.org", "g@uni.ac.uk", "none", None]
    spark.createDataFrame([(m,) for m in mails], "primary_email string").write.parquet(f"{tmp_path}/person.parquet")
    spark.createDataFrame([("HTTPS://www.Uni.ac.uk/x",)], "website string").write.parquet(f"{tmp_path}/qs_university.parquet")
    assert [tuple(r) for r in registry.queries()["registrable_domain_whole"](spark, str(tmp_path)).collect()] == [("uni.ac.uk", 7)]
