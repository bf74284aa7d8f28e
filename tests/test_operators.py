"""Operators of the core on small cases."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from biblioweave.operators import evidence, graph, lookup, matching, profile, search, survivorship, vectors
from biblioweave.operators.packed_fields import parse, parses, split_packed
from biblioweave.plans import registry, silver
from biblioweave.plans.registry import group, rule


def rows(df):
    """Rows as sorted tuples."""
    return sorted(map(tuple, df.collect()), key=repr)


# packed fields


def test_parse():
    assert parse('"a; b"; c;; d', (";",), True) == ["a; b", "c", "d"]
    assert parse('"say ""x"""; y', (";",), True) == ['say "x"', "y"]
    assert parse("men's health; 'a|b'", (";",), True) == ["men's health", "a|b"]
    assert parse('"open; b', (";",), True) == ['"open', "b"]
    assert parse("", (";",), True) == []


VOCABULARY = ["alpha beta", "gamma", "delta, minor", "x/y relations", "r&d policy", "it's", "epsilon"]


def test_split_packed_finds_dialects(spark):
    rnd = random.Random(3)
    data, want = [], set()
    for i in range(300):
        values = rnd.sample(VOCABULARY, rnd.randint(2, 5))
        d = rnd.choice(["; ", ";", " | ", "\n", ", "])
        quote = (lambda v: f'"{v}"') if rnd.random() < 0.2 else (lambda v: f'"{v}"' if "," in v and d == ", " else v)
        data.append((str(i), d.join(map(quote, values)), None, "y"))
        want |= {(str(i), "k", p + 1, v) for p, v in enumerate(values)}
    data += [("n", None, None, "y"), ("e", "  ", None, "y"), ("s", "gamma", None, "y"), data[0]]
    df = spark.createDataFrame(data, "id string, k string, other string, pos string")
    got = set(rows(split_packed(df, "id", ["k", "other"], 2)))
    assert len(want ^ got) <= 0.02 * len(want)
    assert ("s", "k", 1, "gamma") in set(rows(split_packed(df, "id", ["k"])))


def test_all_sets_of_many_delimiters_are_parsed():
    text = "a, b; c、d|e；f，g·h"
    assert ["a, b", "c、d", "e", "f，g·h"] in [items for _, items in parses(text)]


def test_split_packed_wrapped_and_empty(spark):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(['["gamma", "alpha beta"]', '"gamma; alpha beta; epsilon"', "; gamma;; epsilon ;", "gamma; alpha beta", "epsilon; gamma", "alpha beta; gamma"])], "id string, k string")
    got = {}
    for i, _, p, v in rows(split_packed(df, "id", ["k"], 2)):
        got.setdefault(i, []).append((p, v))
    assert [v for _, v in sorted(got["0"])] == ["gamma", "alpha beta"]
    assert [v for _, v in sorted(got["1"])] == ["gamma", "alpha beta", "epsilon"]
    assert [v for _, v in sorted(got["2"])] == ["gamma", "epsilon"]
    assert split_packed(df.where("false"), "id", ["k"]).count() == 0


# search


@pytest.fixture(scope="module")
def library(spark):
    """A small table with every kind of field."""
    data = [
        (1, "A Study of Remote Sensing", 2020, ["x", "y"], [("s", 5), ("t", 20)], True, dt.datetime(2020, 1, 1)),
        (2, "Sensing, remote", 2019, ["z"], [("s", 20)], False, None),
        (3, None, None, None, None, None, dt.datetime(2021, 1, 1)),
        (4, "other", 2021, [], [], True, None),
    ]
    df = spark.createDataFrame(data, "id int, title string, year int, tags array<string>, refs array<struct<sys string, n int>>, ok boolean, at timestamp")
    return df, search.entity("library", df.schema, "id", texts=["title"], default_sort=[("year", "desc")])


@pytest.mark.parametrize(
    ("tree", "want"),
    [
        ({}, [1, 2, 3, 4]),
        (group("and"), [1, 2, 3, 4]),
        (group("and", rule("", "")), [1, 2, 3, 4]),
        (group("and", rule("title", "match_phrase", value="remote sensing")), [1]),
        (group("and", rule("title", "match", value="REMOTE x")), [1, 2]),
        (group("and", rule("year", "between", range={"from": 2020})), [1, 4]),
        (group("and", rule("year", "between", range={})), [1, 2, 4]),
        (group("and", rule("tags", "not_in", values=["x"])), [2, 3, 4]),
        (group("and", rule("tags", "exists")), [1, 2]),
        (group("and", rule("tags", "not_exists")), [3, 4]),
        (group("and", rule("refs.sys", "eq", value="s"), rule("refs.n", "gte", value=10)), [2]),
        (group("or", rule("refs.n", "eq", value=5), rule("ok", "eq", value=False)), [1, 2]),
        (group("or", group("and", rule("year", "gt", value=2020)), rule("tags", "prefix", value="z")), [2, 4]),
    ],
)
def test_search_trees(library, tree, want):
    df, e = library
    assert sorted(r["id"] for r in search.matching(df, e, tree).collect()) == want


def test_search_errors_and_pages(library):
    df, e = library
    for bad in (rule("year", "prefix", value="2"), rule("tags", "in", values=[]), rule("year", ""), {"type": "x"}, group("xor", rule("ok", "eq", value=True))):
        with pytest.raises(ValueError):
            search.matching(df, e, group("and", bad) if bad.get("type") == "rule" else bad)
    with pytest.raises(KeyError):
        search.matching(df, e, group("and", rule("none", "eq", value=1)))
    page, warnings = search.search(df, e, search.Request(select=["id", "year"], sort=[("title", "asc"), ("year", "desc")], page_size=2))
    assert [r["id"] for r in page.collect()] == [4, 1] and len(warnings) == 1
    rest, _ = search.search(df, e, search.Request(select=["id"], sort=[("year", "desc")], page_size=10, after=[2020, 1]))
    assert [r["id"] for r in rest.collect()] == [2, 3]
    rest, _ = search.search(df, e, search.Request(select=["id"], sort=[("year", "desc")], page_size=10, after=[None, 3]))
    assert rest.count() == 0
    with pytest.raises(ValueError):
        search.search(df, e, search.Request(page_size=5000))
    assert search.sql_text(e, search.Request(group("and", rule("year", "neq", value=3))))[0] == "sql"
    assert search.sql_text(e, search.Request(group("or", rule("year", "eq", value=3), rule("ok", "eq", value=True))))[0] == "sql+filter"


# folds


def test_folds(spark):
    data = [("k", 1, None, "b", ["x"], "low", 1.0), ("k", 2, "v", "a", None, "high", 3.0), ("k", 3, "w", None, ["y", "x"], None, None), ("m", 1, None, None, None, None, None)]
    df = spark.createDataFrame(data, "k string, o int, a string, b string, l array<string>, c string, s double")
    rules = {"a": "first", "b": "first_row", "l": "union", "c": "best:high>medium>low", "s": "max"}
    got = {r["k"]: tuple(r)[1:] for r in survivorship.fold(df, ["k"], ["o"], rules).collect()}
    assert got["k"] == ("v", "b", ["x", "y"], "high", 3.0)
    assert got["m"] == (None, None, [], None, None)
    assert rows(survivorship.fold(df, ["k"], ["o"], {"l": "concat"})) == [("k", ["x", "y", "x"]), ("m", [])]
    assert rows(survivorship.first_rows(df.select("k", "o", "a"), ["k"], ["o"])) == [("k", 1, None, 2), ("m", 1, None, 0)]
    assert rows(survivorship.conflicts(df, ["k"], ["o"], ["a"])) == [("k", 1), ("m", 0)]
    assert rows(survivorship.conflicts(df, ["k"], ["o"], ["a"], backfilled=False)) == [("k", 0), ("m", 0)]
    assert rows(survivorship.most_common(df, ["k"], "a", ["o"])) == [("k", "v")]


# lookups


def test_unique_lookup(spark):
    index = spark.createDataFrame([("p", "k1", "A"), ("p", "k1", "B"), ("p", "k2", "A"), ("q", "k1", "C"), ("p", None, "Z")], "g string, key string, owner string")
    asked = spark.createDataFrame([("p", "1", "k1", 1, "x"), ("p", "1", "k2", 2, "y"), ("p", "2", "k1", 1, "x"), ("q", "3", "k1", 1, "x")], "g string, i string, key string, priority int, rule string")
    assert rows(lookup.unique_lookup(asked, index, ["g"], ["i"], "owner")) == [("p", "1", "A", "y"), ("q", "3", "C", "x")]


def test_ranked_alias_lookup(spark):
    entries = spark.createDataFrame([("mit", "US", 1), ("univ oxford", "UK", 2), ("alpha univ", "US", 9), ("alpha univ", "UK", 8)], "alias string, country string, rank int")
    asked = spark.createDataFrame([("a", ["mit"], "US"), ("b", ["x", "univ oxford"], "UK"), ("c", ["alpha univ"], None), ("d", ["mit"], "UK"), ("e", ["alpha univ"], "UK"), ("f", ["mit"], None)], "i string, aliases array<string>, country string")
    assert rows(lookup.ranked_alias_lookup(asked, entries, "i")) == [("a", 1), ("b", 2), ("c", None), ("d", None), ("e", 8), ("f", 1)]


def test_top_with_margin(spark):
    data = [("a", 1, 0.95), ("a", 2, 0.80), ("b", 1, 0.95), ("b", 2, 0.94), ("c", 1, 0.98), ("c", 2, 0.97), ("d", 1, 0.5), ("e", 1, 0.97), ("e", 2, 0.97)]
    got = rows(lookup.top_with_margin(spark.createDataFrame(data, "g string, c int, s double"), ["g"], "c", "s"))
    assert got == [("a", 1, 0.95), ("c", 1, 0.98), ("e", 2, 0.97)]


# graphs


def python_components(edges):
    """Union-find."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return sorted((n, find(n)) for n in parent)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcdefghijkl"), st.sampled_from("abcdefghijkl")), max_size=14))
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a string, b string")
    assert rows(graph.components(df, "a", "b")) == python_components(edges)


def test_components_of_a_chain_and_merges(spark):
    chain = [(f"{i:03d}", f"{i + 1:03d}") for i in range(40)]
    df = spark.createDataFrame([*chain, ("x", "x"), (None, "y"), ("000", "001")], "a string, b string")
    assert {c for _, c in rows(graph.components(df, "a", "b"))} == {"000"}
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "n string")
    phases = [("one", spark.createDataFrame([("a", "b")], "a string, b string")), ("two", spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string"))]
    assert rows(graph.phased_merges(nodes, "n", phases)) == [("one", 1), ("two", 1)]


# matching

PERSON = "person_id string, name_original string, name_aliases array<string>, orcid string, researcher_ids array<string>, primary_email string, emails array<string>, affiliations array<string>, current_affiliation string, countries_observed array<string>, country string, source_systems array<string>, updated_at timestamp"


def persons(spark, *short):
    """Persons from (id, name, orcid, institution, country)."""
    return spark.createDataFrame([(i, n, None, o, None, None, None, None, f, None, c, ["scholars"], None) for i, n, o, f, c in short], PERSON)


def test_decisions_and_clusters(spark):
    df = persons(spark, ("1", "Wang, Li", None, "Monash Univ", "Australia"), ("2", "Li Wang", None, "Monash Univ", "Australia"), ("3", "Wang, Li", None, "Other", "Australia"), ("4", "Wang, Li", "0000-0001", "Monash Univ", "Australia"), ("5", "Wang, Li", "0000-0002", "Monash Univ", "Australia"), ("6", "Wang, Q", "0000-0001", None, None))
    nodes = matching.nodes_of_persons(df)
    pairs, _ = matching.blocked_pairs(matching.block_keys(nodes))
    got = {(a, b): d for a, b, d, *_ in rows(matching.decided_pairs(pairs, nodes))}
    assert got[("1", "2")] == "merge" and got[("1", "3")] == "manual_review" and got[("4", "5")] == "blocked_conflict"
    clusters, *_ = matching.cluster_persons(df)
    sizes = sorted(r["cluster_size"] for r in clusters.collect())
    assert sizes == [1, 5]
    _, big = matching.blocked_pairs(matching.block_keys(nodes), most=3)
    assert big.count() >= 1


def test_large_blocks_are_paired_or_reported(spark, tmp_path):
    persons(spark, *[(f"{i:03d}", "Wang, Li", "0000-0000-0000-0000", None, "X") for i in range(210)]).withColumn("name_norm", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/person.parquet")
    q = registry.queries()
    assert q["blocked_pairs"](spark, str(tmp_path)).count() == 0
    assert q["blocked_pairs_whole"](spark, str(tmp_path)).count() == 210 * 209 // 2
    assert rows(q["skipped_blocks"](spark, str(tmp_path))) == [("compact:wangli", 210), ("sigcountry:wang|l|x", 210)]


def test_clusters_do_not_depend_on_order(spark):
    df = persons(spark, *[(str(i), f"Name{i % 4}, A", None, f"Inst{i % 3}", "X") for i in range(24)])
    a = rows(matching.cluster_persons(df)[0].select("canonical_person_id", "cluster_size"))
    b = rows(matching.cluster_persons(df.orderBy(F.rand(5)).repartition(5))[0].select("canonical_person_id", "cluster_size"))
    assert a == b


# claims


def test_claims_of_one_paper(spark):
    df = spark.createDataFrame(
        [("10.1/x", "Wang, Li; Smith, John A.; ;", "Smith, John/0000-0001-2345-678x", "Wang, Li/AAA-1", "[Wang, Li; Smith, John A.] Monash Univ, Clayton, Vic, Australia", "Smith, JA (corresponding author), Monash Univ, Clayton, Vic, Australia.", "john.smith@monash.edu")],
        "pub string, names string, orcids string, rids string, addresses string, reprints string, emails string",
    )
    who = silver.authors(df, "pub", "names")
    assert [(r["author_order"], r["surname_norm"]) for r in who.orderBy("author_order").collect()] == [(1, "wang"), (2, "smith")]
    ids = silver.identifier_claims(df, who, "pub", "orcids", "rids")
    assert sorted((r["claim_type"], r["claim_value"], r["match_rule"]) for r in ids.collect()) == [("orcid", "0000-0001-2345-678X", "exact_name"), ("researcher_id", "AAA-1", "exact_name")]
    aff = silver.affiliation_claims(df, who, "pub", "addresses", "reprints")
    assert sorted((r["institution"], r["country_norm"], r["is_reprint"]) for r in aff.collect()) == [("Monash Univ", "Australia", False), ("Monash Univ", "Australia", False), ("Monash Univ", "Australia", True)]
    mail = silver.email_claims(df, who, aff, "pub", "emails").collect()
    assert [(r["binding_rule"], r["score"], r["confidence"]) for r in mail] == [("unique_corresponding_author", 0.99, "high")]


# profiles, vectors, contacts


def test_profile(spark):
    df = spark.createDataFrame([("1", None, []), (" ", "x", ["a"]), ("z", "y", None)], "a string, b string, c array<string>")
    got = {r["field"]: (r["n_null"], r["n_anomalies"]) for r in profile.profile(df, {"a": "int"}).collect()}
    assert got == {"a": (1, 2), "b": (1, 0), "c": (2, 0)}


def test_nearest_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i bigint, v array<double>")
    got = rows(vectors.nearest(df.where("i % 10 = 0"), df, "i", "v", k=3, query_block=2, base_block=7).select("query_id", "rank", "i"))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = []
    for q in range(0, 60, 10):
        s = np.round(u @ u[q], 6)
        best = sorted((i for i in range(60) if i != q), key=lambda i: (-s[i], i))[:3]
        want += [(q, r + 1, i) for r, i in enumerate(best)]
    assert got == sorted(want, key=repr)


def test_embed_fails_softly(spark):
    def wobbly(texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return [[1.0, 2.0] if t != "short" else [1.0] for t in texts]

    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "short")], "i int, t string").coalesce(1)
    got = {r["i"]: (r["embedding"], r["error"]) for r in vectors.embed(df, "i", "t", wobbly, 2, batch=1, retries=2).collect()}
    assert got[1] == ([1.0, 2.0], None) and got[2] == (None, "RuntimeError: no") and got[3][0] is None


def test_anchors(spark):
    data = [("c", 1, "true", 3, 2020, 5, "0.9", "a"), ("c", 2, "no", 1, 2021, 9, "0.9", "b"), ("d", 3, None, 1, 2019, 1, None, "x"), ("d", 4, None, 1, 2020, 1, None, "y")]
    df = spark.createDataFrame(data, "k string, o int, is_corresponding_author string, author_order int, publication_year int, times_cited int, similarity string, title string")
    assert rows(evidence.anchors(df, "k", "o").select("k", "title", "n_evidences")) == [("c", "a", 2), ("d", "y", 2)]
    flat = evidence.flat(spark.createDataFrame([(["a", "b"], True, 1), (None, False, None)], "l array<string>, b boolean, n int"))
    assert rows(flat) == sorted([("a；b", "是", "1"), (None, "否", None)], key=repr)


def test_everything_takes_empty_tables(spark):
    e = spark.createDataFrame([], "a string, b string, s double, k array<string>")
    assert graph.components(e, "a", "b").count() == 0
    assert graph.star_edges(e, "a", "b").count() == 0
    assert lookup.top_with_margin(e, ["a"], "b", "s").count() == 0
    assert survivorship.fold(e, ["a"], ["b"], {"k": "union", "s": "max"}).count() == 0
    assert split_packed(e, "a", ["b"]).count() == 0


def test_supports_of_decisions(spark):
    from pyspark.sql import types as T

    df = persons(spark, ("1", "Wang, Li", None, "Monash Univ", "Australia"), ("2", "Wang, Li", None, "Monash Univ", "Chile"), ("3", "Wang, Li", None, "Other", "Peru"))
    df = df.withColumn("source_systems", F.array(F.lit("frontiers"))).withColumn("publication_ids", F.array(F.concat(F.lit("p"), "person_id")))
    assert isinstance(df.schema["publication_ids"].dataType, T.ArrayType)
    nodes = matching.nodes_of_persons(df)
    pairs, skipped = matching.blocked_pairs(matching.block_keys(nodes))
    plain = {(r["a"], r["b"]): (r["decision"], set(r["rules_hit"])) for r in matching.decided_pairs(pairs, nodes).collect()}
    assert plain["1", "2"][0] == "merge" and {"institution_overlap", "publication_stability"} <= plain["1", "2"][1] and ("1", "3") not in plain
    told = matching.with_external(pairs, spark.createDataFrame([("3", "1"), ("1", "3"), ("2", "2")], "a string, b string"))
    got = {(r["a"], r["b"]): (r["decision"], set(r["rules_hit"])) for r in matching.decided_pairs(told, nodes).collect()}
    assert got["1", "3"][0] == "manual_review" and "external_matched" in got["1", "3"][1] and skipped.count() == 0


def test_projection_of_dirty_rows(spark):
    from biblioweave.plans import projection

    rows_ = spark.createDataFrame(
        [("f", "s", 1, {"DOI": "10.1/x", "Publication Year": "2020.0", "Author Keywords": "b; a;;a", "Extra": "1"}), ("f", "s", 2, {"Article Title": "T", "Publication Year": "2020", "Source Title": "J"}), ("f", "s", 3, {})],
        "source_file string, sheet string, row_index bigint, cells map<string,string>",
    )
    got = projection.publications(rows_, F.lit("2024-01-01").cast("timestamp")).orderBy(F.col("source_refs")[0]["row_index"]).collect()
    assert (got[0]["publication_id"], got[0]["publication_year"], got[0]["author_keywords"]) == ("10.1/x", None, ["a", "b"])
    assert got[1]["publication_id"] == __import__("hashlib").sha1(b"T|2020|J").hexdigest() and got[1]["publication_year"] == 2020
    assert len(got) == 3 and got[0]["source_refs"][0]["raw_keys"] == ["Author Keywords", "DOI", "Extra", "Publication Year"]
    seeds = projection.person_seeds(spark.createDataFrame([("f", "s", 1, {"name": " Li Wang ", "orcid": "x", "countries": "AU"}), ("f", "s", 2, {"name": " - "})], rows_.schema), F.current_timestamp()).collect()
    assert [(r["name_original"], r["orcid"], r["countries_observed"]) for r in seeds] == [("Li Wang", None, ["AU"])]


def test_evidence_pairs_of_a_paper_with_many_authors(spark):
    import time

    from biblioweave.functions.names import name_parts, name_score

    def authors(*given):
        df = spark.createDataFrame(given, "node string, publication_id string, raw string, aliases array<string>")
        return df.select("node", "publication_id", name_parts(F.col("raw")).alias("name"), "aliases")

    names = ["Wang, Li", "LI WANG", "Wang, L", "Wang, Lu", "Wang", "W|ang, Li", "王, 丽", "王, 丽丽", "丽 王", None, "", "Zoë O'Neil", "ONeil, Zoe", "Neil, Zoe O"]
    aliases = [None, [], ["Wang, Li"], ["x", None], ["x"]]
    some = authors(*[(f"{i:02d}", "pq"[i % 7 == 0], n, aliases[i % len(aliases)]) for i, n in enumerate(names * 3)]).cache()
    a, b = some.alias("a"), some.alias("b")
    for least in (0.0, 0.9, 0.93, 0.96, 0.98, 0.985, 1.0):
        score = F.coalesce(name_score(F.col("a.name"), F.col("b.name"), F.col("a.aliases"), F.col("b.aliases"))["score"], F.lit(0.0))
        each = a.join(b, (F.col("a.publication_id") == F.col("b.publication_id")) & (F.col("a.node") != F.col("b.node"))).where(F.col("a.name").isNull() | (score >= least))
        want = rows(each.select(F.least("a.node", "b.node"), F.greatest("a.node", "b.node")).distinct())
        assert rows(matching.evidence_pairs(some, some, least).select("a", "b")) == want and want
    many = spark.range(40_000).select(F.col("id").cast("string").alias("node"), F.lit("p").alias("publication_id"), name_parts(F.concat(F.lit("Name"), F.col("id") % 39_999, F.lit(", X"))).alias("name"), F.array().cast("array<string>").alias("aliases")).localCheckpoint()
    began = time.time()
    assert rows(matching.evidence_pairs(many, many).select("a", "b")) == [("0", "39999")]
    assert time.time() - began < 60  # 1.6 billion pairs, one by one, take minutes
