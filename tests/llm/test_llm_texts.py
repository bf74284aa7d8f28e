"""Problems 8 to 10 on small and hard cases."""

import itertools
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from biblioweave.llm import abuse, mixing, packing, tokens

# 8: containers


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=5), st.integers(0, 60))
def test_closest_filling_is_best(counts, room):
    used = packing.closest_filling(counts, room)
    assert all(used[x] <= counts[x] for x in used)
    lengths = [x for x, c in counts.items() for _ in range(c)]
    best = max((sum(s) for r in range(len(lengths) + 1) for s in itertools.combinations(lengths, r) if sum(s) <= room), default=0)
    assert sum(x * n for x, n in used.items()) == best


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 20), max_size=12))
def test_fillings_use_every_item_once(counts):
    out = Counter()
    for used, times in packing.fillings(counts, 40):
        assert sum(x * n for x, n in used.items()) <= 40
        for x, n in used.items():
            out[x] += n * times
    assert out == Counter(counts)


def test_pack(spark):
    rnd = random.Random(2)
    data = [(i, rnd.choice([0, 3, 7, 19, 50, 99, 100, 101, 250, 4000])) for i in range(800)] + [(9000, None), (1, 7)]
    df = spark.createDataFrame(data, "doc_id bigint, n_tokens bigint")
    kinds = spark.createDataFrame([("s", 100), ("l", 1000), ("s", 100)], "container_kind string, capacity_tokens int")
    got = packing.pack(df, kinds, window_items=200).collect()
    for kind, cap in (("s", 100), ("l", 1000)):
        mine = [r for r in got if r["container_kind"] == kind]
        fill, pieces = Counter(), {}
        for r in mine:
            fill[r["window"], r["container_no"]] += r["n_tokens"]
            pieces.setdefault(r["doc_id"], []).append((r["piece_no"], r["start_token"], r["n_tokens"]))
        assert max(fill.values()) <= cap
        for i, n in data:
            got_n = sorted(pieces[i])
            if i == 1:
                continue
            assert sum(p[2] for p in got_n) == (n or 0)
            assert len(got_n) == max(1, -(-(n or 0) // cap))
            assert all(p[2] == cap for p in got_n[:-1])
        unused = 1 - sum(fill.values()) / (cap * len(fill))
        assert unused < 0.1
    assert packing.pack(df.where("false"), kinds).count() == 0


def test_token_sizes(spark):
    df = spark.createDataFrame([(1, "hello world", "s"), (2, None, "s"), (3, "", None), (4, "x" * 20_000, "s")], "doc_id bigint, text string, n_tokens string")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_sizes(df.drop("n_tokens"), ["doc_id"]).collect()}
    assert got[1] == 2 and got[2] == 0 and got[3] == 0 and got[4] > 1000


# 9: mixing


def test_permutations_are_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        j = np.arange(n)
        p = mixing.permuted(j, np.full(n, n), np.full(n, 12345))
        assert sorted(p.tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 1)).tolist() != mixing.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 2)).tolist()


def test_mix_reaches_shares(spark):
    rnd = random.Random(3)
    data = [(i, "big" if i % 10 else "small", rnd.randint(0, 300)) for i in range(3000)] + [(5000, "other", 10), (5001, None, 10)]
    df = spark.createDataFrame(data, "doc_id bigint, source string, n_tokens bigint")
    target = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 3), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(df, target, block_tokens=32, shard_blocks=500).cache()
    share = {r["source"]: r["share"] for r in mixing.shares_report(mixed, target).collect()}
    assert abs(share["big"] - 0.7) < 0.01 and abs(share["small"] - 0.3) < 0.01
    used = mixed.groupBy("source", "block", "doc_id", "doc_from").count().groupBy("source").agg(F.max("count").alias("m")).collect()
    assert {r["source"]: r["m"] for r in used}["big"] == 1 and {r["source"]: r["m"] for r in used}["small"] <= 3
    n = {i: t for i, _, t in data}
    assert all(0 <= r["doc_from"] and r["doc_from"] + r["n_tokens"] <= n[r["doc_id"]] for r in mixed.select("doc_id", "doc_from", "n_tokens").collect())
    assert mixed.select("shard").distinct().count() > 1
    assert mixing.mix(df.where("source = 'big'"), target).count() == 0
    assert mixing.mix(df.where("false"), target).count() == 0


def test_blocks_cover_every_token(spark):
    df = spark.createDataFrame([(i, "s", i % 17) for i in range(300)], "doc_id bigint, source string, n_tokens bigint")
    pieces, totals = mixing.blocks(df, 10, docs_per_bucket=20)
    assert totals == {"s": sum(i % 17 for i in range(300))}
    assert pieces.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).where("n <> doc_id % 17").count() == 0
    assert pieces.groupBy("block").agg(F.sum("n_tokens").alias("n")).where("n > 10").count() == 0
    assert pieces.agg(F.sum("n_tokens")).first()[0] == totals["s"]


# 10: abuse


def segments_brute(s):
    """All maximal segments by the recursive definition: the best one, then those left and right of it."""
    out = []

    def go(a, b):
        best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best and best[0] > 0:
            out.append((best[3], best[4], best[0]))
            go(a, best[3])
            go(best[4], b)

    go(0, len(s))
    return sorted(out)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -1.25, -0.5, 0.75, 2.0, 4.5]), max_size=14))
def test_segments(values):
    got = abuse.segments(np.array(values))
    want = segments_brute(values)
    assert [round(x, 6) for *_, x in got] == [round(x, 6) for *_, x in want]
    assert abuse.best_segment(np.array(values)) == max((x for *_, x in want), default=0.0)


def test_disguises():
    for text in ("you i d i o t", "1d10t", "idiooooot", "i​diot", "i***t", "IDIOT!!!", "an id iot"):
        found = {w for words, _ in abuse.sentences(text) for w in words} & abuse.SEED_WORDS
        assert found or text == "an id iot", text
    (words, quoted), *_ = abuse.sentences("They marked 'idiot' as an insult.")
    assert quoted[words.index("idiot")] and not abuse.seeded(words, quoted)
    assert abuse.sentences("") == [] and abuse.sentences(" \n ") == []


def test_quotations_of_any_length():
    def own(text):
        return [w for words, quoted in abuse.sentences(text) for w, q in zip(words, quoted, strict=True) if not q]

    assert "idiot" not in own('He wrote "I read it. You are an idiot and a moron. Go home." and left.')
    assert "idiot" not in own("They quote: “" + "long words here. " * 100 + "you idiot.” We analyse it.")
    assert "idiot" not in own("One «line\nand you idiot» more.") and "idiot" not in own("„Du idiot“, stand da.")
    assert "idiot" in own('An inch is 2.54 cm or 1" long. You idiot!') and "idiot" in own("The authors' view is wrong, you idiot. That's all.")
    assert "idiot" in own('An opening "mark that is never closed, you idiot.') and "idiot" not in own("<p class='" + "x" * 500 + " idiot'>text</p>")


def test_seeds_are_single_words():
    assert all(w.isalpha() for w in abuse.SEED_WORDS) and abuse.WEAK_SEEDS <= abuse.SEED_WORDS and len(abuse.SEED_WORDS) <= 200


def test_company_teaches_words_that_are_no_seeds(spark):
    rnd = random.Random(3)
    topics = [f"topic{i}" for i in range(40)]
    data, hidden = [], set()
    for i in range(3000):
        parts = [f"We measured {rnd.choice(topics)} near {rnd.choice(topics)} again." for _ in range(rnd.randint(2, 5))]
        kind = i % 30
        if kind in (0, 1):
            parts.append(rnd.choice(["Only an idiot writes this.", "You are a moron."]))
        if kind in (0, 2):  # no word of it is a seed
            parts.append(f"Crocodiles will chew your {rnd.choice(['knees', 'elbows'])} tonight.")
            if kind == 2:
                hidden.add(i)
        rnd.shuffle(parts)
        data.append((i, " ".join(parts), "a", "en"))
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string, lang string")
    got = {r["doc_id"] for r in abuse.abusive(abuse.score_texts(df)).collect()}
    assert len(got & hidden) >= 0.9 * len(hidden)
    assert all(i % 30 in (0, 1, 2) for i in got)


def test_score_texts(spark):
    rnd = random.Random(6)
    sober = ["The samples were measured twice.", "We thank the reviewers for their time.", "Results depend on the local setting.", "The idiom is used in this region.", "You can find the data online.", "No effect was found in the second trial."]
    insults = ["You are a stupid idiot.", "Shut up and go away, you moron.", "What a load of shit, written by an idiot.", "You pathetic imbecile, stop wasting our time.", "Go to hell, idiot."]
    data, bad = [], set()
    for i in range(600):
        parts = rnd.choices(sober, k=rnd.randint(2, 6))
        if i % 20 == 0:
            parts.insert(rnd.randint(0, len(parts)), rnd.choice(insults))
            bad.add(i)
        elif i % 20 == 1:
            parts.append("Annotators marked insults such as 'idiot' or 'moron' in a corpus of posts.")
        data.append((i, " ".join(parts), "a" if i % 2 else "b"))
    data += [(1000, None, "a"), (1001, "", None), (1002, "word " * 30_000, "a")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    scored = abuse.score_texts(df).cache()
    got = {r["doc_id"] for r in abuse.abusive(scored).collect()}
    assert scored.count() == 603
    assert len(got & bad) >= 0.9 * len(bad) and len(got - bad) <= 2
    assert {r["doc_id"]: r["abuse_score"] for r in scored.where("doc_id in (1000, 1001)").collect()} == {1000: 0.0, 1001: 0.0}
    assert {r["source"]: r["documents"] for r in abuse.rates(scored).collect()} == {"a": 302, "b": 300, None: 1}
    assert abuse.score_texts(df.where("false")).count() == 0
