"""Problem 3: variant spellings of one person's name, by a sparse cosine join and average-linkage clustering.

1. A record's vector has one dimension for each character 3-gram of its names and aliases together with each thing that
   places it (an institution's first letters, the domain of its mailbox, a half of its ORCID, its subject with the start of a name): the tensor product of its
   3-gram vector and its vector of places, both weighted by inverse document frequency and of unit length. The cosine of
   two records is then the product of their two cosines. A 3-gram alone is too common to be a posting; with a place it's rare.
2. The join finds all pairs of one source with a cosine of at least ``least_cosine``, but for those of different subjects,
   which can't be one person. Dimensions are posted rarest first, until those left out have a length under ``SLACK``
   (or half of ``least_cosine``) and a weight up to ``COMMON``; partial dot products of shared postings are summed by pair, in joins and aggregations
   that no task gathers. A record is light if its common dimensions, those of a weight up to ``COMMON``, have a length of
   at most the root of that; where two light records meet, their common dimensions aren't summed, as they add at most the
   product of both lengths. What both left out adds at most the longer of both rests. The ids carry these lengths: a pair
   whose sum can reach ``least_cosine`` meets its features, the exact cosine decides. ``top_n`` may keep only the
   best partners of a record; by default all stay.
   Records that are one person by their confidence may have a lower cosine, or none: no place in common, or a short name
   with a slip. Pairs that share a rare word within a slip, or two common words, are candidates too (``name_keys``) and
   come out if their confidence is at least the one that links. Names alone rule most candidates out, in narrow rows.
3. The confidence of a pair adds the cosine of the names to what the records have in common (``people.evidence``).
4. Clusters merge while the average confidence over all their pairs is at least a half: in each round every cluster picks
   its best partner, and pairs that pick each other merge, which for average linkage gives the same tree as one merge at
   a time. The pair table is summed by cluster pairs, so no cluster is gathered. Equal averages are ordered by a hash of
   the pair, so that among many copies of a record about a quarter merge in each round, not one.

Defined cases: null names are compared by their aliases; records with neither link to none;
repeated rows count once; an empty table gives no rows; a cluster is named by its smallest id.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, drop_cut
from . import people

#: The length of what a record's postings may leave out.
SLACK = 0.05
#: Log-odds that equal names add to a confidence, and names without a common 3-gram take from it, each by a half.
COSINE_WEIGHT = 2.0
LEAST_COSINE = 0.09
#: A word that at most a few times exp(RARE) records have is rare: the list of such a word doesn't grow with the table.
RARE = 5.0
#: Rounding of single-precision sums.
ROUNDING = 1e-5
VECTOR = ["no", "src", "words", "more", "places", "domain", "shared", "orcid", "subject", "family"]
#: The weight, before it is made a part of a vector of unit length, up to which a dimension is common: about that of one in e^8 records.
COMMON = 16.0
#: The low bits of a posted id: a code of the subject (0: none), the length of the common dimensions in parts of the root of
#: the slack (all ones if it is longer), and the length left out in parts of the slack, both rounded up.
SUBJECT_BITS = REST_BITS = COMMON_BITS = 5
LOW_BITS = COMMON_BITS + REST_BITS
HEAVY = 2**COMMON_BITS - 1
#: The high bits of a posted id: the letters of the family name, several to a bit (none: not known, or it may agree with other letters).
FAMILY_BITS, NUMBER_BITS = 20, 28
FAMILY_AT = NUMBER_BITS + SUBJECT_BITS + LOW_BITS


@dataclass
class Counts:
    """Counts over all records: of words and places (``rarity``), and by bucket of the 3-grams and places of vectors."""

    rarity: people.Rarity
    grams: np.ndarray
    contexts: np.ndarray
    records: int


@lru_cache(maxsize=200_000)
def _word_grams(w: str) -> frozenset[int]:
    t = f" {w} "
    return frozenset(people.bucket(t[g : g + 3]) for g in range(len(t) - 2))


def grams_of(words: Iterable[str]) -> set[int]:
    """Buckets of the character 3-grams of words, with a blank around each word."""
    return set().union(*map(_word_grams, words))


def contexts_of(places: Iterable[str], domain: str, shared: bool, orcid: str, words: Iterable[str], subject: str) -> set[int]:
    """Buckets of what places a record: institutions and the domain by their first letters, halves of the ORCID, subject and start of a name."""
    out = {"p" + p[:5] for p in places}
    if subject:
        out |= {f"s{w[:4]}|{subject}" for w in words if len(w) > 3}
    if domain and not shared:
        out.add("p" + domain[:5])
    if orcid:
        out |= {"a" + orcid[:8], "z" + orcid[-8:]}
    return {people.bucket(x) for x in out}


@lru_cache(maxsize=200_000)
def _spelled(w: str) -> frozenset[str]:
    """The word, its full forms, and what is left of it without one letter: words within a slip have one of these in common."""
    return frozenset({w, *people.FULL_OF.get(w, ()), *(w[:i] + w[i + 1 :] for i in range(len(w) if len(w) > 3 else 0))})


def name_keys(words: Iterable[str], more: Iterable[str], rarity: people.Rarity) -> set[str]:
    """What records share that may be one person by their names and without a place: each spelling of a rare word, two common words."""
    own = {w for w in (*words, *more) if len(w) > 2 and w not in people.PARTICLES}
    rare = {w for w in own if rarity(w) >= rarity.size - RARE}
    full = sorted({f for w in own - rare for f in people.FULL_OF.get(w, {w})})
    return {f"w{x}" for w in rare for x in _spelled(w)} | {f"t{x}|{y}" for i, x in enumerate(full) for y in full[i + 1 :]}


def count_all(feats: DataFrame) -> Counts:
    """``Counts`` in one pass; only sums for at most three times ``WORD_BUCKETS`` numbers reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n = np.zeros((3, people.WORD_BUCKETS), np.int64), 0
        for b in batches:
            n += len(b)
            every: tuple[list[int], ...] = ([], [], [])
            for words, more, places, domain, shared, orcid, subject in b.itertuples(index=False, name=None):
                every[0].extend(people.rarity_buckets(words, places))
                every[1].extend(grams_of((*words, *more)))
                every[2].extend(contexts_of(places, domain, shared, orcid, words, subject))
            for total, buckets in zip(sums, every, strict=True):
                total += np.bincount(np.array(buckets, np.int64), minlength=people.WORD_BUCKETS)
        kind, at = np.nonzero(sums)
        yield pd.DataFrame({"kind": [*kind.tolist(), -1], "k": [*at.tolist(), -1], "c": [*sums[kind, at].tolist(), n]})

    out, records = np.zeros((3, people.WORD_BUCKETS), np.int64), 0
    for kind, k, c in feats.select("words", "more", "places", "domain", "shared", "orcid", "subject").mapInPandas(count, "kind int, k int, c bigint").groupBy("kind", "k").agg(F.sum("c")).collect():
        if kind < 0:
            records = c
        else:
            out[kind, k] = c
    return Counts(people.Rarity(out[0], records), out[1], out[2], records)


def unit(buckets: Iterable[int], counts: np.ndarray, records: int) -> tuple[dict[int, float], float]:
    """(inverse document frequency of each bucket, the length of the vector)."""
    out = {k: math.log(1 + records / (1.0 + float(counts[k]))) for k in buckets}
    return out, math.sqrt(sum(x * x for x in out.values())) or 1.0


def weights(counts: np.ndarray, records: int) -> np.ndarray:
    """The inverse document frequency of every bucket."""
    return np.log(1 + records / (1.0 + counts))


@lru_cache(maxsize=10_000)
def subject_code(subject: str) -> int:
    """0 for no subject, else a number of ``SUBJECT_BITS``."""
    return 1 + zlib.crc32(subject.encode()) % (2**SUBJECT_BITS - 1) if subject else 0


@lru_cache(maxsize=200_000)
def family_letters(family: str) -> int:
    """The letters of a family name in ``FAMILY_BITS``, 0 for none; where more than two of either are not the other's, ``people.word_match`` is 0."""
    if len(family) < 2 or family in people.FULL_OF:
        return 0
    out = 0
    for ch in family:
        out |= 1 << (ord(ch) & 63) % FAMILY_BITS
    return out


def posted_ids(no: np.ndarray, subjects: Iterable[str], families: Iterable[str], common: np.ndarray | float = 0.0, rest: np.ndarray | float = 0.0, slack: float = 1.0) -> np.ndarray:
    """The numbers of records with what ``meeting`` and ``joined`` ask about them in the other bits."""
    if len(no) and no.max() >> NUMBER_BITS:
        raise ValueError(f"more than 2^{NUMBER_BITS} records")
    letters = np.fromiter(map(family_letters, families), np.int64, len(no))
    codes = np.fromiter(map(subject_code, subjects), np.int64, len(no))
    light = np.where(common <= math.sqrt(slack), np.ceil(common / math.sqrt(slack) * (HEAVY - 1)), HEAVY).astype(np.int64)
    left = np.minimum(2**REST_BITS - 1, np.ceil(rest / slack * (2**REST_BITS - 1))).astype(np.int64)
    return (((letters << NUMBER_BITS | no) << SUBJECT_BITS | codes) << COMMON_BITS | light) << REST_BITS | left


def postings(feats: DataFrame, counts: Counts, slack: float) -> DataFrame:
    """(k, id, w): the posted dimensions of every record, within its source; see ``posted_ids``. The common ones of light records are negative."""

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_gram, of_context = weights(counts.grams, counts.records), weights(counts.contexts, counts.records)
        hashed = lru_cache(10_000)(xxhash.xxh64_intdigest)

        def posted(part: list[tuple]) -> pd.DataFrame:
            nos, srcs, subjects, families, grams, contexts = zip(*part, strict=True)
            ng, nc = (np.fromiter(map(len, x), np.int64, len(x)) for x in (grams, contexts))
            g, c = (np.fromiter(itertools.chain.from_iterable(x), np.uint64, n.sum()) for x, n in ((grams, ng), (contexts, nc)))
            gw, cw = of_gram[g], of_context[c]
            firsts = np.cumsum(nc) - nc
            length = np.sqrt(np.add.reduceat(gw**2, np.cumsum(ng) - ng) * np.add.reduceat(cw**2, firsts))
            # each 3-gram of a record with each of its contexts
            times = np.repeat(nc, ng)
            gi, r = np.repeat(np.arange(len(g)), times), np.repeat(np.arange(len(part)), ng * nc)
            ci = np.repeat(np.repeat(firsts, ng) - (np.cumsum(times) - times), times) + np.arange(len(gi))
            w = gw[gi] * cw[ci]
            with np.errstate(over="ignore"):
                z = ((g[gi] * np.uint64(people.WORD_BUCKETS) + c[ci]) ^ np.fromiter(map(hashed, srcs), np.uint64, len(part))[r]) * np.uint64(0x9E3779B97F4A7C15)
            k = (z ^ (z >> np.uint64(29))).view(np.int64)
            value = w / length[r]
            # only common dimensions may be left out, the most common first, alike in all records
            low = np.flatnonzero(w <= COMMON)
            low = low[np.lexsort((k[low], w[low], r[low]))]
            common = np.bincount(r[low], value[low] ** 2, len(part))
            upto = np.cumsum(value[low] ** 2) - (np.cumsum(common) - common)[r[low]]
            out = upto < slack**2
            rest = np.sqrt(np.bincount(r[low][out], value[low][out] ** 2, len(part)))
            common = np.sqrt(common)
            value[low[(common <= math.sqrt(slack))[r[low]]]] *= -1
            kept = np.ones(len(w), bool)
            kept[low[out]] = False
            ids = posted_ids(np.array(nos, np.int64), subjects, families, common, rest, slack)
            return pd.DataFrame({"k": k[kept], "id": ids[r[kept]], "w": value[kept].astype(np.float32)})

        for b in batches:
            part, size = [], 0
            for no, src, words, more, places, domain, shared, orcid, subject, family in zip(*(b[c].tolist() for c in VECTOR), strict=True):
                g, c = grams_of((*words, *more)), contexts_of(places, domain, shared, orcid, words, subject)
                if not g or not c:
                    continue
                part.append((no, src, subject, family, g, c))
                size += len(g) * len(c)
                if size > 500_000:
                    yield posted(part)
                    part, size = [], 0
            if part:
                yield posted(part)

    return feats.select(*VECTOR).mapInPandas(post, "k bigint, id bigint, w float")


def meeting(posted: DataFrame) -> DataFrame:
    """(ia, ib, and wa, wb if there are weights): records, not of different subjects or unlike family names, for each posting they share."""
    l, r = (posted.select("k", *[F.col(c).alias(("i" if c == "id" else c) + x) for c in posted.columns if c != "k"]) for x in "ab")
    sa, sb = (F.shiftright(c, LOW_BITS).bitwiseAND(F.lit(2**SUBJECT_BITS - 1)) for c in ("ia", "ib"))
    fa, fb = (F.shiftright(c, FAMILY_AT) for c in ("ia", "ib"))
    alike = (fa == 0) | (fb == 0) | (F.bit_count(fa.bitwiseAND(F.bitwise_not(fb))) <= 2) & (F.bit_count(fb.bitwiseAND(F.bitwise_not(fa))) <= 2)
    met = l.join(r, "k").where("ia < ib").where((sa == sb) | (sa == 0) | (sb == 0)).where(alike)
    return met.select(*[F.col(c).bitwiseAND(F.lit((1 << FAMILY_AT) - 1)).alias(c) if c[0] == "i" else c for c in met.columns if c != "k"])


def joined(posted: DataFrame, least: float, slack: float) -> DataFrame:
    """(ia, ib), numbers of records: the pairs, not of different subjects, that may have a cosine of at least ``least``."""
    ra, rb = (F.col(c).bitwiseAND(F.lit(2**REST_BITS - 1)) for c in ("ia", "ib"))
    ca, cb = (F.shiftright(c, REST_BITS).bitwiseAND(F.lit(HEAVY)) for c in ("ia", "ib"))
    light = (ca < HEAVY) & (cb < HEAVY)
    # the rest counts for light records too: with names alike, a pair under the cosine by less than that may be sure
    most = F.col("dot") + F.greatest(ra, rb) * (slack / (2**REST_BITS - 1)) + F.when(light, ca * cb * (slack / (HEAVY - 1) ** 2)).otherwise(0.0)
    near = meeting(posted).where("wa > 0 or wb > 0").groupBy("ia", "ib").agg(F.sum(F.abs(F.col("wa") * F.col("wb"))).alias("dot")).where(most >= least - ROUNDING)
    return near.select(*[F.shiftright(c, SUBJECT_BITS + LOW_BITS).alias(c) for c in ("ia", "ib")])


def joined_by_name(feats: DataFrame, rarity: people.Rarity) -> DataFrame:
    """(ia, ib), numbers of records: the pairs of one source, not of different subjects, that share a key of their names."""

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = [[xxhash.xxh64_intdigest(f"{src}\u0001{k}") for k in name_keys(words, more, rarity)] for src, words, more in zip(b["src"], b["words"], b["more"], strict=True)]
            n = np.fromiter(map(len, keys), np.int64, len(keys))
            ids = posted_ids(b["no"].to_numpy(np.int64), b["subject"], b["family"])
            yield pd.DataFrame({"k": np.fromiter(itertools.chain.from_iterable(keys), np.uint64, n.sum()).view(np.int64), "id": np.repeat(ids, n)})

    posted = feats.select("no", "src", "words", "more", "subject", "family").mapInPandas(post, "k bigint, id bigint")
    return meeting(posted).select("ia", "ib").distinct().select(*[F.shiftright(c, SUBJECT_BITS + LOW_BITS).alias(c) for c in ("ia", "ib")])


def named_alike(near: DataFrame, feats: DataFrame, rarity: people.Rarity) -> DataFrame:
    """The (ia, ib) whose names may be one person's."""
    names = F.concat_ws("\t", F.array_join("words", " "), F.array_join("more", " "), "family")
    a, b = (feats.select(F.col("no").alias("i" + x), names.alias(x)) for x in "ab")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        @lru_cache(50_000)
        def opened(text: str) -> tuple:
            words, more, family = text.split("\t")
            return None, None, None, words.split(), more.split(), family

        for batch in batches:
            kept = [people.name_evidence(opened(x), opened(y), rarity) > -math.inf for x, y in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True)]
            yield batch[["ia", "ib"]][np.array(kept, bool)]

    return near.join(a, "ia").join(b, "ib").mapInPandas(check, "ia bigint, ib bigint")


def placed(rows: DataFrame, mark: str, name: str) -> DataFrame:
    """``rows`` with their place in the whole order as ``name``, in place of the ``monotonically_increasing_id`` in ``mark``."""
    part, inside = F.shiftright(mark, 33).cast("int"), F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r[0], r[1]) for r in rows.groupBy(part.alias("p")).agg(F.count("*")).collect())
    before, total = {}, 0
    for p, n in counts:
        before[p], total = total, total + n
    start = F.element_at(F.create_map(*[x for p, n in before.items() for x in (F.lit(p), F.lit(n).cast("bigint"))]), part) if before else F.lit(0).cast("bigint")
    return rows.select(*[c for c in rows.columns if c != mark], (inside + start).alias(name))


def numbered(feats: DataFrame) -> DataFrame:
    """``feats`` written with a number ``no`` for each record: its place among them, which for ``unmatched_features`` is that of its id."""
    return placed(cut(feats.withColumn("m", F.monotonically_increasing_id()), "people"), "m", "no")


def similar_numbers(feats: DataFrame, least_cosine: float = LEAST_COSINE, top_n: int | None = None, sure: float | None = None) -> DataFrame:
    """``similar_pairs`` of numbered features, by number."""
    counts = count_all(feats)
    slack = min(SLACK, least_cosine / 2)
    near = cut(joined(postings(feats, counts, slack), least_cosine, slack), "near")
    if sure is not None:
        near = near.unionByName(cut(joined_by_name(feats, counts.rarity), "near-names"))
    near = cut(named_alike(near, feats, counts.rarity), "alike")
    rows = people.packed(feats).withColumnRenamed("no", "i")
    a, b = (rows.select(*[F.col(c).alias(c + x) for c in rows.columns]) for x in "ab")
    # the records of a pair meet once its dot product is known
    met = near.join(a, "ia").join(b, "ib").where("subjecta = subjectb or subjecta = '' or subjectb = ''")
    flat = met.select(*[F.col(c + x) for x in "ab" for c in rows.columns])
    rarity = counts.rarity

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_gram, of_context = (np.square(weights(c, counts.records)).tolist() for c in (counts.grams, counts.contexts))

        @lru_cache(20_000)
        def opened(*row: object) -> tuple[tuple, tuple[set[int], float]]:
            r = people.unpacked(row)
            g = grams_of((*r[3], *r[4]))
            return r, (g, sum(of_gram[k] for k in g))

        def placed_by(r: tuple) -> tuple[set[int], float]:
            c = contexts_of(r[11], r[9], r[10], r[7], r[3], r[6])
            return c, sum(of_context[k] for k in c)

        def cosine(x: tuple[set[int], float], y: tuple[set[int], float], of: list[float]) -> float:
            return sum(of[k] for k in x[0] & y[0]) / math.sqrt(x[1] * y[1]) if x[0] and y[0] else 0.0

        for batch in batches:
            found = []
            n = len(people.ROW)
            for both in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
                x, y = both[:n], both[n:]
                if x[0] == y[0] or x[1] != y[1]:
                    continue
                (x, gx), (y, gy) = (opened(*r) for r in ((x, y) if x[0] < y[0] else (y, x)))
                e = people.evidence(x, y, rarity)
                if e == -math.inf:
                    continue
                names = cosine(gx, gy, of_gram)
                sim = people.confidence(e + COSINE_WEIGHT * (names - 0.5), rarity)
                # what is sure needs no cosine of places
                if sure is not None and sim >= sure or names * cosine(placed_by(x), placed_by(y), of_context) >= least_cosine:
                    found.append((x[0], y[0], sim))
            yield pd.DataFrame(found, columns=["a", "b", "sim"])

    pairs = flat.mapInPandas(check, "a bigint, b bigint, sim double").groupBy("a", "b").agg(F.max("sim").alias("sim"))
    if top_n is not None:
        both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("a"), F.col("b"), F.col("sim")), F.struct(F.col("b").alias("v"), F.col("a"), F.col("b"), F.col("sim")))).alias("x")).select("x.*")
        order = Window.partitionBy("v").orderBy(F.desc("sim"), "a", "b")
        pairs = both.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top_n).select("a", "b", "sim").distinct()
    return pairs


def similar_pairs(feats: DataFrame, least_cosine: float = LEAST_COSINE, top_n: int | None = None, sure: float | None = None) -> DataFrame:
    """(a, b, sim): pairs of one source with at least this cosine, a < b, with their confidence; those that can't be one person are left out.

    With ``sure``, pairs that share a key of their names and have at least this confidence come too, whatever their cosine.
    """
    feats = feats if "no" in feats.columns else numbered(feats)
    a, b = (feats.select(F.col("no").alias(x), F.col("person_id").alias("p" + x)) for x in "ab")
    named = similar_numbers(feats, least_cosine, top_n, sure).join(a, "a").join(b, "b")
    return named.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"), "sim")


def _followed(merges: list[DataFrame]) -> DataFrame:
    """(gone, into) of all merges, oldest first, with the id that each ends in; the tables given are deleted."""
    into = merges[-1]
    for earlier in reversed(merges[:-1]):
        later = into.select(F.col("gone").alias("into"), F.col("into").alias("final"))
        into = earlier.join(later, "into", "left").select("gone", F.coalesce("final", "into").alias("into")).unionByName(into)
    into = cut(into, "linkage-into")
    for m in merges:
        drop_cut(m)
    return into


def average_linkage(pairs: DataFrame, least: float = 0.5) -> DataFrame:
    """(id, cluster) of every id that ends in a cluster of at least two; ``pairs`` has a, b and sim, others count 0."""
    edges = cut(pairs.select("a", "b", "sim", F.lit(1).cast("bigint").alias("na"), F.lit(1).cast("bigint").alias("nb")), "linkage")
    merges: list[DataFrame] = []
    while True:  # the best pair of all merges in any round, so this ends
        average = F.round(F.col("sim") / (F.col("na") * F.col("nb")), 12)  # sums of equal values differ in their last bits
        good = edges.where(average >= least).withColumn("s", average)
        rank = F.struct(F.col("s"), F.xxhash64("a", "b").alias("h"), F.col("b").alias("x"), F.col("a").alias("y"))  # one order of all pairs, from either end
        ends = good.select(F.explode(F.array(F.struct(F.col("a").alias("v"), rank.alias("r")), F.struct(F.col("b").alias("v"), rank.alias("r")))).alias("e")).select("e.v", "e.r")
        best = ends.groupBy("v").agg(F.max("r").alias("r"))
        # a pair that both its ends pick merges into the smaller id
        merged = cut(best.groupBy("r").agg(F.count("*").alias("n")).where("n = 2").select(F.col("r.x").alias("gone"), F.col("r.y").alias("into")), "linkage-merged")
        if merged.isEmpty():
            drop_cut(edges)
            drop_cut(merged)
            break
        merges.append(merged)
        a, b = merged.select(F.col("gone").alias("a"), F.col("into").alias("ia")), merged.select(F.col("gone").alias("b"), F.col("into").alias("ib"))
        # sizes: the id that stays takes over the count of the one that goes
        size = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("na").alias("n")), F.struct(F.col("b").alias("v"), F.col("nb").alias("n")))).alias("e")).select("e.v", "e.n").distinct()
        grown = merged.join(size.withColumnRenamed("v", "gone"), "gone").select(F.col("into").alias("v"), F.col("n").alias("plus"))
        grown = size.join(grown, "v", "inner").select("v", (F.col("n") + F.col("plus")).alias("n"))
        moved = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ia", "a").alias("a"), F.coalesce("ib", "b").alias("b"), "sim", "na", "nb").where("a <> b")
        both = moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim", F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"), F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"))
        summed = both.groupBy("a", "b").agg(F.sum("sim").alias("sim"), F.max("na").alias("na"), F.max("nb").alias("nb"))
        ga, gb = grown.select(F.col("v").alias("a"), F.col("n").alias("ga")), grown.select(F.col("v").alias("b"), F.col("n").alias("gb"))
        after = cut(summed.join(ga, "a", "left").join(gb, "b", "left").select("a", "b", "sim", F.coalesce("ga", "na").alias("na"), F.coalesce("gb", "nb").alias("nb")), "linkage")
        drop_cut(edges)
        edges = after
        if len(merges) == 8:  # keeps the plan short
            merges = [_followed(merges)]
    if not merges:
        kind = pairs.schema["a"].dataType.simpleString()
        return pairs.sparkSession.createDataFrame([], f"id {kind}, cluster {kind}")
    into = _followed(merges)
    return into.select(F.col("gone").alias("id"), F.col("into").alias("cluster")).unionByName(into.select(F.col("into").alias("id"), F.col("into").alias("cluster")).distinct())


def name_clusters(person: DataFrame, least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(clusters, features) of the unmatched rows of ``person``; clusters go by number."""
    feats = numbered(people.unmatched_features(person))
    return average_linkage(similar_numbers(feats, sure=least), least), feats


def spelled_differently(person: DataFrame, least: float = 0.5) -> DataFrame:
    """(person_id_a, person_id_b): pairs of one cluster, smaller id first, whose names are written differently."""
    clusters, feats = name_clusters(person, least)
    named = clusters.join(feats.select(F.col("no").alias("id"), "person_id", "name"), "id")
    a, b = named.alias("a"), named.alias("b")
    return a.join(b, (F.col("a.cluster") == F.col("b.cluster")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.name") != F.col("b.name"))).select(F.col("a.person_id").alias("person_id_a"), F.col("b.person_id").alias("person_id_b"))
