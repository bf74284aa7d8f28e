"""Problem 4: records of different sources that describe one person, by sorted neighbourhoods and one-to-one assignment.

1. Every record gets a sort key for each of several composites (institution and name, name and subject, given name and
   institution, identifier, mailbox). All keys are sorted together over the cluster; each record is compared with the
   ``window - 1`` before it. Sorted rows get their place in the whole order, and runs of ``run`` places go to one task
   with the neighbours across the border, so neither a frequent name nor a source can overload a task. Rows that tie on
   a key have no order among them: all of them are compared, runs of more than ``CHUNK`` in pairs of chunks.
2. Weighted similarities of the fields add up to a confidence (``people.evidence``).
3. Records of one source that are one person form an entity by average linkage. Whatever sure pairs link, directly or
   through others, is compared whole first, so no average counts a pair that the window left out. Between each two sources, entities are
   assigned one to one so that the total confidence is the largest: pairs without a rival at once, those of a component
   of at most ``MOST`` pairs exactly, by shortest augmenting paths, and those of larger ones by an auction that runs
   until nobody bids, whose total is within ``EPSILON`` for each assigned entity of the best.
4. Entities assigned to each other, directly or through a third source, are one person; their pairs of records come out.

Defined cases: rows without any name are compared by their other fields only if an alias exists; an empty source list is
a source of its own; repeated rows count once; an empty table gives no rows; ties go to the smaller ids.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, drop_cut
from . import people
from .components import hash_to_min
from .spellings import average_linkage, numbered

EPSILON = 0.01
MOST = 20_000
CHUNK = 256
PAIR = "a bigint, b bigint, src_a string, src_b string, sim double"


class Comparer:
    """Compares records and keeps the pairs that may be one person."""

    def __init__(self, rarity: people.Rarity) -> None:
        self.rarity = rarity
        self.found: list[tuple] = []
        self.seen: set[tuple[int, int]] = set()

    def opened(self, row: tuple) -> list:
        """A ``people.ROW`` for ``compare``: number, source, subject, marks of the name, the row itself, and its features once they are needed."""
        words, more, _ = row[4].split("\t", 2)
        return [row[0], row[1], row[2], people.name_marks((None, None, None, words.split(), more.split())), row, None]

    def compare(self, old: list, new: list) -> None:
        if old[0] == new[0] or old[2] and new[2] and old[2] != new[2] or not people.maybe_same_name(new[3], old[3]):
            return
        x, y = (old, new) if old[0] < new[0] else (new, old)
        if (x[0], y[0]) in self.seen:
            return
        if len(self.seen) > 500_000:
            self.seen.clear()  # only saves work: pairs are made distinct later
        self.seen.add((x[0], y[0]))
        for r in (x, y):
            r[5] = r[5] or people.unpacked(r[4])
        e = people.evidence(x[5], y[5], self.rarity)
        if e > -math.inf and (sim := people.confidence(e, self.rarity)) > 0.01:
            self.found.append((x[0], y[0], x[1], y[1], sim))

    def taken(self) -> pd.DataFrame:
        """The pairs found since the last call."""
        found, self.found = self.found, []
        return pd.DataFrame(found, columns=["a", "b", "src_a", "src_b", "sim"])


def sort_keys(row: tuple, rarity: people.Rarity) -> list[str]:
    """The composite sort keys of a record; the first letters name the composite."""
    words = [w for w in row[3] if w not in people.PARTICLES]
    long = [w for w in words if len(w) > 2] or [w for w in row[4] if len(w) > 2]
    if not long:
        return []
    # the family name: where a comma shows it, else the rarest word
    family = row[5] or max(long, key=lambda w: (rarity(w), w))
    given = next((w for w in words if w != family and len(w) > 1), next((w for w in row[4] if people.word_match(w, family) == 0), next((w for w in words if w != family), "")))
    given = min(people.FULL_OF.get(given, {given}))
    places = sorted({p[:6] for p in row[11]} | ({row[9][:6]} if row[9] and not row[10] else set()))
    out = [f"1|{p}|{family}|{given}" for p in places]
    out += [f"3|{given[:4]}|{p}|{family}" for p in places if len(given) > 1]
    out.append(f"2|{family}|{given[:1]}|{row[6]}|{places[0] if places else ''}")
    if row[7]:
        out += [f"4|{row[7][-16:]}", f"5|{row[7][::-1]}"]
    if row[8]:
        out.append(f"6|{row[9]}|{row[8]}")
    return out


def compared(groups: DataFrame, feats: DataFrame, rarity: people.Rarity) -> DataFrame:
    """(a, b, src_a, src_b, sim) of all pairs that share a group (g, no); pairs may repeat."""
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    dealt = groups.join(groups.groupBy("g").agg(F.count("*").alias("n")), "g").withColumn("chunk", F.pmod(F.xxhash64("no", F.lit(5)), chunks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = dealt.select("g", "no", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    rows = dealt.join(people.packed(feats), "no").repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi", "no")

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: list[tuple] = []
        now = None
        comparer = Comparer(rarity)
        for b in batches:
            for g, lo, hi, chunk, *row in zip(*(b[c].tolist() for c in ("g", "lo", "hi", "chunk", *people.ROW)), strict=True):
                if (g, lo, hi) != now:
                    group, now = [], (g, lo, hi)
                new = comparer.opened(tuple(row))
                for other, old in group:
                    if lo == hi or chunk != other:  # else they meet where their chunk meets itself
                        comparer.compare(old, new)
                group.append((chunk, new))
                if len(comparer.found) >= 50_000:
                    yield comparer.taken()
            yield comparer.taken()

    return rows.mapInPandas(pair, PAIR)


def neighbours(feats: DataFrame, window: int = 10, run: int | None = None, rarity: people.Rarity | None = None) -> DataFrame:
    """(a, b, src_a, src_b, sim): numbers of compared pairs that may be one person, a < b, each once.

    With ``run``, tasks get about so many sorted rows, else as many as the session deals to one.
    """
    feats = feats if "no" in feats.columns else numbered(feats)
    rarity = rarity or people.count_words(feats)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [sort_keys(people.unpacked(r), rarity) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            at = pa.array(np.repeat(np.arange(len(keys)), [len(ks) for ks in keys]))
            yield pa.RecordBatch.from_arrays([pa.array([k for ks in keys for k in ks], pa.string()), *(c.take(at) for c in b.columns)], names=["key", *people.ROW])

    tall = cut(people.packed(feats).mapInArrow(keyed, "key string, no bigint, src string, subject string, country string, rest string"), "sort-keys")
    tasks = [max(1, math.ceil(tall.count() / run))] if run else []
    ordered = tall.repartitionByRange(*tasks, "key", "no").sortWithinPartitions("key", "no")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs; the rows at both ends of the task, as a with its features; and the rows of ties that are, or may go on to be, longer than the window, as a with the key."""
        part = TaskContext.get().partitionId()
        comparer = Comparer(rarity)
        recent: list[list] = []
        at, key, first, tied = 0, None, True, []
        for b in batches:
            ends, ties = [], []
            for k, *row in zip(*(b[c].tolist() for c in ("key", *people.ROW)), strict=True):
                new = comparer.opened(tuple(row))
                for old in recent:
                    comparer.compare(old, new)
                recent.append(new)
                if len(recent) >= window:
                    del recent[0]
                if at < window - 1:
                    ends.append((at, *row))
                at += 1
                if k != key:
                    first, key, tied, length = key is None, k, [], 0
                tied.append(row[0])
                length += 1
                if first or length > window:
                    ties += [(k, i) for i in tied]
                    tied = []
            yield comparer.taken()
            yield pd.DataFrame(ends, columns=["at", "a", "src_a", "subject", "country", "rest"]).assign(part=part)
            yield pd.DataFrame(ties, columns=["key", "a"])
        last = [(at - len(recent) + i, *r[4]) for i, r in enumerate(recent)]
        yield pd.DataFrame([r for r in last if r[0] >= window - 1], columns=["at", "a", "src_a", "subject", "country", "rest"]).assign(part=part)
        yield pd.DataFrame([(key, i) for i in tied], columns=["key", "a"])

    kinds = {"a": "Int64", "b": "Int64", "src_a": object, "src_b": object, "sim": "Float64", "part": "Int64", "at": "Int64", "key": object, "subject": object, "country": object, "rest": object}

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in compare(batches):
            if len(x):
                yield pd.DataFrame({c: x[c].astype(kind) if c in x else pd.Series([None] * len(x), dtype=kind) for c, kind in kinds.items()})

    met = cut(ordered.mapInPandas(aligned, f"{PAIR}, part int, at bigint, key string, subject string, country string, rest string"), "met")
    drop_cut(tall)

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        comparer = Comparer(rarity)
        recent: list[tuple[int, list]] = []
        for b in batches:
            for part, *row in zip(*(b[c].tolist() for c in ("part", "a", "src_a", "subject", "country", "rest")), strict=True):
                new = comparer.opened(tuple(row))
                for other, old in recent:
                    if other != part:  # else they have met
                        comparer.compare(old, new)
                recent.append((part, new))
                if len(recent) >= window:
                    del recent[0]
            yield comparer.taken()

    # both ends of all tasks are few; between the last rows of a task and the first ones of the next there are no others
    borders = met.where("part is not null").select("part", "at", "a", "src_a", "subject", "country", "rest").repartition(1).sortWithinPartitions("part", "at")
    found = [met.where("b is not null").select("a", "b", "src_a", "src_b", "sim"), borders.mapInPandas(across, PAIR)]
    tied = met.where("key is not null").select(F.xxhash64("key").alias("g"), F.col("a").alias("no"))
    long = tied.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > window).select("g")
    tied = cut(tied.join(long, "g", "left_semi"), "tied")
    if not tied.isEmpty():
        found.append(compared(tied, feats, rarity))
    # a pair has its sources: they are grouped by, as numbers alone aggregate without sorting
    return functools.reduce(DataFrame.unionByName, found).groupBy("a", "b", "src_a", "src_b").agg(F.max("sim").alias("sim"))


def best_assignment(edges: list[tuple[str, str, float]]) -> list[tuple[str, str, float]]:
    """The (a, b, v) of the assignment with the largest total, by shortest augmenting paths; an a may stay alone for 0."""
    top = max((v for *_, v in edges), default=0.0)
    out: dict[str, list[tuple[tuple[int, str], float]]] = {}
    value: dict[tuple[str, str], float] = {}
    for a, b, v in sorted(edges):
        out.setdefault(a, []).append(((1, b), top - v))
        value[a, b] = v
    price_a: dict[str, float] = {}
    price_b: dict[tuple[int, str], float] = {}
    owner: dict[tuple[int, str], str] = {}
    held: dict[str, tuple[int, str]] = {}
    for a in out:
        out[a].append(((0, a), top))  # its place for staying alone
        price_a[a] = 0.0
        dist: dict[tuple[int, str], float] = {}
        back: dict[tuple[int, str], str] = {}
        done: list[tuple[int, str]] = []
        closed: set[tuple[int, str]] = set()
        heap: list[tuple[float, tuple[int, str]]] = []
        row, base = a, 0.0
        while True:
            for place, cost in out[row]:
                d = base + cost - price_a[row] - price_b.get(place, 0.0)
                if place not in closed and d < dist.get(place, math.inf):
                    dist[place], back[place] = d, row
                    heapq.heappush(heap, (d, place))
            d, place = heapq.heappop(heap)
            while place in closed:
                d, place = heapq.heappop(heap)
            if place not in owner:
                break
            closed.add(place)
            done.append(place)
            row, base = owner[place], d
        price_a[a] += d
        for x in done:
            price_a[owner[x]] += d - dist[x]
            price_b[x] = price_b.get(x, 0.0) - (d - dist[x])
        while True:
            row = back[place]
            owner[place] = row
            place, held[row] = held.get(row), place
            if row == a:
                break
    return [(a, b, value[a, b]) for a, (real, b) in sorted(held.items()) if real]


def assign(edges: DataFrame) -> DataFrame:
    """(a, b, v) of the assignment of each a to at most one b, and of each b to one a, with the largest total v > 0."""
    edges = cut(edges.where("v > 0").groupBy("a", "b").agg(F.max("v").alias("v")), "assign")
    rivals_a = edges.groupBy("a").agg(F.count("*").alias("n_a"))
    rivals_b = edges.groupBy("b").agg(F.count("*").alias("n_b"))
    counted = cut(edges.join(rivals_a, "a").join(rivals_b, "b"), "assign-counted")
    alone = counted.where("n_a = 1 and n_b = 1").select("a", "b", "v")
    rivals = counted.where("n_a > 1 or n_b > 1").select("a", "b", "v")
    # the sides are told apart, as an a may be named like a b
    parts = hash_to_min(rivals.select(F.concat(F.lit("a"), "a").alias("a"), F.concat(F.lit("b"), "b").alias("b")), "a", "b")
    parted = cut(rivals.join(parts.where("node like 'a%'").select(F.expr("substr(node, 2)").alias("a"), "component"), "a"), "assign-parted")
    sizes = parted.groupBy("component").agg(F.count("*").alias("n"))
    small = parted.join(sizes.where(F.col("n") <= MOST).select("component"), "component", "left_semi").repartition("component").sortWithinPartitions("component")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, group = None, []
        for batch in batches:
            found = []
            for c, *edge in batch[["component", "a", "b", "v"]].itertuples(index=False, name=None):
                if c != now:
                    found += best_assignment(group)
                    now, group = c, []
                group.append(tuple(edge))
            yield pd.DataFrame(found, columns=["a", "b", "v"])
        yield pd.DataFrame(best_assignment(group), columns=["a", "b", "v"])

    solved = small.mapInPandas(solve, "a string, b string, v double")
    large = cut(parted.join(sizes.where(F.col("n") > MOST).select("component"), "component", "left_semi").select("a", "b", "v"), "assign-large")
    return alone.unionByName(solved).unionByName(auction(large))


def auction(edges: DataFrame) -> DataFrame:
    """What ``assign`` gives, but for ``EPSILON`` for each assigned a. Every bid raises a price, so it ends."""
    owners = cut(edges.sparkSession.createDataFrame([], "b string, a string, price double"), "assign-owners")
    while True:
        priced = edges.join(owners.select("b", "price"), "b", "left").withColumn("net", F.col("v") - F.coalesce("price", F.lit(0.0)))
        bidders = priced.join(owners.select("a"), "a", "left_anti").where("net > 0")
        order = Window.partitionBy("a").orderBy(F.desc("net"), "b")
        top = bidders.withColumn("r", F.row_number().over(order)).withColumn("second", F.coalesce(F.lead("net").over(order), F.lit(0.0))).where("r = 1")
        bids = top.select("b", "a", (F.coalesce("price", F.lit(0.0)) + F.col("net") - F.col("second") + EPSILON).alias("price"))
        won = cut(bids.groupBy("b").agg(F.max_by("a", F.struct("price", "a")).alias("a"), F.max("price").alias("price")), "assign-won")
        if won.isEmpty():
            drop_cut(won)
            break
        after = cut(owners.join(won.select("b"), "b", "left_anti").unionByName(won), "assign-owners")
        drop_cut(owners)
        drop_cut(won)
        owners = after
    return edges.join(owners.select("a", "b"), ["a", "b"])


def inner_pairs(pairs: DataFrame, feats: DataFrame, rarity: people.Rarity, least: float) -> DataFrame:
    """(a, b, sim) of all pairs among records of one source that pairs of at least ``least`` link, however indirectly."""
    sure = pairs.where((F.col("src_a") == F.col("src_b")) & (F.col("sim") >= least)).select("a", "b", "sim")
    linked = cut(hash_to_min(sure, "a", "b").select(F.col("component").alias("g"), F.col("node").alias("no")), "inner")
    # a component of two is the pair itself
    large = linked.groupBy("g").agg(F.count("*").alias("n")).where("n > 2").select("g")
    larger = cut(linked.join(large, "g", "left_semi"), "inner-larger")
    two = sure.join(larger.select(F.col("no").alias("a")), "a", "left_anti")
    whole = compared(larger, feats, rarity).groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return two.unionByName(whole)


def linked_rows(person: DataFrame, least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(person_id_a, person_id_b, na, nb) of unmatched records of different sources, smaller id first, with their numbers; compared pairs."""
    feats = numbered(people.unmatched_features(person))
    rarity = people.count_words(feats)
    pairs = cut(neighbours(feats, rarity=rarity), "neighbours")
    entities = cut(average_linkage(inner_pairs(pairs, feats, rarity, least), least), "entities")
    across = pairs.where((F.col("src_a") != F.col("src_b")) & (F.col("sim") >= least))
    ea, eb = entities.select(F.col("id").alias("a"), F.col("cluster").alias("ea")), entities.select(F.col("id").alias("b"), F.col("cluster").alias("eb"))
    named = across.join(ea, "a", "left").join(eb, "b", "left").select("src_a", "src_b", F.coalesce("ea", "a").alias("ea"), F.coalesce("eb", "b").alias("eb"), "sim")
    # an entity has one place for each other source; the source whose name comes first bids
    first = F.col("src_a") < F.col("src_b")
    x, y = F.when(first, F.col("ea")).otherwise(F.col("eb")), F.when(first, F.col("eb")).otherwise(F.col("ea"))
    sx, sy = F.least("src_a", "src_b"), F.greatest("src_a", "src_b")
    # numbers as texts of one length are in the order of the numbers
    text = lambda n: F.lpad(n.cast("string"), 15, "0")
    edges = named.select(F.concat_ws("\u0001", text(x), sy).alias("a"), F.concat_ws("\u0001", text(y), sx).alias("b"), F.col("sim").alias("v"))
    chosen = assign(edges).select(*[F.substring_index(c, "\u0001", 1).cast("bigint").alias(c) for c in "ab"])
    persons = hash_to_min(chosen, "a", "b").select(F.col("node").alias("cluster"), "component")
    members = persons.join(entities, "cluster", "left").select("component", F.coalesce("id", "cluster").alias("no"))
    rows = cut(feats.select("no", "person_id", "src").join(members, "no"), "person-rows")
    l, r = rows.alias("l"), rows.alias("r")
    out = l.join(r, (F.col("l.component") == F.col("r.component")) & (F.col("l.no") < F.col("r.no")) & (F.col("l.src") != F.col("r.src")))
    return out.select(F.col("l.person_id").alias("person_id_a"), F.col("r.person_id").alias("person_id_b"), F.col("l.no").alias("na"), F.col("r.no").alias("nb")), pairs


def linked_ids(person: DataFrame, least: float = 0.5) -> DataFrame:
    """``linked_people`` without the confidence."""
    return linked_rows(person, least)[0].select("person_id_a", "person_id_b")


def linked_people(person: DataFrame, least: float = 0.5) -> DataFrame:
    """(person_id_a, person_id_b, confidence) of unmatched records of different sources, smaller id first."""
    out, pairs = linked_rows(person, least)
    seen = pairs.select(F.col("a").alias("na"), F.col("b").alias("nb"), F.col("sim").alias("direct"))
    # a pair that was not compared itself is as sure as the least that counts
    return out.join(seen, ["na", "nb"], "left").select("person_id_a", "person_id_b", F.round(F.coalesce("direct", F.lit(least)), 6).alias("confidence"))
