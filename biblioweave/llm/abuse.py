"""Problem 10: abusive, hateful or sexual passages, by maximum-scoring segments over token log-odds.

1. Every text becomes numbers of words, with disguised spellings (spaced, starred, leet, stretched, zero-width) resolved
   where that gives a word of the seed list, and marks for quoted words and sentence starts. Quotations are found in the
   whole text before it is split, of any length and over any number of sentences.
2. Sentences with an unquoted seed word are the first guess of the abusive class. It grows by the company that words keep:
   a word or pair of words weighs the log-odds that a text with it also has a sentence of the class elsewhere, against the
   rate of texts of the same ``strata``, less a standard deviation. Sentences whose weights add up join, round by round.
3. Token and pair counts of class and corpus give log-odds with an informative Dirichlet prior (the whole corpus).
4. In each text the linear-time scan of Ruzzo and Tompa finds all maximal segments. A segment of score S in a text of n
   tokens is expected ``K n exp(-lambda S)`` times by chance; lambda solves the Karlin-Altschul equation for the scores
   of sober sentences, K fits the maxima of texts. A text's score is ``-log10`` of the chance of its best segment.

Counts, weights and calibration cover all texts. Words and pairs are keyed by 64 bits of their hash; weights are kept for
those that at least ``least_docs`` texts of the class hold and that weigh more than an unknown one. They are the only thing
that reaches the driver; ``MAX_WEIGHTS`` bounds it with an error that names the parameter, never by dropping some.
Defined cases: null and empty texts score 0; quoted words never count for abuse; texts of any length are scanned whole;
repeated ids give as many rows; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, drop_cut
from .common import fold

#: Single words that are insults, slurs, obscenities or sexual in four languages, folded to plain letters; written from
#: general knowledge, after the kind of public word lists of profanity, and not read off any table. Fixed values.
SEED_WORDS = frozenset(
    """idiot idiots idiotic moron morons moronic imbecile imbeciles cretin cretins halfwit halfwits dimwit dimwits nitwit nitwits dumbass stupid fool fools loser losers
    bastard bastards asshole assholes arsehole jackass jerk jerks scum scumbag scumbags shithead dickhead douchebag wanker twat cunt cunts bitch bitches whore whores slut sluts slutty
    fuck fucking fucked fucker motherfucker shit shitty bullshit crap goddamn retard retards retarded faggot faggots vermin parasite parasites subhuman subhumans
    worthless pathetic useless brainless spineless gutless disgusting filthy ugly porn porno orgy horny erection orgasm blowjob tits boobs nude nudes naked sexy
    arschloch scheisse scheiss verpiss fresse schlampe hure hurensohn wichser fotze ficken trottel vollidiot dummkopf schwachkopf versager abschaum ungeziefer missgeburt nackt
    connard connards connasse conne salope salaud salopard putain merde foutre encule batard abruti cretine vermine nue nues
    idiota idiotas imbecil puta putas mierda carajo gilipollas cabron pendejo basura cobarde follar desnuda desnudas""".split()
)
#: Seeds that also have sober uses: they count only with a second one or a word of address in the same sentence.
WEAK_SEEDS = frozenset("retarded retard retards tits boobs stupid fool fools loser losers jerk jerks crap parasite parasites vermin vermine useless pathetic disgusting filthy ugly worthless naked nude nudes nackt nue nues desnuda desnudas erection orgasm horny sexy basura cobarde".split())
ADDRESS = frozenset("you your yours yourself u du dich dir dein deine deinen ihr euch tu te toi ton ta tes vous votre ti tus usted ustedes".split())
LEET = (str.maketrans("013457@$!€", "oieastasie"), str.maketrans("013457@$!€", "oleastasle"))
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff\ue000\ue001]")
_TAGS = re.compile(r"</?[A-Za-z!][^<>]*>")
_SENTENCE = re.compile("(?:(?<=[.!?…])|(?<=[.!?…][\"'”’»])|(?<=[.!?…][\"'”’»]\ue001))\\s+|[\\r\\n]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]{1,2}[ .\-_]){3,}[^\W_]{1,2}(?![^\W_])", re.UNICODE)
_PAIRED = {"“": "”", "„": "“”", "«": "»", "‘": "’"}
_MARK = re.compile(r"[\"'“”„«»‘’]")
_WORD = re.compile(r"[^\W_]+", re.UNICODE)
_STRETCHED = re.compile(r"(.)\1{2,}")


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the quotations of a text, of any length; a mark that opens and is never closed quotes nothing."""
    out: list[tuple[int, int]] = []
    openings: dict[str, int] = {}
    for m in _MARK.finditer(text):
        ch, i = m.group(0), m.start()
        before, after = text[i - 1 : i], text[i + 1 : i + 2]
        if ch in "\"'":
            closes = bool(before) and not before.isspace() and not (after.isalnum() or after == "_")
            opens = bool(after) and not after.isspace() and not (before.isalnum() or before == "_")
            if closes and ch in openings:
                out.append((openings.pop(ch), i + 1))
            elif opens:
                openings[ch] = i
            continue
        opener = next((o for o in openings if ch in _PAIRED.get(o, "")), None)
        if ch in "”»’“" and opener and not (ch == "’" and after.isalnum()):
            out.append((openings.pop(opener), i + 1))
        elif ch in _PAIRED:
            openings[ch] = i
    merged: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _starred(chunk: str) -> str | None:
    if "*" in chunk and chunk[0].isalpha() and len(chunk) > 2:
        shape = re.compile("".join("." if c == "*" else re.escape(c) for c in chunk))
        return next((w for w in sorted(SEED_WORDS) if len(w) == len(chunk) and shape.fullmatch(w)), None)
    return None


@lru_cache(maxsize=200_000)
def words_of(chunk: str) -> tuple[str, ...]:
    """The folded words of a run of characters without space; one word where it is a seed in disguise."""
    low = fold(chunk).strip(".,;:!?\"'()[]{}<>“”‘’«»„…-")
    if not low:
        return ()
    plain = re.sub(r"[^\w*@$!€]|_", "", low)
    if plain.isalpha() and (plain in SEED_WORDS or plain == low and not _STRETCHED.search(plain)):
        return (plain,)
    for form in dict.fromkeys((plain, plain.translate(LEET[0]), plain.translate(LEET[1]))):
        for short in (form, _STRETCHED.sub(r"\1", form), _STRETCHED.sub(r"\1\1", form)):
            if short in SEED_WORDS:
                return (short,)
    if hit := _starred(plain):
        return (hit,)
    return tuple(_WORD.findall(_STRETCHED.sub(r"\1", low) if _STRETCHED.search(low) and low.isalpha() else low))


def _joined(m: re.Match) -> str:
    run = re.sub(r"[ .\-_]", "", m.group(0))
    letters = m.group(0).split()
    for a in range(len(letters) - 3):  # the word may start after an article
        for b in range(len(letters), a + 3, -1):
            if words_of("".join(letters[a:b])) and words_of("".join(letters[a:b]))[0] in SEED_WORDS:
                return " ".join([*letters[:a], "".join(letters[a:b]), *letters[b:]])
    return run if fold(run) in SEED_WORDS else m.group(0)


def sentences(text: str) -> list[tuple[list[str], list[bool]]]:
    """(words, which of them are quoted) of every sentence."""
    text = _TAGS.sub(" ", html.unescape(_HIDDEN.sub("", text)))
    at, parts = 0, []
    for a, b in quoted_spans(text):
        parts += [text[at:a], "\ue000", text[a:b], "\ue001"]
        at = b
    text = "".join([*parts, text[at:]])
    out, inside = [], False
    for sentence in _SENTENCE.split(text):
        words, quoted = [], []
        spaced = _SPACED.sub(_joined, sentence)
        marked = "\ue000" in spaced or "\ue001" in spaced
        if not marked:
            for chunk in spaced.split():
                words += words_of(chunk)
            quoted = [inside] * len(words)
        for chunk in spaced.split() if marked else ():
            for piece in re.split("([\ue000\ue001])", chunk):
                if piece in ("\ue000", "\ue001"):
                    inside = piece == "\ue000"
                elif piece:
                    w = words_of(piece)
                    words += w
                    quoted += [inside] * len(w)
        if words:
            out.append((words, quoted))
    return out


def seeded(words: list[str], quoted: list[bool]) -> bool:
    """True where a sentence has a seed word of its own."""
    strong = weak = 0
    for w, q in zip(words, quoted, strict=True):
        if not q and w in SEED_WORDS:
            weak += w in WEAK_SEEDS
            strong += w not in WEAK_SEEDS
    return strong > 0 or weak > 1 or (weak == 1 and any(w in ADDRESS for w in words))


@lru_cache(maxsize=500_000)
def number(word: str) -> int:
    """The key of a word: 62 bits of its hash."""
    return xxhash.xxh64_intdigest(word) >> 2


def pair_numbers(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The key of each token with the one before it; ``first`` marks those that start a text. Words' keys are positive, these negative."""
    before = np.concatenate([np.zeros(1, np.uint64), ids[:-1].astype(np.uint64)])
    before[first] = 0
    with np.errstate(over="ignore"):
        z = (ids.astype(np.uint64) ^ (before * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))) * np.uint64(0xBF58476D1CE4E5B9)
    return -((z ^ (z >> np.uint64(31))) >> np.uint64(2)).astype(np.int64) - 1


NO_STRATUM = "\u0001"


def tokenised(docs: DataFrame, keep: list[str], stratum: Column, text: str = "text") -> DataFrame:
    """``keep``, stratum, ids (keys of tokens), starts (of sentences), quoted (token places) and seeds (seeded sentences)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for t in batch["_text"]:
                ids: list[int] = []
                starts, marks, seeds = [], [], []
                for k, (words, quoted) in enumerate(sentences(t) if t else ()):
                    starts.append(len(ids))
                    marks += [len(ids) + i for i, q in enumerate(quoted) if q]
                    if seeded(words, quoted):
                        seeds.append(k)
                    ids += [number(w) for w in words]
                for c, v in zip(cols, (ids, starts, marks, seeds), strict=True):
                    c.append(v)
            yield batch[[*keep, "_stratum"]].assign(ids=cols[0], starts=cols[1], quoted=cols[2], seeds=cols[3])

    source = docs.select(*keep, stratum.alias("_stratum"), F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text")
    return source.mapInPandas(run, f"{schema}, ids array<bigint>, starts array<int>, quoted array<int>, seeds array<int>")


class Batch:
    """The texts of a batch end to end, as flat arrays."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        ids = batch["ids"]
        self.ids = ids.flatten().to_numpy(zero_copy_only=False)
        self.n = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)  # tokens of each text
        self.at = np.concatenate([[0], np.cumsum(self.n)])[:-1]
        self.text = np.repeat(np.arange(len(self.n)), self.n)  # text of each token
        first = np.zeros(len(self.ids), bool)
        first[self.at[self.n > 0]] = True
        self.pairs = pair_numbers(self.ids, first) if len(self.ids) else self.ids
        starts, per = self._flat(batch["starts"])
        self.per = per  # sentences of each text
        self.start = starts + np.repeat(self.at, per)
        self.owner = np.repeat(np.arange(len(per)), per)  # text of each sentence
        self.sentence = np.repeat(np.arange(len(self.start)), np.diff(np.append(self.start, len(self.ids))))  # of each token
        marks, of = self._flat(batch["quoted"])
        self.quoted = np.zeros(len(self.ids), bool)
        self.quoted[marks + np.repeat(self.at, of)] = True
        seeds, of = self._flat(batch["seeds"])
        self.seeded = np.zeros(len(self.start), bool)
        self.seeded[seeds + np.repeat(np.concatenate([[0], np.cumsum(per)])[:-1], of)] = True

    @staticmethod
    def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

    def sums(self, scores: np.ndarray) -> np.ndarray:
        """The sum of the scores of each sentence."""
        return np.bincount(self.sentence, weights=scores, minlength=len(self.start)) if len(self.start) else np.zeros(0)


@dataclass
class Weights:
    """Log-odds of words and pairs by sorted key; all others weigh ``floor``, and quoted words no more than ``hush``."""

    keys: np.ndarray
    values: np.ndarray
    floor: float
    hush: float
    pair_share: float

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The weights of keys."""
        if not len(self.keys):
            return np.full(len(keys), self.floor)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], self.floor)

    def scores(self, b: Batch) -> np.ndarray:
        """The score of each token: its own and a share of that of the pair it ends."""
        s = self.of(b.ids) + self.pair_share * self.of(b.pairs)
        return np.where(b.quoted, np.minimum(s, self.hush), s)


#: Weights of one kind that the driver may hold (16 bytes each); ``least_docs`` is the parameter that lowers their number.
MAX_WEIGHTS = 8_000_000
#: Log-odds that a word must have beyond its standard deviation to speak for abuse by its company, and the sum of a sentence that joins.
LIFT, JOIN_AT = 0.5, 3.0
FLOOR = -1.5


def in_class(b: Batch, company: list[Weights]) -> np.ndarray:
    """Which sentences are of the class: seeded, or joined by the weights of one of the rounds."""
    out = b.seeded.copy()
    for w in company:
        out |= b.sums(w.scores(b)) >= JOIN_AT
    return out


def _gathered(rows: DataFrame, floor: float, hush: float, pair_share: float) -> Weights:
    """``rows`` (key, w) as weights, after a check of their number."""
    rows = cut(rows, "abuse-weights")
    n = rows.count()
    if n > MAX_WEIGHTS:
        raise ValueError(f"{n} words and pairs have weights, more than {MAX_WEIGHTS}: raise least_docs")
    got = rows.toPandas().sort_values("key")
    drop_cut(rows)
    return Weights(got["key"].to_numpy(np.int64), got["w"].to_numpy(np.float64), floor, hush, pair_share)


def corpus_counts(tokens: DataFrame) -> DataFrame:
    """(key, stratum, n, a): texts and tokens with each word and pair, by stratum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = Batch(batch)
            stratum = pd.Series(batch["_stratum"].to_pandas()).fillna(NO_STRATUM)
            codes, names = pd.factorize(stratum)
            for keys in (b.ids, b.pairs):
                if not len(keys):
                    continue
                each = pd.DataFrame({"key": keys, "text": b.text}).groupby(["key", "text"], sort=False).size().rename("a").reset_index()
                each["code"] = codes[each["text"]]
                got = each.groupby(["key", "code"], sort=False)["a"].agg(["size", "sum"]).reset_index()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got["key"], pa.int64()), pa.array(names[got["code"]].astype(object), pa.string()), pa.array(got["size"], pa.int64()), pa.array(got["sum"], pa.int64())],
                    names=["key", "stratum", "n", "a"],
                )

    counted = tokens.mapInArrow(run, "key bigint, stratum string, n bigint, a bigint")
    return counted.groupBy("key", "stratum").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))


def class_counts(tokens: DataFrame, company: list[Weights]) -> DataFrame:
    """(kind, key, stratum, c, y, m), summed over all texts.

    kind 0: for a key, its tokens in the class (c), the texts of the class that have it outside of class sentences (y), and
    those that have it inside only (m). kind 1: for a stratum, its texts (c), those with a sentence outside of the class (m),
    and of these the ones with one inside (y); key -1 has the tokens of the class (c), of all texts (y) and class sentences (m).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, key, stratum, c, y, m) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), kind), pa.int32()), pa.array(key, pa.int64()), pa.array(stratum, pa.string()), pa.array(c, pa.int64()), pa.array(y, pa.int64()), pa.array(m, pa.int64())],
                names=["kind", "key", "stratum", "c", "y", "m"],
            )

        for batch in batches:
            b = Batch(batch)
            codes, names = pd.factorize(pd.Series(batch["_stratum"].to_pandas()).fillna(NO_STRATUM))
            names = names.astype(object)
            inside = in_class(b, company)
            texts = len(b.n)
            has = np.bincount(b.owner[inside], minlength=texts) > 0
            beside = np.bincount(b.owner[~inside], minlength=texts) > 0
            k = len(names)
            yield out(1, np.zeros(k, np.int64), names, np.bincount(codes, minlength=k), np.bincount(codes[has & beside], minlength=k), np.bincount(codes[beside], minlength=k))
            token_in = inside[b.sentence] if len(b.ids) else np.zeros(0, bool)
            yield out(1, np.full(1, -1), [NO_STRATUM], [int(token_in.sum())], [len(b.ids)], [int(inside.sum())])
            of_class = has[b.text] if len(b.ids) else token_in
            free = of_class & ~token_in & ~b.quoted
            for keys in (b.ids, b.pairs):
                if not of_class.any():
                    continue
                each = pd.DataFrame({"key": keys[of_class], "text": b.text[of_class], "c": token_in[of_class].astype(np.int64), "free": free[of_class]})
                each = each.groupby(["key", "text"], sort=False).agg(c=("c", "sum"), free=("free", "max")).reset_index()
                each["code"], each["y"] = codes[each["text"]], each["free"].astype(np.int64)
                each["m"] = 1 - each["y"]
                got = each.groupby(["key", "code"], sort=False)[["c", "y", "m"]].sum().reset_index()
                yield out(0, got["key"], names[got["code"]], got["c"], got["y"], got["m"])

    counted = tokens.mapInArrow(run, "kind int, key bigint, stratum string, c bigint, y bigint, m bigint")
    return counted.groupBy("kind", "key", "stratum").agg(F.sum("c").alias("c"), F.sum("y").alias("y"), F.sum("m").alias("m"))


MAX_STRATA = 10_000


def _rates(strata: DataFrame) -> DataFrame:
    """(stratum, rate) of texts with a class sentence beside another; a small stratum leans on its first column's, worth ten texts."""
    parent = F.split(F.col("stratum"), "\u0002")[0]
    rows = strata.where("key = 0").withColumn("parent", parent)
    above = rows.groupBy("parent").agg((F.sum("y") / F.greatest(F.sum("m"), F.lit(1))).alias("above"))
    return rows.join(F.broadcast(above), "parent").select("stratum", ((F.col("y") + 10 * F.col("above")) / (F.col("m") + 10)).alias("rate"))


def company_weights(counts: DataFrame, corpus: DataFrame, least_docs: int, sure: float = 1.0, prior: float = 4.0) -> Weights:
    """Log-odds of the company of words and pairs, from ``class_counts`` and ``corpus_counts``."""
    strata = counts.where("kind = 1")
    if strata.where("key = 0").count() > MAX_STRATA:
        raise ValueError(f"there are more than {MAX_STRATA} strata")
    keyed = counts.where("kind = 0")
    wanted = keyed.groupBy("key").agg(F.sum("y").alias("y")).where(F.col("y") >= least_docs)
    beside = corpus.join(wanted, "key").join(keyed.select("key", "stratum", "m"), ["key", "stratum"], "left").join(F.broadcast(_rates(strata)), "stratum")
    left = F.greatest(F.col("n") - F.coalesce("m", F.lit(0)), F.lit(0))
    per = beside.groupBy("key").agg(F.first("y").alias("y"), F.sum(left).alias("n"), F.sum(left * F.col("rate")).alias("e"))
    p = F.least(F.greatest(F.col("e") / F.greatest(F.col("n"), F.lit(1)), F.lit(1e-4)), F.lit(0.9))
    per = per.select("key", "y", F.greatest("n", "y").alias("n"), p.alias("p"))
    i, o = F.col("y") + prior * F.col("p"), F.col("n") - F.col("y") + prior * (1 - F.col("p"))
    odds = F.log(i / o) - F.log(F.col("p") / (1 - F.col("p")))
    w = F.signum(odds) * F.greatest(F.lit(0.0), F.abs(odds) - sure * F.sqrt(1 / i + 1 / o)) - LIFT
    return _gathered(per.select("key", w.alias("w")).where(F.col("w") > -LIFT), -LIFT, -3.0, 1.0)


def class_weights(counts: DataFrame, corpus: DataFrame, least_docs: int, sure: float = 2.0, prior: float = 200.0, each: float = 2.0) -> Weights:
    """Log-odds of words and pairs in the class, less ``sure`` standard deviations.

    The prior of a key is the corpus, worth ``prior`` tokens, and ``each`` counts, in both classes by their sizes.
    """
    total = counts.where("kind = 1 and key = -1").agg(F.sum("c"), F.sum("y")).first()
    n_class, n_all = float(total[0] or 0), float(total[1] or 0)
    if not n_class or n_class >= n_all:
        return Weights(np.zeros(0, np.int64), np.zeros(0), FLOOR, 1.5 * FLOOR, 0.5)
    held = counts.where("kind = 0").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= least_docs)
    whole = corpus.join(held, "key").groupBy("key").agg(F.first("c").alias("c"), F.sum("a").alias("a"))
    share = n_class / n_all
    alpha = F.col("a") * (prior / n_all) + each
    i, o = F.col("c") + alpha * share, F.col("a") - F.col("c") + alpha * (1 - share)
    odds = F.log(i / o) - math.log(share / (1 - share))
    w = F.signum(odds) * F.greatest(F.lit(0.0), F.abs(odds) - sure * F.sqrt(1 / i + 1 / o))
    w = F.least(F.greatest(w, F.lit(FLOOR)), F.lit(4.0))
    return _gathered(whole.select("key", w.alias("w")).where(F.col("w") > FLOOR), FLOOR, 1.5 * FLOOR, 0.5)


def fit(tokens: DataFrame, rounds: int = 4, least_docs: int = 2) -> Weights:
    """Weights learned from the seeded sentences of all texts and those that join them in rounds."""
    corpus = cut(corpus_counts(tokens), "abuse-corpus")
    company: list[Weights] = []
    before = -1
    while True:
        counts = cut(class_counts(tokens, company), "abuse-class")
        now = counts.where("kind = 1 and key = -1").agg(F.sum("m")).first()[0] or 0
        if len(company) >= rounds or now == before or not now:
            weights = class_weights(counts, corpus, least_docs)
            drop_cut(counts)
            drop_cut(corpus)
            return weights
        company.append(company_weights(counts, corpus, least_docs))
        drop_cut(counts)
        before = now


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (start, end, score), by the linear-time scan of Ruzzo and Tompa."""
    stack: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    total = 0.0
    for i, x in enumerate(scores.tolist()):
        before, total = total, total + x
        if x <= 0:
            continue
        start, left = i, before
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= total:
                stack.append((start, i + 1, left, total))
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, after - before) for a, b, before, after in stack]


def best_segment(scores: np.ndarray) -> float:
    """The score of the best segment."""
    if not len(scores):
        return 0.0
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    return float(max(0.0, (sums[1:] - np.minimum.accumulate(sums)[:-1]).max()))


STEP = 0.25


def chance_of_segments(bins: np.ndarray, maxima: float, logs: float, n: float) -> tuple[float, float]:
    """(lambda, K) from the scores of sober sentences by ``STEP``, and sums over ``n`` sober texts: of maxima and of log lengths."""
    if not bins.sum():
        return 1.0, 0.1
    p, s = bins / bins.sum(), (np.arange(200) - 100) * STEP
    if p[s > 0].sum() == 0 or (p * s).sum() >= 0:
        return 1.0, 0.1
    lo, hi = 1e-6, 20.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 500))).sum() < 1 else (lo, mid)
    lam = (lo + hi) / 2
    k = math.exp(lam * maxima / n - logs / n - 0.5772) if n else 0.1
    return lam, min(1.0, max(k, 1e-6))


def score_texts(docs: DataFrame, row_id: str = "doc_id", keep: tuple[str, ...] = ("source",), strata: tuple[str, ...] = ("source", "lang"), rounds: int = 4, least_docs: int = 2, report_at: float = 6.0) -> DataFrame:
    """row_id, keep, abuse_score (``-log10`` of the chance), n_passages and the token place and score of the worst one."""
    stratum = F.concat_ws("\u0002", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in strata if c in docs.columns], F.lit(""))
    tokens = cut(tokenised(docs, [row_id, *keep], stratum), "abuse-tokens")
    weights = fit(tokens, rounds, least_docs)
    kept = [f for f in tokens.schema if f.name in (row_id, *keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each text, and one for each batch with the sums that calibrate (``bins``)."""
        for batch in batches:
            b = Batch(batch)
            s = weights.scores(b)
            heavy = b.sums(s) >= report_at
            sober = ~heavy[b.sentence] if len(s) else np.zeros(0, bool)
            bins = np.bincount(np.clip(np.round(s[sober] / STEP).astype(int) + 100, 0, 199), minlength=200).astype(float)
            clean = (np.bincount(b.owner[heavy], minlength=len(b.n)) == 0) & (b.n > 0)
            best, count, worst = np.zeros(len(b.n)), np.zeros(len(b.n), np.int32), np.full(len(b.n), -1, np.int32)
            for i in np.flatnonzero(b.n):
                part = s[b.at[i] : b.at[i] + b.n[i]]
                best[i] = best_segment(part)
                if best[i] >= report_at:
                    found = [g for g in segments(part) if g[2] >= report_at]
                    count[i], worst[i] = len(found), max(found, key=lambda g: g[2], default=(-1, -1, 0.0))[0]
            bins = np.concatenate([bins, [best[clean].sum(), np.log(np.maximum(b.n[clean], 1)).sum(), clean.sum()]])
            rows = len(b.n)
            cols = [batch[f.name] for f in kept] + [pa.array(b.n, pa.int64()), pa.array(best), pa.array(count), pa.array(worst), pa.nulls(rows, pa.list_(pa.float64()))]
            names = [*(f.name for f in kept), "_n", "_best", "n_passages", "worst_at", "_bins"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, batch[f.name].type) for f in kept), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.array([bins.tolist()], pa.list_(pa.float64()))], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    scanned = cut(tokens.mapInArrow(run, f"{schema}, _n bigint, _best double, n_passages int, worst_at int, _bins array<double>"), "abuse-scores")
    drop_cut(tokens)
    sums = {r[0]: r[1] for r in scanned.where("_bins is not null").select(F.posexplode("_bins")).groupBy("pos").agg(F.sum("col")).collect()}
    lam, k = chance_of_segments(np.array([sums.get(i, 0.0) for i in range(200)]), *(sums.get(i, 0.0) for i in (200, 201, 202)))
    expected = k * F.col("_n") * F.exp(-F.least(lam * F.col("_best"), F.lit(700.0)))
    chance = F.greatest(-F.expm1(-expected), F.lit(1e-300))
    score = F.when(F.col("_n") > 0, F.round(-F.log10(chance), 4)).otherwise(F.lit(0.0))
    return scanned.where("_bins is null").select(*[f.name for f in kept], score.alias("abuse_score"), "n_passages", "worst_at", F.round("_best", 4).alias("worst_score"))


#: A text is abusive where its best passage would come by chance in fewer than one text in a billion (a power of ten).
ABUSIVE_AT = 9.0


def abusive(scored: DataFrame, at: float = ABUSIVE_AT) -> DataFrame:
    """The rows of ``score_texts`` that count as abusive."""
    return scored.where(F.col("abuse_score") >= at)


def rates(scored: DataFrame, at: float = ABUSIVE_AT) -> DataFrame:
    """Texts, abusive texts and their share for each source."""
    n = F.count_if(F.col("abuse_score") >= at)
    return scored.groupBy("source").agg(F.count("*").alias("documents"), n.alias("abusive"), F.round(n / F.count("*"), 6).alias("rate"))
