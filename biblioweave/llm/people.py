"""What two records of a person have in common: features of a record, and the evidence that two are the same person.

The evidence adds up as log-odds. Names must be compatible (typing slips, initials, order, nicknames, titles); a
different subject rules a pair out; identifiers, mailboxes, institutions, key words and counts weigh for or against.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .canonical import FILLER, KIND_OF, slips
from .common import PLACEHOLDERS, SHARED_MAILBOXES, fold, tokens

TITLES = frozenset("dr prof professor phd md mr mrs ms miss sir dame jr sr ii iii iv dipl ing msc bsc dphil hon".split())
PARTICLES = frozenset("van von de der den el al la le di da del dos du ter ten bin ibn".split())
#: Usual short forms of given names. Fixed values.
NICKNAMES = {
    "william": "bill billy will willy", "robert": "bob bobby rob robbie", "richard": "dick rick rich ricky", "elizabeth": "beth liz lizzie betty eliza", "katherine": "kate katie kathy kat kit",
    "michael": "mike mick mickey", "alexander": "alex sasha sandy alec xander aleksandr alexandr", "frederick": "fred freddy freddie", "gregory": "greg", "thomas": "tom tommy", "james": "jim jimmy jamie", "joseph": "joe joey jo",
    "anthony": "tony ant", "stephanie": "steph stef steffi", "samuel": "sam sammy", "daniel": "dan danny", "david": "dave davy", "edward": "ed eddie ted ned", "theodore": "theo ted teddy", "benjamin": "ben benny",
    "matthew": "matt matty", "margaret": "meg maggie peggy marge greta", "patricia": "pat patty trish tricia", "susan": "sue susie", "victoria": "vicky tori vic", "valentina": "vale val tina", "isabella": "bella isa izzy",
    "dorothy": "dot dottie dolly", "lawrence": "larry laurie", "nicholas": "nick nicky nico", "christopher": "chris kit topher", "charlotte": "charlie lottie", "deborah": "deb debbie", "jennifer": "jen jenny",
    "jonathan": "jon jonny", "zachary": "zach zack", "timothy": "tim timmy", "rebecca": "becky becca", "andrew": "andy drew", "gabriela": "gabi gaby", "natalia": "nat tasha", "magdalena": "magda lena", "francesca": "fran",
    "barbara": "barb barbie", "sebastian": "seb bastian", "philippa": "pip pippa", "philip": "phil", "johannes": "hans jan", "peter": "pete", "steven": "steve", "charles": "charlie chuck", "kenneth": "ken", "ronald": "ron",
    "catherine": "cathy cat", "alexandra": "alex sandra", "stephen": "steve", "ekaterina": "katya", "helena": "lena", "johanna": "hanna", "tomas": "tom", "oliver": "ollie", "leonard": "leo len", "abigail": "abby",
}
FULL_OF: dict[str, frozenset[str]] = {}
for _full, _short in NICKNAMES.items():
    for _n in _short.split():
        FULL_OF[_n] = FULL_OF.get(_n, frozenset()) | {_full}
GENERIC = frozenset("dept department div division faculty fac lab institute applied ecology engineering arts physics math chemistry medicine earth business econ grad comp campus main soft matter".split())
UNIT = GENERIC - {"institute"}
_UPPER = re.compile(r"[A-Z]{2}")


@lru_cache(maxsize=400_000)
def _word_tokens(w: str) -> tuple[str, ...]:
    return tuple(tokens(w))


def name_words(name: str) -> tuple[tuple[str, ...], str]:
    """(words of a name, initials single; the family name where a comma shows it, else "")."""
    raw = [w for w in re.split(r"[\s.,()\-]+", name) if w]
    long = any(len(w) > 2 for w in raw)
    words: list[str] = []
    for w in raw:
        t = _word_tokens(w)
        if not t or t[0] in TITLES:
            continue
        if long and _UPPER.fullmatch(w):
            words += list(fold(w))
        else:
            words += t
    family = ""
    if "," in name:
        before = [w for w in _word_tokens(name.split(",")[0]) if w not in PARTICLES and w not in TITLES and len(w) > 2]
        family = before[-1] if before else ""
    return tuple(words), family


def orcid_digits(text: str | None) -> str:
    """The digits of an ORCID as typed, with ``x``; empty for placeholders."""
    if not text:
        return ""
    d = re.sub(r"[^0-9x]", "", text.lower().replace("orcid", ""))
    return d if len(d) >= 12 and len(set(d)) > 2 else ""


def plain_mailbox(text: str | None) -> tuple[str, str, bool]:
    """(local part, domain, shared by several people) of an address, its usual damage repaired; empty if there is none."""
    if not text:
        return "", "", False
    t = fold(text).strip()
    m = re.search(r"<([^<>]*)>", t)
    t = re.sub(r"^\s*mailto:\s*", "", m.group(1) if m else t).strip(" \t\"'()[]<>;,.")
    m = re.fullmatch(r"([\w.+'-]+?)(?:@+([\w.-]+)|\s+([\w-]+\.[\w.-]+))", t)
    if not m:
        return "", "", False
    local, domain = m.group(1), m.group(2) or m.group(3)
    first = re.split(r"[._+\-]", local)[0] if not local.startswith(("no-reply", "no_reply")) else "noreply"
    if "".join(re.split(r"\W+", local)) in PLACEHOLDERS or local == domain.split(".")[0]:
        return "", "", False
    return local, domain, first in SHARED_MAILBOXES


@lru_cache(maxsize=50_000)
def _bit_tokens(bit: str) -> tuple[str, ...]:
    return tuple(tokens(bit))


@lru_cache(maxsize=100_000)
def _places_of(text: str) -> frozenset[str]:
    if re.sub(r"[\W_]+", "", fold(text)) in PLACEHOLDERS:
        return frozenset()
    out: set[str] = set()
    for part in re.split(r"\s+[/|]\s+|[;()]", text):
        bits = [_bit_tokens(b) for b in part.split(",")]
        # an address goes on with postcode, town and country: the name has the first word of its kind
        named = next((b for b in bits if any(w in KIND_OF for w in b) and UNIT.isdisjoint(b)), bits[0])
        out |= {w for w in named if len(w) > 4 and w not in KIND_OF and w not in FILLER and w not in GENERIC and not w.isdigit()}
    return frozenset(out)


def place_words(texts: list[str]) -> set[str]:
    """Words that tell institutions apart: long, and no kind, unit or filler word."""
    return set().union(*map(_places_of, texts)) if texts else set()


FEATURES = (
    "person_id string, src string, name string, words array<string>, more array<string>, family string, subject string, orcid string, mailbox string, domain string, shared boolean, "
    "places array<string>, keywords array<int>, h int, cites int, country string"
)


def _list(v) -> list:
    return [x for x in v if x] if hasattr(v, "__len__") else []


def _int(v) -> int:
    return int(v) if v is not None and v == v and v is not pd.NA else -1


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the rows of ``person``, for ``mapInArrow``; of neighbours with one id, the first counts."""
    kinds = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_(), "int": pa.int32()}
    names, types = zip(*(c.split() for c in FEATURES.split(", ")), strict=True)
    before = None
    for b in batches:
        out = []
        for pid, src, name, alias, orcid, mail, aff, affs, subj, kw, h, cites, country in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if pid == before:
                continue
            before = pid
            words, family = name_words(name or "")
            more: set[str] = set()
            for a in _list(alias):
                w, f = name_words(a)
                more |= {x for x in w if len(x) > 1}
                family = family or f
            local, domain, shared = plain_mailbox(mail)
            places = place_words(_list([aff]) + _list(affs))
            code = fold(country or "").strip(" .;()")
            out.append((
                pid, src, name or "", list(words), sorted(more - set(words)), family, (_list(subj) or [""])[0], orcid_digits(orcid), local, domain, shared, sorted(places), [zlib.crc32(k.encode()) & 0x7FFFFFFF for k in _list(kw)],
                _int(h) if 0 <= _int(h) < 300 else -1, _int(cites), "" if re.sub(r"[\W_]+", "", code) in PLACEHOLDERS else code,
            ))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[t]) for i, t in enumerate(types)], names=names)


def unmatched_rows(person: DataFrame) -> DataFrame:
    """What ``features`` reads of the rows that no earlier run matched, in the order of their ids; rows of one id are in one task."""
    rows = person.where(F.col("canonical_person_id").isNull() & F.col("person_id").isNotNull())
    source = F.coalesce(F.array_join(F.array_sort("source_systems"), "|"), F.lit(""))
    plain = rows.select(
        "person_id", source.alias("src"), "name_original", "name_aliases", "orcid", "primary_email", "current_affiliation", "affiliations", "subjects", "keywords", "h_index", "total_citations", "country",
    )
    return plain.repartitionByRange("person_id").sortWithinPartitions("person_id")


def unmatched_features(person: DataFrame) -> DataFrame:
    """Features of the rows that no earlier run matched, each id once, in the order of the ids."""
    return unmatched_rows(person).mapInArrow(features, FEATURES)


#: A mark of words that may agree with a word of other letters: initials and short forms.
FREE = 1 << 64


@lru_cache(maxsize=200_000)
def _letters(w: str) -> int:
    """A bit for each letter, rare ones share theirs; and ``FREE``."""
    out = FREE if len(w) == 1 or w in FULL_OF else 0
    for ch in w:
        out |= 1 << (ord(ch) & 63)
    return out


def inner_slips(a: str, b: str, most: int) -> int:
    """``slips``, which the letters that both words begin and end with don't change."""
    start, ends = 0, min(len(a), len(b))
    while start < ends and a[start] == b[start]:
        start += 1
    ends -= start
    end = 0
    while end < ends and a[-1 - end] == b[-1 - end]:
        end += 1
    return slips(a[start : len(a) - end], b[start : len(b) - end], most)


def word_match(a: str, b: str) -> float:
    """How well two words of names agree: 1 equal, 0.9 nicknames, 0.85 slips, 0.5 an initial, 0 not at all."""
    if a == b:
        return 1.0 if len(a) > 1 else 0.5
    x, y = _letters(a), _letters(b)
    # a slip brings in one letter at most, and there are two at most
    if (x | y) < FREE and ((x & ~y).bit_count() > 2 or (y & ~x).bit_count() > 2):
        return 0.0
    return _unequal_match(a, b)


@lru_cache(maxsize=400_000)
def _unequal_match(a: str, b: str) -> float:
    if len(a) == 1 or len(b) == 1:
        one, word = (a, b) if len(a) == 1 else (b, a)
        others = {*FULL_OF.get(word, ()), *NICKNAMES.get(word, "").split()} if len(word) > 1 else ()
        return 0.5 if word[0] == one else 0.4 if any(f[0] == one for f in others) else 0.0
    if a in FULL_OF.get(b, ()) or b in FULL_OF.get(a, ()) or FULL_OF.get(a, frozenset()) & FULL_OF.get(b, frozenset()):
        return 0.9
    shorter = min(len(a), len(b))
    most = 0 if shorter < 3 else 1 if shorter < 6 else 2
    x, y = _letters(a), _letters(b)
    if abs(len(a) - len(b)) > most or (x & ~y & ~FREE).bit_count() > most or (y & ~x & ~FREE).bit_count() > most:
        return 0.0
    d = inner_slips(a, b, most) if most else 9
    return 0.85 - 0.1 * (d - 1) if d <= most else 0.0


def _pairing(short: list[str], long: list[str]) -> tuple[list[tuple[float, str, str]], int, list[str], list[str]]:
    """Greedy best pairing: (match, word, word) of full words, initials paired, unpaired words of each side."""
    scored = sorted(((word_match(a, b), i, j) for i, a in enumerate(short) for j, b in enumerate(long)), reverse=True)
    used_a: set[int] = set()
    used_b: set[int] = set()
    full, initials = [], 0
    for s, i, j in scored:
        if s <= 0:
            break
        if i in used_a or j in used_b:
            continue
        used_a.add(i)
        used_b.add(j)
        if s > 0.5:
            full.append((s, short[i], long[j]))
        else:
            initials += 1
    return full, initials, [w for i, w in enumerate(short) if i not in used_a], [w for j, w in enumerate(long) if j not in used_b]


few_slips = lru_cache(maxsize=400_000)(inner_slips)


class Rarity:
    """Surprise of words and places in nats, from counts by bucket; ``size`` is the log of the number of records."""

    def __init__(self, counts: np.ndarray, records: int) -> None:
        self.counts, self.size = counts, math.log(max(2, records))
        self.known: dict[str, float] = {}

    def __call__(self, word: str) -> float:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = min(self.size, max(0.5, self.size - math.log(max(1.0, float(self.counts[bucket(word)])))))
            self.known[word] = got
        return got

    def place(self, word: str) -> float:
        """Of sharing a place, which is told by its first letters."""
        return min(6.0, max(2.0, self("@" + word[:6])))


def _unexplained(words: list[str], others: tuple[str, ...]) -> bool:
    """Whether a long word is like none of the others."""
    for w in words:
        if len(w) > 1:
            for x in others:
                if word_match(w, x):
                    break
            else:
                return True
    return False


def name_evidence(a: tuple, b: tuple, rarity: Rarity) -> float:
    """Log-odds from the names; -inf where they can't be one person's."""
    wa, ma, fa = a[3], a[4], a[5]
    wb, mb, fb = b[3], b[4], b[5]
    if fa and fb and word_match(fa, fb) == 0:
        return -math.inf
    ca = [w for w in wa if w not in PARTICLES]
    cb = [w for w in wb if w not in PARTICLES]
    # long words that nothing of the other explains, on both sides
    if _unexplained(ca, (*cb, *mb)) and _unexplained(cb, (*ca, *ma)):
        return -math.inf
    full, initials, left_a, left_b = _pairing(ca, cb)
    if left_a and left_b:
        # another spelling among the aliases may explain a word that found no partner
        for w in left_a[:]:
            if hit := max(((word_match(w, x), w, x) for x in mb), default=(0.0, "", "")):
                if hit[0] > 0:
                    left_a.remove(w)
                    full += [hit] if hit[0] > 0.5 else []
        for w in left_b[:]:
            if hit := max(((word_match(w, x), w, x) for x in ma), default=(0.0, "", "")):
                if hit[0] > 0:
                    left_b.remove(w)
                    full += [hit] if hit[0] > 0.5 else []
    if not full and (both := set(ma) & set(mb)):
        full = [(1.0, w, w) for w in both]
    if not full:
        return -math.inf
    if left_a and left_b and (len(full) + initials < 2 or any(len(w) > 1 for w in left_a) and any(len(w) > 1 for w in left_b)):
        return -math.inf
    e = -4.0 if left_a and left_b else 0.0
    got = sum(rarity(x) if s == 1 else max(1.0, min(rarity(x), rarity(y)) - 1.5) for s, x, y in full)
    return e + min(rarity.size + 3.0, got) + 0.8 * initials


def same_digits(a: str, b: str) -> float:
    """Evidence of two ORCIDs as typed."""
    if not a or not b:
        return 0.0
    if a == b:
        return 9.0
    if len(a) == len(b):
        near = sum(x != y for x, y in zip(a, b, strict=True)) <= 2
    else:
        near = a in b or b in a or a.startswith(b[:14]) or b.startswith(a[:14]) or few_slips(a[-12:], b[-12:], 2) <= 2
    return 6.0 if near else -6.0


@lru_cache(maxsize=200_000)
def word_marks(w: str) -> tuple[frozenset[str], str]:
    """(first letters that a word or its nicknames may have, its end)."""
    return frozenset(f[0] for f in (w, *FULL_OF.get(w, ()), *NICKNAMES.get(w, "").split())), w[-3:] if len(w) > 3 else ""


def name_marks(row: tuple) -> tuple[list[tuple[frozenset[str], str]], set[str], set[str]]:
    """What ``maybe_same_name`` compares: marks of the words, and all first letters and ends of words and aliases."""
    own = [word_marks(w) for w in row[3] if w not in PARTICLES]
    every = own + [word_marks(w) for w in row[4]]
    return own, {x for f, _ in every for x in f}, {e for _, e in every if e}


def maybe_same_name(a: tuple, b: tuple) -> bool:
    """A quick test that pairs with evidence pass: two words of the shorter name start or end as words of the other."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    need = min(2, len(a[0]))
    for first, end in a[0]:
        if end and end in b[2] or not first.isdisjoint(b[1]):
            need -= 1
            if need <= 0:
                return True
    return need <= 0


def evidence(a: tuple, b: tuple, rarity: Rarity) -> float:
    """Log-odds that two records (tuples in the order of ``FEATURES``) are one person, without the prior."""
    if a[6] and b[6] and a[6] != b[6]:
        return -math.inf
    e = name_evidence(a, b, rarity)
    if e == -math.inf:
        return e
    if a[6] and b[6]:
        e += 1.8
    e += same_digits(a[7], b[7])
    if a[9] and b[9]:
        same_domain = a[9] == b[9] or few_slips(a[9], b[9], 2) <= 2
        if a[8] == b[8] and same_domain:
            e += 1.5 if a[10] or b[10] else 8.0
        elif a[10] or b[10]:
            e += 0.5 if same_domain else 0.0
        elif same_domain:
            e += 4.0 if few_slips(a[8], b[8], 2) <= 1 else -1.0
        elif a[8] == b[8]:
            e += 2.0
    ha, hb = {p[:6] for p in a[11]}, {p[:6] for p in b[11]}
    if a[9] and not a[10]:
        ha.add(a[9][:6])
    if b[9] and not b[10]:
        hb.add(b[9][:6])
    if both := ha & hb:
        e += max(map(rarity.place, both))
    elif any(few_slips(x, y, 2) <= 2 for x in a[11] for y in b[11] if len(x) > 7 and len(y) > 7):
        e += 3.0
    elif ha and hb:
        e -= 2.5
    ka, kb = set(a[12]), set(b[12])
    if ka and kb:
        n = len(ka & kb)
        e += (-1.5, 0.5, 1.5, 2.5)[min(n, 3)]
    if a[13] >= 0 and b[13] >= 0:
        d = abs(a[13] - b[13])
        e += 1.2 if d <= 2 else 0.0 if d <= 8 else -0.5
    if a[14] > 0 and b[14] > 0:
        r = abs(math.log((a[14] + 8) / (b[14] + 8)))
        e += 2.0 if r < 0.02 else 0.5 if r < 0.3 else -0.3
    if a[15] and b[15]:
        e += 0.6 if a[15] == b[15] else 0.0
    return e


#: What is compared of a record: its number, and beside texts of any kind the other features, none with white space, in one text.
ROW = ["no", "src", "subject", "country", "rest"]


def packed(feats: DataFrame) -> DataFrame:
    """``ROW`` of numbered features."""
    listed = [F.array_join(F.col(c).cast("array<string>"), " ") if c in ("words", "more", "places", "keywords") else F.col(c).cast("string") for c in ("words", "more", "family", "orcid", "mailbox", "domain", "shared", "places", "keywords", "h", "cites")]
    return feats.select(*ROW[:-1], F.concat_ws("\t", *listed).alias("rest"))


def unpacked(row: tuple) -> tuple:
    """The features of a ``ROW`` as ``people.evidence`` takes them, the number in place of the id."""
    no, src, subject, country, rest = row
    words, more, family, orcid, mailbox, domain, shared, places, keywords, h, cites = rest.split("\t")
    return (no, src, None, words.split(), more.split(), family, subject, orcid, mailbox, domain, shared == "true", places.split(), keywords.split(), int(h), int(cites), country)


WORD_BUCKETS = 1 << 18


def bucket(word: str) -> int:
    """The bucket of a word of a name."""
    return zlib.crc32(word.encode()) % WORD_BUCKETS


def rarity_buckets(words: list[str], places: list[str]) -> list[int]:
    """The buckets that ``Rarity`` counts of a record."""
    return [bucket(w) for w in {*words, *("@" + p[:6] for p in places)}]


def count_words(feats: DataFrame) -> Rarity:
    """Rarity of words over all records; only ``WORD_BUCKETS`` sums reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n = np.zeros(WORD_BUCKETS, np.int64), 0
        for b in batches:
            n += len(b)
            for words, places in zip(b["words"], b["places"], strict=True):
                np.add.at(sums, rarity_buckets(words, places), 1)
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"k": [*at.tolist(), -1], "c": [*sums[at].tolist(), n]})

    out, records = np.zeros(WORD_BUCKETS, np.int64), 0
    for k, c in feats.select("words", "places").mapInPandas(count, "k int, c bigint").groupBy("k").agg(F.sum("c")).collect():
        if k < 0:
            records = c
        else:
            out[k] = c
    return Rarity(out, records)


#: How much more than the log of the number of records the evidence must be for two records to be one person.
SURE = 1.0


def confidence(e: float, rarity: Rarity) -> float:
    """The evidence as a probability: 0.5 at ``SURE``."""
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, (e - rarity.size - SURE) / 1.5))))
