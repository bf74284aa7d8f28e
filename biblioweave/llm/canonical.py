"""Problem 5: freely typed values mapped to the entries of a reference list; what no entry is meant by is reported.

An Aho-Corasick automaton over the canonical names and their aliases finds embedded mentions; of overlapping ones the
longest wins, and it must stand on word bounds. What is left goes to token-set similarity, in which tokens may differ by
the slips of typing. The automaton is built from the list (whose size is checked) on the driver, goes to the tasks in
the closure, and every row is matched where it lies: nothing is shuffled but the result's own distinct.

Countries: aliases are the names that the JVM's locale data has in the languages of ``LANGUAGES``, the ISO codes, and
the forms in ``COUNTRY_ALIASES``; government words ("republic of") are dropped. Codes count only as the whole value.

Institutions: a name is a set of tokens, of its place and of its kind. Abbreviations and other languages' kind words are
resolved. A value means the entry with the largest token-set similarity, if that is large enough: the same place with other
kind words is another institution. An acronym counts where one entry only has it.

Defined cases: null and empty values and those that are an entry letter for letter give no row; blanks and placeholders
are ``unmatched``; repeated rows give one row; ties between entries are ``unmatched``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PLACEHOLDERS, fold

UNMATCHED, MAX_ENTRIES = "unmatched", 50_000
LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl", "sv", "da", "nb", "fi", "pl", "cs", "hu", "ro", "tr", "el", "ru", "uk", "zh", "ja", "ko", "th", "vi", "hi", "he", "ar", "id", "af", "ca")
#: Names in use that are not in the locale data. Fixed values.
COUNTRY_ALIASES = {
    "US": "usa|us of a|u s|u s a|the states|america|united states of america|etats unis d amerique|estados unidos de america|vereinigte staaten von amerika",
    "GB": "uk|u k|great britain|britain|england|scotland|wales|northern ireland|n ireland|united kingdom of great britain and northern ireland",
    "CN": "prc|p r c|p r china|pr china|peoples r china|peoples republic of china|people s republic of china|mainland china|zhongguo",
    "DE": "fed rep ger|fed rep germany|federal republic of germany|frg|brd|w germany",
    "KR": "한국|korea|korea south|south korea|s korea|republic of korea|rok|korea rep",
    "NL": "holland|the netherlands|nederlanden", "RU": "russian federation|russian fed", "CZ": "czech republic|czech rep|cesko",
    "TR": "turkiye", "GR": "hellas|hellenic republic", "IN": "bharat", "JP": "nippon|nihon", "HK": "hong kong|hong kong sar|hksar|hongkong|hong kong china|hong kong sar china",
    "SA": "ksa|kingdom of saudi arabia", "ZA": "s africa|rsa|republic of south africa", "MY": "w malaysia|west malaysia", "VN": "viet nam", "AU": "aus|commonwealth of australia",
    "CH": "swiss confederation|confoederatio helvetica", "NZ": "aotearoa", "AR": "argentine republic|the argentine", "PT": "portuguese republic", "FR": "french republic|republique francaise",
    "EG": "arab republic of egypt", "BR": "brasil", "MX": "mejico|united mexican states", "IT": "italian republic", "ES": "kingdom of spain|espana", "RO": "rumania|roumania", "UA": "the ukraine",
}
GOVERNMENT = frozenset("the of republic rep kingdom state federal federative federation fed commonwealth confederation democratic socialist arab and".split())
NOT_COUNTRIES = frozenset({"europe", "africa", "asia", "america", "antarctica", "oceania"})
#: Kind words and their usual short forms and other languages' words. Fixed values.
KIND_WORDS = {
    "university": "univ uni u universitat universite universidad universita universidade universiteit universitet uniwersytet", "national": "natl nat nac nacional nationale nazionale", "state": "st",
    "institute": "inst instituto institut", "technology": "tech technol technological", "technical": "techn technische technique tecnica technical", "science": "sci sciences", "college": "coll col", "royal": "roy",
    "school": "ecole escuela sch schule", "superior": "superieure superior", "polytechnic": "poly polytech", "hospital": "hosp", "research": "res", "center": "centre ctr cent cen", "laboratory": "lab labs laboratories",
    "museum": "mus", "history": "hist", "natural": "", "general": "gen", "analytics": "", "biotech": "", "company": "ltd gmbh inc corp", "academy": "acad",
}
KIND_OF = {w: k for k, ws in KIND_WORDS.items() for w in [k, *ws.split()]}
FILLER = frozenset("of de der des du la le les di del da do das den the and und et y e for fur in at an".split())
CAMPUS = frozenset("main campus".split())
_WORDS = re.compile(r"[^\W_]+", re.UNICODE)


def slips(a: str, b: str, most: int) -> int:
    """Insertions, deletions, changes and swaps of neighbours that turn ``a`` into ``b``; ``most + 1`` if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], prev2[j - 2] + 1)
        if min(row) > most:
            return most + 1
        prev2, prev = prev, row
    return prev[-1]


def allowed(word: str) -> int:
    """How many slips of typing a word may have."""
    return 0 if len(word) < 4 else 1 if len(word) < 9 else 2


def automaton(patterns: dict[str, object]):
    """An Aho-Corasick automaton over ``patterns``, each a text with a space at both ends."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    for p, v in patterns.items():
        auto.add_word(p, (p, v))
    if patterns:
        auto.make_automaton()
    return auto


def mentions(auto, text: str) -> list[tuple[int, int, object]]:
    """(start, end, value) of the longest mentions that don't overlap, left to right; ``text`` has spaces around words."""
    if not len(auto):
        return []
    found = sorted(((end - len(p) + 1, end, v) for end, (p, v) in auto.iter(text)), key=lambda m: (m[0] - m[1], m[0]))
    out: list[tuple[int, int, object]] = []
    for s, e, v in found:
        if all(e <= a or s >= b for a, b, _ in out):  # neighbours may share the space between them
            out.append((s, e, v))
    return sorted(out, key=lambda m: m[0])


def country_names(spark: SparkSession, entries: list[tuple[str, str]]) -> list[tuple[str, str, int]]:
    """(name, code, rank): all names of the entries; rank 0 is a code, 1 the list's own name, 2 any other."""
    locale = spark._jvm.java.util.Locale
    shown = [locale.forLanguageTag(x) for x in LANGUAGES]
    out = []
    for code, name in entries:
        here = locale.forLanguageTag(f"und-{code}")
        out += [(name, code, 1), (code, code, 0)]
        if len(code) == 2:
            try:
                out.append((here.getISO3Country(), code, 0))
            except Exception:  # noqa: BLE001 - a code that isn't ISO's has no long form
                pass
            out += [(here.getDisplayCountry(x), code, 2) for x in shown]
        out += [(a, code, 2) for a in COUNTRY_ALIASES.get(code, "").split("|") if a]
    return out


class Countries:
    """Matches typed countries with the codes of a list."""

    def __init__(self, names: list[tuple[str, str, int]]) -> None:
        # a name of a better rank hides the same word of another entry ("NGA" is a code, and Russia in Vietnamese)
        ranks: dict[str, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        spaced: dict[str, str] = {}
        for name, code, rank in names:
            words = _WORDS.findall(fold(name))
            compact = "".join(words)
            if words and compact not in NOT_COUNTRIES:
                ranks[compact][rank].add(code)
                if rank and (len(compact) > 3 or not compact.isascii()):
                    spaced[compact] = " " + " ".join(words) + " "
        best = {k: min(r.items()) for k, r in ranks.items()}
        self.whole = {k: next(iter(codes)) for k, (_, codes) in best.items() if len(codes) == 1}
        self.inside = {spaced[k]: self.whole[k] for k in spaced if k in self.whole}
        self.fuzzy: dict[int, list[tuple[str, str, int]]] = defaultdict(list)
        for k, code in self.whole.items():
            if len(k) > 3 and k.isascii():
                self.fuzzy[len(k)].append((k, code, best[k][0]))
        self.auto = None

    def __call__(self, value: str) -> str:
        words = [w for w in _WORDS.findall(fold(value)) if not w.isdigit()]
        compact = "".join(words)
        if compact in PLACEHOLDERS:
            return UNMATCHED
        if compact in self.whole:
            return self.whole[compact]
        if self.auto is None:
            self.auto = automaton(self.inside)
        found = mentions(self.auto, " " + " ".join(words) + " ")
        if found:
            codes = {c for _, _, c in found}
            return found[-1][2] if len(codes) > 1 else next(iter(codes))  # an address ends with its country
        core = [w for w in words if w not in GOVERNMENT]
        if core and "".join(core) in self.whole and len("".join(core)) > 3:
            return self.whole["".join(core)]
        for text in dict.fromkeys((compact, "".join(core), words[-1] if words else "")):
            most = allowed(text)
            near: dict[int, set[str]] = defaultdict(set)
            for n in range(len(text) - most, len(text) + most + 1):
                for k, code, rank in self.fuzzy.get(n, ()) if most else ():
                    d = slips(text, k, most)
                    if d <= most:
                        near[2 * d + (rank > 1)].add(code)
            if near:
                best = near[min(near)]
                return next(iter(best)) if len(best) == 1 else UNMATCHED
        return UNMATCHED


#: Likeness of two tokens that differ by one slip of typing, and the token-set similarity that a value must reach. With at
#: most five tokens a side, a token without a partner keeps a value below it.
SLIP, LEAST_SIMILARITY = 0.95, 0.9


def allowed_in_token(word: str) -> int:
    """Slips that a token may have."""
    return 0 if len(word) < 5 else 1 if len(word) < 8 else 2


class Institutions:
    """Matches typed institutions with the ids of a list."""

    def __init__(self, entries: list[tuple[str, str]]) -> None:
        acronyms: dict[str, set[str]] = defaultdict(set)
        names: dict[str, set[str]] = defaultdict(set)
        self.entries: list[tuple[frozenset, str]] = []
        for ref, name in entries:
            for a in re.findall(r"\(([^()]*)\)", name):
                if len(a.split()) == 1:
                    acronyms[fold(a)].add(ref)
            words = self.words(re.sub(r"\([^()]*\)", " ", name))
            names[" " + " ".join(words) + " "].add(ref)
            self.entries.append((frozenset(words), ref))
        self.acronyms = {k: next(iter(v)) for k, v in acronyms.items() if len(v) == 1}
        self.names = {k: next(iter(v)) for k, v in names.items() if len(v) == 1}
        self.auto = None
        self.index: dict[str, list[int]] = defaultdict(list)
        self.places: dict[int, list[tuple[str, int]]] = defaultdict(list)
        self.tokens_by_length: dict[int, list[str]] = defaultdict(list)
        for i, (tokens, _) in enumerate(self.entries):
            place = "".join(sorted(w for w in tokens if w not in KIND_WORDS))
            self.places[len(place)].append((place, i))
            for t in tokens:
                self.index[t].append(i)
        for t in self.index:
            self.tokens_by_length[len(t)].append(t)
        self.index = dict(self.index)

    @staticmethod
    @lru_cache(maxsize=65_536)
    def kind(word: str) -> str | None:
        """The kind word that a word is or is a slip of."""
        if word in KIND_OF:
            return KIND_OF[word]
        if len(word) > 5:
            near = {KIND_OF[k] for k in KIND_OF if len(k) > 5 and abs(len(k) - len(word)) < 3 and slips(word, k, 1 if len(k) < 9 else 2) <= (1 if len(k) < 9 else 2)}
            if len(near) == 1:
                return next(iter(near))
        return None

    def words(self, text: str) -> list[str]:
        """Words without fillers, kind words in their full English form."""
        out = [w for w in _WORDS.findall(fold(text)) if w not in FILLER and not w.isdigit()]
        return [self.kind(w) or w for w in out]

    def split(self, words: list[str]) -> tuple[str, frozenset]:
        """The place and the kind words."""
        return " ".join(sorted({w for w in words if w not in KIND_WORDS})), frozenset(w for w in words if w in KIND_WORDS)

    @lru_cache(maxsize=65_536)  # noqa: B019 - one matcher lives as long as its task
    def near_tokens(self, word: str) -> tuple[tuple[str, float], ...]:
        """(token, likeness) of the listed tokens that a word is or is a slip of."""
        if word in self.index:
            return ((word, 1.0),)
        most = allowed_in_token(word)
        found = ((t, slips(word, t, most)) for n in range(len(word) - most, len(word) + most + 1) for t in self.tokens_by_length.get(n, ())) if most else ()
        return tuple((t, SLIP**d) for t, d in found if d <= most)

    def similarity(self, words: frozenset, entry: frozenset) -> float:
        """Token-set similarity: twice the likeness of paired tokens over the number of tokens of both.

        Equal tokens are paired first, then slips, then what is left of both sides run together ("Newtown", "New Town").
        """
        total, left, rest = float(len(words & entry)), set(words - entry), set(entry - words)
        for w in sorted(left):
            like, t = max(((x, t) for t, x in self.near_tokens(w) if t in rest), default=(0.0, ""))
            if like:
                total += like
                left.discard(w)
                rest.discard(t)
        if left and rest and (left | rest).isdisjoint(KIND_WORDS):
            one, other = "".join(sorted(left)), "".join(sorted(rest))
            most = allowed_in_token(one)
            d = slips(one, other, most) if most and abs(len(one) - len(other)) <= most else most + 1
            if one == other or d <= most:
                total += (len(left) + len(rest)) / 2 * SLIP ** (0 if one == other else d)
        return 2 * total / (len(words) + len(entry))

    @lru_cache(maxsize=65_536)  # noqa: B019
    def similar(self, words: frozenset) -> frozenset:
        """The entries most like a set of tokens, if they are like enough."""
        place = "".join(sorted(w for w in words if w not in KIND_WORDS))
        most = allowed_in_token(place)
        keys = {t for w in words if w not in KIND_WORDS for t, _ in self.near_tokens(w)}
        about = {i for t in keys for i in self.index[t]}
        about |= {i for n in range(len(place) - most, len(place) + most + 1) for p, i in self.places.get(n, ()) if p == place or most and slips(place, p, most) <= most}
        best: dict[float, set[str]] = defaultdict(set)
        for i in about:
            tokens, ref = self.entries[i]
            best[round(self.similarity(words, tokens), 9)].add(ref)
        top = max(best, default=0.0)
        return frozenset(best[top]) if top >= LEAST_SIMILARITY else frozenset()

    def __call__(self, value: str) -> str:
        if re.sub(r"[\W_]+", "", fold(value)) in PLACEHOLDERS:
            return UNMATCHED
        if self.auto is None:
            self.auto = automaton(self.names)
        parts = [p for p in re.split(r"\s+[/|]\s+|[;()\"“”]|\s-\s|,", value) if p.strip()]
        if re.search(r",[^,()]*\s(?:of|de)\s*(?:$|,|\()", value, re.IGNORECASE):  # "Vestashan, National University of"
            parts += [" ".join(value.split(",")[k : k + 2]) for k in range(value.count(","))]
        exact, near = [], []
        for part in parts:
            words = [w for w in self.words(part) if w not in CAMPUS]
            if not words:
                continue
            text = " " + " ".join(words) + " "
            for s, e, ref in mentions(self.auto, text):
                rest = (text[:s] + " " + text[e:]).split()
                if not any(w in KIND_WORDS for w in rest):  # else it is the name of something else
                    exact.append((e - s, ref))
            if len(words) == 1 and words[0] in self.acronyms:
                exact.append((len(words[0]), self.acronyms[words[0]]))
            place, kinds = self.split(words)
            if place and kinds:
                hits = self.similar(frozenset(words))
                near += [hits] if len(hits) == 1 else []
        if exact:
            longest = max(n for n, _ in exact)
            refs = {ref for n, ref in exact if n == longest}
            return next(iter(refs)) if len(refs) == 1 else UNMATCHED
        refs = set().union(*near) if near else set()
        return next(iter(refs)) if len(refs) == 1 else UNMATCHED


def reference_entries(ref: DataFrame, key: str, name: str) -> list[tuple[str, str]]:
    """The entries of a list; an error if it is no small list."""
    rows = ref.where(F.col(key).isNotNull() & F.col(name).isNotNull()).select(key, name).distinct().limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the list has more than {MAX_ENTRIES} entries")
    return sorted((str(r[0]), str(r[1])) for r in rows)


def map_values(df: DataFrame, row_id: str, matchers: dict[str, tuple[Callable[[str], str], set[str]]]) -> DataFrame:
    """(row_id, field_name, ref_id) for every value that is neither null, empty nor an entry letter for letter."""
    fields = list(matchers)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {f: lru_cache(maxsize=200_000)(matchers[f][0]) for f in fields}
        for batch in batches:
            parts = []
            for f in fields:
                entries = matchers[f][1]
                at = [(i, v) for i, v in zip(batch[row_id], batch[f], strict=True) if v and v not in entries]
                parts.append(pd.DataFrame({row_id: [i for i, _ in at], "field_name": f, "ref_id": [seen[f](v) for _, v in at]}, dtype="object"))
            yield pd.concat(parts)

    plain = df.where(F.col(row_id).isNotNull()).select(F.col(row_id).cast("string").alias(row_id), *[F.col(f).cast("string").alias(f) for f in fields])
    return plain.mapInPandas(rows, f"`{row_id}` string, field_name string, ref_id string").distinct()


def map_person(person: DataFrame, country_ref: DataFrame, qs_university: DataFrame) -> DataFrame:
    """``map_values`` for the country and the current affiliation of ``person``."""
    countries = reference_entries(country_ref, "country_code", "country_name")
    schools = reference_entries(qs_university, "qs_id", "university")
    matchers = {
        "country": (Countries(country_names(person.sparkSession, countries)), {n for _, n in countries}),
        "current_affiliation": (Institutions(schools), {n for _, n in schools}),
    }
    return map_values(person, "person_id", matchers)
