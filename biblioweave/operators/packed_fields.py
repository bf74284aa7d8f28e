"""Several values packed in one field: split by the dialect of minimum description length.

A dialect is a set of delimiters, whether quotes protect them, and a wrapping around the whole field. For every distinct
text all dialects whose delimiters occur in it are parsed. The code length of a value is ``log2(N / count)``, with its
count over the parses of the whole corpus (a distributed aggregation; each text spreads its weight over its parses and
is left out of its own counts), or its length in characters where no other text has it. The dialect with the shortest
code wins, and its values come out with their positions.

Counts are pre-aggregated before the shuffle and the join with them is by value, so a frequent text or value is never
gathered. No part of the vocabulary reaches the driver.

Defined cases: null and blank fields give no rows; empty values are skipped and don't count in ``pos``; a field of one
value gives one row from ``split_packed`` (``min_items`` leaves it out); a delimiter inside quotes belongs to the value;
quotes that don't close before a delimiter are ordinary characters; texts of any length are parsed whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, drop_cut

#: Name -> pattern of each delimiter that a field may use. A slash with space around it isn't one within a word.
DELIMITERS = {
    ";": ";", "；": "；", ",": ",", "，": "，", "、": "、", "|": r"\|", "tab": r"\t", "line": r"[\r\n]+",
    " / ": r"(?:(?<=\s)|^)/(?=\s|$)", "/": r"(?<!\s)/(?!\s|$)", "·": "[·•]",
}
#: Bits for naming a delimiter: common ones are cheap; each further one costs as much again, and 3 more.
DELIMITER_BITS = {";": 1, ",": 2, "|": 2, " / ": 3, "tab": 3, "line": 3, "；": 3, "，": 4, "、": 4, "·": 4, "/": 6}
NO_QUOTES_BITS, KEEP_WRAP_BITS = 4, 4
QUOTED = r'"((?:[^"]|"")*)"|“([^”]*)”|\'((?:[^\']|\'\')*)\'|‘([^’]*)’|«([^»]*)»'
BRACKETS = {"[": "]", "(": ")", "{": "}"}
QUOTES = {'"': '"', "“": "”", "'": "'", "‘": "’", "«": "»"}
_FOUND = {name: re.compile(p) for name, p in DELIMITERS.items()}


@lru_cache(maxsize=4096)
def _patterns(delimiters: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    any_of = "|".join(DELIMITERS[d] for d in delimiters) or r"(?!)"
    keep = ("\\t" if "tab" in delimiters else "") + ("\\r\\n" if "line" in delimiters else "")
    space = f"[^\\S{keep}]*"
    quoted = re.compile(f"{space}(?:{QUOTED}){space}(?={any_of}|\\Z)")
    return re.compile(any_of), quoted, re.compile(f"{space}[\"“'‘«]")


def parse(text: str, delimiters: tuple[str, ...], quotes: bool) -> list[str]:
    """The non-empty values of a text under a dialect, in order."""
    cut_at, quoted, opening = _patterns(delimiters)
    if not quotes or not any(q in text for q in "\"“'‘«"):
        return [v for piece in cut_at.split(text) if (v := piece.strip())]
    out, pos, end = [], 0, len(text)
    while pos <= end:
        m = quoted.match(text, pos) if quotes and opening.match(text, pos) else None
        if m:
            k = m.lastindex or 1
            value = m.group(k)
            value = value.replace('""', '"') if k == 1 else value.replace("''", "'") if k == 3 else value
            pos = m.end()
            d = cut_at.match(text, pos)
        else:
            d = cut_at.search(text, pos)
            value = text[pos : d.start() if d else end]
        if value := value.strip():
            out.append(value)
        if d is None:
            break
        pos = max(d.end(), pos + 1)
    return out


def _unwrapped(text: str) -> str | None:
    """What a wrapping around the whole field holds, if there may be one."""
    t = text.strip()
    if len(t) < 2:
        return None
    if BRACKETS.get(t[0]) == t[-1]:
        depth = 0
        for i, ch in enumerate(t):
            depth += (ch == t[0]) - (ch == t[-1])
            if depth == 0:
                return t[1:-1] if i == len(t) - 1 else None
    if QUOTES.get(t[0]) == t[-1]:
        inner, q = t[1:-1], t[-1]
        if t[0] != q:
            return inner if t[0] not in inner and q not in inner else None
        single = inner.replace(q + q, "")
        return inner.replace(q + q, q) if q not in single else None
    return None


def parses(text: str) -> list[tuple[float, list[str]]]:
    """(bits for naming the dialect, values) of every dialect that differs on this text."""
    out: dict[tuple[str, ...], float] = {}
    inner = _unwrapped(text)
    for wrap, body in ((False, text), (True, inner)):
        if body is None:
            continue
        here = [d for d, p in _FOUND.items() if p.search(body)]
        kept = 0 if wrap or inner is None else KEEP_WRAP_BITS
        for n in range(len(here) + 1):
            for ds in combinations(here, n):
                bits = kept + sum(DELIMITER_BITS[d] for d in ds) + 3 * max(0, n - 1)
                for quotes in (True, False) if any(q in body for q in "\"“'‘«") else (True,):
                    items = tuple(parse(body, ds, quotes))
                    if items:
                        b = bits + (0 if quotes else NO_QUOTES_BITS)
                        out[items] = min(b, out.get(items, b))
    return [(b, list(items)) for items, b in out.items()]


def _value_key(value: str) -> int:
    """64 bits that are equal for values that differ in letter case only."""
    return xxhash.xxh64_intdigest(value.lower()) - (1 << 63)


def _values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, h, n, w): the values of all parses of a text, each once, with the weight that the text gives them.

    A text of one parse needs no costs: its weights are summed over the batch under the id -1.
    """
    for batch in batches:
        ids, hs, ns, ws = [], [], [], []
        plain: dict[int, float] = {}
        for i, t, n in zip(batch["id"], batch["text"], batch["n"], strict=True):
            found = parses(t)
            weight: dict[int, float] = {}
            for _, items in found:
                for v in items:
                    h = _value_key(v)
                    weight[h] = weight.get(h, 0.0) + n / len(found)
            if len(found) == 1:
                for h, w in weight.items():
                    plain[h] = plain.get(h, 0.0) + w
            else:
                ids += [i] * len(weight)
                ns += [n] * len(weight)
                hs += weight
                ws += weight.values()
        yield pd.DataFrame({"id": [*ids, *[-1] * len(plain)], "h": [*hs, *plain], "n": [*ns, *[0] * len(plain)], "w": [*ws, *plain.values()]})


def cheapest_parses(texts: DataFrame, bits_per_char: float = 5.0) -> DataFrame:
    """(text, items) for every distinct text of the column ``text``, parsed by its cheapest dialect.

    What a value costs depends on the value and its text, not on the parse, so only numbers are shuffled: the values of a
    text once each for the counts, and their codes back to it. Then the text is parsed again and its cheapest parse kept.
    """
    distinct = texts.where(F.col("text").isNotNull()).groupBy("text").agg(F.count("*").alias("n"))
    numbered = cut(distinct.select(F.monotonically_increasing_id().alias("id"), "text", "n"), "packed")
    values = cut(numbered.mapInPandas(_values, "id bigint, h bigint, n bigint, w double"), "packed-values")
    counts = cut(values.groupBy("h").agg(F.sum("w").alias("c")), "packed-counts")
    total = float(counts.agg(F.sum("c")).first()[0] or 1.0) + 1.0
    own = values.where("id >= 0").select("id", "h", "n")
    # a value that no other text has is spelled out, which needs no code
    coded = own.join(counts, "h").where(F.col("c") > F.col("n")).select("id", "h", F.log2(F.lit(total) / (F.col("c") - F.col("n"))).cast("float").alias("code"))
    codes = coded.groupBy("id").agg(F.collect_list("h").alias("hs"), F.collect_list("code").alias("codes"))  # of one text
    told = numbered.select("id", "text").join(codes, "id", "left")

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, hs, cs in zip(batch["text"], batch["hs"], batch["codes"], strict=True):
                found = parses(t)
                if len(found) > 1:
                    known = dict(zip(hs.tolist(), cs.tolist(), strict=True)) if hs is not None else {}

                    def bits(one: tuple[float, list[str]], known: dict[int, float] = known) -> tuple:
                        spelled = ((10.0 + bits_per_char * (len(v) + 1), v) for v in one[1])
                        return round(one[0] + sum(min(b, known.get(_value_key(v), b)) for b, v in spelled), 6), len(one[1]), one[1]

                    found = [min(found, key=bits)]
                out.append(found[0][1] if found else [])
            yield pd.DataFrame({"text": batch["text"], "items": out})

    out = cut(told.select("text", "hs", "codes").mapInPandas(choose, "text string, items array<string>").where(F.size("items") > 0), "packed-best")
    for df in (numbered, values, counts):
        drop_cut(df)
    return out


def split_packed(df: DataFrame, row_id: str, fields: list[str], min_items: int = 1) -> DataFrame:
    """(row_id, field_name, pos, item): one row for each value of each field, each row once."""
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields])
    long = df.select(F.col(row_id).alias("_id"), F.explode(each).alias("x")).select("_id", "x.field_name", "x.text")
    long = long.where(F.col("text").rlike(r"(?U)\S")).distinct()
    best = cheapest_parses(long.select("text")).where(F.size("items") >= min_items)
    out = long.join(best, "text").select("_id", "field_name", F.posexplode("items").alias("p", "item"))
    return out.select(F.col("_id").alias(row_id), "field_name", (F.col("p") + 1).cast("int").alias("pos"), "item").distinct()
