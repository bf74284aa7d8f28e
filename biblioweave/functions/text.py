"""Text normalisation and splitting as column expressions.

Everything here stays in the JVM. Accents and compatibility forms are resolved with a ``translate`` table that is built
from the Unicode data at import, for all characters whose decomposition is one base character and marks.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _tables() -> tuple[str, str, dict[str, str]]:
    one_from, one_to, many = [], [], {}
    for cp in range(0xA0, min(sys.maxunicode, 0x2FFFF) + 1):
        ch = chr(cp)
        if 0x3400 <= cp <= 0xD7FF or 0xF900 <= cp <= 0xFAFF:  # ideographs and syllables stay as they are
            continue
        flat = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if flat == ch or cp > 0xFFFF:
            continue
        if len(flat) == 1:
            one_from.append(ch)
            one_to.append(flat)
        elif flat.isalpha() and len(flat) == 2 and flat.isascii():
            many[ch] = flat
    return "".join(one_from), "".join(one_to), many


_FROM, _TO, _MANY = _tables()


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it; nested uses would multiply the plan."""
    return F.get(F.transform(F.array(c), lambda x: f(x)), F.lit(0))


def strip_space(c: Column) -> Column:
    """Without white space, of any kind, at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def empty_to_null(c: Column) -> Column:
    """Null where the text is empty."""
    return F.nullif(c, F.lit(""))


def decomposed(c: Column) -> Column:
    """Compatibility decomposition without combining marks; texts in ASCII, the most of them, are only looked through."""
    out = F.regexp_replace(F.translate(c, _FROM, _TO), r"\p{M}+", "")
    # one step over a constant array: a call for each pair would make the generated code too large to be compiled
    table = F.split(F.lit(" ".join(ch + flat for ch, flat in _MANY.items())), " ")
    pairs = F.aggregate(table, out, lambda acc, p: F.replace(acc, F.substring(p, 1, 1), F.substring(p, 2, 2)))
    rare = F.when(c.rlike("[" + "".join(_MANY) + "]"), pairs).otherwise(out)
    return F.when(c.rlike(r"[^\x00-\x7F]"), rare).otherwise(c)


def normalize_text(c: Column) -> Column:
    """Letters and digits in lower case, words parted by one space; null if none is left."""
    return empty_to_null(F.trim(F.regexp_replace(F.lower(decomposed(c)), r"[^\p{L}\p{N}]+", " ")))


def normalize_compact(c: Column) -> Column:
    """``normalize_text`` with only a-z and 0-9 left."""
    return empty_to_null(F.regexp_replace(normalize_text(c), "[^a-z0-9]+", ""))


def split_ordered(c: Column, separator: str = ";") -> Column:
    """Trimmed non-empty pieces in order, with repeats; an empty array for null."""
    pieces = F.transform(F.split(c, f"\\Q{separator}\\E"), strip_space)
    return F.coalesce(F.filter(pieces, lambda x: x != ""), F.expr("cast(array() as array<string>)"))


def split_sorted(c: Column, separator: str = ";") -> Column:
    """Distinct trimmed non-empty pieces, sorted."""
    return F.array_sort(F.array_distinct(split_ordered(c, separator)))


def split_top_level(c: Column) -> Column:
    """Pieces between the ``;`` that are outside square and round brackets; stray closing brackets are ignored."""
    start = F.struct(F.lit(0).alias("sq"), F.lit(0).alias("par"), F.lit("").alias("cur"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc: Column, ch: Column) -> Column:
        sq = F.when(ch == "[", acc["sq"] + 1).when((ch == "]") & (acc["sq"] > 0), acc["sq"] - 1).otherwise(acc["sq"])
        par = F.when(ch == "(", acc["par"] + 1).when((ch == ")") & (acc["par"] > 0), acc["par"] - 1).otherwise(acc["par"])
        ends = (ch == ";") & (sq == 0) & (par == 0)
        return F.struct(
            sq.alias("sq"),
            par.alias("par"),
            F.when(ends, F.lit("")).otherwise(F.concat(acc["cur"], ch)).alias("cur"),
            F.when(ends, F.array_append(acc["out"], acc["cur"])).otherwise(acc["out"]).alias("out"),
        )

    walked = F.aggregate(F.split(F.coalesce(c, F.lit("")), ""), start, step, lambda acc: F.array_append(acc["out"], acc["cur"]))
    return F.filter(F.transform(walked, strip_space), lambda x: x != "")


def ordered_distinct(c: Column) -> Column:
    """Distinct elements in the order of their first occurrence."""
    return F.array_distinct(c)


def words(c: Column) -> Column:
    """Words of the normalised text; an empty array for none."""
    return F.filter(F.split(F.coalesce(normalize_text(c), F.lit("")), " "), lambda x: x != "")


def to_int(c: Column) -> Column:
    """Whole numbers as written, else null ("2020.0" and "" are null)."""
    t = strip_space(c.cast("string"))
    return F.when(t.rlike(r"^[+-]?\d{1,10}$"), t.try_cast("int"))


def to_float(c: Column) -> Column:
    """Numbers as written, else null."""
    return strip_space(c.cast("string")).try_cast("double")


def joined(c: Column, separator: str) -> Column:
    """Elements of an array joined; null for an empty or null array."""
    return empty_to_null(F.array_join(c, separator))


def embedding_text(title: Column, abstract: Column, sections: list[tuple[str, Column]], limit: int = 24_000) -> Column:
    """Title, abstract and labelled sections, one a line; the abstract alone gives way to the limit. Null without title."""
    head = empty_to_null(strip_space(title))
    tail = F.concat_ws("\n", *[F.when(F.length(strip_space(t)) > 0, F.concat(F.lit(f"{label}: "), strip_space(t))) for label, t in sections])
    title_line = F.concat(F.lit("Title: "), head)
    fixed = F.length(title_line) + F.when(F.length(tail) > 0, F.length(tail) + 1).otherwise(F.lit(0)) + F.length(F.lit("Abstract: ")) + 1
    body = strip_space(F.substring(strip_space(abstract), F.lit(1), F.greatest(F.lit(limit) - fixed, F.lit(0))))
    abstract_line = F.when(F.length(body) > 0, F.concat(F.lit("Abstract: "), body))
    whole = F.concat_ws("\n", title_line, abstract_line, empty_to_null(tail))
    return F.when(head.isNotNull(), F.substring(whole, 1, limit))
