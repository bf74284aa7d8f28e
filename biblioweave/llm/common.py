"""Values that people type when they have nothing to say, and cleaning shared by the operators of this subpackage."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a placeholder is once case, punctuation and white space are gone.
PLACEHOLDERS = (
    "", "0", "00", "x", "xx", "xxx", "na", "nan", "nil", "null", "none", "nonone", "unknown", "unknownaffiliation",
    "affiliationpending", "affiliationunknown", "pending", "notavailable", "notspecified", "notprovided", "notknown",
    "notapplicable", "unspecified", "undefined", "tbd", "tba", "todo", "sameasabove", "seeabove", "asabove", "ditto",
    "withheld", "anonymous", "selectcountry", "selectone", "pleaseselect", "choose", "missing", "blank", "test",
    "keineangabe", "inconnu", "desconocido", "unbekannt",
)
#: First part of a mailbox that no single person owns.
SHARED_MAILBOXES = (
    "noreply", "donotreply", "unknown", "none", "test", "xxx", "na", "example", "info", "contact", "office",
    "secretariat", "secretary", "admin", "webmaster", "postmaster", "mail", "lab", "group", "team", "anonymous",
)
_ADDRESS = r"^[\p{L}\p{N}][\p{L}\p{N}._%+'-]*@[\p{L}\p{N}-]+(\.[\p{L}\p{N}-]+)+$"
_ACCENTED = "àáâãäåāăąçćčĉċďđèéêëēĕėęěĝğġģĥìíîïĩīĭįıĵķĺļľłñńņňòóôõöøōŏőŕŗřśŝşšţťŧùúûüũūŭůűųŵýÿŷźżž"
_PLAIN = "aaaaaaaaacccccddeeeeeeeeegggghiiiiiiiiijkllllnnnnooooooooorrrsssstttuuuuuuuuuuwyyyzzz"


def placeholder(c: Column) -> Column:
    """True where the text is null, blank or stands for "nothing known"."""
    bare = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", "")
    return bare.isin(*PLACEHOLDERS)


def unwrapped_email(c: Column) -> Column:
    """The address inside ``mailto:``, ``Name <...>``, padding or other case; the text itself if there is none."""
    low = F.regexp_replace(F.lower(c), r"(?U)\s+$|^\s+", "")
    low = F.when(low.rlike("<[^<>]*>"), F.regexp_extract(low, "<([^<>]*)>", 1)).otherwise(low)
    return F.regexp_replace(F.regexp_replace(low, r"^(?U)\s*mailto:\s*", ""), r"(?U)^[\s\"'(\[<]+|[\s\"')\]>;,.]+$", "")


def personal_email(c: Column) -> Column:
    """The address in plain form where it is a whole one of a person, else null."""
    plain = unwrapped_email(c)
    box = F.regexp_replace(F.regexp_extract(plain, r"^([^@._+]*)", 1), "-", "")
    return F.when(plain.rlike(_ADDRESS) & ~box.isin(*SHARED_MAILBOXES), plain)


def ascii_lower(c: Column) -> Column:
    """Lower case without the accents of Latin letters."""
    low = F.translate(F.lower(c), _ACCENTED, _PLAIN)
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(low, "ß", "ss"), "æ", "ae"), "œ", "oe")


def fold(text: str) -> str:
    """``ascii_lower`` for Python: case-folded, compatibility forms resolved, without accents."""
    if text.isascii():
        return text.lower()
    out = unicodedata.normalize("NFKD", text.casefold().replace("ø", "o").replace("ł", "l").replace("ı", "i").replace("đ", "d"))
    return "".join(ch for ch in out if not unicodedata.combining(ch))


_SPLIT = re.compile(r"[\W_]+", re.UNICODE)


def tokens(text: str) -> list[str]:
    """Folded words of a text."""
    return [t for t in _SPLIT.split(fold(text)) if t]
