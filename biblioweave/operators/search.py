"""Structured search: a JSON tree of groups and rules becomes one boolean column; Catalyst does the rest.

A catalog of fields is inferred from a schema (texts that are analysed are named by the caller). Rules of one nested path
that are siblings in a group must hold on the same array element, so they become one ``exists``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import words

#: What a rule may ask of a field of each kind. Fixed values.
OPERATORS = {
    "keyword": ("eq", "neq", "in", "not_in", "exists", "not_exists", "prefix"),
    "text": ("match", "match_phrase", "exists", "not_exists"),
    "integer": ("eq", "gt", "gte", "lt", "lte", "between", "exists"),
    "float": ("eq", "gt", "gte", "lt", "lte", "between", "exists"),
    "date": ("eq", "gt", "gte", "lt", "lte", "between", "exists"),
    "boolean": ("eq",),
    "nested": ("exists",),
}
DEEP_OFFSET, MOST_ROWS = 10_000, 1000


@dataclass(frozen=True)
class Field:
    """A searchable field: dotted path, kind, whether it is an array, and the array of structs it lies in."""

    path: str
    kind: str
    is_array: bool = False
    nested_path: str | None = None

    @property
    def operators(self) -> tuple[str, ...]:
        """Operators that a rule may use."""
        return OPERATORS[self.kind]

    @property
    def sortable(self) -> bool:
        """Whether results can be ordered by it."""
        return self.kind not in ("text", "nested") and not self.is_array and self.nested_path is None


@dataclass(frozen=True)
class Entity:
    """A searchable table."""

    name: str
    key: str
    fields: Mapping[str, Field]
    visible: tuple[str, ...] = ()
    default_sort: tuple[tuple[str, str], ...] = ()

    def field(self, path: str) -> Field:
        """The field of a path; KeyError if there is none."""
        if path not in self.fields:
            raise KeyError(f"{self.name} has no field {path}")
        return self.fields[path]


def _kind(t: T.DataType, path: str, texts: Iterable[str]) -> str:
    if path in texts:
        return "text"
    if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "integer"
    if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float"
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "boolean" if isinstance(t, T.BooleanType) else "keyword"


def entity(name: str, schema: T.StructType, key: str, texts: Iterable[str] = (), visible: Sequence[str] = (), default_sort: Sequence[tuple[str, str]] = ()) -> Entity:
    """The catalog entry of a table."""
    texts = set(texts)
    fields: dict[str, Field] = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            fields[f.name] = Field(f.name, "nested", True)
            for g in f.dataType.elementType.fields:
                path = f"{f.name}.{g.name}"
                inner = g.dataType.elementType if isinstance(g.dataType, T.ArrayType) else g.dataType
                fields[path] = Field(path, _kind(inner, path, texts), isinstance(g.dataType, T.ArrayType), f.name)
        elif isinstance(f.dataType, T.ArrayType):
            fields[f.name] = Field(f.name, _kind(f.dataType.elementType, f.name, texts), True)
        elif isinstance(f.dataType, T.StructType):
            for g in f.dataType.fields:
                fields[f"{f.name}.{g.name}"] = Field(f"{f.name}.{g.name}", _kind(g.dataType, f"{f.name}.{g.name}", texts))
        else:
            fields[f.name] = Field(f.name, _kind(f.dataType, f.name, texts))
    return Entity(name, key, fields, tuple(visible) or tuple(f.name for f in schema.fields), tuple(default_sort))


def prune(node: Mapping[str, Any]) -> dict[str, Any] | None:
    """The tree without blank rules; a rule with only a field or only an operator is an error."""
    kind = node.get("type", "group")
    if kind == "group":
        kept = [c for c in map(prune, node.get("children", [])) if c is not None]
        return {"type": "group", "logic": str(node.get("logic", "and")).lower(), "children": kept}
    if kind != "rule":
        raise ValueError(f"unknown node type {kind}")
    name, op = str(node.get("field") or "").strip(), str(node.get("operator") or "").strip()
    if not name and not op:
        return None
    if not name or not op:
        raise ValueError("a rule needs a field and an operator")
    return {**node, "field": name, "operator": op}


def _on(meta: Field, value: Column, test) -> Column:
    return F.exists(value, test) if meta.is_array else test(value)


def _rule(meta: Field, rule: Mapping[str, Any], value: Column) -> Column:
    op = rule["operator"]
    if op not in meta.operators:
        raise ValueError(f"{op} is not an operator of {meta.path}")
    if op in ("in", "not_in") and not rule.get("values"):
        raise ValueError(f"{op} needs values")
    if op == "between" and not isinstance(rule.get("range"), Mapping):
        raise ValueError("between needs a range")
    present = value.isNotNull() & (F.size(value) > 0) if meta.is_array else value.isNotNull()
    literal = F.lit(rule.get("value"))
    if op in ("exists", "not_exists"):
        return present if op == "exists" else ~F.coalesce(present, F.lit(False))
    if op in ("eq", "neq"):
        hit = _on(meta, value, lambda x: x == literal)
    elif op in ("in", "not_in"):
        hit = _on(meta, value, lambda x: x.isin(*rule["values"]))
    elif op == "prefix":
        hit = _on(meta, value, lambda x: F.startswith(x, literal))
    elif op == "match":
        hit = _on(meta, value, lambda x: F.arrays_overlap(words(x), words(literal)))
    elif op == "match_phrase":
        phrase = F.concat(F.lit(" "), F.array_join(words(literal), " "), F.lit(" "))
        hit = _on(meta, value, lambda x: F.contains(F.concat(F.lit(" "), F.array_join(words(x), " "), F.lit(" ")), phrase))
    elif op == "between":
        low, high = rule["range"].get("from"), rule["range"].get("to")
        if low is None and high is None:
            return present
        hit = _on(meta, value, lambda x: reduce(lambda p, q: p & q, [*([x >= F.lit(low)] if low is not None else []), *([x <= F.lit(high)] if high is not None else [])]))
    else:
        hit = _on(meta, value, {"gt": lambda x: x > literal, "gte": lambda x: x >= literal, "lt": lambda x: x < literal, "lte": lambda x: x <= literal}[op])
    # a missing value is no match, and so it is one of the negated forms
    return ~F.coalesce(hit, F.lit(False)) if op in ("neq", "not_in") else F.coalesce(hit, F.lit(False))


def condition(node: Mapping[str, Any], on: Entity) -> Column:
    """The boolean column of a pruned tree."""
    if node.get("type", "group") == "rule":
        return _group([node], "and", on)
    logic = str(node.get("logic", "and")).lower()
    if logic not in ("and", "or"):
        raise ValueError(f"{logic} is no logic of a group")
    return _group(node.get("children", []), logic, on)


def _group(children: Sequence[Mapping[str, Any]], logic: str, on: Entity) -> Column:
    def join(cs: list[Column]) -> Column:
        return reduce((lambda p, q: p & q) if logic == "and" else (lambda p, q: p | q), cs)

    plain, nested = [], {}
    for child in children:
        if child.get("type", "group") == "rule":
            meta = on.field(child["field"])
            if meta.nested_path:
                nested.setdefault(meta.nested_path, []).append((meta, child))
            else:
                plain.append(_rule(meta, child, F.col(meta.path)))
        else:
            plain.append(condition(child, on))
    for path, rules in nested.items():
        def element(e: Column, rules=tuple(rules)) -> Column:  # noqa: B008
            return join([_rule(m, r, e[m.path.split(".", 1)[1]]) for m, r in rules])

        plain.append(F.coalesce(F.exists(F.col(path), _one_argument(element)), F.lit(False)))
    return join(plain) if plain else F.lit(True)


def _one_argument(f):
    return lambda e: f(e)


@dataclass
class Request:
    """What to search: tree, fields to show, order, and a page by number or after a row."""

    tree: Mapping[str, Any] = field(default_factory=dict)
    select: Sequence[str] = ()
    sort: Sequence[tuple[str, str]] = ()
    page: int = 1
    page_size: int = 20
    after: Sequence[Any] | None = None


def order_of(on: Entity, sort: Sequence[tuple[str, str]], warnings: list[str]) -> list[tuple[str, str]]:
    """Sort keys that can be sorted by, the key last; others are dropped with a warning."""
    out = []
    for name, way in sort or on.default_sort:
        if on.field(name).sortable:
            out.append((name, way))
        else:
            warnings.append(f"{name} can't be sorted by and was left out")
    return out if any(n == on.key for n, _ in out) else [*out, (on.key, "asc")]


def after(order: Sequence[tuple[str, str]], row: Sequence[Any]) -> Column:
    """Rows that come after ``row`` in the order, where nulls come last."""
    out, equal = F.lit(False), F.lit(True)
    for (name, way), v in zip(order, row, strict=True):
        c = F.col(name)
        if v is None:
            beyond = F.lit(False)
        else:
            beyond = F.coalesce(c > F.lit(v) if way == "asc" else c < F.lit(v), F.lit(True))  # a null comes after every value
        out, equal = out | (equal & beyond), equal & c.eqNullSafe(F.lit(v))
    return out


def matching(df: DataFrame, on: Entity, tree: Mapping[str, Any]) -> DataFrame:
    """All rows that a tree selects."""
    return df.where(condition(prune(tree or {"children": []}), on))


def search(df: DataFrame, on: Entity, request: Request) -> tuple[DataFrame, list[str]]:
    """The page of a request, and warnings."""
    if not 1 <= request.page_size <= MOST_ROWS or request.page < 1:
        raise ValueError(f"pages count from 1 and have at most {MOST_ROWS} rows")
    warnings: list[str] = []
    chosen = list(request.select) or list(on.visible)
    for name in chosen:
        on.field(name.split(".")[0] if name not in on.fields else name)
    order = order_of(on, request.sort, warnings)
    hits = matching(df, on, request.tree)
    if request.after is not None:
        hits = hits.where(after(order, request.after))
    hits = hits.orderBy(*[F.col(n).desc_nulls_last() if way == "desc" else F.col(n).asc_nulls_last() for n, way in order])
    if request.after is None:
        offset = (request.page - 1) * request.page_size
        if offset >= DEEP_OFFSET:
            warnings.append(f"offset {offset} is deep; page by the last row instead")
        hits = hits.offset(offset)
    return hits.limit(request.page_size).select(*[F.col(n).alias(n.replace(".", "_")) for n in chosen]), warnings


def sql_text(on: Entity, request: Request) -> tuple[str, str]:
    """(mode, SQL that shows a request): ``sql`` where plain ANDs say it all, else ``sql+filter``. It is never run."""
    warnings: list[str] = []
    order = ", ".join(f"{n} {way.upper()} NULLS LAST" for n, way in order_of(on, request.sort, warnings))
    head = f"SELECT {', '.join(request.select or on.visible)} FROM {on.name}"
    tail = f" ORDER BY {order} LIMIT {request.page_size} OFFSET {(request.page - 1) * request.page_size}"

    def literal(v: Any) -> str:
        return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    def say(node: Mapping[str, Any]) -> list[str] | None:
        if node["type"] == "group":
            parts = [say(c) for c in node["children"]]
            return None if node["logic"] != "and" and len(parts) > 1 or any(p is None for p in parts) else [x for p in parts for x in p]
        meta, op = on.field(node["field"]), node["operator"]
        if meta.kind == "text" or meta.nested_path or meta.is_array:
            return None
        sign = {"eq": "=", "gt": ">", "gte": ">=", "lt": "<", "lte": "<="}
        if op in sign:
            return [f"{meta.path} {sign[op]} {literal(node.get('value'))}"]
        if op == "neq":
            return [f"({meta.path} <> {literal(node.get('value'))} OR {meta.path} IS NULL)"]
        if op in ("in", "not_in"):
            listed = f"{meta.path} {'NOT ' * (op == 'not_in')}IN ({', '.join(map(literal, node['values']))})"
            return [listed if op == "in" else f"({listed} OR {meta.path} IS NULL)"]
        if op == "prefix":
            return [f"{meta.path} LIKE {literal(str(node.get('value')).replace('%', '!%').replace('_', '!_') + '%')} ESCAPE '!'"]
        if op in ("exists", "not_exists"):
            return [f"{meta.path} IS {'NOT ' * (op == 'exists')}NULL"]
        low, high = node["range"].get("from"), node["range"].get("to")
        return [*([f"{meta.path} >= {literal(low)}"] if low is not None else []), *([f"{meta.path} <= {literal(high)}"] if high is not None else [])] or [f"{meta.path} IS NOT NULL"]

    where = say(prune(request.tree or {"children": []}))
    if where is None:
        return "sql+filter", head + tail
    return "sql", head + (" WHERE " + " AND ".join(where) if where else "") + tail
