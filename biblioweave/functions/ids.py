"""Deterministic ids and index-ready documents, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import empty_to_null, strip_space


def hashed_id(*parts: Column) -> Column:
    """SHA-1 of the parts joined by ``|``; a null part is empty."""
    return F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def publication_id(doi: Column, other: Column, title: Column, year: Column, source: Column) -> Column:
    """The DOI, else the other identifier, else a hash of title, year and source."""
    return F.coalesce(empty_to_null(doi), empty_to_null(other), hashed_id(title, F.nullif(year.cast("string"), F.lit("0")), source))


def stable_shard(c: Column, shards: int) -> Column:
    """Shard of a key from the first 12 hex digits of its SHA-1."""
    return (F.conv(F.substring(F.sha1(c), 1, 12), 16, 10).cast("bigint") % shards).cast("int")


def safe_id(c: Column, most_bytes: int = 512) -> Column:
    """The id, or its SHA-1 where it is longer than an index takes."""
    return F.when(F.octet_length(c) > most_bytes, F.sha1(c)).otherwise(c)


def clean_text(c: Column) -> Column:
    """Without control characters (but tab and line ends), trimmed; null if empty."""
    return empty_to_null(strip_space(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")))


def clean_value(c: Column, kind: T.DataType) -> Column:
    """A value ready for an index: texts cleaned, no NaN or infinity, no empty members inside arrays and structs."""
    if isinstance(kind, T.StringType):
        return clean_text(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    if isinstance(kind, T.ArrayType):
        return F.filter(F.transform(c, lambda x: clean_value(x, kind.elementType)), lambda x: x.isNotNull())
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[clean_value(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def bulk_pair(df, row_id: str, index: str):
    """(_id, _lines): for each row the action and the document without its nulls, a line each; long ids are replaced and kept."""
    cleaned = df.select(*[clean_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
    key = safe_id(F.col(row_id))
    kept = cleaned.withColumn("original_id", F.when(key != F.col(row_id), F.col(row_id)))
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), key.alias("_id")).alias("index")))
    return kept.select(key.alias("_id"), F.concat_ws("\n", action, F.to_json(F.struct(*kept.columns))).alias("_lines"))


def bulk_lines(df, row_id: str, index: str):
    """(line_no, value, _id): the lines of ``bulk_pair``, a row each."""
    return bulk_pair(df, row_id, index).select(F.posexplode(F.split("_lines", "\n")).alias("line_no", "value"), "_id")
