"""Contacts with their papers: rows grouped to one contact, and the paper that stands for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import empty_to_null, strip_space


def truthy(c: Column) -> Column:
    """Typed yes: 1, true, yes, y, t."""
    return F.lower(strip_space(c.cast("string"))).isin("1", "true", "yes", "y", "t")


def lenient_number(c: Column, default: float = 0.0) -> Column:
    """A typed number, else the default."""
    return F.coalesce(strip_space(c.cast("string")).try_cast("double"), F.lit(default))


def first_token(c: Column) -> Column:
    """The first non-empty piece of a list with ``;`` or ``|``."""
    return F.get(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[;|]"), strip_space), lambda x: x != ""), F.lit(0))


def contact_key(email: Column, name: Column) -> Column:
    """What makes two rows one contact: mailbox and name, whatever their case."""
    return F.concat_ws("|", F.lower(strip_space(F.coalesce(email, F.lit("")))), F.lower(strip_space(F.coalesce(name, F.lit("")))))


def anchors(evidence: DataFrame, key: str, order: str) -> DataFrame:
    """The paper that stands for each contact: corresponding author, then author order, newest, most cited, most similar, first."""
    rank = F.struct(
        (~F.coalesce(truthy(F.col("is_corresponding_author")), F.lit(False))).alias("a"),
        F.coalesce(F.col("author_order").cast("int"), F.lit(10**9)).alias("b"),
        (-F.coalesce(F.col("publication_year").cast("int"), F.lit(0))).alias("c"),
        (-F.coalesce(F.col("times_cited").cast("int"), F.lit(0))).alias("d"),
        (-lenient_number(F.col("similarity"))).alias("e"),
        F.col(order).alias("f"),
    )
    rest = [c for c in evidence.columns if c != key]
    return evidence.groupBy(key).agg(F.min_by(F.struct(*rest), rank).alias("_a"), F.count("*").alias("n_evidences")).select(key, *[F.col(f"_a.{c}").alias(c) for c in rest], "n_evidences")


def flat_value(c: Column, kind: str, separator: str = "；", yes: str = "是", no: str = "否") -> Column:
    """A value as an export shows it: lists joined, truth in words."""
    if kind.startswith("array"):
        return empty_to_null(F.array_join(c.cast("array<string>"), separator))
    if kind == "boolean":
        return F.when(c, yes).when(~c, no)
    return c.cast("string")


def flat(df: DataFrame) -> DataFrame:
    """All columns as an export shows them."""
    return df.select(*[flat_value(F.col(n), k).alias(n) for n, k in df.dtypes])
