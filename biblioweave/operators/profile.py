"""Data quality in one pass: shares of nulls, values that don't fit a type, counts by label, drops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fits(c: Column, kind: str) -> Column:
    """Whether a typed text can be read as a kind (nulls fit)."""
    return c.isNull() | c.cast("string").try_cast(kind).isNotNull()


def profile(df: DataFrame, expected: Mapping[str, str] | None = None) -> DataFrame:
    """(field, n_rows, n_null, null_rate, n_anomalies): one pass over all columns, in long form."""
    expected = expected or {}
    aggs = [F.count("*").alias("_n")]
    for k, f in enumerate(df.schema.fields):
        missing = F.col(f.name).isNull()
        if isinstance(f.dataType, T.StringType):
            missing = missing | (F.trim(f.name) == "")
        elif isinstance(f.dataType, T.ArrayType):
            missing = missing | (F.size(f.name) == 0)
        aggs.append(F.count_if(missing).alias(f"_m{k}"))
        aggs.append((F.count_if(~fits(F.col(f.name), expected[f.name])) if f.name in expected else F.lit(0).cast("bigint")).alias(f"_a{k}"))
    one = df.agg(*aggs)
    each = F.array(*[F.struct(F.lit(f.name).alias("field"), F.col(f"_m{k}").alias("n_null"), F.col(f"_a{k}").alias("n_anomalies")) for k, f in enumerate(df.schema.fields)])
    out = one.select("_n", F.explode(each).alias("x")).select("x.field", F.col("_n").alias("n_rows"), "x.n_null", F.round(F.col("x.n_null") / F.col("_n"), 6).alias("null_rate"), "x.n_anomalies")
    return out


def label_counts(df: DataFrame, label: str, labels: Sequence[str]) -> DataFrame:
    """One row with the count of each label."""
    return df.agg(*[F.count_if(F.col(label) == x).alias(f"{x}_count") for x in labels])


def hits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_known) of each column."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{k}").alias("n_known")) for k, c in enumerate(columns)])
    return df.agg(*[F.count(c).alias(f"_{k}") for k, c in enumerate(columns)]).select(F.explode(each).alias("x")).select("x.*")
