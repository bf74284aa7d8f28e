"""Problem 1: the best representative of each group of records, by skylines over completeness, recency and trust.

A record is *dominated* when another of its group is at least as complete, as recent and as trusted, and better in one
of them. The undominated records are the first layer, those undominated once the first is gone the second, and so on.
The survivor is the first layer's best by the lexicographic policy (trust, recency, completeness, smallest id). Each field
takes its value from the skyline of the records whose value is usable there: what is left undominated once the records that
lack the field are peeled off, so a null of the survivor is filled from the layers behind it; of that skyline the policy
picks one. The layer that each value came from, counted over all records, is reported beside it.

A group may hold a third of all rows, so it is never gathered. Among the rows that have the same usable fields and the
same trust, only the latest can supply a value: it dominates the others and has every field that they have. The first
aggregation therefore keeps one champion for each (group, set of usable fields, trust), at most ``2 ** (fields + 1)``
rows, with partial aggregation before the shuffle. Skylines and layers are found over the champions inside one array
expression; a skyline over them is that over all records, layers count the records that a champion stands for as one.

Defined cases: null group ids drop out; null recency counts as the earliest; a null trust as untrusted; repeated rows
count once; ties go to the smaller id; a group of one id gives no row where ``min_ids`` is 2; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import personal_email, placeholder


def person_fields() -> dict[str, Column]:
    """Usable values of the four fields of ``person`` that disagree: null where missing, a placeholder or impossible."""
    h = F.col("h_index")
    return {
        "primary_email": personal_email(F.col("primary_email")),
        "current_affiliation": F.when(~placeholder(F.col("current_affiliation")), F.col("current_affiliation")),
        "country": F.when(~placeholder(F.col("country")), F.col("country")),
        "h_index": F.when((h >= 0) & ~F.coalesce(h > F.col("articles"), F.lit(False)), h).cast("string"),
    }


def champions(df: DataFrame, group: str, row_id: str, recency: str, trust: Column, fields: Mapping[str, Column]) -> DataFrame:
    """One row for each (group, set of usable fields, trust): the latest, as struct ``c``, smallest id on ties."""
    bits = [F.when(v.isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, v in enumerate(fields.values())]
    mask = sum(bits[1:], bits[0])
    rows = df.where(F.col(group).isNotNull() & F.col(row_id).isNotNull()).select(
        F.col(group).alias("_g"),
        F.col(row_id).cast("string").alias("_id"),
        F.col(recency).alias("_r"),
        F.coalesce(trust, F.lit(False)).alias("_t"),
        mask.alias("_m"),
        *[v.alias(f"_v{k}") for k, v in enumerate(fields.values())],
    )
    values = F.struct(*[F.col(f"_v{k}") for k in range(len(fields))])
    # min_by over (age, id): the latest first, then the smallest id; a null recency is the oldest
    rank = F.struct((-F.coalesce(F.unix_micros(F.col("_r").cast("timestamp")), F.lit(-(2**62)))).alias("age"), F.col("_id").alias("id"))
    return rows.groupBy("_g", "_m", "_t").agg(
        F.min_by(F.struct(F.col("_id").alias("id"), rank["age"].alias("age"), values.alias("v")), rank).alias("_c"),
        F.min("_id").alias("_lo"),
        F.max("_id").alias("_hi"),
    )


def dominates(a: Column, b: Column) -> Column:
    """True where champion ``a`` is no worse than ``b`` in trust, recency and completeness, and better in one of them."""
    no_worse = (a["distrust"] <= b["distrust"]) & (a["age"] <= b["age"]) & (a["lack"] <= b["lack"])
    return no_worse & ((a["distrust"] < b["distrust"]) | (a["age"] < b["age"]) | (a["lack"] < b["lack"]))


def skyline(cs: Column) -> Column:
    """The champions of an array that no other of it dominates, in its order."""
    return F.filter(cs, lambda x: ~F.exists(cs, lambda y: dominates(y, x)))


def layered(champs: DataFrame, n_fields: int, min_ids: int) -> DataFrame:
    """One row for each group with ``cs``: its champions in order of the policy, each with its layer (from 1)."""
    member = F.struct(
        (~F.col("_t")).alias("distrust"),
        F.col("_c.age").alias("age"),
        (-F.bit_count(F.col("_m"))).alias("lack"),
        F.col("_c.id").alias("id"),
        F.col("_m").alias("mask"),
        F.col("_c.v").alias("v"),
    )
    groups = champs.groupBy("_g").agg(F.array_sort(F.collect_list(member)).alias("cs"), F.min("_lo").alias("lo"), F.max("_hi").alias("hi"))
    if min_ids > 1:
        groups = groups.where(F.col("lo") != F.col("hi"))

    # In order of the policy a record comes after all that dominate it, so one pass finds the layers.
    start = F.expr("cast(array() as array<int>)")
    cs = F.col("cs")
    layers = F.aggregate(
        F.sequence(F.lit(0), F.size(cs) - 1),
        start,
        lambda acc, i: F.array_append(
            acc,
            F.lit(1)
            + F.coalesce(
                F.array_max(F.transform(acc, lambda depth, j: F.when(dominates(F.get(cs, j), F.get(cs, i)), depth).otherwise(F.lit(0)))),
                F.lit(0),
            ),
        ),
    )
    return groups.select("_g", "cs", layers.alias("layers"))


def survivors(df: DataFrame, group: str, row_id: str, recency: str, trust: Column, fields: Mapping[str, Column], min_ids: int = 1) -> DataFrame:
    """One row for each group: ``survivor_id`` and, for each field, its value, the id and the layer it came from."""
    names = list(fields)
    base = layered(champions(df, group, row_id, recency, trust, fields), len(names), min_ids)
    out: list[Column] = [F.col("_g").alias(group), F.get(F.col("cs"), F.lit(0))["id"].alias("survivor_id")]
    base = base.withColumn("z", F.zip_with("cs", "layers", lambda c, depth: F.struct(*[c[f].alias(f) for f in ("distrust", "age", "lack", "id", "mask", "v")], depth.alias("layer"))))
    for k, name in enumerate(names):
        bit = F.lit(1 << k)
        usable = F.filter(F.col("z"), lambda z: z["mask"].bitwiseAND(bit) != 0)  # noqa: B023
        hit = F.get(skyline(usable), F.lit(0))  # the array is in the policy's order
        out += [hit["v"][f"_v{k}"].alias(name), hit["id"].alias(f"{name}_from"), hit["layer"].alias(f"{name}_layer")]
    return base.select(*out)


def surviving_fields(records: DataFrame, group: str, row_id: str, fields: Sequence[str]) -> DataFrame:
    """Long form of ``survivors``: the row whose value survives, for each group and field that has a usable value."""
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}_from").alias("at")) for f in fields])
    long = records.select(group, F.explode(each).alias("x"))
    return long.select(F.col(group), F.col("x.field_name").alias("field_name"), F.col("x.at").alias(row_id)).where(F.col(row_id).isNotNull())


def person_survivors(person: DataFrame, source_system_ref: DataFrame, min_ids: int = 2) -> DataFrame:
    """``survivors`` of ``person``: grouped by an earlier run, trust by the first of a row's source systems."""
    trusted = source_system_ref.where("is_trusted").select("source_system").distinct()
    names = [r[0] for r in trusted.limit(1001).collect()]  # a list of systems, kept by hand
    if len(names) > 1000:
        raise ValueError("source_system_ref has more than 1,000 trusted systems")
    trust = F.arrays_overlap(F.col("source_systems"), F.array(*[F.lit(x) for x in names])) if names else F.lit(False)
    return survivors(person, "canonical_person_id", "person_id", "updated_at", trust, person_fields(), min_ids)
