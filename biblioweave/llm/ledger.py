"""Problem 2: records that differ only in formatting, counted in an incremental ledger of canonical keys.

The canonical key drops white space, case, punctuation, the customary lead-in of an identifier (label or resolver
address) and which identifier field holds which. The ledger is a set of bucketed tables in the shared folder: a batch is
aggregated to one row for each key (partial aggregation, so a key with a third of all rows moves as a few rows), then
full-outer-joined with the matching buckets of the ledger only; counts add up and the earliest representative stays.
Buckets that a batch doesn't touch are neither read nor written. A version is written by ``buckets * splits`` tasks: raise them
with the number of keys. A batch may be named, so that one that is delivered again after a failure counts once.

Defined cases: a missing identifier or title agrees only with a missing one (blank counts as missing); rows without an
identifier and without a title stay apart; repeated rows count; an empty batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path

LEAD_IN = (
    r"^[^\p{L}\p{N}]*(?:(?:https?|ftp)\W+)?"
    r"(?:(?:dx\W|www\W)?doi\W\p{L}+\W+|(?:dx\W)?doi\b\W*|ut\b\W*wos\b\W*|ut\b\W*|wos\b\W*|accession\W+(?:number|no)\W*)*"
)


def bare(c: Column) -> Column:
    """Letters and digits in lower case; null if none is left."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}]+", F.lit("")), F.lit(""))


def bare_identifier(c: Column) -> Column:
    """``bare`` without the label or resolver address before the identifier."""
    return bare(F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)\s+", " ")), LEAD_IN, ""))


def canonical_key(identifiers: list[Column], texts: list[Column], row_id: Column) -> Column:
    """16 bytes that are equal where the identifiers, in any order, and the texts agree but for formatting."""
    ids = F.array_sort(F.array_compact(F.array(*[bare_identifier(c) for c in identifiers])))
    parts = [F.array_join(ids, "\u0001"), *[F.coalesce(bare(c), F.lit("")) for c in texts]]
    whole = F.concat_ws("\u0002", *parts)
    nothing = (F.size(ids) == 0) & (F.length(F.concat(*parts[1:])) == 0)
    return F.unhex(F.md5(F.when(nothing, F.concat(F.lit("\u0003"), F.coalesce(row_id, F.lit("")))).otherwise(whole).cast("binary")))


class Ledger:
    """Bucketed counts of canonical keys: key, copies, keep_id (smallest id), first_at (earliest time seen)."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 32, splits: int = 4) -> None:
        self.spark, self.path, self.buckets, self.splits = spark, path or new_path(spark, "ledger"), buckets, splits
        self.versions: dict[int, str] = {}  # bucket -> folder of its newest version; at most ``buckets`` entries
        self.number = 0
        self.batches: set[str] = set()
        if path is not None:
            self._resume()

    def _resume(self) -> None:
        """Go on with the ledger in the folder: whole versions only, the later ones over the earlier."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return
        for name in sorted(s.getPath().getName() for s in fs.listStatus(root)):
            version = jvm.org.apache.hadoop.fs.Path(root, name)
            if name.startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(version, "_SUCCESS")):
                self.number = int(name[1:7]) + 1
                self.batches |= {name.split("-", 2)[2]} - {""}
                for s in fs.listStatus(version):
                    part = s.getPath().getName()
                    if part.startswith("bucket="):
                        self.versions[int(part[7:])] = f"{self.path}/{name}"

    SCHEMA = "key binary, copies bigint, keep_id string, first_at timestamp, bucket int"

    def _read(self, buckets: list[int]) -> DataFrame | None:
        # a version folder holds several buckets; the filter on the partition column prunes the others
        by: dict[str, list[int]] = {}
        for b in buckets:
            if b in self.versions:
                by.setdefault(self.versions[b], []).append(b)
        parts = [self.spark.read.schema(self.SCHEMA).parquet(p).where(F.col("bucket").isin(*bs)) for p, bs in by.items()]
        out = parts[0] if parts else None
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def add(self, rows: DataFrame, batch: str = "") -> "Ledger":
        """Fold a batch with the columns key, row_id and at into the ledger; a named one that was folded before changes nothing."""
        spark = self.spark
        if batch and batch in self.batches:
            return self
        fresh = (
            rows.groupBy("key")
            .agg(F.count("*").alias("copies"), F.min("row_id").alias("keep_id"), F.min(F.col("at").cast("timestamp")).alias("first_at"))
            .withColumn("bucket", F.pmod(F.hash("key"), F.lit(self.buckets)))
        )
        old = self._read(list(self.versions))
        if old is not None:
            staged = new_path(spark, "ledger-batch")
            fresh.write.partitionBy("bucket").parquet(staged)
            touched = [r[0] for r in spark.read.schema(self.SCHEMA).parquet(staged).select("bucket").distinct().collect()]
            fresh = spark.read.schema(self.SCHEMA).parquet(staged)
            old = self._read(touched)
        if old is not None:
            a, b = fresh.alias("a"), old.alias("b")
            fresh = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.key") == F.col("b.key")), "full_outer").select(
                F.coalesce("a.key", "b.key").alias("key"),
                (F.coalesce("a.copies", F.lit(0)) + F.coalesce("b.copies", F.lit(0))).alias("copies"),
                F.least("a.keep_id", "b.keep_id").alias("keep_id"),
                F.least("a.first_at", "b.first_at").alias("first_at"),
                F.coalesce("a.bucket", "b.bucket").alias("bucket"),
            )
        version = f"{self.path}/v{self.number:06d}-{new_path(spark, 'x')[-8:]}-{batch}"
        self.batches |= {batch} - {""}
        self.number += 1
        fresh.repartition(F.col("bucket"), F.pmod(F.xxhash64("key"), F.lit(self.splits))).write.partitionBy("bucket").parquet(version)
        for (b,) in spark.read.schema(self.SCHEMA).parquet(version).select("bucket").distinct().collect():
            self.versions[b] = version
        return self

    def current(self) -> DataFrame:
        """All keys with their counts."""
        out = self._read(list(self.versions))
        return out if out is not None else self.spark.createDataFrame([], self.SCHEMA)


def publication_rows(publication: DataFrame) -> DataFrame:
    """Keys of ``publication`` as a ledger takes them."""
    key = canonical_key([F.col("doi"), F.col("ut_wos_id")], [F.col("title")], F.col("publication_id"))
    return publication.select(key.alias("key"), F.col("publication_id").alias("row_id"), F.col("created_at").alias("at"))


def publication_ledger(publication: DataFrame, buckets: int = 32) -> DataFrame:
    """The ledger after the delivered rows, then after the late ones (created long after their update)."""
    late = F.coalesce(F.col("created_at") > F.col("updated_at"), F.lit(False))
    ledger = Ledger(publication.sparkSession, buckets=buckets)
    ledger.add(publication_rows(publication.where(~late)))
    ledger.add(publication_rows(publication.where(late)))
    return ledger.current()
