"""Incremental processing with Structured Streaming: new files only, keyed upserts, resumable embeddings, late rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.survivorship import rule_of
from ..session import cut


def new_files(spark: SparkSession, schema, folder: str, name: str | None = None, fmt: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    """A stream of the rows of files that were not read before: those of a folder, or of one table (file or folder) in it."""
    reader = spark.readStream.format(fmt).schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if name is None:
        return reader.load(folder)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.load(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).load(folder)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int, str], None]) -> None:
    """Process what there is, batch by batch, and stop; a later call goes on where this one ended.

    ``each`` gets the batch, its number and the id that the checkpoint gave its stream: number and id name a batch.
    """
    known: list[str] = []

    def one(batch: DataFrame, number: int) -> None:
        if not known:
            known.append(batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"])
        each(batch, number, known[0])

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(one).start()
    query.awaitTermination()


class Upserted:
    """A table folded by key, in buckets: a version holds the buckets that one batch touched, the newest of each counts.

    Of a value that depends on the order of rows (``first``, ``first_row``, ``union``, ``concat``) the order stays beside it, so
    folding in any batches gives what folding all rows at once gives. The order columns themselves are kept as the smallest.
    A batch that runs again, known by stream and number, is written once. ``buckets`` is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], rules: Mapping[str, str], buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path, list(keys), list(order), buckets
        self.rules = {**{o: "min" for o in order}, **{c: r for c, r in rules.items() if c not in order}}

    def _versions(self) -> list[str]:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(n for n in names if n.startswith("v"))

    def _newest(self) -> dict[int, str]:
        """Bucket -> newest version that has it; at most ``buckets`` entries."""
        jvm = self.spark._jvm
        out: dict[int, str] = {}
        for name in self._versions():
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            for s in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder):
                part = s.getPath().getName()
                if part.startswith("_bucket="):
                    out[int(part[8:])] = name
        return out

    def _states(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        by: dict[str, list[int]] = {}
        for b, name in self._newest().items():
            if buckets is None or b in buckets:
                by.setdefault(name, []).append(b)
        out = None
        for name, bs in sorted(by.items()):
            part = self.spark.read.parquet(f"{self.path}/{name}").where(F.col("_bucket").isin(*bs))
            out = part if out is None else out.unionByName(part)
        return out

    def _opened(self, rows: DataFrame) -> DataFrame:
        """States of single rows."""
        by = F.struct(*[F.col(o).alias(f"o{k}") for k, o in enumerate(self.order)])
        cols = []
        for c, rule in self.rules.items():
            if rule in ("first", "first_row"):
                state = F.struct(by.alias("o"), F.col(c).alias("x"))
                state = F.when(F.col(c).isNotNull(), state) if rule == "first" else state
            elif rule in ("union", "concat"):
                state = F.when(F.col(c).isNotNull(), F.array(F.struct(by.alias("o"), F.col(c).alias("x"))))
            else:
                state = F.col(c)
            cols.append(state.alias(c))
        return rows.select(*self.keys, *cols)

    def _folded(self, states: DataFrame) -> DataFrame:
        def one(c: str, rule: str):
            if rule in ("first", "first_row"):
                return F.min_by(F.col(c), F.col(f"{c}.o"))
            if rule in ("union", "concat"):
                return F.array_sort(F.flatten(F.collect_list(c)))
            return rule_of(c, rule, F.lit(0))

        return states.groupBy(*self.keys).agg(*[one(c, r).alias(c) for c, r in self.rules.items()])

    def add(self, batch: DataFrame, number: int, stream: str = "") -> None:
        """Fold a batch into the table."""
        names = self._versions()
        if any(n.endswith(f"-{stream}-{number}") for n in names):
            return
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        fresh = cut(self._folded(self._opened(batch)), "upsert")
        touched = [r[0] for r in fresh.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
        old = self._states(touched) if names else None
        if old is not None:
            fresh = self._folded(old.drop("_bucket").unionByName(fresh))
        version = f"{self.path}/v{int(names[-1][1:10]) + 1 if names else 0:09d}-{stream}-{number}"
        fresh.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(version)

    def current(self) -> DataFrame | None:
        """The table; None before its first batch."""
        states = self._states()
        if states is None:
            return None

        def value(c: str, rule: str):
            if rule in ("first", "first_row"):
                return F.col(f"{c}.x")
            if rule in ("union", "concat"):
                kept = F.array_compact(F.flatten(F.transform(c, lambda e: e["x"])))
                return F.array_distinct(kept) if rule == "union" else kept
            return F.col(c)

        return states.select(*self.keys, *[value(c, r).alias(c) for c, r in self.rules.items()])


def append_missing(path: str, row_id: str, make: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch function: ``make`` and append only rows whose id the table hasn't got (embeddings that resume)."""

    def each(batch: DataFrame, number: int, stream: str = "") -> None:
        spark = batch.sparkSession
        todo = batch.dropDuplicates([row_id])
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            todo = todo.join(spark.read.parquet(path).select(row_id), row_id, "left_anti")
        make(todo).write.mode("append").parquet(path)

    return each


def windowed_counts(stream: DataFrame, at: str, by: Sequence[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and group; a row that comes later than ``late`` is left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")
