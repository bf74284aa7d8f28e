"""Readers of tabular files into bronze rows: every value a text, with the file, group, sheet and row it came from."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import empty_to_null, strip_space

META = ("source_file", "source_group", "converted_at", "sheet", "row_index")
ENCODINGS = ("utf-8-sig", "utf-8", "gb18030", "latin1")


def discover(spark: SparkSession, root: str, endings: Sequence[str] = ("csv", "xlsx", "xlsm", "xls")) -> DataFrame:
    """(path, size, modified, sha1) of all files below a folder with one of the endings, lock files left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    wanted = files.where(F.lower(name).rlike(r"\.(" + "|".join(endings) + r")$") & ~F.startswith(name, F.lit("~$")) & ~F.startswith(name, F.lit("~%24")))
    return wanted.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha1("content").alias("sha1"))


def decoded(content: bytes) -> str:
    """The text of a file in the first encoding that fits."""
    for e in ENCODINGS:
        try:
            return content.decode(e)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", "replace")


def _sheets(path: str, content: bytes) -> Iterator[tuple[str, pd.DataFrame]]:
    if path.lower().endswith(".csv"):
        yield "csv", pd.read_csv(io.StringIO(decoded(content)), dtype=str, keep_default_na=False)
        return
    for name, sheet in pd.read_excel(io.BytesIO(content), sheet_name=None, dtype=object).items():
        yield str(name), sheet.astype(object).where(sheet.notna(), None)


def cells(spark: SparkSession, root: str, group: str, endings: Sequence[str] = ("csv", "xlsx", "xlsm", "xls")) -> DataFrame:
    """One row for each table row of all files of a folder, its cells as a map from header to text; rows count by sheet."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    files = files.where(F.lower(name).rlike(r"\.(" + "|".join(endings) + r")$") & ~F.startswith(name, F.lit("~")))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                for sheet, table in _sheets(path, bytes(content)):
                    texts = [{str(h): str(v).strip() for h, v in zip(table.columns, r, strict=True) if v is not None and str(v).strip()} for r in table.itertuples(index=False)]
                    order = [str(h) for h in table.columns]
                    yield pd.DataFrame({"source_file": path, "sheet": sheet, "row_index": range(1, len(texts) + 1), "headers": [order] * len(texts), "cells": texts})

    read = files.select("path", "content").mapInPandas(rows, "source_file string, sheet string, row_index bigint, headers array<string>, cells map<string,string>")
    return read.withColumn("source_group", F.lit(group))


def bronze(rows: DataFrame, converted_at: str) -> DataFrame:
    """Flat bronze table of ``cells``: the meta columns, then all headers in the order in which files and sheets have them."""
    seen = rows.select("source_file", "sheet", F.posexplode("headers").alias("pos", "h")).groupBy("h").agg(F.min(F.struct("source_file", "sheet", "pos")).alias("at"))
    names = [r["h"] for r in seen.orderBy("at").collect()]  # headers, not rows
    meta = [F.col("source_file"), F.col("source_group"), F.lit(converted_at).alias("converted_at"), F.col("sheet"), F.col("row_index")]
    return rows.select(*meta, *[F.element_at("cells", F.lit(n)).alias(n) for n in names if n not in META])


def bronze_csv(spark: SparkSession, path: str, group: str, converted_at: str, encoding: str = "utf-8") -> DataFrame:
    """Flat bronze table of large CSV files, split over tasks; the row index counts by file in the order of its bytes."""
    raw = spark.read.option("header", True).option("multiLine", False).option("encoding", encoding).csv(path)
    names = [c for c in raw.columns if c not in META]
    at = F.col("_metadata.file_path")
    plain = raw.select(*[empty_to_null(strip_space(F.col(f"`{n}`"))).alias(n) for n in names], at.alias("source_file"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    order = Window.partitionBy("source_file").orderBy("_b", "_m")
    return plain.select("source_file", F.lit(group).alias("source_group"), F.lit(converted_at).alias("converted_at"), F.lit("csv").alias("sheet"), F.row_number().over(order).cast("bigint").alias("row_index"), *names)


def row_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON lines ``{source_file, sheet, row_index, row: {}}``; other lines drop out, a missing index is the line's number in its file.

    The number is the lines of the file's earlier parts and the place within its own part, so no file is gathered.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = spark.read.text(path).select("value", at.alias("at"), F.monotonically_increasing_id().alias("m"))
    schema = "source_file string, sheet string, row_index bigint, row map<string,string>"
    r = F.from_json("value", schema)
    rows = lines.select(r.alias("r"), "at", "m")
    kept = rows.where(F.col("r.row").isNotNull())
    # ids grow along a part; the parts of a file are few, one for each split
    parts = lines.groupBy("at").agg(F.count("*").alias("n"), F.min("m").alias("first"))
    earlier = Window.partitionBy("at.file").orderBy("at.start").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("at", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("m") - F.col("first") + 1
    numbered = kept.join(parts, "at")
    return numbered.select("r.source_file", F.coalesce("r.sheet", F.lit("unknown")).alias("sheet"), F.coalesce("r.row_index", number).cast("bigint").alias("row_index"), F.col("r.row").alias("cells"))


def workbook_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of files ``{source_file, sheets: {name: [{}]}}``."""
    schema = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("sheets", T.MapType(T.StringType(), T.ArrayType(T.MapType(T.StringType(), T.StringType()))))])
    files = spark.read.schema(schema).option("multiLine", True).json(path)
    sheets = files.select("source_file", F.explode("sheets").alias("sheet", "rows"))
    return sheets.select("source_file", "sheet", F.posexplode("rows").alias("p", "cells")).select("source_file", "sheet", (F.col("p") + 1).cast("bigint").alias("row_index"), "cells")


def row_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a flat bronze table; the cells map holds only filled columns."""
    raw = spark.read.parquet(path)
    names = [c for c in raw.columns if c not in META]
    pairs = F.array(*[F.struct(F.lit(n).alias("k"), empty_to_null(strip_space(F.col(f"`{n}`").cast("string"))).alias("v")) for n in names])
    filled = F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))
    return raw.select("source_file", F.coalesce("sheet", F.lit("unknown")).alias("sheet"), F.coalesce("row_index", F.lit(0)).alias("row_index"), filled.alias("cells"))


def rows_of(spark: SparkSession, *, parquet: str | None = None, jsonl: str | None = None, json: str | None = None) -> DataFrame:
    """Rows from exactly one of the inputs."""
    given = [(f, p) for f, p in ((row_parquet, parquet), (row_json, jsonl), (workbook_json, json)) if p]
    if len(given) != 1:
        raise ValueError("name exactly one input")
    return given[0][0](spark, given[0][1])


def matches_json(spark: SparkSession, path: str) -> DataFrame:
    """Match records of a file: a list, ``{matches: []}`` or ``{matches_by_scholar: {name: []}}`` (the name fills in)."""
    whole = spark.read.option("wholetext", True).text(path)
    item = "map<string,string>"
    flat = F.from_json("value", f"array<{item}>")
    boxed = F.from_json("value", f"struct<matches: array<{item}>, matches_by_scholar: map<string, array<{item}>>>")
    listed = whole.where(F.ltrim("value").startswith("[")).select(F.explode(flat).alias("m"))
    objects = whole.where(F.ltrim("value").startswith("{")).select(boxed.alias("b"))
    plain = objects.select(F.explode("b.matches").alias("m"))
    named = objects.select(F.explode("b.matches_by_scholar").alias("name", "ms")).select("name", F.explode("ms").alias("m"))
    filled = named.select(F.when(F.element_at("m", F.lit("scholar_name")).isNull(), F.map_concat(F.map_filter("m", lambda k, v: k != "scholar_name"), F.create_map(F.lit("scholar_name"), "name"))).otherwise(F.col("m")).alias("m"))
    return listed.unionByName(plain).unionByName(filled)


def ranking_json(spark: SparkSession, path: str) -> DataFrame:
    """(rank_text, name, country, domain) of a ranking file; nameless rows drop out."""
    raw = spark.read.schema("rank string, university string, company string, country string, domain string, website string").option("multiLine", True).json(path)
    name = F.coalesce(empty_to_null(strip_space(F.col("university"))), empty_to_null(strip_space(F.col("company"))))
    domain = F.coalesce(empty_to_null(strip_space(F.col("domain"))), empty_to_null(strip_space(F.col("website"))))
    return raw.select(F.col("rank").alias("rank_text"), name.alias("name"), "country", domain.alias("domain")).where(F.col("name").isNotNull())


def contacts_sqlite(spark: SparkSession, path: str, table: str = "records", wanted: Sequence[str] = ()) -> DataFrame:
    """A table of a SQLite file, those of the wanted columns that it has."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        have = [r[1] for r in db.execute(f'PRAGMA table_info("{table}")')]
        kept = [c for c in wanted or have if c in have]
        last = db.execute(f'SELECT max(rowid) FROM "{table}"').fetchone()[0] or 0
    columns = ", ".join(f'CAST("{c}" AS TEXT)' for c in kept)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as own:
            for b in batches:
                for start in b["start"]:
                    got = own.execute(f'SELECT rowid, {columns} FROM "{table}" WHERE rowid > ? AND rowid <= ?', (int(start), int(start) + 10_000)).fetchall()
                    yield pd.DataFrame(got, columns=["row_index", *kept])

    starts = spark.range(0, max(last, 1), 10_000).withColumnRenamed("id", "start")
    return starts.mapInPandas(read, ", ".join(["row_index bigint", *[f"`{c}` string" for c in kept]]))
