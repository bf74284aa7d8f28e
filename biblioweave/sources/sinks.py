"""Writers: Parquet, JSON lines, bulk index files, CSV and XLSX exports."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import bulk_pair
from ..operators.evidence import flat


def to_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Parquet with zstd; written whole or not at all."""
    (df.coalesce(files) if files else df).write.mode(mode).option("compression", "zstd").parquet(path)


def to_jsonl(df: DataFrame, path: str, keep_nulls: bool = True, mode: str = "overwrite") -> None:
    """JSON lines."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def to_bulk(df: DataFrame, path: str, row_id: str, index: str, mode: str = "overwrite") -> None:
    """Bulk index files: an action line and a document line for each row, next to each other."""
    bulk_pair(df, row_id, index).select("_lines").write.mode(mode).text(path)


def to_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV files with a byte order mark, a header and flat values."""
    df = flat(df)
    mark = [F.col(f"`{c}`").alias("\ufeff" + c if k == 0 else c) for k, c in enumerate(df.columns)]
    df.select(*mark).write.mode(mode).option("header", True).option("encoding", "utf-8").csv(path)


def to_excel_file(df: DataFrame, path: str, most: int = 1_000_000) -> None:
    """One XLSX or CSV file (with byte order mark) for people; an error if there are more rows than a sheet holds."""
    rows = flat(df).limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write CSV files instead")
    if path.endswith(".csv"):
        rows.to_csv(path, index=False, encoding="utf-8-sig")
    else:
        rows.to_excel(path, index=False, sheet_name="results")


def load_bulk(df: DataFrame, row_id: str, index: str, send: Callable[[str], list[dict]], chunk: int = 5000, tries: int = 5, wait: float = 1.0) -> DataFrame:
    """Send the rows in chunks through ``send``; (row_id, status, error) of every row that stays refused.

    Both lines of a row travel as one value, so any batch holds whole rows, and repeated ids are sent as often as they occur.
    A row that is refused for the moment is sent again after ``wait`` seconds, twice as many each time, at most 60.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            failed = []
            rows = list(zip(b["_id"], b["_lines"], strict=True))
            for at in range(0, len(rows), chunk):
                todo = rows[at : at + chunk]
                for k in range(tries):
                    answers = send("\n".join(t for _, t in todo) + "\n")
                    refused = [(r, a) for r, a in zip(todo, answers, strict=True) if a.get("status", 200) >= 300]
                    again = [(r, a) for r, a in refused if a["status"] in (408, 429, 500, 502, 503, 504)]
                    last = k == tries - 1
                    failed += [(r[0], int(a["status"]), str(a.get("error", ""))) for r, a in refused if last or (r, a) not in again]
                    todo = [r for r, _ in again]
                    if not todo or last:
                        break
                    time.sleep(min(60.0, wait * 2**k))
            yield pd.DataFrame(failed, columns=["row_id", "status", "error"])

    return bulk_pair(df, row_id, index).mapInPandas(run, "row_id string, status int, error string")


def run_summary(counts: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows) of several tables in one table."""
    out = None
    for name, df in counts.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out
