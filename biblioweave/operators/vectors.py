"""Vectors: checked embeddings from a pluggable function, and exact nearest neighbours by cosine."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checked(c: Column, dim: int) -> Column:
    """The vector, or null where it hasn't ``dim`` numbers."""
    whole = (F.size(c) == dim) & ~F.exists(c, lambda x: x.isNull() | F.isnan(x))
    return F.when(whole, c)


def hash_embedder(dim: int) -> Callable[[list[str]], list[list[float]]]:
    """A deterministic stand-in for an embedding service: signed counts of hashed words, of length 1."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = np.zeros(dim)
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                v[h % dim] += 1 if h >> 63 else -1
            out.append((v / (np.linalg.norm(v) or 1.0)).tolist())
        return out

    return embed


def embed(df: DataFrame, row_id: str, text: str, embedder: Callable[[list[str]], list[list[float]]], dim: int, batch: int = 20, retries: int = 5, pause: float = 0.0) -> DataFrame:
    """(row_id, embedding, error): small batches with retries; a batch that fails leaves its error and the job goes on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                vectors: list = [None] * len(part)
                error = None
                for k in range(retries):
                    try:
                        vectors, error = embedder(part[text].fillna("").tolist()), None
                        break
                    except Exception as e:  # noqa: BLE001 - the error is the result
                        error = f"{type(e).__name__}: {e}"
                        time.sleep(pause * 2**k)
                wrong = [v is not None and len(v) != dim for v in vectors]
                yield pd.DataFrame({
                    row_id: part[row_id].to_numpy(),
                    "embedding": [None if w else v for v, w in zip(vectors, wrong, strict=True)],
                    "error": [f"expected {dim} numbers" if w else error for w in wrong],
                })

    kind = df.schema[row_id].dataType.simpleString()
    return df.select(row_id, text).mapInPandas(run, f"`{row_id}` {kind}, embedding array<double>, error string")


def nearest(queries: DataFrame, base: DataFrame, row_id: str, vector: str, k: int = 10, query_block: int = 1024, base_block: int = 8192) -> DataFrame:
    """(query_id, row_id, cosine, rank): the k nearest of all base rows for each query, itself left out; ties by id.

    Exact: queries and base are cut into blocks of bounded size, every block of one meets every block of the other in a
    task of its own as one matrix product, and the best k of each meeting are merged for each query.
    """
    n_q, n_b = max(1, -(-queries.count() // query_block)), max(1, -(-base.count() // base_block))
    v = F.col(vector).cast("array<double>")
    left = queries.select(F.col(row_id).alias("id"), v.alias("v"), F.pmod(F.xxhash64(row_id), F.lit(n_q)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(n_b - 1))).alias("bb"))
    right = base.select(F.col(row_id).alias("id"), v.alias("v"), F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"), F.pmod(F.xxhash64(row_id, F.lit(1)), F.lit(n_b)).cast("int").alias("bb"))

    def meet(key: tuple, q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if q.empty or b.empty:
            return pd.DataFrame({"query_id": [], "id": [], "cosine": []}).astype({"query_id": "int64", "id": "int64", "cosine": "float64"})
        x, y = np.array(q["v"].tolist()), np.array(b["v"].tolist())
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
        sims, ids = np.round(x @ y.T, 6), b["id"].to_numpy()
        out = []
        for i, qid in enumerate(q["id"].to_numpy()):
            s = np.where(ids == qid, -np.inf, sims[i])
            top = np.lexsort((ids, -s))[:k]
            out += [(qid, ids[j], s[j]) for j in top if s[j] > -np.inf]
        return pd.DataFrame(out, columns=["query_id", "id", "cosine"])

    met = left.groupBy("qb", "bb").cogroup(right.groupBy("qb", "bb")).applyInPandas(meet, "query_id bigint, id bigint, cosine double")
    best = met.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("d"), F.col("id").alias("id")))), 1, k).alias("t"))
    return best.select("query_id", F.posexplode("t").alias("p", "x")).select("query_id", F.col("x.id").alias(row_id), (-F.col("x.d")).alias("cosine"), (F.col("p") + 1).alias("rank"))
