"""Problem 9: sources mixed to target weights, in blocks of tokens.

Each source's texts are laid end to end in a pseudorandom order and cut into blocks of ``block_tokens``; a distributed
prefix sum over hash buckets gives every text its place. The largest total in which each source keeps its share without
using a block more than ``max_repeats`` times sets the number of slots of each source. A pseudorandom permutation of all
slots deals them to output shards, so a shard's source counts are multinomial draws without replacement and the totals stay
exact, with nothing drawn on the driver. Each slot is mapped through its source's pseudorandom permutation of block
numbers, another one in each repeat, and joined with the blocks by number.

Only sums for each source are gathered. Defined cases: a source without target, or with a share of 0, gives nothing; a text without tokens is in no
block; a source that has no tokens but a share makes the mix empty; repeated ids are laid out as often as they occur.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .tokens import VOCABULARY, token_sizes

MAX_BUCKETS, MAX_SOURCES = 4096, 1000


def permuted(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each ``j`` in a permutation of 0..n-1 that ``key`` picks: four Feistel rounds, walked back below n."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2).astype(np.uint64))
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = j.astype(np.uint64), np.ones(len(j), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            x, h, m, k = out[todo], half[todo], low[todo], key[todo].astype(np.uint64)
            left, right = x >> h, x & m
            for r in range(4):
                z = (right + k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1) * np.uint64(0xD1B54A32D192ED03)) * np.uint64(0xBF58476D1CE4E5B9)
                z = (z ^ (z >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((z ^ (z >> np.uint64(32))) & m)
            out[todo] = (left << h) | right
            todo &= out >= n.astype(np.uint64)
    return out.astype(np.int64)


def blocks(sizes: DataFrame, block_tokens: int, docs_per_bucket: int = 20_000) -> tuple[DataFrame, dict[str, int]]:
    """(source, block, doc_id, doc_from, n_tokens) of every piece of every text, and the tokens of each source."""
    sized = cut(sizes.where((F.col("n_tokens") > 0) & F.col("source").isNotNull()), "mix-sizes")
    buckets = int(min(MAX_BUCKETS, max(1, math.ceil(sized.count() / docs_per_bucket))))
    placed = sized.withColumn("h", F.xxhash64("doc_id")).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sums = placed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(sums.withColumn("offset", F.coalesce(F.sum("tokens").over(before), F.lit(0))), "mix-offsets")
    totals = {r[0]: int(r[1]) for r in offsets.groupBy("source").agg(F.sum("tokens")).limit(MAX_SOURCES + 1).collect()}
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"there are more than {MAX_SOURCES} sources")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    laid = placed.join(offsets.select("source", "bucket", "offset"), ["source", "bucket"]).withColumn("at", start)
    size = F.lit(block_tokens)
    first, last = (F.col("at") / size).cast("bigint"), ((F.col("at") + F.col("n_tokens") - 1) / size).cast("bigint")
    cutup = laid.select("source", "doc_id", "at", "n_tokens", F.explode(F.sequence(first, last)).alias("block"))
    lo = F.greatest(F.col("at"), F.col("block") * size)
    hi = F.least(F.col("at") + F.col("n_tokens"), (F.col("block") + 1) * size)
    return cutup.select("source", "block", "doc_id", (lo - F.col("at")).alias("doc_from"), (hi - lo).alias("n_tokens")), totals


def slots_of(n_blocks: dict[str, int], target: dict[str, tuple[float, int]]) -> dict[str, int]:
    """How many slots each source fills: its share of the largest total that no source's repeats are too few for."""
    use = {s: t for s, t in target.items() if t[0] > 0 and t[1] > 0}
    if not use or any(n_blocks.get(s, 0) == 0 for s in use):
        return {}
    total = min(n_blocks[s] * r / share for s, (share, r) in use.items())
    return {s: min(round(total * share), n_blocks[s] * r) for s, (share, r) in sorted(use.items())}


CHUNK_SLOTS = 1 << 16


def mix(sizes: DataFrame, targets: DataFrame, block_tokens: int = 512, shard_blocks: int = 65_536, seed: int = 7) -> DataFrame:
    """(shard, slot, source, repeat_no, block, doc_id, doc_from, n_tokens): the selection, piece by piece."""
    spark = sizes.sparkSession
    rows = targets.select("source", "target_share", "max_repeats").where("source is not null").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"there are more than {MAX_SOURCES} targets")
    target = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in rows}
    pieces, totals = blocks(sizes, block_tokens)
    n_blocks = {s: -(-t // block_tokens) for s, t in totals.items()}
    slots = slots_of(n_blocks, target)
    keys = {s: k for k, s in enumerate(sorted(target))}
    all_slots, plan = 0, []
    for s, n in slots.items():
        plan.append((s, all_slots, n, n_blocks[s], keys[s]))
        all_slots += n
    # a row for each source becomes one for each chunk of its slots, and those are dealt to tasks before slots are made
    sources = spark.createDataFrame(plan, "source string, first bigint, slots bigint, n bigint, k int")
    chunks = sources.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("slots") - 1, F.lit(0)), F.lit(CHUNK_SLOTS).cast("bigint")))).where("slots > 0")
    chunks = chunks.repartition("source", "from")

    @F.pandas_udf("bigint")
    def place(j: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(j.to_numpy(), n.to_numpy(), key.to_numpy()))

    each = chunks.withColumn("slot", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + CHUNK_SLOTS, F.col("slots")) - 1)))
    dealt = place(F.col("first") + F.col("slot"), F.lit(max(1, all_slots)).cast("bigint"), F.lit(seed * 7_919 + 1).cast("bigint"))
    each = each.withColumn("shard", (dealt / F.lit(shard_blocks)).cast("int"))
    repeat = (F.col("slot") / F.col("n")).cast("int")
    each = each.withColumn("repeat_no", repeat).withColumn("block", place(F.col("slot") % F.col("n"), F.col("n"), F.lit(seed * 1_000_003).cast("bigint") + F.col("k") * 1009 + F.col("repeat_no")))
    return each.join(pieces, ["source", "block"]).select("shard", "slot", "source", "repeat_no", "block", "doc_id", "doc_from", "n_tokens")


def mix_documents(documents: DataFrame, mix_target: DataFrame, vocabulary: str = VOCABULARY, **options) -> DataFrame:
    """``mix`` for the texts of ``documents``."""
    return mix(token_sizes(documents, ["source", "doc_id"], vocabulary=vocabulary), mix_target, **options)


def shares_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and reached share of each source, its tokens, texts, and the most that a block was used."""
    # a text is in a repeat at most once, so its uses are counted in distinct repeats, block by block
    per = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), (F.max("repeat_no") + 1).alias("most_repeats"))
    total = Window.partitionBy()
    out = targets.select("source", "target_share", "max_repeats").join(per, "source", "left")
    out = out.withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    return out.withColumn("share", F.round(F.col("tokens") / F.sum("tokens").over(total), 6))
