"""Problem 8: items of varying length into containers of fixed capacity, by minimum bin slack.

Items are spread over windows of about ``window_items`` by a hash of their id, so each window is bounded however large
the table grows, and windows are packed side by side. A window is a count of items for each length. Its largest
remaining item opens a container; a subset-sum over the remaining lengths, as shifts of one integer whose bits are the
reachable sums, finds the multiset that fills the rest closest to the capacity, and walking back through the recorded
states gives its counts. A filling is used as often as the counts allow before the next one is sought.

Defined cases: only an item longer than the capacity is split, into full pieces and a rest that is packed as an item; an
item without tokens joins the first container of its window; a null text has no tokens; repeated ids are packed as
often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .tokens import VOCABULARY, token_sizes


def closest_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many items of each length fill ``room`` best: the largest sum that isn't above it."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x, c in counts.items() if c and 0 < x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left > 0:
            take = min(k, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, k = left - take, k * 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            used[length] += take
    return dict(used)


def fillings(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(filling, how often) until no item is left; every length must be from 1 to ``capacity``."""
    left = {x: c for x, c in counts.items() if c > 0}
    out = []
    while left:
        first = max(left)
        left[first] -= 1
        used = closest_filling(left, capacity - first)
        left[first] += 1
        used[first] = used.get(first, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        out.append((used, times))
    return out


def pack(sizes: DataFrame, containers: DataFrame, item: str = "doc_id", window_items: int = 20_000) -> DataFrame:
    """(container_kind, window, container_no, item, piece_no, start_token, n_tokens, capacity_tokens).

    ``sizes`` has the item and ``n_tokens``; ``containers`` has container_kind and capacity_tokens, and is small.
    """
    kinds = [(r[0], int(r[1])) for r in containers.select("container_kind", "capacity_tokens").distinct().limit(101).collect()]
    if len(kinds) > 100 or any(c < 1 for _, c in kinds):
        raise ValueError("there are more than 100 kinds of containers, or one has no room")
    sizes = cut(sizes.select(item, "n_tokens"), "pack-sizes")  # texts are tokenised once
    kind_type = sizes.schema[item].dataType.simpleString()
    windows = max(1, -(-sizes.count() // window_items))
    each = F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("bigint").alias("capacity_tokens")) for k, c in kinds])
    rows = sizes.select(F.col(item), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.pmod(F.xxhash64(item), F.lit(windows)).cast("int").alias("window"), F.explode(each).alias("k"))
    rows = rows.select("window", "k.*", item, "n_tokens")
    schema = f"container_kind string, window int, container_no int, `{item}` {kind_type}, piece_no int, start_token bigint, n_tokens bigint, capacity_tokens bigint"

    def one_window(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity, kind, window = int(pdf["capacity_tokens"].iloc[0]), pdf["container_kind"].iloc[0], int(pdf["window"].iloc[0])
        pieces: dict[int, list[tuple]] = defaultdict(list)
        out, no = [], 0
        pdf = pdf.sort_values(item)
        for i, n in zip(pdf[item], pdf["n_tokens"], strict=True):
            start, piece = 0, 0
            while n - start > capacity:  # only these are split
                out.append((no, i, piece, start, capacity))
                start, piece, no = start + capacity, piece + 1, no + 1
            pieces[int(n - start)].append((i, piece, start))
        empty = pieces.pop(0, [])
        out += [(0, i, piece, start, 0) for i, piece, start in empty]
        for used, times in fillings({x: len(p) for x, p in pieces.items()}, capacity):
            for _ in range(times):
                for length, n in used.items():
                    for _ in range(n):
                        out.append((no, *pieces[length].pop(), length))
                no += 1
        got = pd.DataFrame(out, columns=["container_no", item, "piece_no", "start_token", "n_tokens"])
        got[item] = got[item].astype(pdf[item].dtype)
        got.insert(0, "container_kind", kind)
        got.insert(1, "window", window)
        return got.assign(capacity_tokens=capacity)

    return rows.groupBy("container_kind", "window").applyInPandas(one_window, schema)


def pack_documents(documents: DataFrame, container_ref: DataFrame, vocabulary: str = VOCABULARY, window_items: int = 20_000) -> DataFrame:
    """``pack`` for the texts of ``documents``."""
    return pack(token_sizes(documents, ["doc_id"], vocabulary=vocabulary), container_ref, window_items=window_items)


def fill_report(packed: DataFrame) -> DataFrame:
    """Containers, tokens, unused share and split items of each kind."""
    per = packed.groupBy("container_kind", "window", "container_no").agg(F.sum("n_tokens").alias("used"), F.first("capacity_tokens").alias("capacity"), F.count_if(F.col("piece_no") == 1).alias("split"))
    return per.groupBy("container_kind").agg(
        F.count("*").alias("containers"),
        F.sum("used").alias("tokens"),
        F.sum("split").alias("split_items"),
        F.round(1 - F.sum("used") / F.sum("capacity"), 6).alias("unused_share"),
    )
