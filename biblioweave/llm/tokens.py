"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

#: Vocabulary file of the byte-level tokenizer that sizes are in, unless a caller names another.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(vocabulary: str = VOCABULARY):
    """The tokenizer of a file of ranks, once per process."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(docs: DataFrame, keep: list[str], text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` of every row; a null or empty text has none."""
    source = docs.select(*keep, text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keep)

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch[text]]
            yield batch[keep].assign(n_tokens=pd.Series(n, index=batch.index, dtype="int64"))

    return source.mapInPandas(sizes, f"{schema}, n_tokens bigint")
