"""Lengths of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import TYPE_CHECKING

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import tiktoken

#: Vocabulary file of a byte-level BPE as ranks; read on the workers, never copied.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How the vocabulary splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """Tokens of the whole text; null and empty texts have none."""

    @F.pandas_udf("int")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoding(path)
        for s in texts:
            yield pd.Series([len(e.encode_ordinary(t)) if t else 0 for t in s], dtype="int32")

    return count(text)
