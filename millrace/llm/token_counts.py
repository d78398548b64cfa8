"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LOADED: dict[str, object] = {}


def encoder(path: str = TOKENIZER):
    """The tokenizer stored at `path` (ranks as base64 lines), loaded once per worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[path] = tiktoken.Encoding(re.sub(r"\W", "_", path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def count_tokens(text: str, path: str = TOKENIZER) -> int:
    return len(encoder(path).encode_ordinary(text))


def with_tokens(df: DataFrame, text_col: str = "text", out_col: str = "tokens", path: str = TOKENIZER) -> DataFrame:
    """All rows and columns of `df` with the token count of each text; null for null texts."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for texts in batches:
            yield pd.Series(
                [len(e.encode_ordinary(t)) if isinstance(t, str) else None for t in texts], dtype="Int64"
            )

    return df.withColumn(out_col, count(F.col(text_col)))
