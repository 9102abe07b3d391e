"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most characters given to the tokenizer at once; a longer text is cut before a space, where tokens never span.
STRETCH = 100_000


def default_vocabulary() -> str:
    """Rank file of the byte-level BPE with 50k tokens; TAMIS_TOKENIZERS or /opt/tokenizers names the folder."""
    return os.path.join(os.environ.get("TAMIS_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")


#: Fixed value: the pattern that splits text before merges, as published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def encoding(path: str):
    import tiktoken

    with open(path) as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str) -> int:
    """Tokens of a text; NULL has none.  Unpaired surrogates can't occur in Spark strings."""
    if not text:
        return 0
    enc, n, at = encoding(path), 0, 0
    while len(text) - at > STRETCH:
        end = text.rfind(" ", at + 1, at + STRETCH)
        end = end if end > at and not text[end - 1].isspace() else at + STRETCH
        n, at = n + len(enc.encode_ordinary(text[at:end])), end
    return n + len(enc.encode_ordinary(text[at:]))


def with_tokens(docs: DataFrame, text: str = "text", tokens: str = "tokens", path: str | None = None) -> DataFrame:
    """The table with ``tokens`` in place of the text."""
    path = path or default_vocabulary()
    rest = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[tokens] = [count_tokens(t, path) for t in pdf[text]]
            yield pdf.drop(columns=text)

    from pyspark.sql import types as T

    return docs.select(*[F.col(f.name) for f in rest], text).mapInPandas(run, T.StructType([*rest, T.StructField(tokens, T.LongType())]))
