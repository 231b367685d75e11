"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import shipped

#: Where the vocabulary files lie; a parameter of every operator that counts tokens.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A longer text is measured in pieces of this many characters, cut before white space where there is any.
PIECE = 100_000


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    start = 0
    while len(text) - start > most:
        cut = text.rfind(" ", start + most // 2, start + most)
        cut = start + most if cut < 0 else cut
        yield text[start:cut]
        start = cut
    yield text[start:]


def count_tokens(text: str | None, path: str = TOKENIZER) -> int:
    """Tokens of a text; a null one has none."""
    if not text:
        return 0
    encode = encoding(path).encode_ordinary
    if len(text) <= PIECE:
        return len(encode(text))
    return sum(len(encode(p)) for p in pieces(text))


def with_tokens(df: DataFrame, text_col: str = "text", path: str = TOKENIZER) -> DataFrame:
    """``df`` with its text replaced by its size, a column ``tokens``. Any other columns stay as they are."""
    shipped(df.sparkSession)
    kept = [c for c in df.columns if c != text_col]
    schema = df.drop(text_col).withColumn("tokens", F.lit(0).cast("bigint")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array([count_tokens(t, path) for t in b.column(text_col).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), n], names=[*kept, "tokens"])

    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col)).mapInArrow(count, schema)
