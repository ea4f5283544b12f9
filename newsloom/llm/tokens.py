"""Sizes of texts in tokens of a public tokenizer, and ranks and running sums that survive hot keys."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A tiktoken rank file; every executor must see it under this path.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pre-tokenisation pattern of byte-level BPE vocabularies of this family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rows that are numbered in one group at most, about: a hot key is split into groups of this size.
GROUP_ROWS = 1_000_000
_encodings: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a rank file, loaded once a Python worker."""
    if path not in _encodings:
        import tiktoken

        lines = Path(path).read_bytes().splitlines()
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
        _encodings[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def token_count(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Tokens of the whole text; 0 for null and empty texts."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(tokenizer).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str, size: Column | None = None, most: int = 0, salt: Column | None = None) -> DataFrame:
    """df with a running number (0-based) per key, or the sum of size over the rows before, in a column out.

    most: rows of the largest key. The order within a key is by salt (a hash of the order columns, of as many values as the
    largest key needs), then by the order columns. No task holds a hot key whole: numbers are taken within (key, salt), and
    a small table has what comes before each salt. salt: another expression to split keys by.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(max(8, -(-most // GROUP_ROWS)))) if salt is None else salt)
    amount = size if size is not None else F.lit(1)
    totals = salted.groupBy(*keys, "__salt").agg(F.sum(amount).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy(*keys, "__salt").orderBy(*order)
    if size is None:
        local = F.row_number().over(within) - 1
    else:
        local = F.coalesce(F.sum(size).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = salted.withColumn("__local", local).join(bases, [*keys, "__salt"])
    return rows.withColumn(out, (F.col("__base") + F.col("__local")).cast("bigint")).drop("__salt", "__local", "__base")
