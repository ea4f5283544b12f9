"""Duplicates hidden by formatting: Merkle-style digests of nested records, and link addresses as such records.

A record is hashed bottom-up. Leaves are normalised (blanks, letter case, punctuation), the child digests of an unordered
node (struct fields, maps, arrays named as unordered) are sorted before they are hashed, those of an ordered array are not.
Records meet by root digest and are confirmed by their whole normalised structure, which is part of the grouping key: two
different structures of one digest stay apart.

A link is the record struct<host: words, path: words, params: unordered of key=value>. Blanks, letter case, scheme, a
leading `www.`, default port, fragment, percent and HTML escapes, punctuation between the words, order of parameters and
tracking parameters don't enter it.

Defined results: a null, empty or wordless link has no address (null) and is in no group; equal rows are copies of each
other; an empty table gives an empty result; links of any length are read whole; extra columns are ignored.

Scale: native columns, but for links with rarer HTML escapes; one aggregation with map-side combination (a hot address costs one row a task), then a join of
the addresses that occur twice or more, whose hot keys AQE splits because the other side has one row a key.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.dates import once
from newsloom.functions.url import TRACKING_RE

_WORD = r"\p{L}\p{N}\p{M}"
# Named HTML escapes of ASCII punctuation.
ESCAPES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "sol": "/", "quest": "?", "equals": "=", "num": "#", "colon": ":", "period": ".", "lowbar": "_", "hyphen": "-"}


#: A named or numeric escape with its semicolon; without one, `&copy=1` is a parameter.
ESCAPE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: re.sub(ESCAPE, lambda m: html.unescape(m[0]), t), na_action="ignore")


def unescape_html(text: Column) -> Column:
    """All named and numeric escapes; only texts that hold one besides &amp; go to Python."""
    text = F.regexp_replace(text, r"(?i)&(amp;)+", "&")
    for name, sign in ESCAPES.items():
        if name != "amp":
            text = F.replace(text, F.lit(f"&{name};"), F.lit(sign))
    return F.coalesce(_unescaped(F.when(text.rlike(ESCAPE), text)), text)


def _decoded(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("%")), F.coalesce(F.try_url_decode(text), text)).otherwise(text)


def words(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(_decoded(text)), f"[^{_WORD}]+", " "))


def link_record(link: Column) -> Column:
    """struct<host string, path string, params array<string>>: words by single spaces, params sorted; null without words."""

    def split_parts(u: Column) -> Column:
        u = F.regexp_replace(u, f"^[^{_WORD}]+", "")
        u = F.regexp_replace(u, r"(?i)^[a-z][a-z0-9+.\-]*://+", "")
        u = F.regexp_replace(u, r"(?s)#.*$", "")

        def parts(v: Column) -> Column:
            head = _decoded(F.lower(F.regexp_extract(v, r"(?s)^([^?]*)", 1)))
            query = F.regexp_extract(v, r"(?s)^[^?]*\?(.*)$", 1)
            head = F.regexp_replace(head, rf"^[^{_WORD}]*(?:www\.)?", "")
            host = F.regexp_replace(F.regexp_extract(head, r"(?s)^([^/]*)", 1), r":(80|443)\s*$", "")
            path = F.regexp_extract(head, r"(?s)^[^/]*(/.*)$", 1)

            def param(p: Column) -> Column:
                key, value = F.split_part(p, F.lit("="), F.lit(1)), F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)
                name = F.regexp_replace(F.lower(_decoded(key)), f"^[^{_WORD}]+", "")
                text = F.concat(words(key), F.lit("="), words(value))
                return F.when(~name.rlike(TRACKING_RE) & (text != "="), text)

            params = F.array_sort(F.filter(F.transform(F.split(query, "&"), param), lambda p: p.isNotNull()))
            return F.struct(words(host).alias("host"), words(path).alias("path"), params.alias("params"))

        return once(u, parts)

    record = once(unescape_html(link), split_parts)
    return once(record, lambda r: F.when((r["host"] != "") | (r["path"] != ""), r))


def normal_leaf(text: Column) -> Column:
    """Blanks, letter case and punctuation removed from the comparison."""
    return F.trim(F.regexp_replace(F.lower(text), f"[^{_WORD}]+", " "))


def merkle_digest(value: Column, kind: T.DataType, unordered: frozenset[str] = frozenset(), path: str = "") -> Column:
    """Digest of a value of any nested type. unordered: dotted paths of arrays whose order doesn't count.

    A null leaf, an absent field and an empty text are one thing: records that differ only there are the same record.
    """
    if isinstance(kind, T.StructType):
        below = [
            F.xxhash64(F.lit(f.name.lower()), merkle_digest(value.getField(f.name), f.dataType, unordered, f"{path}.{f.name}".lstrip(".")))
            for f in kind.fields
        ]
        return F.xxhash64(F.lit("struct"), F.array_sort(F.array(*below)))
    if isinstance(kind, T.ArrayType):
        below = F.transform(F.coalesce(value, F.array().cast(kind)), lambda x: merkle_digest(x, kind.elementType, unordered, path))
        return F.xxhash64(F.lit("array"), F.array_sort(below) if path in unordered else below)
    if isinstance(kind, T.MapType):
        entries = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        below = F.transform(F.map_entries(value), lambda x: merkle_digest(x, entries, unordered, path))
        return F.xxhash64(F.lit("map"), F.array_sort(below))
    return F.xxhash64(F.coalesce(normal_leaf(value.cast("string")), F.lit("")))


LINK_TYPE = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("params", T.ArrayType(T.StringType()))])


def with_address(df: DataFrame, link: str, digest: str = "address_digest", address: str = "address") -> DataFrame:
    """Adds the root digest of the link's record and the whole structure as text; both null without an address."""
    if taken := {c.lower() for c in df.columns} & {digest.lower(), address.lower()}:
        raise ValueError(f"columns already there: {sorted(taken)}")

    def both(r: Column) -> Column:
        text = F.concat(r["host"], F.lit("/"), r["path"], F.lit("?"), F.array_join(r["params"], "&"))
        return F.when(r.isNotNull(), F.struct(merkle_digest(r, LINK_TYPE, frozenset({"params"})).alias("d"), text.alias("t")))

    # a generator, not a projection: filters and join keys on its columns would make Spark read each link again
    none = F.struct(F.lit(None).cast("bigint").alias("d"), F.lit(None).cast("string").alias("t"))
    out = df.select("*", F.inline(F.array(F.coalesce(once(link_record(F.col(f"`{link}`")), both), none))).alias(digest, address))
    return out


def first_copies(df: DataFrame, id_column: str, keys: list[str]) -> DataFrame:
    """Per group of equal, non-null keys: first_id, copies; groups of one stay in."""
    groups = df.groupBy(*keys).agg(F.min(id_column).alias("first_id"), F.count("*").alias("copies"))
    return groups.where(F.col(keys[0]).isNotNull())


def copies_of_first(df: DataFrame, id_column: str, keys: list[str]) -> DataFrame:
    """(first_id, id) of every row that isn't the first of its group; each id stands in one row."""
    first = first_copies(df, id_column, keys).where("copies > 1").drop("copies")
    rows = df.select(F.col(id_column).alias("article_id"), *keys).join(first, keys)
    return rows.where("article_id <> first_id").select("first_id", "article_id")


def _links(spark, sf: str, table: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/{table}.parquet").select("article_id", "link")
    return with_address(rows, "link").drop("link")


KEYS = ["address_digest", "address"]


def p4_found(spark, sf: str) -> DataFrame:
    a, b = (copies_of_first(_links(spark, sf, t), "article_id", KEYS) for t in ("reddit_articles", "web_articles"))
    return a.unionByName(b)


def p4_records(spark, sf: str) -> DataFrame:
    """One record per address and table with its number of copies."""
    parts = []
    for t in ("reddit_articles", "web_articles"):
        parts.append(first_copies(_links(spark, sf, t), "article_id", KEYS).select(F.lit(t).alias("table_name"), "first_id", "address", "copies"))
    return parts[0].unionByName(parts[1])
