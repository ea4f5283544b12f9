"""Near-duplicate titles: set-similarity self-join by signature trees.

Distinct word sets (copies are folded first) fall into blocks by prefix word (see wordsets). In a block the sets become
the leaves of a tree: sorted by size and signature, 32 to a leaf node, 8 nodes to a parent. A node holds the OR of its
sets' 128-bit token bitmaps, the range of their sizes, their least position and the largest number of words that share a
bit. Two trees are traversed together: a pair of nodes is dropped when its size ranges cannot reach the threshold or
when popcount(OR_a & OR_b) + min(shared-bit excess) is less than the overlap that the smallest sizes need. Pairs of sets
that remain are checked exactly.

Defined results: a null title, or one without a word, resembles none; equal titles are similar; repeated rows are rows of
their own; an empty table gives an empty result; titles of any length are read whole.

Scale: nothing is compared across blocks. Copies are folded before the join and come back by one join per side; a word of
very many sets is split into cells. Word counts stay a table; only a sketch of them of fixed size reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import wordsets as W
from newsloom.operators.graph import connected_components
from newsloom.session import forget, written

LEAF, FAN = 32, 8
THRESHOLD = 0.7


def pairs_within(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All i < j inside each range [start, end)."""
    rows = np.concatenate([np.arange(s, e) for s, e in zip(starts.tolist(), ends.tolist())]) if len(starts) else np.zeros(0, np.int64)
    left = np.repeat(ends, ends - starts) - rows - 1
    i = np.repeat(rows, left)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(left) - left, left)


class Tree:
    """Levels of OR-combined nodes over rows [0, n) that are sorted by size; level 0 has one node a row."""

    def __init__(self, lo, hi, size, excess, pos):
        self.levels = [(lo, hi, size, size, excess, pos)]
        n, step = len(lo), LEAF
        while n > 1:
            at = np.arange(0, n, step)
            l, h, smin, smax, ex, ps = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(l, at), np.bitwise_or.reduceat(h, at), np.minimum.reduceat(smin, at), np.maximum.reduceat(smax, at), np.maximum.reduceat(ex, at), np.minimum.reduceat(ps, at)))
            n, step = len(at), FAN

    def alive(self, level: int, a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
        lo, hi, smin, smax, ex, pos = self.levels[level]
        reach = np.bitwise_count(lo[a] & lo[b]).astype(np.int64) + np.bitwise_count(hi[a] & hi[b]) + np.minimum(ex[a], ex[b])
        # sizes fit: the larger of one may be 1/t of the smaller of the other; positions leave enough words
        fit = (smax[a] >= t * smin[b] - 1e-9) & (smax[b] >= t * smin[a] - 1e-9)
        least = np.maximum(W.need(t, smin[a] + smin[b]), 1)
        return fit & (reach >= least) & (np.minimum(smax[a] - pos[a], smax[b] - pos[b]) >= least)

    def pairs(self, t: float, chunk: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs i < j that no bound excludes; the frontier is walked depth-first in chunks, so memory stays small."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > chunk:
                stack += [(level, a[k : k + chunk], b[k : k + chunk]) for k in range(0, len(a), chunk)]
                continue
            keep = self.alive(level, a, b, t)
            a, b = a[keep], b[keep]
            if level == 0:
                if (one := a < b).any():
                    yield a[one], b[one]
                continue
            if not len(a):
                continue
            fan, n = (LEAF if level == 1 else FAN), len(self.levels[level - 1][0])
            for part in range(0, len(a), max(1, chunk // fan**2)):
                x, y = a[part : part + max(1, chunk // fan**2)], b[part : part + max(1, chunk // fan**2)]
                kx = (x[:, None, None] * fan + np.arange(fan)[None, :, None]) + np.zeros((1, 1, fan), np.int64)
                ky = (y[:, None, None] * fan + np.arange(fan)[None, None, :]) + np.zeros((1, fan, 1), np.int64)
                ok = (kx < n) & (ky < n) & (kx <= ky)
                stack.append((level - 1, kx[ok], ky[ok]))


def similar_in_blocks(batch: pd.DataFrame, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pairs of one block each whose similarity reaches t, and their common words."""
    block = batch["block"].to_numpy()
    edges = np.flatnonzero(np.diff(block)) + 1
    starts, ends = np.r_[0, edges], np.r_[edges, len(block)]
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none, none
    side, size, pos = batch["side"].to_numpy(np.int64), batch["size"].to_numpy(np.int64), batch["tree"].to_numpy(np.int64)
    words = batch["words"].to_numpy()
    maps = lo, hi, excess = W.bitmaps(batch["words"])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(none, none, none)]

    def settle(i: np.ndarray, j: np.ndarray) -> None:
        ok = ((side[i] == 0) | (side[i] != side[j])) & W.position_bound(t, size[i], size[j], pos[i], pos[j])
        ok &= np.minimum(size[i], size[j]) >= t * np.maximum(size[i], size[j]) - 1e-9
        i, j = i[ok], j[ok]
        ok = W.may_share(maps, maps, i, j) >= W.need(t, size[i] + size[j])
        i, j = i[ok], j[ok]
        ok, both = W.confirm(words, i, j, size, pos[i], t)
        found.append((i[ok], j[ok], both[ok]))

    small = ends - starts <= LEAF
    settle(*pairs_within(starts[small], ends[small]))
    for s, e in zip(starts[~small].tolist(), ends[~small].tolist()):
        by = s + np.lexsort((hi[s:e], lo[s:e], size[s:e]))
        tree = Tree(lo[by], hi[by], size[by], excess[by], pos[by])
        for i, j in tree.pairs(t):
            settle(by[i], by[j])
    i, j, both = (np.concatenate(x) for x in zip(*found))
    return i, j, both


def similar_sets(sets: DataFrame, threshold: float, counts: DataFrame, cell_sets: int = W.CELL_SETS) -> DataFrame:
    """set_a, set_b, similarity of all pairs of distinct word sets that reach the threshold; sets: set_key, words; counts: word, n."""
    blocks = W.in_cells(W.prefix_blocks(sets, W.word_order(counts), threshold, closed=True), counts, cell_sets)
    blocks = blocks.repartition("block").sortWithinPartitions("block")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in W.whole_blocks(batches):
            i, j, both = similar_in_blocks(batch, threshold)
            words, size = batch["words"].to_numpy(), batch["size"].to_numpy(np.int64)
            if len(i):
                keys = {r: W.set_key(words[r]) for r in np.unique(np.r_[i, j]).tolist()}
                a, b = ([keys[r] for r in x.tolist()] for x in (i, j))
                yield pd.DataFrame({"set_a": [min(x, y) for x, y in zip(a, b)], "set_b": [max(x, y) for x, y in zip(a, b)], "similarity": both / (size[i] + size[j] - both)})

    return blocks.mapInPandas(join, "set_a binary, set_b binary, similarity double")


def similar_keys(sets: DataFrame, threshold: float, counts: DataFrame) -> DataFrame:
    """set_a, set_b of similar_sets, written: blocks are gone before rows are joined to the pairs. counts is forgotten."""
    pairs = written(similar_sets(sets, threshold, counts).select("set_a", "set_b"), "set-pairs")
    forget(counts)
    return pairs


def word_sets(df: DataFrame, id_column: str, title: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: id, set_key; sets: set_key, words; counts: word, n), read from runs in the shared folder: titles are read once.

    Words are counted over the rows, which lie there without a shuffle; a count that copies make too large costs no more than
    a finer split.
    """
    rows = written(W.with_word_sets(df, id_column, title).drop("batch"), "word-sets")
    sets = rows.groupBy("set_key").agg(F.first("words").alias("words"))
    return rows.select("id", "set_key"), sets, W.word_counts(rows)


def similar_rows(df: DataFrame, id_column: str, title: str, threshold: float = THRESHOLD) -> DataFrame:
    """id_a < id_b of all rows whose titles reach the threshold, equal titles included."""
    members, sets, counts = word_sets(df, id_column, title)
    pairs = similar_keys(sets, threshold, counts)
    a = members.select(F.col("id").alias("x"), F.col("set_key").alias("set_a"))
    b = members.select(F.col("id").alias("y"), F.col("set_key").alias("set_b"))
    across = pairs.join(a, "set_a").join(b, "set_b").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    several = members.groupBy("set_key").count().where("count > 1").select("set_key")
    copies = members.join(several, "set_key", "left_semi")
    equal = copies.alias("a").join(copies.alias("b"), (F.col("a.set_key") == F.col("b.set_key")) & (F.col("a.id") < F.col("b.id")))
    return across.unionByName(equal.select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")))


def similar_groups(df: DataFrame, id_column: str, title: str, threshold: float = THRESHOLD) -> DataFrame:
    """id, class_id (the least id of its class), links (similar rows, copies included) of all rows that resemble another.

    Distinct sets are linked, each named by its least id, so copies are counted and never paired.
    """
    members, sets, counts = word_sets(df, id_column, title)
    heads = written(members.groupBy("set_key").agg(F.min("id").alias("head"), F.count("*").alias("copies")), "set-heads")
    pairs = similar_keys(sets, threshold, counts)
    a, b = (heads.select(F.col("set_key").alias(f"set_{x}"), F.col("head").alias(f"head_{x}"), F.col("copies").alias(f"copies_{x}")) for x in "ab")
    linked = written(pairs.join(a, "set_a").join(b, "set_b"), "set-links")
    forget(pairs)
    both = linked.select(F.col("head_a").alias("head"), F.col("copies_b").alias("n")).unionByName(linked.select(F.col("head_b").alias("head"), F.col("copies_a").alias("n")))
    others = both.groupBy("head").agg(F.sum("n").alias("others"))
    classes = connected_components(linked, "head_a", "head_b").withColumnRenamed("vertex", "head")
    marked = heads.join(others, "head", "left").join(classes, "head", "left")
    marked = marked.select("set_key", F.coalesce("component", "head").alias("class_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    return members.join(marked.where("links > 0"), "set_key").select("id", "class_id", "links")


def titles(spark, sf: str) -> DataFrame:
    tables = ("twitter_articles", "rss_articles", "web_articles")
    return reduce(DataFrame.unionByName, (spark.read.parquet(f"{sf}/{t}.parquet").select("article_id", "title") for t in tables))


def p6_found(spark, sf: str) -> DataFrame:
    return similar_rows(titles(spark, sf), "article_id", "title")


def p6_groups(spark, sf: str) -> DataFrame:
    """Each record with a similar one: its class and its number of links."""
    return similar_groups(titles(spark, sf), "article_id", "title")
