"""Every pair of titles that can reach a similarity, whatever tokens they share: blocks of titles meet as matrix products.

A title becomes a card: a 1024-bit map of its bigrams, counts of its letters and a few sizes. What a pair needs in common is
at least a sum of one number of either title, so one product of two blocks' maps, folded to 256 bits, with these numbers as
columns tells which pairs may be near; the few that are left are tried on the whole cards. All bounds are necessary
conditions of `similarity.can_reach` and of the ratios: they lose nothing. No token is left out for being common. The price
is that each pair of titles is looked at, for some nanoseconds: work grows with the square of the titles, disk doesn't.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import near as N
from newsloom.session import forget, written

#: Titles of a block, rows of a product, pairs that are tried on whole cards at once, blocks that go to Python at once.
BLOCK, STRIP, AT_ONCE, BATCH = 4096, 512, 200_000, 4
#: 64-bit words of the map and of the folded one.
LANES, FOLDED = 16, 4
CARD = np.dtype([("map", "<u8", LANES), ("ix", "<i8"), *[(c, "<i4") for c in ("grams", "words", "odd", "length", "compact", "domain", "url", "cross", "twice")], ("bag", "u1", 32)])

HAN = re.compile("[\u3400-\u4dbf\u4e00-\u9fff]")


def countable(title: str) -> bool:
    """Whether a title has 2 words or 3 CJK bigrams to share."""
    return len({w for w in title.split(" ") if len(w) >= 2}) >= 2 or len(HAN.findall(title)) >= 4


def cards_of(titles: list[str]) -> np.ndarray:
    """Cards of normalised titles (ix, domain and url 0). cross: bigrams across words at the most. twice: a word comes again."""
    row, token, sizes = N.read_titles(titles, (N.GRAM,))
    cards = np.zeros(len(titles), CARD)
    for c in ("grams", "words", "odd", "length", "compact"):
        cards[c] = sizes[c]
    bits = np.zeros((len(titles), 64 * LANES), np.uint8)
    bits[row, (token.view(np.uint64) >> np.uint64(54)).astype(np.int64)] = 1
    cards["map"] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    words = [t.split() for t in titles]
    cards["cross"] = [max(len(w) - 1, 0) for w in words]
    cards["twice"] = [len(set(w)) < len(w) for w in words]
    letters = ["".join(w) for w in words]
    code = np.frombuffer("".join(letters).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    place = np.repeat(np.arange(len(titles)), [len(x) for x in letters]) * 32 + (N._mixed(code) >> np.uint64(59)).astype(np.int64)
    cards["bag"] = np.minimum(np.bincount(place, minlength=32 * len(titles)), 255).reshape(-1, 32)
    return cards


def _bits(m: np.ndarray) -> np.ndarray:
    return np.bitwise_count(m).sum(-1, dtype=np.int64)


def needed(cards: np.ndarray, least: float) -> np.ndarray:
    """A number for each card; a pair that can reach least has at least the two numbers' sum of bigrams in common.

    Either the bigrams are close (can_reach), which includes a compact title that is within the other and not much shorter;
    or the overlap is what weighs 0.2 beside ratios of 1 and the hint of a domain.
    """
    if least <= 0.8:
        return np.full(len(cards), -1e6)
    t = (least - 0.74) / 0.2
    close = cards["grams"] / 2 - 0.15 * cards["length"]
    overlap = t / (1 + t) * (cards["grams"] + cards["words"] + cards["odd"]) - cards["words"] / 2 - cards["odd"]
    return np.minimum(close, overlap)


def can_be(a: np.ndarray, b: np.ndarray, common: np.ndarray, least: float) -> np.ndarray:
    """False only for cards of pairs that cannot reach least, exact pairs apart; common: bigrams in common at the most.

    Letters that only one title has are inserted or deleted, which bounds the ratios. A token set ratio of 0.95 needs such
    letters to be a twentieth of all at the most (unless words come again, which it counts once), or common words to be
    all but 0.0953 of one title, hence its bigrams within words as well.
    """
    if least <= 0.8:
        return np.ones(len(a), bool)
    ga, gb = a["grams"], b["grams"]
    size = ga + a["words"] + a["odd"] + gb + b["words"] + b["odd"]
    shared = np.minimum(common + np.minimum(a["words"], b["words"]) + a["odd"] + b["odd"], size // 2)
    jac = np.where(size > 0, shared / np.maximum(size - shared, 1), 0.0)
    held = (common >= np.minimum(ga, gb)) & (np.minimum(a["compact"], b["compact"]) >= 0.7 * np.maximum(a["compact"], b["compact"]) - 1e-9)
    url = np.where(held, 1.0, np.where((a["domain"] != 0) & (a["domain"] == b["domain"]), 0.4, 0.0))
    long = (a["length"] + b["length"]).astype(float)
    odd = np.abs(a["bag"].astype(np.int16) - b["bag"]).sum(1)
    mixed = 0.6 + 0.1 * (1 - odd / np.maximum(long, 1)) + 0.2 * jac + 0.1 * url >= least - 1e-9
    covered = common >= np.minimum(ga - a["cross"] - 0.0953 * a["length"], gb - b["cross"] - 0.0953 * b["length"]) - 1e-9
    sets = (odd <= 0.05 * long + 1e-9) | (a["twice"] != 0) | (b["twice"] != 0) | covered
    return mixed | ((ga + gb - 2 * common <= 0.3 * long + 1e-9) & (odd <= 0.1 * long + 1e-9) & sets)


class _Block:
    """Cards with what products need of them."""

    def __init__(self, body: bytes, least: float):
        self.cards = np.frombuffer(body, CARD)
        self.needed = needed(self.cards, least)
        self.rest = self.cards["grams"] - _bits(self.cards["map"])
        folded = np.bitwise_or.reduce(self.cards["map"].reshape(-1, LANES // FOLDED, FOLDED), axis=1)
        bits = np.unpackbits(np.ascontiguousarray(folded).view(np.uint8), axis=1, bitorder="little").astype(np.float32)
        # bigrams that share a bit: half of both is no less than the lesser of them
        bar = (self.needed - (self.cards["grams"] - _bits(folded)) / 2 - 1e-3).astype(np.float32)[:, None]
        one = np.ones_like(bar)
        self.left, self.right = np.hstack([bits, -bar, one]), np.ascontiguousarray(np.hstack([bits, one, -bar]).T)


def near_of(a: _Block, b: _Block, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and b of the pairs that can reach least; of a block with itself each once."""
    for k in range(0, len(a.cards), STRIP):
        at = np.flatnonzero(a.left[k : k + STRIP] @ b.right >= 0)
        x, y = at // len(b.cards) + k, at % len(b.cards)
        if a is b:
            x, y = x[x < y], y[x < y]
        for s in range(0, len(x), AT_ONCE):
            p, q = x[s : s + AT_ONCE], y[s : s + AT_ONCE]
            common = _bits(a.cards["map"][p] & b.cards["map"][q]) + np.minimum(a.rest[p], b.rest[q])
            ok = common >= a.needed[p] + b.needed[q] - 1e-6
            p, q, common = p[ok], q[ok], common[ok]
            ca, cb = a.cards[p], b.cards[q]
            ok = can_be(ca, cb, np.minimum(common, np.minimum(ca["grams"], cb["grams"])), least)
            if ok.any():
                yield p[ok], q[ok]


@contextmanager
def _few_at_once(spark: SparkSession) -> Iterator[None]:
    """Python gets a few blocks at once, not thousands."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def near(rows: DataFrame, least: float) -> DataFrame:
    """i < j of all titles (see near.titles) that have 2 words or 3 CJK bigrams and whose cards can reach least, each once; read from a written table."""
    spark = rows.sparkSession

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            batch = batch[batch["norm_title"].map(countable)]
            if not len(batch):
                continue
            cards = cards_of(batch["norm_title"].tolist())
            for c in ("ix", "domain", "url"):
                cards[c] = batch[c].to_numpy()
            held.append(cards)
            n += len(cards)
            while n >= BLOCK:
                every = np.concatenate(held)
                yield pd.DataFrame({"body": [every[:BLOCK].tobytes()]})
                held, n = [every[BLOCK:]], n - BLOCK
        if n:
            yield pd.DataFrame({"body": [np.concatenate(held).tobytes()]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, _Block] = {}

        def block(key: int, body: bytes) -> _Block:
            if key not in known:
                while len(known) > 2:
                    known.pop(next(iter(known)))
                known[key] = _Block(body, least)
            else:
                known[key] = known.pop(key)  # the one used last goes last
            return known[key]

        for d in batches:
            for a, b, x, y in zip(d["a"].tolist(), d["b"].tolist(), d["x"], d["y"]):
                left, right = block(a, x), block(b, y)
                for p, q in near_of(left, right, least):
                    i, j = left.cards["ix"][p], right.cards["ix"][q]
                    ok = i != j
                    yield pd.DataFrame({"i": np.minimum(i, j)[ok], "j": np.maximum(i, j)[ok]})

    blocks = written(rows.select("ix", "norm_title", "domain", "url").mapInPandas(packed, "body binary").withColumn("block", F.monotonically_increasing_id()), "blocks")
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks.count()))
    a = blocks.select(F.col("block").alias("a"), F.col("body").alias("x")).repartition(n)
    b = blocks.select(F.col("block").alias("b"), F.col("body").alias("y")).hint("shuffle_replicate_nl")
    with _few_at_once(spark):
        found = written(a.join(b, F.col("a") <= F.col("b")).select("a", "b", "x", "y").mapInPandas(meet, "i bigint, j bigint"), "met")
    forget(blocks)
    return found
