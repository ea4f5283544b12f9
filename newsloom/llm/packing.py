"""Filling fixed-capacity containers: shortest-pack-first over the length histogram.

Only the histogram of item lengths (at most one entry a token of capacity) comes to the driver. Lengths are placed longest
first; each goes to the packs that are filled least, in whole groups of equal packs, and to new packs when none has room.
What results is a list of packing patterns with counts. Items and patterns meet again by rank: the r-th item of a length
has its place in the pattern that covers rank r of that length.

An item longer than the capacity is cut into pieces of the capacity and a rest; any other item stays whole. Defined
results: null and empty texts have no tokens and no place; equal documents are items of their own; a capacity below 1
takes no item; ties are broken by id, so the same input gives the same containers.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tokens import TOKENIZER, numbered, token_count
from newsloom.session import written

#: Ranks of one stretch in which items look for their pattern.
RANKS = 1024


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(number of packs, {length: items of this length in each})] for lengths 1..capacity."""
    groups: dict[int, tuple[int, dict[int, int]]] = {}
    heap: list[tuple[int, int]] = []  # (filled, group): the least filled first
    number = 0

    def put(filled: int, count: int, pattern: dict[int, int]) -> None:
        nonlocal number
        groups[number] = (count, pattern)
        heapq.heappush(heap, (filled, number))
        number += 1

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > capacity:
                each = capacity // length  # a new pack is the least filled one until it has no room for this length
                whole, rest = divmod(left, each)
                if whole:
                    put(each * length, whole, {length: each})
                if rest:
                    put(rest * length, 1, {length: rest})
                break
            filled, g = heapq.heappop(heap)
            count, pattern = groups.pop(g)
            take = min(count, left)
            if take < count:
                put(filled, count - take, pattern)
            put(filled + length, take, pattern | {length: pattern.get(length, 0) + 1})
            left -= take
    return list(groups.values())


def intervals(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first container, items a container): which ranks of a length a pattern takes."""
    taken: dict[int, int] = {}
    out, base = [], 0
    for count, pattern in patterns:
        for length, each in pattern.items():
            lo = taken.get(length, 0)
            out.append((length, lo, lo + count * each, base, each))
            taken[length] = lo + count * each
        base += count
    return out


def pieces(sizes: DataFrame, capacity: dict[str, int]) -> DataFrame:
    """sizes doc_id, n_tokens; capacity of each kind of container -> one row per piece."""
    kinds = F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("int").alias("capacity_tokens")) for k, c in capacity.items() if c and c > 0])
    kinds = kinds if any(c and c > 0 for c in capacity.values()) else F.array().cast("array<struct<container_kind:string,capacity_tokens:int>>")
    both = sizes.where("n_tokens > 0").select("doc_id", "n_tokens", F.inline(kinds))
    last = F.floor((F.col("n_tokens") - 1) / F.col("capacity_tokens")).cast("bigint")
    cut = both.withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    start = F.col("piece_no") * F.col("capacity_tokens")
    return cut.select("container_kind", "doc_id", "piece_no", start.alias("start_token"), F.least(F.col("capacity_tokens"), F.col("n_tokens") - start).cast("int").alias("length"))


def pack(sizes: DataFrame, containers: DataFrame) -> DataFrame:
    """container_kind, container_no, doc_id, piece_no, start_token, n_tokens: a place for every piece."""
    capacity = {r["container_kind"]: r["capacity_tokens"] for r in containers.collect()}  # a row a kind
    items = pieces(sizes, capacity)
    histogram: dict[str, dict[int, int]] = {}
    for r in items.groupBy("container_kind", "length").count().collect():  # at most the sum of the capacities
        histogram.setdefault(r["container_kind"], {})[r["length"]] = r["count"]
    rows = [(kind, *x) for kind, h in sorted(histogram.items()) for x in intervals(pack_histogram(h, capacity[kind]))]
    plan = sizes.sparkSession.createDataFrame(rows, "container_kind string, length int, lo bigint, hi bigint, base bigint, each bigint")
    # ranks are looked up by stretches of RANKS, so that an item meets only patterns of its stretch, however common its length
    stretch = lambda rank: F.floor(rank / RANKS).cast("bigint")
    plan = plan.withColumn("stretch", F.explode(F.sequence(stretch(F.col("lo")), stretch(F.col("hi") - 1))))
    most = max((n for h in histogram.values() for n in h.values()), default=0)
    ranked = numbered(items, ["container_kind", "length"], ["doc_id", "piece_no"], "rank", most=most).withColumn("stretch", stretch(F.col("rank")))
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    placed = ranked.join(plan, ["container_kind", "length", "stretch"]).where(inside)
    number = F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("each")).cast("bigint")
    return placed.select("container_kind", number.alias("container_no"), "doc_id", "piece_no", "start_token", F.col("length").cast("bigint").alias("n_tokens"))


def document_sizes(spark, sf: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source, n_tokens of every document; written, so that texts are tokenised once."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    return written(docs.select("doc_id", "source", token_count(F.col("text"), tokenizer).alias("n_tokens")), "token-counts")


def p7_containers(spark, sf: str) -> DataFrame:
    return pack(document_sizes(spark, sf).drop("source"), spark.read.parquet(f"{sf}/container_sizes.parquet"))


def p7_fill(spark, sf: str) -> DataFrame:
    """Containers, pieces and filled share per kind."""
    kinds = spark.read.parquet(f"{sf}/container_sizes.parquet")
    used = p7_containers(spark, sf).groupBy("container_kind", "container_no").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("n_tokens"))
    total = used.groupBy("container_kind").agg(F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("fullest"))
    return total.join(kinds, "container_kind").withColumn("filled", F.col("n_tokens") / (F.col("containers") * F.col("capacity_tokens")))
