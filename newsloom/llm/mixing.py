"""Mixing sources to target weights: fixed-length token blocks, drawn by index.

Each source's documents, in a pseudorandom order, form one stream of tokens that is cut into blocks of BLOCK tokens. The
total is shared out in tokens by target; a source that would have to repeat its tokens more than max_repeats times gives
what it has, and the rest goes to the others by their targets. Without a given total it is the largest at which every target
is met. Tokens become slots, one a block; the last block of a stream is shorter and counts as what it holds, so a source misses
its tokens by less than a block. Source counts per output shard are drawn from the multinomial conditioned on these totals (so
that totals come out exactly). A source's j-th slot is block perm(j mod n) of its round j div n, each round with a permutation
of its own (a Feistel network with cycle walking); so no block, and no document in it, is used more often than rounds allow.

Defined results: null and empty texts and documents of sources without a target are left out; a source without tokens
has no slots and its share goes to the others; a missing or negative cap counts as 0 repeats; equal documents are
documents of their own; equal input and seed give the same selection.

Scale: shards have BLOCKS_PER_SHARD blocks each, however many that makes. The driver draws counts for the square root of
that many groups of shards (sources x groups rows); a task draws the shards of its group and writes their slots in parts.
Streams are cut by running sums within salts; slots and blocks meet by an equi-join on (source, block).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.packing import document_sizes
from newsloom.llm.tokens import numbered

BLOCK = 512
BLOCKS_PER_SHARD = 256
#: Slots that a task writes at once.
SLOTS_AT_ONCE = 1 << 16
SEED = 7


def allocate(sizes: dict[str, int], targets: dict[str, float], repeats: dict[str, int], total: int | None = None) -> dict[str, int]:
    """Amount per source, in the unit of sizes. total None: the most at which every source that has any reaches its target."""
    usable = [s for s in targets if targets[s] > 0 and sizes.get(s, 0) > 0 and repeats.get(s, 0) > 0]
    cap = {s: sizes[s] * repeats[s] for s in usable}
    if not usable:
        return {}
    weight = sum(targets[s] for s in usable)
    if total is None:
        total = int(min(cap[s] * weight / targets[s] for s in usable))
    slots: dict[str, float] = {}
    left, open_ = float(min(total, sum(cap.values()))), list(usable)
    while open_:
        w = sum(targets[s] for s in open_)
        full = [s for s in open_ if left * targets[s] / w >= cap[s]]
        if not full:
            slots |= {s: left * targets[s] / w for s in open_}
            break
        for s in full:
            slots[s] = cap[s]
        left -= sum(cap[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    out = {s: int(x) for s, x in slots.items()}
    short = min(total, sum(cap.values())) - sum(out.values())
    for s in sorted(out, key=lambda s: (out[s] - slots[s], s)):  # largest remainders
        if short > 0 and out[s] < cap[s]:
            out[s], short = out[s] + 1, short - 1
    return out


def drawn(rng: np.random.Generator, left: np.ndarray, size: int) -> np.ndarray:
    """size draws without replacement from left of each kind."""
    if left.sum() < 10**9:
        return rng.multivariate_hypergeometric(left, size, method="marginals")
    # beyond the range of the exact method replacement makes no difference but at a kind's end
    out = np.minimum(rng.multinomial(size, left / left.sum()), left)
    while (short := size - int(out.sum())) > 0:
        out += np.minimum(rng.multinomial(short, (left - out) / (left - out).sum()), left - out)
    return out


def shard_counts(slots: dict[str, int], shards: int, seed: int | tuple = SEED, widths: list[int] | None = None) -> list[tuple[int, str, int, int, int]]:
    """(shard, source, count, first slot of the source, first place in the shard). widths: relative sizes of the shards."""
    rng, names = np.random.default_rng(seed), sorted(slots)
    left = np.array([slots[s] for s in names], np.int64)
    used, out = np.zeros(len(names), np.int64), []
    widths = widths or [1] * shards
    rest = sum(widths)
    for k in range(shards):
        size = int(left.sum()) * widths[k] // rest
        rest -= widths[k]
        got = drawn(rng, left, size) if k < shards - 1 else left.copy()
        place = 0
        for i, s in enumerate(names):
            if got[i]:
                out.append((k, s, int(got[i]), int(used[i]), place))
                place += int(got[i])
        used, left = used + got, left - got
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Pseudorandom permutation of [0, n) for each key: a 4-round Feistel network over the next power of 4, walked into range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, key = index.astype(np.uint64), key.astype(np.uint64)
    todo = np.arange(len(out))

    def scrambled(x: np.ndarray, r: int) -> np.ndarray:
        x = (x + key[todo] + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x >> np.uint64(32)

    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for r in range(4):
            if inverse:
                left, right = (right ^ scrambled(left, 3 - r)) & mask[todo], left
            else:
                left, right = right, (left ^ scrambled(right, r)) & mask[todo]
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def round_key(key, turn):
    return key * 1_000_003 + turn


def slots_for(goal: int, total: int, block: int, key: int) -> int:
    """How many slots of a source with total tokens come closest to goal tokens."""
    n = -(-total // block)
    tail = total - (n - 1) * block
    turn, rest = divmod(goal, total)
    more = min(n, (rest + block // 2) // block)
    if 0 < more < n:  # the short block may stand among the slots of the last round
        one = lambda x: np.array([x], np.int64)
        if permuted(one(n - 1), one(n), one(round_key(key, turn)), inverse=True)[0] < more and rest - (more - 1) * block - tail > block // 2:
            more += 1
    return turn * n + more


def blocks_of(sizes: DataFrame, block: int = BLOCK, most: int = 0) -> DataFrame:
    """source, block_no, doc_id, start_token, n_tokens: the parts of documents that make up each block. most: documents of the largest source."""
    placed = numbered(sizes.where("n_tokens > 0"), ["source"], ["doc_id"], "at", size=F.col("n_tokens"), most=most)
    end = F.col("at") + F.col("n_tokens")
    first, last = F.floor(F.col("at") / block).cast("bigint"), F.floor((end - 1) / block).cast("bigint")
    cut = placed.withColumn("block_no", F.explode(F.sequence(first, last)))
    lo, hi = F.greatest(F.col("at"), F.col("block_no") * block), F.least(end, (F.col("block_no") + 1) * block)
    return cut.select("source", "block_no", "doc_id", (lo - F.col("at")).alias("start_token"), (hi - lo).alias("n_tokens"))


def slots_of_shards(plan: DataFrame, blocks: dict[str, int], keys: dict[str, int], seed: int) -> DataFrame:
    """shard, slot, source, round, block_no of every slot; plan: group, first_shard, shards, drawn (source, count, first slot)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, first_shard, shards, of in zip(batch["group"], batch["first_shard"], batch["shards"], batch["drawn"]):
                begin = {x["source"]: x["first"] for x in of}
                for k, source, count, first, place in shard_counts({x["source"]: x["n"] for x in of}, shards, (seed, 1, group)):
                    for at in range(0, count, SLOTS_AT_ONCE):
                        i = np.arange(at, min(at + SLOTS_AT_ONCE, count))
                        j = begin[source] + first + i
                        n = np.full(len(j), blocks[source])
                        turn = j // n
                        yield pd.DataFrame({"shard": np.full(len(j), first_shard + k), "slot": place + i, "source": source, "round": turn, "block_no": permuted(j % n, n, round_key(keys[source], turn))})

    return plan.mapInPandas(work, "shard bigint, slot bigint, source string, round bigint, block_no bigint")


def mixed(sizes: DataFrame, targets: DataFrame, *, total_tokens: int | None = None, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """shard, slot, source, round, block_no, doc_id, start_token, n_tokens.

    sizes: doc_id, source, n_tokens; targets: source, target_share, max_repeats (few rows).
    """
    spark = sizes.sparkSession
    goal = {r["source"]: r for r in targets.where("source is not null").collect()}
    sizes = sizes.where(F.col("source").isin(*goal)) if goal else sizes.limit(0)
    held = sizes.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs")).collect()  # a row a source
    totals = {r["source"]: r["n"] for r in held if r["n"]}
    tokens = allocate(totals, {s: r["target_share"] or 0.0 for s, r in goal.items()}, {s: max(0, r["max_repeats"] or 0) for s, r in goal.items()}, total_tokens)
    n_blocks = {s: -(-n // block) for s, n in totals.items()}
    keys = {s: xxhash.xxh32_intdigest(f"{seed}/{s}") for s in totals}
    slots = {s: slots_for(n, totals[s], block, keys[s]) for s, n in tokens.items()}
    shards = max(1, -(-sum(slots.values()) // BLOCKS_PER_SHARD))
    groups = max(1, math.isqrt(shards))
    edges = [g * shards // groups for g in range(groups + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:])]
    of: dict[int, list] = {}
    for g, s, n, first, _ in shard_counts(slots, groups, (seed, 0), widths):
        of.setdefault(g, []).append((s, n, first))
    rows = [(g, edges[g], widths[g], x) for g, x in of.items()]
    plan = spark.createDataFrame(rows, "group bigint, first_shard bigint, shards bigint, drawn array<struct<source:string,n:bigint,first:bigint>>").repartitionById(groups, F.col("group").cast("int"))
    # a task a group: left to itself, Spark would fold so small a table into one task
    picked = slots_of_shards(plan, n_blocks, keys, seed)
    parts = blocks_of(sizes, block, max((r["docs"] for r in held), default=0))
    # by merge: a side below the broadcast threshold at one size is beyond any at another
    return picked.hint("merge").join(parts, ["source", "block_no"]).select("shard", "slot", "source", "round", "block_no", "doc_id", "start_token", "n_tokens")


def shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, n_tokens, actual_share, most_uses of one document's token range."""
    got = selection.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), (F.max("round") + 1).alias("most_uses"))
    out = targets.join(got, "source", "left")
    total = F.sum("n_tokens").over(Window.partitionBy(F.lit(0)))  # over a row a source
    return out.select("source", "target_share", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), (F.coalesce("n_tokens", F.lit(0)) / total).alias("actual_share"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats")


def _mix(spark, sf: str) -> tuple[DataFrame, DataFrame]:
    targets = spark.read.parquet(f"{sf}/mix_targets.parquet")
    return mixed(document_sizes(spark, sf), targets), targets


def p8_selection(spark, sf: str) -> DataFrame:
    return _mix(spark, sf)[0]


def p8_shares(spark, sf: str) -> DataFrame:
    """The shares actually reached."""
    return shares(*_mix(spark, sf))
