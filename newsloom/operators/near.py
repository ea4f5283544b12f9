"""Title pairs that share a rare token and can still reach a similarity, found where the token's titles meet.

A title becomes one posting for each of its rare tokens. The posting carries a card of the title: a 256-bit map of its
bigrams and a few sizes. Pairs are made in the task that holds a token, and a pair leaves it only if the cards don't
exclude it, so neither texts nor token arrays travel with pairs. The bounds are necessary conditions of
`similarity.can_reach`: they lose nothing. Every shared token gives the same answer for a pair, so common tokens can be
counted over the pairs that are left.

Which tokens are rare is known from counts; what reaches the driver of them is a Bloom filter of fixed size, whose false
positives are taken out again in the task, where all titles of a token are seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.udf import ratio, token_set_ratio

#: Kinds of tokens, the two low bits of a token.
WORD, CJK, GRAM = 0, 1, 2
#: Bits of the Bloom filter as a power of two: 8 MB whatever the corpus; and of one row that brings a part of it.
BLOOM_BITS, PART_BITS = 26, 19
#: Titles that a task counts at once, and pairs that it compares at once.
STRETCH, AT_ONCE = 50_000, 1_000_000
CARD = np.dtype([("map", "<u8", 4), ("grams", "<i4"), ("words", "<i4"), ("odd", "<i4"), ("length", "<i4"), ("compact", "<i4"), ("domain", "<i4"), ("url", "<i4")])
POSTING = "token bigint, side byte, ix bigint, card binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix of 64-bit values."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct_pairs(codes: np.ndarray) -> np.ndarray:
    """row << 42 | first << 21 | second of the distinct neighbours in each row; rows end with a newline. Sorted."""
    row = np.cumsum(codes == 10)
    ok = (codes[:-1] != 10) & (codes[1:] != 10)
    return np.unique((row[:-1][ok] << 42) | (codes[:-1][ok] << 21) | codes[1:][ok])


def read_titles(titles: list[str], kinds: tuple[int, ...] = (WORD, CJK, GRAM)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token) of the distinct tokens of normalised titles, and their cards (domain and url 0). At most 2**21 titles."""
    codes = np.frombuffer("".join(t + "\n" for t in titles).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    n = len(titles)
    low = np.int64((1 << 42) - 1)
    compact = codes[codes != 32]
    grams = _distinct_pairs(compact)
    cjk = _distinct_pairs(compact[(compact == 10) | ((compact >= 0x3400) & (compact <= 0x4DBF)) | ((compact >= 0x4E00) & (compact <= 0x9FFF))])
    gram_row, gram_hash = grams >> 42, _mixed((grams & low).astype(np.uint64))

    inside = (codes != 32) & (codes != 10)
    begins = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    ends = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
    lines = np.cumsum(codes == 10)
    word_row, long = lines[begins], ends - begins
    if len(begins):
        at = np.cumsum(inside) - 1
        flat = codes[inside].astype(np.uint64)
        first = at[begins]
        place = (np.arange(len(flat)) - np.repeat(first, long)).astype(np.uint64)
        word_hash = _mixed(np.add.reduceat(_mixed(flat | (place << np.uint64(21))), first))
    else:
        word_hash = np.zeros(0, np.uint64)
    word_row, word_hash, long = word_row[long >= 2], word_hash[long >= 2], long[long >= 2]
    by = np.lexsort((word_hash, word_row))
    word_row, word_hash, long = word_row[by], word_hash[by], long[by]
    new = np.r_[True, (word_row[1:] != word_row[:-1]) | (word_hash[1:] != word_hash[:-1])][: len(by)]
    word_row, word_hash, long = word_row[new], word_hash[new], long[new]

    cards = np.zeros(n, CARD)
    count = lambda rows: np.bincount(rows, minlength=n)
    cards["grams"], cards["words"], cards["odd"] = count(gram_row), count(word_row[long >= 3]), count(np.setdiff1d(cjk, grams, assume_unique=True) >> 42)
    cards["length"] = np.diff(np.r_[-1, np.flatnonzero(codes == 10)]) - 1
    cards["compact"] = np.diff(np.r_[-1, np.flatnonzero(compact == 10)]) - 1
    if len(grams):
        starts = np.flatnonzero(np.r_[True, gram_row[1:] != gram_row[:-1]])
        bit = gram_hash >> np.uint64(56)
        for lane in range(4):
            one = np.where(bit >> np.uint64(6) == lane, np.left_shift(np.uint64(1), bit & np.uint64(63)), np.uint64(0))
            cards["map"][gram_row[starts], lane] = np.bitwise_or.reduceat(one, starts)

    made = {WORD: (word_row, word_hash), CJK: (cjk >> 42, _mixed((cjk & low).astype(np.uint64))), GRAM: (gram_row, gram_hash)}
    row = np.concatenate([made[k][0] for k in kinds])
    token = np.concatenate([(made[k][1] << np.uint64(2)) | np.uint64(k) for k in kinds]).view(np.int64)
    return row, token, cards


def can_be(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """False only for cards of pairs that cannot reach least, exact pairs apart. A floor of 0.8 or below excludes nothing."""
    if least <= 0.8:
        return np.ones(len(a), bool)
    bits = lambda m: np.bitwise_count(m).sum(1, dtype=np.int64)
    ga, gb = a["grams"], b["grams"]
    common = bits(a["map"] & b["map"]) + np.minimum(ga - bits(a["map"]), gb - bits(b["map"]))
    common = np.minimum(common, np.minimum(ga, gb))
    # all tokens: bigrams, words of three letters or more, CJK bigrams that are none of the compact title
    size = ga + a["words"] + a["odd"] + gb + b["words"] + b["odd"]
    shared = np.minimum(common + np.minimum(a["words"], b["words"]) + a["odd"] + b["odd"], size // 2)
    jac = np.where(size > 0, shared / np.maximum(size - shared, 1), 0.0)
    held = (common >= np.minimum(ga, gb)) & (np.minimum(a["compact"], b["compact"]) >= 0.7 * np.maximum(a["compact"], b["compact"]) - 1e-9)
    url = np.where(held, 1.0, np.where((a["domain"] != 0) & (a["domain"] == b["domain"]), 0.4, 0.0))
    close = ga + gb - 2 * common <= 0.3 * (a["length"] + b["length"]) + 1e-9
    return (0.7 + 0.2 * jac + 0.1 * url >= least - 1e-9) | close | ((a["url"] != 0) & (a["url"] == b["url"]))


def _token_sets(title: str) -> tuple[str, set[str], set[str], set[str], set[str]]:
    """Compact title, words, bigrams, CJK bigrams and all tokens of a normalised title."""
    compact = title.replace(" ", "")
    words = {w for w in title.split(" ") if len(w) >= 2}
    grams = {compact[k : k + 2] for k in range(len(compact) - 1)}
    han = [c for c in compact if "\u3400" <= c <= "\u4dbf" or "\u4e00" <= c <= "\u9fff"]
    cjk = {x + y for x, y in zip(han, han[1:])}
    return compact, words, grams, cjk, words | grams | cjk


def _measure(ta: str, tb: str, seen: dict, url: bool, domain: bool, least: float, ratios: bool, counted: bool) -> tuple | None:
    """(hint, jac, url, words, a_compact_title, b_compact_title) of a pair that is exact or can reach least, else None; counted: it must share 2 words or 3 CJK bigrams."""
    for t in (ta, tb):
        if t not in seen:
            seen[t] = _token_sets(t)
    (ca, wa, ga, ha, ea), (cb, wb, gb, hb, eb) = seen[ta], seen[tb]
    if counted and len(wa & wb) < 2 and len(ha & hb) < 3:
        return None
    both = len(ea & eb)
    jac = both / (len(ea) + len(eb) - both) if ea and eb else 0.0
    if url or (ca and ca == cb):
        return 1.0, jac, 1.0, len(wa & wb), ca, cb
    held = ca and cb and (ca in cb or cb in ca) and min(len(ca), len(cb)) / max(len(ca), len(cb)) >= 0.7
    hint = 1.0 if held else 0.4 if domain else 0.0
    if least > 0.8:
        reach = 0.2 * jac + 0.1 * hint
        if 0.7 + reach < least - 1e-9 and len(ga) + len(gb) - 2 * len(ga & gb) > 0.3 * (len(ta) + len(tb)) + 1e-9:
            return None
        if ratios:  # the partial ratio costs most; what it could reach at best with the others
            direct = max(ratio(ta, tb), ratio(ca, cb))
            if 0.6 + reach + 0.1 * direct < least - 1e-9 and direct < 0.9:
                return None
            whole = max(token_set_ratio(ta, tb), token_set_ratio(ca, cb))
            if 0.35 * whole + 0.25 + reach + 0.1 * direct < least - 1e-9 and (direct < 0.9 or whole < 0.95):
                return None
    return None, jac, hint, len(wa & wb), ca, cb


def measured(both: DataFrame, least: float, ratios: bool, counted: bool = False) -> DataFrame:
    """i, j, hint, jac, url, words and both titles of the pairs that are exact or can reach least: those of similarity.measured
    and can_reach, less those that the direct and token set ratios already exclude (ratios: the fuzzy backend has them).
    counted: only pairs that share 2 words or 3 CJK bigrams.

    both: i, j and of either side a_, b_ norm_title, url and domain (64-bit hashes, 0 if there is none).
    """

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            same = {c: ((d[f"a_{c}"] != 0) & (d[f"a_{c}"] == d[f"b_{c}"])).tolist() for c in ("url", "domain")}
            seen: dict[str, tuple] = {}
            rows = []
            for i, j, ta, tb, u, o in zip(d["i"].tolist(), d["j"].tolist(), d["a_norm_title"], d["b_norm_title"], same["url"], same["domain"]):
                found = _measure(ta, tb, seen, u, o, least, ratios, counted)
                if found:
                    rows.append((i, j, *found[:4], ta, tb, *found[4:]))
            yield pd.DataFrame(rows, columns=["i", "j", "hint", "jac", "url", "words", "a_norm_title", "b_norm_title", "a_compact_title", "b_compact_title"])

    return both.mapInPandas(measure, "i bigint, j bigint, hint double, jac double, url double, words int, a_norm_title string, b_norm_title string, a_compact_title string, b_compact_title string")


def named(column: str) -> Column:
    """A text as 64 bits, 0 for none."""
    return F.when(F.coalesce(column, F.lit("")) == "", F.lit(0).cast("bigint")).otherwise(F.xxhash64(column))


def titles(features: DataFrame, side: int, links: bool = False) -> DataFrame:
    """What postings are made of. A row without a number keeps its place before all others and is joined to nothing."""
    own = lambda c: (named(c).bitwiseAND(F.lit(0x7FFFFFFF)) if links else F.lit(0)).cast("int")
    return features.select(F.coalesce("article_ix", F.lit(-1)).cast("bigint").alias("ix"), "norm_title", own("domain").alias("domain"), own("norm_url").alias("url"), F.lit(side).cast("byte").alias("side"))


def rare_tokens(df: DataFrame, kinds: tuple[int, ...], least: int, most: dict[int, int]) -> DataFrame:
    """Tokens that least to most[kind] titles of df have."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        rows = 0

        def sums() -> pd.DataFrame:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"token": token, "n": n})

        for batch in batches:
            held.append(read_titles(batch["norm_title"].tolist(), kinds)[1])
            rows += len(batch)
            if rows >= STRETCH:
                yield sums()
                held, rows = [], 0
        if held:
            yield sums()

    counts = df.select("norm_title").mapInPandas(counted, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    cap = reduce(lambda c, k: c.when(F.col("token").bitwiseAND(F.lit(3)) == k, most[k]), kinds, F.when(F.lit(False), 0))
    return counts.where((F.col("n") >= least) & (F.col("n") <= cap)).select("token")


def bloom(tokens: DataFrame, mixed: bool = True) -> np.ndarray:
    """Bit map of the tokens, two bits each: 2**(BLOOM_BITS - 3) bytes, whatever their number. Not mixed: they are plain numbers."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.unique(np.concatenate(_places(batch["token"].to_numpy(np.int64) if mixed else marks(batch["token"].to_numpy(np.int64)))))
            yield pd.DataFrame({"part": (at >> PART_BITS).astype(np.int32), "at": (at & ((1 << PART_BITS) - 1)).astype(np.int32)})

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << PART_BITS, np.uint8)
        bits[part["at"].to_numpy()] = 1
        return pd.DataFrame({"part": part["part"].iloc[:1], "body": [np.packbits(bits, bitorder="little").tobytes()]})

    out = np.zeros((1 << (BLOOM_BITS - PART_BITS), 1 << (PART_BITS - 3)), np.uint8)
    for r in tokens.mapInPandas(places, "part int, at int").groupBy("part").applyInPandas(packed, "part int, body binary").collect():
        out[r["part"]] = np.frombuffer(r["body"], np.uint8)
    return out.ravel()


def marks(ix: np.ndarray) -> np.ndarray:
    """Numbers as well-mixed values for a filter."""
    return _mixed(ix.astype(np.int64).view(np.uint64)).view(np.int64)


def _places(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t, mask = token.view(np.uint64), np.uint64((1 << BLOOM_BITS) - 1)
    return ((t >> np.uint64(2)) & mask).astype(np.int64), ((t >> np.uint64(34)) & mask).astype(np.int64)


def held(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the filter may hold values."""
    return reduce(np.logical_and, [(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1 for at in _places(values)])


def may_hold(bits: np.ndarray):
    """Function of a column of tokens: whether the filter may hold them."""

    @F.pandas_udf("boolean")
    def found(tokens: pd.Series) -> pd.Series:
        return pd.Series(held(bits, tokens.to_numpy(np.int64)))

    return found


def postings(df: DataFrame, rare: np.ndarray, kinds: tuple[int, ...], only: np.ndarray | None = None) -> DataFrame:
    """token, side, ix, card of each title of df (see titles) and token in the filter. only: a filter of the titles of side 1; cards are left out."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if only is not None:
                batch = batch[(batch["side"].to_numpy() == 0) | held(only, marks(batch["ix"].to_numpy()))]
            row, token, cards = read_titles(batch["norm_title"].tolist(), kinds)
            ok = held(rare, token)
            row, token = row[ok], token[ok]
            cards["domain"], cards["url"] = batch["domain"].to_numpy(), batch["url"].to_numpy()
            body = np.array([b"" if only is not None else c.tobytes() for c in cards] + [b""], dtype=object)[:-1]
            yield pd.DataFrame({"token": token, "side": batch["side"].to_numpy()[row], "ix": batch["ix"].to_numpy()[row], "card": body[row]})

    return df.mapInPandas(emit, POSTING)


def pairs(posted: DataFrame, least: float, most: dict[int, int], cross: bool) -> DataFrame:
    """i, j, kind of each rare token that two titles share and whose cards can reach least.

    cross: i of side 1 and j of side 0, tokens that most[kind] titles of side 0 have at the most. Else i < j, and all titles
    of the token count. least 0: no cards are read. A token's titles are streamed: of side 0 no more than the bound is held, of side 1 nothing.
    """
    caps = np.array([most.get(k, 0) for k in range(4)])

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if not len(batch):
                continue
            d = pd.concat([rest, batch], ignore_index=True) if rest is not None else batch
            last = d["token"].to_numpy() == d["token"].iloc[-1]
            held = d[last & (d["side"].to_numpy() == 0)] if cross else d[last]
            rest = held.iloc[: caps.max() + 1]  # more than the bound are as good as one more
            yield from compared(d if cross else d[~last])
        if rest is not None and not cross:
            yield from compared(rest)

    def compared(d: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(d):
            return
        token, side, ix = d["token"].to_numpy(), d["side"].to_numpy(), d["ix"].to_numpy()
        start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        size = np.diff(np.r_[start, len(token)])
        group = np.repeat(np.arange(len(start)), size)
        kind = (token & 3).astype(np.int8)
        if cross:  # side 0 comes first; rows of side 1 meet all of them
            held = np.add.reduceat((side == 0).astype(np.int64), start)[group]
            lo, n = start[group], np.where((side == 1) & (held <= caps[kind]), held, 0)
        else:
            full = size[group]
            lo = np.arange(len(token)) + 1
            n = np.where(full <= caps[kind], (start + size)[group] - lo, 0)
        rows = np.flatnonzero(n)
        if not len(rows):
            return
        cards = np.frombuffer(b"".join(d["card"]), CARD) if least > 0 else None
        total = np.cumsum(n[rows])
        k = 0
        while k < len(rows):
            e = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + AT_ONCE, side="right")))
            r, m = rows[k:e], n[rows[k:e]]
            x = np.repeat(r, m)
            y = np.repeat(lo[r], m) + np.arange(len(x)) - np.repeat(np.cumsum(m) - m, m)
            if cards is not None:
                ok = can_be(cards[x], cards[y], least)
                x, y = x[ok], y[ok]
            i, j = (ix[x], ix[y]) if cross else (np.minimum(ix[x], ix[y]), np.maximum(ix[x], ix[y]))
            if not cross:
                x, i, j = x[i < j], i[i < j], j[i < j]
            if len(i):
                yield pd.DataFrame({"i": i, "j": j, "kind": kind[x]})
            k = e

    return posted.repartition("token").sortWithinPartitions("token", "side").mapInPandas(meet, "i bigint, j bigint, kind byte")
