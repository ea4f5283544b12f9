"""Titles as word sets, and the parts that set-similarity joins share: words, a rare-first order, prefixes and blocks.

A title's words are its unbroken runs of letters or digits as they read to the eye, letter case ignored, accents kept,
each Han character a word of its own. Words are compared by 64-bit hashes, equal sets meet by a 128-bit key.

Exactness. Two sets x, y of Jaccard similarity >= t share at least a = ceil(t/(1+t) * (|x|+|y|)) words. In any common
order of all words they then share one among the first |x| - ceil(t*|x|) + 1 words of x and the like of y, so blocks of
sets with equal prefix words lose no pair. The order is rare words first. It needs the
counts of all words, which stand in a table; what travels is a sketch of them of fixed size (see Order).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import lookalike
from newsloom.session import shuffles_removed, written

#: Cells of the sketch of word counts, as a power of two: 4 MB whatever the corpus; more cells tell more words apart.
SKETCH_BITS = 22
#: A prefix word of more sets than this is split into a grid of cells.
CELL_SETS = 20_000
#: Words that a task counts at once.
COUNTED = 4_000_000
_HAN = re.compile("([⺀-⿟々-〇㐀-䶿一-鿿豈-﫿\U00020000-\U0003fffd])")
_RUN = re.compile(r"[^\W_]+")


class _Expander(dict):
    def __missing__(self, cp: int) -> str:
        self[cp] = lookalike.expansion(chr(cp))
        return self[cp]


_expand = _Expander()
_listed = {ord(o): x for o, x in lookalike.listed_shapes().items()}


def title_words(title: str, shapes: dict[int, str] = _listed) -> list[str]:
    """Distinct words, sorted. A word of another script is lowered before its look-alike letters are read as Latin."""
    if title.isascii():
        return sorted(set(_RUN.findall(title.lower())))
    text = unicodedata.normalize("NFD", title.translate(_expand))
    out = set()
    for word in _RUN.findall(_HAN.sub(r" \1 ", unicodedata.normalize("NFC", text))):
        if not word.isascii():
            read = unicodedata.normalize("NFC", unicodedata.normalize("NFD", word).translate(shapes))
            if not (read.isascii() or any("a" <= c.lower() <= "z" for c in word)):
                read = unicodedata.normalize("NFC", unicodedata.normalize("NFD", word.casefold()).translate(shapes))
            word = read
        out.add(word.casefold())
    return sorted(out)


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


def need(t: float, sizes: np.ndarray) -> np.ndarray:
    """Least overlap of two sets whose sizes sum to this."""
    return np.ceil(t / (1 + t) * sizes - 1e-9).astype(np.int64)


SET_SCHEMA = "id bigint, set_key binary, words binary, batch int"


def set_hasher(shapes: dict[str, str]):
    """shapes: as lookalike.public_shapes gives them. Function of a frame (id, batch, title) that gives id, set_key, words (sorted 64-bit hashes), batch; rows without a word are left out."""
    seen: dict[str, int] = {}
    table = {ord(o): x for o, x in shapes.items()}

    def hashed(batch: pd.DataFrame) -> pd.DataFrame:
        if len(seen) > 500_000:
            seen.clear()
        ids, numbers, keys, packed = [], [], [], []
        for i, n, title_ in zip(batch["id"], batch["batch"], batch["title"]):
            if title_ is None:
                continue
            hashes = []
            for w in title_words(title_, table):
                h = seen.get(w)
                if h is None:
                    h = seen[w] = xxhash.xxh3_64_intdigest(w) >> 1
                hashes.append(h)
            if hashes:
                p = np.unique(np.array(hashes, np.int64)).tobytes()
                ids.append(i)
                numbers.append(n)
                packed.append(p)
                keys.append(xxhash.xxh3_128_digest(p))
        return pd.DataFrame({"id": np.array(ids, np.int64), "set_key": pd.Series(keys, dtype=object), "words": pd.Series(packed, dtype=object), "batch": np.array(numbers, np.int32)})

    return hashed


def with_word_sets(df: DataFrame, id_column: str, title: str) -> DataFrame:
    """id, set_key binary(16), words binary (sorted 64-bit hashes), batch 0; rows without a word are left out, they resemble none."""

    shapes = lookalike.public_shapes(df.sparkSession)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(set_hasher(shapes), batches)

    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(title).alias("title"), F.lit(0).alias("batch"))
    return rows.mapInPandas(hashed, SET_SCHEMA)


@dataclass(frozen=True)
class Order:
    """Rare-first order of all words: by the count class of the word's cell in a count sketch, then by a hash.

    A sketch cell never holds less than its word's count, and any common order is right, so collisions cost time only. The
    sketch has a fixed number of cells of one byte, whatever the corpus.
    """

    cells: np.ndarray  # uint8, a power of two of them

    def rank(self, words: np.ndarray) -> np.ndarray:
        return self.cells[words & (len(self.cells) - 1)]


def word_counts(rows: DataFrame) -> DataFrame:
    """word, n of every word over the sets of rows (set_key, words); a table in the shared folder, of which nothing goes to the driver.

    Copies of a set count once in a stretch of some COUNTED words of a task, so that a title of very many rows doesn't make
    its words look like words of very many sets.
    """

    def postings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def counted() -> pd.DataFrame:
            stretch = pd.concat(held) if held else pd.DataFrame({"set_key": [], "words": []})
            keys = np.frombuffer(b"".join(stretch["set_key"]), np.int64)[::2]
            _, one = np.unique(keys, return_index=True)
            w, n = np.unique(np.frombuffer(b"".join(stretch["words"].to_numpy()[one]), np.int64), return_counts=True)
            return pd.DataFrame({"word": w, "n": n})

        for batch in batches:
            held.append(batch)
            size += sum(map(len, batch["words"])) // 8
            if size > COUNTED:
                yield counted()
                held, size = [], 0
        yield counted()

    counts = rows.select("set_key", "words").mapInPandas(postings, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counts, "word-counts")


def word_order(counts: DataFrame, bits: int = SKETCH_BITS) -> Order:
    """The sketch of word counts, a class of a quarter octave a cell: 2**bits bytes come to the driver whatever the corpus."""
    side = min(bits, 16)
    cell = F.col("word").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    kinds = counts.groupBy(cell.alias("cell")).agg(F.least(F.ceil(4 * F.log2(F.sum("n"))), F.lit(255)).cast("int").alias("kind")).where("kind > 0")

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        body = np.zeros(1 << side, np.uint8)
        body[part["cell"].to_numpy() & ((1 << side) - 1)] = part["kind"].to_numpy()
        return pd.DataFrame({"part": part["part"].iloc[:1], "body": [body.tobytes()]})

    cells = np.zeros(1 << bits, np.uint8)
    with shuffles_removed(counts.sparkSession):
        parts = kinds.withColumn("part", F.shiftright("cell", side)).groupBy("part").applyInPandas(packed, "part int, body binary").collect()  # 2**(bits - side) rows
    for r in parts:
        cells[r["part"] << side : (r["part"] + 1) << side] = np.frombuffer(r["body"], np.uint8)
    return Order(cells)


def flat(packed: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words, the row of each word, the words a row."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 8
    return np.frombuffer(b"".join(packed), np.int64), np.repeat(np.arange(len(packed)), sizes), sizes


def ordered(packed: pd.Series, order: Order) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As flat, with every row's words in the order, and each word's position."""
    words, row, sizes = flat(packed)
    # ties by another hash of the word: the least hashes of all sets would crowd into the first files of a run
    by = np.lexsort((words * np.int64(0x5851F42D4C957F2D), order.rank(words), row))
    starts = np.cumsum(sizes) - sizes
    return words[by], row, sizes, np.arange(len(words)) - np.repeat(starts, sizes)


BLOCK_SCHEMA = "block bigint, tree int, size int, words binary"


def set_key(words: bytes) -> bytes:
    """The key of a set from its words in any order: blocks needn't carry it."""
    return xxhash.xxh3_128_digest(np.sort(np.frombuffer(words, np.int64)).tobytes())


def prefix_length(threshold: float, sizes: np.ndarray) -> np.ndarray:
    """How many words of a set's order reach every similar set."""
    return sizes - np.ceil(threshold * sizes - 1e-9).astype(np.int64) + 1


def prefix_blocks(sets: DataFrame, order: Order, threshold: float, extra: str = "", closed: bool = False) -> DataFrame:
    """One row per set and prefix word: block (the word), tree (its position in the order), size, words in order.

    extra names a column that is carried along. closed: no other sets than those counted in order will be met, so a word that
    was counted once (its cell is 0, which no collision makes smaller) makes no block, as no other set has it.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            words, row, sizes, pos = ordered(batch["words"], order)
            ends = np.cumsum(sizes)
            data = words.tobytes()
            sorted_words = np.array([data[8 * (e - s) : 8 * e] for s, e in zip(sizes.tolist(), ends.tolist())] + [b""], dtype=object)[:-1]
            met = pos < prefix_length(threshold, sizes)[row]
            keep = np.flatnonzero(met & (order.rank(words) > 0) if closed else met)
            r = row[keep]
            out = {"block": words[keep], "tree": pos[keep].astype(np.int32), "size": sizes[r].astype(np.int32), "words": sorted_words[r]}
            if extra:
                out[extra] = batch[extra].to_numpy()[r]
            yield pd.DataFrame(out)

    kind = f", {extra} {dict(sets.dtypes)[extra]}" if extra else ""
    return sets.select("words", *([extra] if extra else [])).mapInPandas(emit, BLOCK_SCHEMA + kind)


def in_cells(blocks: DataFrame, counts: DataFrame, cell_sets: int = CELL_SETS) -> DataFrame:
    """blocks with a column side, the blocks of words in more than cell_sets sets split, wherever such a word stands in the order.

    The sets of such a word fall into g groups, and cell (i, j) holds groups i and j, so that each pair of sets meets in
    just one cell; side tells the two groups of a mixed cell apart (0: all pairs of the cell count). The words to split are
    a table that is joined: Spark broadcasts it or not by its size.
    """
    hot = counts.where(F.col("n") > cell_sets).select(F.col("word").alias("block"), F.ceil(F.col("n") / cell_sets).cast("int").alias("groups"))
    rows = blocks.join(hot, "block", "left").withColumn("own", F.coalesce(F.pmod(F.xxhash64("words"), F.col("groups")), F.lit(0)).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.coalesce("groups", F.lit(1)) - 1)).alias("other"))
    cell = F.when(F.col("groups").isNull(), F.col("block")).otherwise(F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other")))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return rows.select(cell.alias("block"), side.alias("side"), "tree", "size", "words")


def whole_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Re-cuts a partition that is sorted by block so that no block is cut in two."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        block = batch["block"].to_numpy()
        last = np.searchsorted(block, block[-1]) if block[0] <= block[-1] else len(block)
        if rest and (last > 0):
            yield pd.concat([*rest, batch.iloc[:last]], ignore_index=True)
            rest = [batch.iloc[last:]]
        elif last > 0:
            yield batch.iloc[:last]
            rest = [batch.iloc[last:]]
        else:
            rest.append(batch)
    if rest:
        yield pd.concat(rest, ignore_index=True)


def position_bound(t: float, sa, sb, pa, pb) -> np.ndarray:
    """Whether sets whose first common word stands at pa and pb can still share enough words."""
    return np.minimum(sa - pa, sb - pb) >= need(t, sa + sb)


def bitmaps(packed: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit token bitmap of each set as two uint64, and how many of its words share a bit with another."""
    words, _, sizes = flat(packed)
    bit = (words & 127).astype(np.uint64)
    one = np.left_shift(np.uint64(1), bit & np.uint64(63))
    starts = np.cumsum(sizes) - sizes
    lo = np.bitwise_or.reduceat(np.where(bit < 64, one, np.uint64(0)), starts)
    hi = np.bitwise_or.reduceat(np.where(bit >= 64, one, np.uint64(0)), starts)
    return lo, hi, sizes - np.bitwise_count(lo).astype(np.int64) - np.bitwise_count(hi).astype(np.int64)


def may_share(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The most words that sets i of a and j of b can share by their bitmaps."""
    (alo, ahi, aex), (blo, bhi, bex) = a, b
    return np.bitwise_count(alo[i] & blo[j]).astype(np.int64) + np.bitwise_count(ahi[i] & bhi[j]) + np.minimum(aex[i], bex[j])


def overlaps(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, before: np.ndarray | None = None, words_at_once: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Exact number of common words of sets a[i] and b[j], and whether one stands among the first before[k] of a[i]."""
    common, early = np.zeros(len(i), np.int64), np.zeros(len(i), bool)
    if not len(i):
        return common, early
    ui, i = np.unique(i, return_inverse=True)
    uj, j = np.unique(j, return_inverse=True)
    wa, _, na = flat(a[ui])
    wb, rb, nb = flat(b[uj])
    letters, wb = np.unique(wb, return_inverse=True)
    at = np.minimum(np.searchsorted(letters, wa), len(letters) - 1)
    wa = np.where(letters[at] == wa, at, -1)
    keys = np.sort(rb * np.int64(len(letters)) + wb)
    starts = np.cumsum(na) - na
    ends = np.cumsum(na[i])
    lo = 0
    while lo < len(i):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + words_at_once, side="right")))
        n = na[i[lo:hi]]
        own = np.repeat(np.arange(lo, hi), n)
        first = np.cumsum(n) - n
        place = np.arange(len(own)) - np.repeat(first, n)
        word = wa[starts[i[own]] + place]
        key = j[own] * np.int64(len(letters)) + word
        found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = (word >= 0) & (keys[found] == key)
        common[lo:hi] = np.add.reduceat(hit, first)
        if before is not None:
            early[lo:hi] = np.logical_or.reduceat(hit & (place < before[own]), first)
        lo = hi
    return common, early


def confirm(words: np.ndarray, i: np.ndarray, j: np.ndarray, size: np.ndarray, pi: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Exact check of row pairs, and their common words; a pair counts only in the block of its first common word."""
    both, early = overlaps(words, words, i, j, pi)
    return (both >= t * (size[i] + size[j] - both) - 1e-9) & ~early, both
