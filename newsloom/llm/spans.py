"""Long exact spans shared between documents, by FM-indexes over the passages that documents have in common.

Routing. Every window of SPAN code points belongs to one anchor: its least hashed GRAM-gram (leftmost on ties), so equal
windows of different documents have equal anchors. Documents announce their anchors by hash; an anchor that one document
alone holds needs no further look. A document whose anchor is shared sends the passage of the anchor's windows to the
anchor's shard. No window can be lost: what two documents share in SPAN code points, their shared windows' anchors carry.

Index. A shard concatenates its passages, sorts their suffixes (by more than SPAN code points, by doubling or tripling) and keeps the
Burrows-Wheeler transform as a wavelet matrix of packed bit vectors with rank counts. Passages are then streamed over it
by backward search: a window is read from its end leftwards while another document's suffix stays in the interval; where
none stays at some offset, no window over that stretch can match, and the search goes on with the first window after it.
From a passage's first matching window on, the intervals of its windows follow by suffix links (a window's own rank and
the stretch of ranks that agree in SPAN code points): a backward search for each window anew would read every code point
SPAN times. Documents in one interval share the window. Beside the wavelet matrix a shard keeps its suffix order in arrays
of 32 bits a code point; they live as long as the shard is searched and are never written.

Defined results: null texts and texts under SPAN code points share nothing; nothing is normalised; equal texts share all
and are folded to one before the search, their pairs come back by a join; repeats inside one document alone don't count;
an empty table gives an empty result; texts of any length are read whole.

Scale: the shuffles carry anchors (16 bytes each, about 2 per 100 code points), the texts of documents with a shared anchor and
their shared passages. An anchor that more than CELL documents hold is split into a grid of cells. Only the output itself
can grow faster than the input, where many documents share one passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.graph import connected_components
from newsloom.session import written

SPAN, GRAM = 200, 100
#: Documents of one anchor per cell, code points of one index, code points hashed at once.
CELL, SHARD, AT_ONCE = 2_000, 1_000_000, 1 << 20
_B = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """Hash of points[i : i + gram] for every i."""
    n = len(points)
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        one = np.uint64(1)
        _powers.clear()
        _powers[size] = (np.cumprod(np.r_[one, np.full(size - 1, _B)]), np.cumprod(np.r_[one, np.full(size - 1, _INV)]))
    up, down = _powers[size]
    sums = np.r_[np.uint64(0), np.cumsum(_mix(points.astype(np.uint64) + np.uint64(1)) * up[:n])]
    return _mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, m = len(values), -(-len(values) // width) * width
    padded = np.full(m, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[str], span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, anchor hash, first window start, last window start) of every anchor; texts of fewer than span points have none."""
    pts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    parts = [(k, a) for k, p in enumerate(pts) for a in range(0, max(1, len(p) - span + 1), AT_ONCE) if len(p) >= span]
    out: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(parts):
        pieces, owner, offset, total = [], [], [], 0
        while at < len(parts) and (not pieces or total < AT_ONCE):
            k, a = parts[at]
            piece = pts[k][a : a + AT_ONCE + span - 1]
            pieces.append(piece), owner.append(k), offset.append(a)
            total += len(piece)
            at += 1
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(sizes) - sizes
        hashes = gram_hashes(np.concatenate(pieces), gram)
        where = np.arange(len(hashes), dtype=np.uint64)
        least = sliding_min((hashes & np.uint64(0xFFFFFFFFFF000000)) | where, span - gram + 1)
        least = (least & np.uint64(0xFFFFFF)).astype(np.int64)  # the anchor of each window start
        piece_of = np.repeat(np.arange(len(pieces)), sizes)[: len(least)]
        inside = np.arange(len(least)) - starts[piece_of] + span <= sizes[piece_of]
        window = np.flatnonzero(inside)
        anchor, piece_of = least[window], piece_of[window]
        cut = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (piece_of[1:] != piece_of[:-1])]) if len(window) else np.zeros(0, np.int64)
        end = np.r_[cut[1:], len(window)] - 1
        shift = np.array(offset)[piece_of[cut]] - starts[piece_of[cut]]
        out.append((np.array(owner)[piece_of[cut]], hashes[anchor[cut]].view(np.int64), window[cut] + shift, window[end] + shift))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


class BitVector:
    """Packed bits with rank counts per 64."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Sequence of small numbers with rank of any symbol at any place."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        order = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = ((order >> level) & 1).astype(np.uint8)
            self.levels.append((BitVector(bit), int(len(bit) - bit.sum())))
            order = np.concatenate([order[bit == 0], order[bit == 1]])
        self.start = np.zeros(1 << self.bits, np.int64)
        first = np.flatnonzero(np.r_[True, order[1:] != order[:-1]]) if len(order) else np.zeros(0, np.int64)
        self.start[order[first]] = first

    def ranks(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[q] among the first i[q] places."""
        for depth, (bits, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - depth)) & 1).astype(bool)
            r = bits.rank(i)
            i = np.where(one, zeros + r, i - r)
        return i - self.start[symbol]


class FMIndex:
    """Passages of documents, suffixes sorted by at least span symbols."""

    def __init__(self, texts: list[str], docs: np.ndarray, span: int = SPAN):
        self.span, self.docs = span, docs
        # arrays over the symbols have 32 bits: a shard is some SHARD code points and one block, itself bounded by CELL passages
        _, self.code = np.unique(docs, return_inverse=True)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.length = np.fromiter(map(len, texts), np.int64, len(texts))
        self.base = np.cumsum(self.length) - self.length + np.arange(1, len(texts) + 1)
        n = len(points) + len(texts) + 1
        ends = np.r_[0, self.base + self.length]
        raw = np.zeros(n, np.uint32)  # 0 stands between passages, a code point is itself + 1
        raw[np.repeat(self.base - np.cumsum(self.length) + self.length, self.length) + np.arange(len(points))] = points + 1
        letters, symbols = np.unique(raw, return_inverse=True)
        self.symbols = symbols.astype(np.int32)
        owner = np.repeat(np.r_[self.code, -1].astype(np.int32), np.diff(np.r_[ends, n]))
        self._sort(len(letters))
        self.doc = owner[self.sa]
        change = np.flatnonzero(self.doc[1:] != self.doc[:-1]) + 1
        self.next_other = np.r_[change, n][np.searchsorted(change, np.arange(n), side="right")].astype(np.int32)  # first rank of another document
        self.bwt = WaveletMatrix(self.symbols[self.sa - 1], len(letters))
        self.before = np.r_[0, np.cumsum(np.bincount(self.symbols, minlength=len(letters)))]

    def _sort(self, sigma: int) -> None:
        n, s = len(self.symbols), self.symbols.astype(np.int64)
        width = max(1, int(sigma - 1).bit_length())
        k = max(1, min(62 // width, self.span))
        key = np.zeros(n, np.int64)
        for j in range(k):
            key = (key << width) | np.r_[s[j:], np.zeros(min(j, n), np.int64)][:n]
        agree = None
        while True:
            self.sa = np.argsort(key).astype(np.int32)  # suffixes that agree in so many symbols may stand in any order
            step = key[self.sa]
            rank = np.empty(n, np.int64)
            rank[self.sa] = np.cumsum(np.r_[0, step[1:] != step[:-1]])
            if k <= self.span and 2 * k >= self.span:
                agree = (rank, self.span - k)  # equal span symbols: equal k symbols here and k symbols further on
            if k >= self.span:
                break
            # three ranks to a key where they fit, two for the step after which equality in span symbols can be read off
            times, wide = (3, b) if 3 * k <= self.span and 3 * (b := int(n + 1).bit_length()) <= 63 else (2, int(n + 1).bit_length())
            key = rank
            for j in range(1, times):
                key = (key << wide) | np.r_[rank[j * k :] + 1, np.zeros(min(j * k, n), np.int64)][:n]
            k *= times
        self.rank_of = np.empty(n, np.int32)
        self.rank_of[self.sa] = np.arange(n)
        r, off = agree
        here, there = r[self.sa], r[np.minimum(self.sa + off, n - 1)]
        self.stretch = np.cumsum(np.r_[0, (here[1:] != here[:-1]) | (there[1:] != there[:-1])]).astype(np.int32)  # of each rank
        # a search begins with the interval of the grams that the sort has told apart anyway: place -> gram -> first rank
        self.skip, self.gram = off, r.astype(np.int32)
        self.gram_from = np.r_[0, np.flatnonzero(here[1:] != here[:-1]) + 1, n]

    def first_matches(self, chunk: int = 20_000) -> np.ndarray:
        """Per passage the first window that another document holds, -1 if none: backward search with skips, from a gram at the window's end."""
        out = np.full(len(self.base), -1, np.int64)
        for lo in range(0, len(self.base), chunk):
            self._search(np.arange(lo, min(lo + chunk, len(self.base))), out)
        return out

    def _search(self, q: np.ndarray, out: np.ndarray) -> None:
        n = len(self.symbols)
        start = np.zeros(len(q), np.int64)
        offset = np.full(len(q), self.skip, np.int64)
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), n, np.int64)
        last = self.length[q] - self.span
        fit = last >= 0
        q, start, offset, lo, hi, last = (x[fit] for x in (q, start, offset, lo, hi, last))
        while len(q):
            place = self.base[q] + start + offset
            new = offset == self.skip
            begun, on = np.flatnonzero(new), np.flatnonzero(~new)
            g = self.gram[place[begun]]
            lo[begun], hi[begun] = self.gram_from[g], self.gram_from[g + 1]
            c = self.symbols[place[on]]
            lo[on], hi[on] = self.bwt.ranks(np.r_[c, c], np.r_[lo[on], hi[on]]).reshape(2, -1) + self.before[c]
            own = self.code[q]
            at = np.minimum(lo, n - 1)
            other = (lo < hi) & ((self.doc[at] != own) | (self.next_other[at] < hi))
            done = other & (offset == 0)
            out[q[done]] = start[done]
            start = np.where(other, start, start + offset + 1)
            lo, hi = np.where(other, lo, 0), np.where(other, hi, n)
            offset = np.where(other, offset - 1, self.skip)
            go = ~done & (start <= last)
            if not go.all():
                q, start, offset, lo, hi, last = (x[go] for x in (q, start, offset, lo, hi, last))

    def shared_windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, window start, interval) of all windows that two documents hold at least."""
        first = self.first_matches()
        q = np.flatnonzero(first >= 0)
        count = self.length[q] - self.span - first[q] + 1
        passage = np.repeat(q, count)
        start = np.arange(len(passage)) - np.repeat(np.cumsum(count) - count - first[q], count)
        interval = self.stretch[self.rank_of[self.base[passage] + start]]
        by = np.lexsort((self.docs[passage], interval))
        passage, start, interval = passage[by], start[by], interval[by]
        d = self.docs[passage]
        lead = np.flatnonzero(np.r_[True, interval[1:] != interval[:-1]]) if len(interval) else np.zeros(0, np.int64)
        tail = np.r_[lead[1:], len(interval)]
        several = np.repeat(d[lead] != d[tail - 1], tail - lead) if len(lead) else np.zeros(0, bool)
        return passage[several], start[several], interval[several]


def _pairs(index: FMIndex, side: np.ndarray, group: np.ndarray) -> pd.DataFrame:
    """doc_a < doc_b of the documents that meet in an interval; equal sets of documents are written out once."""
    passage, _, interval = index.shared_windows()
    rows = pd.DataFrame({"i": interval, "d": index.docs[passage], "s": side[passage], "g": group[passage]}).drop_duplicates()
    if not len(rows):
        return pd.DataFrame({"doc_a": np.zeros(0, np.int64), "doc_b": np.zeros(0, np.int64)})
    rows = rows.sort_values(["i", "g", "d", "s"], ignore_index=True)
    mark = _mix(rows["d"].to_numpy(np.int64).view(np.uint64) * np.uint64(4) + rows["s"].to_numpy(np.uint64))
    cut = np.flatnonzero(np.r_[True, (rows["i"].to_numpy()[1:] != rows["i"].to_numpy()[:-1]) | (rows["g"].to_numpy()[1:] != rows["g"].to_numpy()[:-1])])
    ends = np.r_[cut[1:], len(rows)]
    sign = np.add.reduceat(mark, cut)
    _, one = np.unique(np.stack([sign, (ends - cut).astype(np.uint64)]), axis=1, return_index=True)
    found = []
    d, s = rows["d"].to_numpy(), rows["s"].to_numpy()
    for a, b in zip(cut[one].tolist(), ends[one].tolist()):
        i, j = np.triu_indices(b - a, 1)
        ok = (d[a + i] != d[a + j]) & ((s[a + i] == 0) | (s[a + i] != s[a + j]))
        found.append(np.stack([d[a + i][ok], d[a + j][ok]]))
    x = np.concatenate(found, axis=1)
    x = np.unique(np.sort(x, axis=0), axis=1)
    return pd.DataFrame({"doc_a": x[0], "doc_b": x[1]})


def _windows(index: FMIndex, starts: list, side: np.ndarray, group: np.ndarray) -> pd.DataFrame:
    """doc_id, lo, hi: stretches of document positions that shared windows cover; a passage may stand at several places."""
    passage, start, _ = index.shared_windows()
    by = np.lexsort((start, passage))
    passage, start = passage[by], start[by]
    cut = np.flatnonzero(np.r_[True, (passage[1:] != passage[:-1]) | (start[1:] != start[:-1] + 1)]) if len(passage) else np.zeros(0, np.int64)
    end = np.r_[cut[1:], len(passage)] - 1
    places = [np.asarray(starts[p]) for p in passage[cut]]
    n = np.fromiter(map(len, places), np.int64, len(places))
    at = np.concatenate(places) if len(places) else np.zeros(0, np.int64)
    return pd.DataFrame({"doc_id": np.repeat(index.docs[passage[cut]], n), "lo": at + np.repeat(start[cut], n), "hi": at + np.repeat(start[end], n) + index.span})


def distinct_texts(docs: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(copies: doc_id, head of the documents whose text stands in a lower doc_id; documents without those copies)."""
    long = docs.where(F.length("text") >= span)
    keyed = long.select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))  # no two texts are known to share one
    heads = keyed.groupBy("key").agg(F.min("doc_id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = written(keyed.join(heads, "key").where("doc_id <> head").select("doc_id", "head"), "copies")
    return copies, long.join(copies.select("doc_id"), "doc_id", "left_anti")


def passages(docs: DataFrame, span: int = SPAN, gram: int = GRAM, cell: int = CELL) -> DataFrame:
    """block, side, doc_id, text, starts: the passages of shared anchors, keyed by anchor or cell of it. docs: doc_id, text."""

    def announce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k, h, _, _ = anchors(batch["text"].tolist(), span, gram)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(np.int64)[k], "anchor": h}).drop_duplicates()

    held = written(docs.mapInPandas(announce, "doc_id bigint, anchor bigint"), "anchors")
    # counted with map-side combination and joined, so that an anchor of very many documents is in no single task
    shared = held.join(held.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchor")
    lists = shared.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "n")).alias("shared"))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].tolist()
            k, h, first, last = anchors(texts, span, gram)
            wanted = [{x["anchor"]: x["n"] for x in s} for s in batch["shared"]]
            seen: dict[tuple, list[int]] = {}
            for t, a, lo, hi in zip(k.tolist(), h.tolist(), first.tolist(), last.tolist()):
                if a in wanted[t]:
                    seen.setdefault((t, a, texts[t][lo : hi + span]), []).append(lo)
            rows = []
            for (t, a, text), starts in seen.items():
                g = -(-wanted[t][a] // cell)
                own = hash(ids[t]) * 0x9E3779B97F4A7C15 % 2**64 % g
                for other in range(g):
                    i, j = min(own, other), max(own, other)
                    block = a if g == 1 else ((a ^ (i << 20) ^ j) * 0x5851F42D4C957F2D + 2**63) % 2**64 - 2**63
                    rows.append((block, 0 if i == j else 1 if own == i else 2, ids[t], text, starts))
            yield pd.DataFrame(rows, columns=["block", "side", "doc_id", "text", "starts"])

    return docs.join(lists, "doc_id").mapInPandas(send, "block bigint, side int, doc_id bigint, text string, starts array<bigint>")


def over_shards(rows: DataFrame, use, schema: str, span: int = SPAN, shard: int = SHARD) -> DataFrame:
    """use(index, batch) for indexes of whole blocks, each of at least shard code points where there are so many."""
    from newsloom.llm.wordsets import whole_blocks

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            batch = pd.concat(held, ignore_index=True)
            return use(FMIndex(batch["text"].tolist(), batch["doc_id"].to_numpy(np.int64), span), batch)

        for whole in whole_blocks(batches):
            block = whole["block"].to_numpy()
            sizes = np.cumsum(whole["text"].str.len().to_numpy(np.int64))
            at = 0
            for e in np.r_[np.flatnonzero(block[1:] != block[:-1]) + 1, len(block)].tolist():
                if size + sizes[e - 1] - (sizes[at - 1] if at else 0) >= shard:
                    held.append(whole.iloc[at:e])
                    yield flush()
                    held, size, at = [], 0, e
            if at < len(block):
                held.append(whole.iloc[at:])
                size += int(sizes[-1] - (sizes[at - 1] if at else 0))
        if held:
            yield flush()

    return rows.repartition("block").sortWithinPartitions("block").mapInPandas(work, schema)


def _head_pairs(heads: DataFrame, span: int, gram: int) -> DataFrame:
    """doc_a < doc_b of different texts with a common span."""

    def pairs(index: FMIndex, batch: pd.DataFrame) -> pd.DataFrame:
        side, block = batch["side"].to_numpy(np.int64), batch["block"].to_numpy(np.int64)
        return _pairs(index, side, np.where(side == 0, 0, block))

    return over_shards(passages(heads, span, gram), pairs, "doc_a bigint, doc_b bigint", span).distinct()


def shared_pairs(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_a < doc_b of all documents (doc_id, text) with a common span of at least span code points."""
    copies, heads = distinct_texts(docs, span)
    found = _head_pairs(heads, span, gram)
    # copies come back: each head stands for its whole class
    own = copies.select("head").distinct().select("head", F.col("head").alias("doc_id")).unionByName(copies.select("head", "doc_id"))
    within = own.alias("a").join(own.alias("b"), (F.col("a.head") == F.col("b.head")) & (F.col("a.doc_id") < F.col("b.doc_id")))
    within = within.select(F.col("a.doc_id").alias("doc_a"), F.col("b.doc_id").alias("doc_b"))
    a, b = (own.select(F.col("head").alias(x), F.col("doc_id").alias(y)) for x, y in (("doc_a", "x"), ("doc_b", "y")))
    across = found.join(a, "doc_a", "left").join(b, "doc_b", "left").select(F.coalesce("x", "doc_a").alias("x"), F.coalesce("y", "doc_b").alias("y"))
    return within.unionByName(across.select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")))


def shared_classes(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class), links (documents it shares a span with) of all that share one.

    Different texts are linked and copies counted, so no pairs of copies are made.
    """
    copies, heads = distinct_texts(docs, span)
    found = written(_head_pairs(heads, span, gram), "span-links")
    held = copies.groupBy("head").agg(F.count("*").alias("more"))
    both = found.select(F.col("doc_a").alias("doc"), F.col("doc_b").alias("other")).unionByName(found.select(F.col("doc_b").alias("doc"), F.col("doc_a").alias("other")))
    others = both.join(held, both["other"] == held["head"], "left").groupBy("doc").agg(F.sum(1 + F.coalesce("more", F.lit(0))).alias("others"))
    classes = connected_components(found, "doc_a", "doc_b")
    linked = others.join(classes, F.col("doc") == F.col("vertex"), "full_outer").select(F.coalesce("doc", "vertex").alias("doc"), "others", "component")
    rows = linked.join(held, linked["doc"] == held["head"], "full_outer")
    rows = rows.select(F.coalesce("doc", "head").alias("head"), F.coalesce("component", "doc", "head").alias("class_id"), (F.coalesce("others", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("links"))
    return rows.select(F.col("head").alias("doc_id"), "class_id", "links").unionByName(copies.join(rows, "head").select("doc_id", "class_id", "links"))


def shared_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, lo, hi: maximal stretches of code points that lie in windows shared with other documents.

    A document that has copies is shared from end to end; of copies every row is listed.
    """
    copies, heads = distinct_texts(docs, span)

    def windows(index: FMIndex, batch: pd.DataFrame) -> pd.DataFrame:
        return _windows(index, batch["starts"].tolist(), batch["side"].to_numpy(), batch["block"].to_numpy())

    found = over_shards(passages(heads, span, gram), windows, "doc_id bigint, lo bigint, hi bigint", span)
    copied = copies.select("doc_id").unionByName(copies.select(F.col("head").alias("doc_id"))).distinct()
    whole = docs.join(copied, "doc_id").select("doc_id", F.lit(0).cast("bigint").alias("lo"), F.length("text").cast("bigint").alias("hi"))
    every = found.unionByName(whole)
    by = Window.partitionBy("doc_id").orderBy("lo", "hi")
    reach = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = every.withColumn("new", F.when(F.col("lo") <= reach, 0).otherwise(1))
    island = begins.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy("doc_id", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def _documents(spark, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


def p9_found(spark, sf: str) -> DataFrame:
    return shared_pairs(_documents(spark, sf))


def p9_classes(spark, sf: str) -> DataFrame:
    """Each document that shares a span: its class and its number of links."""
    return shared_classes(_documents(spark, sf))


def p9_spans(spark, sf: str) -> DataFrame:
    """doc_id, lo, hi of every shared stretch."""
    return shared_spans(_documents(spark, sf))


def p9_coverage(spark, sf: str) -> DataFrame:
    """Per document: code points, how many of them stand in other documents too, number of shared stretches."""
    docs = _documents(spark, sf)
    spans = p9_spans(spark, sf).groupBy("doc_id").agg(F.sum(F.col("hi") - F.col("lo")).alias("shared_chars"), F.count("*").alias("spans"))
    sizes = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"))
    return sizes.join(spans, "doc_id", "left").select("doc_id", "chars", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.coalesce("spans", F.lit(0)).alias("spans"))
