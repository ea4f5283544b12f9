"""Deduplicating new batches against all history: a saved prefix-tree hash forest over titles and addresses.

Signature. A set (the words of a title, or the two halves of an address's digest) has its word hashes in a rare-first order
that is fixed when the forest is founded. Its r-th permutation begins at the r-th word; what is stored of it is an entry
(the word, the set's size, the position r, the first id, all words). A batch's entries make one run, sorted by (word, size)
and cut into files by the leading bits of the word, in the shared folder; a small file beside the runs (``save``, ``open``)
holds the order and the list of runs.

Search. A batch is written as a run first. Its entries then go through all runs, its own included, by range search: of
each run only the row groups whose range of words holds a word of the entries are read, and in them a binary search by
(word, least size) and (word, greatest size) gives the range of entries that can be similar. A set's prefix is widened
word by word until the share of similar sets that it must meet reaches ``recall`` (see ``widened``): with 1, the default,
it is the whole prefix, which no similar set escapes. What is met is verified on the whole sets. History is neither
shuffled nor compared with itself, its titles and links are not read again, and every range may be read by any number of
tasks, so a word that very many titles have needs no cells.

Runs grow as a log-structured tree does: ``accept`` adds one, and once FAN runs are of one level they are merged into one of
the next, so an entry is rewritten a number of times that grows with the logarithm of the history only.

Defined results: a null title, or one without words, matches by address only; a null or empty link by title only; equal
rows repeat each other; a row never matches itself; history is accepted as it stands; an empty batch gives no rows; a null
batch number counts as history.  Extra columns are ignored.

Scale: equal sets of a batch are folded to one with the lowest id, so a hot title costs one entry a prefix word and run. The
lowest id of what a set meets is all that is kept of it. No list of ids or documents reaches the driver.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import lookalike
from newsloom.llm import wordsets as W
from newsloom.llm.address import with_address
from newsloom.session import run_path, until_exit, written

THRESHOLD = 0.7
#: Runs of one level that are merged, entries of one file and bytes of one row group, pairs looked at together.
FAN, FILE_ENTRIES, GROUP_BYTES, AT_ONCE = 4, 500_000, 2 << 20, 1_000_000
#: Files of a run at least, as a power of two, so that small runs are searched by several tasks.
LEAST_BITS = 3
ENTRY = ["block", "size", "tree", "first_id", "words"]


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The shared folder as tasks see it."""
    if re.match(r"^file:/|^/", uri):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return pafs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class Run:
    path: str
    bits: int
    level: int
    entries: int  # at most


def widened(sizes: np.ndarray, threshold: float, recall: float) -> np.ndarray:
    """How many words of its order a set must search for.

    A similar set shares at least a = ceil(t*n) of the n words. If these stood anywhere, the first m words would miss them
    all with probability C(n-a, m) / C(n, m); m is the least for which that is at most 1 - recall.
    """
    longest = W.prefix_length(threshold, sizes)
    if recall >= 1:
        return longest
    out, miss, m = longest.copy(), np.ones(len(sizes)), 0
    free = longest - 1  # n - a
    open_ = np.ones(len(sizes), bool)
    while open_.any():
        miss = miss * np.maximum(free - m, 0) / np.maximum(sizes - m, 1)
        m += 1
        now = open_ & ((miss <= 1 - recall) | (m >= longest))
        out[now] = m
        open_ &= ~now
    return out


class RangeSearch:
    """Reads sorted runs in a task: footers and listings are kept, of the rows only what a range search needs."""

    def __init__(self, runs: list[Run], threshold: float):
        self.runs, self.t = runs, threshold
        self.files: dict[tuple[str, int], list] = {}
        self.read = 0  # entries read so far

    def groups(self, run: Run, bucket: int) -> list:
        """(file, row group, least block, greatest block) of one bucket of a run."""
        if (run.path, bucket) not in self.files:
            fs, root = file_system(run.path)
            out = []
            for info in fs.get_file_info(pafs.FileSelector(f"{root}/bucket={bucket}", allow_not_found=True)):
                if info.path.endswith(".parquet"):
                    f = pq.ParquetFile(info.path, filesystem=fs)
                    at = f.schema_arrow.names.index("block")
                    for g in range(f.metadata.num_row_groups):
                        stats = f.metadata.row_group(g).column(at).statistics
                        out.append((f, g, stats.min, stats.max))
            self.files[run.path, bucket] = out
        return self.files[run.path, bucket]

    def entries(self, run: Run, blocks: np.ndarray) -> Iterator[pa.Table]:
        """The row groups of a run in whose range one of the blocks (sorted, distinct) lies."""
        shift = 63 - run.bits
        for bucket in np.unique(blocks >> shift).tolist():
            for f, g, lo, hi in self.groups(run, bucket):
                if np.searchsorted(blocks, hi, side="right") > np.searchsorted(blocks, lo):
                    rows = f.read_row_group(g, columns=ENTRY)
                    self.read += rows.num_rows
                    yield rows

    def least_ids(self, batch: pd.DataFrame) -> np.ndarray:
        """Per entry of batch and run the lowest first_id among similar sets, the greatest bigint where there is none."""
        none = np.iinfo(np.int64).max
        out = np.full((len(self.runs), len(batch)), none, np.int64)
        block, size, pos = (batch[c].to_numpy(np.int64) for c in ("block", "size", "tree"))
        blocks = np.unique(block)
        words, maps = batch["words"].to_numpy(), W.bitmaps(batch["words"])
        least, most = np.ceil(self.t * size - 1e-9).astype(np.int64), np.floor(size / self.t + 1e-9).astype(np.int64)
        for k, run in enumerate(self.runs):
            for there in self.entries(run, blocks):
                b, s, p, ids = (there[c].to_numpy().astype(np.int64) for c in ("block", "size", "tree", "first_id"))
                head = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
                at = np.minimum(np.searchsorted(b[head], block), len(head) - 1)
                mine = np.flatnonzero(b[head][at] == block)
                if not len(mine):
                    continue
                wide = max(int(s.max()), int(most.max())) + 2
                code = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(b)])) * wide + s
                lo = np.searchsorted(code, at[mine] * wide + least[mine])
                hi = np.searchsorted(code, at[mine] * wide + most[mine], side="right")
                # only entries in some range are unpacked
                inside = np.cumsum(np.bincount(lo, minlength=len(b) + 1) - np.bincount(hi, minlength=len(b) + 1))[: len(b)] > 0
                kept = np.flatnonzero(inside)
                if not len(kept):
                    continue
                there_words = there["words"].take(pa.array(kept)).to_pandas()
                there_maps, there_words = W.bitmaps(there_words), there_words.to_numpy()
                place = np.cumsum(inside) - 1
                ends = np.cumsum(hi - lo)
                for a in range(0, int(ends[-1]), AT_ONCE):
                    pair = np.arange(a, min(a + AT_ONCE, int(ends[-1])))
                    q = np.searchsorted(ends, pair, side="right")
                    j = hi[q] - (ends[q] - pair)
                    i = mine[q]
                    ok = (ids[j] < out[k, i]) & W.position_bound(self.t, size[i], s[j], pos[i], p[j])
                    i, j = i[ok], j[ok]
                    ok = W.may_share(maps, there_maps, i, place[j]) >= W.need(self.t, size[i] + s[j])
                    i, j = i[ok], j[ok]
                    both, _ = W.overlaps(words, there_words, i, place[j])
                    ok = both >= self.t * (size[i] + s[j] - both) - 1e-9
                    np.minimum.at(out[k], i[ok], ids[j[ok]])
        return out


@dataclass
class HashForest:
    """An index of accepted titles and addresses that grows by runs; path: its folder."""

    path: str
    order: W.Order
    threshold: float = THRESHOLD
    recall: float = 1.0
    runs: list[Run] = field(default_factory=list)

    @classmethod
    def founded(cls, history: DataFrame, path: str | None = None, threshold: float = THRESHOLD, recall: float = 1.0) -> HashForest:
        """From rows id, set_key, words. path: a folder that all executors share; one that ends with the session by default."""
        order = W.word_order(W.word_counts(history))
        spark = history.sparkSession
        forest = cls(path or run_path(spark, "forest"), order, threshold, recall)
        forest.accept(history)
        if not path:
            until_exit(spark, forest.path)
        return forest

    def save(self) -> None:
        """Written last, after the runs it names: what a lost job left behind is in no list."""
        fs, root = file_system(self.path)
        with fs.open_output_stream(f"{root}/order") as out:
            out.write(self.order.cells.tobytes())
        with fs.open_output_stream(f"{root}/forest.json") as out:
            out.write(json.dumps({"threshold": self.threshold, "recall": self.recall, "runs": [asdict(r) for r in self.runs]}).encode())

    @classmethod
    def open(cls, path: str) -> HashForest:
        fs, root = file_system(path)
        with fs.open_input_stream(f"{root}/order") as f:
            order = W.Order(np.frombuffer(f.read(), np.uint8))
        with fs.open_input_stream(f"{root}/forest.json") as f:
            meta = json.loads(f.read())
        return cls(path, order, meta["threshold"], meta["recall"], [Run(**r) for r in meta["runs"]])

    def _write(self, entries: DataFrame, n: int, level: int) -> Run:
        bits = max(LEAST_BITS, (n // FILE_ENTRIES).bit_length())
        run = Run(f"{self.path}/run-{uuid.uuid4().hex}", bits, level, n)
        placed = entries.withColumn("bucket", F.shiftright("block", 63 - bits).cast("int")).repartitionById(1 << bits, F.col("bucket"))
        out = placed.sortWithinPartitions("bucket", "block", "size", "first_id").write.partitionBy("bucket").option("parquet.block.size", GROUP_BYTES)
        out.parquet(run.path)
        return run

    def _entries(self, run: Run, spark: SparkSession) -> DataFrame:
        return spark.read.schema("block bigint, size int, tree int, first_id bigint, words binary, bucket int").parquet(run.path)

    def accept(self, rows: DataFrame) -> Run:
        """Add a batch (id, set_key, words) as one sorted run."""
        sets = rows.groupBy("set_key").agg(F.min("id").alias("first_id"), F.first("words").alias("words"))
        n = rows.count()
        run = self._write(W.prefix_blocks(sets, self.order, self.threshold, "first_id").select(*ENTRY), n * 4, max(0, n.bit_length() // 2 - 6))
        self.runs.append(run)
        self.save()
        return run

    def compact(self, spark: SparkSession) -> bool:
        """Merge the last FAN runs if they are of one level, again as long as that is so."""
        merged = False
        while len(self.runs) >= FAN and len({r.level for r in self.runs[-FAN:]}) == 1:
            self.merge(spark, FAN)
            merged = True
        return merged

    def merge(self, spark: SparkSession, last: int | None = None) -> None:
        """Fold the last runs (all by default) into one; equal entries become one with the lowest id. The old files go."""
        old = self.runs[-(last or len(self.runs)) :]
        parts = [self._entries(r, spark).drop("bucket") for r in old]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        rows = rows.groupBy("block", "size", "tree", "words").agg(F.min("first_id").alias("first_id"))
        run = self._write(rows.select(*ENTRY), sum(r.entries for r in old), max(r.level for r in old) + 1)
        self.runs = [*self.runs[: len(self.runs) - len(old)], run]
        self.save()
        for r in old:
            fs, root = file_system(r.path)
            fs.delete_dir(root)

    def arrive(self, rows: DataFrame) -> DataFrame:
        """Accept a batch (id, set_key, words); id, first_id of its rows that an accepted set, or an earlier one of the batch, precedes.

        Lazy: read it before the next ``compact`` or ``merge``, which delete runs.
        """
        spark, own = rows.sparkSession, self.accept(rows)
        runs, threshold, recall = list(self.runs), self.threshold, self.recall
        none = np.iinfo(np.int64).max

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            search = RangeSearch(runs, threshold)
            for batch in batches:
                if recall < 1:
                    batch = batch[batch["tree"].to_numpy() < widened(batch["size"].to_numpy(np.int64), threshold, recall)]
                if len(batch):
                    ids = search.least_ids(batch)
                    old = ids[:-1].min(axis=0, initial=none)
                    yield pd.DataFrame({"set_key": [W.set_key(w) for w in batch["words"]], "old": old, "own": ids[-1]})

        met = self._entries(own, spark).drop("bucket").mapInPandas(look, "set_key binary, old bigint, own bigint")
        met = met.groupBy("set_key").agg(F.min("old").alias("old"), F.min("own").alias("own"))
        # of the batch itself only lower ids precede a row; the lowest that a set meets is enough
        first = F.least(F.when(F.col("old") < none, F.col("old")), F.when(F.col("own") < F.col("id"), F.col("own")))
        found = rows.select("id", "set_key").join(met, "set_key").select("id", first.alias("first_id")).where("first_id is not null")
        return found.groupBy("id").agg(F.min("first_id").alias("first_id"))


def address_words(address: str) -> bytes:
    """An address as a set of two words: it is similar to its equal only."""
    return (np.frombuffer(xxhash.xxh3_128_digest(address), np.uint64) >> np.uint64(1)).tobytes()


def article_sets(df: DataFrame, *, id_column: str, batch: str, title: str, link: str) -> DataFrame:
    """id, set_key, words, batch: one row for a title and one for an address; each row is read once. In a folder by batch."""
    number = F.coalesce(F.col(batch).cast("int"), F.lit(0))
    named = df.select(F.col(id_column).cast("bigint").alias("id"), number.alias("batch"), F.col(title).cast("string").alias("title"), F.col(link).cast("string").alias("link"))
    rows = with_address(named, "link").select("id", "batch", "title", "address")
    titles = W.set_hasher(lookalike.public_shapes(df.sparkSession))

    def both(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield titles(part)
            linked = part[part["address"].notna()]
            words = [address_words(a) for a in linked["address"]]
            yield pd.DataFrame({"id": linked["id"], "set_key": [W.set_key(w) for w in words], "words": words, "batch": linked["batch"]})

    return written(rows.mapInPandas(both, W.SET_SCHEMA), "forest-arrivals", partition=["batch"])


def repeats(df: DataFrame, *, id_column: str, batch: str, title: str, link: str, history_batch: int = 0, threshold: float = THRESHOLD, recall: float = 1.0) -> DataFrame:
    """first_id, id: rows after the history that repeat an accepted row, or an earlier row, by title or address.

    The history founds the forest; the later batches arrive one after the other, and each is searched for in the runs and
    accepted. (Batch numbers are few, as each is a job of its own.)
    """
    spark = df.sparkSession
    arrivals = article_sets(df, id_column=id_column, batch=batch, title=title, link=link)
    forest = HashForest.founded(arrivals.where(F.col("batch") <= history_batch), threshold=threshold, recall=recall)
    later = sorted(r[0] for r in arrivals.where(F.col("batch") > history_batch).select("batch").distinct().collect())
    found = run_path(spark, "forest-repeats")
    spark.createDataFrame([], "id bigint, first_id bigint").write.parquet(found)
    until_exit(spark, found)
    for number in later:
        forest.arrive(arrivals.where(F.col("batch") == number)).write.mode("append").parquet(found)
        forest.compact(spark)
    return spark.read.schema("id bigint, first_id bigint").parquet(found)


def p1_found(spark, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/rss_articles.parquet").select("article_id", "batch_no", "title", "link")
    found = repeats(rows, id_column="article_id", batch="batch_no", title="title", link="link")
    return found.select("first_id", F.col("id").alias("article_id"))


def p1_batches(spark, sf: str) -> DataFrame:
    """Per batch: rows, and how many repeat an accepted or earlier row."""
    rows = spark.read.parquet(f"{sf}/rss_articles.parquet").select("article_id", "batch_no", "title", "link")
    found = repeats(rows, id_column="article_id", batch="batch_no", title="title", link="link")
    per = rows.join(found, rows["article_id"] == found["id"], "left").groupBy("batch_no")
    return per.agg(F.count("*").alias("rows"), F.count("first_id").alias("repeats"))
