"""Packing, mixing and shared spans."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import mixing, packing, spans, tokens


def test_pack_histogram_places_every_item():
    rnd = random.Random(5)
    for _ in range(60):
        cap = rnd.randint(1, 60)
        histogram = collections.Counter(rnd.randint(1, cap) for _ in range(rnd.randint(0, 300)))
        patterns = packing.pack_histogram(dict(histogram), cap)
        placed = collections.Counter()
        for n, p in patterns:
            assert n > 0 and sum(k * m for k, m in p.items()) <= cap
            for k, m in p.items():
                placed[k] += n * m
        assert placed == histogram
        ranges = collections.defaultdict(list)
        for length, lo, hi, _, _ in packing.intervals(patterns):
            ranges[length].append((lo, hi))
        for length, r in ranges.items():
            r.sort()
            assert r[0][0] == 0 and r[-1][1] == histogram[length] and all(a[1] == b[0] for a, b in zip(r, r[1:]))


def test_pack_fills_well_and_keeps_items_whole(spark):
    rnd = random.Random(6)
    sizes = [(i, rnd.choice([0, 1, 7, 7, 7, rnd.randint(1, 40), rnd.randint(1, 300)])) for i in range(800)]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint")
    kinds = spark.createDataFrame([("s", 32), ("l", 256)], "container_kind string, capacity_tokens int")
    rows = packing.pack(df, kinds).collect()
    for kind, cap in (("s", 32), ("l", 256)):
        mine = [r for r in rows if r["container_kind"] == kind]
        filled = collections.Counter()
        parts = collections.defaultdict(list)
        for r in mine:
            filled[r["container_no"]] += r["n_tokens"]
            parts[r["doc_id"]].append((r["start_token"], r["n_tokens"]))
        assert max(filled.values()) <= cap and set(filled) == set(range(len(filled)))
        for i, n in sizes:
            p = sorted(parts.get(i, []))
            assert sum(x for _, x in p) == n and (n > cap or len(p) <= 1)
        assert sum(filled.values()) / (len(filled) * cap) > 0.95
    assert packing.pack(df.limit(0), kinds).count() == 0


def test_numbered_over_a_hot_key(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    got = tokens.numbered(df, ["k"], ["id"], "n").collect()
    for k in (0, 1):
        assert sorted(r["n"] for r in got if r["k"] == k) == list(range(sum(r["k"] == k for r in got)))


def test_token_counts(spark):
    df = spark.createDataFrame([("hello world",), (None,), ("",), ("好" * 5000,)], "t string")
    n = [r["n"] for r in df.select(tokens.token_count(F.col("t")).alias("n")).collect()]
    assert n == [len(tokens.encoding(tokens.TOKENIZER).encode_ordinary("hello world")), 0, 0, len(tokens.encoding(tokens.TOKENIZER).encode_ordinary("好" * 5000))] and n[0] > 1


def test_allocate():
    assert mixing.allocate({"a": 100, "b": 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2}) == {"a": 20, "b": 20}
    assert mixing.allocate({"a": 100, "b": 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2}, 100) == {"a": 80, "b": 20}
    assert mixing.allocate({}, {"a": 1.0}, {"a": 1}) == {}
    counts = mixing.shard_counts({"a": 70, "b": 30}, 7)
    assert sum(c for _, s, c, _, _ in counts if s == "a") == 70 and {k for k, *_ in counts} == set(range(7))


def test_permutation():
    for n in (1, 2, 3, 17, 64, 1000):
        for key in (0, 9, 12345):
            assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key)).tolist()) == list(range(n))


def test_permutation_backwards():
    for n in (1, 2, 17, 1000):
        i, k = np.arange(n), np.full(n, 77)
        assert mixing.permuted(mixing.permuted(i, np.full(n, n), k), np.full(n, n), k, inverse=True).tolist() == i.tolist()


def test_slots_miss_their_tokens_by_less_than_a_block():
    for total in (1, 31, 32, 33, 100, 959, 960, 961):
        n = -(-total // 32)
        size = [32] * (n - 1) + [total - 32 * (n - 1)]
        for goal in range(0, 3 * total + 1, max(1, total // 40)):
            slots = mixing.slots_for(goal, total, 32, 5)
            got = 0
            for turn in range(slots // n + 1):
                k = min(n, slots - turn * n)
                got += sum(size[b] for b in mixing.permuted(np.arange(k), np.full(k, n), np.full(k, mixing.round_key(5, turn))))
            assert abs(got - goal) < 32, (total, goal, got)


def test_draws_beyond_the_exact_method():
    rng = np.random.default_rng(1)
    left = np.array([5 * 10**9, 3, 0, 2 * 10**9])
    got = mixing.drawn(rng, left, 10**9)
    assert got.sum() == 10**9 and (got <= left).all() and (mixing.drawn(rng, left, int(left.sum())) == left).all()


def test_slots_of_many_shards(spark):
    sizes = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), (F.col("id") % 50 + 1).cast("bigint").alias("n_tokens"))
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    rows = mixing.mixed(sizes, targets, block=4).select("shard", "slot", "source", "round", "block_no").distinct().collect()
    assert len(rows) == len({(r["shard"], r["slot"]) for r in rows}) == len({(r["source"], r["round"], r["block_no"]) for r in rows})
    per = collections.Counter(r["shard"] for r in rows)
    assert set(per) == set(range(len(per))) and len(per) > 50 and max(per.values()) - min(per.values()) < 10
    a = [sum(r["shard"] == k and r["source"] == "a" for r in rows) / per[k] for k in per]
    assert 0.3 < min(a) < max(a) < 0.7 and len(set(a)) > 5  # drawn, not fixed


def test_hot_length_meets_its_patterns_by_stretches(spark):
    sizes = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 < 4, 7).otherwise(F.col("id") % 30 + 1).cast("bigint").alias("n_tokens"))
    rows = packing.pack(sizes, spark.createDataFrame([("s", 32), (None, 0), ("bad", -1)], "container_kind string, capacity_tokens int")).collect()
    assert len(rows) == 5000 and len({r["doc_id"] for r in rows}) == 5000
    filled = collections.Counter()
    for r in rows:
        filled[r["container_no"]] += r["n_tokens"]
    assert max(filled.values()) <= 32 and sum(filled.values()) / (32 * len(filled)) > 0.9


def test_mix_keeps_caps_and_shares(spark):
    rnd = random.Random(7)
    sizes = [(i, s, rnd.randint(0, 90)) for i, s in enumerate(["big"] * 600 + ["small"] * 40 + ["other"] * 50 + [None] * 5)]
    df = spark.createDataFrame(sizes, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 4), ("absent", 0.0, 3)], "source string, target_share double, max_repeats int")
    sel = mixing.mixed(df, targets, block=32).cache()
    uses = collections.Counter((r["doc_id"], r["start_token"], r["n_tokens"]) for r in sel.collect())
    cap = {"big": 1, "small": 4}
    source = {i: s for i, s, _ in sizes}
    assert all(n <= cap[source[k[0]]] for k, n in uses.items())
    share = {r["source"]: r["actual_share"] for r in mixing.shares(sel, targets).collect()}
    assert abs(share["big"] - 0.7) < 0.02 and abs(share["small"] - 0.3) < 0.02 and share["absent"] == 0
    assert mixing.mixed(df.limit(0), targets).count() == 0


def corpus(seed=8):
    rnd = random.Random(seed)
    text = lambda n, a="abcdefgh ": "".join(rnd.choice(a) for _ in range(n))
    shared = [text(260), text(199), text(200, "汉字好人大小𝒳 "), text(900)]
    docs = [text(rnd.randint(0, 700)) + (rnd.choice(shared) if rnd.random() < 0.6 else "") + text(rnd.randint(0, 500)) for _ in range(60)]
    docs += [shared[1], "a" * 1500, "b" + "a" * 800, "ab" * 400, "xab" * 300, docs[0], docs[0], None, "", " " * 300, "\0" * 250 + "z", "\0" * 260]
    return docs


def shared_brute(docs, span):
    held = collections.defaultdict(set)
    for i, t in enumerate(docs):
        for k in range(len(t or "") - span + 1):
            held[t[k : k + span]].add(i)
    pairs = {(a, b) for v in held.values() for a in v for b in v if a < b}
    cover = {}
    for i, t in enumerate(docs):
        marks = bytearray(len(t or ""))
        for k in range(len(marks) - span + 1):
            if len(held[t[k : k + span]]) > 1:
                marks[k : k + span] = b"\1" * span
        cover[i] = sum(marks)
    return pairs, cover


def test_shared_spans_are_exact(spark):
    docs = corpus()
    pairs, cover = shared_brute(docs, 200)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").withColumn("anchor", F.lit("clash"))
    df = df.select("doc_id", "text")
    got = [(r["doc_a"], r["doc_b"]) for r in spans.shared_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs and len(pairs) > 50
    found = collections.Counter()
    for r in spans.shared_spans(df).collect():
        found[r["doc_id"]] += r["hi"] - r["lo"]
    assert all(found[i] == n for i, n in cover.items())
    assert spans.shared_pairs(df.limit(0)).count() == 0
    near = collections.defaultdict(set)
    for a, b in pairs:
        near[a].add(b), near[b].add(a)
    want = {}
    for i in sorted(near):
        todo = [i]
        while todo:
            if (k := todo.pop()) not in want:
                want[k] = i
                todo += near[k]
    rows = spans.shared_classes(df).collect()
    assert len(rows) == len(near) and {r["doc_id"]: (r["class_id"], r["links"]) for r in rows} == {i: (c, len(near[i])) for i, c in want.items()}


def test_cells_of_a_hot_anchor(spark):
    docs = corpus(9)
    pairs, _ = shared_brute(docs, 200)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").dropDuplicates(["text"]).where("length(text) >= 200")
    ids = {r["doc_id"] for r in df.collect()}

    def use(index, batch):
        side, block = batch["side"].to_numpy(np.int64), batch["block"].to_numpy(np.int64)
        return spans._pairs(index, side, np.where(side == 0, 0, block))

    got = {(r["doc_a"], r["doc_b"]) for r in spans.over_shards(spans.passages(df, cell=4), use, "doc_a bigint, doc_b bigint", shard=3000).collect()}
    assert got == {p for p in pairs if set(p) <= ids}


def test_wavelet_matrix_ranks():
    rnd = np.random.default_rng(1)
    s = rnd.integers(0, 23, 500)
    w = spans.WaveletMatrix(s, 23)
    q, i = rnd.integers(0, 23, 300), rnd.integers(0, 501, 300)
    assert w.ranks(q, i).tolist() == [int((s[:k] == c).sum()) for c, k in zip(q, i)]


def test_span_search_begins_with_a_gram():
    """The grams that the sort tells apart need no steps of their own: at most half a window is searched symbol by symbol."""
    draw = random.Random(3)
    text = "".join(draw.choice("abcdefgh ") for _ in range(400))
    index = spans.FMIndex([text, "x" * 250 + text[50:300], text[:199]], np.array([1, 2, 3]))
    steps, ranks = [], index.bwt.ranks
    index.bwt.ranks = lambda symbol, i: steps.append(len(symbol)) or ranks(symbol, i)
    assert index.first_matches().tolist() == [50, 250, -1]
    assert 0 < len([n for n in steps if n]) <= 150
