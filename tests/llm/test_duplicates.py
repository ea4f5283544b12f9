"""Near-duplicate titles, the hash forest and consensus records against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import consensus, forest, sigtree, wordsets


def titles(seed, n=260):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + [f"rare{i}" for i in range(300)]
    out = []
    for _ in range(n):
        if out and rnd.random() < 0.5:
            t = rnd.choice([x for x in out if x] or ["a b"]).split()
            for _ in range(rnd.randint(0, 3)):
                k = rnd.randrange(len(t)) if t else 0
                t[k : k + 1] = rnd.choice([[], [rnd.choice(words)], [t[k].upper() if t else "x"]])
            out.append(" ".join(t))
        else:
            out.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 14))))
    return out + [None, "", "?!", "same title here", "Same title HERE"] * 2 + ["long " + " ".join(f"t{i}" for i in range(4000))] * 2


def sets_of(texts):
    return [frozenset(wordsets.title_words(t)) if t else frozenset() for t in texts]


def test_similar_rows_is_exact(spark):
    texts = titles(1)
    s = sets_of(texts)
    want = {(i, j) for i in range(len(s)) for j in range(i + 1, len(s)) if wordsets.jaccard(s[i], s[j]) >= 0.7 - 1e-9}
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, title string").withColumn("words", F.lit("clash"))
    got = [(r["id_a"], r["id_b"]) for r in sigtree.similar_rows(df, "id", "title").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    assert sigtree.similar_rows(df.limit(0), "id", "title").count() == 0


def test_blocks_are_gone_before_rows_are_joined(spark):
    df = spark.createDataFrame(list(enumerate(titles(3, 40))), "id bigint, title string")
    plan = sigtree.similar_rows(df, "id", "title")._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "set-pairs-" in plan and "word-counts-" not in plan


def test_similar_groups(spark):
    texts = titles(2, 120)
    s = sets_of(texts)
    near = {i: {j for j in range(len(s)) if j != i and wordsets.jaccard(s[i], s[j]) >= 0.7 - 1e-9} for i in range(len(s))}
    want = {}
    for i in sorted(k for k in near if near[k]):
        todo = [i]
        while todo:
            if (k := todo.pop()) not in want:
                want[k] = i
                todo += near[k]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, title string")
    got = {r["id"]: (r["class_id"], r["links"]) for r in sigtree.similar_groups(df, "id", "title").collect()}
    assert got == {i: (c, len(near[i])) for i, c in want.items()} and len(set(want.values())) > 5


def test_hot_words_in_cells_and_deep_trees(spark):
    # one word in all titles and no rarer ones shared: blocks larger than a leaf, words split into cells
    rnd = random.Random(2)
    texts = [" ".join(["hot", *rnd.sample([f"v{i}" for i in range(9)], rnd.randint(1, 6))]) for _ in range(300)]
    s = sets_of(texts)
    distinct = sorted(set(s), key=sorted)
    rows = sigtree.W.with_word_sets(spark.createDataFrame(list(enumerate(texts)), "id bigint, title string"), "id", "title")
    sets = rows.groupBy("set_key").agg(F.first("words").alias("words"))
    counts = wordsets.word_counts(rows)
    assert counts.where("n > 60").count() > 3  # words that get more than three groups of 20
    want = sum(1 for i, a in enumerate(distinct) for b in distinct[i + 1 :] if wordsets.jaccard(a, b) >= 0.7 - 1e-9)
    got = sigtree.similar_sets(sets, 0.7, counts, cell_sets=20).collect()
    assert len(got) == len({(bytes(r["set_a"]), bytes(r["set_b"])) for r in got}) == want > 20


def brute_repeats(rows, sets):
    out = {}
    for i, (ix, batch, _, link) in enumerate(rows):
        if batch > 0:
            ids = [x for k, (x, b, _, other) in enumerate(rows) if (b < batch or (b == batch and x < ix)) and ((link and other == link) or wordsets.jaccard(sets[k], sets[i]) >= 0.7 - 1e-9)]
            if ids:
                out[ix] = min(ids)
    return out


def test_repeats_whole_and_batch_by_batch(spark):
    rnd = random.Random(3)
    texts = titles(3, 160)
    # ids out of batch order on purpose
    ids = rnd.sample(range(1000), len(texts))
    rows = [(x, rnd.randint(0, 3), t, rnd.choice([None, "", *[f"https://h.example/{k}" for k in range(200)]])) for x, t in zip(ids, texts)]
    want = brute_repeats(rows, sets_of([r[2] for r in rows]))
    df = spark.createDataFrame(rows, "article_id bigint, batch_no int, title string, link string").withColumn("old", F.lit(1))
    got = {r["id"]: r["first_id"] for r in forest.repeats(df, id_column="article_id", batch="batch_no", title="title", link="link").collect()}
    assert got == want and len(want) > 40
    by_title = brute_repeats([(a, b, c, None) for a, b, c, _ in rows], sets_of([r[2] for r in rows]))
    rows_ = forest.article_sets(df.withColumn("link", F.lit(None).cast("string")), id_column="article_id", batch="batch_no", title="title", link="link")
    f = forest.HashForest.founded(rows_.where("batch = 0"))
    step = {}
    for b in (1, 2, 3):
        step |= {r["id"]: r["first_id"] for r in f.arrive(rows_.where(F.col("batch") == b)).collect()}
        if b == 2:
            f.merge(spark)
            assert len(f.runs) == 1
            f = forest.HashForest.open(f.path)  # saved and opened again
    assert step == by_title
    assert f.arrive(rows_.limit(0)).count() == 0


def test_forest_widens_to_the_recall_target(spark):
    sizes = np.arange(1, 60)
    whole = forest.widened(sizes, 0.7, 1.0)
    for recall in (0.5, 0.9, 0.99):
        m = forest.widened(sizes, 0.7, recall)
        assert (m >= 1).all() and (m <= whole).all()
        for n, k in zip(sizes.tolist(), m.tolist()):
            free = n - math.ceil(0.7 * n - 1e-9)
            miss = lambda w: math.comb(free, w) / math.comb(n, w)
            assert miss(k) <= 1 - recall + 1e-12 and (k == 1 or miss(k - 1) > 1 - recall)
    texts = titles(5, 300)
    rows = [(i, int(i >= 200), t, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "article_id bigint, batch_no int, title string, link string")
    want = brute_repeats(rows, sets_of(texts))
    found = {r["id"]: r["first_id"] for r in forest.repeats(df, id_column="article_id", batch="batch_no", title="title", link="link", recall=0.9).collect()}
    assert set(found) <= set(want) and len(found) >= 0.9 * len(want)


def test_range_search_reads_only_what_it_needs(spark):
    rows = [(i, 0, f"alpha{i} beta{i} gamma{i}", None) for i in range(3000)]
    df = spark.createDataFrame(rows, "article_id bigint, batch_no int, title string, link string")
    sets = forest.article_sets(df, id_column="article_id", batch="batch_no", title="title", link="link")
    f = forest.HashForest.founded(sets)
    entries = f._entries(f.runs[0], spark).orderBy("block").toPandas()
    search = forest.RangeSearch(f.runs, 0.7)
    some = entries.iloc[:1].reset_index(drop=True)
    assert search.least_ids(some)[0, 0] == some["first_id"][0]
    assert 0 < search.read <= len(entries) / 4  # one file of eight


def test_titles_of_a_hot_word_and_hot_title(spark):
    texts = ["hot one two"] * 150 + [f"hot filler{i} more{i}" for i in range(150)] + ["one hot two"] * 5
    rows = [(i, i % 3, t, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "article_id bigint, batch_no int, title string, link string")
    got = {r["id"]: r["first_id"] for r in forest.repeats(df, id_column="article_id", batch="batch_no", title="title", link="link").collect()}
    assert got == brute_repeats(rows, sets_of(texts))


def test_best_records(spark):
    rows = [
        (1, 11, "k1", "Alpha beta gamma delta", 3, 100), (2, 12, "k1", "Alpha beta gama delta", 9, None), (3, 13, "k1", "Alpha beta gamma delta!", 9, 50), (4, 14, "k1", None, 9, 50),
        (5, 15, "k2", "solo", 1, 1), (6, 16, None, "no key", 1, 1), (7, 17, None, "no key", 1, 1), (8, 18, "k3", " ", 2, 5), (9, 19, "k3", "filled", 2, 5),
    ]
    df = spark.createDataFrame(rows, "id bigint, first_id bigint, key string, title string, prio int, at bigint")
    out = {r["first_id"]: r for r in consensus.best_records(df, id_column="id", keys=["key"], trust=F.col("prio"), recency=F.col("at"), fields=["title"]).collect()}
    assert set(out) == {1, 8}
    assert (out[1]["best_id"], out[1]["copies"], out[1]["title"]) == (3, 4, "Alpha beta gamma delta")
    assert (out[8]["best_id"], out[8]["title"]) == (8, "filled")
    assert consensus.best_records(df.limit(0), id_column="id", keys=["key"], trust=F.col("prio"), recency=F.col("at"), fields=["title"]).count() == 0


def test_records_have_every_field(spark, tables):
    source = spark.read.parquet(f"{tables}/reddit_articles.parquet")
    flat = [c for c in source.columns if c not in ("article_id", "metrics")] + [f"metrics_{m}" for m in source.schema["metrics"].dataType.names]
    got = consensus.p5_records(spark, tables).collect()
    assert set(got[0].asDict()) == {"first_id", "best_id", "copies", *flat}
    assert all(any(r[c] is not None for r in got) for c in flat)
    assert all(r["date"] is None or r["date"].endswith("+00:00") for r in got)
    assert sorted((r["first_id"], r["best_id"]) for r in got) == sorted(map(tuple, consensus.p5_found(spark, tables).collect()))
    seconds = spark.sql("select explode(array(-1L, 0L, 951782399L, null)) s").select(consensus.instant(F.col("s"))).collect()
    assert [r[0] for r in seconds] == ["1969-12-31T23:59:59+00:00", "1970-01-01T00:00:00+00:00", "2000-02-28T23:59:59+00:00", None]


def test_consensus_over_many_values_needs_rounds(spark):
    votes = spark.createDataFrame([(1, 0, f"the common words stay while n{i} varies", 1.0) for i in range(400)] + [(1, 0, "the common words stay while varies", 1.0)], "first_id bigint, field int, value string, weight double")
    got = consensus.consensus_values(votes, ["first_id", "field"], chunk=8).collect()
    assert len(got) == 1 and got[0]["value"].startswith("the common words stay while")


def test_alignment():
    p = consensus.progressive([[{t: w} for t in v.split()] for v, w in (("a b c d", 2.0), ("a x c d", 1.0), ("a b c", 1.0))])
    assert consensus.winners(p) == ["a", "b", "c", "d"]
    assert consensus.progressive([]) == []
