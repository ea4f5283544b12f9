"""Operators on small frames: noise, anti-joins, pairs, components, ranking, diagnostics, catalogues."""

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from newsloom.operators import articles as A
from newsloom.operators import config, diagnostics
from newsloom.operators import ranking as R
from newsloom.operators import similarity as S
from newsloom.operators.graph import connected_components
from newsloom.session import forget, shared_dir, written
from newsloom.sources.tables import ARTICLE


def frame(spark, rows):
    """Articles from dictionaries; what isn't given is null."""
    base = {"source_type": "rss", "source_priority": 3}
    data = [tuple((base | {"article_ix": i, "article_id": i} | r).get(c) for c in ARTICLE) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in ARTICLE.items()))


def test_noise(spark):
    rows = [
        {"title": "50 折 deal", "summary": "get it https://shop.example/x", "link": "https://a.example/?utm_source=x"},
        {"title": "A long and ordinary headline about a new compiler release", "link": "https://a.example/p?ref=1"},
        {"title": None, "link": None},
    ]
    got = [r["is_noise"] for r in A.with_noise(frame(spark, rows)).orderBy("article_ix").collect()]
    assert got == [True, False, False]
    assert A.without_noise(frame(spark, rows)).count() == 2


def test_history_and_seen(spark):
    old = frame(spark, [{"title": "Big News!", "link": "https://www.a.example/x/"}, {"title": None, "link": None}])
    new = frame(spark, [{"title": "big news", "link": "https://b.example/"}, {"title": "other", "link": "http://a.example/x?y=1"}, {"title": "fresh", "link": "https://c.example"}, {"title": "", "link": ""}])
    assert sorted(r["article_ix"] for r in A.not_in_history(new, old).collect()) == [2, 3]
    assert sorted(r["article_ix"] for r in A.not_seen_today(new, old).collect()) == [0, 1, 2, 3]
    assert A.not_in_history(new, old.limit(0)).count() == 4


def test_pairs_and_similarity(spark):
    titles = ["Rust compiler gets faster builds", "Rust compiler gets much faster builds", "Completely different topic here", "Rust compiler gets faster builds", None]
    f = S.features_of(frame(spark, [{"title": t, "link": f"https://h{i}.example/{i}"} for i, t in enumerate(titles)]))
    pairs = {(r["i"], r["j"]) for r in S.candidate_pairs(f).collect()}
    assert {(0, 1), (0, 3), (1, 3)} <= pairs and all(2 not in p and 4 not in p for p in pairs)
    scored = {(r["i"], r["j"]): r["similarity"] for r in S.scored_pairs(S.candidate_pairs(f), f, 0.5).collect()}
    assert scored[0, 3] == 1.0 and 0.86 < scored[0, 1] < 1.0
    every = {(r["i"], r["j"]) for r in S.scored_pairs(S.candidate_pairs(f), f, 0.0).where("similarity >= 0.86").collect()}
    assert every == {(r["i"], r["j"]) for r in S.scored_pairs(S.candidate_pairs(f), f, 0.86).collect()}


def test_prefilter_keeps_scattered_insertions(spark):
    titles = ["x4ea 4q9o m489 4zjo j7ya ekct br4y", "x4ea 1 4q9o z m489 2 4zjo i j7ya x ekct g br4y"]
    f = S.features_of(frame(spark, [{"title": t, "link": f"https://h{i}.example/{i}"} for i, t in enumerate(titles)]))
    pairs = spark.createDataFrame([(0, 1)], "i bigint, j bigint")
    assert [r["similarity"] for r in S.scored_pairs(pairs, f, 0.92).collect()] == [0.93]


def test_history_score(spark):
    old = S.features_of(frame(spark, [{"title": "Rust compiler gets faster builds"}, {"title": "Weather today"}]))
    new = S.features_of(frame(spark, [{"title": "Rust compiler gets faster builds"}, {"title": "Nothing in common at all"}]))
    got = {r["article_ix"]: r["history_score"] for r in S.history_scores(new, old).where("history_score < 0").collect()}
    assert got == {0: -16.0}


def test_history_score_of_equal_compact_titles_needs_no_bucket(spark):
    # more archived titles share every token than a bucket may have
    old = S.features_of(frame(spark, [{"title": "Open AI news"}] + [{"title": f"Open AI news number {i}"} for i in range(150)]))
    new = S.features_of(frame(spark, [{"title": "OpenAI news"}]))
    assert [(r["similarity"], r["history_score"]) for r in S.history_scores(new, old).collect()] == [(1.0, -16.0)]


def test_seen_by_any_link(spark):
    old = frame(spark, [{"title": "x", "link": "https://t.example/1"}])
    new = frame(spark, [{"title": "y", "reddit_url": "https://T.example/1/"}, {"title": "z", "link": "", "external_url": "https://t.example/1"}, {"title": "w", "link": "https://t.example/2", "reddit_url": "https://t.example/1"}])
    assert [r["article_ix"] for r in A.not_seen_today(new, old).collect()] == [2]


def test_components_match_union_find(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 380)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["vertex"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {v: find(v) for v in parent}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_rank_and_canonical(spark):
    rows = [{"title": t, "source_priority": p, "topic": k, "source_type": s} for t, p, k, s in (("a", 5, "x", "rss"), ("b", 5, "x", "rss"), ("c", 9, None, "rss"), ("d", 1, "y", "reddit"))]
    d = R.with_rank_scores(R.with_base_scores(frame(spark, rows)))
    assert {r["title"]: r["rank_score"] for r in d.collect()} == {"c": 3.0, "a": 1.5, "b": 0.0, "d": 3.0}
    d = d.withColumns({"history_score": F.lit(0.0), "hot_score": F.lit(0.0), "recency_score": F.lit(0.0), "component": F.when(F.col("title") == "c", 9).otherwise(1).cast("bigint")})
    c = {r["title"]: r for r in R.canonical(R.with_final_score(d)).collect()}
    assert set(c) == {"a", "c"} and c["a"]["cluster_size"] == 3 and c["a"]["multi_source"] and c["a"]["primary_topic"] == "x" and c["c"]["primary_topic"] == "uncategorized"
    top = R.top_per_topic(R.canonical(R.with_final_score(d)))
    assert top.count() == 2


def test_round_robin_alternates(spark):
    rows = [(i, "t", "rss" if i < 6 else "reddit", 10.0 - i, i, f"n{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "article_ix bigint, primary_topic string, source_type string, final_score double, first_ix bigint, title string")
    got = [r["article_ix"] for r in R.top_per_topic(df).orderBy("selection_order").collect()]
    assert got == [0, 6, 1, 7, 2]


def test_status_algebra(spark):
    rows = [("a", "ok", None, 4.0, None, 0), ("a", "error", "  bad \n thing ", None, 2.0, 3), ("b", "ok", None, 9.0, 9.5, 1)]
    t = spark.createDataFrame(rows, "step_key string, status string, error string, active_s double, total_s double, attempt int").withColumn("run_date", F.lit("2024-01-01").cast("date"))
    n = diagnostics.normalized_traces(t).orderBy("step_key", "status").collect()
    assert (n[0]["error"], n[0]["active_s"], n[0]["attempt"], n[1]["total_s"], n[1]["attempt"]) == ("bad thing", 2.0, 3, 4.0, 1)
    runs = diagnostics.step_runs(diagnostics.normalized_traces(t))
    assert {r["step_key"]: r["status"] for r in runs.collect()} == {"a": "partial", "b": "ok"}
    assert diagnostics.pipeline_status(runs, ["run_date"]).first()["status"] == "partial"
    buckets = {(r["step_key"], r["bucket"]): r["n"] for r in diagnostics.slow_buckets(t, ["step_key"]).collect()}
    assert buckets == {("a", "3.0-5.0"): 1, ("a", "5.0+"): 0, ("b", "3.0-5.0"): 0, ("b", "5.0+"): 1}


def test_catalogues(spark):
    d = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), (None, "z", 3)], "id string, name string, n int")
    o = spark.createDataFrame([("b", None, 7), ("c", "new", 8)], "id string, name string, n int")
    got = {r["id"]: (r["name"], r["n"]) for r in config.overlay_merge(d, o, "id").collect()}
    assert got == {"a": ("x", 1), "b": ("y", 7), "c": ("new", 8)}
    assert config.deep_merge({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 9}, "d": {"e": 1}}) == {"a": {"b": 9, "c": 2}, "d": {"e": 1}}
    topics = spark.createDataFrame([("ai", "AI / Artificial"), ("bare", "Plain")], "id string, label string")
    rows = spark.createDataFrame([("ai",), ("bare",), ("open-source",)], "topic string")
    assert {r["topic"]: r["topic_title"] for r in config.with_topic_titles(rows, topics).collect()} == {"ai": "Artificial", "bare": "Plain", "open-source": "Open Source"}


def test_history_pairs_that_cannot_be_near_never_meet_texts(spark):
    """One rare word shared by all: 60 x 60 pairs, of which only the 60 that are near leave the task; the scores are as before."""
    from newsloom.operators import near as N

    draw = random.Random(5)
    texts = [" ".join(["zyqor"] + ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(8)]) for _ in range(60)]
    old = S.features_of(frame(spark, [{"title": t} for t in texts]))
    new = S.features_of(frame(spark, [{"title": t + " s"} for t in texts]))
    kinds, most = (N.WORD, N.CJK, N.GRAM), dict.fromkeys(range(3), 96)
    posted = N.postings(N.titles(new, 1).unionByName(N.titles(old, 0)), N.bloom(N.rare_tokens(N.titles(old, 0), kinds, 1, most)), kinds)
    every, near = (N.pairs(posted, least, most, True).select("i", "j").distinct() for least in (0.0, 0.88))
    assert every.count() == 3600
    left = {(r["i"], r["j"]) for r in near.collect()}
    assert {(k, k) for k in range(60)} <= left and len(left) < 1200
    got = {r["article_ix"]: r["similarity"] for r in S.history_scores(new, old).collect()}
    assert set(got) == set(range(60)) and all(0.88 <= x < 1 for x in got.values())


def test_cards_lose_no_pair(spark):
    from newsloom.operators import near as N

    titles = ["Rust compiler gets faster builds", "Rust compiler gets much faster builds", "ab", "a b", "", "国务院 发布 新 规定 2024", "国务院发布新规定2024", "x4ea 4q9o m489 4zjo j7ya ekct br4y", "x4ea 1 4q9o z m489 2 4zjo i j7ya x ekct g br4y", "go go go", "𠮷野家 日本 ok"]
    f = S.features_of(frame(spark, [{"title": t, "link": f"https://h{i % 2}.example/{i}"} for i, t in enumerate(titles)]))
    rows = {r["article_ix"]: r for r in f.collect()}
    names = [rows[i]["norm_title"] for i in range(len(titles))]
    row, token, cards = N.read_titles(names)
    for i in rows:
        of = {k: len({t for r, t in zip(row.tolist(), token.tolist()) if r == i and t & 3 == k}) for k in range(3)}
        assert [of[0], of[1], of[2]] == [len(rows[i][c]) for c in ("word_tokens", "cjk_bigrams", "compact_bigrams")]
        assert cards[i]["grams"] + cards[i]["words"] + cards[i]["odd"] == len(rows[i]["all_tokens"])
        assert cards[i]["length"] == len(names[i]) and cards[i]["compact"] == len(rows[i]["compact_title"])
    ids = spark.createDataFrame([(i, j) for i in rows for j in rows if i < j], "i bigint, j bigint")
    for least in (0.82, 0.86, 0.92):
        reach = S.measured(S.with_both(ids, f)).where(S.can_reach(least)).select("i", "j", "jac").collect()
        cards["domain"] = [1 + i % 2 for i in range(len(titles))]
        assert all(N.can_be(cards[[r["i"]]], cards[[r["j"]]], least)[0] for r in reach)


def test_near_pairs_are_the_scored_candidates(spark):
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdefghijklm") for _ in range(6)) for _ in range(60)] + ["国务院发布新规定", "日本经济增长数据"]
    titles = [" ".join(draw.choices(words, k=5)) for _ in range(60)]
    titles += [t + " s" for t in titles[:20]] + titles[20:30] + [titles[30].replace(" ", "")]
    f = S.features_of(frame(spark, [{"title": t, "link": f"https://h{i % 5}.example/{i % 70}"} for i, t in enumerate(titles)]))
    want = {(r["i"], r["j"], r["similarity"]) for r in S.scored_pairs(S.candidate_pairs(f), f, 0.86).collect()}
    got = S.near_pairs(f, 0.86).collect()
    assert len(want) > 30 and sorted(want) == sorted((r["i"], r["j"], r["similarity"]) for r in got)


def test_near_pairs_need_no_rare_token(spark):
    """Every word is one of more titles than a bucket may hold; words go, come, are joined, mistyped and change places."""
    from newsloom.params import Params

    draw = random.Random(3)
    words = ["compiler", "builds", "faster", "today", "release", "kernel", "report", "in"]
    titles = [" ".join(draw.choices(words, k=draw.randint(4, 7))) for _ in range(160)]
    for t in titles[:20]:
        w = t.split()
        k = draw.randrange(len(w) - 1)
        letter = draw.randrange(len(t))
        titles += [" ".join(w[:k] + w[k + 1 :]), " ".join(w[:k] + [w[k] + w[k + 1]] + w[k + 2 :]), t[:letter] + t[letter + 1 :], " ".join(w[1:] + w[:1]), t + " now"]
    titles += ["国务院 发布 新规定 关于 市场", "国务院 发布 新规定 关于 市场 今日"] + ["", "go", "a b"] * 3
    f = written(S.features_of(frame(spark, [{"title": t, "link": f"https://h{i % 3}.example/{i % 240}"} for i, t in enumerate(titles)])), "features")
    lifted = Params(word_bucket=10**9, cjk_bucket=10**9)
    want = {(r["i"], r["j"], r["similarity"]) for r in S.scored_pairs(S.candidate_pairs(f, lifted), f, 0.86).collect()}
    for least in (0.86, 0.93):
        got = S.near_pairs(f, least).collect()
        assert sorted(w for w in want if w[2] >= least) == sorted((r["i"], r["j"], r["similarity"]) for r in got)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_exact_pairs_take_one_shuffle_of_hashes(spark):
    rows = [{"title": t, "link": u} for t, u in (("Big News", "https://a.example/x"), ("big news!", None), ("bignews", "https://b.example"), ("other", "http://a.example/x/"), (None, ""), ("", None))]
    pairs = S.exact_pairs(S.features_of(frame(spark, rows)))
    assert _exchanges(pairs) == 1
    assert sorted((r["i"], r["j"]) for r in pairs.collect()) == [(0, 1), (0, 1), (0, 2), (0, 3)]


def test_fresh_articles_are_those_not_in_history(spark):
    """Keys of titles, of links and of what stands for either; without a shuffle but for what may be archived."""
    from newsloom.functions import text as X
    from newsloom.functions import url as U
    from newsloom.plans.pipeline import fresh_articles

    old = frame(spark, [{"title": "Big News!", "link": "https://www.a.example/x/"}, {"title": "https://c.example/seen", "link": None}, {"title": None, "link": ""}])
    new = frame(spark, [{"title": "big news"}, {"title": "other", "link": "http://a.example/x?y=1"}, {"title": "new", "link": "https://n.example"}, {"title": "", "link": ""}, {"title": " ", "reddit_url": "https://a.example/x"}, {"title": None, "link": "https://c.example/seen"}, {"title": "", "link": "", "external_url": "https://a.example/x/"}])
    archive = old.select("article_ix", X.normalize_title(F.col("title")).alias("norm_title"), U.normalize_url(F.col("link")).alias("norm_link"))
    got = fresh_articles(new, archive)
    assert _exchanges(got) == 0
    assert sorted(r["article_ix"] for r in got.collect()) == sorted(r["article_ix"] for r in A.not_in_history(new, old).collect()) == [2, 3]


def test_canonical_rows_are_not_joined_back(spark):
    rows = [(i, i // 3, None if i == 4 else "rss" if i % 2 else "reddit", f"t{i % 2}", 1.0, float(i % 3 == 1), "x") for i in range(8)]
    d = spark.createDataFrame(rows, "article_ix bigint, component bigint, source_type string, title string, final_score double, extra_score double, topic string")
    c = R.canonical(d)
    assert {(r["article_ix"], r["cluster_size"], r["multi_source"], r["first_ix"]) for r in c.collect()} == {(1, 3, True, 0), (4, 3, False, 3), (7, 2, True, 6)}
    assert "SortMergeJoin [article_ix" not in c._jdf.queryExecution().sparkPlan().toString() and c._jdf.queryExecution().sparkPlan().toString().count("Join") == 1


def test_positions_keep_no_key_and_shuffle_once(spark):
    d = spark.createDataFrame([(i, "rss" if i % 3 else "reddit", -i) for i in range(50)], "article_ix bigint, source_type string, k bigint")
    got = R.positions(d.repartition(5), "source_type", "k", "place")
    assert "k" not in got.columns and "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    rows = {(r["source_type"], r["place"]): r["article_ix"] for r in got.collect()}
    assert rows == {(t, n): x for t, xs in (("rss", [i for i in range(49, -1, -1) if i % 3]), ("reddit", [i for i in range(48, -1, -3)])) for n, x in enumerate(xs, 1)}


def _shuffled(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def _runs(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file://")).glob("*") if any(p.glob("*.parquet"))}


def test_written_tables_leave_no_shuffle_and_can_be_forgotten(spark, tmp_path):
    had, runs = _shuffled(spark), _runs(spark)
    run = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevens")
    until = time.time() + 20
    while _shuffled(spark) - had and time.time() < until:  # they are removed soon after
        time.sleep(0.2)
    assert not _shuffled(spark) - had and run.count() == 7
    run.write.parquet(f"{tmp_path}/own")
    forget(run.unionByName(spark.read.parquet(f"{tmp_path}/own")))
    assert _runs(spark) == runs and spark.read.parquet(f"{tmp_path}/own").count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_components_keep_one_run(spark):
    had = _runs(spark)
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "src bigint, dst bigint")
    assert {r["component"] for r in connected_components(edges).collect()} == {0}
    assert len(_runs(spark) - had) == 1


def test_pairs_and_history_scores_are_read_from_one_run(spark):
    titles = ["rust compiler gets faster builds today", "rust compiler gets faster builds today now", "weather report for the north", "weather report for the northern"]
    rows = written(S.features_of(frame(spark, [{"title": t, "link": f"https://h{i}.example"} for i, t in enumerate(titles)])), "features")
    for make, name in ((lambda: S.near_pairs(rows, 0.5), "pairs-"), (lambda: S.history_scores(rows, rows), "history-scores-")):
        had = _runs(spark)
        got = make()
        assert got.count() > 0 and _exchanges(got) == 0
        assert [n for n in _runs(spark) - had if not n.startswith(name)] == [] and rows.count() == 4


def test_scores_of_the_pipeline_keep_the_positions_only(spark):
    from newsloom.plans.pipeline import scored_articles

    had = _runs(spark)
    new = frame(spark, [{"title": f"story number {i // 2} about compilers and builds", "link": f"https://h{i}.example", "source_type": "rss" if i % 2 else "google"} for i in range(8)])
    assert scored_articles(new, frame(spark, [{"title": "an old story", "link": "https://old.example"}])).count() == 8
    assert {n.rpartition("-")[0] for n in _runs(spark) - had} <= {"ranges", "history-scores", "star", "edges"}
