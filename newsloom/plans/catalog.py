"""Registered queries of the core over whole tables; plans.sql has the same in DuckDB's SQL where SQL can say it.

The queries with scores take what SQL can say: components by equal URL, title or compact title, no history score. Their
all_... forms take the pipeline's scores and components, fuzzy similarity included, after its noise and history filters.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import dates, numbers
from newsloom.functions import text as X
from newsloom.functions import url as U
from newsloom.operators import articles as A
from newsloom.operators import config, diagnostics, timestamps
from newsloom.operators import documents as D
from newsloom.operators import matches as M
from newsloom.operators import ranking as R
from newsloom.operators import similarity as S
from newsloom.operators.graph import connected_components
from newsloom.params import DEFAULTS
from newsloom.plans import operations, services, sql
from newsloom.plans.pipeline import scored_stories, top_stories, with_texts
from newsloom.session import written
from newsloom.sources.tables import ARTICLE, articles, read, traces

def _joined(tokens) -> F.Column:
    return F.array_join(F.array_sort(tokens), " ")


def union_registry(spark, sf):
    return articles(spark, sf).select("article_ix", "source_type", "source_priority", "title")


def norm_title(spark, sf):
    d = articles(spark, sf).select("article_ix", X.normalize_title(F.col("title")).alias("norm_title"))
    return d.withColumn("compact_title", X.compact(F.col("norm_title")))


def norm_url(spark, sf):
    d = articles(spark, sf)
    return d.select("article_ix", U.normalize_url(F.col("link")).alias("norm_url"), U.url_host(F.col("link")).alias("domain"), U.tracking_params(F.col("link")).alias("tracking"))


def noise_signals(spark, sf):
    return A.with_noise(articles(spark, sf)).select("article_ix", *A.NOISE_WEIGHTS, "noise_score", "is_noise")


def _promoted(spark, sf):
    """Articles made promotional: a price before the title's beginning, a link and counts behind the summary."""
    n = F.col("article_ix") % 4
    title = F.when(n == 0, F.col("title")).otherwise(F.concat(F.lit("5折 "), F.substring("title", 1, 20)))
    summary = F.when(n <= 1, F.col("summary")).otherwise(F.concat(X.text(F.col("summary")), F.lit(" https://shop.example/x 12 comments"), F.when(n == 3, " 7 posts").otherwise("")))
    return A.with_noise(articles(spark, sf).withColumns({"title": title, "summary": summary}))


def noise_stressed(spark, sf):
    """The noise rules where they bite."""
    return _promoted(spark, sf).select("article_ix", *A.NOISE_WEIGHTS, "noise_score", "is_noise")


def noise_removed(spark, sf):
    d = A.with_noise(articles(spark, sf))
    return d.groupBy("source_type").agg(F.count("*").alias("total"), F.count_if("is_noise").alias("removed"))


def word_tokens(spark, sf):
    d = A.with_features(articles(spark, sf))
    return d.select("article_ix", F.size("word_tokens").cast("bigint").alias("n"), _joined("word_tokens").alias("words"))


def bigram_sets(spark, sf):
    d = A.with_features(articles(spark, sf))
    return d.select("article_ix", _joined("cjk_bigrams").alias("cjk"), _joined("compact_bigrams").alias("compact"))


def _halves(spark, sf):
    """(articles that came later or from elsewhere, the archive: batch 0 of the feeds)."""
    arts = articles(spark, sf)
    old = (F.col("source_type") == "rss") & (F.col("batch_no") == 0)
    return arts.where(~F.coalesce(old, F.lit(False))), arts.where(old)


def history_anti_join(spark, sf):
    new, old = _halves(spark, sf)
    return A.not_in_history(new, old).select("article_ix", "title", "link")


def same_day_seen(spark, sf):
    new, old = _halves(spark, sf)
    return A.not_seen_today(new, old).select("article_ix", "title", "link")


def _features(spark, sf):
    """Written: a dozen branches read it."""
    return written(S.features_of(articles(spark, sf)), "features")


def candidate_pairs(spark, sf):
    return S.candidate_pairs(_features(spark, sf))


def pair_jaccard(spark, sf):
    f = _features(spark, sf)
    d = S.measured(S.with_both(S.candidate_pairs(f), f))
    return d.select("i", "j", F.bround("jac", 6).alias("jaccard"), F.col("words").cast("bigint").alias("words"), "url")


def comparable_pairs(spark, sf):
    f = _features(spark, sf)
    return S.measured(S.with_both(S.candidate_pairs(f), f)).where(S.comparable()).select("i", "j", "hint")


def fuzzy_pairs(spark, sf):
    f = _features(spark, sf)
    return S.near_pairs(f, DEFAULTS.hot_threshold).select("i", "j", F.bround("similarity", 4).alias("similarity"))


def _exact_components(features):
    return connected_components(S.exact_pairs(features).withColumnsRenamed({"i": "src", "j": "dst"}))


def exact_components(spark, sf):
    return _exact_components(_features(spark, sf))


def hot_scores(spark, sf):
    d = written(A.with_features(articles(spark, sf)).select("article_ix", "source_type", "norm_url", "norm_title", "compact_title"), "keys")
    return R.hot_scores(d.select("article_ix", "source_type"), _exact_components(d))


def history_penalty(spark, sf):
    new, old = _halves(spark, sf)
    f = S.history_scores(S.written_titles(new), S.written_titles(old))
    return f.where("history_score < 0").select("article_ix", F.bround("similarity", 4).alias("similarity"), "history_score")


def engagement_tiers(spark, sf):
    return articles(spark, sf).select("article_ix", A.engagement(None).cast("bigint").alias("extra_score"))


def recency(spark, sf):
    return R.with_recency(articles(spark, sf)).select("article_ix", "recency_score")


def fetch_rank(spark, sf):
    return R.with_rank_scores(R.with_base_scores(articles(spark, sf))).select("article_ix", "base_score", "extra_score", "rank_score")


def _scored(spark, sf, whole) -> DataFrame:
    """whole: the pipeline's scores and components. Else what SQL can say: components by exact keys, no history score."""
    if whole:
        return scored_stories(spark, sf)  # read from written rows
    d = written(A.with_features(articles(spark, sf)), "features")
    components = _exact_components(d)
    hot = R.hot_scores(d.select("article_ix", "source_type"), components)
    d = R.with_recency(R.with_rank_scores(R.with_base_scores(d.select(*ARTICLE))))
    d = d.join(components, d["article_ix"] == components["vertex"], "left").drop("vertex").withColumn("component", F.coalesce("component", "article_ix"))
    scored = R.with_final_score(d.join(hot, "article_ix", "left").withColumn("history_score", F.lit(0.0)))
    return written(scored, "scored")  # read two to four times


def _canonical(spark, sf, whole) -> DataFrame:
    """Canonical rows for what reads them twice; the pipeline's are written, else they would be made as often."""
    canon = R.canonical(_scored(spark, sf, whole))
    return written(canon, "canonical") if whole else canon


def final_score(spark, sf, whole=False):
    return _scored(spark, sf, whole).select("article_ix", "component", "final_score")


def canonical_pick(spark, sf, whole=False):
    return R.canonical(_scored(spark, sf, whole)).select("article_ix", "cluster_size", "multi_source", "first_ix", "final_score")


def cluster_topic(spark, sf, whole=False):
    return R.canonical(_scored(spark, sf, whole)).select("article_ix", "primary_topic", F.size("topic_candidates").cast("bigint").alias("topics"))


def grouped_ranking(spark, sf):
    d = R.with_base_scores(articles(spark, sf))
    d = d.withColumn("o", F.struct((-(F.col("base_score") + F.col("extra_score"))).alias("s"), X.text(F.col("title")).alias("t"), F.col("article_ix").alias("x")))
    return R.positions(d, "source_type", "o", "position").select("article_ix", "source_type", F.col("position").cast("bigint").alias("position"))


def topic_order(spark, sf, whole=False):
    c = _canonical(spark, sf, whole)
    return R.topic_order(c, R.source_order(c)).select("primary_topic", "available", F.col("topic_rank").cast("bigint").alias("topic_rank"))


def round_robin_topn(spark, sf, whole=False):
    d = R.top_per_topic(_canonical(spark, sf, whole))
    return d.select(F.col("primary_topic").alias("topic"), "article_ix", F.col("selection_order").cast("bigint").alias("selection_order"), F.col("rank").cast("bigint").alias("rank"), F.col("turn").cast("bigint").alias("turn"))


def markdown_lines(spark, sf, whole=False):
    top = R.top_per_topic(_canonical(spark, sf, whole))
    return R.markdown_lines(with_texts(top, spark, sf) if whole else top).select("topic", F.col("rank").cast("bigint").alias("rank"), "line")


def noise_samples(spark, sf):
    return A.noise_samples(_promoted(spark, sf)).select("article_ix", "title", "link", F.array_join(F.map_keys("signals"), " ").alias("signals"))


def topic_counts(spark, sf):
    """What each topic still has once the articles of a later feed batch were shown."""
    canon = R.canonical(_scored(spark, sf, False))
    seen = articles(spark, sf, ("rss",)).where("batch_no = 1").select("title", "link")
    return R.topic_counts(canon, seen)


def explained_pairs(spark, sf):
    """Pairs of equal URL or title with the parts of their similarity."""
    f = _features(spark, sf)
    return S.explained_pairs(S.exact_pairs(f).distinct(), f)


def _exact_matches(spark, sf):
    arts = written(A.with_features(articles(spark, sf)), "features")
    pairs = S.exact_pairs(arts).distinct().withColumn("similarity", F.lit(1.0))
    return M.article_matches(pairs, arts, DEFAULTS.hot_threshold), _exact_components(arts)


def article_matches(spark, sf):
    """Matches by equal URL or title; the pipeline's have the fuzzy ones too (all_article_matches)."""
    return _exact_matches(spark, sf)[0]


def cluster_matches(spark, sf):
    return M.cluster_matches(*_exact_matches(spark, sf)).withColumn("match_rank", F.col("match_rank").cast("bigint"))


def all_article_matches(spark, sf):
    arts = written(A.with_features(articles(spark, sf)), "features")
    f = arts.select("article_ix", *S.FEATURES)
    return M.article_matches(S.scored_pairs(S.candidate_pairs(f), f, DEFAULTS.hot_threshold), arts, DEFAULTS.hot_threshold)


def _selection(spark, sf):
    """(canonical rows, selected rows, topics) of the exact scores."""
    canon = written(R.canonical(_scored(spark, sf, False)), "canonical")
    topics = R.topic_order(canon, R.source_order(canon)).withColumn("topic_title", X.humanize_id(F.col("primary_topic")))
    return canon, written(R.top_per_topic(canon), "selected"), written(topics, "topics")


def merged_output(spark, sf):
    """Merged articles as JSON with their place in their source type, and fields of them read back."""
    d = D.merged_articles(R.canonical(_scored(spark, sf, False)))
    got = lambda p: F.get_json_object("json", f"$.{p}")
    return d.select("article_ix", "source_type", F.col("position").cast("bigint").alias("position"), got("title").alias("title"), got("primary_topic").alias("primary_topic"), got("final_score").cast("double").alias("final_score"), got("score_components.local_extra_score").cast("double").alias("extra"), F.contains("json", F.lit('"summary":')).alias("has_summary"))


def hotspot_items(spark, sf):
    """The items of the run's document, read back from its JSON."""
    canon, selected, topics = _selection(spark, sf)
    doc = D.hotspots_document(selected, canon, topics, DEFAULTS.now)
    kind = "topics array<struct<id:string,available_article_count:bigint,items:array<struct<rank:bigint,title:string,link:string,hotspot_score:double,source_type:string,metrics:struct<likes:bigint,comments:bigint>,selection_debug:struct<selection_order:bigint>>>>>"
    t = doc.select(F.explode(F.from_json("value", kind)["topics"]).alias("t")).select("t.id", "t.available_article_count", F.explode("t.items").alias("i"))
    return t.select(F.col("id").alias("topic"), F.col("available_article_count").alias("available"), "i.rank", "i.title", "i.link", "i.hotspot_score", "i.source_type", F.col("i.metrics.likes").alias("likes"), F.col("i.metrics.comments").alias("comments"), F.col("i.selection_debug.selection_order").alias("selection_order"))


def markdown_document(spark, sf):
    canon, selected, topics = _selection(spark, sf)
    fetched = {r["source_type"]: r["count"] for r in canon.groupBy("source_type").count().collect()}
    return D.markdown_document(selected, topics, generated_at=DEFAULTS.now, fetched=fetched)


def distribution(spark, sf):
    return R.distribution(articles(spark, sf)).select("source_type", "n")


def timing_summary(spark, sf):
    return diagnostics.timing_summary(diagnostics.normalized_traces(traces(spark, sf)), ["step_key"])


def slow_buckets(spark, sf):
    return diagnostics.slow_buckets(traces(spark, sf), ["step_key"])


def failed_items(spark, sf):
    return diagnostics.failed_items(diagnostics.normalized_traces(traces(spark, sf))).select("trace_id", "step_key", "error", "active_s")


def step_runs(spark, sf):
    return diagnostics.step_runs(traces(spark, sf))


def pipeline_status(spark, sf):
    return diagnostics.pipeline_status(diagnostics.step_runs(traces(spark, sf)), ["run_date"])


def health_history(spark, sf):
    runs = diagnostics.step_runs(traces(spark, sf)).withColumn("observed", F.col("run_date").cast("timestamp"))
    return diagnostics.health_history(runs, F.lit("2024-01-31 00:00:00").cast("timestamp")).drop("latest_error")


def overlay_merge(spark, sf):
    base = read(spark, sf, "feed_sources").select("source_id", "source_name", "topic", F.col("priority").cast("bigint").alias("priority"))
    over = read(spark, sf, "reddit_subreddits").select("source_id", "source_name", F.lit(None).cast("string").alias("topic"), F.lit(5).cast("bigint").alias("priority"))
    patch = base.where("priority >= 8").select("source_id", F.lit(None).cast("string").alias("source_name"), F.lit("pinned").alias("topic"), F.lit(None).cast("bigint").alias("priority"))
    return config.overlay_merge(base, over.unionByName(patch), "source_id")


def topic_labels(spark, sf):
    topics = read(spark, sf, "web_topics").select(F.col("topic_id").alias("id"), F.when(F.col("queries_ok") >= 4, F.concat(F.col("api_used"), F.lit(" / "), F.col("topic_id"))).alias("label"))
    rows = read(spark, sf, "rss_articles").where("topic is not null").groupBy("topic").agg(F.count("*").alias("n"))
    return config.with_topic_titles(rows, topics)


def config_violations(spark, sf):
    return config.source_violations(read(spark, sf, "reddit_subreddits"), read(spark, sf, "web_topics"), ["source_id", "source_name", "subreddit"])


def first_wins(spark, sf):
    d = read(spark, sf, "web_articles").where("link <> ''")
    return A.first_wins(d, [F.col("topic"), F.col("link")], [F.col("article_id")]).select("article_id", "topic", "link")


def html_clean(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", X.truncate(X.clean_html(F.col("text")), 240).alias("summary"))


def release_summary(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", X.release_summary(F.col("text")).alias("summary"))


def human_numbers(spark, sf):
    d = read(spark, sf, "reddit_articles").where("score is not null")
    said = F.when(F.col("article_id") % 3 == 0, F.concat(F.col("score").cast("string"), F.lit("万"))).when(F.col("article_id") % 3 == 1, F.concat(F.lit("约 "), F.format_string("%.1f", F.col("score") / 10), F.lit(" 亿 热度"))).otherwise(F.col("score").cast("string"))
    return d.select("article_id", numbers.human_number(said).alias("number"))


def stars_per_day(spark, sf):
    o = read(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("stars"), F.min("o_orderdate").alias("created"))
    age = F.greatest(F.lit(1), F.datediff(F.lit("2000-01-01").cast("date"), F.to_date("created")))
    return o.select("o_custkey", "stars", F.bround(F.col("stars") / age, 6).alias("daily"))


def window_cutoff(spark, sf):
    now = F.lit("2024-01-30 00:00:00").cast("timestamp")
    d = traces(spark, sf).where(F.unix_seconds("ts") >= F.unix_seconds(now) - 48 * 3600)
    return d.groupBy("run_date").agg(F.count("*").alias("n"))


def search_queries(spark, sf):
    d = read(spark, sf, "web_articles").where("web_query is not null").select("web_query").distinct()
    return d.select("web_query", X.search_query(F.col("web_query"), F.array(F.lit("press release"), F.lit("jobs"), F.lit(" "))).alias("query"))


def feed_dates(spark, sf):
    d = read(spark, sf, "rss_articles")
    return d.select("article_id", F.unix_seconds(dates.parse_feed_date(F.col("date"))).alias("second"))


def top_engaged(spark, sf):
    """Best five posts of each source by score, first met wins ties."""
    w = Window.partitionBy("source_id").orderBy(F.desc("score"), "article_id")
    d = read(spark, sf, "reddit_articles").where("score is not null and source_id is not null")
    return d.withColumn("rank", F.row_number().over(w)).where("rank <= 5").select("source_id", "article_id", F.col("rank").cast("bigint").alias("rank"), "score")


_CORE = (
    union_registry, norm_title, norm_url, noise_signals, noise_stressed, noise_removed, word_tokens, bigram_sets, history_anti_join, same_day_seen, candidate_pairs,
    pair_jaccard, comparable_pairs, fuzzy_pairs, exact_components, hot_scores, history_penalty, engagement_tiers, recency, fetch_rank, final_score,
    canonical_pick, cluster_topic, grouped_ranking, topic_order, round_robin_topn, markdown_lines, noise_samples, topic_counts, explained_pairs, article_matches, cluster_matches, all_article_matches, merged_output, hotspot_items, markdown_document, distribution, timing_summary, slow_buckets, failed_items,
    step_runs, pipeline_status, health_history, overlay_merge, topic_labels, config_violations, first_wins, html_clean, release_summary, human_numbers,
    stars_per_day, window_cutoff, search_queries, feed_dates, top_engaged,
)

_ALL = (final_score, canonical_pick, cluster_topic, topic_order, round_robin_topn, markdown_lines)


def queries() -> dict:
    return {f.__name__: f for f in _CORE} | services.queries() | operations.queries() | {f"all_{f.__name__}": partial(f, whole=True) for f in _ALL} | {
        "top_stories": top_stories,
        "p3_found": timestamps.p3_found,
        "p3_how": timestamps.p3_how,
        "p3_estimated_zones": timestamps.p3_estimated_zones,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql() | services.oracle_sql() | operations.oracle_sql()
