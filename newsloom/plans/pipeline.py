"""The whole pipeline as one plan: noise, history, similarity, components, scores, canonical rows, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import url as U
from newsloom.operators import articles as A
from newsloom.operators import near as N
from newsloom.operators import ranking as R
from newsloom.operators import similarity as S
from newsloom.operators.graph import connected_components
from newsloom.params import DEFAULTS, Params
from newsloom.session import forget, written
from newsloom.sources.tables import ARTICLE, articles


#: What scores, canonical rows and selection read of an article; the rest is joined to the few that are selected.
SCORED = ("article_ix", "source_type", "title", "topic")


def fresh_articles(arts: DataFrame, archive: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Rows of articles with features and scores of their own, less noise and what the archive (norm_title, norm_link) holds: not_in_history.

    Rows are made and written in one pass, without a shuffle: a filter of fixed size tells which may be archived, and only
    these are joined with the archive, by the keys themselves.
    """
    key = lambda n, c: F.xxhash64(F.lit(n), c)
    titles, links = (archive.where(F.col(c) != "").select(F.col(c).alias(h)).distinct() for c, h in (("norm_title", "h_title"), ("norm_link", "h_link")))
    held = N.may_hold(N.bloom(titles.select(key(0, "h_title").alias("token")).unionByName(links.select(key(1, "h_link").alias("token")))))
    made = A.with_features(R.with_recency(R.with_base_scores(A.without_noise(arts, params).select(*ARTICLE), params), params))
    # the keys of not_in_history: those of the title and the link themselves where these are filled
    title, link = (X.text(F.col(c)) != "" for c in ("title", "link"))
    made = made.withColumns({
        "k_title": F.when(title, F.col("norm_title")).otherwise(X.normalize_title(F.when(~title, A.display_title()))),
        "k_link": F.when(link, F.col("norm_url")).otherwise(U.normalize_url(A.primary_link())),
    })
    made = made.withColumn("met", held(key(0, "k_title")) | held(key(1, "k_link")))
    own = (*SCORED, "base_score", "extra_score", "recency_score", "norm_title", "norm_url", "domain")  # no token sets, no texts that no score reads
    rows = written(made.select(*own, "met", *[F.when(F.col("met"), F.col(c)).alias(c) for c in ("k_title", "k_link")]), "articles")
    met = written(A.without_keys(rows.where("met"), titles, links).select(*own), "met")
    return rows.where(~F.col("met")).select(*own).unionByName(met)


def scored_articles(arts: DataFrame, history: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Articles (SCORED) with all scores and their duplicate component. history: article_ix, title, link of the archive.

    What is returned is read from rows that are written; it need not be written again.
    """
    archive = written(history.select("article_ix", X.normalize_title(F.col("title")).alias("norm_title"), U.normalize_url(F.col("link")).alias("norm_link")), "archive")
    archived = S.as_titles(archive.select("article_ix", "norm_title"))
    rows = fresh_articles(arts, archive, params)  # used by five branches; the title UDF runs once
    feats = rows.select("article_ix", "norm_title", X.compact(F.col("norm_title")).alias("compact_title"), "norm_url", "domain")
    pairs = S.near_pairs(feats, params.hot_threshold, params)
    # equal URLs have similarity 1, so they need no look of their own
    duplicate = pairs.where(F.col("similarity") >= min(params.duplicate_threshold, 1.0)).select(F.col("i").alias("src"), F.col("j").alias("dst"))
    kinds = rows.select("article_ix", "source_type")
    a, b = (kinds.select(F.col("article_ix").alias(ix), F.col("source_type").alias(t)) for ix, t in (("i", "ta"), ("j", "tb")))
    hot = pairs.join(a, "i").join(b, "j").where("ta <> tb").select(F.col("i").alias("src"), F.col("j").alias("dst"))
    dup = connected_components(duplicate).withColumnRenamed("vertex", "article_ix")
    scored = (
        rows.select(*SCORED, "base_score", "extra_score", "recency_score")
        .join(S.history_scores(feats, archived, params).select("article_ix", "history_score"), "article_ix", "left")
        .join(R.hot_scores(kinds, connected_components(hot), params), "article_ix", "left")
        .join(dup, "article_ix", "left")
        .withColumn("component", F.coalesce("component", "article_ix"))
    )
    final = R.with_final_score(R.with_rank_scores(scored, params))  # reads the positions' rows alone
    for run in (rows, archive, pairs):
        forget(run)
    return final


def scored_stories(spark, sf: str, params: Params = DEFAULTS) -> DataFrame:
    """scored_articles over all article tables; batch 0 of the feeds is the archive."""
    arts = articles(spark, sf)
    history = arts.where((F.col("source_type") == "rss") & (F.col("batch_no") == 0)).select("article_ix", "title", "link")
    fresh = arts.where((F.col("source_type") != "rss") | (F.col("batch_no") > 0))
    return scored_articles(fresh, history, params)


def with_texts(selected: DataFrame, spark, sf: str) -> DataFrame:
    """The articles' other columns beside selected rows, which are few: they are written first, so that Spark sees their size."""
    return written(selected, "selected").join(articles(spark, sf).select("article_ix", *[c for c in ARTICLE if c not in SCORED]), "article_ix")


def top_stories(spark, sf: str, params: Params = DEFAULTS) -> DataFrame:
    """Top articles per topic over all article tables."""
    top = with_texts(R.top_per_topic(written(R.canonical(scored_stories(spark, sf, params)), "canonical"), params), spark, sf)
    return top.select(F.col("primary_topic").alias("topic"), "rank", "selection_order", "title", "link", "source_type", "source_name", "final_score", "cluster_size", "multi_source")
