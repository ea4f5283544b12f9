"""Output documents: merged articles, hotspot items, the document of a run, and its Markdown, as JSON or lines.

Documents hold selected articles only (top-N of each topic), so folding them into one row is bounded.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import ranking as R
from newsloom.operators.articles import display_title, primary_link
from newsloom.params import DEFAULTS, Params

# Score components by the name they have in documents, and the fields of a merged article.
COMPONENTS = {
    "base_priority_score": "base_score",
    "fetch_local_rank_score": "rank_score",
    "history_score": "history_score",
    "cross_source_hot_score": "hot_score",
    "recency_score": "recency_score",
    "local_extra_score": "extra_score",
}
FIXED = ("title", "link", "date", "primary_topic", "source_type", "source_id", "source_name", "source_priority", "final_score", "score_components")
OPTIONAL = (
    "summary", "snippet", "metrics", "replies", "num_comments", "score", "reddit_url", "external_url", "google_query", "twitter_query", "reddit_query", "name", "repo",
    "published_at", "cross_source_matches", "topic_candidates",
)
FORMULA = "base_priority_score + fetch_local_rank_score + history_score + cross_source_hot_score + recency_score"


def score_components(df: DataFrame) -> Column:
    """struct of all components, 0 where one is missing."""
    return F.struct(*[(F.coalesce(F.col(c), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(n) for n, c in COMPONENTS.items()])


def joined_objects(*objects: Column) -> Column:
    """One JSON object of several."""
    inner = F.filter(F.array(*[F.substring(o, F.lit(2), F.length(o) - 2) for o in objects]), lambda x: x != "")
    return F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}"))


def article_json(df: DataFrame) -> Column:
    """A merged article: the fixed fields, null or not, and the optional ones that are filled."""
    have = set(df.columns)
    value = {"score_components": score_components(df), "primary_topic": F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("primary_topic", "topic") if c in have])}
    fixed = F.struct(*[(value[c] if c in value else F.col(c)).alias(c) for c in FIXED])
    optional = F.struct(*[F.col(c) for c in OPTIONAL if c in have])
    return joined_objects(F.to_json(fixed, {"ignoreNullFields": "false"}), F.to_json(optional))


def merged_articles(df: DataFrame) -> DataFrame:
    """source_type, position (by final score, title), json of every article; no document holds them all."""
    rows = df.withColumns({"json": article_json(df), "o": F.struct((-F.col("final_score")).alias("s"), X.text(F.col("title")).alias("t"), F.col("article_ix").alias("x"))})
    return R.positions(rows.select("article_ix", "source_type", "json", "o"), "source_type", "o", "position").drop("o")


def item_json(df: DataFrame) -> Column:
    """A hotspot item with its score and selection explained. df: rows of top_per_topic, with source_position and source_total if known."""
    have = set(df.columns)
    rounded = F.bround("final_score", 1)
    metric = lambda c: F.nullif(F.col(c), F.lit(0)) if c in have else F.lit(None).cast("bigint")
    metrics = F.struct(metric("like_count").alias("likes"), metric("retweet_count").alias("retweets"), F.coalesce(metric("reply_count"), metric("replies")).alias("replies"), metric("num_comments").alias("comments"), metric("score").alias("score"))
    published = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("date", "published_at") if c in have])
    place = lambda c: F.coalesce(F.col(c), F.lit(0)) if c in have else F.lit(0)
    score = F.struct(F.col("final_score").alias("final_score"), rounded.alias("hotspot_score"), F.lit(FORMULA).alias("formula"), score_components(df).alias("components"))
    chosen = F.struct(place("source_position").alias("source_type_rank"), place("source_total").alias("source_type_total_candidates"), F.lit(True).alias("selected_after_same_day_dedup"), F.lit(True).alias("selected_by_round_robin"), F.col("selection_order"), F.col("rank").alias("display_rank"))
    matches = [F.col("cross_source_matches")] if "cross_source_matches" in have else []
    return F.to_json(
        F.struct(
            "rank", F.col("primary_topic").alias("topic"), display_title().alias("title"), primary_link().alias("link"), rounded.alias("hotspot_score"), "source_type", X.text(F.col("source_name")).alias("source_name"), *matches,
            F.trim(X.first_filled(F.col("snippet"), F.col("summary"))).alias("summary"), metrics.alias("metrics"), published.alias("published_at"), score.alias("score_debug"), chosen.alias("selection_debug"),
        )
    )


def topic_rows(selected: DataFrame, topics: DataFrame) -> DataFrame:
    """topic_rank, id, title, available, items (array of JSON in order of rank) of the topics with their selected articles.

    topics: primary_topic, available, topic_rank, topic_title.
    """
    made = selected.select("primary_topic", F.struct(F.col("rank"), item_json(selected).alias("json")).alias("item"))
    items = made.groupBy("primary_topic").agg(F.array_sort(F.collect_list("item")).alias("i"))
    rows = topics.join(items, "primary_topic", "left")
    left = F.col("remaining") if "remaining" in topics.columns else F.col("available")
    return rows.select("topic_rank", F.col("primary_topic").alias("id"), F.col("topic_title").alias("title"), "available", left.alias("remaining"), F.coalesce(F.transform("i", lambda x: x["json"]), F.array().cast("array<string>")).alias("items"))


def scoring_config(params: Params = DEFAULTS) -> dict:
    """The settings that made the scores, as they are shown beside them."""
    return {
        "fetch_rank_max_score": params.rank_score, "history_threshold": min(t for t, _ in params.history_tiers), "history_score_rules": [{"threshold": t, "score": v} for t, v in params.history_tiers],
        "cross_source_hot_threshold": params.hot_threshold, "duplicate_threshold": params.duplicate_threshold, "cross_source_hot_score_per_extra_type": params.hot_step, "cross_source_hot_score_cap": params.hot_cap,
        "recency_24h_score": 1.0, "recency_6h_score": 1.5,
    }


def processing_summary(input_total: int, archived_titles: int, archived_links: int, params: Params = DEFAULTS) -> dict:
    """What was done to the input of a merge."""
    return {
        "deduplication_applied": True, "noise_filter_applied": True, "previous_hotspots_scoring_applied": archived_titles > 0, "previous_hotspots_exact_link_index_applied": archived_links > 0, "scoring_applied": True,
        "scoring_version": "2.0", "score_formula": FORMULA, "scoring_config": scoring_config(params), "input_total_articles": input_total,
    }


def merged_head(canon: DataFrame, inputs: DataFrame, generated_at: str, archived: tuple[int, int] = (0, 0), params: Params = DEFAULTS) -> str:
    """JSON of a merge but its articles (those are merged_articles): input and output by source type, and the processing. inputs: ranking.distribution."""
    counted = lambda d, c: {r["source_type"]: r[c] for r in d.collect()}  # noqa: E731  # a row a source type
    had, out = counted(inputs, "n"), counted(canon.groupBy("source_type").count(), "count")
    total = sum(had.values())
    return json.dumps({
        "generated": generated_at, "input_stats": {"total_articles": total, "source_type_distribution": had},
        "output_stats": {"total_articles": sum(out.values()), "source_types_count": len(out), "source_type_distribution": out}, "processing": processing_summary(total, *archived, params),
    }, ensure_ascii=False)


def similarity_debug(df: DataFrame) -> Column:
    """Why an article stands where it does among similar ones: history, merged cluster, other source types that tell its story."""
    have = set(df.columns)
    value = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in have else F.lit(default)
    group = F.struct((value("cluster_size", 1) > 1).alias("merged"), value("cluster_size", 1).cast("bigint").alias("cluster_size"))
    hot = F.struct((value("hot_score", 0.0) / DEFAULTS.hot_step).cast("int").alias("matched_source_type_count"), value("hot_score", 0.0).alias("score"))
    return F.struct(value("history_similarity", 0.0).alias("history_similarity"), (value("history_score", 0.0) < 0).alias("history_duplicate"), group.alias("duplicate_group"), hot.alias("cross_source_hot"))


def hotspots_document(selected: DataFrame, candidates: DataFrame, topics: DataFrame, generated_at: str) -> DataFrame:
    """One row, one JSON text: counts by source type, and the topics with their items.

    candidates: all canonical rows; topics: see topic_rows, with remaining where something of today was seen before.
    """
    counted = lambda d: {r["source_type"]: r["count"] for r in d.where("source_type <> ''").groupBy("source_type").count().collect()}  # noqa: E731  # a row a source type
    picked, had = counted(selected), counted(candidates)
    as_map = lambda c: F.create_map(*[x for k, v in sorted(c.items()) for x in (F.lit(k), F.lit(v))]) if c else F.create_map().cast("map<string,bigint>")
    t = topic_rows(selected, topics)
    one = joined_objects(F.to_json(F.struct("id", "title", F.col("available").alias("available_article_count"), F.col("remaining").alias("remaining_article_count"))), F.concat(F.lit('{"items":['), F.array_join("items", ","), F.lit("]}")))
    whole = t.select("topic_rank", one.alias("json")).agg(F.array_sort(F.collect_list(F.struct("topic_rank", "json"))).alias("t"))
    head = F.to_json(F.struct(F.lit(generated_at).alias("generated_at"), F.lit(sum(picked.values())).alias("total_articles"), as_map(picked).alias("source_type_counts"), F.lit(sum(had.values())).alias("candidate_total_articles"), as_map(had).alias("candidate_source_type_counts")))
    return whole.select(joined_objects(head, F.concat(F.lit('{"topics":['), F.array_join(F.transform("t", lambda x: x["json"]), ","), F.lit("]}"))).alias("value"))


def summary_line(mode: str, total: int, fetched: dict[str, int], selected: dict[str, int], failed: dict[str, int], generated_at: str) -> str:
    """Front-matter line over all source types that stand in any of the counts."""
    types = sorted(set(fetched) | set(selected) | set(failed))
    parts = [f"mode:{mode}", f"total_articles:{total}", *[f"{t}({fetched.get(t, 0)}→{selected.get(t, 0)},fail={failed.get(t, 0)})" for t in types], f"generated_at:{generated_at}"]
    return "summary: " + " | ".join(parts)


def markdown_document(selected: DataFrame, topics: DataFrame, *, generated_at: str, mode: str = "daily", fetched: dict[str, int] | None = None, failed: dict[str, int] | None = None, extra: str = "") -> DataFrame:
    """line_no, line of the whole Markdown: front matter, heading, a section a topic with its items, what is added at the end.

    selected: rows of top_per_topic (at most top-N a topic); topics: primary_topic, topic_rank, topic_title. A topic without items keeps its heading.
    """
    spark = selected.sparkSession
    picked = {r["source_type"]: r["count"] for r in selected.where("source_type <> ''").groupBy("source_type").count().collect()}  # a row a source type
    head = ["---", summary_line(mode, sum(picked.values()), fetched or {}, picked, failed or {}, generated_at), "---", f"# {generated_at[:10] or '<DATE>'} {mode} 全球科技与 AI 热点", ""]
    place = topics.select("primary_topic", "topic_rank")
    lines = R.markdown_lines(selected).join(place, F.col("topic") == F.col("primary_topic")).select("topic_rank", F.col("rank").cast("int").alias("part"), "line")
    titles = topics.select("topic_rank", F.lit(0).alias("part"), F.concat(F.lit("## "), "topic_title").alias("line"))
    ends = topics.select("topic_rank", F.lit(2**31 - 1).alias("part"), F.lit("").alias("line"))
    first = spark.createDataFrame([(0, i, x) for i, x in enumerate(head)], "topic_rank int, part int, line string")
    last = spark.createDataFrame([(2**31 - 1, 0, extra.strip())] if extra.strip() else [], "topic_rank int, part int, line string")
    every = first.unionByName(titles).unionByName(lines).unionByName(ends).unionByName(last)
    numbered = every.withColumn("line_no", F.row_number().over(Window.orderBy("topic_rank", "part")))  # bounded by topics x top-N
    tail = numbered.where("line <> ''").agg(F.max("line_no")).first()[0]
    return numbered.where(F.col("line_no") <= tail).select(F.col("line_no").cast("bigint").alias("line_no"), "line")
