"""Scores, canonical rows, topics, fair selection and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import dates
from newsloom.functions import text as X
from newsloom.functions.numbers import rounded
from newsloom.operators.articles import engagement, not_seen_today
from newsloom.params import DEFAULTS, REGISTRY, Params
from newsloom.session import written

ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
COMPONENTS = ("base_score", "rank_score", "history_score", "hot_score", "recency_score")


def with_base_scores(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return df.withColumn("base_score", F.col("source_priority").cast("double")).withColumn("extra_score", engagement(df, params).cast("double"))


def with_rank_scores(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """rank_score: from the full score for the first of its source type in equal steps to 0 for the last; alone it gets all.

    The order is one over the whole source type; a source type may hold any share of the rows, so positions come from a
    range-partitioned sort and the counts before each range, not from a window over one partition.
    """
    key = F.struct((-(F.col("base_score") + F.col("extra_score"))).alias("s"), X.text(F.col("title")).alias("t"), F.col("article_ix").alias("x"))
    ranked = positions(df, "source_type", key, "pos")
    n = ranked.groupBy("source_type").agg(F.count("*").alias("total"))
    ranked = ranked.join(F.broadcast(n), "source_type")  # one row a source type: at most as many as the registry has
    share = F.when(F.col("total") == 1, params.rank_score).otherwise(params.rank_score * (1.0 - (F.col("pos") - 1) / (F.col("total") - 1)))
    return ranked.withColumn("rank_score", rounded(share)).drop("total", "pos")


def positions(df: DataFrame, group: str, key: Column | str, out: str) -> DataFrame:
    """1-based position by key within group, by one range-partitioned sort: no task holds a group.

    Rows are numbered as they are sorted and written once, without a key that is a column of its own. A number holds its range
    and its place there; a row's position is its place after the first of its group in the range and what the ranges before
    hold of its group (a table of ranges and groups, some thousand rows, which is broadcast).
    """
    by = [F.col(group), F.col(key) if isinstance(key, str) else key]
    d = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("p_id", F.monotonically_increasing_id())
    d = written(d.drop(key) if isinstance(key, str) else d, "ranges").withColumn("p_range", F.shiftright("p_id", 33))
    sizes = d.groupBy(group, "p_range").agg(F.count("*").alias("p_n"), F.min("p_id").alias("p_first"))
    before = Window.partitionBy(group).orderBy("p_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "p_range", (F.coalesce(F.sum("p_n").over(before), F.lit(0)) - F.col("p_first") + 1).alias("p_off"))
    return d.join(F.broadcast(offsets), [group, "p_range"]).withColumn(out, F.col("p_id") + F.col("p_off")).drop("p_range", "p_id", "p_off")


def date_ts(column: str = "date") -> Column:
    """Instant of an article's date as ISO text; text without a zone is in the session's zone; null where it is no such text."""
    return F.when(F.col(column).rlike(ISO), F.col(column).try_cast("timestamp"))


def with_recency(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return df.withColumn("recency_score", dates.recency_score(date_ts(), F.lit(params.now).cast("timestamp")))


def hot_scores(members: DataFrame, components: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """article_ix, hot_score: steps for every further source type in the article's hot component, up to the cap.

    members: article_ix, source_type; components: vertex, component.
    """
    c = components.join(members, components["vertex"] == members["article_ix"])
    kinds = c.groupBy("component").agg(F.count_distinct(F.nullif("source_type", F.lit(""))).alias("kinds"))
    score = F.least(F.lit(params.hot_cap), params.hot_step * F.greatest(F.col("kinds") - 1, F.lit(0)))
    return c.join(kinds, "component").select("article_ix", score.alias("hot_score"))


def with_final_score(df: DataFrame) -> DataFrame:
    return df.withColumn("final_score", rounded(sum((F.coalesce(F.col(c), F.lit(0.0)) for c in COMPONENTS), F.lit(0.0))))


def canonical(df: DataFrame) -> DataFrame:
    """One row per duplicate component: the best by final, extra, title; the first wins ties. df has component.

    Adds cluster_size, multi_source, first_ix, primary_topic (the topic of most score; ties to the larger name) and
    topic_candidates. Aggregations only, so a component of any size is combined map-side; the best row is carried by them
    whole, so that rows aren't shuffled again to be joined.
    """
    topic = F.when(F.trim(X.text(F.col("topic"))) == "", "uncategorized").otherwise(F.trim("topic"))
    d = df.withColumn("c_topic", topic)
    best = F.max_by(F.struct(*[F.col(c) for c in df.columns if c != "component"]), F.struct("final_score", "extra_score", X.text(F.col("title")), -F.col("article_ix")))
    # several source types: a distinct count would shuffle the rows once more
    several = F.coalesce(F.min("source_type") != F.max("source_type"), F.lit(False))
    heads = d.groupBy("component").agg(best.alias("best"), F.count("*").alias("cluster_size"), several.alias("multi_source"), F.min("article_ix").alias("first_ix"))
    heads = heads.select("component", "best.*", "cluster_size", "multi_source", "first_ix")
    per = d.groupBy("component", "c_topic").agg(F.sum("final_score").alias("s"), F.count("*").alias("n"))
    topics = per.groupBy("component").agg(
        F.max_by("c_topic", F.struct("s", "c_topic")).alias("primary_topic"),
        F.array_sort(F.collect_list(F.struct((-rounded(F.col("s"))).alias("minus"), F.col("c_topic").alias("topic"), F.col("n").alias("count")))).alias("t"),
    )
    candidates = F.transform("t", lambda x: F.struct(x["topic"].alias("topic"), (-x["minus"]).alias("score"), x["count"].alias("count")))
    topics = topics.select("component", "primary_topic", candidates.alias("topic_candidates"))
    return heads.join(topics, "component")


def source_order(df: DataFrame) -> DataFrame:
    """source_type, source_order: by the best article of each, ties to the one met first."""
    best = df.groupBy("source_type").agg(F.min(F.struct((-F.col("final_score")).alias("s"), F.col("first_ix").alias("x"))).alias("b"))
    return best.select("source_type", (F.row_number().over(Window.orderBy("b")) - 1).alias("source_order"))  # one row a source type


def top_per_topic(df: DataFrame, params: Params = DEFAULTS, candidates: bool = False) -> DataFrame:
    """Round-robin over source types within each topic: turn t takes each source's t-th article, up to top_n.

    Adds turn, selection_order and rank (display order: score, source order, title). Only the first top_n articles of a
    (topic, source type) can be taken, so the windows run over a bounded remainder.
    """
    order = source_order(df)
    d = df.join(F.broadcast(order), "source_type")  # at most one row per registered source type
    place = Window.partitionBy("primary_topic", "source_type").orderBy(F.desc("final_score"), "first_ix")
    d = d.withColumn("turn", F.row_number().over(place)).where(F.col("turn") <= params.top_n)
    pick = Window.partitionBy("primary_topic").orderBy("turn", "source_order")
    d = d.withColumn("selection_order", F.row_number().over(pick)).where(F.col("selection_order") <= params.top_n)
    shown = Window.partitionBy("primary_topic").orderBy(F.desc("final_score"), "source_order", X.text(F.col("title")), "first_ix")
    return d.withColumn("rank", F.row_number().over(shown))


def topic_order(df: DataFrame, order: DataFrame) -> DataFrame:
    """topic, available, topic_rank: topics by their best article (score, source order, title), seen ones included."""
    d = df.join(F.broadcast(order), "source_type")
    best = d.groupBy("primary_topic").agg(F.count("*").alias("available"), F.min(F.struct((-F.col("final_score")).alias("s"), F.col("source_order").alias("o"), X.text(F.col("title")).alias("t"))).alias("b"))
    return best.select("primary_topic", "available", F.row_number().over(Window.orderBy("b", "primary_topic")).alias("topic_rank"))


def topic_counts(canon: DataFrame, seen: DataFrame) -> DataFrame:
    """primary_topic, available, remaining: canonical rows of each topic, and those that today's outputs (title, link) don't hold."""
    left = not_seen_today(canon, seen).groupBy("primary_topic").agg(F.count("*").alias("left"))
    every = canon.groupBy("primary_topic").agg(F.count("*").alias("available"))
    return every.join(left, "primary_topic", "left").select("primary_topic", "available", F.coalesce("left", F.lit(0)).alias("remaining"))


def distribution(df: DataFrame) -> DataFrame:
    """source_type, n for every registered type, zero-filled."""
    spark = df.sparkSession
    registry = spark.createDataFrame([(i, t) for i, t in enumerate(REGISTRY, 1)], "step int, source_type string")
    return registry.join(df.groupBy("source_type").agg(F.count("*").alias("n")), "source_type", "left").select("step", "source_type", F.coalesce("n", F.lit(0)).alias("n"))


def metrics_text() -> Column:
    """`likes=5, comments=3` in fixed order, without missing and zero values."""
    parts = [("likes", "like_count"), ("comments", "num_comments"), ("replies", "reply_count"), ("retweets", "retweet_count"), ("score", "score")]
    shown = [F.when(F.coalesce(F.col(c), F.lit(0)) != 0, F.concat(F.lit(f"{k}="), F.col(c).cast("string"))) for k, c in parts]
    return F.concat_ws(", ", *shown)


def markdown_lines(selected: DataFrame) -> DataFrame:
    """topic, rank, line of each selected item."""
    title = X.first_filled(F.col("title"), F.col("link"))
    summary = X.collapse(X.first_filled(F.col("snippet"), F.col("summary")))
    source = F.concat_ws(" - ", F.nullif(X.text(F.col("source_type")), F.lit("")), F.nullif(X.text(F.col("source_name")), F.lit("")))
    metrics = metrics_text()
    line = F.concat(
        F.col("rank").cast("string"), F.lit(". ⭐"), F.format_string("%.1f", F.bround("final_score", 1)), F.lit(" | "), title,
        F.when(summary != "", F.concat(F.lit(" - "), summary)).otherwise(""), F.lit(" | *"), source, F.lit("*"),
        F.when(metrics != "", F.concat(F.lit(" | *"), metrics, F.lit("*"))).otherwise(""),
    )
    return selected.select(F.col("primary_topic").alias("topic"), "rank", line.alias("line"))
