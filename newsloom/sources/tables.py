"""Adapters from the Parquet tables to one article schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.numbers import normalize_priority
from newsloom.params import REGISTRY

#: Columns of an article; others that a source has not are null.
ARTICLE = {
    "article_ix": "bigint", "article_id": "bigint", "source_type": "string", "source_id": "string", "source_name": "string", "source_priority": "int",
    "topic": "string", "title": "string", "link": "string", "reddit_url": "string", "external_url": "string", "date": "string", "summary": "string", "snippet": "string",
    "score": "bigint", "num_comments": "bigint", "replies": "bigint", "like_count": "bigint", "retweet_count": "bigint", "reply_count": "bigint", "fetched_at": "timestamp", "batch_no": "int",
}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_articles(df: DataFrame, source_type: str, **given: Column) -> DataFrame:
    """The article columns of a table. article_ix is the position in the union of all sources: step, then id."""
    step = REGISTRY.index(source_type) + 1
    have = set(df.columns)
    base = {"source_type": F.lit(source_type), "article_ix": F.lit(step * 10**13) + F.col("article_id"), "source_priority": F.lit(3)} | given
    cols = [(base[c] if c in base else F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in ARTICLE.items()]
    return df.select(*cols)


def with_priority(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Priority of the source by its id, as the merge reads it; 3 without a source."""
    known = catalogue.groupBy("source_id").agg(F.max("priority").alias("source_priority"))
    joined = df.drop("source_priority").join(known, "source_id", "left")
    return joined.withColumn("source_priority", normalize_priority(F.col("source_priority"))).select(*ARTICLE)


def articles(spark: SparkSession, sf: str, types: tuple[str, ...] = ("rss", "twitter", "google", "reddit"), enrich: bool = True) -> DataFrame:
    """UNION ALL of the article tables in registry order; enrich looks the priorities up."""
    parts = {}
    if "rss" in types:
        parts["rss"] = (as_articles(read(spark, sf, "rss_articles"), "rss"), "feed_sources")
    if "twitter" in types:
        m = {c: F.col(f"metrics.{c}") for c in ("like_count", "retweet_count", "reply_count")}
        parts["twitter"] = (as_articles(read(spark, sf, "twitter_articles"), "twitter", **m), "feed_sources")
    if "google" in types:
        parts["google"] = (as_articles(read(spark, sf, "web_articles"), "google"), None)
    if "reddit" in types:
        parts["reddit"] = (as_articles(read(spark, sf, "reddit_articles"), "reddit"), "reddit_subreddits")
    frames = [with_priority(df, read(spark, sf, cat)) if enrich and cat else df for df, cat in parts.values()]
    return reduce(DataFrame.unionByName, frames)


def traces(spark: SparkSession, sf: str) -> DataFrame:
    """Request traces from the events: ten events to a second of active time, total adds the k property."""
    e = read(spark, sf, "events")
    active = F.col("value") / 10
    return e.select(
        F.col("event_id").alias("trace_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("step"), (F.col("user_id") % 11).cast("string")).alias("step_key"),
        F.to_date("ts").alias("run_date"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("failed for user "), F.col("user_id").cast("string"))).alias("error"),
        active.alias("active_s"), (active + F.get_json_object("props", "$.k").cast("double") / 100).alias("total_s"),
    )
