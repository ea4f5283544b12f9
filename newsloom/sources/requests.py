"""What to ask of services and what came of it, as rows: source lists, request texts, limits, cooldown, retries, caches.

No request is made here; these are the decisions around one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import url as U

# Answers and texts of failures that pass.
PASSING_CODES = (408, 425, 429, 500, 502, 503, 504)
PASSING_TEXTS = r"timed out|timeout|tempor|connection reset|connection aborted"
# Commands of the sites that answer through a browser.
COMMANDS = {"twitter": "twitter/tweets", "twitter_topic": "twitter/search", "google": "google/news", "reddit": "reddit/hot", "reddit_topic": "reddit/search", "v2ex": "v2ex/hot", "zhihu": "zhihu/hot", "weibo": "weibo/hot", "toutiao": "toutiao/hot"}


def active_sources(sources: DataFrame, required: str | None = None) -> DataFrame:
    """Sources that are enabled (so if nothing is said), with the required field filled."""
    out = sources.where(F.coalesce(F.col("enabled"), F.lit(True))) if "enabled" in sources.columns else sources
    return out.where(F.trim(X.text(F.col(required).cast("string"))) != "") if required else out


def topic_queries(topics: DataFrame, column: str, only: str | None = None) -> DataFrame:
    """topic, query_ix, query, exclude: one row a filled query. topics: id, exclude array<string> and the queries' column."""
    rows = topics if only is None else topics.where(F.col("id") == only)
    found = rows.select(F.col("id").alias("topic"), F.coalesce("exclude", F.array().cast("array<string>")).alias("exclude"), F.posexplode(column).alias("query_ix", "query"))
    return found.where(F.trim(X.text(F.col("query"))) != "")


def trending_search(query: Column, cutoff: Column, min_stars: int, per_topic: int) -> Column:
    """Address of a repository search: pushed after the cutoff's day, stars above the least, most starred first."""
    q = F.concat(query, F.lit(" pushed:>"), F.date_format(cutoff, "yyyy-MM-dd"), F.lit(f" stars:>{min_stars}"))
    return F.concat(X.search_url("https://api.github.com/search/repositories?q=", q), F.lit(f"&sort=stars&order=desc&per_page={per_topic}"))


def result_count(value: Column, default: int) -> Column:
    """At least 1; the default where the setting is missing or no number."""
    return F.greatest(F.lit(1), F.coalesce(value.try_cast("int"), F.lit(default)))


def command(kind: str, *arguments: Column) -> Column:
    """Arguments of a site's command, all text."""
    return F.array(F.lit(COMMANDS[kind]), *[a.cast("string") for a in arguments])


def reddit_period(hours: Column) -> Column:
    return F.when(hours <= 48, "day").otherwise("week")


def passing_failure(code: Column, error: Column) -> Column:
    """Whether a retry may help: by the answer's code where there is one, else by the error's text."""
    return F.when(code.isNotNull(), code.isin(*PASSING_CODES)).otherwise(F.lower(X.text(error)).rlike(PASSING_TEXTS))


def login_wall(error: Column) -> Column:
    """Whether an error means that every further search would fail too."""
    e = F.lower(X.text(error))
    return F.contains(e, F.lit("http 403")) & F.contains(e, F.lit("please log in to https://www.reddit.com"))


def until_login_wall(calls: DataFrame, order: str = "call_ix") -> DataFrame:
    """Calls up to the first that met a login wall, that one included; later ones are skipped. calls: error and an order."""
    wall_at = calls.where(login_wall(F.col("error"))).agg(F.min(order)).first()[0]
    return calls if wall_at is None else calls.where(F.col(order) <= wall_at)


def retry_delay(attempt: Column, delay_s: float = 2.0) -> Column:
    """Seconds before the attempt after this one (from 0): twice as long each time."""
    return F.lit(delay_s) * F.pow(F.lit(2.0), attempt)


def cooled_starts(calls: DataFrame, cooldowns: DataFrame) -> DataFrame:
    """calls (url, call_ix, elapsed_s) with host and start_s: calls to one host keep its cooldown between their starts.

    cooldowns: host, cooldown_s. A host has as many calls as a run asks of it.
    """
    d = calls.withColumn("host", U.url_host(F.col("url"))).join(cooldowns.withColumnRenamed("host", "c_host"), F.col("host") == F.col("c_host"), "left").drop("c_host")
    before = Window.partitionBy("host").orderBy("call_ix").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.greatest(F.coalesce("cooldown_s", F.lit(0.0)), F.col("elapsed_s"))
    return d.withColumn("start_s", F.coalesce(F.sum(gap).over(before), F.lit(0.0))).drop("cooldown_s")


def conditional_requests(sources: DataFrame, cache: DataFrame, now: Column, ttl_hours: int = 24) -> DataFrame:
    """sources (url) with if_none_match and if_modified_since from a cache that is young enough. cache: url, etag, last_modified, seen_at."""
    young = cache.where(F.unix_seconds(now) - F.unix_seconds("seen_at") < ttl_hours * 3600)
    c = young.groupBy(F.col("url").alias("c_url")).agg(F.max_by("etag", "seen_at").alias("if_none_match"), F.max_by("last_modified", "seen_at").alias("if_modified_since"))
    return sources.join(c, F.col("url") == F.col("c_url"), "left").drop("c_url")


def updated_cache(cache: DataFrame, answers: DataFrame) -> DataFrame:
    """The cache after a run: an answer with a validator replaces its address's entry. answers: url, etag, last_modified, seen_at."""
    new = answers.where(F.col("etag").isNotNull() | F.col("last_modified").isNotNull()).select("url", "etag", "last_modified", "seen_at")
    rows = cache.select("url", "etag", "last_modified", "seen_at", F.lit(0).alias("new")).unionByName(new.withColumn("new", F.lit(1)))
    best = F.max_by(F.struct("etag", "last_modified", "seen_at"), F.struct("new", "seen_at")).alias("v")
    return rows.groupBy("url").agg(best).select("url", "v.*")


def still_fresh(written_at: Column, now: Column, hours: float = 1.0) -> Column:
    """Whether an output is too young to be made again."""
    return F.coalesce(F.unix_seconds(now) - F.unix_seconds(written_at) < hours * 3600, F.lit(False))
