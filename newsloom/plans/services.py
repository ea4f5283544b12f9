"""Queries of the service forms: rows of the tables are put into the services' answers and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.sources import payloads as P
from newsloom.sources import requests
from newsloom.sources.tables import read


def _answer(df: DataFrame, key: str, **fields: Column) -> DataFrame:
    """article_id, payload: an answer with one item under key ('' for a bare list)."""
    one = F.array(F.struct(*[v.alias(k) for k, v in fields.items()]))
    return df.select("article_id", F.to_json(F.struct(one.alias(key)) if key else one).alias("payload"))


def tweet_rows(spark, sf):
    m = F.col("metrics")
    d = _answer(read(spark, sf, "twitter_articles"), "tweets", text=F.col("title"), url=F.col("link"), created_at=F.lit("Mon Sep 15 10:00:00 +0000 2025"), likes=m["like_count"], retweet_count=m["retweet_count"], replies=m["reply_count"], quotes=m["quote_count"], impressions=m["impression_count"], id=F.col("tweet_id"), author=F.col("source_name"))
    return P.tweets(d).select("article_id", "title", "link", "source_name", "like_count", "retweet_count", "reply_count", "quote_count", "impression_count", "tweet_id", F.unix_seconds("date_ts").alias("second"))


def post_rows(spark, sf):
    inner = lambda **f: F.struct(*[v.alias(k) for k, v in f.items()])
    data = inner(title=F.col("title"), permalink=F.regexp_replace("reddit_url", "^https://www.reddit.com", ""), external_url=F.col("external_url"), created_utc=F.unix_seconds("fetched_at"), score=F.col("score"), num_comments=F.col("num_comments"), link_flair_text=F.col("flair"), is_self=F.col("is_self"), subreddit=F.col("source_name"), upvote_ratio=F.col("metrics.upvote_ratio"))
    d = _answer(read(spark, sf, "reddit_articles"), "children", kind=F.lit("t3"), data=data)
    return P.posts(d, 10).select("article_id", "title", "link", "reddit_url", "external_url", "date", "score", "num_comments", "flair", "is_self", "source_name", "upvote_ratio")


def google_rows(spark, sf):
    d = _answer(read(spark, sf, "web_articles"), "results", title=F.col("title"), url=F.col("link"), snippet=F.col("snippet"), timestamp=F.unix_seconds("fetched_at"), source=F.col("topic"))
    return P.google_news(d).select("article_id", "title", "link", "summary", "date", "publisher", "source_name")


def v2ex_rows(spark, sf):
    d = _answer(read(spark, sf, "reddit_articles"), "", title=F.col("title"), url=F.col("link"), content=F.col("flair"), created=F.unix_seconds("fetched_at"), replies=F.col("num_comments"), author=F.col("source_name"), node=F.col("topic"), nodeSlug=F.upper("topic"), id=F.col("article_id"))
    return P.v2ex_topics(d).select("article_id", "title", "link", "date", "summary", "replies", "author", "node", "node_slug", "v2ex_id")


def zhihu_rows(spark, sf):
    target = F.struct(F.col("title").alias("title"), F.col("article_id").alias("id"), F.col("snippet").alias("excerpt"), (F.col("article_id") % 7).alias("answer_count"))
    d = _answer(read(spark, sf, "web_articles"), "questions", target=target, hot_text=F.concat(F.col("article_id").cast("string"), F.lit(" 万热度")), url=F.when(F.col("article_id") % 2 == 0, F.col("link")))
    return P.zhihu_questions(d).select("article_id", "title", "link", "summary", "question_id", "hot_score", "answer_count", "follower_count")


def weibo_rows(spark, sf):
    kind = F.col("article_id") % 3
    link = F.when(kind == 0, F.lit("//w.example/a")).when(kind == 1, F.lit("/b"))
    d = _answer(read(spark, sf, "web_articles").where("title rlike '^[ -~]*$'"), "realtime", note=F.col("title"), scheme=link, label_name=F.col("topic"), raw_hot=F.lit("1,234"), realpos=kind)
    return P.weibo_hot(d).select("article_id", "title", "link", "summary", "hot_score", "rank")


def toutiao_rows(spark, sf):
    kind = F.col("article_id") % 3
    link = F.when(kind == 0, F.lit("//w.example/a")).when(kind == 1, F.lit("/b")).otherwise(F.lit("https://t.example/c"))
    d = _answer(read(spark, sf, "web_articles"), "news", word=F.col("title"), share_url=link, abstract=F.col("snippet"), hot_value=F.lit("1.5万"), position=kind)
    return P.toutiao_hot(d).select("article_id", "title", "link", "summary", "hot_score", "rank")


def api_rows(spark, sf):
    """One answer a row, in turn of each registered API and of an unknown one."""
    kind = F.col("article_id") % 4
    source = F.when(kind == 0, "weibo-api").when(kind == 1, "wallstreetcn-api").when(kind == 2, "tencent-api").otherwise("other-api")
    j = lambda **f: F.struct(*[v.alias(k) for k, v in f.items()])
    weibo = F.to_json(j(data=j(realtime=F.array(j(word=F.col("title"), num=F.col("article_id"))))))
    wall = F.to_json(j(data=j(items=F.array(j(resource=j(title=F.col("title"), content_short=F.col("snippet"), uri=F.col("link"), display_time=F.unix_seconds("fetched_at")))))))
    tencent = F.to_json(j(data=j(tabs=F.array(j(articleList=F.array(j(title=F.col("title"), url=F.col("link"), pub_time=F.col("date"), intro=F.col("snippet"))))))))
    d = read(spark, sf, "web_articles").select("article_id", source.alias("source_id"), F.when(kind == 0, weibo).when(kind == 1, wall).when(kind == 2, tencent).alias("payload"))
    out = P.api_articles(d.select("source_id", "payload"))
    return out.groupBy("source_id", "status", "error").agg(F.count("*").alias("rows"), F.count_if(F.col("date") != "").alias("dated"), F.coalesce(F.sum(F.length("title")), F.lit(0)).alias("title_chars"), F.coalesce(F.sum(F.length("summary")), F.lit(0)).alias("summary_chars"))


def story_rows(spark, sf):
    r = read(spark, sf, "reddit_articles")
    item = F.struct(F.when(F.col("article_id") % 5 == 0, "job").otherwise("story").alias("type"), F.col("title"), F.col("external_url").alias("url"), F.unix_seconds("fetched_at").alias("time"), F.col("score"), F.col("num_comments").alias("descendants"), F.col("source_name").alias("by"))
    least = r.agg(F.min("article_id")).first()[0] or 0
    d = r.select((F.col("article_id") - least + 1).alias("story_rank"), F.col("article_id").alias("story_id"), F.to_json(item).alias("payload"))
    return P.hacker_news(d).select("hn_id", "title", "link", "date", "score", "comments", "author")


def release_rows(spark, sf):
    d = read(spark, sf, "documents")
    rel = F.array(F.struct((F.col("doc_id") % 10 == 0).alias("draft"), F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"), F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("tag_name"), F.concat(F.lit("https://r.example/"), F.col("doc_id").cast("string")).alias("html_url"), F.col("text").alias("body")))
    d = d.select("doc_id", F.concat(F.lit("org/"), F.coalesce("source", F.lit("none"))).alias("repo"), F.coalesce("source", F.lit("none")).alias("name"), F.to_json(rel).alias("payload"))
    return P.releases(d, F.lit("2000-01-01 00:00:00").cast("timestamp")).select("doc_id", "title", "link", "summary", "source_name", F.unix_seconds("date_ts").alias("second"))


def trending_rows(spark, sf):
    d = read(spark, sf, "reddit_articles")
    item = F.array(F.struct(F.concat(F.coalesce("source_id", F.lit("org")), F.lit("/"), (F.col("article_id") % 500).cast("string")).alias("full_name"), F.col("title").alias("description"), F.lit("https://g.example/x").alias("html_url"), F.col("score").alias("stargazers_count"), F.col("num_comments").alias("forks_count"), F.when(F.col("article_id") % 3 > 0, F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("created_at")))
    d = d.select(F.col("article_id").alias("query_ix"), F.lit("github").alias("topic"), F.to_json(F.struct(item.alias("items"))).alias("payload"))
    return P.trending(d, F.lit("2027-01-01 00:00:00").cast("timestamp")).select("query_ix", "repo", "title", "summary", "stars", "daily_stars_est", "forks")


def request_plan(spark, sf):
    """Every active source with its command, and whether the cache lets the request be conditional."""
    feeds = read(spark, sf, "feed_sources").withColumn("enabled", F.when(F.col("status") == "disabled", F.lit(False)))
    now = F.lit("2026-04-21 00:00:00").cast("timestamp")
    cache = feeds.select("url", F.concat(F.lit("W/"), F.col("source_id")).alias("etag"), F.lit(None).cast("string").alias("last_modified"), (now - F.make_dt_interval(hours=F.length("source_name") * 2)).alias("seen_at"))
    planned = requests.conditional_requests(requests.active_sources(feeds), cache.where("url is not null"), now)
    return planned.select("source_id", F.when(F.col("source_type") == "twitter", F.array_join(requests.command("twitter", F.col("handle"), requests.result_count(F.col("attempts"), 20)), " ")).alias("command"), F.col("if_none_match").isNotNull().alias("conditional"), requests.reddit_period(F.col("priority") * 10).alias("period"))


def queries() -> dict:
    found = (tweet_rows, post_rows, google_rows, v2ex_rows, zhihu_rows, weibo_rows, toutiao_rows, api_rows, story_rows, release_rows, trending_rows, request_plan)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from newsloom.plans.sql import CUT, collapse, release_summary

    clean = lambda t: collapse(f"regexp_replace(coalesce({t}, ''), '<[^>]+>', ' ', 'g')")
    short = lambda t, n: f"CASE WHEN length({t}) <= {n} THEN {t} ELSE rtrim(substring({t}, 1, {n - 3})) || '...' END"
    iso = lambda t: f"strftime({t}, '%Y-%m-%dT%H:%M:%S+00:00')"
    name = "coalesce(nullif(source_name, ''), '{}')"
    hot = lambda link: f"""SELECT article_id, {clean('title')} AS title, {link} AS link"""
    return {
        "tweet_rows": f"""SELECT article_id, {short(collapse('title'), 280)} AS title, link, trim({name.format('Twitter')}) AS source_name, coalesce(metrics.like_count, 0) AS like_count, coalesce(metrics.retweet_count, 0) AS retweet_count,
          coalesce(metrics.reply_count, 0) AS reply_count, coalesce(metrics.quote_count, 0) AS quote_count, metrics.impression_count AS impression_count, tweet_id, 1757930400::BIGINT AS second
          FROM twitter_articles WHERE {collapse('title')} <> '' AND coalesce(link, '') <> ''""",
        "post_rows": f"""WITH r AS (SELECT *, coalesce(nullif(regexp_replace(reddit_url, '^https://www.reddit.com', ''), ''), '') AS thread FROM reddit_articles),
          s AS (SELECT *, CASE WHEN starts_with(thread, '/') THEN 'https://www.reddit.com' || thread ELSE thread END AS u, coalesce(nullif(external_url, ''), '') AS e FROM r)
          SELECT article_id, trim(title) AS title, coalesce(nullif(e, ''), u) AS link, u AS reddit_url, e AS external_url, {iso('fetched_at')} AS date, coalesce(score, 0) AS score, coalesce(num_comments, 0) AS num_comments,
          nullif(flair, '') AS flair, coalesce(is_self, false) AS is_self, trim({name.format('Reddit')}) AS source_name, metrics.upvote_ratio AS upvote_ratio FROM s
          WHERE trim(coalesce(title, '')) <> '' AND coalesce(nullif(e, ''), u) <> '' AND coalesce(score, 0) >= 10""",
        "google_rows": f"""SELECT article_id, {collapse('title')} AS title, link, {collapse('snippet')} AS summary, {iso('fetched_at')} AS date, {collapse('topic')} AS publisher, coalesce(nullif({collapse('topic')}, ''), 'Google News') AS source_name
          FROM web_articles WHERE {collapse('title')} <> '' AND coalesce(link, '') <> ''""",
        "v2ex_rows": f"""SELECT article_id, {clean('title')} AS title, link, {iso('fetched_at')} AS date, {clean('flair')} AS summary, coalesce(num_comments, 0) AS replies, {clean('source_name')} AS author, {clean('topic')} AS node,
          lower(trim(upper(coalesce(topic, '')))) AS node_slug, article_id::VARCHAR AS v2ex_id FROM reddit_articles WHERE {clean('title')} <> '' AND coalesce(link, '') <> ''""",
        "zhihu_rows": f"""SELECT article_id, {clean('title')} AS title, CASE WHEN article_id % 2 = 0 AND {clean('link')} <> '' THEN {clean('link')} ELSE 'https://www.zhihu.com/question/' || article_id END AS link,
          {short(clean('snippet'), 240)} AS summary, article_id::VARCHAR AS question_id, article_id * 10000 AS hot_score, article_id % 7 AS answer_count, 0::BIGINT AS follower_count FROM web_articles WHERE {clean('title')} <> ''""",
        "weibo_rows": f"""{hot(f"CASE article_id % 3 WHEN 0 THEN 'https://w.example/a' WHEN 1 THEN 'https://s.weibo.com/b' ELSE 'https://s.weibo.com/weibo?q=' || replace(replace(url_encode({clean('title')}), '~', '%7E'), '%2A', '*') END")},
          {short(clean('topic'), 240)} AS summary, 1234::BIGINT AS hot_score, article_id % 3 AS rank FROM web_articles WHERE regexp_full_match(title, '[ -~]*') AND {clean('title')} <> ''""",
        "toutiao_rows": f"""{hot("CASE article_id % 3 WHEN 0 THEN 'https://w.example/a' WHEN 1 THEN 'https://www.toutiao.com/b' ELSE 'https://t.example/c' END")},
          {short(clean('snippet'), 240)} AS summary, 15000::BIGINT AS hot_score, article_id % 3 AS rank FROM web_articles WHERE {clean('title')} <> ''""",
        "api_rows": """WITH w AS (SELECT article_id % 4 AS k, substring(coalesce(title, ''), 1, 200) AS t0, trim(coalesce(title, '')) AS t1, trim(coalesce(snippet, '')) AS s1, substring(coalesce(snippet, ''), 1, 500) AS s0, coalesce(link, '') AS l, coalesce(date, '') AS d FROM web_articles),
          r AS (SELECT 'weibo-api' AS source_id, t0 AS t, '' AS s, '' AS d FROM w WHERE k = 0 AND t0 <> ''
            UNION ALL SELECT 'wallstreetcn-api', substring(coalesce(nullif(t1, ''), s1), 1, 200), substring(s1, 1, 500), 'x' FROM w WHERE k = 1 AND l <> '' AND coalesce(nullif(t1, ''), s1) <> ''
            UNION ALL SELECT 'tencent-api', t0, s0, d FROM w WHERE k = 2 AND t0 <> '' AND l <> '')
          SELECT source_id, 'ok' AS status, NULL AS error, count(*) AS rows, count(*) FILTER (d <> '') AS dated, sum(length(t))::BIGINT AS title_chars, sum(length(s))::BIGINT AS summary_chars FROM r GROUP BY 1
          UNION ALL SELECT 'other-api', 'error', 'Unsupported API source: other-api', count(*), 0, 0, 0 FROM w WHERE k = 3""",
        "story_rows": f"""WITH r AS (SELECT *, article_id - min(article_id) OVER () + 1 AS rank FROM reddit_articles)
          SELECT article_id AS hn_id, trim(title) AS title, coalesce(nullif(external_url, ''), 'https://news.ycombinator.com/item?id=' || article_id) AS link, {iso('fetched_at')} AS date, coalesce(score, 0) AS score,
          coalesce(num_comments, 0) AS comments, coalesce(source_name, '') AS author FROM r WHERE rank <= 45 AND article_id % 5 <> 0 AND trim(coalesce(title, '')) <> '' ORDER BY rank LIMIT 15""",
        "release_rows": f"""WITH m AS (SELECT *, {release_summary('text')} AS v FROM documents WHERE doc_id % 10 <> 0 AND published_at IS NOT NULL), {CUT}
          SELECT doc_id, coalesce(source, 'none') || ' v' || doc_id AS title, 'https://r.example/' || doc_id AS link, summary, coalesce(source, 'none') AS source_name, epoch(date_trunc('second', published_at))::BIGINT AS second FROM cut2""",
        "trending_rows": """WITH r AS (SELECT article_id AS query_ix, coalesce(source_id, 'org') || '/' || article_id % 500 AS repo, substring(coalesce(title, ''), 1, 200) AS summary, coalesce(score, 0) AS stars, coalesce(num_comments, 0) AS forks,
            CASE WHEN article_id % 3 > 0 THEN greatest(1, floor((epoch(TIMESTAMPTZ '2027-01-01 00:00:00+00') - epoch(date_trunc('second', fetched_at))) / 86400)) ELSE 365 END AS age FROM reddit_articles)
          SELECT query_ix, repo, CASE WHEN summary <> '' THEN repo || ': ' || summary ELSE repo END AS title, summary, stars, round_even(stars / age, 0)::BIGINT AS daily_stars_est, forks FROM r QUALIFY row_number() OVER (PARTITION BY repo ORDER BY query_ix) = 1""",
        "request_plan": """SELECT source_id, CASE WHEN source_type = 'twitter' THEN concat_ws(' ', 'twitter/tweets', handle, greatest(1, coalesce(attempts, 20))::VARCHAR) END AS command, url IS NOT NULL AND length(source_name) < 12 AS conditional,
          CASE WHEN priority * 10 <= 48 THEN 'day' ELSE 'week' END AS period FROM feed_sources WHERE status IS DISTINCT FROM 'disabled'""",
    }
