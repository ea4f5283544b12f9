"""Answers of services to article rows, and the decisions around requests."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from newsloom.sources import payloads as P
from newsloom.sources import requests


def answers(spark, *payloads):
    return spark.createDataFrame([(i, p if p is None or isinstance(p, str) else json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)], "answer int, payload string")


def test_envelopes(spark):
    texts = [[{"a": 1}, 2, "x", None, {}], {"results": [{"a": 1}], "items": [{"a": 2}, {"a": 3}]}, {"data": {"items": [{"a": 1}, {"a": 2}]}}, {"items": {"x": 1}}, {"x": 1}, "oops", None]
    df = answers(spark, *texts)
    sizes = lambda service: [r["n"] if r["n"] and r["n"] > 0 else 0 for r in df.orderBy("answer").select(F.size(P.envelope(F.col("payload"), service)).alias("n")).collect()]
    assert sizes("twitter") == [2, 1, 2, 0, 0, 0, 0]  # results before items; what is no object goes
    assert sizes("zhihu") == [2, 2, 2, 0, 0, 0, 0]
    assert P.tweets(df.limit(0)).count() == 0


def test_tweets(spark):
    day = "Mon Sep 15 10:00:00 +0000 2025"
    payload = {"tweets": [
        {"text": "a &amp; b\n c", "url": "https://t.example/1", "created_at": day, "likes": 5, "retweet_count": "7", "author": "ann"},
        {"full_text": "x" * 300, "link": "https://t.example/2", "createdAt": "2025-09-16T00:00:00Z", "username": "bob", "impressions": 9},
        {"text": "no link", "created_at": day}, {"text": "old", "url": "u", "created_at": "2020-01-01T00:00:00Z"}, {"text": "no date", "url": "u"}, 7,
    ]}
    got = P.tweets(answers(spark, payload), F.lit("2025-09-01 00:00:00").cast("timestamp")).orderBy("position").collect()
    assert [(r["title"], r["like_count"], r["retweet_count"], r["source_name"], r["impression_count"]) for r in got] == [("a & b c", 5, 7, "ann", None), ("x" * 277 + "...", 0, 0, "bob", 9)]


def test_posts(spark):
    payload = {"data": {"children": [
        {"data": {"title": " A ", "permalink": "/r/x/1", "url": "https://o.example/a", "created_utc": 1757930400, "score": 12, "comments": 3, "selftext": " s "}},
        {"title": "self", "url": "/r/x/2", "score": 50}, {"title": "low", "permalink": "/r/x/3", "score": 1}, {"title": "", "permalink": "/r/x/4", "score": 99}, {"title": "nowhere", "score": 99},
    ]}}
    got = P.posts(answers(spark, payload), 10).orderBy("position").collect()
    assert [(r["title"], r["link"], r["reddit_url"], r["external_url"], r["date"], r["num_comments"]) for r in got] == [
        ("A", "https://o.example/a", "https://www.reddit.com/r/x/1", "https://o.example/a", "2025-09-15T10:00:00+00:00", 3),
        ("self", "https://www.reddit.com/r/x/2", "https://www.reddit.com/r/x/2", None, "", 0),
    ]


def test_hot_lists(spark):
    zhihu = P.zhihu_questions(answers(spark, {"data": {"list": [{"target": {"title": "<b>Q</b> &lt;1&gt;", "id": 42, "answer_count": 8}, "hot_text": "1.2 万热度"}, {"title": "<i></i>", "question_title": "two", "url": "https://z.example"}, {"title": "no link"}]}})).orderBy("position").collect()
    assert [(r["title"], r["link"], r["hot_score"], r["answer_count"]) for r in zhihu] == [("Q", "https://www.zhihu.com/question/42", 12000, 8), ("two", "https://z.example", 0, 0)]
    weibo = P.weibo_hot(answers(spark, {"data": {"realtime": [{"word": "热 搜", "num": 3.9}, {"note": "n", "scheme": "//h.example/x"}, {"title": "t", "url": "/y", "rank": "第5"}]}})).orderBy("position").collect()
    assert [(r["title"], r["link"], r["hot_score"], r["rank"]) for r in weibo] == [("热 搜", "https://s.weibo.com/weibo?q=%E7%83%AD%20%E6%90%9C", 3, 0), ("n", "https://h.example/x", 0, 0), ("t", "https://s.weibo.com/y", 0, 5)]
    toutiao = P.toutiao_hot(answers(spark, [{"name": "n", "share_url": "/z", "hot": "2亿"}])).collect()
    assert [(r["link"], r["hot_score"]) for r in toutiao] == [("https://www.toutiao.com/z", 200000000)]
    v2ex = P.v2ex_topics(answers(spark, [{"title": "T", "url": "u", "nodeSlug": " Py ", "created": "no number", "replies": None}])).collect()
    assert [(r["node_slug"], r["date"], r["replies"]) for r in v2ex] == [("py", "", 0)]


def test_apis(spark):
    rows = [("weibo-api", json.dumps({"data": {"realtime": [{"note": "", "word": "w"}, {"x": 1}]}})), ("tencent-api", json.dumps({"data": {"tabs": [{"articleList": [{"title": "t", "link_info": {"url": "l"}, "desc": "d"}]}]}})), ("tencent-api", "broken"), ("no-api", None)]
    got = P.api_articles(spark.createDataFrame(rows, "source_id string, payload string")).collect()
    assert sorted((r["source_id"], r["status"], r["title"], r["link"]) for r in got if r["status"] == "ok") == [("tencent-api", "ok", "t", "l"), ("weibo-api", "ok", "w", "https://s.weibo.com/weibo?q=w")]
    assert [(r["source_id"], r["error"]) for r in got if r["status"] == "error"] == [("no-api", "Unsupported API source: no-api")]
    stories = [(i, 100 + i, json.dumps({"type": "story" if i % 2 else "job", "title": f"s{i}", "time": 0 if i == 1 else None})) for i in range(1, 12)]
    got = P.hacker_news(spark.createDataFrame(stories, "story_rank int, story_id bigint, payload string"), 3).collect()
    assert [(r["hn_id"], r["date"]) for r in got] == [(101, "1970-01-01T00:00:00+00:00"), (103, ""), (105, "")]


def test_releases_and_trending(spark):
    rel = [{"tag_name": "v1", "html_url": "h", "published_at": "2025-09-15T00:00:00Z", "body": "# Hi\n* a"}, {"tag_name": "v2", "html_url": "h", "published_at": "2025-09-15T00:00:00Z", "draft": True}, {"tag_name": "v3", "html_url": "h"}]
    df = answers(spark, rel).withColumns({"repo": F.lit("org/tool"), "name": F.lit("Tool")})
    assert [(r["title"], r["summary"]) for r in P.releases(df).collect()] == [("tool v1", "Hi * a")]
    assert P.releases(df, per_repo=1).count() == 1
    repos = [{"items": [{"full_name": "a/b", "html_url": "h", "stargazers_count": 10, "created_at": "2025-09-10T00:00:00Z", "description": "d"}]}, {"items": [{"full_name": "a/b", "html_url": "h2"}, {"full_name": "c/d", "html_url": "h", "stargazers_count": 730}]}]
    got = P.trending(answers(spark, *repos).withColumnRenamed("answer", "query_ix"), F.lit("2025-09-15 00:00:00").cast("timestamp")).orderBy("repo").collect()
    assert [(r["title"], r["link"], r["daily_stars_est"]) for r in got] == [("a/b: d", "h", 2), ("c/d", "h", 2)]


def test_request_decisions(spark):
    at = lambda h: datetime(2025, 9, 15, h)
    now = F.lit("2025-09-15 12:00:00").cast("timestamp")
    cache = spark.createDataFrame([("u1", "e1", None, at(1)), ("u1", "e2", None, at(2)), ("u2", "old", None, datetime(2025, 9, 1))], "url string, etag string, last_modified string, seen_at timestamp")
    sources = spark.createDataFrame([("a", "u1", True), ("b", "u2", None), ("c", "u3", False), ("d", "", True)], "id string, url string, enabled boolean")
    got = {r["id"]: r["if_none_match"] for r in requests.conditional_requests(requests.active_sources(sources, "url"), cache, now).collect()}
    assert got == {"a": "e2", "b": None}
    new = spark.createDataFrame([("u2", "n", None, at(3)), ("u9", None, None, at(3))], "url string, etag string, last_modified string, seen_at timestamp")
    assert {r["url"]: r["etag"] for r in requests.updated_cache(cache, new).collect()} == {"u1": "e2", "u2": "n"}
    calls = spark.createDataFrame([(503, "x"), (404, "timed out"), (None, "Connection reset by peer"), (None, "bad")], "code int, error string")
    assert [r["p"] for r in calls.select(requests.passing_failure(F.col("code"), F.col("error")).alias("p")).collect()] == [True, False, True, False]
    wall = "HTTP 403: please log in to https://www.reddit.com to go on"
    runs = spark.createDataFrame([(1, None), (2, wall), (3, None)], "call_ix int, error string")
    assert sorted(r["call_ix"] for r in requests.until_login_wall(runs).collect()) == [1, 2]
    assert requests.until_login_wall(runs.where("call_ix <> 2")).count() == 2
    timed = spark.createDataFrame([("https://h.example/a", 1, 1.0), ("https://h.example/b", 2, 20.0), ("https://h.example/c", 3, 1.0), ("https://o.example/", 4, 2.0)], "url string, call_ix int, elapsed_s double")
    starts = {r["call_ix"]: r["start_s"] for r in requests.cooled_starts(timed, spark.createDataFrame([("h.example", 5.0)], "host string, cooldown_s double")).collect()}
    assert starts == {1: 0.0, 2: 5.0, 3: 25.0, 4: 0.0}
    topics = spark.createDataFrame([("github", ["a", " ", None], ["x"]), ("ai", ["b"], None)], "id string, github_queries array<string>, exclude array<string>")
    assert [(r["topic"], r["query"]) for r in requests.topic_queries(topics, "github_queries", "github").collect()] == [("github", "a")]
    one = spark.range(1).select(
        requests.result_count(F.lit("0"), 5).alias("a"), requests.result_count(F.lit("x"), 5).alias("b"), requests.reddit_period(F.lit(48)).alias("c"), requests.retry_delay(F.lit(2)).alias("d"),
        requests.command("reddit", F.lit("python"), F.lit(25)).alias("e"), requests.trending_search(F.lit("topic:ai"), now, 50, 10).alias("f"), requests.still_fresh(now - F.expr("interval 59 minutes"), now).alias("g"),
    ).first()
    assert tuple(one)[:5] == (1, 5, "day", 8.0, ["reddit/hot", "python", "25"]) and one["g"] is True
    assert one["f"].endswith("q=topic%3Aai%20pushed%3A%3E2025-09-15%20stars%3A%3E50&sort=stars&order=desc&per_page=10")
