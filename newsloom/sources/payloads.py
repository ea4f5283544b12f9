"""Answers of services (JSON text) to article rows: envelopes, row forms of each service, and limits.

A payload is read once into a variant; an item is a variant too, and every field is a path into it, so nothing leaves the
JVM but the texts whose HTML entities are undone. Frames go in with a column ``payload`` beside any others, which are kept
(``topic``, ``query`` and the like), and come out with ``position`` (place in the answer) and the article's fields.

Defined results: text that is no JSON, an answer without a list under a known key and items that are no objects give no
rows; an item without title or link is left out; missing counts are 0; a time that is no number gives an empty date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import dates
from newsloom.functions import text as X
from newsloom.functions.numbers import human_number

# Keys under which a service's list stands, in the order in which they are tried, and keys one level deeper.
ENVELOPES = {
    "twitter": (("tweets", "results", "items", "data"), ("tweets", "results", "items")),
    "reddit": (("posts", "results", "items", "children", "data"), ("children", "items", "posts")),
    "google": (("results",), ()),
    "v2ex": (("topics", "items", "data", "results"), ("topics", "items", "list")),
    "zhihu": (("items", "questions", "data", "results"), ("items", "questions", "data", "list")),
    "weibo": (("items", "data", "realtime", "results"), ("items", "data", "realtime", "list")),
    "toutiao": (("items", "data", "news", "results"), ("items", "data", "news", "list")),
    "weibo-api": ((), ("data.realtime",)),
    "wallstreetcn-api": ((), ("data.items",)),
    "tencent-api": ((), ("data.tabs[0].articleList",)),
    "github": ((), ()),
    "github_trending": (("items",), ()),
}


def at(item: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(item, "$" if path == "$" else f"$.{path}", kind)


def envelope(payload: Column, service: str) -> Column:
    """array<variant>: the answer itself if it is a list, else the first list under the service's keys; objects only."""
    v = F.try_parse_json(payload)
    keys, deeper = ENVELOPES[service]
    found = [at(v, "$", "array<variant>")]
    for k in keys:
        found += [at(v, k, "array<variant>"), *[at(v, f"{k}.{d}", "array<variant>") for d in deeper]]
    if not keys:
        found += [at(v, d, "array<variant>") for d in deeper]
    return F.filter(F.coalesce(*found), lambda x: F.schema_of_variant(x).startswith("OBJECT"))


def items(df: DataFrame, service: str, limit: int | None = None) -> DataFrame:
    """df without payload, one row an item: position, item."""
    listed = envelope(F.col("payload"), service)
    kept = [c for c in df.columns if c != "payload"]
    return df.select(*kept, F.posexplode(F.slice(listed, 1, limit) if limit else listed).alias("position", "item"))


def filled(item: Column, *paths: str) -> Column:
    """First text that isn't empty; null if there is none."""
    return F.coalesce(*[F.nullif(at(item, p), F.lit("")) for p in paths])


#: Stands between texts that are cleaned in one go.
_GAP = "\u241e"


def cleaned(item: Column, *paths: str) -> Column:
    """First text that isn't empty once it is cleaned; '' if there is none."""
    joined = X.html_unescape(F.concat_ws(_GAP, *[F.replace(X.text(at(item, p)), F.lit(_GAP), F.lit(" ")) for p in paths]))
    parts = F.split(F.regexp_replace(joined, f"<[^>{_GAP}]+>", " "), _GAP)
    return X.text(F.get(F.filter(F.transform(parts, X.collapse), lambda x: x != ""), 0))


def summary(item: Column, *paths: str, limit: int = 240) -> Column:
    return X.truncate(X.clean_html(filled(item, *paths)), limit)


def count(item: Column, *paths: str) -> Column:
    """First number that isn't 0, plain or written for people; null if there is none."""
    one = lambda p: F.coalesce(at(item, p, "double").cast("bigint"), human_number(X.clean_html(at(item, p))))
    return F.coalesce(*[F.nullif(one(p), F.lit(0).cast("bigint")) for p in paths])


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))


def epoch_date(item: Column, *paths: str) -> Column:
    """ISO text in UTC of the first path that holds a number; '' if none does."""
    numbers = [F.when(F.schema_of_variant(at(item, p, "variant")).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), at(item, p, "double")) for p in paths]
    return X.text(dates.iso_text(F.floor(F.coalesce(*numbers)).cast("bigint")))


def _rows(found: DataFrame, **fields: Column) -> DataFrame:
    """The frame's own columns and the fields; rows without title or link are left out.

    Through a generator, so that the filter isn't pushed below it and every field read twice.
    """
    kept = [c for c in found.columns if c != "item" and c not in fields]
    rows = found.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in fields.items()]))))
    return rows.where("title <> '' AND link <> ''")


def _own(df: DataFrame, column: str) -> Column:
    return F.col(column) if column in df.columns else F.lit(None).cast("string")


def tweets(df: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Posts: text cut at 280, a date at or after the cutoff, counts under either of their names. df may have topic, query, source_name."""
    found = items(df, "twitter")
    i = F.col("item")
    line = lambda *p: X.truncate(X.collapse(X.html_unescape(X.text(filled(i, *p)))), 280)
    out = _rows(
        found,
        title=line("text", "full_text"), link=X.text(filled(i, "url", "link")), date=X.text(filled(i, "created_at", "createdAt")), topic=_own(df, "topic"),
        summary=line("note_tweet", "note_tweet_text", "summary", "description"), source_name=F.trim(X.first_filled(_own(df, "source_name"), at(i, "author"), at(i, "username"), F.lit("Twitter"))),
        like_count=or_zero(count(i, "likes", "like_count")), retweet_count=or_zero(count(i, "retweets", "retweet_count")), reply_count=or_zero(count(i, "replies", "reply_count")),
        quote_count=or_zero(count(i, "quotes", "quote_count")), impression_count=F.coalesce(at(i, "impressions", "bigint"), at(i, "impression_count", "bigint")),
        tweet_id=at(i, "id"), tweet_type=at(i, "type"), author=filled(i, "author", "username"), rt_author=at(i, "rt_author"), twitter_query=_own(df, "query"),
    )
    instant = dates.parse_feed_date(F.col("date"))
    return out.withColumn("date_ts", instant).where("date_ts IS NOT NULL" if cutoff is None else F.col("date_ts") >= cutoff)


def posts(df: DataFrame, min_score: Column | int = 0) -> DataFrame:
    """Forum posts, bare or wrapped in a `data` object: outside page before thread, score at or above the least."""
    found = items(df, "reddit")
    wrapped = F.schema_of_variant(at(F.col("item"), "data", "variant")).startswith("OBJECT")
    found = found.withColumn("item", F.when(F.coalesce(wrapped, F.lit(False)), at(F.col("item"), "data", "variant")).otherwise(F.col("item")))
    i = F.col("item")
    thread = filled(i, "permalink", "reddit_url", "url")
    reddit_url = X.text(F.when(thread.startswith("/"), F.concat(F.lit("https://www.reddit.com"), thread)).otherwise(thread))
    outside = F.coalesce(filled(i, "external_url"), F.when(~X.text(at(i, "url")).startswith("/r/"), X.text(at(i, "url"))))
    score = or_zero(at(i, "score", "double").cast("bigint"))
    comments = or_zero(F.coalesce(at(i, "num_comments", "double"), at(i, "comments", "double"), at(i, "comment_count", "double")).cast("bigint"))
    out = _rows(
        found,
        title=F.trim(X.text(at(i, "title"))), link=X.first_filled(outside, reddit_url), reddit_url=reddit_url, external_url=outside, date=epoch_date(i, "created_utc", "created"),
        score=score, num_comments=comments, flair=filled(i, "link_flair_text", "flair"), is_self=F.coalesce(at(i, "is_self", "boolean"), F.lit(False)),
        summary=F.substring(F.trim(X.text(filled(i, "selftext", "text", "snippet"))), 1, 400), topic=_own(df, "topic"),
        source_name=F.trim(X.first_filled(_own(df, "source_name"), at(i, "subreddit_name_prefixed"), at(i, "subreddit"), F.lit("Reddit"))),
        upvote_ratio=at(i, "upvote_ratio", "double"), reddit_query=_own(df, "query"),
    )
    return out.where(F.col("score") >= min_score)


def google_news(df: DataFrame) -> DataFrame:
    """Search results: the snippet is the summary, the publisher the source. df has fetched_at for results without a time."""
    found = items(df, "google")
    i = F.col("item")
    now = dates.iso_text(F.unix_seconds("fetched_at")) if "fetched_at" in df.columns else F.lit("")
    snippet, publisher = X.collapse(at(i, "snippet")), X.collapse(at(i, "source"))
    return _rows(
        found,
        title=X.collapse(at(i, "title")), link=X.text(at(i, "url")), snippet=snippet, summary=snippet, date=X.first_filled(epoch_date(i, "timestamp"), now), topic=_own(df, "topic"),
        publisher=publisher, source_name=X.first_filled(publisher, F.lit("Google News")), google_query=_own(df, "query"),
    )


def v2ex_topics(df: DataFrame) -> DataFrame:
    found = items(df, "v2ex")
    i = F.col("item")
    return _rows(
        found,
        title=X.clean_html(at(i, "title")), link=X.text(at(i, "url")), date=epoch_date(i, "created"), summary=summary(i, "content"), source_name=F.lit("V2EX"), topic=F.lit("technology"),
        replies=or_zero(at(i, "replies", "double").cast("bigint")), author=X.clean_html(at(i, "author")), node=X.clean_html(at(i, "node")), node_slug=F.lower(F.trim(X.text(at(i, "nodeSlug")))), v2ex_id=at(i, "id"),
    )


def zhihu_questions(df: DataFrame) -> DataFrame:
    found = items(df, "zhihu")
    i = F.col("item")
    question = cleaned(i, "question_id", "questionId", "target.id", "id")
    link = X.first_filled(cleaned(i, "url", "link", "share_url", "question_url", "target.url", "target.share_url"), F.when(question.rlike("^[0-9]+$"), F.concat(F.lit("https://www.zhihu.com/question/"), question)))
    return _rows(
        found,
        title=cleaned(i, "title", "question_title", "target.title", "target.name"), link=link, date=F.lit(""), topic=F.lit("social"), source_name=F.lit("Zhihu"),
        summary=summary(i, "excerpt", "detail_text", "description", "target.excerpt", "target.detail_text", "target.answer_text"), question_id=question,
        hot_score=or_zero(count(i, "hot", "hot_score", "metrics.hot_score", "hot_text")), answer_count=or_zero(count(i, "answer_count", "target.answer_count", "metrics.answer_count")),
        follower_count=or_zero(count(i, "follower_count", "target.follower_count", "metrics.follower_count")),
    )


def _hot_list(df: DataFrame, service: str, name: str, host: str, search: str, titles: tuple, links: tuple, about: tuple, heat: tuple, rank: tuple) -> DataFrame:
    """Hot-search lists: a link without host gets one, a missing link becomes a search for the title; dated when fetched."""
    found = items(df, service)
    i = F.col("item")
    title, link = cleaned(i, *titles), cleaned(i, *links)
    link = F.when(link.startswith("//"), F.concat(F.lit("https:"), link)).when(link.startswith("/"), F.concat(F.lit(host), link)).when(link == "", X.search_url(search, title)).otherwise(link)
    now = dates.iso_text(F.unix_seconds("fetched_at")) if "fetched_at" in df.columns else F.lit("")
    return _rows(found, title=title, link=link, date=now, summary=summary(i, *about), source_name=F.lit(name), topic=F.lit("social"), hot_score=or_zero(count(i, *heat)), rank=or_zero(count(i, *rank)))


def weibo_hot(df: DataFrame) -> DataFrame:
    return _hot_list(
        df, "weibo", "Weibo", "https://s.weibo.com", "https://s.weibo.com/weibo?q=", ("title", "note", "word", "keyword"), ("url", "scheme", "link"),
        ("label_name", "label", "icon_desc", "description", "desc"), ("num", "hot", "raw_hot"), ("rank", "realpos"),
    )


def toutiao_hot(df: DataFrame) -> DataFrame:
    return _hot_list(
        df, "toutiao", "Toutiao", "https://www.toutiao.com", "https://www.toutiao.com/search/?keyword=", ("title", "word", "query", "keyword", "name"), ("url", "link", "share_url"),
        ("abstract", "description", "label", "hot_desc", "desc"), ("hot", "hot_value", "score"), ("rank", "realpos", "position"),
    )


def weibo_api(df: DataFrame, limit: int = 15) -> DataFrame:
    i, title = F.col("item"), X.text(filled(F.col("item"), "note", "word"))
    return _rows(items(df, "weibo-api", limit), title=F.substring(title, 1, 200), link=F.when(title != "", F.concat(F.lit("https://s.weibo.com/weibo?q="), title)), summary=F.lit(""), source_id=F.lit("weibo-api"), source_name=F.lit("Weibo Hot Search"), heat=F.coalesce(at(i, "num"), F.lit("0")))


def wallstreetcn_api(df: DataFrame, limit: int = 15) -> DataFrame:
    i = F.col("item")
    title, short = F.trim(X.text(at(i, "resource.title"))), F.trim(X.text(at(i, "resource.content_short")))
    return _rows(
        items(df, "wallstreetcn-api", limit),
        title=F.substring(X.first_filled(title, short), 1, 200), link=X.text(at(i, "resource.uri")), date=epoch_date(i, "resource.display_time"), summary=F.substring(short, 1, 500),
        source_id=F.lit("wallstreetcn-api"), source_name=F.lit("Wall Street CN"),
    )


def tencent_api(df: DataFrame, limit: int = 15) -> DataFrame:
    i = F.col("item")
    return _rows(
        items(df, "tencent-api", limit),
        title=F.substring(X.text(at(i, "title")), 1, 200), link=X.text(filled(i, "url", "link_info.url")), date=X.text(filled(i, "pub_time", "publish_time")),
        summary=F.substring(X.text(filled(i, "abstract", "intro", "desc")), 1, 500), source_id=F.lit("tencent-api"), source_name=F.lit("Tencent News"),
    )


def hacker_news(df: DataFrame, limit: int = 15) -> DataFrame:
    """Stories in list order until there are enough, among the first three times as many. df: story_rank (from 1), story_id, payload (the item)."""
    d = df.withColumn("item", F.try_parse_json("payload")).where(F.col("story_rank") <= 3 * limit)
    i = F.col("item")
    out = d.where(at(i, "type") == "story").select(
        "story_rank", F.col("story_id").alias("hn_id"), F.substring(F.trim(X.text(at(i, "title"))), 1, 200).alias("title"),
        F.coalesce(filled(i, "url"), F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("story_id").cast("string"))).alias("link"), epoch_date(i, "time").alias("date"),
        F.substring(X.text(at(i, "text")), 1, 500).alias("summary"), or_zero(at(i, "score", "double").cast("bigint")).alias("score"), or_zero(at(i, "descendants", "double").cast("bigint")).alias("comments"),
        X.text(at(i, "by")).alias("author"), F.lit("hacker-news-api").alias("source_id"), F.lit("Hacker News API").alias("source_name"),
    ).where("title <> ''")
    return out.orderBy("story_rank").limit(limit)  # a list of one answer: at most 3 * limit rows


#: Row forms of the public APIs by source id.
API = {"weibo-api": weibo_api, "wallstreetcn-api": wallstreetcn_api, "tencent-api": tencent_api}


def api_articles(df: DataFrame, limit: int = 15) -> DataFrame:
    """Answers of the registered APIs by source_id; an unknown id gives one row with its error.

    df: source_id, payload. Gives source_id, position, title, link, date, summary, source_name, status, error.
    """
    out = None
    for source, form in API.items():
        rows = form(df.where(F.col("source_id") == source), limit)
        rows = rows.select("source_id", "position", "title", "link", F.col("date") if "date" in rows.columns else F.lit("").alias("date"), "summary", "source_name", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))
        out = rows if out is None else out.unionByName(rows)
    unknown = df.where(~F.col("source_id").isin(*API) | F.col("source_id").isNull())
    none = [F.lit(None).cast(t).alias(c) for c, t in (("position", "int"), ("title", "string"), ("link", "string"), ("date", "string"), ("summary", "string"), ("source_name", "string"))]
    return out.unionByName(unknown.select("source_id", *none, F.lit("error").alias("status"), F.concat(F.lit("Unsupported API source: "), X.text(F.col("source_id"))).alias("error")))


def releases(df: DataFrame, cutoff: Column | None = None, per_repo: int = 20) -> DataFrame:
    """Releases of repositories: no drafts, dated, at or after the cutoff; the title is the short name and the tag. df: repo, name, topic, payload."""
    found = items(df, "github", per_repo)
    i = F.col("item")
    found = found.where(~F.coalesce(at(i, "draft", "boolean"), F.lit(False)))
    out = _rows(found, title=F.concat(X.short_repo(F.col("repo")), F.lit(" "), X.text(at(i, "tag_name"))), link=X.text(at(i, "html_url")), date=X.text(at(i, "published_at")), summary=X.release_summary(at(i, "body")), source_name=F.col("name"))
    out = out.withColumn("date_ts", dates.parse_feed_date(F.col("date"))).where("date_ts IS NOT NULL")
    return out if cutoff is None else out.where(F.col("date_ts") >= cutoff)


def trending(df: DataFrame, now: Column) -> DataFrame:
    """Repositories of search answers, each once (in the first answer that has it), as articles; stars a day since its creation. df: query_ix, topic, payload."""
    found = items(df, "github_trending")
    i = F.col("item")
    stars = or_zero(at(i, "stargazers_count", "double").cast("bigint"))
    created = dates.parse_feed_date(X.text(at(i, "created_at")))
    age = F.when(created.isNotNull(), F.greatest(F.lit(1), F.floor((F.unix_seconds(now) - F.unix_seconds(created)) / 86400))).otherwise(365)
    about = F.substring(X.text(at(i, "description")), 1, 200)
    repo = X.text(at(i, "full_name"))
    out = _rows(
        found,
        repo=repo, title=F.when(about != "", F.concat(repo, F.lit(": "), about)).otherwise(repo), link=X.text(at(i, "html_url")), summary=about, date=X.text(at(i, "pushed_at")),
        stars=stars, daily_stars_est=F.bround(stars / age).cast("bigint"), forks=or_zero(at(i, "forks_count", "double").cast("bigint")), language=at(i, "language"), created_at=X.text(at(i, "created_at")), source_priority=F.lit(4),
    )
    first = Window.partitionBy("repo").orderBy("query_ix", "position")
    return out.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")
