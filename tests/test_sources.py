"""Feeds, step files, envelopes, archive and streaming."""

import json

from pyspark.sql import functions as F

from newsloom.sources import feeds, steps
from newsloom.streaming import incremental

RSS = """<?xml version="1.0"?><rss><channel><item><title>One &amp; two</title><link>/a</link><pubDate>Mon, 15 Sep 2025 10:00:00 +0000</pubDate><description><![CDATA[<b>bold</b> text]]></description></item>
<item><title>Old</title><link>https://h.example/old</link><pubDate>Mon, 01 Sep 2025 10:00:00 +0000</pubDate></item><item><title>No date</title><link>https://h.example/n</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Atom</title><link rel="self" href="https://h.example/self"/><link rel="alternate" href="https://h.example/alt"/><updated>2025-09-16T00:00:00Z</updated></entry></feed>"""


def test_feeds(spark):
    df = spark.createDataFrame([("https://h.example/feed", RSS), ("https://h.example/atom", ATOM), ("https://x.example", "<broken"), ("https://y.example", None)], "feed_url string, content string")
    got = {r["title"]: r for r in feeds.parse_feeds(df, F.lit("2025-09-10 00:00:00").cast("timestamp")).collect()}
    assert set(got) == {"One & two", "Atom"}
    assert (got["One & two"]["link"], got["One & two"]["summary"]) == ("https://h.example/a", "bold text")
    assert got["Atom"]["link"] == "https://h.example/alt"
    assert [r["f"] for r in df.select(feeds.is_feed(F.col("content"), F.lit("")).alias("f")).collect()] == [True, True, False, False]


def test_steps_and_archive(spark, tmp_path):
    (tmp_path / "rss.json").write_text(json.dumps({"articles": [{"title": "a", "source_priority": 99}, {"title": "b", "topic": " ai "}]}))
    (tmp_path / "reddit.json").write_text("not json")
    rows = steps.read_steps(spark, {"rss": str(tmp_path / "rss.json"), "reddit": str(tmp_path / "reddit.json"), "api": str(tmp_path / "absent.json")}).collect()
    assert [(r["title"], r["source_priority"], r["topic"]) for r in sorted(rows, key=lambda r: r["article_ix"])] == [("a", 10, "uncategorized"), ("b", 3, "ai")]
    selected = spark.createDataFrame([("ai", 2, "t2", "l2"), ("ai", 1, "t1", "l1")], "topic string, rank int, title string, link string")
    for day in ("2025-09-01", "2025-09-02"):
        steps.write_archive(selected, str(tmp_path / "archive"), day, day)
    back = steps.archive_items(spark, str(tmp_path / "archive"), before="2025-09-02").collect()
    assert [(r["title"], r["link"]) for r in back] == [("t1", "l1"), ("t2", "l2")]


def test_streams(spark, tmp_path):
    rows = [("a", "https://h.example/1", "2025-01-01 00:00:00"), ("A", "https://h.example/1/", "2025-01-01 00:01:00"), ("b", "https://old.example/x", "2025-01-01 00:02:00"), ("Old news!", "https://new.example/y", "2025-01-01 00:03:00")]
    df = spark.createDataFrame(rows, "title string, link string, at string").withColumn("at", F.col("at").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    history = spark.createDataFrame([("old NEWS", "https://www.old.example/x/"), (None, "")], "title string, link string")
    stream = incremental.fresh_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), history, "at")
    q = stream.writeStream.format("memory").queryName("fresh").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert [r["link"].rstrip("/") for r in spark.table("fresh").collect()] == ["https://h.example/1"]


def test_stream_drops_by_title_or_link(spark, tmp_path):
    times = [f"2025-01-01 00:0{i}:00" for i in range(6)]
    rows = list(zip(["same", "Same", "other", "", "", "third"], ["https://h.example/1", "https://h.example/2", "https://h.example/1", "https://h.example/4", "https://h.example/5", ""], times))
    df = spark.createDataFrame(rows, "title string, link string, at string").withColumn("at", F.col("at").cast("timestamp"))
    for i in range(6):
        df.where(F.col("at") == F.lit(times[i]).cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    history = spark.createDataFrame([], "title string, link string")
    stream = incremental.fresh_stream(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), history, "at")
    q = stream.writeStream.format("memory").queryName("fresh2").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["title"], r["link"]) for r in spark.table("fresh2").collect()) == [("", "https://h.example/4"), ("", "https://h.example/5"), ("same", "https://h.example/1"), ("third", "")]
