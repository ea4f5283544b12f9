"""Feed documents (RSS, Atom, RDF) to article rows, as an Arrow step over (feed_url, content)."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import dates
from newsloom.functions import text as X

ENTRY = "feed_url string, position int, title string, link string, date string, summary string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2].lower() if isinstance(tag, str) else ""


def _child(node: ET.Element, *names: str) -> ET.Element | None:
    for name in names:
        for c in node:
            if _local(c.tag) == name:
                return c
    return None


def _text(node: ET.Element | None) -> str:
    return "".join(node.itertext()).strip() if node is not None else ""


def _link(entry: ET.Element, base: str) -> str:
    links = [c for c in entry if _local(c.tag) == "link"]
    alternate = [c for c in links if c.get("href") and c.get("rel", "alternate") == "alternate"]
    found = [c.get("href") for c in alternate] + [c.get("href") for c in links if c.get("href")] + [_text(c) for c in links if _text(c)]
    whole = urljoin(base, found[0]) if found else ""
    return whole if whole.startswith(("http://", "https://")) else ""


def entries(content: str, base: str) -> list[tuple[str, str, str, str]]:
    """(title, link, date, summary) of every entry, in order; [] for what is no well-formed XML."""
    try:
        root = ET.fromstring(content.strip())
    except ET.ParseError:
        return []
    out = []
    for node in root.iter():
        if _local(node.tag) in ("item", "entry"):
            title = _text(_child(node, "title"))
            date = _text(_child(node, "pubdate", "published", "updated", "date"))
            out.append((title, _link(node, base), date, _text(_child(node, "description", "summary", "content", "encoded"))))
    return out


def is_feed(content: Column, content_type: Column) -> Column:
    """Whether the content type says so, or a feed's element stands anywhere in the text."""
    return F.lower(X.text(content_type)).rlike("rss|atom|xml") | X.text(content).rlike("(?i)<rss|<feed|<rdf")


def parse_feeds(feeds: DataFrame, cutoff: Column | None = None, per_feed: int = 20) -> DataFrame:
    """Entries of each feed: the first per_feed that have title, link and a date at or after the cutoff.

    feeds: feed_url, content. Adds date_ts; title is cut at 200 characters, summary cleaned and cut at 400.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(u, k, *e) for u, c in zip(batch["feed_url"], batch["content"]) if c for k, e in enumerate(entries(c, u or "")[:per_feed])]
            yield pd.DataFrame(rows, columns=["feed_url", "position", "title", "link", "date", "summary"])

    d = feeds.select("feed_url", "content").mapInPandas(read, ENTRY)
    d = d.withColumn("date_ts", dates.parse_feed_date(F.col("date"))).where("title <> '' AND link <> '' AND date_ts IS NOT NULL")
    if cutoff is not None:
        d = d.where(F.col("date_ts") >= cutoff)
    return d.withColumns({"title": F.substring(X.collapse(F.col("title")), 1, 200), "summary": X.truncate(X.collapse(X.strip_tags(F.col("summary"))), 400)})
