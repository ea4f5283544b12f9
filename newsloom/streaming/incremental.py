"""Streaming forms of the seen-before checks (an extension; batch is the reference form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import url as U
from newsloom.operators.articles import link_key, title_key


def fresh_stream(stream: DataFrame, history: DataFrame, event_time: str, delay: str = "24 hours") -> DataFrame:
    """Articles that neither the archive holds nor the stream brought before within the delay, by title or by link.

    history: title, link. The archive is met by two stream-static anti-joins on normalised keys, as in not_in_history; the
    stream itself by two stateful steps, one a key. An empty title or link matches nothing: it is told apart by the other.
    """
    titles = history.select(X.normalize_title(F.col("title")).alias("h_title")).where("h_title <> ''").distinct()
    links = history.select(U.normalize_url(F.col("link")).alias("h_link")).where("h_link <> ''").distinct()
    d = stream.withColumns({"n_title": X.normalize_title(F.col("title")), "n_link": U.normalize_url(F.col("link")), "k_title": title_key(F.col("title")), "k_link": link_key(F.col("link"))})
    d = d.join(titles, F.col("n_title") == F.col("h_title"), "left_anti").join(links, F.col("n_link") == F.col("h_link"), "left_anti")
    d = d.withColumns({"k_t": F.when(F.col("k_title") != "", F.col("k_title")).otherwise(F.concat(F.lit("link "), "k_link")), "k_l": F.when(F.col("k_link") != "", F.col("k_link")).otherwise(F.concat(F.lit("title "), "k_title"))})
    d = d.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["k_t"]).dropDuplicatesWithinWatermark(["k_l"])
    return d.drop("n_title", "n_link", "k_title", "k_link", "k_t", "k_l")


def windowed_status(traces: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Requests and errors per step and event-time window."""
    w = traces.withWatermark("ts", delay).groupBy(F.window("ts", width), "step_key")
    return w.agg(F.count("*").alias("requests"), F.count_if(F.col("status") != "ok").alias("errors")).select(F.col("window.start").alias("since"), "step_key", "requests", "errors")
