"""Cross-source matches: which articles of other source types tell an article's story, by article and by cluster.

Matches are rows, not lists: a story of very many articles has very many. Lists are made for selected articles only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators.articles import display_title, primary_link

MATCH = ["source_type", "source_name", "topic", "title", "link", "similarity"]


def article_matches(pairs: DataFrame, arts: DataFrame, least: float) -> DataFrame:
    """article_ix and MATCH of every pair (i, j, similarity) of two source types that reaches `least`, once for each side.

    Of matches with equal source type, title and link an article keeps the one met first (the lower other article).
    """
    info = arts.select("article_ix", "source_type", X.text(F.col("source_name")).alias("source_name"), X.text(F.col("topic")).alias("topic"), display_title().alias("title"), primary_link().alias("link"))
    hot = pairs.where(F.col("similarity") >= least)
    both = hot.select(F.col("i").alias("article_ix"), F.col("j").alias("other"), "similarity").unionByName(hot.select(F.col("j").alias("article_ix"), F.col("i").alias("other"), "similarity"))
    kinds = arts.select("article_ix", F.col("source_type").alias("own_type"))
    met = both.join(kinds, "article_ix").join(info.withColumnRenamed("article_ix", "other"), "other").where("own_type <> source_type")
    first = F.min_by(F.struct("source_name", "topic", F.bround("similarity", 4).alias("similarity")), "other").alias("m")
    kept = met.groupBy("article_ix", "source_type", "title", "link").agg(first)
    return kept.select("article_ix", "source_type", "m.source_name", "m.topic", "title", "link", "m.similarity")


def cluster_matches(matches: DataFrame, components: DataFrame) -> DataFrame:
    """component and MATCH: the matches of all members (vertex, component; an article without one is its own), each once, with match_rank.

    Order: similarity, then source type, then title. Of equal matches the one of the earliest member stays.
    """
    d = matches.join(components, matches["article_ix"] == components["vertex"], "left").withColumn("component", F.coalesce("component", "article_ix"))
    first = F.min_by(F.struct("source_name", "topic", "similarity"), "article_ix").alias("m")
    kept = d.groupBy("component", "source_type", "title", "link").agg(first).select("component", "source_type", "m.source_name", "m.topic", "title", "link", "m.similarity")
    order = Window.partitionBy("component").orderBy(F.desc("similarity"), "source_type", "title", "link")
    return kept.withColumn("match_rank", F.row_number().over(order))


def with_match_lists(selected: DataFrame, matches: DataFrame, key: str = "component") -> DataFrame:
    """selected with cross_source_matches, an array in order of rank; selected is bounded by the top-N of each topic."""
    of = matches.join(selected.select(key), key, "left_semi").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("match_rank", *MATCH))).alias("ranked"))
    lists = of.select(key, F.transform("ranked", lambda m: F.struct(*[m[c].alias(c) for c in MATCH])).alias("cross_source_matches"))
    empty = F.array().cast("array<struct<source_type:string,source_name:string,topic:string,title:string,link:string,similarity:double>>")
    return selected.join(lists, key, "left").withColumn("cross_source_matches", F.coalesce("cross_source_matches", empty))
