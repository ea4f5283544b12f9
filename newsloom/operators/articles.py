"""Row-wise article operators and anti-joins: noise, features, history, same-day keys, first-wins distinct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import url as U
from newsloom.functions.numbers import count_or_zero
from newsloom.params import DEFAULTS, Params


def display_title(df: DataFrame | None = None) -> Column:
    return X.first_filled(F.col("title"), primary_link())


def primary_link() -> Column:
    return X.first_filled(F.col("link"), F.col("reddit_url"), F.col("external_url"))


# Weights of the noise signals.
NOISE_WEIGHTS = {"embedded_url_text": 1.5, "embedded_external_redirect": 1.5, "tracking_url": 1.5, "engagement_chrome": 1.0, "promotion_shape": 1.5, "short_low_information_title": 1.0}


def with_noise(df: DataFrame, params: Params = DEFAULTS, compatibility: bool = True) -> DataFrame:
    """Adds one boolean per signal, noise_score and is_noise."""
    title, summary = X.collapse(F.col("title")), X.collapse(X.first_filled(F.col("summary"), F.col("snippet")))
    both = X.collapse(F.concat_ws(" ", F.nullif(title, F.lit("")), F.nullif(summary, F.lit(""))))
    link = X.first_filled(F.col("link"), F.col("external_url"), F.col("reddit_url"))
    d = df.withColumns({"n_title": title, "n_text": both, "n_link": link})
    host, domains = U.url_host(F.col("n_link")), X.embedded_domains(F.col("n_text"))
    words = F.size(F.filter(F.split(X.normalize_title(F.col("n_title"), compatibility), " "), lambda t: F.length(t) >= 2))
    d = d.withColumns({
        "embedded_url_text": F.col("n_text").rlike(r"(?i)https?://\S+"),
        "embedded_external_redirect": (host != "") & F.exists(domains, lambda x: x != host),
        "tracking_url": U.tracking_params(F.col("n_link")) >= 1,
        "engagement_chrome": F.regexp_count("n_text", F.lit(X.COUNT_UNITS)) >= 2,
        "promotion_shape": F.col("n_text").rlike(X.PROMOTION),
        "short_low_information_title": (words <= 4) & (F.length("n_title") <= 48),
    }).drop("n_title", "n_text", "n_link")
    score = sum((F.when(F.col(k), w).otherwise(0.0) for k, w in NOISE_WEIGHTS.items()), F.lit(0.0))
    url, red, track, chrome, promo, short = (F.col(k) for k in NOISE_WEIGHTS)
    shape = (chrome & (url | red)) | (track & promo) | (promo & short & (url | red | track))
    return d.withColumn("noise_score", score).withColumn("is_noise", (F.col("noise_score") >= params.noise_limit) & shape)


def without_noise(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return with_noise(df, params).where(~F.col("is_noise")).drop(*NOISE_WEIGHTS, "noise_score", "is_noise")


def noise_samples(noisy: DataFrame, n: int = 5) -> DataFrame:
    """The first n removed articles: title (at most 160 characters), link and the signals that speak against each. noisy: with_noise."""
    link = X.first_filled(F.col("link"), F.col("external_url"), F.col("reddit_url"))
    signals = F.map_from_arrays(F.array(*[F.lit(k) for k in NOISE_WEIGHTS]), F.array(*[F.when(F.col(k), w).otherwise(0.0) for k, w in NOISE_WEIGHTS.items()]))
    hit = F.map_filter(signals, lambda k, w: w > 0)
    return noisy.where("is_noise").orderBy("article_ix").limit(n).select("article_ix", F.substring(X.collapse(F.col("title")), 1, 160).alias("title"), link.alias("link"), hit.alias("signals"))


def without_internal(df: DataFrame) -> DataFrame:
    """Columns but those that begin with an underscore, which are working state."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("_")])


def with_features(df: DataFrame, compatibility: bool = True) -> DataFrame:
    """Adds norm_title, compact_title, word_tokens, cjk_bigrams, compact_bigrams, all_tokens (their union), norm_url, domain."""
    d = df.withColumn("norm_title", X.normalize_title(F.col("title"), compatibility))
    d = d.withColumn("compact_title", X.compact(F.col("norm_title")))
    d = d.withColumns({
        "word_tokens": X.word_tokens(F.col("norm_title")), "cjk_bigrams": X.cjk_bigrams(F.col("compact_title")), "compact_bigrams": X.bigrams(F.col("compact_title")),
        "norm_url": U.normalize_url(F.col("link")), "domain": U.url_host(F.col("link")),
    })
    return d.withColumn("all_tokens", F.array_union(F.array_union("word_tokens", "cjk_bigrams"), "compact_bigrams"))


def not_in_history(df: DataFrame, history: DataFrame, compatibility: bool = True) -> DataFrame:
    """Rows whose display title and primary link, both normalised, stand in no archived title or link. Empty keys match nothing.

    history: title, link. Two anti-joins; which side is broadcast is left to the sizes Spark sees.
    """
    titles = history.select(X.normalize_title(F.col("title"), compatibility).alias("h_title")).where("h_title <> ''").distinct()
    links = history.select(U.normalize_url(F.col("link")).alias("h_link")).where("h_link <> ''").distinct()
    d = df.withColumns({"k_title": X.normalize_title(display_title(), compatibility), "k_link": U.normalize_url(primary_link())})
    return without_keys(d, titles, links)


def without_keys(df: DataFrame, titles: DataFrame, links: DataFrame) -> DataFrame:
    """Rows whose k_title is no h_title of titles and whose k_link no h_link of links; the keys are dropped."""
    d = df.join(titles, F.col("k_title") == F.col("h_title"), "left_anti").join(links, F.col("k_link") == F.col("h_link"), "left_anti")
    return d.drop("k_title", "k_link")


def title_key(column: Column) -> Column:
    return F.lower(X.collapse(column))


def link_key(column: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(X.text(column))), "/+$", "")


def not_seen_today(df: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows that today's earlier outputs (title, link) don't hold by either key; a row's link is its first that is filled."""
    titles = seen.select(title_key(F.col("title")).alias("s_title")).where("s_title <> ''").distinct()
    links = seen.select(link_key(primary_link() if {"reddit_url", "external_url"} <= set(seen.columns) else F.col("link")).alias("s_link")).where("s_link <> ''").distinct()
    return df.join(titles, title_key(F.col("title")) == F.col("s_title"), "left_anti").join(links, link_key(primary_link()) == F.col("s_link"), "left_anti")


def first_wins(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def engagement(df: DataFrame, params: Params = DEFAULTS) -> Column:
    """Tier score of the row's source type; 0 for others."""
    out = F.when(F.lit(False), 0)
    for kind, tiers in params.engagement.items():
        for score, marks in tiers:
            hit = F.lit(False)
            for metric, least in marks:
                hit = hit | (count_or_zero(F.col(metric)) >= least)
            out = out.when((F.col("source_type") == kind) & hit, score)
    return out.otherwise(0)
