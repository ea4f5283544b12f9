"""Blocked similarity self-join of articles, weighted title similarity and the history penalty."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.numbers import ladder
from newsloom.functions.udf import fuzzy3
from newsloom.operators import allpairs as P
from newsloom.operators import near as N
from newsloom.operators.articles import with_features
from newsloom.params import DEFAULTS, Params
from newsloom.session import forget, written

FEATURES = ("norm_title", "compact_title", "word_tokens", "cjk_bigrams", "compact_bigrams", "all_tokens", "norm_url", "domain")


def block_pairs(features: DataFrame, tokens: str, cap: int, least: int) -> DataFrame:
    """i < j that share at least `least` tokens, counting the tokens that 2 to cap articles have.

    The bound on a token's articles is part of the result's definition; it is applied before any pair exists.
    """
    posted = features.select(F.col("article_ix").alias("ix"), F.explode(F.transform(tokens, lambda t: F.xxhash64(t))).alias("token"))
    bucket = posted.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n").between(2, cap)).select("token")
    kept = posted.join(bucket, "token")
    a, b = kept.alias("a"), kept.alias("b")
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.ix") < F.col("b.ix")))
    return pairs.groupBy(F.col("a.ix").alias("i"), F.col("b.ix").alias("j")).agg(F.count("*").alias("shared")).where(F.col("shared") >= least).select("i", "j")


def exact_pairs(features: DataFrame) -> DataFrame:
    """Edges of equal non-empty URL, title or compact title: the first of each group with every other.

    Equality is transitive, so a star says as much as all pairs and a hot key stays linear. Keys meet as 128 bits of two hashes
    with different seeds, in one shuffle of 24 bytes a key; a key's rows are read in one task, but none of them is held beyond
    the window's buffer, which spills.
    """
    keys = [F.when(F.col(c) != "", F.struct(F.xxhash64(F.lit(n), c).alias("h"), F.xxhash64(c, F.lit(n)).alias("g"))) for n, c in enumerate(("norm_url", "norm_title", "compact_title"))]
    rows = features.select(F.col("article_ix").alias("ix"), F.inline(F.array_compact(F.array(*keys))))
    return rows.withColumn("i", F.min("ix").over(Window.partitionBy("h", "g"))).where("ix <> i").select("i", F.col("ix").alias("j"))


def candidate_pairs(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Distinct i < j: at least 2 common words, or 3 common CJK bigrams, in buckets within their bounds; or an exact key."""
    words = block_pairs(features, "word_tokens", params.word_bucket, 2)
    cjk = block_pairs(features, "cjk_bigrams", params.cjk_bucket, 3)
    return words.unionByName(cjk).unionByName(exact_pairs(features)).distinct()


def with_both(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """Features of both sides beside each pair, as a_* and b_*."""
    for side, key in (("a", "i"), ("b", "j")):
        cols = [F.col(c).alias(f"{side}_{c}") for c in FEATURES]
        pairs = pairs.join(features.select(F.col("article_ix").alias(key), *cols), key)
    return pairs


def _same(c: str) -> Column:
    return (F.col(f"a_{c}") != "") & (F.col(f"a_{c}") == F.col(f"b_{c}"))


def _shared(c: str) -> Column:
    return F.size(F.array_intersect(f"a_{c}", f"b_{c}"))


def exact_hint() -> Column:
    """1.0 for an equal title, compact title or URL, else null."""
    return F.when(_same("norm_title") | _same("compact_title") | _same("norm_url"), 1.0)


def comparable() -> Column:
    return F.col("hint").isNotNull() | (F.col("words") >= 2) | (F.col("cjk") >= 3) | (F.col("grams") >= 4)


def measured(both: DataFrame) -> DataFrame:
    """Adds hint, jac, url and the numbers of common words, CJK bigrams and bigrams.

    Through a generator: filters on these columns would otherwise compute the set operations again below a projection.
    """
    sizes = F.size("a_all_tokens") + F.size("b_all_tokens")
    jac = F.when((F.size("a_all_tokens") == 0) | (F.size("b_all_tokens") == 0), 0.0).otherwise(_shared("all_tokens") / (sizes - _shared("all_tokens")))
    made = F.struct(exact_hint().alias("hint"), jac.alias("jac"), url_hint().alias("url"), _shared("word_tokens").alias("words"), _shared("cjk_bigrams").alias("cjk"), _shared("compact_bigrams").alias("grams"))
    return both.select("*", F.inline(F.array(made)))


def url_hint() -> Column:
    a, b = F.col("a_compact_title"), F.col("b_compact_title")
    inside = lambda x, y: F.contains(y, x) & (F.length(x) / F.greatest(F.length(y), F.lit(1)) >= 0.7)
    return F.when(_same("norm_url"), 1.0).when((a != "") & (b != "") & (inside(a, b) | inside(b, a)), 1.0).when(_same("domain"), 0.4).otherwise(0.0)


def weighted(jac: Column, hint: Column, fuzzy: Column, words: Column) -> Column:
    """Weighted mix of the fuzzy ratios, token overlap and URL hint, with its two floors, at most 1."""
    # fixed values: weights and floors
    ts, pa, di = fuzzy["token_set"], fuzzy["partial"], fuzzy["direct"]
    score = 0.35 * ts + 0.25 * pa + 0.20 * jac + 0.10 * di + 0.10 * hint
    score = F.when((ts >= 0.95) & (di >= 0.9), F.greatest(score, F.lit(0.93))).otherwise(score)
    score = F.when((words >= 2) & (pa >= 0.85) & (ts >= 0.85), F.greatest(score, F.lit(0.8))).otherwise(score)
    return F.least(score, F.lit(1.0))


def can_reach(least: float) -> Column:
    """False only for pairs whose weighted similarity must stay below least. Needs measured columns.

    The ratios weigh 0.7 together. The floor of 0.93 needs a direct ratio of 0.9, hence at most a tenth of all characters
    inserted or deleted; each takes away a bigram and adds two, or the reverse, so three change at most.
    """
    apart = F.size("a_compact_bigrams") + F.size("b_compact_bigrams") - 2 * F.col("grams")
    close = apart <= 0.3 * (F.length("a_norm_title") + F.length("b_norm_title")) + 1e-9
    return F.lit(least <= 0.8) | (0.7 + 0.2 * F.col("jac") + 0.1 * F.col("url") >= least - 1e-9) | close


def _fuzzy(df: DataFrame, params: Params) -> DataFrame:
    """Adds the fuzzy ratios; spread over all partitions first, since the UDF costs far more than its input."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n).withColumn("fuzzy", fuzzy3(params.fuzzy_backend)("a_norm_title", "b_norm_title", "a_compact_title", "b_compact_title"))


def _filter(tokens: DataFrame) -> np.ndarray:
    """near.bloom of tokens, which are made once: they are written and then forgotten."""
    run = written(tokens, "tokens")
    bits = N.bloom(run)
    forget(run)
    return bits


def scored_pairs(pairs: DataFrame, features: DataFrame, least: float = 0.0, params: Params = DEFAULTS) -> DataFrame:
    """i, j, similarity of comparable pairs that reach `least`. Exact pairs never see the fuzzy UDF."""
    both = measured(with_both(pairs, features)).where(comparable())
    both = written(both.where(F.col("hint").isNotNull() | can_reach(least)).select("i", "j", "hint", "jac", "url", "words", *[f"{s}_{c}" for s in "ab" for c in ("norm_title", "compact_title")]), "compared")
    exact = both.where("hint is not null").select("i", "j", F.col("hint").alias("similarity"))
    rest = _fuzzy(both.where("hint is null"), params)
    rest = rest.select("i", "j", weighted(F.col("jac"), F.col("url"), F.col("fuzzy"), F.col("words")).alias("similarity"))
    return exact.unionByName(rest).where(F.col("similarity") >= least)


def near_pairs(features: DataFrame, least: float, params: Params = DEFAULTS) -> DataFrame:
    """i, j, similarity of the pairs that reach least, of all that share 2 words or 3 CJK bigrams, however many titles have these; and of exact_pairs.

    scored_pairs of candidate_pairs, less the bounds on buckets. Titles that can be near are found by their cards (allpairs),
    those of equal URL by a join; tokens in common are counted on the texts of what is left. Of features only titles, URL and
    domain are read. Each step is written. The result is read from a written table.
    """
    exact = exact_pairs(features).select("i", "j")
    met = P.near(N.titles(features, 0, links=True), least)
    a, b = (features.select(F.col("article_ix").alias(ix), N.named("norm_url").alias("url")).where("url <> 0") for ix in "ij")
    near = written(met.unionByName(a.join(b, "url").where("i < j").select("i", "j")).distinct(), "near")
    forget(met)
    side = lambda s, ix: features.select(F.col("article_ix").alias(ix), F.col("norm_title").alias(f"{s}_norm_title"), N.named("norm_url").alias(f"{s}_url"), N.named("domain").alias(f"{s}_domain"))
    both = written(N.measured(near.join(side("a", "i"), "i").join(side("b", "j"), "j"), least, params.fuzzy_backend == "indel", counted=True), "compared")
    forget(near)
    rest = _fuzzy(both.where("hint is null"), params)
    rest = rest.select("i", "j", weighted(F.col("jac"), F.col("url"), F.col("fuzzy"), F.col("words")).alias("similarity")).where(F.col("similarity") >= least)
    equal = both.where("hint is not null").select("i", "j").unionByName(exact).distinct()
    found = written(equal.select("i", "j", F.lit(1.0).alias("similarity")).where(F.col("similarity") >= least).unionByName(rest), "pairs")
    forget(both)
    return found


def explained_pairs(pairs: DataFrame, features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """i, j and every part of their similarity: exact hint, fuzzy ratios, overlap, URL hint, common tokens, and the whole."""
    both = _fuzzy(measured(with_both(pairs, features)), params)
    whole = F.coalesce("hint", weighted(F.col("jac"), F.col("url"), F.col("fuzzy"), F.col("words")))
    return both.select("i", "j", "hint", "fuzzy.token_set", "fuzzy.partial", "fuzzy.direct", "jac", "url", "words", "cjk", "grams", whole.alias("similarity"))


def history_candidates(features: DataFrame, history: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """article_ix, h_ix, weight: archived titles that share words (3 each), CJK bigrams (2) or bigrams (1).

    Tokens that more than the bucket bound of archived titles have don't count; per article the heaviest stay, ties to the
    earlier title. history: article_ix, features; duplicates count.
    """
    found = []
    for tokens, weight in (("word_tokens", 3), ("cjk_bigrams", 2), ("compact_bigrams", 1)):
        h = history.select(F.col("article_ix").alias("h_ix"), F.explode(F.transform(tokens, lambda t: F.xxhash64(t))).alias("token"))
        ok = h.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") <= params.history_bucket).select("token")
        a = features.select("article_ix", F.explode(F.transform(tokens, lambda t: F.xxhash64(t))).alias("token"))
        found.append(a.join(h.join(ok, "token"), "token").select("article_ix", "h_ix", F.lit(weight).alias("w")))
    weights = reduce(DataFrame.unionByName, found).groupBy("article_ix", "h_ix").agg(F.sum("w").alias("weight"))
    rank = F.row_number().over(Window.partitionBy("article_ix").orderBy(F.desc("weight"), "h_ix"))
    return weights.withColumn("rank", rank).where(F.col("rank") <= params.history_candidates).drop("rank")


def history_scores(features: DataFrame, history: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """article_ix, history_score (a penalty) of the articles whose title is near an archived one.

    Archived titles have no link: URL and domain give no hint. An equal title or compact title is met by a join of its own,
    whatever the bounds on tokens. For the others, pairs that can reach the least tier are found by their cards (see near) and
    scored; a scored one counts if it is among the article's `history_candidates`, which are made for such articles only.
    Each step is written, so that postings are gone when texts are joined. The result is read from a written table.
    """
    least = min(t for t, _ in params.history_tiers)
    key = [F.xxhash64("compact_title").alias("k1"), F.xxhash64(F.lit(1), "compact_title").alias("k2")]  # equal titles have equal compact ones
    known = history.where(F.col("compact_title") != "").select(*key).distinct()
    equal = features.where(F.col("compact_title") != "").select("article_ix", *key).join(known, ["k1", "k2"], "left_semi").select("article_ix").distinct()
    kinds, most = (N.WORD, N.CJK, N.GRAM), dict.fromkeys((N.WORD, N.CJK, N.GRAM), params.history_bucket)
    rare = _filter(N.rare_tokens(N.titles(history, 0), kinds, 1, most))
    every = N.titles(features, 1).unionByName(N.titles(history, 0))
    near = written(N.pairs(N.postings(every, rare, kinds), least, most, True).select("i", "j").distinct(), "near")
    apart = near.join(equal.select(F.col("article_ix").alias("i")), "i", "left_anti")
    text = lambda df, side, ix: df.select(F.col("article_ix").alias(ix), F.col("norm_title").alias(f"{side}_norm_title"))
    none = {f"{side}_{c}": F.lit(0).cast("bigint") for side in "ab" for c in ("url", "domain")}
    both = N.measured(apart.join(text(features, "a", "i"), "i").join(text(history, "b", "j"), "j").withColumns(none), least, params.fuzzy_backend == "indel")
    sim = weighted(F.col("jac"), F.col("url"), F.col("fuzzy"), F.col("words"))
    found = written(_fuzzy(both, params).select("i", "j", sim.alias("similarity")).where(F.col("similarity") >= least), "scored")
    forget(near)
    # candidates of the articles that are near a title, of no others, tell whether it is among the heaviest
    only = N.bloom(found.select(F.col("i").alias("token")), mixed=False)
    weight = F.when(F.col("kind") == N.WORD, 3).when(F.col("kind") == N.CJK, 2).otherwise(1)
    weights = N.pairs(N.postings(every, rare, kinds, only), 0.0, most, True).repartition("i").groupBy("i", "j").agg(F.sum(weight).alias("weight"))
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("weight"), "j"))
    ranked = weights.withColumn("rank", rank).where(F.col("rank") <= params.history_candidates).select("i", "j")
    scored = found.join(ranked, ["i", "j"], "left_semi").select(F.col("i").alias("article_ix"), "similarity")
    best = equal.select("article_ix", F.lit(1.0).alias("similarity")).unionByName(scored).groupBy("article_ix").agg(F.max("similarity").alias("similarity"))
    scores = written(best.select("article_ix", "similarity", ladder(F.col("similarity"), list(params.history_tiers)).alias("history_score")), "history-scores")
    forget(found)
    return scores


def features_of(df: DataFrame, compatibility: bool = True) -> DataFrame:
    return with_features(df, compatibility).select("article_ix", *FEATURES)


def written_titles(df: DataFrame) -> DataFrame:
    """article_ix, norm_title, compact_title: normalised titles are written once, which is what costs; token sets are not."""
    return as_titles(written(df.select("article_ix", X.normalize_title(F.col("title")).alias("norm_title")), "titles"))


def as_titles(titles: DataFrame) -> DataFrame:
    """article_ix, norm_title with what else a title's features are; archived titles have no link."""
    return titles.withColumns({"compact_title": X.compact(F.col("norm_title")), "norm_url": F.lit(""), "domain": F.lit("")})
