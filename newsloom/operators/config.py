"""Catalogues: overlay merge by id, topic labels, violations of the catalogue's rules."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import humanize_id, text


def overlay_merge(defaults: DataFrame, overlay: DataFrame, key: str) -> DataFrame:
    """Full outer join by key; an overlay's field wins where it is not null; rows without a key are left out."""
    d, o = defaults.where(F.col(key).isNotNull()), overlay.where(F.col(key).isNotNull())
    fields = [c for c in dict.fromkeys([*d.columns, *o.columns]) if c != key]
    a = d.select(F.col(key).alias("k_a"), *[F.col(c).alias(f"a_{c}") for c in d.columns if c != key])
    b = o.select(F.col(key).alias("k_b"), *[F.col(c).alias(f"b_{c}") for c in o.columns if c != key])
    pick = lambda c: F.coalesce(*[F.col(f"{s}_{c}") for s, cols in (("b", o.columns), ("a", d.columns)) if c in cols])
    return a.join(b, F.col("k_a") == F.col("k_b"), "full_outer").select(F.coalesce("k_a", "k_b").alias(key), *[pick(c).alias(c) for c in fields])


def record_overlay(defaults: DataFrame, overlay: DataFrame) -> DataFrame:
    """Records of two configuration lists merged by id, to any depth. Both: position, record (JSON text).

    id, place, record: defaults in their order, then what only the overlay has; the overlay's fields win, objects merge field by
    field; of several records of one id in the overlay each is laid over the one before; records without id are left out.
    """

    @F.pandas_udf("string")
    def merged(base: pd.Series, over: pd.Series) -> pd.Series:
        def one(b: str | None, layers) -> str:
            out = json.loads(b) if b else {}
            for x in layers if layers is not None else ():
                out = deep_merge(out, json.loads(x))
            return json.dumps(out, ensure_ascii=False, sort_keys=True)

        return pd.Series([one(b, o) for b, o in zip(base, over)], dtype=object)

    def known(df: DataFrame) -> DataFrame:
        ident = F.trim(text(F.get_json_object("record", "$.id")))
        return df.withColumn("id", ident).where("id <> ''")

    d = known(defaults).groupBy("id").agg(F.min("position").alias("at"), F.max_by("record", "position").alias("base"))
    o = known(overlay).groupBy("id").agg(F.min("position").alias("over_at"), F.transform(F.array_sort(F.collect_list(F.struct("position", "record"))), lambda x: x["record"]).alias("layers"))
    both = d.join(o, "id", "full_outer")
    return both.select("id", F.struct(F.col("at").isNull().alias("new"), F.coalesce("at", "over_at").alias("position")).alias("place"), merged("base", "layers").alias("record"))


def deep_merge(base: dict, overlay: dict) -> dict:
    """Nested settings: the overlay wins, dictionaries merge field by field."""
    out = dict(base)
    for k, v in overlay.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def topic_title(label: Column, topic: Column, emoji: Column | None = None) -> Column:
    """Text after the label's first slash, else the label, else the id made readable; an emoji goes before it."""
    after = F.trim(F.regexp_extract(text(label), r"(?s)^[^/]*/(.*)$", 1))
    title = F.when(F.contains(text(label), F.lit("/")) & (after != ""), after).when(F.trim(text(label)) != "", F.trim(label)).otherwise(humanize_id(topic))
    return title if emoji is None else F.trim(F.concat(F.trim(text(emoji)), F.lit(" "), title))


def with_topic_titles(df: DataFrame, topics: DataFrame, topic: str = "topic") -> DataFrame:
    """Left lookup of each row's topic. topics: id, label, and emoji if there are any."""
    marked = "emoji" in topics.columns
    t = topics.select(F.col("id").alias("t_id"), "label", *(["emoji"] if marked else []))
    joined = df.join(t, F.col(topic) == F.col("t_id"), "left")
    return joined.withColumn("topic_title", topic_title(F.col("label"), F.col(topic), F.col("emoji") if marked else None)).drop("t_id", "label", *(["emoji"] if marked else []))


def source_violations(sources: DataFrame, topics: DataFrame, required: list[str], kind: str | None = None) -> DataFrame:
    """source_id, rule: a row per broken rule. Empty required field, no boolean enabled (where the table has it), priority outside 1..10, unknown topic, id used twice."""
    s = sources
    found = [s.where(F.trim(text(F.col(c).cast("string"))) == "").select("source_id", F.lit(f"{c} is empty").alias("rule")) for c in required]
    if "enabled" in s.columns:
        found.append(s.where(F.col("enabled").try_cast("boolean").isNull()).select("source_id", F.lit("enabled is not true or false").alias("rule")))
    found.append(s.where(~F.coalesce(F.col("priority").between(1, 10), F.lit(False))).select("source_id", F.lit("priority is not in 1..10").alias("rule")))
    if kind:
        found.append(s.where(text(F.col("source_type")) != kind).select("source_id", F.lit(f"type is not {kind}").alias("rule")))
    known = topics.select(F.col("topic_id").alias("t")).distinct()
    found.append(s.where(F.col("topic").isNotNull()).join(known, F.col("topic") == F.col("t"), "left_anti").select("source_id", F.lit("topic is unknown").alias("rule")))
    found.append(s.groupBy("source_id").count().where("count > 1").select("source_id", F.lit("id is used twice").alias("rule")))
    return reduce(DataFrame.unionByName, found)


# What the settings must hold.
TOPIC_TEXTS = ("emoji", "label", "description")
QUERY_LISTS = ("google_queries", "twitter_queries", "reddit_queries", "github_queries", "exclude")
RUN_NUMBERS = ("fetch_step_timeout_s", "merge_timeout_s", "hotspots_timeout_s", "default_hotspots_top_n", "archive_retention_days")
HEALTH_NUMBERS = ("history_days", "report_limit", "error_text_limit")
CACHE_PATHS = ("rss_cache_path", "github_cache_path")
FETCH_FIELDS = {
    "rss": ("request_timeout_s", "max_workers", "max_articles_per_feed", "retry_count", "retry_delay_s", "cache_ttl_hours"),
    "github": ("request_timeout_s", "cooldown_s", "releases_per_repo", "retry_count", "retry_delay_s", "cache_ttl_hours"),
    "github_trending": ("request_timeout_s", "cooldown_s", "min_stars", "per_topic"),
    "google": ("request_timeout_s", "cooldown_s", "results_per_query"),
    "twitter": ("request_timeout_s", "cooldown_s", "count", "results_per_query"),
    "reddit": ("request_timeout_s", "cooldown_s", "results_per_query"),
    "v2ex": ("request_timeout_s", "cooldown_s"),
    "zhihu": ("request_timeout_s", "cooldown_s", "limit"),
    "weibo": ("request_timeout_s", "cooldown_s", "limit"),
    "toutiao": ("request_timeout_s", "cooldown_s", "limit"),
    "api": ("request_timeout_s", "max_workers", "limit", "host_cooldowns"),
}


def _kind(v: Column, path: str) -> Column:
    """Type of the value at a path: OBJECT, ARRAY, STRING, BIGINT, BOOLEAN, DECIMAL or DOUBLE; '' where there is none."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, f"$.{path}", "variant")), "^[A-Z]+", 0), F.lit(""))


def _text_at(v: Column, path: str) -> Column:
    return F.trim(text(F.try_variant_get(v, f"$.{path}", "string")))


def _whole(v: Column, path: str, least: int = 1, most: int | None = None) -> Column:
    n = F.try_variant_get(v, f"$.{path}", "bigint")
    ok = (_kind(v, path) == "BIGINT") & (n >= least)
    return F.coalesce(ok & (n <= most) if most is not None else ok, F.lit(False))


def _broken(df: DataFrame, keys: list[str], rules: list[tuple[Column, str]]) -> DataFrame:
    """keys, rule for each rule (holds, text) that doesn't hold."""
    found = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for ok, rule in rules])
    return df.select(*keys, F.explode(F.array_compact(found)).alias("rule"))


def _twice(df: DataFrame) -> DataFrame:
    return df.where("id <> ''").groupBy("id").count().where("count > 1").select("id", F.lit("id is used twice").alias("rule"))


def _entries(files: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows position, entry of the objects in a file's list; rows id, rule where it has no list or an entry is no object). files: content."""
    v = files.select(F.try_parse_json("content").alias("v"))
    no_list = v.where(F.coalesce(_kind(F.col("v"), key) != "ARRAY", F.lit(True))).select(F.lit("").alias("id"), F.lit(f"{key} is no list").alias("rule"))
    rows = v.select(F.posexplode(F.try_variant_get("v", f"$.{key}", "array<variant>")).alias("position", "entry"))
    is_object = F.coalesce(F.schema_of_variant("entry").startswith("OBJECT"), F.lit(False))
    return rows.where(is_object), no_list.unionByName(rows.where(~is_object).select(F.lit("").alias("id"), F.lit(f"an entry of {key} is no object").alias("rule")))


def topic_file_violations(files: DataFrame) -> DataFrame:
    """id, rule of a topics file (content: JSON text)."""
    rows, broken = _entries(files, "topics")
    e = F.col("entry")
    rows = rows.select(_text_at(e, "id").alias("id"), "entry")
    rules = [(F.col("id") != "", "id is empty"), *[(_text_at(e, f) != "", f"{f} is empty") for f in TOPIC_TEXTS], (_kind(e, "search") == "OBJECT", "search is no object")]
    rules += [(_kind(e, f"search.{f}").isin("", "ARRAY"), f"search.{f} is no list") for f in QUERY_LISTS]
    rules += [(_kind(e, "display") == "OBJECT", "display is no object"), ((_kind(e, "display") != "OBJECT") | _whole(e, "display.max_items"), "display.max_items is below 1")]
    return broken.unionByName(_broken(rows, ["id"], rules)).unionByName(_twice(rows))


def source_file_violations(files: DataFrame, topics: DataFrame, kind: str | None = None, required: str | None = None) -> DataFrame:
    """id, rule of a sources file (content: JSON text); kind and its required field, or neither for the public APIs. topics: topic_id."""
    rows, broken = _entries(files, "sources")
    e = F.col("entry")
    known = topics.select(F.col("topic_id").alias("t")).distinct()
    rows = rows.select(_text_at(e, "id").alias("id"), _text_at(e, "topic").alias("topic"), "entry").join(known, F.col("topic") == F.col("t"), "left")
    rules = [(F.col("id") != "", "id is empty"), (_text_at(e, "name") != "", "name is empty"), (_kind(e, "enabled") == "BOOLEAN", "enabled is not true or false"), (_whole(e, "priority", 1, 10), "priority is not in 1..10")]
    rules += [(F.col("topic") != "", "topic is empty"), ((F.col("topic") == "") | F.col("t").isNotNull(), "topic is unknown")]
    if kind:
        rules += [(_text_at(e, "type") == kind, f"type is not {kind}"), (_text_at(e, required) != "", f"{required} is empty")]
    return broken.unionByName(_broken(rows, ["id"], rules)).unionByName(_twice(rows))


def runtime_file_violations(files: DataFrame) -> DataFrame:
    """rule of a runtime file (content: JSON text)."""
    v = files.select(F.try_parse_json("content").alias("v"))
    e = F.col("v")
    run, fetch, health, cache = (_kind(e, k) == "OBJECT" for k in ("pipeline", "fetch", "diagnostics", "cache"))
    rules = [(run, "pipeline is no object"), *[(~run | _whole(e, f"pipeline.{f}"), f"pipeline.{f} is no whole number from 1") for f in RUN_NUMBERS], (fetch, "fetch is no object")]
    for source, fields in FETCH_FIELDS.items():
        there = _kind(e, f"fetch.{source}") == "OBJECT"
        rules.append((~fetch | there, f"fetch.{source} is no object"))
        rules += [(~fetch | ~there | (_kind(e, f"fetch.{source}.{f}") != ""), f"fetch.{source}.{f} is missing") for f in fields]
    rules += [(health, "diagnostics is no object"), *[(~health | _whole(e, f"diagnostics.{f}"), f"diagnostics.{f} is no whole number from 1") for f in HEALTH_NUMBERS]]
    marks = F.try_variant_get(e, "$.diagnostics.slow_request_thresholds_s", "array<double>")
    rules.append((~health | _kind(e, "diagnostics.degraded_threshold").isin("BIGINT", "DECIMAL", "DOUBLE"), "diagnostics.degraded_threshold is no number"))
    rules.append((~health | ((F.size(marks) > 0) & F.forall(marks, lambda x: x > 0)), "diagnostics.slow_request_thresholds_s is no list of positive numbers"))
    rules += [(cache, "cache is no object"), *[(~cache | (_text_at(e, f"cache.{f}") != ""), f"cache.{f} is empty") for f in CACHE_PATHS]]
    return _broken(v, [], rules)
