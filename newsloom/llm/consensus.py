"""Best representative of each duplicate group: the record to keep, and the best value field by field.

The record to keep is the one of highest trust, then latest, then lowest id. Beside it each field gets a consensus: the
group's distinct values of the field, weighted by copies, trust and recency (a record counts 1 + trust/10, and up to 0.1
more the later it stands between the group's first and last), are split into tokens and aligned progressively into
columns; every column takes the token (or gap) of most weight; the existing value closest to the row of winning tokens is
emitted. A field of one distinct value needs no vote. A null or blank value has no vote, so that the fuller record's value
survives; a field that no record fills stays null.

Ties: equal weights in a column take the smaller token; equal distances the heavier, then the smaller value.

Defined results: rows with a null key are in no group; a group of one is its own representative; equal rows vote twice;
an unreadable date counts as earliest, a missing trust as its default; an empty table gives an empty result.

Order of alignment: a field's values stand in the order of the least hash of their tokens, then of the value, so that values
with much in common are near each other. CHUNK neighbours are aligned (heaviest and longest first), then CHUNK neighbouring
profiles, and so on: one tree over one order, whatever a group's size.

Scale: a group's distinct values are weighted by a map-side combined aggregation and ranked without any task that holds a
group; no alignment has more than CHUNK members. Distances are measured value by value after a join with the consensus.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.numbers import normalize_priority
from newsloom.llm.address import KEYS, with_address
from newsloom.llm.tokens import GROUP_ROWS, numbered
from newsloom.operators.timestamps import normalize_timestamps
from newsloom.session import written

CHUNK = 64
Profile = list[dict[str, float]]  # a column: token -> weight; '' is the gap


def tokens(value: str) -> list[str]:
    return value.split()


def winners(profile: Profile) -> list[str]:
    return [min(column, key=lambda t: (-column[t], t)) for column in profile]


def aligned(a: Profile, b: Profile) -> Profile:
    """Both profiles in common columns. Columns pair where their winning tokens match; stretches between pair in turn."""
    if not a or not b:
        longer, other = (a, b) if a else (b, a)
        return [dict(c) for c in longer]
    wa, wb = sum(a[0].values()), sum(b[0].values())
    out: Profile = []

    def both(x: dict | None, y: dict | None) -> None:
        x, y = x or {"": wa}, y or {"": wb}
        out.append({t: x.get(t, 0.0) + y.get(t, 0.0) for t in {**x, **y}})

    for tag, i1, i2, j1, j2 in SequenceMatcher(None, winners(a), winners(b), autojunk=False).get_opcodes():
        same = min(i2 - i1, j2 - j1)
        for k in range(same):
            both(a[i1 + k], b[j1 + k])
        for k in range(i1 + same, i2):
            both(a[k], None)
        for k in range(j1 + same, j2):
            both(None, b[k])
    return out


def progressive(profiles: list[Profile]) -> Profile:
    """Heaviest and longest first, one after the other."""
    weight = lambda p: sum(p[0].values()) if p else 0.0
    rest = sorted(profiles, key=lambda p: (-weight(p), -len(p), winners(p)))
    return reduce(aligned, rest[1:], rest[0]) if rest else []


def distance(value: str, consensus: list[str]) -> float:
    return 1.0 - SequenceMatcher(None, tokens(value), consensus, autojunk=False).ratio()


def _align(rows: DataFrame, keys: list[str], from_profile: bool) -> DataFrame:
    """rows keys, chunk, value|profile, weight -> keys, chunk, profile: one per (keys, chunk)."""
    cols = [*keys, "chunk"]
    schema = ", ".join(f"{k} {dict(rows.dtypes)[k]}" for k in cols) + ", profile string"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []

        def flush() -> pd.DataFrame:
            profiles = [json.loads(p) for p in held] if from_profile else [[{t: w} for t in tokens(v)] for v, w in held]
            return pd.DataFrame([[*at, json.dumps(progressive([p for p in profiles if p]), ensure_ascii=False)]], columns=[*cols, "profile"])

        done: list[pd.DataFrame] = []
        for batch in batches:
            columns = [batch[c] for c in cols] + ([batch["profile"]] if from_profile else [batch["value"], batch["weight"]])
            for row in zip(*columns):
                if row[: len(cols)] != at:
                    if at is not None:
                        done.append(flush())
                    at, held = row[: len(cols)], []
                held.append(row[-1] if from_profile else row[-2:])
            if done:
                yield pd.concat(done, ignore_index=True)
                done = []
        if at is not None:
            yield flush()

    return rows.repartition(*cols).sortWithinPartitions(*cols).mapInPandas(work, schema)


def guide(value: Column) -> Column:
    """The least hash of a value's tokens."""
    return F.array_min(F.transform(F.split(F.trim(value), r"\s+"), lambda t: F.xxhash64(t)))


def consensus_values(votes: DataFrame, keys: list[str], chunk: int = CHUNK) -> DataFrame:
    """votes: keys, value, weight (one row per distinct value) -> keys, value: the existing value closest to the consensus."""
    single = votes.groupBy(*keys).agg(F.count("*").alias("n"), F.min("value").alias("only"))
    several = single.where("n > 1").select(*keys, "n")
    contested = written(votes.join(several, keys).withColumn("guide", guide(F.col("value"))), "votes")
    most = contested.agg(F.max("n")).first()[0] or 0
    # groups of a rank are cut by the leading bits of the guide, so that the ranks follow it
    bits = max(0, (most // GROUP_ROWS).bit_length())
    ranked = numbered(contested, keys, ["guide", "value"], "rank", salt=F.shiftright("guide", 64 - bits) if bits else F.lit(0).cast("bigint"))
    profiles = _align(ranked.withColumn("chunk", F.floor(F.col("rank") / chunk).cast("bigint")), keys, False)
    left = -(-most // chunk)  # profiles of the largest group
    while left > 1:
        profiles = _align(written(profiles, "profiles").withColumn("chunk", F.floor(F.col("chunk") / chunk).cast("bigint")), keys, True)
        left = -(-left // chunk)
    profiles = profiles.drop("chunk")

    @F.pandas_udf("double")
    def far(values: pd.Series, profiles: pd.Series) -> pd.Series:
        seen: dict[str, list[str]] = {}
        out = []
        for v, p in zip(values, profiles):
            if p not in seen:
                seen = {p: [t for t in winners(json.loads(p)) if t]}
            out.append(distance(v, seen[p]))
        return pd.Series(out, dtype=float)

    scored = contested.join(profiles, keys).withColumn("far", far("value", "profile"))
    best = scored.groupBy(*keys).agg(F.min_by("value", F.struct("far", -F.col("weight"), F.col("value"))).alias("value"))
    return single.where("n = 1").select(*keys, F.col("only").alias("value")).unionByName(best)


def best_records(df: DataFrame, *, id_column: str, keys: list[str], trust: Column, recency: Column, fields: list[str]) -> DataFrame:
    """One row per key: first_id, best_id, copies and a consensus value (as text) for each field.

    recency: a number, null for the earliest. Rows with a null first key are left out.
    """
    rows = df.select(F.col(id_column).alias("id"), *keys, trust.cast("int").alias("trust"), recency.cast("bigint").alias("recency"), *[F.col(f).cast("string").alias(f"f_{f}") for f in fields])
    rows = rows.where(F.col(keys[0]).isNotNull())
    rank = F.struct("trust", F.coalesce("recency", F.lit(-(2**62))), -F.col("id"))
    times = (F.min("recency").alias("oldest"), F.nullif(F.max("recency") - F.min("recency"), F.lit(0)).alias("span"))
    groups = rows.groupBy(*keys).agg(F.min("id").alias("first_id"), F.max_by("id", rank).alias("best_id"), F.count("*").alias("copies"), *times)
    groups = groups.where("copies > 1")
    held = written(rows.join(groups, keys).drop(*keys), "groups")
    weight = 1.0 + F.col("trust") / 10 + F.coalesce((F.col("recency") - F.col("oldest")) / F.col("span"), F.lit(0.0)) / 10
    stacked = held.select("first_id", weight.alias("weight"), F.posexplode(F.array(*[F.col(f"f_{f}") for f in fields])).alias("field", "value"))
    votes = stacked.where(F.trim(F.coalesce("value", F.lit(""))) != "").groupBy("first_id", "field", "value").agg(F.sum("weight").alias("weight"))
    chosen = consensus_values(votes, ["first_id", "field"])
    wide = chosen.groupBy("first_id").agg(*[F.max(F.when(F.col("field") == i, F.col("value"))).alias(f) for i, f in enumerate(fields)])
    heads = held.groupBy("first_id").agg(F.first("best_id").alias("best_id"), F.first("copies").alias("copies"))
    return heads.join(wide, "first_id", "left")


#: All columns of reddit_articles but the id, those of the struct metrics one by one; date by its normalised instant.
METRICS = ["score", "num_comments", "upvote_ratio"]
PLAIN = ["title", "flair", "topic", "source_id", "source_name", "link", "reddit_url", "external_url", "score", "num_comments", "is_self", "fetched_at"]
FIELDS = [*PLAIN, "date", *[f"metrics_{m}" for m in METRICS]]


def instant(second: Column) -> Column:
    """Seconds since 1970 as text, in UTC whatever the session's zone."""
    day, rest = F.floor(second / 86400), F.pmod(second, F.lit(86400))
    clock = F.format_string("T%02d:%02d:%02d+00:00", F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))
    return F.when(second.isNotNull(), F.concat(F.date_from_unix_date(day.cast("int")).cast("string"), clock))


def reddit_records(spark, sf: str, fields: list[str]) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/reddit_articles.parquet").select("article_id", "date", *PLAIN, *[F.col(f"metrics.{m}").alias(f"metrics_{m}") for m in METRICS])
    subreddits = spark.read.parquet(f"{sf}/reddit_subreddits.parquet")
    priority = subreddits.groupBy("source_id").agg(F.max("priority").alias("priority"))
    dated = normalize_timestamps(rows, value="date", fetched="fetched_at", key="source_id", zones=subreddits, zone_key="source_id", zone="tz")
    linked = with_address(dated.join(priority, "source_id", "left"), "link").withColumn("date", instant(F.col("ts_second")))
    return best_records(linked, id_column="article_id", keys=KEYS, trust=normalize_priority(F.col("priority")), recency=F.col("ts_second"), fields=fields)


def p5_found(spark, sf: str) -> DataFrame:
    """The records to keep, from the whole operator: each address's consensus is made and written beside its record."""
    return written(p5_records(spark, sf), "best-records").select("first_id", "best_id")


def p5_records(spark, sf: str) -> DataFrame:
    """Each address held twice or more: the record to keep and the best value of each field."""
    return reddit_records(spark, sf, FIELDS)
