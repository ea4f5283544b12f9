"""Mixed timestamp formats and time zones, brought to one UTC instant.

``normalize_timestamps`` reads a text column of times. A value with an offset, a zone name, an abbreviation, an epoch
number or a span back ("3 hours ago") needs nothing else. A value without a zone is a clock reading of its source. Where
the catalogue declares the source's zone, that zone is the only admissible offset history; where it declares none, the
history is estimated: every candidate zone converts the source's readings month by month, a reading that would lie after its
ingestion time violates the order of events, the other lags are priced by how usual they are among the readings whose instant
is certain, and the history of zones with the least price wins; a change of zone has a price too.

Defined results
* null, empty, blank, wordy, incomplete or impossible text -> null instant
* a reading that occurs twice in its zone -> the first; one that a clock change skips -> null; a bare day -> its first moment
* null or unknown source: an undeclared key is estimated over the rows without key as one more source; with no candidate
  zones at all -> null
* equal rows stay separate rows; a key that has only unreadable rows gets no zone; an empty table gives an empty table
* the columns added (prefix ``ts_``) never replace a column of the input: a clash raises ValueError

Scale: one pass that parses and tallies (source, month, candidate zone, lag bin) with map-side combination, a path search per
source over its months, and joins of the small results. No row is shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import dates
from newsloom.session import written

#: A clock may run this far ahead of the one that stamped the ingestion.
TOLERANCE_S = 60
#: Least seconds of each bin of lags: hours for a day, then coarser. Bins that aren't lags.
HOURS = 24
LAG_BINS = [3600 * h for h in (*range(HOURS + 1), 48, 96, 192)]
VIOLATED, NO_EVIDENCE = -1, 99
#: Price of a violation and of a change of zone, as negative logarithms of a probability.
VIOLATION, CHANGE = 12.0, 15.0


def _clash(df: DataFrame, added: list[str]) -> None:
    if taken := {c.lower() for c in df.columns} & {c.lower() for c in added}:
        raise ValueError(f"columns already there: {sorted(taken)}")


def parse_times(df: DataFrame, value: str, fetched: str) -> DataFrame:
    """Adds ts_local (clock reading), ts_bare, ts_zone (as written, '' if none), ts_fixed (seconds, where no source zone is needed)."""
    _clash(df, ["ts_local", "ts_bare", "ts_zone", "ts_fixed", "ts_read"])

    def read_fields(f: Column) -> Column:
        p = dates.parts(f)
        return F.struct(dates.local_timestamp(f).alias("local"), p["bare"].alias("bare"), p["zone"].alias("zone"))

    def settle(r: Column) -> Column:
        wall, offset = F.unix_seconds(r["local"]), dates.zone_seconds(r["zone"])
        named = F.when(dates.is_zone(r["zone"]), F.unix_seconds(dates.local_to_utc(r["local"], r["zone"], r["bare"])))
        back = F.unix_seconds(F.col(fetched)) - dates.span_seconds(F.col(value))
        fixed = (
            F.when(r["local"].isNotNull(), F.when(r["zone"] == "", None).otherwise(F.coalesce(wall - offset, named)))
            .when(r["zone"].isNull(), F.coalesce(dates.epoch_seconds(F.col(value)), back))
        )
        return F.struct(r["local"].alias("local"), r["bare"].alias("bare"), r["zone"].alias("zone"), fixed.alias("fixed"))

    # nested so that the text is matched once a row: a chain of projections would be inlined into every use
    reading = dates.once(dates.once(dates.time_fields(F.col(value)), read_fields), settle)
    out = df.withColumn("ts_read", reading)
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.col(f"ts_read.{x}").alias(f"ts_{x}") for x in ("local", "bare", "zone", "fixed")],
    )


def _month(local: Column) -> Column:
    return (F.year(local) * 12 + F.month(local) - 1).cast("int")


def lag_bin(lag: Column, bare: Column, tolerance_s: int) -> Column:
    """VIOLATED, the bin of LAG_BINS, or NO_EVIDENCE where there is no lag or the reading is a whole day wide."""
    hours = F.floor(lag / 3600).cast("int")
    bins = F.when(hours < HOURS, hours)
    for i, edge in enumerate(LAG_BINS[HOURS + 1 :]):
        bins = bins.when(lag < edge, HOURS + i)
    bins = bins.otherwise(len(LAG_BINS) - 1)
    return F.when(lag < -tolerance_s, VIOLATED).when(lag.isNull() | bare, NO_EVIDENCE).otherwise(bins)


def offset_histories(tallies: Iterator[pd.DataFrame], costs: np.ndarray) -> pd.DataFrame:
    """Per month of one key the zone on the cheapest path: the cost of its lags, and CHANGE for each change of zone."""
    t = pd.concat(tallies)
    price = np.where(t["bin"] == VIOLATED, VIOLATION, np.where(t["bin"] == NO_EVIDENCE, 0.0, costs[t["bin"].clip(0, len(costs) - 1)]))
    t = t.assign(cost=price * t["n"], violations=np.where(t["bin"] == VIOLATED, t["n"], 0))
    cost, bad, n = (t.pivot_table(index="ts_month", columns="zone", values=v, aggfunc="sum", fill_value=0) for v in ("cost", "violations", "n"))
    zones, c = cost.columns.to_numpy(), cost.to_numpy(float)
    total, back = c[0].copy(), []
    for row in c[1:]:
        best = int(np.argmin(total))  # the first in the alphabet on ties
        stay = total <= total[best] + CHANGE
        back.append(np.where(stay, np.arange(len(zones)), best))
        total = np.where(stay, total, total[best] + CHANGE) + row
    path = [int(np.argmin(total))]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    path = np.array(path[::-1])
    at = np.arange(len(c))
    return pd.DataFrame({"ts_key": t["ts_key"].iloc[0], "ts_month": cost.index.to_numpy(), "ts_estimated": zones[path], "ts_readings": n.to_numpy()[at, path], "ts_violations": bad.to_numpy()[at, path]})


def estimate_zones(parsed: DataFrame, key: str, fetched: str, candidates: list[str], tolerance_s: int = TOLERANCE_S) -> DataFrame:
    """Per key and month of its zone-less readings the zone of the offset history that fits the ingestion times best.

    Returns ts_key, ts_month (months since year 0), ts_estimated, ts_readings, ts_violations. The readings whose instant
    needs no zone say how long after its time a record is ingested. With that distribution of lags every candidate zone has
    a price for a month's readings, a violation of the order of events (a reading after its ingestion) the highest; the
    history with the least price, changes of zone included, wins. Ties go to the zone that stands first in the alphabet.
    """
    schema = f"ts_key {dict(parsed.dtypes)[key]}, ts_month int, ts_estimated string, ts_readings bigint, ts_violations bigint"
    if not candidates:
        return parsed.sparkSession.createDataFrame([], schema)
    # no filter: it would be pushed below the parser and match every text twice; rows that say nothing explode to nothing
    at = F.unix_seconds(F.col(fetched))
    tally = lambda zone, lag, bare: F.struct(F.lit(zone).cast("string").alias("zone"), lag_bin(lag, bare, tolerance_s).alias("bin"))
    open_ = F.array(*[tally(z, at - F.unix_seconds(F.to_utc_timestamp("ts_local", F.lit(z))), F.col("ts_bare")) for z in sorted(set(candidates))])
    known = F.array(tally(None, at - F.col("ts_fixed"), F.lit(False)))
    said = F.when((F.col("ts_zone") == "") & F.col("ts_local").isNotNull(), open_).when((F.col("ts_zone") != "") & F.col("ts_fixed").isNotNull(), known)
    rows = parsed.select(F.col(key).alias("ts_key"), _month(F.col("ts_local")).alias("ts_month"), F.inline(said))
    tallies = written(rows.groupBy("ts_key", "ts_month", "zone", "bin").agg(F.count("*").alias("n")), "lag-tallies")
    seen = np.ones(len(LAG_BINS))
    for r in tallies.where(f"zone is null and bin between 0 and {len(LAG_BINS) - 1}").groupBy("bin").agg(F.sum("n").alias("n")).collect():  # a row per bin
        seen[r["bin"]] += r["n"]
    costs = -np.log(seen / seen.sum() / np.diff([*LAG_BINS, 2 * LAG_BINS[-1]]) * LAG_BINS[1])
    return tallies.where("zone is not null").groupBy("ts_key").applyInPandas(lambda t: offset_histories([t], costs), schema)


def normalize_timestamps(
    df: DataFrame,
    *,
    value: str,
    fetched: str,
    key: str,
    zones: DataFrame,
    zone_key: str,
    zone: str,
    candidates: list[str] | None = None,
    tolerance_s: int = TOLERANCE_S,
) -> DataFrame:
    """All rows of df with ts_utc (instant), ts_second (whole seconds), ts_how ('written', 'declared', 'estimated' or null).

    zones declares the zone of each key (unknown names count as undeclared). candidates: zones to choose from for keys
    without a declared one; default all that zones declares.
    """
    _clash(df, ["ts_utc", "ts_second", "ts_how", "ts_key"])
    declared = zones.groupBy(F.col(zone_key).alias("ts_key")).agg(F.min(F.when(dates.is_zone(F.col(zone)), F.col(zone))).alias("ts_declared"))
    if candidates is None:  # a catalogue names at most as many distinct zones as there are
        candidates = [r[0] for r in zones.select(zone).where(dates.is_zone(F.col(zone))).distinct().collect()]
    parsed = parse_times(df, value, fetched)
    estimated = estimate_zones(parsed, key, fetched, candidates, tolerance_s).select(F.col("ts_key").alias("ts_of"), "ts_month", "ts_estimated")
    # null is a key of its own
    out = parsed.join(declared, parsed[key].eqNullSafe(declared["ts_key"]), "left")
    out = out.join(estimated, out[key].eqNullSafe(estimated["ts_of"]) & (_month(out["ts_local"]) == estimated["ts_month"]), "left")
    offset_history = F.coalesce("ts_declared", "ts_estimated")
    local = F.unix_seconds(dates.local_to_utc(F.col("ts_local"), offset_history, F.col("ts_bare")))
    zoneless = (F.col("ts_zone") == "") & F.col("ts_local").isNotNull()
    second = F.when(zoneless, local).otherwise(F.col("ts_fixed"))
    how = F.when(~zoneless, "written").when(F.col("ts_declared").isNotNull(), "declared").otherwise("estimated")
    return out.withColumn("ts_second", second).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.timestamp_seconds("ts_second").alias("ts_utc"),
        "ts_second",
        F.when(F.col("ts_second").isNotNull(), how).alias("ts_how"),
    )


def read(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Article tables whose dates are free text: the column that names a row's source, the catalogue of the sources and its key.
DATED = (("twitter_articles", "source_id", "feed_sources", "source_id"), ("reddit_articles", "source_id", "reddit_subreddits", "source_id"), ("web_articles", "topic", "web_topics", "topic_id"))


def article_times(spark, sf: str) -> DataFrame:
    """table, article_id, date, ts_second, ts_how over the three article tables whose dates are free text."""
    parts = []
    for table, key, catalogue, zone_key in DATED:
        rows = read(spark, sf, table).select("article_id", "date", "fetched_at", F.col(key).alias("zone_of"))
        done = normalize_timestamps(rows, value="date", fetched="fetched_at", key="zone_of", zones=read(spark, sf, catalogue), zone_key=zone_key, zone="tz")
        parts.append(done.select(F.lit(table).alias("table_name"), "article_id", "date", "ts_second", "ts_how"))
    return reduce(DataFrame.unionByName, parts)


def p3_found(spark, sf: str) -> DataFrame:
    rows = article_times(spark, sf).where(F.col("ts_second").isNotNull() & ~F.col("date").rlike(dates.ALREADY_UTC_RE))
    return rows.select("article_id", F.col("ts_second").alias("utc_second"))


def p3_how(spark, sf: str) -> DataFrame:
    """How many dates of each table were readable, and what settled their zone."""
    rows = article_times(spark, sf)
    return rows.groupBy("table_name", F.coalesce("ts_how", F.lit("unreadable")).alias("how")).agg(F.count("*").alias("n"), F.min("ts_second").alias("first_second"), F.max("ts_second").alias("last_second"))


def p3_estimated_zones(spark, sf: str) -> DataFrame:
    """What the estimation says for each source of the three tables when no zone is declared, beside the declared zone.

    same: zone-less readings that mean the same instant by both; changes: changes of zone in the estimated history.
    """
    parts = []
    for table, key, catalogue, zone_key in DATED:
        declared = read(spark, sf, catalogue).groupBy(F.col(zone_key).alias("source")).agg(F.min(F.when(dates.is_zone(F.col("tz")), F.col("tz"))).alias("declared"))
        zones = [r[0] for r in declared.where("declared is not null").select("declared").distinct().collect()]
        parsed = parse_times(read(spark, sf, table).select(F.col(key).alias("zone_of"), "date", "fetched_at"), "date", "fetched_at")
        found = estimate_zones(parsed, "zone_of", "fetched_at", zones)
        open_ = parsed.select("zone_of", "ts_local", F.when(F.col("ts_zone") == "", _month(F.col("ts_local"))).alias("ts_month"))
        met = open_.join(found, (open_["zone_of"] == found["ts_key"]) & (open_["ts_month"] == found["ts_month"])).join(declared, F.col("ts_key") == F.col("source"))
        same = F.count_if(F.to_utc_timestamp("ts_local", F.col("declared")) == F.to_utc_timestamp("ts_local", F.col("ts_estimated")))
        agreed = met.groupBy("ts_key", "declared").agg(same.alias("same"))
        per = found.where("ts_key is not null").groupBy("ts_key").agg(F.max_by("ts_estimated", found["ts_month"]).alias("estimated"), (F.count_distinct("ts_estimated") - 1).alias("changes"), F.sum("ts_readings").alias("readings"), F.sum("ts_violations").alias("violations"))
        parts.append(per.join(agreed, "ts_key").select(F.lit(table).alias("table_name"), F.col("ts_key").alias("source"), "declared", "estimated", "changes", "readings", "violations", "same"))
    return reduce(DataFrame.unionByName, parts)
