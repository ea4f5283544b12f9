"""Request traces, step and pipeline status, and the health history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.numbers import rounded
from newsloom.functions.text import collapse
from newsloom.params import DEFAULTS, REGISTRY, Params


def normalized_traces(df: DataFrame) -> DataFrame:
    """Missing side of the timing mirrors the other (3 digits), attempt at least 1, error text collapsed and cut at 300."""
    active, total = F.col("active_s"), F.col("total_s")
    d = df.withColumns({"active_s": rounded(F.coalesce(active, total, F.lit(0.0))), "total_s": rounded(F.coalesce(total, active, F.lit(0.0)))})
    if "attempt" in df.columns:
        d = d.withColumn("attempt", F.greatest(F.lit(1), F.coalesce(F.col("attempt").try_cast("int"), F.lit(1))))
    return d.withColumn("error", F.when(F.col("error").isNotNull(), F.substring(collapse(F.col("error")), 1, 300)))


def timing_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: requests, ok, errors, and mean, least, most, median, p90, p95 of active and total time.

    df: normalised traces, whose times are whole milliseconds. Requests are counted by time first, so that the exact
    quantiles are taken over as many values as times below the timeout have milliseconds, not over the requests.
    """
    out = df.groupBy(*keys).agg(F.count("*").alias("requests"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("errors"))
    for side in ("active", "total"):
        c = F.col(f"{side}_s")
        counted = df.groupBy(*keys, f"{side}_s").agg(F.count("*").alias("n"))
        aggs = [rounded(F.sum(c * F.col("n")) / F.sum("n")).alias(f"{side}_avg"), rounded(F.min(c)).alias(f"{side}_min"), rounded(F.max(c)).alias(f"{side}_max")]
        aggs += [rounded(F.percentile(c, q, F.col("n"))).alias(f"{side}_p{int(q * 100)}") for q in (0.5, 0.9, 0.95)]
        out = out.join(counted.groupBy(*keys).agg(*aggs), keys)
    return out


def slow_buckets(df: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    """Per group and bucket [t_i, t_i+1), the last one open: count and share of the group's requests (4 digits), zero-filled."""
    marks = sorted({t for t in params.slow_thresholds if t > 0})
    ranges = [(i, f"{lo:.1f}-{hi:.1f}" if hi else f"{lo:.1f}+", lo, hi) for i, (lo, hi) in enumerate(zip(marks, [*marks[1:], None]))]
    aggs = [F.count("*").alias("total")]
    for i, _, lo, hi in ranges:
        inside = (F.col("active_s") >= lo) & ((F.col("active_s") < hi) if hi else F.lit(True))
        aggs.append(F.count_if(inside).alias(f"b{i}"))
    wide = df.groupBy(*keys).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(label).alias("bucket"), F.col(f"b{i}").alias("n"), F.bround(F.col(f"b{i}") / F.col("total"), 4).alias("rate")) for i, label, _, _ in ranges])
    return wide.select(*keys, "total", F.inline(rows))


def failed_items(df: DataFrame) -> DataFrame:
    """Requests that aren't ok and say why, as items: source, target, status, error (two lines, cut), method, attempt, timing.

    Sort by active_s (most first) to report; the rows have no order of their own.
    """
    own = lambda c, default: X.first_filled(F.trim(F.col(c).cast("string")), F.lit(default)) if c in df.columns else F.lit(default)
    attempt = F.greatest(F.lit(1), F.coalesce(F.col("attempt").try_cast("int"), F.lit(1))) if "attempt" in df.columns else F.lit(1)
    added = {"source_id": own("source_id", "item"), "target": own("target", ""), "method": own("method", ""), "attempt": attempt, "backend": own("backend", ""), "adapter": own("adapter", "")}
    return df.where((F.col("status") != "ok") & (X.error_text(F.col("error")) != "")).withColumns({"error": X.error_text(F.col("error")), **added})


def slow_requests(df: DataFrame, keys: list[str], params: Params = DEFAULTS) -> DataFrame:
    """Per group: how many requests are slow at all, and the buckets as an array (label, n, rate)."""
    b = slow_buckets(df, keys, params)
    return b.groupBy(*keys).agg(F.sum("n").alias("total_count"), F.array_sort(F.collect_list(F.struct("bucket", "n", "rate"))).alias("buckets"))  # a row a threshold


def call_stats(kind: Column, total: Column, ok: Column, failed: Column | None = None, partial: Column | None = None) -> Column:
    """struct<kind, total_calls, ok_calls, failed_calls, partial_calls>: none below 0, failed is what isn't ok unless given, partial null unless positive."""
    zero = F.lit(0).cast("bigint")
    n = lambda c: F.greatest(zero, F.coalesce(c.cast("bigint"), zero))
    rest = F.greatest(zero, n(total) - n(ok))
    part = n(partial) if partial is not None else zero
    return F.struct(
        X.first_filled(kind, F.lit("step")).alias("kind"), n(total).alias("total_calls"), n(ok).alias("ok_calls"),
        (rest if failed is None else F.when(failed.isNull(), rest).otherwise(n(failed))).alias("failed_calls"), F.when(part > 0, part).alias("partial_calls"),
    )


def reconciled_status(process: Column, meta: Column) -> Column:
    """Status of a step from its process and from what it wrote: a timeout stands, an error outweighs a written ok."""
    return F.when(process == "timeout", "timeout").when((process == "error") & (meta == "ok"), "error").otherwise(F.coalesce(F.nullif(meta, F.lit("")), process))


def fetch_step_summary(processes: DataFrame, metas: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row a fetch step: status, items, calls, elapsed. What the step wrote about itself counts where it did, else its output.

    processes: step_key, process_status, process_elapsed_s; metas: step_key, status, items, calls_total, calls_ok, failed_calls, elapsed_s;
    outputs: step_key, articles (number of articles in its output file).
    """
    m = metas.select("step_key", F.col("status").alias("m_status"), F.col("items").alias("m_items"), F.col("calls_total").alias("m_total"), F.col("calls_ok").alias("m_ok"), F.col("failed_calls").alias("m_failed"), F.col("elapsed_s").alias("m_elapsed"), F.lit(True).alias("has_meta"))
    d = processes.join(m, "step_key", "left").join(outputs, "step_key", "left")
    meta, made = F.coalesce("has_meta", F.lit(False)), F.col("articles").isNotNull()
    bare = F.when((F.col("process_status") == "ok") & (F.coalesce("articles", F.lit(0)) > 0), "ok").otherwise(F.col("process_status"))
    status = F.when(meta, reconciled_status(F.col("process_status"), F.col("m_status"))).otherwise(bare)
    total = F.when(meta, F.coalesce("m_total", F.lit(0))).otherwise(made.cast("int"))
    ok = F.when(meta, F.coalesce("m_ok", F.lit(0))).otherwise((bare == "ok").cast("int"))
    stats = call_stats(F.col("step_key"), total, ok, F.when(meta, F.col("m_failed")))
    items = F.when(meta, F.coalesce("m_items", F.lit(0))).otherwise(F.coalesce("articles", F.lit(0)))
    return d.select("step_key", status.alias("status"), items.cast("bigint").alias("items"), stats.alias("call_stats"), F.coalesce("m_elapsed", "process_elapsed_s").alias("elapsed_s"))


def merge_step_summary(process_status: Column, written: Column, items: Column, input_items: Column) -> Column:
    """struct of the merge step: ok only if its document was written; one call then."""
    status = F.when((process_status == "ok") & written, "ok").otherwise(process_status)
    return F.struct(status.alias("status"), F.when(written, items).otherwise(0).alias("items"), F.when(written, input_items).otherwise(0).alias("input_items"), written.cast("int").alias("calls_total"), (written & (status == "ok")).cast("int").alias("calls_ok"))


def pipeline_overview(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Per run and step of the registry: status, whether fully successful, items, calls, elapsed. steps: step_runs with status."""
    registry = F.array(*[F.lit(t) for t in REGISTRY])
    rows = steps.where(F.array_contains(registry, F.col("step_key")))
    return rows.select(*keys, "step_key", "status", (F.col("status") == "ok").alias("fully_successful"), "items", "calls_total", "calls_ok", "calls_failed", "elapsed_s")


def pipeline_roll_up(steps: DataFrame, keys: list[str], wall_s: Column | None = None) -> DataFrame:
    """Per run: status, active seconds over the steps, items of the last step that has any (hotspots, else merge), call counts of steps.

    steps: keys, step_key, status, items, elapsed_s; source steps and the steps merge-sources and merge-hotspots.
    """
    fetch = ~F.col("step_key").isin("merge-sources", "merge-hotspots")
    of = lambda k: F.max(F.when(F.col("step_key") == k, F.col("items")))
    more = steps.groupBy(*keys).agg(rounded(F.sum(F.when(fetch, F.col("elapsed_s")))).alias("fetch_active_s"), F.coalesce(of("merge-hotspots"), of("merge-sources"), F.lit(0)).alias("items"))
    out = pipeline_status(steps, keys).join(more, keys)
    return out if wall_s is None else out.withColumn("wall_s", rounded(wall_s))


def pipeline_state(overall: Column, merge: Column, hotspots: Column, failed: Column, partial: Column, skipped: Column) -> Column:
    """Health of a whole run: error if it, its merge or its selection isn't ok or a step failed; partial and skipped steps warn."""
    bad = overall.isin("error", "timeout") | (F.coalesce(merge, F.lit("error")) != "ok") | (F.coalesce(hotspots, F.lit("error")) != "ok") | (failed > 0)
    return F.when(bad, "error").when((partial > 0) | (skipped > 0), "warn").otherwise("ok")


def pipeline_states(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Per run: pipeline_state from its steps' statuses."""
    s, named = F.col("status"), lambda k: F.max(F.when(F.col("step_key") == k, F.col("status")))
    g = steps.groupBy(*keys).agg(named("merge-sources").alias("merge"), named("merge-hotspots").alias("hotspots"), F.count_if(s.isin("error", "timeout")).alias("failed"), F.count_if(s == "partial").alias("partial"), F.count_if(s == "skipped").alias("skipped"), F.count("*").alias("steps"))
    overall = F.when(F.col("steps") == 0, "error").otherwise("ok")
    return g.withColumn("state", pipeline_state(overall, F.col("merge"), F.col("hotspots"), F.col("failed"), F.col("partial"), F.col("skipped")))


def step_status(total: Column, ok: Column, items: Column) -> Column:
    return F.when((total <= 0) | (ok <= 0) | (items <= 0), "error").when(ok < total, "partial").otherwise("ok")


def step_runs(traces: DataFrame) -> DataFrame:
    """One row per step and day: calls, ok and failed calls, items (ok calls), status, active time capped by total."""
    g = traces.groupBy("step_key", "run_date").agg(F.count("*").alias("calls_total"), F.count_if(F.col("status") == "ok").alias("calls_ok"), F.sum("active_s").alias("a"), F.sum("total_s").alias("t"))
    g = g.withColumns({"calls_failed": F.greatest(F.lit(0), F.col("calls_total") - F.col("calls_ok")), "items": F.col("calls_ok")})
    g = g.withColumn("status", step_status(F.col("calls_total"), F.col("calls_ok"), F.col("items")))
    return g.withColumn("elapsed_s", rounded(F.least("a", "t"))).drop("a", "t")


def pipeline_status(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Per run: counts by status (a timeout is an error) and the status of the whole."""
    s = F.col("status")
    g = steps.groupBy(*keys).agg(
        F.count("*").alias("steps"), F.count_if(s == "ok").alias("ok"), F.count_if(s == "partial").alias("partial"),
        F.count_if(s == "skipped").alias("skipped"), F.count_if(s.isin("error", "timeout")).alias("error"),
    )
    whole = F.when(F.col("steps") == 0, "error").when(F.col("ok") == F.col("steps"), "ok").when(F.col("ok") + F.col("partial") + F.col("skipped") > 0, "partial").otherwise("error")
    return g.withColumn("non_ok", F.col("steps") - F.col("ok")).withColumn("status", whole)


def step_state(status: Column, failed: Column, partial: Column | None = None) -> Column:
    """Health of a run: error, skipped, or ok, which failed or partial calls make a warning."""
    worse = failed > 0 if partial is None else (failed > 0) | (partial > 0)
    return F.when(status.isin("error", "timeout", "pending"), "error").when(status == "skipped", "skipped").when(worse, "warn").otherwise("ok")


def health_history(runs: DataFrame, now: Column, params: Params = DEFAULTS) -> DataFrame:
    """Per step over the last days: checks by state, degraded rate, unhealthy flag, median elapsed, latest issue and its error.

    runs: step_key, observed (timestamp), status, calls_failed, elapsed_s, and error if known. Skipped runs are no checks.
    Elapsed times are whole milliseconds and counted first, so the median is over as many values as there are of these.
    """
    since = F.unix_seconds(now) - params.health_days * 86400
    d = runs.where(F.unix_seconds("observed") > since).withColumn("state", step_state(F.col("status"), F.col("calls_failed"))).where("state <> 'skipped'")
    bad, error = F.col("state") != "ok", F.col("error") if "error" in runs.columns else F.lit(None).cast("string")
    g = d.groupBy("step_key").agg(
        F.count("*").alias("checks"), F.count_if(F.col("state") == "ok").alias("ok"), F.count_if(F.col("state") == "warn").alias("warn"),
        F.count_if(F.col("state") == "error").alias("error"), F.max(F.when(bad, F.unix_seconds("observed"))).alias("latest_issue"),
        X.error_text(F.max_by(F.when(bad, error), F.when(bad, F.col("observed")))).alias("latest_error"),
    )
    timed = d.withColumn("elapsed_s", rounded(F.col("elapsed_s"))).groupBy("step_key", "elapsed_s").agg(F.count("*").alias("n"))
    g = g.join(timed.groupBy("step_key").agg(rounded(F.percentile("elapsed_s", 0.5, F.col("n"))).alias("median_elapsed_s")), "step_key")
    g = g.withColumn("degraded_rate", F.bround((F.col("warn") + F.col("error")) / F.col("checks"), 4))
    return g.withColumn("unhealthy", (F.col("checks") >= 2) & (F.col("degraded_rate") > params.degraded_rate))


# Signs of states and statuses.
STATE_ICONS = {"ok": "✅", "warn": "⚠️", "error": "⚠️", "skipped": "⏭️"}
STATUS_ICONS = {"ok": "✅", "partial": "⚠️", "timeout": "⏱️"}


def status_icon(status: Column) -> Column:
    out = F.when(F.lit(False), "")
    for k, v in STATUS_ICONS.items():
        out = out.when(status == k, v)
    return out.otherwise("❌")


def elapsed_text(seconds: Column) -> Column:
    """Seconds with one digit; 0.0s for what is no number."""
    return F.concat(F.format_string("%.1f", F.bround(F.coalesce(seconds.try_cast("double"), F.lit(0.0)), 1)), F.lit("s"))


def timing_text(active: Column, total: Column) -> Column:
    """Both times, or one where they read the same."""
    a, t = elapsed_text(active), elapsed_text(total)
    return F.when(a == t, t).otherwise(F.concat(F.lit("active "), a, F.lit(", total "), t))


def elapsed_suffix(seconds: Column) -> Column:
    """` (1.0s)` behind an error; nothing where no positive time is known."""
    s = seconds.try_cast("double")
    return F.when(s > 0, F.concat(F.lit(" ("), elapsed_text(s), F.lit(")"))).otherwise("")


def history_report(history: DataFrame, params: Params = DEFAULTS, limit: int = 20) -> DataFrame:
    """line_no, line: how many steps are tracked and unhealthy, then the worst steps. history: health_history (a row a step)."""
    n = history.agg(F.count("*").alias("n"), F.count_if("unhealthy").alias("bad")).first()
    order = Window.orderBy(F.desc("degraded_rate"), F.desc("error"), "step_key")  # a row a step
    top = history.withColumn("line_no", F.row_number().over(order) + 1).where(F.col("line_no") <= limit + 1)
    wide = top.agg(F.max(F.length("step_key"))).first()[0] or 0
    icon = F.when(F.col("unhealthy") | (F.col("warn") > 0) | (F.col("error") > 0), "⚠️").otherwise("✅")
    counts = F.concat_ws(" ", *[F.concat(F.lit(f"{k}:"), F.col(k).cast("string")) for k in ("ok", "warn", "error")])
    share = F.concat(F.bround(F.col("degraded_rate") * 100, 0).cast("int").cast("string"), F.lit("% degraded"))
    line = F.concat(icon, F.lit(" "), F.rpad("step_key", wide, " "), F.lit(" - "), counts, F.lit(" ("), share, F.lit(")"))
    head = history.sparkSession.createDataFrame([(1, f"History report: {n['n']} steps tracked, {n['bad']} unhealthy in last {params.health_days} days")], "line_no int, line string")
    return head.unionByName(top.select("line_no", line.alias("line")))


def run_lines(runs: DataFrame, failed: DataFrame) -> DataFrame:
    """run_label, part, line of each run's report: a line a step (the pipeline first, then by name), its failures below it.

    runs: run_label, step_key, status, state, call_stats, items, elapsed_s; failed: run_label, step_key, source_id, error, active_s.
    """
    c = F.col("call_stats")
    wide = runs.agg(F.max(F.length("step_key"))).first()[0] or 0
    icon = F.when(F.lit(False), "")
    for k, v in STATE_ICONS.items():
        icon = icon.when(F.col("state") == k, v)
    calls = F.concat(F.lit("calls:"), F.concat_ws("/", c["ok_calls"].cast("string"), c["failed_calls"].cast("string"), c["total_calls"].cast("string")), F.when(c["partial_calls"] > 0, F.concat(F.lit(" | partial:"), c["partial_calls"].cast("string"))).otherwise(""))
    place = F.struct((F.col("step_key") != "pipeline").alias("p"), F.col("step_key").alias("k"))
    line = F.concat(icon.otherwise("✅"), F.lit(" "), F.rpad("step_key", wide, " "), F.lit(" - "), calls, F.lit(" | items:"), F.col("items").cast("string"), F.lit(" | elapsed:"), elapsed_text(F.col("elapsed_s")))
    below = F.concat(F.lit("   - "), F.col("source_id"), F.lit(": "), X.error_text(F.col("error")), elapsed_suffix(F.col("active_s")))
    shown = runs.select("run_label", F.struct(place.alias("s"), F.lit(0).alias("o"), F.lit("").alias("x")).alias("part"), line.alias("line"))
    return shown.unionByName(failed.select("run_label", F.struct(place.alias("s"), F.lit(1).alias("o"), below.alias("x")).alias("part"), below.alias("line")))


def run_label(day: Column, file_name: Column) -> Column:
    """`YYYY-MM-DD-n` of an archived meta file: no number in its name is the first run; null for other names."""
    number = F.regexp_extract(file_name, META_NAME, 2)
    return F.when(file_name.rlike(META_NAME), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("-"), F.when(number == "", "1").otherwise((number.cast("int") + 1).cast("string"))))


def run_order(label: Column) -> Column:
    """Sorts run labels by day and run number."""
    number = F.substring_index(label, "-", -1).try_cast("int")
    return F.struct(F.when(number.isNull(), label).otherwise(F.substring(label, F.lit(1), F.length(label) - F.length(F.substring_index(label, "-", -1)) - 1)).alias("day"), F.coalesce(number, F.lit(0)).alias("run"))


#: A step's meta file: name, run suffix.
META_NAME = r"^([a-z][a-z_-]*?)(\d*)\.meta\.json$"
