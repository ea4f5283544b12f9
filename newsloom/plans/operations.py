"""Queries of the operational side: roll-ups, states and reports of runs, rules and overlays of configuration files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import dates
from newsloom.functions.numbers import flagged_priority
from newsloom.operators import config
from newsloom.operators import diagnostics as G
from newsloom.params import REGISTRY
from newsloom.sources.tables import read, traces


def slow_requests(spark, sf):
    return G.slow_requests(traces(spark, sf), ["step_key"]).select("step_key", "total_count", F.size("buckets").cast("bigint").alias("buckets"))


def _steps(spark, sf) -> DataFrame:
    """Runs of the source steps, and of the two merge steps beside them."""
    runs = G.step_runs(traces(spark, sf))
    name = F.element_at(F.array(*[F.lit(t) for t in REGISTRY]), F.regexp_extract("step_key", r"\d+", 0).cast("int") + 1)
    source = runs.withColumn("step_key", name)
    days = runs.select("run_date").distinct()
    day = F.dayofmonth("run_date")
    merge = days.select("run_date", F.lit("merge-sources").alias("step_key"), F.when(day % 7 == 0, "error").otherwise("ok").alias("status"), F.lit(100).cast("bigint").alias("items"))
    hot = days.select("run_date", F.lit("merge-hotspots").alias("step_key"), F.lit("ok").alias("status"), day.cast("bigint").alias("items")).where(day % 5 > 0)
    return source.unionByName(merge.unionByName(hot), allowMissingColumns=True)


def pipeline_overview(spark, sf):
    return G.pipeline_overview(_steps(spark, sf), ["run_date"])


def pipeline_roll_up(spark, sf):
    return G.pipeline_roll_up(_steps(spark, sf), ["run_date"]).select("run_date", "steps", "ok", "non_ok", "status", "fetch_active_s", "items")


def pipeline_states(spark, sf):
    return G.pipeline_states(_steps(spark, sf), ["run_date"]).select("run_date", "state", "failed", "partial")


def fetch_summaries(spark, sf):
    """Processes, what they wrote about themselves, and their outputs, of three kinds of runs."""
    runs = G.step_runs(traces(spark, sf)).withColumn("step_key", F.concat_ws("/", "run_date", "step_key"))
    n = F.pmod(F.xxhash64("step_key"), F.lit(3)) * 0 + F.length("step_key") % 3
    process = F.when(n == 0, "timeout").when(n == 1, "error").otherwise("ok")
    processes = runs.select("step_key", process.alias("process_status"), F.lit(9.5).alias("process_elapsed_s"))
    outputs = runs.where("items % 2 = 0").select("step_key", F.col("items").alias("articles"))
    metas = runs.where("items % 3 > 0").select("step_key", "status", "items", "calls_total", "calls_ok", F.col("calls_failed").alias("failed_calls"), "elapsed_s")
    return G.fetch_step_summary(processes, metas, outputs).select("step_key", "status", "items", "call_stats.total_calls", "call_stats.ok_calls", "call_stats.failed_calls", "elapsed_s")


def history_report(spark, sf):
    runs = G.step_runs(traces(spark, sf)).withColumn("observed", F.col("run_date").cast("timestamp"))
    h = G.health_history(runs, F.lit("2024-01-31 00:00:00").cast("timestamp"))
    return G.history_report(h).select(F.col("line_no").cast("bigint").alias("line_no"), "line")


def timing_texts(spark, sf):
    runs = G.step_runs(traces(spark, sf))
    return runs.select("step_key", "run_date", G.status_icon(F.col("status")).alias("icon"), G.timing_text(F.col("elapsed_s"), F.col("elapsed_s") * (F.dayofmonth("run_date") % 2 + 1)).alias("timing"), G.elapsed_suffix(F.when(F.col("status") != "ok", F.col("elapsed_s"))).alias("suffix"), G.run_label(F.col("run_date"), F.concat("step_key", F.lit(".meta.json"))).alias("label"))


def source_file_rules(spark, sf):
    """The feed catalogue as a file, against the rules of such files."""
    one = F.struct(F.col("source_id").alias("id"), F.col("source_name").alias("name"), F.col("source_type").alias("type"), (F.col("status") == "ok").alias("enabled"), "priority", "topic", "url")
    files = read(spark, sf, "feed_sources").agg(F.to_json(F.struct(F.collect_list(one).alias("sources"))).alias("content"))  # a catalogue of fixed size
    return config.source_file_violations(files, read(spark, sf, "web_topics"), "rss", "url")


def topic_file_rules(spark, sf):
    search = F.struct(F.when(F.col("queries_ok") > 3, F.array(F.col("topic_id"))).alias("google_queries"))
    one = F.struct(F.col("topic_id").alias("id"), F.col("freshness").alias("emoji"), F.col("topic_id").alias("label"), F.col("status").alias("description"), search.alias("search"), F.struct((F.col("queries_ok") - 4).alias("max_items")).alias("display"))
    files = read(spark, sf, "web_topics").agg(F.to_json(F.struct(F.collect_list(one).alias("topics"))).alias("content"))
    return config.topic_file_violations(files)


def record_overlay(spark, sf):
    """Two lists of records merged by id to any depth, fields of the result read back."""
    feeds, subs = read(spark, sf, "feed_sources"), read(spark, sf, "reddit_subreddits")
    base = feeds.select(F.col("source_id").alias("id"), F.col("source_name").alias("name"), F.struct("priority", "attempts").alias("run"))
    over = feeds.where("priority >= 8").select(F.col("source_id").alias("id"), F.struct(F.lit(99).alias("priority")).alias("run"))
    more = subs.select(F.col("source_id").alias("id"), F.col("source_name").alias("name"), F.struct(F.lit(1).alias("priority"), F.col("attempts").alias("attempts")).alias("run"))
    place = F.monotonically_increasing_id().alias("position")
    defaults = base.select(place, F.to_json(F.struct("*")).alias("record"))
    layers = over.select("id", F.to_json(F.struct("id", "run")).alias("record")).unionByName(more.select("id", F.to_json(F.struct("*")).alias("record")))
    got = lambda p: F.get_json_object("record", f"$.{p}")
    out = config.record_overlay(defaults, layers.select(place, "record"))
    return out.select("id", F.col("place.new").alias("added"), got("name").alias("name"), got("run.priority").cast("bigint").alias("priority"), got("run.attempts").cast("bigint").alias("attempts"))


def local_times(spark, sf):
    r = read(spark, sf, "rss_articles").join(read(spark, sf, "feed_sources").select("source_id", "tz"), "source_id")
    zoned = r.where(dates.is_zone(F.col("tz")))
    return zoned.select("article_id", dates.local_text(F.col("fetched_at").cast("timestamp"), F.col("tz")).alias("local"), dates.local_day(F.col("fetched_at").cast("timestamp"), F.col("tz")).cast("string").alias("day"))


def flagged_priorities(spark, sf):
    s = read(spark, sf, "reddit_subreddits")
    said = F.when(F.length("source_id") % 3 == 0, "true").when(F.length("source_id") % 3 == 1, "False").otherwise(F.col("priority").cast("string"))
    return s.select("source_id", flagged_priority(said).cast("bigint").alias("priority"))


def queries() -> dict:
    found = (
        slow_requests, pipeline_overview, pipeline_roll_up, pipeline_states, fetch_summaries, history_report, timing_texts, source_file_rules, topic_file_rules, record_overlay,
        local_times, flagged_priorities,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from newsloom.plans.sql import HISTORY, RUNS, TRACES

    names = "[" + ", ".join(f"'{t}'" for t in REGISTRY) + "]"
    steps = f"""{RUNS}, st AS (SELECT * REPLACE (({names})[regexp_extract(step_key, '\\d+')::INT + 1] AS step_key) FROM runs),
      days AS (SELECT DISTINCT run_date FROM runs), every AS (SELECT run_date, step_key, status, items, elapsed_s FROM st
        UNION ALL SELECT run_date, 'merge-sources', CASE WHEN day(run_date) % 7 = 0 THEN 'error' ELSE 'ok' END, 100, NULL FROM days
        UNION ALL SELECT run_date, 'merge-hotspots', 'ok', day(run_date), NULL FROM days WHERE day(run_date) % 5 > 0)"""
    one = "CASE WHEN round_even({0}, 1) = 0 THEN '0.0s' ELSE format('{{:.1f}}', round_even({0}, 1)) || 's' END"
    rule = lambda where, text: f"SELECT coalesce(source_id, '') AS id, '{text}' AS rule FROM feed_sources WHERE {where}"
    topic = lambda where, text: f"SELECT topic_id AS id, '{text}' AS rule FROM web_topics WHERE {where}"
    return {
        "slow_requests": f"WITH {TRACES} SELECT step_key, count(*) FILTER (active_s >= 3) AS total_count, 2::BIGINT AS buckets FROM tr GROUP BY 1",
        "pipeline_overview": f"WITH {steps} SELECT run_date, step_key, status, status = 'ok' AS fully_successful, items, calls_total, calls_ok, calls_failed, elapsed_s FROM st",
        "pipeline_roll_up": f"""WITH {steps} SELECT run_date, count(*) AS steps, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status <> 'ok') AS non_ok,
          CASE WHEN count(*) = count(*) FILTER (status = 'ok') THEN 'ok' WHEN count(*) FILTER (status <> 'error') > 0 THEN 'partial' ELSE 'error' END AS status, round_even(sum(elapsed_s), 3) AS fetch_active_s,
          coalesce(max(items) FILTER (step_key = 'merge-hotspots'), max(items) FILTER (step_key = 'merge-sources'), 0)::BIGINT AS items FROM every GROUP BY 1""",
        "pipeline_states": f"""WITH {steps} SELECT run_date, CASE WHEN coalesce(max(status) FILTER (step_key = 'merge-sources'), '') <> 'ok' OR coalesce(max(status) FILTER (step_key = 'merge-hotspots'), '') <> 'ok' OR count(*) FILTER (status = 'error') > 0 THEN 'error'
          WHEN count(*) FILTER (status = 'partial') > 0 THEN 'warn' ELSE 'ok' END AS state, count(*) FILTER (status = 'error') AS failed, count(*) FILTER (status = 'partial') AS partial FROM every GROUP BY 1""",
        "fetch_summaries": f"""WITH {RUNS}, k AS (SELECT * REPLACE (run_date || '/' || step_key AS step_key) FROM runs), p AS (SELECT *, CASE length(step_key) % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'error' ELSE 'ok' END AS process, items % 3 > 0 AS has_meta, items % 2 = 0 AS made FROM k),
          q AS (SELECT *, CASE WHEN has_meta THEN CASE WHEN process = 'timeout' THEN 'timeout' WHEN process = 'error' AND status = 'ok' THEN 'error' ELSE status END ELSE process END AS st FROM p)
          SELECT step_key, st AS status, CASE WHEN has_meta OR made THEN items ELSE 0 END AS items, CASE WHEN has_meta THEN calls_total ELSE made::BIGINT END AS total_calls, CASE WHEN has_meta THEN calls_ok ELSE (st = 'ok')::BIGINT END AS ok_calls,
          CASE WHEN has_meta THEN calls_failed ELSE greatest(0, made::BIGINT - (st = 'ok')::BIGINT) END AS failed_calls, CASE WHEN has_meta THEN elapsed_s ELSE 9.5 END AS elapsed_s FROM q""",
        "history_report": f"""WITH {HISTORY}, o AS (SELECT *, row_number() OVER (ORDER BY degraded_rate DESC, error DESC, step_key) + 1 AS line_no FROM hist)
          SELECT 1 AS line_no, 'History report: ' || count(*) || ' steps tracked, ' || count(*) FILTER (unhealthy) || ' unhealthy in last 7 days' AS line FROM hist
          UNION ALL SELECT line_no, CASE WHEN unhealthy OR warn > 0 OR error > 0 THEN '⚠️' ELSE '✅' END || ' ' || rpad(step_key, (SELECT max(length(step_key)) FROM hist)::INT, ' ') || ' - ok:' || ok || ' warn:' || warn || ' error:' || error
            || ' (' || round_even(degraded_rate * 100, 0)::INT || '% degraded)' FROM o WHERE line_no <= 21""",
        "timing_texts": f"""WITH {RUNS}, t AS (SELECT *, {one.format('elapsed_s')} AS a, {one.format('(elapsed_s * (day(run_date) % 2 + 1))')} AS b FROM runs)
          SELECT step_key, run_date, CASE status WHEN 'ok' THEN '✅' WHEN 'partial' THEN '⚠️' ELSE '❌' END AS icon, CASE WHEN a = b THEN a ELSE 'active ' || a || ', total ' || b END AS timing,
          CASE WHEN status <> 'ok' AND elapsed_s > 0 THEN ' (' || a || ')' ELSE '' END AS suffix, run_date || '-' || (regexp_extract(step_key, '\\d+')::INT + 1) AS label FROM t""",
        "source_file_rules": " UNION ALL ".join([
            rule("trim(coalesce(source_id, '')) = ''", "id is empty"), rule("trim(coalesce(source_name, '')) = ''", "name is empty"), rule("status IS NULL", "enabled is not true or false"),
            rule("NOT coalesce(priority BETWEEN 1 AND 10, false)", "priority is not in 1..10"), rule("trim(coalesce(topic, '')) = ''", "topic is empty"),
            rule("trim(coalesce(topic, '')) <> '' AND topic NOT IN (SELECT topic_id FROM web_topics)", "topic is unknown"), rule("source_type <> 'rss'", "type is not rss"), rule("trim(coalesce(url, '')) = ''", "url is empty"),
            "SELECT source_id, 'id is used twice' FROM feed_sources GROUP BY 1 HAVING count(*) > 1",
        ]),
        "topic_file_rules": " UNION ALL ".join([
            topic("trim(coalesce(freshness, '')) = ''", "emoji is empty"), topic("trim(coalesce(status, '')) = ''", "description is empty"), topic("NOT coalesce(queries_ok - 4 >= 1, false)", "display.max_items is below 1"),
        ]),
        "record_overlay": """SELECT source_id AS id, false AS added, source_name AS name, CASE WHEN priority >= 8 THEN 99 ELSE priority END::BIGINT AS priority, attempts::BIGINT AS attempts FROM feed_sources
          UNION ALL SELECT source_id, true, source_name, 1, attempts FROM reddit_subreddits""",
        "local_times": """WITH r AS (SELECT article_id, date_trunc('second', fetched_at) AS f, tz FROM rss_articles JOIN feed_sources USING (source_id) WHERE tz LIKE '%/%' OR tz = 'UTC'), l AS (SELECT *, timezone(tz, f) AS w, (epoch(timezone(tz, f)) - epoch(timezone('UTC', f)))::INT // 60 AS m FROM r)
          SELECT article_id, strftime(w, '%Y-%m-%dT%H:%M:%S') || CASE WHEN m < 0 THEN '-' ELSE '+' END || lpad((abs(m) // 60)::VARCHAR, 2, '0') || ':' || lpad((abs(m) % 60)::VARCHAR, 2, '0') AS local, strftime(w, '%Y-%m-%d') AS day FROM l""",
        "flagged_priorities": "SELECT source_id, CASE length(source_id) % 3 WHEN 0 THEN 8 WHEN 1 THEN 3 ELSE greatest(1, least(10, coalesce(priority, 3))) END::BIGINT AS priority FROM reddit_subreddits",
    }
