"""Archive, meta files, health reports, roll-ups, configuration files and documents on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates
from newsloom.operators import config
from newsloom.operators import diagnostics as G
from newsloom.operators import documents as D
from newsloom.operators import matches as M
from newsloom.sources import steps


def test_archive_names_and_retention(spark, tmp_path):
    root = f"file://{tmp_path}/archive"
    doc, lines = spark.createDataFrame([('{"a":1}',)], "value string"), spark.createDataFrame([(2, "b"), (1, "ä"), (3, "")], "line_no int, line string")
    first, second = (steps.write_run(spark, root, "2025-09-02", doc, lines) for _ in range(2))
    assert first[0].endswith("daily.json") and second == (first[0].replace("daily", "daily1"), first[1].replace("daily", "daily1"))
    assert (tmp_path / "archive/2025-09-02/markdown/daily1.md").read_text() == "ä\nb\n"
    assert steps.run_suffix(second[0]) == "1" and steps.run_suffix("x/weekly.json") == "" and steps.meta_path("a/b.json") == "a/b.meta.json"
    for day in ("2025-07-01", "run_date=2025-06-30", "notes"):
        (tmp_path / "archive" / day).mkdir()
    assert steps.drop_expired(spark, root, "2025-09-03") == ["2025-07-01", "2025-06-30"]
    assert sorted(p.name for p in (tmp_path / "archive").iterdir()) == ["2025-09-02", "notes"]
    assert steps.drop_expired(spark, f"{root}/absent", "2025-09-03") == []


def test_meta_files(spark, tmp_path):
    meta = tmp_path / "2025-09-02" / "meta"
    meta.mkdir(parents=True)
    for name, body in {"rss.meta.json": {"step_key": "rss", "failed_calls": 2}, "rss1.meta.json": {"step_key": "rss", "failed_calls": 5}, "merge-sources.meta.json": {"step_key": "merge-sources", "failed_calls": 9}, "pipeline.meta.json": {"step_key": "pipeline"}, "bad.meta.json": None}.items():
        (meta / name).write_text(json.dumps(body) if body else "{oops")
    (tmp_path / "2025-07-01" / "meta").mkdir(parents=True)
    (tmp_path / "2025-07-01" / "meta" / "rss.meta.json").write_text("{}")
    root = f"file://{tmp_path}"
    found = steps.meta_files(spark, root, "2025-09-03")
    assert [f.rpartition("/")[2] for f in found] == ["pipeline.meta.json", "bad.meta.json", "merge-sources.meta.json", "rss.meta.json", "rss1.meta.json"]
    metas = steps.read_metas(spark, found)
    assert metas.count() == 4 and str(metas.first()["run_date"]) == "2025-09-02"
    assert [tuple(r) for r in steps.failed_calls(metas).collect()] == [("rss", 2)] and [tuple(r) for r in steps.failed_calls(metas, "1").collect()] == [("rss", 5)]
    assert steps.next_meta(spark, f"{root}/2025-09-02/meta", "rss").endswith("/rss2.meta.json") and steps.read_metas(spark, []).count() == 0
    labels = metas.select("file_name", G.run_label(F.col("run_date"), F.col("file_name")).alias("l"))
    assert {r["file_name"]: r["l"] for r in labels.collect()} == {"rss.meta.json": "2025-09-02-1", "rss1.meta.json": "2025-09-02-2", "merge-sources.meta.json": "2025-09-02-1", "pipeline.meta.json": "2025-09-02-1"}
    order = spark.createDataFrame([("2025-09-02-10",), ("2025-09-02-9",), ("2025-09-03-1",), ("2025-09-01-current",)], "l string").orderBy(G.run_order(F.col("l")).desc())
    assert [r["l"] for r in order.collect()] == ["2025-09-03-1", "2025-09-02-10", "2025-09-02-9", "2025-09-01-current"]


def test_reports_and_states(spark):
    rows = [("rss", "2025-09-01", "error", 1, 2.0, "a\n\nb\nc"), ("rss", "2025-09-02", "ok", 0, 4.0, None), ("api", "2025-09-02", "ok", 0, 1.0, None), ("api", "2025-08-01", "error", 1, 1.0, "old"), ("v2ex", "2025-09-02", "skipped", 0, 0.0, None)]
    runs = spark.createDataFrame(rows, "step_key string, observed string, status string, calls_failed int, elapsed_s double, error string").withColumn("observed", F.col("observed").cast("timestamp"))
    h = G.health_history(runs, F.lit("2025-09-03 00:00:00").cast("timestamp"))
    got = {r["step_key"]: r for r in h.collect()}
    assert set(got) == {"rss", "api"} and (got["rss"]["latest_error"], got["rss"]["median_elapsed_s"], got["rss"]["unhealthy"]) == ("a | b", 3.0, False)
    lines = [r["line"] for r in G.history_report(h).orderBy("line_no").collect()]
    assert lines == ["History report: 2 steps tracked, 0 unhealthy in last 7 days", "⚠️ rss - ok:1 warn:0 error:1 (50% degraded)", "✅ api - ok:1 warn:0 error:0 (0% degraded)"]
    assert [r["line"] for r in G.history_report(h.limit(0)).collect()] == ["History report: 0 steps tracked, 0 unhealthy in last 7 days"]
    one = spark.range(1).select(F.lit("d-1").alias("run_label"), F.lit("rss").alias("step_key"), F.lit("partial").alias("status"), F.lit("warn").alias("state"), G.call_stats(F.lit(""), F.lit(5), F.lit(7), None, F.lit(2)).alias("call_stats"), F.lit(3).alias("items"), F.lit(1.25).alias("elapsed_s"))
    failed = spark.createDataFrame([("d-1", "rss", "s1", "x  y", 2.0)], "run_label string, step_key string, source_id string, error string, active_s double")
    assert [r["line"] for r in G.run_lines(one, failed).orderBy("run_label", "part").collect()] == ["⚠️ rss - calls:7/0/5 | partial:2 | items:3 | elapsed:1.2s", "   - s1: x y (2.0s)"]
    state = lambda *a: spark.range(1).select(G.pipeline_state(*[F.lit(x) for x in a])).first()[0]
    assert [state("ok", "ok", "ok", 0, 0, 0), state("ok", "ok", "ok", 0, 1, 0), state("ok", "ok", "ok", 0, 0, 1), state("ok", None, "ok", 0, 0, 0), state("ok", "ok", "ok", 1, 0, 0), state("timeout", "ok", "ok", 0, 0, 0)] == ["ok", "warn", "warn", "error", "error", "error"]
    merged = spark.range(1).select(G.merge_step_summary(F.lit("ok"), F.lit(False), F.lit(5), F.lit(9)).alias("m")).first()["m"]
    assert (merged["status"], merged["items"], merged["calls_total"], merged["calls_ok"]) == ("ok", 0, 0, 0)
    items = G.failed_items(spark.createDataFrame([("error", " why ", 0), ("error", " ", 2), ("ok", "x", 1)], "status string, error string, attempt int")).collect()
    assert [(r["error"], r["attempt"], r["source_id"]) for r in items] == [("why", 1, "item")]


def violations(spark, fn, content, *more):
    df = spark.createDataFrame([(content if isinstance(content, str) else json.dumps(content),)], "content string")
    return sorted(tuple(r) for r in fn(df, *more).collect())


def test_configuration_files(spark):
    topic = {"id": "ai", "emoji": "x", "label": "AI", "description": "d", "search": {"exclude": []}, "display": {"max_items": 3}}
    assert violations(spark, config.topic_file_violations, {"topics": [topic]}) == []
    bad = violations(spark, config.topic_file_violations, {"topics": [topic, topic | {"label": " ", "search": {"exclude": "no"}, "display": {"max_items": 0}}, 7, {"id": "b", "emoji": "e", "label": "l", "description": "d"}]})
    assert bad == [("", "an entry of topics is no object"), ("ai", "display.max_items is below 1"), ("ai", "id is used twice"), ("ai", "label is empty"), ("ai", "search.exclude is no list"), ("b", "display is no object"), ("b", "search is no object")]
    topics = spark.createDataFrame([("ai",)], "topic_id string")
    source = {"id": "s", "type": "rss", "name": "n", "enabled": True, "priority": 3, "topic": "ai", "url": "u"}
    assert violations(spark, config.source_file_violations, {"sources": [source]}, topics, "rss", "url") == []
    bad = violations(spark, config.source_file_violations, {"sources": [source | {"priority": True, "enabled": "yes", "topic": "x", "type": "api", "url": None}]}, topics, "rss", "url")
    assert bad == [("s", r) for r in ("enabled is not true or false", "priority is not in 1..10", "topic is unknown", "type is not rss", "url is empty")]
    assert violations(spark, config.source_file_violations, "{oops", topics) == [("", "sources is no list")]
    run = {"pipeline": {f: 1 for f in config.RUN_NUMBERS}, "fetch": {s: {f: 1 for f in fs} for s, fs in config.FETCH_FIELDS.items()}, "diagnostics": {f: 1 for f in config.HEALTH_NUMBERS} | {"degraded_threshold": 0.5, "slow_request_thresholds_s": [3, 5]}, "cache": {f: "p" for f in config.CACHE_PATHS}}
    assert violations(spark, config.runtime_file_violations, run) == []
    run["pipeline"]["merge_timeout_s"], run["diagnostics"]["slow_request_thresholds_s"] = 0, []
    del run["fetch"]["rss"]["max_workers"], run["fetch"]["api"], run["cache"]
    assert [r for (r,) in violations(spark, config.runtime_file_violations, run)] == ["cache is no object", "diagnostics.slow_request_thresholds_s is no list of positive numbers", "fetch.api is no object", "fetch.rss.max_workers is missing", "pipeline.merge_timeout_s is no whole number from 1"]


def test_records_merge_to_any_depth(spark):
    base = [(0, {"id": "a", "x": {"y": {"z": 1, "w": 2}}}), (1, {"id": "b", "n": 1}), (2, {"n": 5})]
    over = [(0, {"id": "c", "n": 9}), (1, {"id": "a", "x": {"y": {"z": 7}}}), (2, {"id": "a", "x": {"v": None}})]
    frames = [spark.createDataFrame([(p, json.dumps(r)) for p, r in rows], "position bigint, record string") for rows in (base, over)]
    got = [(r["id"], json.loads(r["record"])) for r in config.record_overlay(*frames).orderBy("place").collect()]
    assert got == [("a", {"id": "a", "x": {"y": {"z": 7, "w": 2}, "v": None}}), ("b", {"id": "b", "n": 1}), ("c", {"id": "c", "n": 9})]


def test_matches_and_documents(spark):
    arts = spark.createDataFrame([(1, "rss", "R", "t", "same", "l1", None, None), (2, "twitter", None, "t", "same", "l2", None, None), (3, "twitter", "T", None, "same", "l2", None, None), (4, "rss", "R", "t", None, "l4", None, None)], "article_ix bigint, source_type string, source_name string, topic string, title string, link string, reddit_url string, external_url string")
    pairs = spark.createDataFrame([(1, 2, 0.95), (1, 3, 0.97), (1, 4, 0.99), (3, 4, 0.5)], "i bigint, j bigint, similarity double")
    m = M.article_matches(pairs, arts, 0.86)
    got = sorted((r["article_ix"], r["source_type"], r["link"], r["source_name"], r["similarity"]) for r in m.collect())
    assert got == [(1, "twitter", "l2", "", 0.95), (2, "rss", "l1", "R", 0.95), (3, "rss", "l1", "R", 0.97)]
    comp = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "vertex bigint, component bigint")
    c = M.cluster_matches(m, comp)
    assert [(r["source_type"], r["similarity"]) for r in c.orderBy("match_rank").collect()] == [("rss", 0.95), ("twitter", 0.95)]
    lists = M.with_match_lists(spark.createDataFrame([(1,), (9,)], "component bigint"), c).orderBy("component").collect()
    assert [len(r["cross_source_matches"]) for r in lists] == [2, 0]
    assert spark.range(1).select(D.joined_objects(F.lit('{"a":1}'), F.lit("{}"), F.lit('{"b":[2]}'))).first()[0] == '{"a":1,"b":[2]}'
    assert D.summary_line("daily", 1, {"rss": 4}, {"rss": 1}, {"api": 2}, "T") == "summary: mode:daily | total_articles:1 | api(0→0,fail=2) | rss(4→1,fail=0) | generated_at:T"


def test_local_texts(spark):
    df = spark.createDataFrame([("2025-07-01 22:30:00", "Asia/Kolkata"), ("2025-01-01 01:00:00", "America/New_York")], "t string, z string")
    got = df.select(dates.local_text(F.col("t").cast("timestamp"), F.col("z")).alias("a"), dates.local_day(F.col("t").cast("timestamp"), F.col("z")).cast("string").alias("d")).collect()
    assert [tuple(r) for r in got] == [("2025-07-02T04:00:00+05:30", "2025-07-02"), ("2024-12-31T20:00:00-05:00", "2024-12-31")]


@pytest.mark.parametrize("name", ["hotspot_items", "merged_output", "markdown_document"])
def test_documents_of_the_tables(spark, tables, name):
    from newsloom.plans import catalog

    assert catalog.queries()[name](spark, tables).count() > 10
