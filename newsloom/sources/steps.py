"""Step result files, payload envelopes and the dated archive."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import first_filled, text
from newsloom.params import REGISTRY

METRICS = "struct<like_count:bigint,retweet_count:bigint,reply_count:bigint,score:bigint,num_comments:bigint>"
ITEM = (
    "struct<title:string,link:string,date:string,topic:string,source_type:string,source_id:string,source_name:string,source_priority:int,summary:string,snippet:string,"
    f"reddit_url:string,external_url:string,score:bigint,num_comments:bigint,replies:bigint,metrics:{METRICS}>"
)
STEP = f"generated string, source_type string, articles array<{ITEM}>"
OUTPUT = "generated_at string, topics array<struct<id:string,title:string,items:array<struct<title:string,link:string>>>>"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_step(spark: SparkSession, path: str, source_type: str) -> DataFrame:
    """Articles of one step file with the merge's defaults; a missing file, or one that can't be parsed, gives no rows."""
    files = spark.read.text(path, wholetext=True) if exists(spark, path) else spark.createDataFrame([], "value string")
    parsed = files.select(F.from_json("value", STEP, {"mode": "PERMISSIVE"}).alias("p"))
    rows = parsed.select(F.posexplode("p.articles").alias("pos", "a")).where("a IS NOT NULL").select("pos", "a.*")
    topic = first_filled(F.trim(F.col("topic")), F.lit("uncategorized"))
    return rows.withColumns({
        "source_type": first_filled(F.col("source_type"), F.lit(source_type)),
        "source_priority": F.greatest(F.lit(1), F.least(F.lit(10), F.coalesce("source_priority", F.lit(3)))),
        "topic": topic, "primary_topic": topic,
        "article_ix": F.lit((REGISTRY.index(source_type) + 1) * 10**13) + F.col("pos"),
    }).drop("pos")


def read_steps(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """UNION ALL of step files in registry order. paths: source type -> path."""
    return reduce(DataFrame.unionByName, [read_step(spark, paths[t], t) for t in REGISTRY if t in paths])


def archive_items(spark: SparkSession, root: str, before: str | None = None, on: str | None = None) -> DataFrame:
    """run_date, title, link of archived outputs; duplicates stay. The predicate on run_date prunes partitions.

    Layout: root/run_date=YYYY-MM-DD/*.json, one document a file.
    """
    raw = spark.read.schema(OUTPUT + ", run_date date").option("multiLine", True).option("mode", "PERMISSIVE").json(root)
    if before:
        raw = raw.where(F.col("run_date") < F.lit(before).cast("date"))
    if on:
        raw = raw.where(F.col("run_date") == F.lit(on).cast("date"))
    items = raw.select("run_date", F.explode("topics").alias("t")).select("run_date", F.explode("t.items").alias("i"))
    return items.select("run_date", text(F.col("i.title")).alias("title"), text(F.col("i.link")).alias("link"))


def output_documents(selected: DataFrame, generated_at: str) -> DataFrame:
    """One JSON document of topics with their items in rank order. selected: topic, rank, title, link and more (bounded by top-N)."""
    item = F.struct("rank", *[c for c in selected.columns if c not in ("topic", "rank")])
    topics = selected.groupBy("topic").agg(F.array_sort(F.collect_list(item)).alias("items"))
    whole = topics.agg(F.array_sort(F.collect_list(F.struct(F.col("topic").alias("id"), F.col("items")))).alias("topics"))
    return whole.select(F.to_json(F.struct(F.lit(generated_at).alias("generated_at"), "topics")).alias("value"))


def write_archive(selected: DataFrame, root: str, run_date: str, generated_at: str) -> None:
    """Adds a document to the day's partition; earlier documents of the day stay."""
    output_documents(selected, generated_at).coalesce(1).write.mode("append").text(f"{root}/run_date={run_date}")


def expired(run_dates: Column, today: Column, keep_days: int = 30) -> Column:
    return F.datediff(today, run_dates) > keep_days


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (a folder of days, or of one day's files); [] if there is none."""
    fs, p = _folder(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def drop_expired(spark: SparkSession, root: str, today: str, keep_days: int = 30) -> list[str]:
    """Delete the day partitions that are older than keep_days; their days. Other folders stay."""
    gone = []
    for name in _names(spark, root):
        day = re.fullmatch(r"(?:run_date=)?(\d{4}-\d{2}-\d{2})", name)
        if day and (date.fromisoformat(today) - date.fromisoformat(day[1])).days > keep_days:
            fs, p = _folder(spark, f"{root}/{name}")
            fs.delete(p, True)
            gone.append(day[1])
    return gone


def next_pair(spark: SparkSession, json_dir: str, markdown_dir: str, stem: str = "daily") -> tuple[str, str]:
    """First of stem, stem1, stem2 ... that neither folder holds, as a JSON and a Markdown path."""
    taken = {n.removesuffix(".json") for n in _names(spark, json_dir)} | {n.removesuffix(".md") for n in _names(spark, markdown_dir)}
    name = next(n for k in count() if (n := f"{stem}{k or ''}") not in taken)
    return f"{json_dir}/{name}.json", f"{markdown_dir}/{name}.md"


def next_meta(spark: SparkSession, meta_dir: str, step_key: str) -> str:
    """First free name of a step's meta file: step.meta.json, step1.meta.json ..."""
    taken = set(_names(spark, meta_dir))
    return next(f"{meta_dir}/{n}" for k in count() if (n := f"{step_key}{k or ''}.meta.json") not in taken)


def run_suffix(path: str, stem: str = "daily") -> str:
    """What follows the stem in an archived output's name."""
    name = path.rpartition("/")[2].partition(".")[0]
    return name[len(stem) :] if name.startswith(stem) else ""


def meta_path(output: str) -> str:
    """The meta file beside an output."""
    return re.sub(r"(\.[^./]*)?$", ".meta.json", output, count=1)


def write_text(spark: SparkSession, path: str, content: str) -> str:
    """One small file (a document, a report), UTF-8, its folder made."""
    fs, p = _folder(spark, path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    out.write(bytearray(content.encode()))
    out.close()
    return path


def write_run(spark: SparkSession, root: str, run_date: str, document: DataFrame, markdown: DataFrame, stem: str = "daily") -> tuple[str, str]:
    """A run's JSON document (one row, value) and its Markdown (line_no, line) under the next free name of the day."""
    pair = next_pair(spark, f"{root}/{run_date}/json", f"{root}/{run_date}/markdown", stem)
    write_text(spark, pair[0], document.first()["value"])
    lines = [r["line"] for r in markdown.orderBy("line_no").collect()]  # top-N lines a topic
    write_text(spark, pair[1], "\n".join(lines).rstrip() + "\n")
    return pair


def meta_files(spark: SparkSession, root: str, today: str | None = None, days: int = 7) -> list[str]:
    """Meta files of a folder, the pipeline's first, then those of its day folders of the last days; each path once."""
    def inside(folder: str) -> list[str]:
        found = [n for n in _names(spark, folder) if re.fullmatch(r"[a-z][a-z_-]*?\d*\.meta\.json", n)]
        return [f"{folder}/{n}" for n in sorted(found, key=lambda n: (not n.startswith("pipeline"), n))]

    out = inside(root)
    for day in _names(spark, root) if today else []:
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", day) and (date.fromisoformat(today) - date.fromisoformat(day)).days <= days:
            out += inside(f"{root}/{day}/meta")
    return list(dict.fromkeys(out))


META = "step_key string, name string, status string, items bigint, calls_total bigint, calls_ok bigint, failed_calls bigint, timing_s struct<active:double,total:double>"


def read_metas(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, file_name, run_date and the meta fields of step meta files; files that can't be parsed give no row."""
    files = spark.read.text(paths, wholetext=True).withColumn("path", F.input_file_name()) if paths else spark.createDataFrame([], "value string, path string")
    m = files.select("path", F.substring_index("path", "/", -1).alias("file_name"), F.to_date(F.nullif(F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/", 1), F.lit(""))).alias("run_date"), F.from_json("value", META).alias("m"))
    return m.where("m.step_key IS NOT NULL OR m.status IS NOT NULL").select("path", "file_name", "run_date", "m.*")


def failed_calls(metas: DataFrame, suffix: str = "") -> DataFrame:
    """step_key, failed of the source steps whose meta file has this run suffix."""
    source = ~F.col("step_key").startswith("merge-") & (F.col("step_key") != "pipeline")
    rows = metas.where(source & (F.col("file_name") == F.concat(F.col("step_key"), F.lit(f"{suffix}.meta.json"))))
    return rows.select("step_key", F.coalesce("failed_calls", F.lit(0)).alias("failed"))
