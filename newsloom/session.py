"""Session helpers: a local session for tests and benches, and the folder all executors share."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "newsloom", partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A single-JVM session; on a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once a session: their Python need not have it installed."""
    context = spark.sparkContext
    if not getattr(context, "_newsloom_shipped", False):
        package = Path(__file__).parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        folder = Path(tempfile.mkdtemp(prefix="newsloom-code-"))
        (folder / "newsloom_code.zip").write_bytes(packed.getvalue())
        context.addPyFile(str(folder / "newsloom_code.zip"))  # served by the driver, so a local file of the driver will do
        context._newsloom_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only in a local session that doesn't set it (tests) a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "newsloom-shared")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base


def run_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder: what is written there outlives any executor."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def until_exit(spark: SparkSession, path: str) -> str:
    """Have a path that is there deleted when the driver's JVM ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run within are removed as each ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, *, partition: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: it is computed once, and no lost executor takes it away.

    partition: columns whose values get folders of their own. The table is deleted when the driver ends, or by forget; what was
    shuffled for it goes as soon as it is there.
    """
    path = run_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.partitionBy(*(partition or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(until_exit(df.sparkSession, path))


def forget(df: DataFrame) -> None:
    """Delete the written tables that df reads, once all that was made of them is written too. Files elsewhere are never touched."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    shared = path(shared_dir(spark))
    files = shared.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    shared = files.makeQualified(shared)
    for folder in {path(f).getParent().toString() for f in df.inputFiles()}:
        if files.makeQualified(path(folder)).getParent().equals(shared):
            files.delete(path(folder), True)
