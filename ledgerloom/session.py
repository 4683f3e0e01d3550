"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for. AQE re-plans joins from measured sizes (so a side
# is broadcast only when its real size is below spark.sql.autoBroadcastJoinThreshold) and splits skewed
# join partitions; forceOptimizeSkewedJoin keeps that split even when it costs another shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter's session is used as it is."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or a local one where it is unset (local mode)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.removeprefix("file:").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/ledgerloom/{label}-{uuid.uuid4().hex}"


_TRACKS: list[list[str]] = []


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables written inside the block go as soon as each is written; Spark else keeps them until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """df as a table in the shared folder: computed once however many branches read it, and kept when executors go; options: of the writer."""
    return materialise_all([df], label, **options)


def materialise_all(frames: Iterable[DataFrame], label: str, **options: str) -> DataFrame:
    """The rows of frames of one schema as a single table, written one after another: the shuffles of one are gone before the next begins."""
    path = ""
    for df in frames:
        spark = df.sparkSession
        if not path:
            path = scratch_path(spark, label)
            for track in _TRACKS:
                track.append(path)
        with _shuffles_dropped(spark):
            df.write.options(**options).mode("append").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def tracked() -> Iterator[list[str]]:
    """The paths of all tables that materialise writes inside the block; hand them to drop_tables when nothing reads them any more."""
    track: list[str] = []
    _TRACKS.append(track)
    try:
        yield track
    finally:
        _TRACKS[:] = [t for t in _TRACKS if t is not track]


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that materialise wrote, through Spark's own file systems."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_width(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def local_path(path: str) -> str:
    return os.path.abspath(path.removeprefix("file://").removeprefix("file:"))
