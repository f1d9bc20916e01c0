"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import logging
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextvars import ContextVar
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings the load plans rely on; a cluster normally has them already.
LOAD_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Folders of a mart are listed by some tasks, not by one each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Plans here are built from hundreds of column calls; recording the call site of
    # each takes longer than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# For the time of a write: the shuffle files of a query go when it has ended (Spark 4.1 on), not
# when the driver happens to collect garbage, so the disk holds those of one query at a time.
CLEAN_UP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Rows that lie together by some of a join's keys aren't shuffled again by all of them.
TOGETHER = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


# The generated code of a wide cleaning projection passes the size above which HotSpot
# leaves a method to the interpreter; with this flag it is compiled like any other.
# Give it to the executors of a cluster too (spark.executor.extraJavaOptions).
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"


def local_session(cores: str = "8", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("martloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.extraJavaOptions", JVM_OPTIONS)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**LOAD_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="martloom-")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with the executor that wrote it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_folder()


@contextlib.contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Folders of the stages that the run at work has written; none outside of a run.
_stages: ContextVar[list[str] | None] = ContextVar("stages", default=None)


def new_stage_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder for an intermediate table; a run takes it for its own."""
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (of_run := _stages.get()) is not None:
        of_run.append(path)
    return path


def write_stage(
    df: DataFrame,
    label: str,
    computed: Mapping[str, Column] = MappingProxyType({}),
    during: Mapping[str, str] = MappingProxyType({}),
) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    The written files survive the loss of executors, and their size is known to
    the planner of whatever reads them next.  Within ``run_scope`` they go when the run ends.
    Columns that are ``computed`` from others, such as digests, aren't written but made again.
    ``during`` are settings that hold while it is written.
    """
    spark = df.sparkSession
    path = new_stage_path(spark, label)
    stored = df.drop(*computed)
    with settings(spark, {**CLEAN_UP, **during}):
        stored.write.parquet(path)
    rows = spark.read.schema(stored.schema).parquet(path)
    return rows.withColumns({**computed}).select(*df.columns) if computed else rows


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


@contextlib.contextmanager
def run_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the stages written inside when the block ends well.

    After an error they stay where they are, for repair, and their paths are logged.  Frames
    over stages can't be read once the block has ended: it must write or publish its result.
    A run inside of another leaves its stages to the outer one.
    """
    outer = _stages.get()
    if outer is not None:
        yield outer
        return
    paths: list[str] = []
    token = _stages.set(paths)
    try:
        yield paths
    except BaseException:
        log.warning("stages of a run that failed: %s", ", ".join(paths) or "none")
        raise
    finally:
        _stages.reset(token)
    for path in paths:
        remove_folder(spark, path)


def scoped_run(function: Callable) -> Callable:
    """A run, its session the first argument, whose stages are removed after publishing."""

    @functools.wraps(function)
    def run(spark: SparkSession, *args, **kwargs):
        with run_scope(spark):
            return function(spark, *args, **kwargs)

    return run


def new_mart_path(spark: SparkSession) -> str:
    """A path in the shared folder for a mart that begins empty."""
    return f"{scratch_folder(spark)}/mart-{uuid.uuid4().hex}"
