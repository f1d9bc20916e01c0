"""Marts on shared storage: whole snapshots, and marts stored by partitions.

A run publishes last: everything is computed and written before a reader can see
any of it, and an error on the way leaves the mart as it was.

A mart stored by partitions is a folder of runs and a snapshot that says which runs hold
the current rows of which partition.  A run writes its partitions to a folder of its own;
the next snapshot makes them current, all at once.  What a run left behind when it failed,
and what later runs replaced, is in no snapshot and can be removed at any time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from martloom.session import CLEAN_UP, TOGETHER, settings, write_stage
from martloom.sources import key_index

# Marker that Spark's committer leaves in a completely written folder.
COMPLETE = "_SUCCESS"
SNAPSHOT = "snapshot-{:08d}"
# Name that Spark gives the folder of rows whose partition value is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
RUNS, CURRENT, RUN = "runs", "current", "run"
CURRENT_SCHEMA = (
    "partition string, run bigint, rows bigint, uploaded timestamp_ntz, "
    "sources array<struct<source:string,uploaded:timestamp_ntz>>"
)
# Small tables kept with a mart: distinct values per run, and states per snapshot.
LISTED, BESIDE = "listed", "beside"
# One row per run, written with its snapshot.
AUDIT = "audit"
AUDIT_SCHEMA = "inserted bigint, updated bigint, deleted bigint, rows bigint, before bigint"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, sorted; none if it doesn't exist."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder))


def _snapshots(spark: SparkSession, root: str) -> list[tuple[str, bool]]:
    """(name, complete) of every snapshot folder, oldest first."""
    return [
        (n, exists(spark, f"{root}/{n}/{COMPLETE}"))
        for n in folder_names(spark, root)
        if n.startswith("snapshot-")
    ]


def _next_snapshot(spark: SparkSession, root: str) -> str:
    taken = _snapshots(spark, root)
    return SNAPSHOT.format(int(taken[-1][0].rsplit("-", 1)[1]) + 1 if taken else 0)


def empty_frame(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows, and known to the planner to be none, so that joins to it vanish."""
    return spark.createDataFrame([], schema).limit(0)


def read_snapshot(
    spark: SparkSession, root: str, schema: StructType | str | None = None
) -> DataFrame:
    """The newest complete snapshot; an empty frame of ``schema`` if there is none."""
    complete = [n for n, done in _snapshots(spark, root) if done]
    if not complete:
        if schema is None:
            raise FileNotFoundError(f"no complete snapshot below {root}")
        return empty_frame(spark, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{complete[-1]}")


def publish_snapshot(df: DataFrame, root: str) -> str:
    """Write the next snapshot; it becomes current when its last task has committed.

    The frame may read the current snapshot, which stays in place for its readers.
    """
    spark = df.sparkSession
    path = f"{root}/{_next_snapshot(spark, root)}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    return path


def partition_name(column: str) -> Column:
    """The name that Spark gives the folder of a date."""
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Per partition and run that holds its rows: their number and latest upload."""
    return read_snapshot(spark, f"{path}/{CURRENT}", CURRENT_SCHEMA)


def uploads(spark: SparkSession, path: str, name: str = "kortex_upld_ts") -> DataFrame:
    """Latest uploads of a mart, from its snapshot: their maximum is that of all rows."""
    return read_current(spark, path).select(F.col("uploaded").alias(name))


def source_uploads(
    spark: SparkSession, path: str, source: str, name: str = "kortex_upld_ts"
) -> DataFrame:
    """Latest uploads by partition and source, from the snapshot alone.

    Grouped by source they give what the mart's rows would give.
    """
    marks = read_current(spark, path).select(F.explode("sources").alias("_mark"))
    return marks.select(
        F.col("_mark.source").alias(source), F.col("_mark.uploaded").alias(name)
    )


def partition_dates(partitions: DataFrame, column: str) -> DataFrame:
    """The dates that partition names stand for, as ``column``."""
    name = F.col("partition")
    return partitions.select(
        F.when(name != NULL_PARTITION, name).cast("date").alias(column)
    )


def read_listed(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """The values that runs listed under ``name``, with the ``partition`` whose rows have them.

    No row of the mart is read. A mart kept by runs that didn't list them raises.
    """
    full = f"{schema}, partition string, {RUN} bigint"
    current = read_current(spark, path).select("partition", RUN)
    runs = [r[RUN] for r in current.select(RUN).distinct().collect()]
    root = f"{path}/{LISTED}/{name}"
    if not runs:
        return empty_frame(spark, full)
    listed = spark.read.schema(full).option("basePath", root)
    rows = listed.parquet(*[f"{root}/{RUN}={n}" for n in sorted(runs)])
    return rows.join(current, ["partition", RUN], "left_semi")


def read_beside(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame | None:
    """The table that was published under ``name`` with the newest snapshot, if one was."""
    complete = [n for n, done in _snapshots(spark, f"{path}/{CURRENT}") if done]
    folder = f"{path}/{BESIDE}/{name}/{complete[-1]}" if complete else ""
    if not complete or not exists(spark, folder):
        return None
    return spark.read.schema(schema).parquet(folder)


def _read_runs(
    spark: SparkSession, path: str, schema: StructType | str, column: str, current: DataFrame
) -> DataFrame:
    """The rows of the given partitions.

    Their folders are listed on the driver, as for any table stored by partitions.
    """
    empty = empty_frame(spark, schema)
    folders = [
        f"{path}/{RUNS}/{RUN}={r.run}/{column}={r.partition}"
        for r in current.select("partition", "run").collect()
    ]
    if not folders:
        return empty
    rows = spark.read.schema(empty.schema).option("basePath", f"{path}/{RUNS}")
    return rows.parquet(*sorted(folders)).select(*empty.columns)


def read_partitioned(
    spark: SparkSession, path: str, schema: StructType | str, column: str
) -> DataFrame:
    """A mart that is stored by partitions; empty if nothing was published yet."""
    return _read_runs(spark, path, schema, column, read_current(spark, path))


def read_partitions(
    spark: SparkSession, path: str, schema: StructType | str, column: str, touched: DataFrame
) -> DataFrame:
    """The rows of the partitions listed in ``touched``; the folders of others aren't opened."""
    names = touched.select(partition_name(column).alias("partition")).distinct()
    listed = read_current(spark, path).join(names, "partition", "left_semi")
    return _read_runs(spark, path, schema, column, listed)


def _next_run(spark: SparkSession, path: str) -> int:
    names = folder_names(spark, f"{path}/{RUNS}")
    return 1 + max((int(n.partition("=")[2]) for n in names if n.startswith(f"{RUN}=")), default=0)


def begin_run(spark: SparkSession, path: str) -> int:
    """The number of a new run; no reader sees its rows before ``publish_run``."""
    return _next_run(spark, path)


def write_run(df: DataFrame, path: str, column: str, number: int) -> DataFrame:
    """Add rows to a run that isn't published yet, as they lie; all rows it has by now."""
    folder = f"{path}/{RUNS}/{RUN}={number}"
    with settings(df.sparkSession, {**CLEAN_UP, **TOGETHER}):
        df.write.mode("append").partitionBy(column).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Rows of a partition that are written by one task.
ROWS_PER_FILE = 200_000


def task_count(spark: SparkSession, rows: int) -> int:
    """Into how many tasks rows are shuffled that shall be written by partition."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // ROWS_PER_FILE), min(usual, -(-10 * rows // ROWS_PER_FILE)))


def by_file(
    df: DataFrame, partition: str, hashed: Column, rows: Mapping[str, int]
) -> tuple[DataFrame, list[str]]:
    """The rows with the file of their partition, and the columns to shuffle them by.

    Rows that are shuffled by partition and file lie as they are to be written: a small
    partition in one file, a crowded one in several tasks' files, by the hash.  ``rows`` are the
    numbers of rows by name in the column ``partition``.
    """
    files = {name: -(-n // ROWS_PER_FILE) for name, n in rows.items() if n > ROWS_PER_FILE}
    if not files:
        # No column for it: the planner would take one value for a constant, and shuffle again.
        return df, [partition]
    known = F.map_from_arrays(F.lit([*files]), F.lit([*files.values()]))
    count = F.coalesce(F.try_element_at(known, F.col(partition)), F.lit(1)).cast("bigint")
    return df.withColumn("_file", F.pmod(hashed, count)), [partition, "_file"]


def without_computed(df: DataFrame, computed: Mapping[str, Column]) -> DataFrame:
    """Each computed column keeps only the values that its expression doesn't give."""
    same = {f"_same_{c}": F.col(c).eqNullSafe(value) for c, value in computed.items()}
    marked = df.withColumns(same) if same else df
    other = {c: F.when(~F.col(f"_same_{c}"), F.col(c)) for c in computed}
    return marked.withColumns(other) if other else marked


def with_computed(df: DataFrame, computed: Mapping[str, Column]) -> DataFrame:
    made = {
        c: F.when(F.col(f"_same_{c}"), value).otherwise(F.col(c)) for c, value in computed.items()
    }
    return df.withColumns(made) if made else df


def publish_partitions(
    df: DataFrame,
    path: str,
    column: str,
    touched: DataFrame | None = None,
    uploaded: str | None = None,
    source: str | None = None,
    keys: Sequence[str] = (),
    listed: Mapping[str, Sequence[str]] = MappingProxyType({}),
    beside: Mapping[str, DataFrame] = MappingProxyType({}),
    added: int | None = None,
    computed: Mapping[str, Column] = MappingProxyType({}),
    **conditions: Column,
) -> dict[str, int]:
    """Make ``df`` the rows of the ``touched`` partitions, and keep all others.

    Touched partitions without rows in ``df`` vanish.  Rows of a partition that isn't
    touched are added to it; its old rows are neither read nor written.  Without a list,
    the partitions that ``df`` has rows for are touched.  The switch is the new snapshot:
    until it is complete readers see the mart as it was, and a run that failed can be repeated.

    Kept with the snapshot, so that later runs need not read the mart for it: with each
    partition the maximum of ``uploaded``, the upload time, and by ``source`` column too; an
    index of the ``keys`` (see ``key_index``); under each name of ``listed`` the distinct
    values of some columns by partition; and the small tables ``beside``.

    ``computed`` columns, such as digests, are as a rule what these expressions make of the other
    columns; where they are, they aren't shuffled but made again before they are written.

    Returns what the run did, counted from its files: the rows written, those that meet
    each condition, and the rows that the touched partitions had before.  ``added``, the number
    of rows that are new, gives those inserted and deleted too.  It is the run's row in the
    audit; without it or a condition ``inserted`` a run counts as a replacement.
    """
    number = begin_run(df.sparkSession, path)
    # Rebalanced by partition value: small partitions end up in one file each, and a
    # partition that holds much of the mart is cut into several tasks.
    moved = without_computed(df, computed).hint("rebalance", F.col(column))
    rows = with_computed(moved, computed).select(*df.columns)
    folder = f"{path}/{RUNS}/{RUN}={number}"
    with settings(df.sparkSession, CLEAN_UP):
        rows.write.partitionBy(column).parquet(folder)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    return publish_run(
        written, path, column, number, touched, uploaded, source, keys, listed, beside, added, **conditions
    )


def publish_run(
    written: DataFrame,
    path: str,
    column: str,
    number: int,
    touched: DataFrame | None = None,
    uploaded: str | None = None,
    source: str | None = None,
    keys: Sequence[str] = (),
    listed: Mapping[str, Sequence[str]] = MappingProxyType({}),
    beside: Mapping[str, DataFrame] = MappingProxyType({}),
    added: int | None = None,
    **conditions: Column,
) -> dict[str, int]:
    """Make the rows that a run has ``written`` those of the ``touched`` partitions.

    As ``publish_partitions``, for rows that lie in the run's folder already.
    """
    spark = written.sparkSession
    in_partition = partition_name(column).alias("partition")
    latest = F.max(uploaded) if uploaded else F.lit(None)
    marks = (
        written.groupBy(in_partition, (F.col(source) if source else F.lit(None)).alias("source"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            latest.cast("timestamp_ntz").alias("uploaded"),
            *[F.count_if(condition).alias(f"_{name}") for name, condition in conditions.items()],
        )
        .groupBy("partition")
        .agg(
            F.sum("rows").alias("rows"),
            F.collect_list(F.struct("source", "uploaded")).alias("sources"),
            F.max("uploaded").alias("uploaded"),
            *[F.sum(f"_{name}").alias(f"_{name}") for name in conditions],
        )
    )
    fresh = write_stage(marks.withColumn("run", F.lit(number).cast("bigint")), "fresh-partitions")
    for name, columns in listed.items():
        values = written.select(*columns, in_partition).distinct()
        values.write.parquet(f"{path}/{LISTED}/{name}/{RUN}={number}")
    if keys:
        key_index.add_keys(written, path, column, keys, number)
    gone = fresh.select("partition")
    if touched is not None:
        gone = touched.select(partition_name(column).alias("partition")).distinct()
    old = read_current(spark, path)
    current = old.join(gone, "partition", "left_anti").unionByName(fresh.select(*old.columns))
    before = old.join(gone, "partition", "left_semi").agg(F.sum("rows"))
    counts = fresh.agg(F.sum("rows"), *[F.sum(f"_{name}") for name in conditions]).first()
    seen = dict(zip(["rows", *conditions, "before"], [*counts, before.first()[0]], strict=True))
    seen = {name: count or 0 for name, count in seen.items()}
    if added is not None:
        seen |= {"inserted": added, "deleted": seen["before"] + added - seen["rows"]}
    snapshot = _next_snapshot(spark, f"{path}/{CURRENT}")
    audit = spark.createDataFrame([_audit_row(seen)], AUDIT_SCHEMA)
    # A run that failed after this may have left the same snapshot's tables.
    audit.write.mode("overwrite").parquet(f"{path}/{AUDIT}/{snapshot}")
    for name, table in beside.items():
        table.write.mode("overwrite").parquet(f"{path}/{BESIDE}/{name}/{snapshot}")
    publish_snapshot(current.coalesce(1), f"{path}/{CURRENT}")
    return seen


def _audit_row(seen: Mapping[str, int]) -> tuple[int, ...]:
    added = seen.get("inserted", seen["rows"])
    gone = seen["before"] + added - seen["rows"]
    return added, seen.get("matched", 0), gone, seen["rows"], seen["before"]


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """What each run that became current inserted, updated and deleted; ``load`` counts from 1."""
    done = [n for n, complete in _snapshots(spark, f"{path}/{CURRENT}") if complete]
    schema = f"{AUDIT_SCHEMA}, load int"
    if not done:
        return empty_frame(spark, schema)
    rows = spark.read.schema(AUDIT_SCHEMA).parquet(*[f"{path}/{AUDIT}/{n}" for n in done])
    name = F.regexp_extract(F.input_file_name(), r"/snapshot-(\d+)/", 1)
    return rows.withColumn("load", name.cast("int") + 1)


def snapshot_audit(spark: SparkSession, root: str) -> DataFrame:
    """What each whole replacement of ``root`` inserted and deleted, from the kept snapshots."""
    done = [n for n, complete in _snapshots(spark, root) if complete]
    counts = [spark.read.parquet(f"{root}/{n}").count() for n in done]
    rows = [(n, now, old) for n, (now, old) in enumerate(zip(counts, [0, *counts]), 1)]
    return spark.createDataFrame(rows, "load int, inserted bigint, deleted bigint")


def merge_partitions(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    column: str,
    most: int = 8,
    uploaded: str | None = None,
    source: str | None = None,
    keys: Sequence[str] = (),
    reduce: Callable[[DataFrame], DataFrame] | None = None,
) -> list[str]:
    """Write partitions whose rows lie in more than ``most`` runs again, as one run.

    Rows that match nothing, such as those without a date, are added by each run, and with them
    an entry of the snapshot and some small files.  This is a run of its own, so no load
    pays for it, and a partition is written again once in ``most`` loads only.  Readers of
    older snapshots keep their files until ``remove_old_runs``.

    ``uploaded``, ``source`` and ``keys`` are those that the mart is published with; listed
    values and the tables beside the snapshot are found and carried on.  ``reduce`` makes
    fewer rows of the merged ones.  Returns the names of the merged partitions.
    """
    current = read_current(spark, path).select("partition", RUN)
    crowded = current.groupBy("partition").count().filter(F.col("count") > most)
    names = sorted(r.partition for r in crowded.collect())
    if not names:
        return []
    touched = partition_dates(spark.createDataFrame([(n,) for n in names], "partition string"), column)
    rows = read_partitions(spark, path, schema, column, touched)
    listed = {
        name: [
            c
            for c in spark.read.parquet(f"{path}/{LISTED}/{name}").columns
            if c not in ("partition", RUN)
        ]
        for name in folder_names(spark, f"{path}/{LISTED}")
    }
    newest = [n for n, done in _snapshots(spark, f"{path}/{CURRENT}") if done][-1]
    beside = {
        name: spark.read.parquet(f"{path}/{BESIDE}/{name}/{newest}")
        for name in folder_names(spark, f"{path}/{BESIDE}")
        if exists(spark, f"{path}/{BESIDE}/{name}/{newest}")
    }
    publish_partitions(
        reduce(rows) if reduce else rows,
        path,
        column,
        touched,
        uploaded=uploaded,
        source=source,
        keys=keys,
        listed=listed,
        beside=beside,
        added=0,
    )
    return names


def remove_old_runs(spark: SparkSession, path: str) -> list[int]:
    """Delete run folders that the snapshot names nowhere; not while a run or a reader of an
    older snapshot is at work."""
    current = {r.run for r in read_current(spark, path).select("run").distinct().collect()}
    old = [n for n in range(1, _next_run(spark, path)) if n not in current]
    kinds = [RUNS, *(f"{LISTED}/{name}" for name in folder_names(spark, f"{path}/{LISTED}"))]
    for number in old:
        for kind in kinds:
            files, folder = _file_system(spark, f"{path}/{kind}/{RUN}={number}")
            files.delete(folder, True)
    return old
