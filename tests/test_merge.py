import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators.merge import (
    refresh_attribute,
    replace_by_key,
    replace_window,
    update_insert,
)
from martloom.session import write_stage
from martloom.sources.mart import (
    publish_partitions,
    publish_snapshot,
    read_current,
    read_partitioned,
    read_partitions,
    remove_old_runs,
    read_snapshot,
)

DAY = [datetime(2024, 1, d) for d in range(1, 10)]
SCHEMA = "k string, n int, v string, up timestamp_ntz, cre timestamp_ntz, upd timestamp_ntz"
RUN = dict(keys=["k", "n"], update_cols=["v"], created="cre", updated="upd")


def mart(spark):
    rows = [
        ("a", 1, "old", DAY[0], DAY[0], DAY[0]),
        ("b", 1, "kept", DAY[0], DAY[0], DAY[0]),
        ("c", None, "null key", DAY[0], DAY[0], DAY[0]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def delta(spark, *rows):
    return spark.createDataFrame(
        [(k, n, v, DAY[4], None, None) for k, n, v in rows], SCHEMA
    )


def test_update_insert(spark):
    new = delta(spark, ("a", 1, None), ("d", 1, "new"), ("c", None, "null again"))
    out = update_insert(mart(spark), new, as_of=DAY[5], **RUN)
    got = {(r.k, r.v): (r.up, r.cre, r.upd) for r in out.collect()}
    assert got == {
        ("a", None): (DAY[0], DAY[0], DAY[5]),
        ("b", "kept"): (DAY[0], DAY[0], DAY[0]),
        ("c", "null key"): (DAY[0], DAY[0], DAY[0]),
        ("c", "null again"): (DAY[4], DAY[5], DAY[5]),
        ("d", "new"): (DAY[4], DAY[5], DAY[5]),
    }


def test_update_insert_twice(spark):
    new = delta(spark, ("a", 1, "x"), ("d", 1, "new"))
    once = update_insert(mart(spark), new, as_of=DAY[5], **RUN)
    twice = update_insert(once, new, as_of=DAY[5], **RUN)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_null_keys_spread_over_partitions(spark):
    """A third of the mart without a key must not meet in one shuffle partition."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 != 0, F.lit(1)).alias("n"),
        F.col("id").cast("string").alias("v"),
    )
    stamps = ["up", "cre", "upd"]
    target = rows.select("*", *[F.lit(DAY[0]).cast("timestamp_ntz").alias(c) for c in stamps])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = update_insert(target, delta(spark, ("1", 1, "x")), as_of=DAY[5], **RUN)
        sizes = [
            r["count"]
            for r in out.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 1000 and max(sizes) < 500


def test_replace_by_key(spark):
    new = delta(spark, ("a", 1, "new"), ("c", None, "null again"))
    got = sorted((r.k, r.v) for r in replace_by_key(mart(spark), new, ["k", "n"]).collect())
    assert got == [("a", "new"), ("b", "kept"), ("c", "null again"), ("c", "null key")]


def test_replace_window(spark):
    rows = [
        ("start", 1, "kept", DAY[1]),
        ("inside", 1, "gone", DAY[2]),
        ("end", 1, "gone", DAY[3]),
        ("no time", 1, "kept", None),
        ("key", 1, "gone", DAY[0]),
    ]
    schema = "k string, n int, v string, up timestamp_ntz"
    target = spark.createDataFrame(rows, schema)
    new = spark.createDataFrame([("key", 1, "new", DAY[3])], schema)
    out = replace_window(target, new, ["k", "n"], "up", DAY[1], DAY[3])
    assert sorted((r.k, r.v) for r in out.collect()) == [
        ("key", "new"),
        ("no time", "kept"),
        ("start", "kept"),
    ]


def test_refresh_attribute(spark):
    target = spark.createDataFrame(
        [("a", "old"), ("b", "old"), ("c", "old"), (None, "old")], "k string, v string"
    )
    dim = spark.createDataFrame([("a", "new"), ("b", None)], "k string, v string")
    got = {r.k: r.v for r in refresh_attribute(target, dim, "k", "v").collect()}
    assert got == {"a": "new", "b": None, "c": "old", None: "old"}


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "mart")
    assert read_snapshot(spark, root, SCHEMA).count() == 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    publish_snapshot(mart(spark), root)
    current = read_snapshot(spark, root)
    publish_snapshot(current.filter("k = 'a'"), root)
    assert read_snapshot(spark, root, SCHEMA).count() == 1
    with pytest.raises(Exception, match="broken"):
        broken = F.when(F.col("k") == "a", F.raise_error(F.lit("broken"))).otherwise(F.col("v"))
        publish_snapshot(read_snapshot(spark, root).withColumn("v", broken), root)
    assert read_snapshot(spark, root).count() == 1


def days_of(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "d date")


def test_partitions(spark, tmp_path):
    path = str(tmp_path / "mart")
    schema = "k string, d date"
    days = [date(2024, 1, n) for n in range(1, 5)]

    def stored():
        return read_partitioned(spark, path, schema, "d")

    assert stored().isEmpty()
    rows = [("a", days[0]), ("b", days[1]), ("c", None), ("d", days[2])]
    publish_partitions(spark.createDataFrame(rows, schema), path, "d")
    touched = days_of(spark, days[0], days[1], None)
    part = read_partitions(spark, path, schema, "d", touched)
    assert {r.k for r in part.collect()} == {"a", "b", "c"}
    moved = part.withColumn("d", F.when(F.col("k") == "a", F.lit(days[3])).otherwise(F.col("d")))
    untouched = read_partitions(spark, path, schema, "d", days_of(spark, days[2])).inputFiles()
    seen = publish_partitions(moved.filter("k <> 'c'"), path, "d", touched, late=F.col("k") == "b")
    assert seen == {"rows": 2, "late": 1, "before": 3}
    assert {(r.k, r.d) for r in stored().collect()} == {
        ("a", days[3]),
        ("b", days[1]),
        ("d", days[2]),
    }
    assert set(untouched) <= set(stored().inputFiles())
    # Rows of a partition that isn't touched are added to it.
    publish_partitions(spark.createDataFrame([("e", None)], schema), path, "d", days_of(spark))
    publish_partitions(spark.createDataFrame([("f", None)], schema), path, "d", days_of(spark))
    assert {r.k for r in stored().filter("d IS NULL").collect()} == {"e", "f"}
    before = stored().collect()
    assert remove_old_runs(spark, path) == []
    publish_partitions(stored().filter("k <> 'f'"), path, "d")
    assert remove_old_runs(spark, path) == [1, 2, 3, 4]
    assert len(stored().collect()) == len(before) - 1


def test_a_run_that_fails_leaves_the_mart_as_it_was(spark, tmp_path):
    path = str(tmp_path / "mart")
    schema = "k string, d date"
    days = [date(2024, 1, n) for n in range(1, 5)]
    first = spark.createDataFrame([("a", days[0]), ("b", days[1])], schema)
    publish_partitions(first, path, "d")
    broken = F.when(F.col("k") == "b", F.raise_error(F.lit("broken"))).otherwise(F.col("k"))
    part = read_partitioned(spark, path, schema, "d")
    with pytest.raises(Exception, match="broken"):
        publish_partitions(part.withColumn("k", broken), path, "d")
    # As if the driver died between the last task and the switch.
    part.withColumn("k", F.lit("half")).write.partitionBy("d").parquet(f"{path}/runs/run=9")
    assert {r.k for r in read_partitioned(spark, path, schema, "d").collect()} == {"a", "b"}
    publish_partitions(part.withColumn("k", F.upper("k")), path, "d")
    assert {r.k for r in read_partitioned(spark, path, schema, "d").collect()} == {"A", "B"}
    assert {r.run for r in read_current(spark, path).collect()} == {10}


def test_update_of_a_small_delta_does_not_shuffle_the_target(spark, tmp_path):
    stamps = ["up", "cre", "upd"]
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("k"), F.lit(1).alias("n"), F.lit("v").alias("v"),
        *[F.lit(DAY[0]).cast("timestamp_ntz").alias(c) for c in stamps],
    )
    rows.write.parquet(str(tmp_path / "target"))
    delta(spark, ("1", 1, "x"), (None, 1, "y")).write.parquet(str(tmp_path / "delta"))
    target = spark.read.parquet(str(tmp_path / "target"))
    out = update_insert(target, spark.read.parquet(str(tmp_path / "delta")), as_of=DAY[5], **RUN)
    assert out.count() == 2001
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_computed_columns_are_neither_staged_nor_shuffled(spark, tmp_path, monkeypatch):
    """A stored value that its expression doesn't give is kept."""
    double = {"twice": F.col("n") * 2}
    rows = [("2020-01-01", 1, 2), ("2020-01-01", 2, 5), ("2020-01-02", None, 7), (None, 3, None)]
    df = spark.createDataFrame(rows, "day string, n int, twice int").withColumn(
        "day", F.to_date("day")
    )
    monkeypatch.setattr("martloom.session.scratch_folder", lambda _: str(tmp_path / "stages"))
    staged = write_stage(df, "stage", double)
    (folder,) = (tmp_path / "stages").iterdir()
    assert spark.read.parquet(str(folder)).columns == ["day", "n"]
    assert {(r.n, r.twice) for r in staged.collect()} == {(1, 2), (2, 4), (None, None), (3, 6)}
    path = str(tmp_path / "mart")
    publish_partitions(df, path, "day", computed=double)
    stored = read_partitioned(spark, path, df.schema, "day").collect()
    assert sorted(map(str, stored)) == sorted(map(str, df.collect()))


def test_update_takes_only_the_updated_columns_to_the_target(spark):
    target = mart(spark).withColumn("passed", F.lit("p"))
    made = {"passed": F.concat(F.lit("p"), "k")}
    new = delta(spark, ("a", 1, "x"), ("d", 1, "new"))
    got = update_insert(target, new, as_of=DAY[5], **RUN, computed=made).collect()
    assert {(r.k, r.v, r.passed) for r in got} >= {("a", "x", "p"), ("d", "new", "pd")}
    out = update_insert(target, target, as_of=DAY[5], **RUN)
    plan = out._jdf.queryExecution().analyzed().toString()
    packed = re.findall(r"struct\(([^()]*)\) AS new#", plan)
    assert packed and not any("passed" in columns for columns in packed)
