"""One key holding a third of the rows: results stay whole, work is split."""

from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators.dedup import earliest_all, latest_wins
from martloom.operators.lookup import left_lookup
from martloom.operators.merge import without_keys
from martloom.sources.mart import publish_partitions, read_partitioned


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SPLIT_EARLY = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
    "spark__sql__shuffle__partitions": "8",
}
ROWS = 60000


@pytest.fixture(scope="module")
def facts(spark):
    """A third on one key, another sixth on NULL."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 0).when(n % 6 != 1, n % 5000)
    return spark.range(0, ROWS, 1, 8).select(
        n, key.cast("int").alias("k"), F.sha2(n.cast("string"), 256).alias("pad")
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_in_a_lookup_is_split(spark, facts):
    dim = spark.range(5000).select(F.col("id").cast("int").alias("d"), F.col("id").alias("v"))
    with settings(spark, **SPLIT_EARLY):
        joined = left_lookup(facts, dim, [("k", "d")], ["v"])
        assert joined.count() == ROWS
        assert joined.filter("k IS NULL AND v IS NOT NULL").count() == 0
        assert joined.filter("k IS NOT NULL AND v <> k").count() == 0
        assert "skew=true" in final_plan(joined)


def test_hot_null_key_in_a_delete_is_spread(spark, facts):
    gone = spark.range(1, 5000).select(F.col("id").cast("int").alias("k"))
    with settings(spark, **SPLIT_EARLY):
        kept = without_keys(facts, gone, ["k"])
        counts = {r.k: r["count"] for r in kept.groupBy("k").count().collect()}
    want = {r.k: r["count"] for r in facts.groupBy("k").count().collect()}
    assert counts == {k: want[k] for k in (0, None)}


def test_hot_key_is_reduced_before_the_shuffle(spark, facts):
    latest = latest_wins(facts.filter("k IS NOT NULL"), ["k"], "id")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        got = {r.k: r.id for r in latest.collect()}
        plan = latest._jdf.queryExecution().executedPlan()
    top = facts.groupBy("k").agg(F.max("id").alias("id")).filter("k IS NOT NULL").collect()
    assert got == {r.k: r.id for r in top}
    text = plan.toString()
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_group_of_copies_collapses_before_the_shuffle(spark):
    log = spark.range(0, 30000, 1, 8).select(
        F.lit("hot").alias("k"), F.lit(1).alias("t"), (F.col("id") % 2).alias("v")
    )
    out = earliest_all(log, ["k"], ["t"])
    assert sorted(r.v for r in out.collect()) == [0, 1]
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = earliest_all(log, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("HashAggregate")


def test_hot_partition_is_written_by_several_tasks(spark, facts, tmp_path):
    path = str(tmp_path / "mart")
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise("2024-01-02").cast("date")
    rows = facts.select("id", "pad", day.alias("d"))
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB",
        spark__sql__shuffle__partitions="8",
    ):
        publish_partitions(rows, path, "d")
    stored = read_partitioned(spark, path, "id bigint, pad string, d date", "d")
    assert stored.count() == ROWS
    hot = [f for f in stored.inputFiles() if "d=2024-01-02" in f]
    assert 1 < len(hot) < 40


def test_timestamps_are_compared_as_given(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 1),)], "ts timestamp_ntz")
    from martloom.operators.load_window import in_half_open_window

    assert in_half_open_window(df, "ts", datetime(2024, 1, 1), datetime(2024, 1, 2)).count() == 1
