from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from martloom.operators.lookup import (
    LOOKUP_PARTITIONS,
    calendar_lookup,
    flag_member,
    interval_lookup,
    left_lookup,
    not_in_list,
    unique_lookup,
    unique_rows,
)


def test_left_lookup_keeps_null_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    dim = spark.createDataFrame([("a", "x"), (None, "never")], "k string, v string")
    got = {r.id: r.v for r in left_lookup(facts, dim, [("k", "k")], ["v"]).collect()}
    assert got == {1: "x", 2: None}


def test_calendar_lookup(spark):
    weeks = [(date(2020, 1, 1), date(2020, 1, 7)), (date(2020, 1, 7), date(2020, 1, 13))]
    weeks.append((date(2020, 2, 2), date(2020, 2, 1)))
    calendar = spark.createDataFrame(weeks, "a date, b date")
    days = [date(2020, 1, 1), date(2020, 1, 7), date(2020, 1, 14), None]
    facts = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, d date")
    got = calendar_lookup(facts, calendar, "d", "a", "b", ["b"]).collect()
    pairs = sorted((r.id, str(r.b)) for r in got)
    assert pairs == [
        (0, "2020-01-07"),
        (1, "2020-01-07"),
        (1, "2020-01-13"),
        (2, "None"),
        (3, "None"),
    ]


def test_flag_member(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    members = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    got = sorted((str(r.k), r.hit) for r in flag_member(facts, members, "k", "hit").collect())
    assert got == [("None", False), ("a", True), ("b", False)]


@pytest.mark.parametrize("members", [["a"], ["a", None], []])
def test_not_in_list_is_sql_not_in(spark, members):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    listed = spark.createDataFrame([(m,) for m in members], "m string")
    facts.createOrReplaceTempView("facts")
    listed.createOrReplaceTempView("listed")
    want = spark.sql("SELECT k FROM facts WHERE k NOT IN (SELECT m FROM listed)").collect()
    got = not_in_list(facts, listed, "k", "m").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


text = st.text(alphabet="0189AZa~é", max_size=4)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(text, max_size=40), st.lists(st.tuples(text, text), max_size=40))
def test_interval_lookup_is_the_range_join(spark, values, bounds):
    members = spark.createDataFrame(
        [(i, v, i % 2) for i, v in enumerate(values)], "mid int, v string, area int"
    )
    intervals = spark.createDataFrame(
        [(i, "I", "BT", a, b, i % 2) for i, (a, b) in enumerate(bounds)],
        "iid int, valsign string, valoption string, valfrom string, valto string, area int",
    )
    got = sorted(
        (r.mid, r.iid) for r in interval_lookup(members, intervals, ["area"], "v").collect()
    )
    want = sorted(
        (m, i)
        for m, v in enumerate(values)
        for i, (a, b) in enumerate(bounds)
        if m % 2 == i % 2 and a.encode() <= v.encode() <= b.encode()
    )
    assert got == want


def test_interval_options_and_signs(spark):
    members = spark.createDataFrame([("0010",), ("0020",), ("0030",)], "v string").withColumn(
        "area", F.lit(1)
    )
    rows = [
        ("eq hit", "I", "EQ", "0010", None),
        ("eq miss", "I", "EQ", "0011", None),
        ("both ends", "I", "BT", "0010", "0030"),
        ("inverted", "I", "BT", "0030", "0010"),
        ("no end", "I", "BT", "0010", None),
        ("unknown", "I", "CP", "0010", "0030"),
        ("excluding", "E", "EQ", "0010", None),
    ]
    intervals = spark.createDataFrame(
        rows, "n string, valsign string, valoption string, valfrom string, valto string"
    ).withColumn("area", F.lit(1))
    got = sorted((r.n, r.v) for r in interval_lookup(members, intervals, ["area"], "v").collect())
    assert got == [
        ("both ends", "0010"),
        ("both ends", "0020"),
        ("both ends", "0030"),
        ("eq hit", "0010"),
    ]


def test_interval_keys_are_made_by_several_tasks(spark):
    """Also of one partition's rows, as a small file gives them."""
    members = spark.createDataFrame([(n, "A", f"{n:04}") for n in range(64)], "mid int, area string, v string")
    intervals = spark.createDataFrame(
        [(n, "A", "I", "BT", f"{n:04}", f"{n + 1:04}") for n in range(64)],
        "iid int, area string, valsign string, valoption string, valfrom string, valto string",
    )
    found = interval_lookup(members.coalesce(1), intervals.coalesce(1), ["area"], "v")
    plan = found._jdf.queryExecution().executedPlan().toString()
    sides = [line for line in plan.splitlines() if "RoundRobinPartitioning" in line]
    assert len(sides) == 2 and found.count() == 127


def test_unique_lookup(spark):
    facts = spark.createDataFrame([("a",), ("none",)], "k string")
    dim = spark.createDataFrame([("a", 1), ("twice", 2), ("twice", 2)], "k string, v int")
    got = {r.k: r.out for r in unique_lookup(facts, dim, [("k", "k")], "v", "out").collect()}
    assert got == {"a": 1, "none": None}
    bad = spark.createDataFrame([("twice",)], "k string")
    with pytest.raises(Exception, match="more than one row"):
        unique_lookup(bad, dim, [("k", "k")], "v", "out").collect()


def test_unique_lookup_combines_after_the_shuffle(spark):
    """No task holds the keys of its whole input, however few tasks read the dimension."""
    dim = spark.range(0, 50_000, numPartitions=1).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = unique_rows(dim, ["k"], "v")._jdf.queryExecution().sparkPlan().toString()
    lines = [line for line in plan.splitlines() if "Aggregate" in line or "Exchange" in line]
    assert "Exchange" in lines[-1] and "Aggregate" not in lines[-1]
    assert unique_rows(dim, ["k"], "v").rdd.getNumPartitions() == LOOKUP_PARTITIONS


def test_unique_lookup_of_null_keys(spark):
    facts = spark.createDataFrame([("a", "x"), ("a", None), (None, None)], "k string, u string")
    dim = spark.createDataFrame(
        [("a", "x", 1), ("a", None, 2), ("a", None, 3), (None, None, 4)], "k string, u string, v int"
    )
    on = [("k", "k"), ("u", "u")]
    got = [tuple(r) for r in unique_lookup(facts, dim, on, "v", "out").collect()]
    assert sorted(got, key=str) == [("a", "x", 1), ("a", None, None), (None, None, None)]


def test_unique_lookup_is_not_broadcast_on_a_guess(spark, tmp_path):
    """A small file whose rows are exploded keeps a small estimate."""
    path = str(tmp_path / "part")
    spark.range(1000).write.parquet(path)
    dim = spark.read.parquet(path).select(F.explode(F.sequence("id", F.col("id") + 9)).alias("k"))
    facts = spark.read.parquet(path).withColumnRenamed("id", "k")
    out = unique_lookup(facts, dim.distinct().withColumn("v", F.col("k") * 2), [("k", "k")], "v", "out")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert out.filter("out = 2 * k").count() == 1000
