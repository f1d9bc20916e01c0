"""What a stored mart knows without its rows being read: keys, watermarks, listed values."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.operators.diff import changed_keys
from martloom.operators.load_window import ntz_literal, slowest_source_high_water, start_of
from martloom.session import new_mart_path
from martloom.sources.key_index import partitions_of_keys
from martloom.sources.mart import (
    partition_dates,
    publish_partitions,
    read_listed,
    read_partitions,
    source_uploads,
)
from registry import register, table

KEYS = ["l_orderkey", "l_linenumber"]
MONTH = "ship_month"
SCHEMA = "l_orderkey bigint, l_linenumber bigint, l_returnflag string, l_shipdate timestamp_ntz"


def _mart_of_lines(spark, folder):
    """Lines by month of shipping; a second run moves a tenth of them two months on."""
    path, month = new_mart_path(spark), F.trunc("l_shipdate", "month")
    typed = [F.col(f.split()[0]).cast(f.split()[1]) for f in SCHEMA.split(", ")]
    lines = table(spark, folder, "lineitem").select(*typed).withColumn(MONTH, month)
    facts = {"uploaded": "l_shipdate", "source": "l_returnflag", "keys": KEYS}
    facts["listed"] = {"modes": ["l_returnflag"]}
    publish_partitions(lines, path, MONTH, **facts)
    moving = lines.filter("l_orderkey % 10 = 0")
    months = partitions_of_keys(spark, path, moving, KEYS)
    touched = partition_dates(months, MONTH)
    later = F.col("l_shipdate") + F.expr("INTERVAL 2 MONTHS")
    moved = moving.withColumn("l_shipdate", later).withColumn(MONTH, month)
    touched = touched.unionByName(moved.select(MONTH)).distinct()
    part = read_partitions(spark, path, f"{SCHEMA}, {MONTH} date", MONTH, touched)
    kept = part.join(moving.select(*KEYS), KEYS, "left_anti")
    publish_partitions(kept.unionByName(moved), path, MONTH, touched, **facts)
    return path


LINES_SQL = """
    SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_orderkey % 10 = 0
               THEN l_shipdate + INTERVAL 2 MONTHS ELSE l_shipdate END AS l_shipdate
    FROM lineitem"""


@register(
    "key_index_lookup",
    f"""
    SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month
    FROM ({LINES_SQL}) WHERE l_orderkey % 500 = 0""",
)
def key_index_lookup(spark, folder):
    """The months that hold lines of some orders, from the key index after a move."""
    wanted = table(spark, folder, "lineitem").filter("l_orderkey % 500 = 0").select(
        F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("bigint")
    )
    months = partitions_of_keys(spark, _mart_of_lines(spark, folder), wanted, KEYS)
    return partition_dates(months, MONTH).distinct()


@register(
    "source_watermarks",
    f"""
    WITH lines AS ({LINES_SQL}), latest AS (
        SELECT l_returnflag, max(l_shipdate) AS uploaded FROM lines GROUP BY l_returnflag)
    SELECT l_returnflag, uploaded, (SELECT min(uploaded) FROM latest) AS start_ts FROM latest""",
)
def source_watermarks(spark, folder):
    """The latest upload of each source and the start that the slowest gives."""
    marks = source_uploads(spark, _mart_of_lines(spark, folder), "l_returnflag", "uploaded")
    start = start_of(slowest_source_high_water(marks, "l_returnflag", "uploaded"))
    latest = marks.groupBy("l_returnflag").agg(F.max("uploaded").alias("uploaded"))
    return latest.withColumn("start_ts", ntz_literal(start))


@register(
    "listed_values",
    f"""
    SELECT l_returnflag, count(DISTINCT date_trunc('month', l_shipdate)) AS months
    FROM ({LINES_SQL}) GROUP BY l_returnflag""",
)
def listed_values(spark, folder):
    """In how many months each ship mode occurs, from the values that runs listed."""
    listed = read_listed(spark, _mart_of_lines(spark, folder), "modes", "l_returnflag string")
    months = F.count_distinct("partition").alias("months")
    return listed.groupBy("l_returnflag").agg(months)


def _customer_states(spark, folder):
    """A table of customers and the state before it: fewer rows, other values, other NULLs."""
    now = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 6 > 0, F.col("c_mktsegment")).alias("segment"),
        "c_nationkey",
    )
    segment = (
        F.when(F.col("c_custkey") % 30 == 0, F.lit("NEW"))
        .when(F.col("c_custkey") % 30 == 1, F.lit(None))
        .otherwise(F.col("segment"))
    )
    before = now.filter("c_custkey % 11 <> 0").withColumn("segment", segment)
    return before, now.filter("c_custkey % 13 <> 0")


@register(
    "attribute_diff",
    """
    WITH now AS (
        SELECT c_custkey, CASE WHEN c_custkey % 6 > 0 THEN c_mktsegment END AS segment, c_nationkey
        FROM customer
    ), before AS (
        SELECT * REPLACE (CASE c_custkey % 30 WHEN 0 THEN 'NEW' WHEN 1 THEN NULL
                          ELSE segment END AS segment)
        FROM now WHERE c_custkey % 11 <> 0
    ), after AS (SELECT * FROM now WHERE c_custkey % 13 <> 0)
    SELECT c_custkey FROM (
        (SELECT * FROM before EXCEPT SELECT * FROM after)
        UNION ALL (SELECT * FROM after EXCEPT SELECT * FROM before)
    ) GROUP BY c_custkey""",
)
def attribute_diff(spark, folder):
    """Customers whose attributes differ between two states."""
    return changed_keys(*_customer_states(spark, folder), "c_custkey")
