"""Mart mutations: update-insert, key, window and full replace, refresh."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from martloom.operators.dedup import latest_wins
from martloom.operators.merge import (
    refresh_attribute,
    replace_by_key,
    replace_window,
    update_insert,
)
from martloom.session import scratch_folder, write_stage
from martloom.sources.mart import publish_snapshot, read_snapshot, snapshot_audit
from registry import register, table

KEYS = ["l_orderkey", "l_linenumber"]
FIRST_RUN = datetime(2024, 1, 1)
SECOND_RUN = datetime(2024, 1, 2)

# Target: line items shipped before a day, delta: those shipped from it on; the
# latest per key on each side.  Some keys have a NULL part.
SPLIT_SQL = """
    staged AS (
      SELECT * REPLACE (CASE WHEN l_partkey % 101 <> 0 THEN l_linenumber END AS l_linenumber)
      FROM lineitem),
    latest AS (
      SELECT *, row_number() OVER (
        PARTITION BY l_shipdate < TIMESTAMP '1998-07-01', l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS FIRST, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM staged),
    target AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                      l_shipdate
               FROM latest WHERE rn = 1 AND l_shipdate < TIMESTAMP '1998-07-01'),
    delta AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                     l_shipdate
              FROM latest WHERE rn = 1 AND l_shipdate >= TIMESTAMP '1998-07-01')"""


def _split(spark, folder):
    staged = table(spark, folder, "lineitem").withColumn(
        "l_linenumber", F.when(F.col("l_partkey") % 101 != 0, F.col("l_linenumber"))
    )

    def latest(condition):
        return latest_wins(staged.filter(condition), KEYS, "l_shipdate").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_shipdate",
        )

    day = "TIMESTAMP_NTZ '1998-07-01 00:00:00'"
    return latest(f"l_shipdate < {day}"), latest(f"l_shipdate >= {day}")


@register(
    "upsert_update_insert",
    f"""
    WITH {SPLIT_SQL}
    SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey,
           CASE WHEN d.l_orderkey IS NULL THEN t.l_quantity ELSE d.l_quantity END AS l_quantity,
           CASE WHEN d.l_orderkey IS NULL THEN t.l_extendedprice ELSE d.l_extendedprice END
             AS l_extendedprice,
           t.l_shipdate, TIMESTAMP '2024-01-01 00:00:00' AS cre_ts,
           CASE WHEN d.l_orderkey IS NULL THEN TIMESTAMP '2024-01-01 00:00:00'
                ELSE TIMESTAMP '2024-01-02 00:00:00' END AS updt_ts
    FROM target t LEFT JOIN delta d
      ON t.l_orderkey = d.l_orderkey AND t.l_linenumber = d.l_linenumber
    UNION ALL
    SELECT d.*, TIMESTAMP '2024-01-02 00:00:00', TIMESTAMP '2024-01-02 00:00:00'
    FROM delta d
    WHERE NOT EXISTS (SELECT 1 FROM target t
                      WHERE t.l_orderkey = d.l_orderkey AND t.l_linenumber = d.l_linenumber)""",
)
def upsert(spark, folder):
    target, delta = _split(spark, folder)
    first = F.lit(FIRST_RUN.isoformat(sep=" ")).cast("timestamp_ntz")
    stamped = target.withColumns({"cre_ts": first, "updt_ts": first})
    return update_insert(
        stamped,
        delta,
        KEYS,
        ["l_quantity", "l_extendedprice"],
        SECOND_RUN,
        created="cre_ts",
        updated="updt_ts",
    )


@register(
    "replace_by_key",
    f"""
    WITH {SPLIT_SQL}
    SELECT * FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM delta d
                      WHERE t.l_orderkey = d.l_orderkey AND t.l_linenumber = d.l_linenumber)
    UNION ALL SELECT * FROM delta""",
)
def key_replace(spark, folder):
    target, delta = _split(spark, folder)
    return replace_by_key(target, write_stage(delta, "delta"), KEYS)


@register(
    "replace_window",
    f"""
    WITH {SPLIT_SQL},
    timed AS (
      SELECT * REPLACE (CASE WHEN l_suppkey % 20 <> 0 THEN l_shipdate END AS l_shipdate) FROM target)
    SELECT * FROM timed t
    WHERE NOT coalesce(l_shipdate > TIMESTAMP '1997-03-01' AND l_shipdate <= TIMESTAMP '1998-02-01',
                       FALSE)
      AND NOT EXISTS (SELECT 1 FROM delta d
                      WHERE t.l_orderkey = d.l_orderkey AND t.l_linenumber = d.l_linenumber)
    UNION ALL SELECT * FROM delta""",
)
def window_replace(spark, folder):
    target, delta = _split(spark, folder)
    timed = target.withColumn(
        "l_shipdate", F.when(F.col("l_suppkey") % 20 != 0, F.col("l_shipdate"))
    )
    return replace_window(
        timed, write_stage(delta, "delta"), KEYS, "l_shipdate", datetime(1997, 3, 1), datetime(1998, 2, 1)
    )


@register("full_replace", f"WITH {SPLIT_SQL} SELECT * FROM delta")
def full_replace(spark, folder):
    target, delta = _split(spark, folder)
    root = f"{scratch_folder(spark)}/full-replace-{uuid.uuid4().hex}"
    publish_snapshot(target, root)
    publish_snapshot(delta, root)
    return read_snapshot(spark, root)


@register(
    "replace_audit",
    f"""
    WITH {SPLIT_SQL}, sizes AS (
      SELECT (SELECT count(*) FROM target) AS t, (SELECT count(*) FROM delta) AS d)
    SELECT 1 AS load, t AS inserted, 0 AS deleted FROM sizes UNION ALL SELECT 2, d, t FROM sizes""",
)
def replace_audit(spark, folder):
    """What two whole replacements inserted and deleted."""
    root = f"{scratch_folder(spark)}/replace-audit-{uuid.uuid4().hex}"
    for table_ in _split(spark, folder):
        publish_snapshot(table_, root)
    return snapshot_audit(spark, root)


@register(
    "refresh_attribute",
    """
    WITH dim AS (
      SELECT c_custkey AS o_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) END
               AS o_orderpriority
      FROM customer WHERE c_custkey % 3 <> 2)
    SELECT o_orderkey, o.o_custkey,
           CASE WHEN d.o_custkey IS NOT NULL THEN d.o_orderpriority ELSE o.o_orderpriority END
             AS o_orderpriority
    FROM orders o LEFT JOIN dim d ON o.o_custkey = d.o_custkey""",
)
def attribute_refresh(spark, folder):
    key = F.col("c_custkey")
    dim = (
        table(spark, folder, "customer")
        .filter(key % 3 != 2)
        .select(
            key.alias("o_custkey"),
            F.when(key % 3 == 0, F.upper("c_mktsegment")).alias("o_orderpriority"),
        )
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return refresh_attribute(orders, dim, "o_custkey", "o_orderpriority")
