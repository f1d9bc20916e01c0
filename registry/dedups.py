"""One row or value per key."""

from pyspark.sql import functions as F

from martloom.operators.dedup import latest_value, latest_wins, priority_pick
from martloom.plans.pos_market import canonical_markets
from registry import register, table

LINE_KEYS = ["l_orderkey", "l_linenumber"]


@register(
    "latest_wins",
    """
    WITH staged AS (
      SELECT * REPLACE (CASE WHEN l_partkey % 50 <> 0 THEN l_shipdate END AS l_shipdate,
                        CASE WHEN l_suppkey % 50 <> 0 THEN l_linenumber END AS l_linenumber)
      FROM lineitem)
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS FIRST, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM staged) WHERE rn = 1""",
)
def latest_lines(spark, folder):
    staged = table(spark, folder, "lineitem").withColumns(
        {
            "l_shipdate": F.when(F.col("l_partkey") % 50 != 0, F.col("l_shipdate")),
            "l_linenumber": F.when(F.col("l_suppkey") % 50 != 0, F.col("l_linenumber")),
        }
    )
    return latest_wins(staged, LINE_KEYS, "l_shipdate")


@register(
    "latest_attribute",
    """
    SELECT o_custkey, o_orderstatus FROM (
      SELECT o_custkey, o_orderstatus, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderstatus DESC) AS rn
      FROM orders) WHERE rn = 1""",
)
def latest_attribute(spark, folder):
    return latest_value(
        table(spark, folder, "orders"), "o_custkey", "o_orderstatus", "o_orderdate"
    )


@register(
    "priority_pick",
    """
    WITH arms AS (
      SELECT 1 AS rank, upper('Market ' || (c_custkey % 997)) AS mkt_desc,
             lpad(CAST(c_custkey * 1000003 AS VARCHAR), 10, '0') AS plan_to_nbr
      FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL
      SELECT 2, upper('Market ' || (s_suppkey % 997)), lpad(CAST(s_suppkey AS VARCHAR), 10, '0')
      FROM supplier
      UNION ALL
      SELECT 3, upper('Market ' || (o_custkey % 997)), lpad(CAST(o_orderkey AS VARCHAR), 10, '0')
      FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL
      SELECT 4, upper('Market ' || (c_custkey % 997)), lpad(CAST(c_nationkey AS VARCHAR), 10, '0')
      FROM customer)
    SELECT mkt_desc, plan_to_nbr FROM (
      SELECT *, row_number() OVER (
        PARTITION BY mkt_desc ORDER BY rank, plan_to_nbr NULLS LAST) AS rn FROM arms) WHERE rn = 1""",
)
def pick_by_priority(spark, folder):
    def arm(df, market, number):
        return df.select(
            F.upper(F.concat(F.lit("Market "), (F.col(market) % 997).cast("string"))).alias(
                "mkt_desc"
            ),
            F.lpad(number.cast("string"), 10, "0").alias("plan_to_nbr"),
        )

    customer = table(spark, folder, "customer")
    urgent = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    building = customer.filter("c_mktsegment = 'BUILDING'")
    return priority_pick(
        [
            arm(building, "c_custkey", F.col("c_custkey") * 1000003),
            arm(table(spark, folder, "supplier"), "s_suppkey", F.col("s_suppkey")),
            arm(urgent, "o_custkey", F.col("o_orderkey")),
            arm(customer, "c_custkey", F.col("c_nationkey")),
        ],
        "mkt_desc",
        "plan_to_nbr",
    )


@register(
    "canonical_key",
    """
    WITH markets AS (
      SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS mkt_key,
             upper('Nation ' || c_nationkey || ' ' || c_mktsegment) AS mkt_desc FROM customer),
    facts AS (
      SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS period_key,
             CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE '' END || o_custkey AS mkt_key FROM orders),
    padded AS (
      SELECT mkt_key, mkt_desc FROM markets
      UNION SELECT '0' || mkt_key, mkt_desc FROM markets),
    best AS (
      SELECT period_key, mkt_desc, CAST(max(CAST(mkt_key AS INT)) AS VARCHAR) AS mkt_key
      FROM facts JOIN padded USING (mkt_key) GROUP BY period_key, mkt_desc)
    SELECT period_key, mkt_desc, mkt_key,
           CAST(substring(period_key, 1, 4) || '-' || substring(period_key, 5, 2) || '-01' AS DATE)
             AS fisc_dt
    FROM best JOIN padded USING (mkt_key, mkt_desc)""",
)
def canonical_key(spark, folder):
    customer = table(spark, folder, "customer")
    described = F.concat(
        F.lit("Nation "), F.col("c_nationkey").cast("string"), F.lit(" "), F.col("c_mktsegment")
    ).alias("market description")
    plain = F.col("c_custkey").cast("string")
    markets = customer.select(plain.alias("market key"), described).unionByName(
        customer.select(F.concat(F.lit("0"), plain).alias("market key"), described)
    )
    orders = table(spark, folder, "orders")
    period = F.date_format("o_orderdate", "yyyyMM")
    zero = F.when(F.col("o_orderkey") % 5 == 0, "0").otherwise("")
    facts = orders.select(
        period.alias("period_key"),
        F.concat(zero, F.col("o_custkey").cast("string")).alias("mkt_key"),
    )
    month = F.date_format(F.trunc("o_orderdate", "month"), "MM/dd/yy")
    periods = orders.select(
        period.alias("period key"),
        F.concat(F.lit("Month from "), month).alias("period description"),
    ).distinct()
    return canonical_markets(facts, markets, periods)
