"""Text cleaning, product codes, hash keys."""

from pyspark.sql import functions as F

from martloom.functions.gtin import with_gtin_of_text
from martloom.functions.keys import hash_key
from martloom.functions.text import (
    blank_to_null,
    date_or_null,
    decimal_or_zero,
    digits_or_null,
    digits_or_zero,
    has_tail_date,
    tail_date,
)
from registry import register, table


@register(
    "clean_digits",
    r"""
    WITH raw AS (
      SELECT p_partkey,
             CASE p_partkey % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN ' ' || p_partkey
                  WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN p_partkey || chr(10)
                  ELSE CAST(p_partkey AS VARCHAR) END AS raw
      FROM part)
    SELECT p_partkey,
           CASE WHEN regexp_matches(trim(raw), '^[0-9]+\z') THEN CAST(trim(raw) AS INT)
                ELSE 0 END AS as_int,
           CASE WHEN regexp_matches(trim(raw), '^[0-9]+\z') THEN CAST(trim(raw) AS BIGINT)
                ELSE 0 END AS as_bigint,
           CASE WHEN regexp_matches(trim(raw), '^[0-9]+\z') THEN trim(raw) END AS as_text
    FROM raw""",
)
def clean_digits(spark, folder):
    key = F.col("p_partkey")
    text = key.cast("string")
    raw = (
        F.when(key % 7 == 0, "N/A")
        .when(key % 7 == 1, F.concat(F.lit(" "), text))
        .when(key % 7 == 2, "")
        .when(key % 7 == 3, F.lit(None))
        .when(key % 7 == 4, F.concat(text, F.lit("\n")))
        .otherwise(text)
    )
    part = table(spark, folder, "part").select("p_partkey", raw.alias("raw"))
    return part.select(
        "p_partkey",
        digits_or_zero(F.col("raw")).alias("as_int"),
        digits_or_zero(F.col("raw"), "bigint").alias("as_bigint"),
        digits_or_null(F.col("raw")).alias("as_text"),
    )


@register(
    "clean_decimal",
    r"""
    WITH raw AS (
      SELECT o_orderkey,
             CASE o_orderkey % 7 WHEN 0 THEN o_orderkey || '.' WHEN 1 THEN '1,' || o_orderkey
                  WHEN 2 THEN '-.' || (o_orderkey % 100)
                  WHEN 3 THEN ' ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' '
                  WHEN 4 THEN '+' || o_orderkey WHEN 5 THEN NULL
                  ELSE '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS raw
      FROM orders)
    SELECT o_orderkey,
           CAST(CASE WHEN regexp_matches(trim(raw), '^-?[0-9]*\.?[0-9]+\z')
                THEN CAST(trim(raw) AS DECIMAL(20,6)) ELSE 0 END AS DECIMAL(20,6)) AS amount,
           CASE WHEN regexp_matches(trim(raw), '^-?[0-9]*\.?[0-9]+\z')
                THEN CAST(trim(raw) AS DOUBLE) ELSE 0 END AS amount_double
    FROM raw""",
)
def clean_decimal(spark, folder):
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    raw = (
        F.when(key % 7 == 0, F.concat(key.cast("string"), F.lit(".")))
        .when(key % 7 == 1, F.concat(F.lit("1,"), key.cast("string")))
        .when(key % 7 == 2, F.concat(F.lit("-."), (key % 100).cast("string")))
        .when(key % 7 == 3, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(key % 7 == 4, F.concat(F.lit("+"), key.cast("string")))
        .when(key % 7 == 5, F.lit(None))
        .otherwise(F.concat(F.lit("-"), price))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.select(
        "o_orderkey",
        decimal_or_zero(F.col("raw")).alias("amount"),
        decimal_or_zero(F.col("raw"), "double").alias("amount_double"),
    )


@register(
    "blank_to_null",
    """
    WITH raw AS (
      SELECT o_orderkey,
             CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN NULL
                  WHEN 3 THEN ' ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' '
                  ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS raw
      FROM orders)
    SELECT o_orderkey,
           CASE WHEN trim(raw) <> '' THEN raw END AS kept_text,
           CASE WHEN trim(raw) <> '' THEN CAST(trim(raw) AS DATE) END AS as_date
    FROM raw""",
)
def blank_text(spark, folder):
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date").cast("string")
    raw = (
        F.when(key % 6 == 0, "")
        .when(key % 6 == 1, "  ")
        .when(key % 6 == 2, F.lit(None))
        .when(key % 6 == 3, F.concat(F.lit(" "), day, F.lit(" ")))
        .otherwise(day)
    )
    orders = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.select(
        "o_orderkey",
        blank_to_null(F.col("raw")).alias("kept_text"),
        date_or_null(F.col("raw")).alias("as_date"),
    )


@register(
    "tail_date",
    r"""
    WITH raw AS (
      SELECT o_orderkey,
             CASE o_orderkey % 10 WHEN 0 THEN 'Week Ending 02/30/20'
                  WHEN 1 THEN 'Week Ending 01/05/71 ' WHEN 2 THEN 'Week Ending 01/05/2020'
                  WHEN 3 THEN 'Week Ending 13/01/20'
                  ELSE 'Week Ending ' || strftime(o_orderdate, '%m/%d/%y') END AS raw
      FROM orders),
    tail AS (
      SELECT o_orderkey, right(trim(raw), 8) AS t FROM raw
      WHERE regexp_matches(right(trim(raw), 8), '^[0-9]{2}/[0-9]{2}/[0-9]{2}\z')),
    num AS (
      SELECT o_orderkey, CAST(substring(t, 1, 2) AS INT) AS mm, CAST(substring(t, 4, 2) AS INT) AS dd,
             CAST(substring(t, 7, 2) AS INT) AS yy FROM tail)
    SELECT o_orderkey,
           CAST(make_date(CASE WHEN yy >= 70 THEN 1900 ELSE 2000 END + yy, 1, 1)
                + to_months(mm - 1) + to_days(dd - 1) AS DATE) AS fisc_dt
    FROM num""",
)
def tail_dates(spark, folder):
    key = F.col("o_orderkey")
    raw = (
        F.when(key % 10 == 0, "Week Ending 02/30/20")
        .when(key % 10 == 1, "Week Ending 01/05/71 ")
        .when(key % 10 == 2, "Week Ending 01/05/2020")
        .when(key % 10 == 3, "Week Ending 13/01/20")
        .otherwise(F.concat(F.lit("Week Ending "), F.date_format("o_orderdate", "MM/dd/yy")))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.filter(has_tail_date(F.col("raw"))).select(
        "o_orderkey", tail_date(F.col("raw")).alias("fisc_dt")
    )


@register(
    "gtin_normalise",
    r"""
    WITH raw AS (
      SELECT p_partkey,
             CASE p_partkey % 6 WHEN 0 THEN 'UPC' || p_partkey
                  WHEN 1 THEN ' 000' || (p_partkey * 1000003)
                  WHEN 2 THEN CAST(p_partkey AS VARCHAR)
                  WHEN 3 THEN CAST(10000000000 + p_partkey AS VARCHAR)
                  WHEN 4 THEN CAST(100000000000 + p_partkey AS VARCHAR)
                  ELSE CAST(p_partkey * 1000003 AS VARCHAR) END AS upc
      FROM part),
    body AS (
      SELECT p_partkey, trim(upc) AS upc,
             CASE WHEN regexp_matches(trim(upc), '^[0-9]+\z')
                  THEN repeat('0', 11 - length(CAST(CAST(trim(upc) AS BIGINT) AS VARCHAR)))
                       || CAST(CAST(trim(upc) AS BIGINT) AS VARCHAR) END AS b
      FROM raw)
    SELECT p_partkey,
           CASE WHEN b IS NULL THEN upc WHEN length(b) <> 11 THEN b
                ELSE b || CAST((10 - (
                  3 * (b[1]::INT + b[3]::INT + b[5]::INT + b[7]::INT + b[9]::INT + b[11]::INT)
                  + b[2]::INT + b[4]::INT + b[6]::INT + b[8]::INT + b[10]::INT) % 10) % 10
                  AS VARCHAR) END AS gtin
    FROM body""",
)
def gtin_normalise(spark, folder):
    key = F.col("p_partkey")
    upc = (
        F.when(key % 6 == 0, F.concat(F.lit("UPC"), key.cast("string")))
        .when(key % 6 == 1, F.concat(F.lit(" 000"), (key * 1000003).cast("string")))
        .when(key % 6 == 2, key.cast("string"))
        .when(key % 6 == 3, (key + 10000000000).cast("string"))
        .when(key % 6 == 4, (key + 100000000000).cast("string"))
        .otherwise((key * 1000003).cast("string"))
    )
    part = table(spark, folder, "part").select("p_partkey", upc.alias("upc"))
    return with_gtin_of_text(part, F.col("upc"), "gtin").select("p_partkey", "gtin")


@register(
    "hash_key",
    """
    SELECT o_orderkey,
           md5(o_orderstatus || o_custkey || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
               || CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END) AS hash_key
    FROM orders""",
)
def hash_keys(spark, folder):
    priority = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        hash_key(
            "o_orderstatus", "o_custkey", F.col("o_orderdate").cast("date"), priority
        ).alias("hash_key"),
    )
