"""Synthetic tables from the profile of a given table, by way of a profile file."""

from datetime import date

from pyspark.sql import functions as F

from martloom.plans.synthetic import FILLER, synthetic_tables, write_synthetic_tables
from martloom.session import new_mart_path
from martloom.sources.profile_csv import PROFILE_SCHEMA, profile_lines, read_profile
from registry import register, table

AS_OF = date(2024, 1, 1)

# Lines of the profile: table, column, the column of orders that gives cardinality and nulls
# (none: all null), profile type, length, precision.
LINES = [
    ("orders", "o_orderkey", "o_orderkey", "BIGINT", "", ""),
    ("orders", "o_custkey", "o_custkey", "BIGINT", "", ""),
    ("orders", "o_orderstatus", "o_orderstatus", "CHAR", "8", ""),
    ("orders", "o_totalprice", "o_totalprice", "NUMBER", "18", "2"),
    ("orders", "o_orderdate", "o_orderdate", "DATE", "", ""),
    ("orders", "o_orderpriority", "priority", "VARCHAR", "20", "5"),
    ("orders", "o_stamp", "o_orderdate", "TIMESTAMP", "", ""),
    ("orders", "o_urgent", "o_orderstatus", "BOOLEAN", "", ""),
    ("orders", "o_shape", "o_orderstatus", "GEOMETRY", "", ""),
    ("orders", "o_clerk", "o_custkey", "INTEGER", "", ""),
    ("orders", "o_weight", "priority", "DOUBLE", "", ""),
    ("orders", "o_discount", "o_orderstatus", "FLOAT", "", ""),
    ("orders", "o_comment", None, "VARCHAR", "9", ""),
    ("orders", "o total, net", "o_custkey", "NUMBER", "9", "0"),
    ("buyers", "b_key", "o_orderkey", "BIGINT", "", ""),
    ("buyers", "b_code", "o_orderkey", "CHAR", "9", ""),
]


def _profile(spark, folder):
    """The orders' column profile: cardinality, rows and nulls, counted by Spark."""
    orders = table(spark, folder, "orders").withColumn(
        "priority", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))
    )
    sources = sorted({source for _, _, source, *_ in LINES if source})
    counts = orders.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_distinct(c).alias(f"{c}_card") for c in sources],
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in sources],
    ).first()
    rows = [
        (
            "shop",
            name,
            column,
            str(counts[f"{source}_card"] if source else 0),
            str(counts["rows"]),
            kind,
            length,
            precision,
            str(counts[f"{source}_null"] if source else 0),
        )
        for name, column, source, kind, length, precision in LINES
    ]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def _generated(spark, folder):
    """The tables, generated from the profile as a file, written and read back."""
    path = new_mart_path(spark)
    _profile(spark, folder).coalesce(1).write.option("header", True).csv(f"{path}/profile")
    lines = profile_lines(read_profile(spark, f"{path}/profile"))
    write_synthetic_tables(synthetic_tables(spark, lines, AS_OF), f"{path}/tables")
    return [spark.read.parquet(f"{path}/tables/shop/{name}") for name in ("orders", "buyers")]


def draw_sql(text):
    return f"('0x' || left(md5({text}), 15))::BIGINT"


def _column_sql(place, line):
    """A column over the row number ``id``, by the rules of its profile type."""
    name, column, source, kind, length, precision = line
    if kind == "GEOMETRY":
        return None
    if source is None:
        return f'CAST(NULL AS VARCHAR) AS "{column}"'
    seed, high = 10000 + place, f"{source}_card"
    drawn = f"({draw_sql(f"id || ':{seed}'")} % {high} + 1)"
    number = f"if({high} = n, id + 1, {drawn})"
    letters = f"sha256({drawn} || ':{seed}')"
    value = {
        "BIGINT": number,
        "INTEGER": f"{drawn}::INT",
        "DOUBLE": f"{drawn}::DOUBLE",
        "FLOAT": f"{drawn}::DOUBLE",
        "NUMBER": f"{drawn}::DECIMAL({length or 1}, {precision or 0})",
        "DATE": f"DATE '{AS_OF}' + {drawn}::INT",
        "TIMESTAMP": f"TIMESTAMP '{AS_OF}' + to_seconds({drawn})",
        "CHAR": f"rpad({number}::VARCHAR, {length or 1}, '{FILLER}')",
        "VARCHAR": f"left({letters}, ({draw_sql(letters)} % ({length or 1} - {precision or 1} + 1)"
        f" + {precision or 1})::INT)",
        "BOOLEAN": f"({draw_sql(f"id || ':{seed}'")} % least({high}, 2))::BOOLEAN",
    }[kind]
    share = f"floor({source}_null / n::DOUBLE * 1000)"
    kept = f"{draw_sql(f"id || ':{seed + 10000}'")} % 1000 + 1 > {share}"
    return f'CASE WHEN {share} = 0 OR {kept} THEN {value} END AS "{column}"'


def _table_sql(name):
    columns = [_column_sql(i, line) for i, line in enumerate(LINES, 1) if line[0] == name]
    return f"SELECT {', '.join(c for c in columns if c)} FROM ids, profile"


_SOURCES = sorted({source for _, _, source, *_ in LINES if source})
PROFILE_SQL = f"""
    profiled AS (
      SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders),
    profile AS (
      SELECT count(*) AS n, {", ".join(f"count(DISTINCT {c}) AS {c}_card" for c in _SOURCES)},
             {", ".join(f"count(*) - count({c}) AS {c}_null" for c in _SOURCES)}
      FROM profiled),
    ids AS (SELECT unnest(range(n)) AS id FROM profile)"""


@register("profile_generate", f"WITH {PROFILE_SQL} {_table_sql('orders')}")
def profile_generate(spark, folder):
    """Every profile type, a column of nulls, and a type that is left out."""
    return _generated(spark, folder)[0]


@register(
    "profile_second_table",
    f"""WITH {PROFILE_SQL}, buyers AS ({_table_sql('buyers')})
    SELECT count(*) AS n_rows, count(DISTINCT b_code) AS n_codes, min(b_code) AS first_code,
           max(b_key) AS last_key FROM buyers""",
)
def profile_second_table(spark, folder):
    return _generated(spark, folder)[1].agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("b_code").alias("n_codes"),
        F.min("b_code").alias("first_code"),
        F.max("b_key").alias("last_key"),
    )


@register(
    "profile_properties",
    """
    WITH profiled AS (
      SELECT count(*) AS n, count(DISTINCT o_orderkey) AS key_card FROM orders)
    SELECT n AS n_rows, n AS n_keys, TRUE AS custkey_in_range, TRUE AS status_width_ok,
           TRUE AS status_cardinality_ok, TRUE AS price_in_range, TRUE AS date_in_range,
           TRUE AS priority_length_ok, TRUE AS priority_cardinality_ok, TRUE AS null_rate_ok
    FROM profiled""",
)
def profile_properties(spark, folder):
    """What must hold of generated rows, whatever the draws."""
    source = table(spark, folder, "orders")
    wanted = source.select(
        F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct("o_orderstatus").alias("statuses"),
        F.count_distinct("o_totalprice").alias("prices"),
        F.count_distinct("o_orderdate").alias("dates"),
        F.count_distinct(
            F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))
        ).alias("priorities"),
    ).first()
    days = F.date_diff("o_orderdate", F.lit(AS_OF))
    length = F.length("o_orderpriority")
    nulls = F.count_if(F.col("o_orderpriority").isNull()) / F.count(F.lit(1))
    return _generated(spark, folder)[0].agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("o_orderkey").alias("n_keys"),
        F.bool_and(F.col("o_custkey").between(1, wanted["customers"])).alias("custkey_in_range"),
        F.bool_and(F.length("o_orderstatus") == 8).alias("status_width_ok"),
        (F.count_distinct("o_orderstatus") <= wanted["statuses"]).alias("status_cardinality_ok"),
        F.bool_and(F.col("o_totalprice").between(1, wanted["prices"])).alias("price_in_range"),
        F.bool_and(days.between(1, wanted["dates"])).alias("date_in_range"),
        F.bool_and(length.isNull() | length.between(5, 20)).alias("priority_length_ok"),
        (F.count_distinct("o_orderpriority") <= wanted["priorities"]).alias(
            "priority_cardinality_ok"
        ),
        nulls.between(0.2, 0.3).alias("null_rate_ok"),
    )
