"""Synthetic tables from column profiles.

Every draw is an MD5 of the row number and the column's seed.  It does not depend on
partitioning, so a lost task or another cluster size gives the same rows, and any database
can draw the same.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.sources.profile_csv import ColumnProfile

# First seed, distance of the null seeds, and the filler of short
# texts, in which an i stands where a j belongs.
FIRST_SEED = 10000
NULL_SEED_STEP = 10000
FILLER = "abcdefghifklmnopqrstuvwxyz"
PER_MILLE = 1000


def number_of(text: Column) -> Column:
    """A whole number below 2^60 from the digest of a text."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def draw(seed: int, high: int) -> Column:
    """A whole number from 1 to ``high``, fixed by row and seed."""
    row = F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed)))
    return number_of(row) % F.lit(high).cast("bigint") + 1


def _is_key(line: ColumnProfile) -> bool:
    return line.cardinality == line.table_rows


def _number(line: ColumnProfile, seed: int) -> Column:
    return F.col("id") + 1 if _is_key(line) else draw(seed, int(line.cardinality))


def _date(line: ColumnProfile, seed: int, as_of: date) -> Column:
    return F.date_add(F.lit(as_of), draw(seed, int(line.cardinality)).cast("int"))


def _timestamp(line: ColumnProfile, seed: int, as_of: date) -> Column:
    midnight = F.lit(as_of).cast("timestamp_ntz")
    seconds = F.make_dt_interval(secs=draw(seed, int(line.cardinality)).cast("decimal(18,6)"))
    return midnight + seconds


def _char(line: ColumnProfile, seed: int, as_of: date) -> Column:
    return F.rpad(_number(line, seed).cast("string"), int(line.length), FILLER)


def _varchar(line: ColumnProfile, seed: int, as_of: date) -> Column:
    shortest = int(line.precision or 1)
    longest = int(line.length)
    word = draw(seed, int(line.cardinality))
    letters = F.sha2(F.concat_ws(":", word.cast("string"), F.lit(str(seed))), 256)
    length = number_of(letters) % F.lit(longest - shortest + 1).cast("bigint") + shortest
    repeats = -(-longest // 64)
    return F.substring(F.repeat(letters, F.lit(repeats)), F.lit(1), length.cast("int"))


def _boolean(line: ColumnProfile, seed: int, as_of: date) -> Column:
    return (draw(seed, min(int(line.cardinality), 2)) - 1).cast("boolean")


def _cast_number(to: str) -> Callable[[ColumnProfile, int, date], Column]:
    return lambda line, seed, as_of: draw(seed, int(line.cardinality)).cast(to)


def _bigint(line: ColumnProfile, seed: int, as_of: date) -> Column:
    return _number(line, seed)


MAKERS: dict[str, Callable[[ColumnProfile, int, date], Column]] = {
    "DATE": _date,
    "TIMESTAMP": _timestamp,
    "CHAR": _char,
    "VARCHAR": _varchar,
    "BIGINT": _bigint,
    "BOOLEAN": _boolean,
    "INTEGER": _cast_number("int"),
    "DOUBLE": _cast_number("double"),
    "FLOAT": _cast_number("double"),
}
SPARK_TYPES = {
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "CHAR": "string",
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "double",
}


def column_expression(line: ColumnProfile, as_of: date) -> Column | None:
    """The generator of one profiled column; None, with a warning, for unknown types."""
    kind = line.type.upper()
    seed = FIRST_SEED + line.ordinal
    if kind == "NUMBER":
        spark_type = f"decimal({line.length},{line.precision})"
        make = _cast_number(spark_type)
    elif kind in MAKERS:
        spark_type, make = SPARK_TYPES[kind], MAKERS[kind]
    else:
        if line.schema or line.type:
            warnings.warn(f"line {line.ordinal}: unknown type {line.type!r}", stacklevel=2)
        return None
    if int(line.cardinality) <= 0:
        return F.lit(None).cast(spark_type).alias(line.column)
    value = make(line, seed, as_of)
    if line.nulls:
        per_mille = int(float(line.nulls) / float(line.table_rows) * PER_MILLE)
        if per_mille > 0:
            value = F.when(draw(seed + NULL_SEED_STEP, PER_MILLE) > per_mille, value)
    return value.alias(line.column)


def synthetic_tables(
    spark: SparkSession, lines: Iterable[ColumnProfile], as_of: date
) -> dict[tuple[str, str], DataFrame]:
    """One frame per (schema, table), in file order.

    The row count is that of the table's last column.
    """
    columns: dict[tuple[str, str], list[Column]] = {}
    rows: dict[tuple[str, str], int] = {}
    for line in lines:
        expression = column_expression(line, as_of)
        if expression is None:
            continue
        table = (line.schema, line.table)
        columns.setdefault(table, []).append(expression)
        rows[table] = int(line.table_rows)
    return {t: spark.range(rows[t]).select(*exprs) for t, exprs in columns.items()}


def write_synthetic_tables(tables: dict[tuple[str, str], DataFrame], folder: str) -> None:
    """Replace ``folder/schema/table``, one write per table."""
    for (schema, table), df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{schema}/{table}")
