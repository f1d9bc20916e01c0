"""Column profiles: the CSV that describes tables to be synthesised."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the columns of a profile file, by position.
PROFILE_SCHEMA = """
    schema string, table string, column string, cardinality string,
    table_rows string, type string, length string, precision string, nulls string
"""


@dataclass(frozen=True)
class ColumnProfile:
    """One line of a profile; ``ordinal`` counts the lines after the header."""

    ordinal: int
    schema: str
    table: str
    column: str
    cardinality: str
    table_rows: str
    type: str
    length: str
    precision: str
    nulls: str


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """A profile file as text columns; the null count may be missing."""
    return (
        spark.read.schema(PROFILE_SCHEMA)
        .option("header", True)
        .option("quote", '"')
        .csv(path)
    )


def profile_lines(profile: DataFrame) -> list[ColumnProfile]:
    """The profile on the driver: one line per column of the described tables."""
    names = [f.name for f in profile.schema.fields]
    return [
        ColumnProfile(i, *[(row[n] or "").strip() for n in names])
        for i, row in enumerate(profile.collect(), start=1)
    ]
