"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def own(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def whole_text(text: Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(text, F.lit(""))


#: Rows that a worker takes up at once of a batch, however large the batches are.
TAKEN = 1024


def sliced(batches: Iterator[pa.RecordBatch], rows: int = TAKEN) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows at most, which bounds what is made of them at once."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


_lasting: list = []


def lasting(make: Callable) -> Callable:
    """Keep what ``make`` returns for the tasks that a worker runs later, until ``let_go``."""
    kept = functools.lru_cache(maxsize=2)(make)
    _lasting.append(kept)
    return kept


def let_go() -> None:
    """Drop what a worker keeps of other operators' tasks, such as the tables of an encoder."""
    for kept in _lasting:
        kept.cache_clear()
    pa.default_memory_pool().release_unused()
