"""Mart mutations as pure functions: (snapshot, delta) -> new snapshot.

Rows whose key holds a NULL never match, so they stay, and a delta row with a NULL
key part is added again on every run.  Such rows may pile up; ``_spread`` gives
them a salt of their own so that they do not meet in one shuffle partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, functions as F

from martloom.operators.load_window import ntz_literal

SALTS = 1024


def _spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for rows with a full key, a row-dependent salt for those without."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    return F.when(any_null, F.pmod(row, F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))


def spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """A hash of the key, or of the whole row where a part of the key is NULL."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    return F.when(any_null, row).otherwise(F.xxhash64(*[F.col(k) for k in keys]))


def update_insert(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    as_of: datetime,
    created: str | None = None,
    updated: str | None = None,
    computed: Mapping[str, Column] = MappingProxyType({}),
) -> DataFrame:
    """Update ``update_cols`` of matching rows, add the delta rows that match none.

    The delta holds one row per key.  Columns outside ``update_cols`` keep the
    target's values on a match, even when the delta has newer ones.  ``updated`` is
    stamped on a match, both stamps on a new row.

    Matches are a left join and new rows an anti join, not one full outer join, which
    would always shuffle the target: give the delta as a written table, and a small one
    is broadcast.  The target is read a second time for its keys alone, and takes no more of
    the delta's columns than it updates.  ``computed`` columns, of new rows only, needn't be in
    the delta: they are made of the others once it is known which rows are new.
    """
    stamp = ntz_literal(as_of)
    places = range(len(keys))
    new = delta.select(
        F.struct(*update_cols).alias("new"), *[F.col(k).alias(f"_d{i}") for i, k in enumerate(keys)]
    )
    full = new.dropna(subset=[f"_d{i}" for i in places]).withColumn("_ds", F.lit(0).cast("bigint"))
    salted = target.withColumn("_ts", _spread(target, keys))
    same = [F.col(k) == F.col(f"_d{i}") for i, k in enumerate(keys)]
    joined = salted.join(full, [*same, F.col("_ts") == F.col("_ds")], "left")
    in_delta = F.col("new").isNotNull()

    def kept(name: str) -> Column:
        if name == updated:
            return F.when(in_delta, stamp).otherwise(F.col(name))
        if name in update_cols:
            return F.when(in_delta, F.col("new")[name]).otherwise(F.col(name))
        return F.col(name)

    def added(name: str) -> Column:
        if name in computed:
            return computed[name]
        return stamp if name in (created, updated) else F.col(name)

    fresh = without_keys(delta, target.select(*keys).join(
        full.select(*[F.col(f"_d{i}").alias(k) for i, k in enumerate(keys)]), list(keys), "left_semi"
    ), keys)
    return joined.select(*[kept(c).alias(c) for c in target.columns]).unionByName(
        fresh.select(*[added(c).alias(c) for c in target.columns])
    )


def without_keys(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key does not occur in the delta; NULL keys never do."""
    listed = delta.select(
        *[F.col(k).alias(f"_d{i}") for i, k in enumerate(keys)]
    ).dropna().withColumn("_ds", F.lit(0).cast("bigint"))
    salted = target.withColumn("_ts", _spread(target, keys))
    condition = [F.col(k) == F.col(f"_d{i}") for i, k in enumerate(keys)]
    kept = salted.join(listed, [*condition, F.col("_ts") == F.col("_ds")], "left_anti")
    return kept.drop("_ts")


def replace_by_key(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows whose key is in the delta, add the delta.

    The delta is read twice, its keys and its rows: give it as a written table.  Its
    size is then known too, and a small one is broadcast instead of shuffling the mart.
    """
    return without_keys(target, delta, keys).unionByName(delta.select(*target.columns))


def outside_window(target: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """Delete rows with ``start < ts <= end``; rows without a time stay."""
    inside = (F.col(ts) > ntz_literal(start)) & (F.col(ts) <= ntz_literal(end))
    return target.filter(~F.coalesce(inside, F.lit(False)))


def replace_window(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: datetime,
    end: datetime,
) -> DataFrame:
    """Delete the window and the delta's keys from the target, add the delta."""
    return replace_by_key(outside_window(target, ts, start, end), delta, keys)


def refresh_attribute(
    target: DataFrame, dim: DataFrame, key: str, column: str
) -> DataFrame:
    """Overwrite ``column`` wherever ``key`` is in the dimension, even with NULL.

    Rows without a match keep their value.  The dimension has one row per key.
    """
    values = dim.select(
        F.col(key).alias("_key"), F.col(column).alias("_value"), F.lit(True).alias("_hit")
    )
    joined = target.join(values, F.col(key) == F.col("_key"), "left")
    fresh = F.when(F.col("_hit"), F.col("_value")).otherwise(F.col(column))
    return joined.withColumn(column, fresh).select(*target.columns)
