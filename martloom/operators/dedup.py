"""Keeping one row, or one value, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_wins(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the latest ``order`` per key; NULL keys form a group of their own.

    A NULL ``order`` counts as latest.  Equal times are settled by ``tiebreak``
    (by default every other column, ascending, NULL last), so the result does not
    depend on partitioning.  The planner keeps one row per key on the map side,
    hence a hot key sends at most one row per task through the shuffle.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c != order]
    ranking = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        F.col(f"`{order}`").desc_nulls_first(),
        *[F.col(f"`{c}`").asc_nulls_last() for c in tiebreak],
    )
    return df.withColumn("_rn", F.row_number().over(ranking)).filter("_rn = 1").drop("_rn")


def latest_value(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The newest ``value`` per key; at equal times the greatest value.

    A NULL ``order`` counts as newest.
    """
    newest = F.max(F.struct(F.col(order).isNull(), F.col(order), F.col(value).alias("v")))
    return df.groupBy(key).agg(newest["v"].alias(value))


def priority_pick(arms: Sequence[DataFrame], key: str, value: str) -> DataFrame:
    """One value per key from the first arm that has the key.

    Within an arm the smallest value wins, NULL last.  The minimum is combined on
    the map side, so neither a distinct per arm nor a window is needed.
    """
    ranked = None
    for rank, arm in enumerate(arms, start=1):
        tagged = arm.select(
            F.col(key),
            F.struct(
                F.lit(rank).alias("rank"),
                F.col(value).isNull().alias("missing"),
                F.col(value).alias("v"),
            ).alias("candidate"),
        )
        ranked = tagged if ranked is None else ranked.unionByName(tagged)
    return ranked.groupBy(key).agg(F.min("candidate")["v"].alias(value))


def earliest_all(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All distinct rows that share the earliest ``order`` of their key.

    Rows with a NULL key or a NULL order column are dropped, as an equality join
    on them would.  The distinct comes first: copies collapse on the map side and
    spread over all columns, so a hot group of copies never meets in one task.
    """
    present = df.dropna(subset=[*keys, *order]).distinct()
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return (
        present.withColumn("_rank", F.rank().over(ranking)).filter("_rank = 1").drop("_rank")
    )
