"""Load windows: which staging rows a run reads, and where it starts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

# The start that means "not given", and the first look-back start.
UNSET_START = datetime(1900, 1, 1)
LOOKBACK_FLOOR = datetime(1990, 1, 1)
LOOKBACK_DAYS = 7


def ntz_literal(moment: datetime):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_closed_window(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= ts <= end``; rows on the bounds are read again next run."""
    return df.filter(F.col(ts).between(ntz_literal(start), ntz_literal(end)))


def in_half_open_window(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start < ts <= end``."""
    return df.filter((F.col(ts) > ntz_literal(start)) & (F.col(ts) <= ntz_literal(end)))


def global_high_water(target: DataFrame, ts: str, floor: datetime = UNSET_START) -> DataFrame:
    """One row ``start_ts``: the latest load of the whole mart."""
    return target.agg(F.coalesce(F.max(ts), ntz_literal(floor)).alias("start_ts"))


def slowest_source_high_water(
    target: DataFrame, source: str, ts: str, floor: datetime = UNSET_START
) -> DataFrame:
    """One row ``start_ts``: the latest load of the source that lags most."""
    latest = target.groupBy(source).agg(F.max(ts).alias("latest"))
    return latest.agg(F.coalesce(F.min("latest"), ntz_literal(floor)).alias("start_ts"))


def lookback_high_water(
    target: DataFrame,
    ts: str,
    days: int = LOOKBACK_DAYS,
    floor: datetime = LOOKBACK_FLOOR,
) -> DataFrame:
    """One row ``start_ts``: some days before the latest load, for late arrivals."""
    back = F.max(ts) - F.expr(f"INTERVAL {days} DAYS")
    return target.agg(F.coalesce(back, ntz_literal(floor)).alias("start_ts"))


def start_of(high_water: DataFrame) -> datetime:
    """The single value of a high-water frame."""
    return high_water.first()["start_ts"]


def check_window(start: datetime, end: datetime) -> None:
    if start > end:
        raise ValueError(f"window start {start} is after its end {end}")


def window_has_rows(windowed: DataFrame) -> bool:
    """Whether a window holds any row; a load with none goes on all the same."""
    return not windowed.isEmpty()
