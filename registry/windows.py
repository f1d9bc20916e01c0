"""Load windows and high-water marks."""

from datetime import timedelta

from pyspark.sql import functions as F

from martloom.operators.load_window import (
    check_window,
    global_high_water,
    in_closed_window,
    in_half_open_window,
    lookback_high_water,
    slowest_source_high_water,
    window_has_rows,
)
from registry import register, table

# Bounds that lie exactly on a row.
BOUNDS_SQL = """
    bounds AS (SELECT min(ts) FILTER (event_id = 100) AS a, min(ts) FILTER (event_id = 700) AS b
               FROM events)"""


def _bounds(events):
    on_row = events.filter(F.col("event_id").isin(100, 700)).agg(
        F.min("ts").alias("a"), F.max("ts").alias("b")
    )
    return on_row.first()


@register(
    "window_closed",
    f"WITH {BOUNDS_SQL} SELECT event_id, ts FROM events, bounds WHERE ts BETWEEN a AND b",
)
def window_closed(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    a, b = _bounds(events)
    return in_closed_window(events, "ts", a, b)


@register(
    "window_half_open",
    f"WITH {BOUNDS_SQL} SELECT event_id, ts FROM events, bounds WHERE ts > a AND ts <= b",
)
def window_half_open(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    a, b = _bounds(events)
    return in_half_open_window(events, "ts", a, b)


@register(
    "high_water_global",
    "SELECT coalesce(max(ts), TIMESTAMP '1900-01-01 00:00:00') AS start_ts FROM events",
)
def high_water_global(spark, folder):
    return global_high_water(table(spark, folder, "events"), "ts")


@register(
    "high_water_slowest_source",
    """
    SELECT coalesce(min(latest), TIMESTAMP '1900-01-01 00:00:00') AS start_ts
    FROM (SELECT event_type, max(ts) AS latest FROM events
          WHERE event_type <> 'error' OR ts < TIMESTAMP '2024-01-20 00:00:00'
          GROUP BY event_type)""",
)
def high_water_slowest_source(spark, folder):
    lagging = table(spark, folder, "events").filter(
        "event_type <> 'error' OR ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'"
    )
    return slowest_source_high_water(lagging, "event_type", "ts")


@register(
    "high_water_lookback",
    """
    SELECT coalesce(max(ts) - INTERVAL 7 DAY, TIMESTAMP '1990-01-01 00:00:00') AS start_ts
    FROM events""",
)
def high_water_lookback(spark, folder):
    return lookback_high_water(table(spark, folder, "events"), "ts")


@register(
    "high_water_empty",
    """
    SELECT coalesce(max(ts), TIMESTAMP '1900-01-01 00:00:00') AS start_ts
    FROM events WHERE event_type = 'unheard of'""",
)
def high_water_empty(spark, folder):
    none = table(spark, folder, "events").filter("event_type = 'unheard of'")
    return global_high_water(none, "ts")


def _told(check, *args):
    try:
        check(*args)
    except ValueError as error:
        return str(error)
    return ""


@register(
    "window_validation",
    f"""
    WITH {BOUNDS_SQL}, edges AS (SELECT a, b, (SELECT max(ts) FROM events) AS z FROM bounds),
    windows(window_nbr, starts, ends) AS (
      SELECT unnest([1, 2, 3, 4]), unnest([least(a, b), z, greatest(a, b), a]),
             unnest([greatest(a, b), z + INTERVAL 1 DAY, least(a, b), a]) FROM edges)
    SELECT window_nbr, if(starts > ends, 'window start ' || strftime(starts, '%Y-%m-%d %H:%M:%S.%f')
             || ' is after its end ' || strftime(ends, '%Y-%m-%d %H:%M:%S.%f'), '') AS error,
           starts <= ends AND EXISTS (FROM events WHERE ts > starts AND ts <= ends) AS has_rows
    FROM windows""",
)
def window_validation(spark, folder):
    """The error of a window whose start is after its end, and whether a window has rows."""
    events = table(spark, folder, "events").select("event_id", "ts")
    bounds, last = sorted(_bounds(events)), events.agg(F.max("ts")).first()[0]
    a = _bounds(events)[0]
    windows = [bounds, (last, last + timedelta(days=1)), bounds[::-1], (a, a)]
    rows = []
    for number, window in enumerate(windows, 1):
        error = _told(check_window, *window)
        some = not error and window_has_rows(in_half_open_window(events, "ts", *window))
        rows.append((number, error, some))
    return spark.createDataFrame(rows, "window_nbr int, error string, has_rows boolean")
