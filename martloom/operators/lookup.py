"""Enriching facts from dimensions.

Joins carry no hints: the planner broadcasts a dimension only when its size is
below ``spark.sql.autoBroadcastJoinThreshold``, adaptive execution checks the size
again at run time, and beyond it skewed partitions of a sort-merge join are split.
The unique lookup is the exception: the size of its dimension is guessed from files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def left_lookup(
    facts: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], values: Sequence[str]
) -> DataFrame:
    """Left join on (fact column, dimension column) pairs, adding ``values``."""
    renamed = dim.select(
        *[F.col(d).alias(f"_k{i}") for i, (_, d) in enumerate(on)], *values
    )
    condition = [F.col(f) == F.col(f"_k{i}") for i, (f, _) in enumerate(on)]
    return facts.join(renamed, condition, "left").drop(*[f"_k{i}" for i in range(len(on))])


def flag_member(facts: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """Add a boolean: does ``key`` occur in the list?  NULL keys never do."""
    listed = members.select(F.col(key).alias("_member")).filter("_member IS NOT NULL").distinct()
    marked = listed.withColumn(flag, F.lit(True))
    joined = facts.join(marked, F.col(key) == F.col("_member"), "left").drop("_member")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def in_list(facts: DataFrame, members: DataFrame, fact_key: str, member_key: str) -> DataFrame:
    """Facts whose key occurs in the list."""
    listed = members.select(F.col(member_key).alias("_member"))
    return facts.join(listed, F.col(fact_key) == F.col("_member"), "left_semi")


def not_in_list(
    facts: DataFrame, members: DataFrame, fact_key: str, member_key: str
) -> DataFrame:
    """SQL ``NOT IN``: nothing if the list holds a NULL, everything if it is empty.

    Written as a plain anti join plus two list-wide facts, because the planner
    always broadcasts the list of a literal NOT IN, whatever its size.
    """
    listed = members.select(F.col(member_key).alias("_member"))
    shape = listed.agg(
        F.count(F.lit(1)).alias("n"), F.count("_member").alias("n_present")
    )
    is_empty = shape.select(F.col("n") == 0).scalar()
    no_null = shape.select(F.col("n") == F.col("n_present")).scalar()
    kept = facts.join(listed, F.col(fact_key) == F.col("_member"), "left_anti")
    return kept.filter(no_null & (F.col(fact_key).isNotNull() | is_empty))


def calendar_days(calendar: DataFrame, first: str, last: str, day: str) -> DataFrame:
    """One row per day of every calendar interval, closed at both ends."""
    valid = calendar.filter(F.col(first) <= F.col(last))
    return valid.withColumn(day, F.explode(F.sequence(F.col(first), F.col(last))))


def calendar_lookup(
    facts: DataFrame,
    calendar: DataFrame,
    fact_day: str,
    first: str,
    last: str,
    values: Sequence[str],
) -> DataFrame:
    """Left range join of a date into closed intervals, as an equality join on days.

    Overlapping intervals fan out, a date outside all of them gets NULLs.
    """
    days = calendar_days(calendar, first, last, "_day").select("_day", *values)
    return facts.join(days, F.col(fact_day) == F.col("_day"), "left").drop("_day")


# Partitions of either side of an interval lookup while its keys are made.
KEY_PARTITIONS = 32

# Fixed value: hexadecimal digits in text order.
HEX = "0123456789ABCDEF"


def point_keys(value: Column) -> Column:
    """Keys under which a text value can be found by ``interval_keys``.

    ``E`` + the value itself, and ``P`` + every prefix of it; over the hexadecimal
    bytes, whose order is the order of the text.
    """
    code = F.hex(value)
    return F.transform(
        F.sequence(F.lit(0), F.length(code)),
        lambda n: F.when(n == 0, F.concat(F.lit("E"), code)).otherwise(
            F.concat(F.lit("P"), F.substring(code, F.lit(1), n))
        ),
    )


def _steps(first: Column, last: Column) -> Column:
    """first..last as an array, empty when first > last."""
    none = F.array().cast("array<int>")
    return F.when(first <= last, F.sequence(first, last)).otherwise(none)


def _siblings(stem: Column, first: Column, last: Column) -> Column:
    """Prefix keys stem + one digit, for hexadecimal digits number first..last."""
    return F.transform(
        _steps(first, last),
        lambda d: F.concat(F.lit("P"), stem, F.substring(F.lit(HEX), d, F.lit(1))),
    )


def interval_keys(low: Column, high: Column) -> Column:
    """Disjoint keys that cover exactly the text values with low <= value <= high.

    The interval is cut into prefix blocks, as a trie would: below the point where
    the bounds part, all digits above the lower bound's and below the upper
    bound's.  A value meets an interval in at most one key, so an equality join on
    keys is the range join, with no residual test and no pair that is dropped
    again.  An inverted or NULL interval has no keys.
    """
    a, b = F.hex(low), F.hex(high)
    len_a, len_b = F.length(a), F.length(b)
    shorter = F.least(len_a, len_b)
    common = F.size(
        F.filter(
            _steps(F.lit(1), shorter),
            lambda n: F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n),
        )
    )

    def digit(code: Column, place: Column) -> Column:
        return F.instr(F.lit(HEX), F.substring(code, place, F.lit(1)))

    contains_low = common == len_a
    part = common + 1
    # Below the parting place, along the lower bound: digits above its own.
    above = F.flatten(
        F.transform(
            _steps(part + 1, len_a),
            lambda n: _siblings(F.substring(a, F.lit(1), n - 1), digit(a, n) + 1, F.lit(16)),
        )
    )
    # Along the upper bound: digits below its own, and the bound's own prefixes.
    first_upper = F.when(contains_low, part).otherwise(part + 1)
    below = F.flatten(
        F.transform(
            _steps(first_upper, len_b),
            lambda n: _siblings(F.substring(b, F.lit(1), n - 1), F.lit(1), digit(b, n) - 1),
        )
    )
    stops = F.transform(
        _steps(F.when(contains_low, len_a).otherwise(part), len_b),
        lambda n: F.concat(F.lit("E"), F.substring(b, F.lit(1), n)),
    )
    middle = _siblings(F.substring(a, F.lit(1), common), digit(a, part) + 1, digit(b, part) - 1)
    from_low = F.array(F.concat(F.lit("P"), a))
    parted = F.concat(from_low, above, middle, below, stops)
    nested = F.concat(below, stops)
    return F.when(a <= b, F.when(contains_low, nested).otherwise(parted))


def interval_lookup(
    members: DataFrame,
    intervals: DataFrame,
    areas: Sequence[str],
    value: str,
    sign: str = "valsign",
    option: str = "valoption",
    low: str = "valfrom",
    high: str = "valto",
) -> DataFrame:
    """Inner join of members to the including intervals that hold their value.

    ``EQ`` intervals hold one value, ``BT`` intervals a closed text range; any
    other sign or option holds nothing.  ``areas`` are equality columns that both
    sides share; interval columns come first in the result.

    A value makes a key for each hexadecimal digit, so both sides are spread over tasks before
    their keys are made: a small file would be one task's work.
    """
    keys = F.when(
        F.col(option) == "EQ", F.array(F.concat(F.lit("E"), F.hex(F.col(low))))
    ).when(F.col(option) == "BT", interval_keys(F.col(low), F.col(high)))
    listed = intervals.filter((F.col(sign) == "I") & F.col(option).isin("EQ", "BT"))
    cut = listed.repartition(KEY_PARTITIONS).withColumn("_key", F.explode(keys))
    probes = members.repartition(KEY_PARTITIONS).withColumn(
        "_key", F.explode(point_keys(F.col(value)))
    )
    return cut.join(probes, [*areas, "_key"], "inner").drop("_key")


# Partitions of the rows of a unique lookup.
LOOKUP_PARTITIONS = 128


def unique_rows(dim: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key with ``value`` and ``_copies``, the number of rows behind it.

    Keys hardly repeat, so to combine rows before the shuffle would only hold all keys of a
    task's input in memory.  The rows are shuffled first, into a number of partitions that
    isn't lowered at run time.  Keys with a NULL match nothing and are left out.
    """
    spread = dim.select(*keys, value).dropna(subset=list(keys)).repartition(LOOKUP_PARTITIONS, *keys)
    return spread.groupBy(*keys).agg(F.min(value).alias(value), F.count(F.lit(1)).alias("_copies"))


def single_value(value: Column, copies: Column, what: str) -> Column:
    """A scalar lookup's value: an error when more than one row matched."""
    message = F.lit(f"more than one row matches the lookup of {what}")
    return F.when(copies > 1, F.raise_error(message)).otherwise(value)


def unique_lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    value: str,
    alias: str,
) -> DataFrame:
    """Scalar lookup: no match gives NULL, several matches raise instead of fanning out.

    A dimension whose rows are made from few small files, by an explode for one, is far larger
    than the planner takes it for, and a planned broadcast isn't taken back at run time; so both
    sides are sorted and merged.
    """
    packed = unique_rows(dim, [d for _, d in on], value)
    joined = left_lookup(
        facts,
        packed.withColumnRenamed(value, "_value").hint("merge"),
        on,
        ["_value", "_copies"],
    )
    return joined.withColumn(alias, single_value(F.col("_value"), F.col("_copies"), alias)).drop(
        "_value", "_copies"
    )
