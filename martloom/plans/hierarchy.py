"""Set hierarchies flattened to one row per node with the names of its levels.

All roots grow together, one level per step.  A step is one join of the last level
to the edges and one anti join against the earlier levels.  Both of these lie bucketed in the
shared folder and are read in place; what is shuffled is the last level and the new one, each
once.  The new one is appended, so the plan stays short and a lost executor costs one level.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.functions.keys import hash_key
from martloom.operators.load_window import ntz_literal
from martloom.operators.lookup import interval_lookup
from martloom.session import scoped_run
from martloom.sources.bucketed import BucketedStage
from martloom.sources.mart import publish_snapshot

# Class of the roots, text language, deepest level, set types.
ROOT_CLASS = "0101"
LANGUAGE = "E"
MAX_LEVELS = 20
BASIC_TYPE = "B"
LEAF_PARENT_TYPES = ["B", "S"]
LEAF_TYPE = "X"
# What the edges and the sets met so far are bucketed by.
PARENT_KEYS = ["p_class", "p_sub", "p_name"]
SEEN_KEYS = ["root", "set_key"]


class LevelsExceeded(ValueError):
    """A hierarchy reached the deepest level the mart has columns for."""


@dataclass(frozen=True)
class HierarchySources:
    """Set tables, cost centres and the applications that use each root."""

    applications: DataFrame
    headers: DataFrame
    texts: DataFrame
    nodes: DataFrame
    leaves: DataFrame
    centres: DataFrame
    centre_texts: DataFrame


def roots(applications: DataFrame) -> DataFrame:
    """One subclass per root name, the smallest; names are unique afterwards."""
    own = applications.filter((F.col("setclass") == ROOT_CLASS) & F.col("setname").isNotNull())
    return own.groupBy("setname").agg(F.min("subclass").alias("area"))


def described_sets(src: HierarchySources) -> DataFrame:
    """Sets with their text; sets without one are left out."""
    texts = src.texts.filter(F.col("langu") == LANGUAGE)
    return src.headers.join(
        texts.select("setclass", "subclass", "setname", "descript"),
        ["setclass", "subclass", "setname"],
    ).select("setclass", "subclass", "setname", "settype", "descript")


def edges(src: HierarchySources, sets: DataFrame) -> DataFrame:
    """Parent set to described child set."""
    return src.nodes.select(
        F.col("setclass").alias("p_class"),
        F.col("subclass").alias("p_sub"),
        F.col("setname").alias("p_name"),
        F.col("subsetcls").alias("setclass"),
        F.col("subsetscls").alias("subclass"),
        F.col("subsetname").alias("setname"),
    ).join(sets, ["setclass", "subclass", "setname"])


def _set_key() -> Column:
    # Without delimiter, as the sets are compared elsewhere.
    return F.concat("setclass", "subclass", "setname")


def _level_one(src: HierarchySources, sets: DataFrame) -> DataFrame:
    root = roots(src.applications).select(F.col("setname"), F.col("area"))
    headed = sets.filter(F.col("setclass") == ROOT_CLASS).join(
        root.withColumn("subclass", F.col("area")), ["subclass", "setname"]
    )
    return headed.select(
        F.col("setname").alias("root"),
        "area",
        "setclass",
        "subclass",
        "setname",
        "settype",
        F.lit(1).cast("bigint").alias("level_nbr"),
        F.array("setname").alias("names"),
        F.array("descript").alias("descs"),
    )


def _next_level(last: DataFrame, links: DataFrame, seen: DataFrame, level: int) -> DataFrame:
    parents = last.filter(F.col("settype") != BASIC_TYPE).select(
        "root",
        "area",
        F.col("setclass").alias("p_class"),
        F.col("subclass").alias("p_sub"),
        F.col("setname").alias("p_name"),
        "names",
        "descs",
    )
    grown = parents.join(links, ["p_class", "p_sub", "p_name"]).select(
        "root",
        "area",
        "setclass",
        "subclass",
        "setname",
        "settype",
        F.lit(level).cast("bigint").alias("level_nbr"),
        F.concat("names", F.array("setname")).alias("names"),
        F.concat("descs", F.array("descript")).alias("descs"),
    )
    # Two parents on one level both keep a shared child; a set met on an earlier
    # level of its root is dropped, which also ends cycles.
    return grown.withColumn("set_key", _set_key()).join(seen, SEEN_KEYS, "left_anti")


def expand_sets(src: HierarchySources, max_levels: int = MAX_LEVELS) -> DataFrame:
    """All set rows of all roots, level by level.

    Raises as soon as the deepest level has a row, with or without children.
    """
    sets = described_sets(src)
    first = _level_one(src, sets).withColumn("set_key", _set_key())
    spark, known = first.sparkSession, edges(src, sets)
    links = BucketedStage(spark, "edges", known.schema, PARENT_KEYS)
    levels = BucketedStage(spark, "levels", first.schema, SEEN_KEYS)
    try:
        links.append(known.repartition(links.buckets, *PARENT_KEYS))
        levels.append(first.repartition(levels.buckets, *SEEN_KEYS))
        reached = 1
        while True:
            found = levels.table()
            last = found.filter(F.col("level_nbr") == reached)
            if last.isEmpty():
                return levels.files().drop("set_key")
            if reached > 1 and reached >= max_levels:
                raise LevelsExceeded(f"a hierarchy has {max_levels} levels or more")
            reached += 1
            levels.append(_next_level(last, links.table(), found.select(*SEEN_KEYS), reached))
    finally:
        links.forget()
        levels.forget()


def valid_centres(src: HierarchySources, as_of: datetime) -> DataFrame:
    """Cost centres valid at ``as_of`` with the text that ends on the same day."""
    now = ntz_literal(as_of)
    valid = src.centres.filter((F.col("datab") <= now) & (F.col("datbi") >= now))
    texts = src.centre_texts.filter(F.col("spras") == LANGUAGE)
    return valid.join(texts, ["kokrs", "kostl", "datbi"]).select(
        F.col("kokrs").alias("area"), "kostl", "ktext"
    )


def leaf_rows(expanded: DataFrame, src: HierarchySources, as_of: datetime) -> DataFrame:
    """Cost centres one level below the basic and single sets that list them.

    Intervals meet the centres of the root's own area, once per area and set,
    however many roots and paths lead to the set.
    """
    parents = expanded.filter(F.col("settype").isin(*LEAF_PARENT_TYPES))
    wanted = parents.select("area", "setclass", "subclass", "setname").distinct()
    intervals = src.leaves.join(wanted, ["setclass", "subclass", "setname"])
    held = interval_lookup(valid_centres(src, as_of), intervals, ["area"], "kostl").select(
        "area", "setclass", "subclass", "setname", "kostl", "ktext"
    )
    return parents.join(held, ["area", "setclass", "subclass", "setname"]).select(
        "root",
        "area",
        "setclass",
        "subclass",
        F.col("kostl").alias("setname"),
        F.lit(LEAF_TYPE).alias("settype"),
        (F.col("level_nbr") + 1).alias("level_nbr"),
        F.concat("names", F.array("kostl")).alias("names"),
        F.concat("descs", F.array("ktext")).alias("descs"),
    )


def flatten_hierarchy(
    src: HierarchySources, as_of: datetime, max_levels: int = MAX_LEVELS
) -> DataFrame:
    """The hierarchy mart, complete; it replaces the earlier one as a whole."""
    expanded = expand_sets(src, max_levels)
    rows = expanded.unionByName(leaf_rows(expanded, src, as_of))
    users = src.applications.select(
        "setclass",
        "subclass",
        F.col("setname").alias("root"),
        "appl_nm",
        "qualfr",
        "src_nm",
        "kortex_dprct_ts",
        "kortex_upld_ts",
    )
    levels = [
        column
        for n in range(1, MAX_LEVELS + 1)
        for column in (
            F.get("names", F.lit(n - 1)).alias(f"level{n}_nm"),
            F.get("descs", F.lit(n - 1)).alias(f"level{n}_desc"),
        )
    ]
    return rows.join(users, ["setclass", "subclass", "root"]).select(
        "appl_nm",
        F.col("setclass").alias("set_class_cd"),
        F.col("subclass").alias("sub_class_cd"),
        F.col("setname").alias("set_nm"),
        F.col("settype").alias("set_type_cd"),
        "level_nbr",
        *levels,
        "qualfr",
        "src_nm",
        hash_key("src_nm").alias("hash_key"),
        "kortex_dprct_ts",
        "kortex_upld_ts",
        F.element_at("names", -1).alias("last_level_nm"),
        F.element_at("descs", -1).alias("last_level_desc"),
    )


@scoped_run
def run_hierarchy(
    spark: SparkSession,
    mart_path: str,
    src: HierarchySources,
    as_of: datetime,
    max_levels: int = MAX_LEVELS,
) -> str:
    """Replace the mart below ``mart_path`` by the hierarchy as it is now; the new snapshot."""
    return publish_snapshot(flatten_hierarchy(src, as_of, max_levels), mart_path)
