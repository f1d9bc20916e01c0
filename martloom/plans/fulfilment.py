"""Customer order fulfilment: staging text to an upserted mart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from martloom.functions.gtin import CheckDigitFix, add_check_digit, with_gtin
from martloom.functions.keys import hash_key
from martloom.functions.text import (
    blank_to_null,
    date_or_null,
    digits_or_null,
    digits_or_zero,
)
from martloom.operators.dedup import latest_wins
from martloom.operators.load_window import (
    UNSET_START,
    ntz_literal,
    global_high_water,
    in_closed_window,
    start_of,
)
from martloom.operators.lookup import calendar_days, left_lookup
from martloom.operators.merge import update_insert
from martloom.session import scoped_run, write_stage
from martloom.sources.mart import (
    merge_partitions,
    publish_partitions,
    read_partitioned,
    read_partitions,
    uploads,
)

# The mart's layout, its key, and what a match updates.
MART_SCHEMA = """
    po_nbr string, po_type string, plan_to_nm string, gtin string,
    gtin_type_cd string, intrnl_item_id string, intrnl_dc_id string,
    po_cre_dt date, fisc_wk_end_dt date, po_must_arrv_by_dt date,
    po_order_qty int, po_recv_early_qty int, po_recv_on_time_qty int,
    po_recv_late_qty int, po_short_qty int, po_over_qty int,
    src_nm string, hash_key string,
    kortex_dprct_ts timestamp_ntz, kortex_upld_ts timestamp_ntz,
    kortex_cre_ts timestamp_ntz, kortex_updt_ts timestamp_ntz
"""
# Layout column of a stored mart, derived from the order date: the orders of one load are
# spread over many days, and a folder for each would hold a few rows.
ORDER_MONTH = "po_cre_mon"
STORED_SCHEMA = f"{MART_SCHEMA.rstrip()}, {ORDER_MONTH} date"
KEYS = ["src_nm", "po_nbr", "intrnl_dc_id", "intrnl_item_id", "po_cre_dt"]
HASH_PARTS = ["src_nm", "po_nbr", "po_cre_dt", "intrnl_dc_id", "intrnl_item_id"]
UPDATED = [
    "po_type",
    "plan_to_nm",
    "gtin",
    "po_must_arrv_by_dt",
    "po_order_qty",
    "po_recv_early_qty",
    "po_recv_on_time_qty",
    "po_recv_late_qty",
    "po_short_qty",
    "po_over_qty",
]
# Quantity columns, staging name to mart name.
QUANTITIES = {
    "order_qty": "po_order_qty",
    "received_early": "po_recv_early_qty",
    "received_on_time": "po_recv_on_time_qty",
    "received_late": "po_recv_late_qty",
    "short": "po_short_qty",
    "over": "po_over_qty",
}


def clean_orders(staging: DataFrame) -> DataFrame:
    """Typed columns from staging text."""
    return staging.select(
        "src_nm",
        blank_to_null(F.col("po_number")).alias("po_nbr"),
        "po_type",
        digits_or_null(F.col("internal_item_id")).alias("intrnl_item_id"),
        digits_or_null(F.col("internal_dc_id")).alias("intrnl_dc_id"),
        date_or_null(F.col("create_dt")).alias("po_cre_dt"),
        date_or_null(F.col("mabd")).alias("po_must_arrv_by_dt"),
        *[digits_or_zero(F.col(src)).alias(name) for src, name in QUANTITIES.items()],
        "kortex_dprct_ts",
        "kortex_upld_ts",
    )


def retailer_names(distribution_centres: DataFrame) -> DataFrame:
    """One retailer per numeric centre id, the smallest name; other ids are all 0."""
    centre = digits_or_zero(F.col("internal_dc_id"), "bigint").alias("dc_nbr")
    return distribution_centres.groupBy(centre).agg(F.min("retailer").alias("plan_to_nm"))


def item_gtins(items: DataFrame, fix: CheckDigitFix = add_check_digit) -> DataFrame:
    """One GTIN per numeric item id, the smallest; other ids are all 0."""
    codes = items.filter(F.col("retailer_upc").isNotNull()).select(
        digits_or_zero(F.col("internal_item_id"), "bigint").alias("item_nbr"),
        digits_or_zero(F.col("retailer_upc"), "bigint").alias("_upc"),
    )
    coded = with_gtin(codes.distinct(), F.col("_upc"), "gtin", fix)
    return coded.groupBy("item_nbr").agg(F.min("gtin").alias("gtin"))


def week_ends(calendar: DataFrame) -> DataFrame:
    """The earliest end of the fiscal weeks that hold a day, per day."""
    days = calendar_days(calendar, "fisc_wk_start_dt", "fisc_wk_end_dt", "day")
    return days.groupBy("day").agg(F.min("fisc_wk_end_dt").alias("fisc_wk_end_dt"))


def fulfilment_delta(
    staging: DataFrame,
    distribution_centres: DataFrame,
    items: DataFrame,
    calendar: DataFrame,
    start: datetime | None,
    end: datetime,
    as_of: datetime,
    fix: CheckDigitFix = add_check_digit,
) -> DataFrame:
    """The window's rows in the mart's layout, one per key; all rows without a start.

    The key consists of staging columns alone, so the latest row is chosen before
    the lookups: they see fewer rows, and a dimension with several values per id
    cannot fan out.  Among such values, as among rows loaded at the same time, the
    smallest is taken.
    """
    windowed = staging
    if start is not None:
        windowed = in_closed_window(staging, "kortex_upld_ts", start, end)
    latest = latest_wins(clean_orders(windowed), KEYS, "kortex_upld_ts")
    numbered = latest.withColumns(
        {
            "_dc": F.col("intrnl_dc_id").cast("bigint"),
            "_item": F.col("intrnl_item_id").cast("bigint"),
        }
    )
    named = left_lookup(
        numbered, retailer_names(distribution_centres), [("_dc", "dc_nbr")], ["plan_to_nm"]
    )
    coded = left_lookup(named, item_gtins(items, fix), [("_item", "item_nbr")], ["gtin"])
    dated = left_lookup(coded, week_ends(calendar), [("po_cre_dt", "day")], ["fisc_wk_end_dt"])
    stamped = dated.withColumns(
        {
            "gtin_type_cd": F.lit("UPC"),
            "hash_key": hash_key(*HASH_PARTS),
            "kortex_cre_ts": ntz_literal(as_of),
            "kortex_updt_ts": ntz_literal(as_of),
        }
    )
    return stamped.to(StructType.fromDDL(MART_SCHEMA))


def load_fulfilment(
    target: DataFrame,
    staging: DataFrame,
    distribution_centres: DataFrame,
    items: DataFrame,
    calendar: DataFrame,
    from_dt: datetime,
    to_dt: datetime,
    as_of: datetime,
    fix: CheckDigitFix = add_check_digit,
) -> DataFrame:
    """The mart after one incremental load.

    Given the unset start, the load begins at the mart's latest upload time.
    """
    start = from_dt
    if from_dt == UNSET_START:
        start = start_of(global_high_water(target, "kortex_upld_ts"))
    delta = write_stage(
        fulfilment_delta(
            staging, distribution_centres, items, calendar, start, to_dt, as_of, fix
        ).drop("hash_key"),
        "fulfilment-delta",
    )
    return update_insert(
        target,
        delta,
        KEYS,
        UPDATED,
        as_of,
        created="kortex_cre_ts",
        updated="kortex_updt_ts",
        computed={"hash_key": hash_key(*HASH_PARTS)},
    )


@scoped_run
def run_fulfilment(
    spark: SparkSession,
    mart_path: str,
    staging: DataFrame,
    distribution_centres: DataFrame,
    items: DataFrame,
    calendar: DataFrame,
    from_dt: datetime | None,
    to_dt: datetime | None,
    as_of: datetime,
    fix: CheckDigitFix = add_check_digit,
) -> dict[str, int]:
    """Load one window into a mart stored by month of order date; without a start, all rows.

    The order date is part of the key, so only the months in the delta are read and
    written again.  Rows without a date match nothing: they are added, and those of
    earlier runs are left alone.  The high-water mark comes from the mart's snapshot.
    Counted are the rows written, and of them the ones inserted and matched.
    """
    start = from_dt
    if from_dt == UNSET_START:
        start = start_of(global_high_water(uploads(spark, mart_path), "kortex_upld_ts"))
    month = F.trunc("po_cre_dt", "month")
    delta = write_stage(
        fulfilment_delta(
            staging, distribution_centres, items, calendar, start, to_dt, as_of, fix
        )
        .drop("hash_key")
        .withColumn(ORDER_MONTH, month),
        "fulfilment-delta",
    )
    touched = write_stage(
        delta.select(ORDER_MONTH).filter(F.col(ORDER_MONTH).isNotNull()).distinct(),
        "touched-months",
    )
    merged = update_insert(
        read_partitions(spark, mart_path, STORED_SCHEMA, ORDER_MONTH, touched),
        delta,
        KEYS,
        UPDATED,
        as_of,
        created="kortex_cre_ts",
        updated="kortex_updt_ts",
        computed={"hash_key": hash_key(*HASH_PARTS)},
    )
    stamp = ntz_literal(as_of)
    new = F.col("kortex_cre_ts") == stamp
    return publish_partitions(
        merged,
        mart_path,
        ORDER_MONTH,
        touched,
        uploaded="kortex_upld_ts",
        computed={"hash_key": hash_key(*HASH_PARTS)},
        inserted=new,
        matched=~new & (F.col("kortex_updt_ts") == stamp),
    )


def read_fulfilment(spark: SparkSession, mart_path: str) -> DataFrame:
    """The mart that ``run_fulfilment`` keeps."""
    stored = read_partitioned(spark, mart_path, STORED_SCHEMA, ORDER_MONTH)
    return stored.drop(ORDER_MONTH)


def merge_fulfilment(spark: SparkSession, mart_path: str, most: int = 8) -> list[str]:
    """Merge the months that lie in more than ``most`` runs, as rows without a date do."""
    return merge_partitions(
        spark, mart_path, STORED_SCHEMA, ORDER_MONTH, most, uploaded="kortex_upld_ts"
    )
