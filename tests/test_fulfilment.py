from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators.load_window import UNSET_START
from martloom.plans.fulfilment import (
    ORDER_MONTH,
    STORED_SCHEMA,
    fulfilment_delta,
    read_fulfilment,
    run_fulfilment,
)
from martloom.sources.mart import read_partitions

STAGING = """src_nm string, po_number string, po_type string, internal_item_id string,
    internal_dc_id string, create_dt string, mabd string, order_qty string,
    received_early string, received_on_time string, received_late string, short string,
    over string, kortex_dprct_ts timestamp_ntz, kortex_upld_ts timestamp_ntz"""
DAY = [datetime(2024, 1, n) for n in range(1, 20)]


def order(number, item="7", dc="3", created="2024-01-02", qty="5", up=DAY[0]):
    return ("S", number, "T", item, dc, created, " 2024-02-01 ", qty, "x", "1", "", "2", None, up, up)


@pytest.fixture(scope="module")
def dims(spark):
    centres = spark.createDataFrame(
        [("3", "shop b"), ("3", "shop a"), ("bad", "zero bucket"), (" 4 ", "shop 4")],
        "internal_dc_id string, retailer string",
    )
    items = spark.createDataFrame(
        [("7", "3600029145"), ("007", "99"), ("8", None), ("x", "1")],
        "internal_item_id string, retailer_upc string",
    )
    weeks = [(date(2024, 1, 1), date(2024, 1, 7)), (date(2024, 1, 5), date(2024, 1, 11))]
    calendar = spark.createDataFrame(weeks, "fisc_wk_start_dt date, fisc_wk_end_dt date")
    return centres, items, calendar


def test_delta(spark, dims):
    rows = [
        order(" P1"),
        order(" P1", qty=" 9 ", up=DAY[1]),
        order("  ", dc="0"),
        order("P2", item="007", dc="x", created="  "),
        order("P3", created="2024-01-06"),
        order("late", up=DAY[9]),
    ]
    staging = spark.createDataFrame(rows, STAGING)
    out = fulfilment_delta(staging, *dims, DAY[0], DAY[1], DAY[15])
    assert len(out.columns) == 22
    got = {r.po_nbr: r for r in out.collect()}
    assert set(got) == {" P1", None, "P2", "P3"}
    assert got[" P1"].po_order_qty == 9 and got[" P1"].po_recv_early_qty == 0
    # The smallest of several values per id; padded ids stay different keys but join.
    assert got[" P1"].plan_to_nm == "shop a"
    assert got[" P1"].gtin == got["P2"].gtin == "000000000994"
    # An id of 0 meets the bucket of ids that are no numbers.
    assert got[None].plan_to_nm == "zero bucket" and got[None].hash_key is None
    assert got["P2"].plan_to_nm is None and got["P2"].fisc_wk_end_dt is None
    assert got["P3"].fisc_wk_end_dt == date(2024, 1, 7)
    assert got["P3"].po_must_arrv_by_dt == date(2024, 2, 1)


def test_run_rewrites_only_touched_dates(spark, dims, tmp_path):
    path = str(tmp_path / "mart")

    def run(rows, start, end, as_of):
        staging = spark.createDataFrame(rows, STAGING)
        run_fulfilment(spark, path, staging, *dims, start, end, as_of)
        stored = read_fulfilment(spark, path).collect()
        return {(r.po_nbr, r.po_order_qty): r for r in stored}, len(stored)

    def files_of(day):
        day = spark.createDataFrame([(day,)], "d string").select(F.to_date("d").alias(ORDER_MONTH))
        return set(read_partitions(spark, path, STORED_SCHEMA, ORDER_MONTH, day).inputFiles())

    first = [order("P1", up=DAY[1]), order("P2", created="2024-02-03")]
    first.append(order("P9", created="", up=DAY[1]))
    got, n = run(first, UNSET_START, DAY[1], DAY[15])
    assert n == 3
    second = [order("P1", qty="6", up=DAY[2]), order("P3", up=DAY[3])]
    second.append(order("P9", created="", up=DAY[3]))
    before = files_of("2024-02-01")
    got, n = run(first + second, UNSET_START, DAY[5], DAY[16])
    assert files_of("2024-02-01") == before
    # The row without a date has no full key: it is added again, twice with the
    # row on the lower bound of the window, which counts as one with it.
    assert set(got) == {("P1", 6), ("P2", 5), ("P3", 5), ("P9", 5)} and n == 5
    # An update does not advance the upload time, nor the creation stamp.
    assert got[("P1", 6)].kortex_upld_ts == DAY[1]
    assert got[("P1", 6)].kortex_cre_ts == DAY[15]
    assert got[("P1", 6)].kortex_updt_ts == DAY[16]
    again, n = run(first + second, DAY[2], DAY[5], DAY[17])
    assert n == 6 and again[("P3", 5)].kortex_cre_ts == DAY[16]


def test_dimensions_are_joined_after_the_latest_row_is_chosen(spark, dims):
    staging = spark.createDataFrame([order("P1")], STAGING)
    plan = fulfilment_delta(staging, *dims, DAY[0], DAY[1], DAY[15])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join LeftOuter") < text.index("Window [")
    assert "Cross" not in text
