from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom.functions.gtin import with_gtin, with_gtin_of_text
from martloom.functions.keys import hash_key
from martloom.functions.text import (
    blank_to_null,
    date_or_null,
    decimal_or_zero,
    digits_or_null,
    digits_or_zero,
    has_tail_date,
    padded_code,
    tail_date,
    text_timestamp,
)

DIRTY = ["12", " 7 ", "", " ", None, "ab", "-.5", "12.", "1,2", "+5", "1e5", "12\n", "007"]


def one(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_digits(spark):
    got = one(spark, DIRTY, digits_or_zero(F.col("raw")))
    assert got == [12, 7, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 7]
    got = one(spark, DIRTY, digits_or_null(F.col("raw")))
    assert [v for v in got if v] == ["12", "7", "007"]


def test_too_many_digits_raise(spark):
    with pytest.raises(Exception, match="CAST"):
        one(spark, ["12345678901"], digits_or_zero(F.col("raw")))


def test_decimals(spark):
    got = [float(v) for v in one(spark, DIRTY, decimal_or_zero(F.col("raw")))]
    assert got == [12, 7, 0, 0, 0, 0, -0.5, 0, 0, 0, 0, 0, 7]


def test_blank_to_null_keeps_spaces(spark):
    assert one(spark, ["", "  ", None, " x "], blank_to_null(F.col("raw"))) == [
        None,
        None,
        None,
        " x ",
    ]


def test_dates(spark):
    got = one(spark, ["", "  ", None, " 2020-01-02 "], date_or_null(F.col("raw")))
    assert got == [None, None, None, date(2020, 1, 2)]
    with pytest.raises(Exception, match="CAST"):
        one(spark, ["2020-13-45"], date_or_null(F.col("raw")))


def test_tail_dates_roll_over(spark):
    texts = ["w 01/05/71", "w 02/30/20", "w 12/31/69 ", "w 13/01/20"]
    assert one(spark, texts, tail_date(F.col("raw"))) == [
        date(1971, 1, 5),
        date(2020, 3, 1),
        date(2069, 12, 31),
        date(2021, 1, 1),
    ]
    flags = one(spark, [*texts, "01/05/2020", None], has_tail_date(F.col("raw")))
    assert flags == [True] * 4 + [False, None]


def test_gtin_of_text(spark):
    upcs = ["1", "03600029145", "123456789012", "1234567890123", "000000000000012", "AB", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(upcs)], "i int, upc string")
    got = [r.gtin for r in with_gtin_of_text(df, F.col("upc"), "gtin").orderBy("i").collect()]
    assert got == [
        "000000000017",
        "036000291452",
        "123456789012",
        "1234567890123",
        "000000000123",
        "AB",
        None,
    ]


def test_gtin_with_another_fix(spark):
    df = spark.createDataFrame([(0,), (42,)], "n bigint")
    plain = with_gtin(df, F.col("n"), "gtin", fix=lambda code: code)
    assert {r.gtin for r in plain.collect()} == {"00000000000", "00000000042"}


def test_hash_key_with_null_part(spark):
    df = spark.createDataFrame([("a", date(2020, 1, 2)), ("a", None)], "a string, d date")
    got = {r[0] for r in df.select(hash_key("a", "d")).collect()}
    want = spark.sql("SELECT md5('a2020-01-02')").first()[0]
    assert got == {want, None}


def test_small_helpers(spark):
    assert one(spark, ["12345678901", "7"], padded_code(F.col("raw"))) == [
        "1234567890",
        "0000000007",
    ]
    stamp = one(spark, ["2020-01-02"], text_timestamp(F.col("raw"), F.lit("03:04:05")))
    assert str(stamp[0]) == "2020-01-02 03:04:05"
