import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.dates import from_jd, jd_of, monday_before, plus_months_overflow, to_jd
from shelfwise.functions.text import ISBN_PATTERN, ordered_values, truncate_ellipsis
from shelfwise.operators.extract import parse_message
from shelfwise.sources.tables import check_item_numbers


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_julian_day_round_trip(spark):
    assert _one(spark, to_jd(F.lit("2000-01-01").cast("date"))) == 2451545
    assert _one(spark, from_jd(F.lit(2451545))) == dt.date(2000, 1, 1)
    assert jd_of(dt.date(2000, 1, 1)) == 2451545


def test_monday_rule(spark):
    # Tue..Sun -> Monday of the same week; Monday -> the Monday before
    cases = {"2024-01-01": "2023-12-25", "2024-01-02": "2024-01-01", "2024-01-06": "2024-01-01",
             "2024-01-07": "2024-01-01", "2024-02-01": "2024-01-29"}
    for d, want in cases.items():
        assert _one(spark, monday_before(F.lit(d))) == dt.date.fromisoformat(want)


def test_month_overflow(spark):
    assert _one(spark, plus_months_overflow(F.lit("2023-12-31"), 2)) == dt.date(2024, 3, 2)
    assert _one(spark, plus_months_overflow(F.lit("2024-01-15"), 2)) == dt.date(2024, 3, 15)


def test_isbn_prefers_longest_alternative(spark):
    df = spark.createDataFrame([("9781234567897 (pbk.)",), ("123456789X",), ("0123456789",), ("no isbn",)], ["t"])
    got = [r[0] for r in df.select(F.regexp_extract("t", ISBN_PATTERN, 1)).collect()]
    assert got == ["9781234567897", "123456789X", "0123456789", ""]


def test_message_parse_lockstep(spark):
    rows = [(1, "Mon Jan 15 2024 09:45AM: IN TRANSIT from ab1 to cd2"),
            (2, "Mon Jan 15 2024 09:45AM: checked in"),
            (3, "IN TRANSIT from ab1 to cd2"),
            (4, "Jan 01 2024 09:00AM"),
            (5, "Tue Jan 16 2024 10:15PM In Transit Too Long. in transit from x9 to y8")]
    out = {r["id"]: r for r in parse_message(spark.createDataFrame(rows, ["id", "field_content"]),
                                             as_of="2024-02-01").collect()}
    assert set(out) == {1, 2, 3, 5}          # neither pattern -> no row
    assert (out[1]["transit_from"], out[1]["transit_to"]) == ("ab1", "cd2")
    assert out[1]["in_transit_days"] == 17
    assert out[2]["transit_from"] is None and out[2]["in_transit_julianday"] is not None
    assert out[3]["in_transit_julianday"] is None and out[3]["has_in_transit"]
    assert out[5]["has_in_transit_too_long"] and out[5]["transit_to"] == "y8"


def test_ordered_values_keeps_nulls_and_order(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, None), (1, 3, "a"), (2, 1, "z")], ["k", "o", "v"])
    got = {r["k"]: r["vs"] for r in df.groupBy("k").agg(ordered_values(F.col("v"), F.col("o")).alias("vs")).collect()}
    assert got == {1: [None, "b", "a"], 2: ["z"]}


def test_truncate_ellipsis(spark):
    assert _one(spark, truncate_ellipsis(F.lit("x" * 40), 37)) == "x" * 37 + "..."
    assert _one(spark, truncate_ellipsis(F.lit("short"), 37)) == "short"


@pytest.mark.parametrize("column,value", [("l_partkey", 1 << 18), ("l_suppkey", 1 << 14), ("l_orderkey", 1 << 31)])
def test_item_numbers_never_collide_silently(spark, column, value):
    keys = {"l_orderkey": 5, "l_linenumber": 7, "l_partkey": (1 << 18) - 1, "l_suppkey": 3}
    check_item_numbers(spark.createDataFrame([keys]))
    with pytest.raises(ValueError):
        check_item_numbers(spark.createDataFrame([keys | {column: value}]))
