"""Thresholds of every scalar rule, on, below and above each edge."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fairwake.functions import numeric, speed, text
from fairwake.functions.area import AREA, AREA_LEGACY, region_label
from fairwake.schemas import NUM


def column(spark, values, kind=NUM):
    return spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(values)],
                                 "i int, v string").select("i", F.col("v").cast(kind).alias("v"))


def outcome(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression.alias("out")).collect()]


SPEEDS = [None, -1, 0, "0.0005", "0.001", 10, "10.001", 12, "12.001", 15, "15.001", 50, "50.001"]


def test_speed_bins(spark):
    df = column(spark, SPEEDS)
    assert outcome(df, speed.speed_bin(F.col("v"))) == [5, 5, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4, 5]


def test_speed_bins_leave_unknown_speeds_out(spark):
    df = column(spark, SPEEDS)
    expected = [None, None, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4, 5]
    assert outcome(df, speed.speed_bin(F.col("v"), unknown=None)) == expected


def test_grades(spark):
    df = column(spark, [None, 0, "19.999", 20, 40, 60, 80, "98.999", 99, 100])
    assert outcome(df, numeric.grade(F.col("v"))) == ["F", "F", "F", "D", "C", "B", "A", "A", "A+", "A+"]


@pytest.mark.parametrize(
    "lon, lat, region",
    [
        (-120.0, 33.285, "other"),
        (-120.0, 33.287, "other"),
        (-120.0, 33.290, "sc"),
        (-120.0, 34.5739, "sc"),
        (-120.0, 34.57391, "cc"),
        (-120.0, 35.557, "cc"),
        (-120.0, 35.5571, "sf"),
        (-120.0, 39.032, "sf"),
        (-120.0, 39.0321, "other"),
        (-117.460, 34.0, "sc"),
        (-117.457, 34.0, "other"),
        (-125.013, 34.0, "sc"),
        (-125.0131, 34.0, "other"),
    ],
)
def test_regions(spark, lon, lat, region):
    row = spark.range(1).select(region_label(F.lit(lon), F.lit(lat))).first()
    assert row[0] == region


def test_boxes_include_their_edges(spark):
    def within(box, lon, lat):
        return spark.range(1).select(box.contains(F.lit(lon), F.lit(lat))).first()[0]

    assert within(AREA, -125.013, 33.285) and within(AREA, -117.455, 39.032)
    assert not within(AREA, -117.4549, 34.0) and not within(AREA, -120.0, 33.2849)
    assert within(AREA_LEGACY, -121.0299, 34.5738) and not within(AREA_LEGACY, -121.03, 34.0)


def three_speeds(spark, rows):
    return spark.createDataFrame(
        [(i, *(None if v is None else Decimal(str(v)) for v in row)) for i, row in enumerate(rows)],
        "i int, reported decimal(20,9), calculated decimal(20,9), implied decimal(20,9)",
    )


def test_final_speed_takes_the_first_plausible_source(spark):
    df = three_speeds(
        spark,
        [(5, 6, 7), (0, 6, 7), (50.001, 50, 7), (None, 0.0005, 7.12345), (0.001, 6, 7), (-1, 0, 51)],
    )
    chosen = speed.final_speed(F.col("reported"), F.col("calculated"), F.col("implied"))
    assert outcome(df, chosen.cast("double")) == [5.0, 6.0, 50.0, 7.123, 0.001, None]


def test_legacy_final_speed_prefers_the_calculated_one_and_does_not_round(spark):
    df = three_speeds(spark, [(5, 6.123456, 7), (5, 0, 7), (5, 51, 0), (5, 0.000001, 7), (0, None, 60)])
    chosen = speed.final_speed_legacy(F.col("reported"), F.col("calculated"), F.col("implied"))
    assert outcome(df, chosen.cast("double")) == [6.123456, 7.0, 5.0, 0.000001, None]


def test_legacy_choice_never_takes_the_reported_speed(spark):
    df = three_speeds(spark, [(5, None, 0), (5, None, 50), (5, None, 51), (5, None, None)])
    first = speed.speed_choice_legacy(F.col("implied"))
    assert outcome(df, first.cast("double")) == [None, 50.0, None, None]
    second = speed.speed_choice_legacy_2(F.col("calculated"), F.col("implied"))
    assert outcome(df, second.cast("double")) == [None, 50.0, None, None]


def test_calculated_knots_needs_time_to_pass(spark):
    df = spark.createDataFrame([(0, 1852.0, 3600000), (1, 1852.0, 0), (2, 0.0, 10)], "i int, m double, ms long")
    knots = speed.calculated_knots(F.col("m"), F.col("ms"))
    assert outcome(df, knots.cast("double")) == [1.0, None, 0.0]


def test_rounding_is_half_up_on_decimals(spark):
    df = column(spark, ["0.285", "2.675", "-0.285", "1.005"], "double")
    rounded = numeric.rounded(F.col("v"), 2).cast("double")
    assert outcome(df, rounded) == [0.29, 2.68, -0.29, 1.01]


def test_casts_that_fail_give_null(spark):
    df = spark.createDataFrame([(0, "12.5"), (1, "x"), (2, "1e400")], "i int, v string")
    assert outcome(df, numeric.num(F.col("v"))) == [Decimal("12.500000000"), None, None]


def test_percent_text_drops_trailing_zeros(spark):
    df = column(spark, [100, "33.333", "0.04", "50.50", None])
    assert outcome(df, numeric.pct_text(F.col("v"), 1)) == ["100%", "33.3%", "0%", "50.5%", None]
    assert outcome(df, numeric.pct_text(F.col("v"), 2)) == ["100%", "33.33%", "0.04%", "50.5%", None]


def test_division_by_zero_gives_null(spark):
    df = column(spark, [0, 4])
    shares = numeric.percent(F.lit(1).cast(NUM), F.col("v")).cast("double")
    assert outcome(df, shares) == [None, 25.0]


def test_lists_are_sorted_and_empty_ones_null(spark):
    df = spark.createDataFrame([(0, ["b", "a"]), (1, [])], "i int, v array<string>")
    assert outcome(df, text.listed(F.col("v"))) == ["a, b", None]


def test_month_names(spark):
    df = spark.createDataFrame([(0, 1), (1, 12), (2, None)], "i int, v int")
    assert outcome(df, text.month_name(F.col("v"))) == ["jan", "dec", None]
