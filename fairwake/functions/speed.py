"""Speed classes, the choice among speed sources, and speed-banded sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairwake.functions.numeric import num, rounded
from fairwake.schemas import NUM

# Upper edges (inclusive) of the speed classes, in knots.
BINS = [(10, 1), (12, 2), (15, 3), (50, 4)]
STOPPED, OUT_OF_RANGE = 0, 5
FASTEST = 50
BANDS = {
    "total_distance_nm_under_10": (0, 10),
    "total_distance_nm_btwn_10_12": (10, 12),
    "total_distance_nm_btwn_12_15": (12, 15),
    "total_distance_nm_over_15": (15, 50),
    "total_distance_nm": (0, 50),
}
KM_TO_NM = 0.539957
M_TO_NM = 0.000539957


def speed_bin(knots: Column, *, unknown: int | None = OUT_OF_RANGE) -> Column:
    """Class 0 (stopped) to 4, 5 above 50 knots; `unknown` for NULL and negative."""
    out = F.when(knots == 0, STOPPED)
    for upper, label in BINS:
        out = out.when((knots > 0) & (knots <= upper), label)
    return out.when(knots > FASTEST, OUT_OF_RANGE).otherwise(F.lit(unknown)).cast("bigint")


def first_plausible(speeds: list[Column], slowest: str) -> Column:
    """First of the given speeds that lies in [slowest, 50] knots, else NULL."""
    low = F.lit(slowest).cast(NUM)
    return F.coalesce(*[F.when(s.between(low, FASTEST), s) for s in speeds])


def final_speed(reported: Column, calculated: Column, implied: Column) -> Column:
    return rounded(first_plausible([reported, calculated, implied], "0.001"), 3)


def final_speed_legacy(reported: Column, calculated: Column, implied: Column) -> Column:
    return num(first_plausible([calculated, implied, reported], "0.000001"))


def speed_choice_legacy(implied: Column) -> Column:
    """Earlier first-step choice: the implied speed when it lies in (0, 50].

    The earlier rule also named the reported speed, but only for an implied speed
    that is 0 and above 50 at once, so the reported speed was never chosen.
    """
    return num(F.when((implied > 0) & (implied <= FASTEST), implied))


def speed_choice_legacy_2(calculated: Column, first_choice: Column) -> Column:
    return num(
        F.when((calculated > 0) & (calculated <= FASTEST), calculated)
        .when((first_choice > 0) & (first_choice <= FASTEST), first_choice)
    )


def calculated_knots(metres: Column, millis: Column) -> Column:
    """Distance over time in knots, 4 decimals; NULL when no time passed."""
    km = num(metres / 1000.0).cast("double")
    return F.when(millis > 0, rounded(F.try_divide(km, millis / 3.6e6) * KM_TO_NM, 4))


def sum_in_band(distance: Column, knots: Column, low: int, high: int) -> Column:
    """Sum of distances sailed at a speed in (low, high]."""
    in_band = (knots > low) & (knots <= high)
    return num(F.sum(F.when(in_band, distance).otherwise(F.lit(0).cast(NUM))))
