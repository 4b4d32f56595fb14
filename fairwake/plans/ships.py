"""Stage 5: cooperation scorecards per ship and day, month, year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwake.functions.numeric import (
    grade,
    mean,
    mean_over,
    num,
    pct_text,
    percent,
    rounded,
)
from fairwake.functions.speed import BANDS, sum_in_band
from fairwake.operators.joins import MIN_GROSS_TONNAGE, join_category, join_valid_registry
from fairwake.schemas import NUM

SHIP = [
    "mmsi", "name_of_ship", "operator", "operator_code", "technical_manager", "shiptype",
    "ship_category", "vsr_region", "gt",
]
DISTANCES = list(BANDS)
SHARES = {
    "under_10": "total_distance_nm_under_10",
    "btwn_10_12": "total_distance_nm_btwn_10_12",
    "btwn_12_15": "total_distance_nm_btwn_12_15",
    "over_15": "total_distance_nm_over_15",
}
NO_CATEGORY = "OTHER"
# Rolling scores look at the current and the 12 rows before it.
ROLLING_ROWS = 12


def score() -> Column:
    """Share of the distance sailed at 10 knots or less, in percent."""
    return percent(F.col("total_distance_nm_under_10"), F.col("total_distance_nm"))


def registered_segments(
    zone_segments: DataFrame, registry: DataFrame, categories: DataFrame
) -> DataFrame:
    """Zone segments with the registry entry valid at the time and the ship category."""
    valid = join_valid_registry(zone_segments, registry)
    return join_category(valid, categories).where(F.col("gt") >= MIN_GROSS_TONNAGE)


def distance_measures() -> dict[str, Column]:
    """Distances per speed band, of unknown speed, and regardless of speed."""
    knots, distance = F.col("final_speed_knots"), F.col("distance_nm")
    sums = {name: sum_in_band(distance, knots, *band) for name, band in BANDS.items()}
    unknown = F.when(knots.isNull(), distance).otherwise(F.lit(0).cast(NUM))
    sums["total_distance_nm_weird"] = num(F.sum(unknown))
    sums["total_distance_nm_wo_filter"] = num(F.sum(distance))
    return sums


def extreme_measures() -> dict[str, Column]:
    """Highest and lowest speeds; kept out of the scorecard itself."""
    final, implied = F.col("final_speed_knots"), F.col("implied_speed_knots")
    return {
        "max_speed_knots": rounded(F.max(final), 3),
        "min_speed_knots": rounded(F.min(final), 3),
        "max_implied_speed_knots": rounded(F.max(implied), 3),
        "min_implied_speed_knots": rounded(F.min(implied), 3),
        "max_final_calculated_speed_knots": F.max(final),
        "min_final_calculated_speed_knots": F.min(final),
    }


def ship_days(rows: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per ship entry, day and zone region; a missing category is named last."""
    measures = distance_measures() | (extra or {})
    return (
        rows.groupBy(*SHIP, "date")
        .agg(
            rounded(mean(F.col("final_speed_knots")), 1).alias("avg_speed_knots"),
            *[c.alias(name) for name, c in measures.items()],
            F.count("num").alias("seg_count"),
            F.max(F.when(F.col("date").isNotNull(), 1).otherwise(0)).cast("bigint").alias("day_count"),
            F.max("timestamp_end").alias("max_timestamp"),
            F.min("timestamp_beg").alias("min_timestamp"),
        )
        .withColumn("ship_category", F.coalesce("ship_category", F.lit(NO_CATEGORY)))
    )


def rolling_by_day() -> Column:
    """Average score of a ship's days so far, all zones of a day included."""
    so_far = Window.partitionBy("mmsi").orderBy("date")
    so_far = so_far.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rounded(mean_over(F.col("score"), so_far), 3)


def ship_daily(zone_segments: DataFrame, registry: DataFrame, categories: DataFrame) -> DataFrame:
    days = ship_days(registered_segments(zone_segments, registry, categories))
    rolled = days.withColumn("score", score()).withColumn("rolling", rolling_by_day())

    def share(name: str) -> Column:
        return pct_text(percent(F.col(SHARES[name]), F.col("total_distance_nm")), 1)

    return rolled.select(
        "mmsi",
        "name_of_ship",
        "operator",
        "operator_code",
        "technical_manager",
        "shiptype",
        "ship_category",
        "date",
        "vsr_region",
        pct_text(F.col("score"), 1).alias("cooperation_score_daily"),
        rounded(F.col("score"), 2).alias("coop_score_daily"),
        grade(F.col("score")).alias("coop_grade_daily"),
        rounded(F.col("rolling"), 1).alias("rolling_coop_score"),
        grade(F.col("rolling")).alias("rolling_coop_grade"),
        "total_distance_nm",
        "total_distance_nm_under_10",
        share("under_10").alias("percent_under_10_knots"),
        "total_distance_nm_btwn_10_12",
        share("btwn_10_12").alias("percent_10_12_knots"),
        "total_distance_nm_btwn_12_15",
        share("btwn_12_15").alias("percent_12_15_knots"),
        "total_distance_nm_over_15",
        share("over_15").alias("percent_over_15_knots"),
        "total_distance_nm_weird",
        "total_distance_nm_wo_filter",
        "avg_speed_knots",
        "min_timestamp",
        "max_timestamp",
        "gt",
        "day_count",
        "seg_count",
    )


def ship_monthly(daily: DataFrame) -> DataFrame:
    rolled = _rolled_up(daily, {"month": F.month("date"), "year": F.year("date")})
    others = [c for c in SHIP if c != "mmsi"]
    window = Window.partitionBy("mmsi", "year").orderBy("month", *others)
    return _scorecard(rolled, ["month", "year"], "coop_score_monthly", "month_grade", window)


def ship_annual(daily: DataFrame) -> DataFrame:
    rolled = _rolled_up(daily, {"year": F.year("date")})
    others = [c for c in SHIP if c != "mmsi"]
    window = Window.partitionBy("mmsi").orderBy("year", *others)
    return _scorecard(rolled, ["year"], "coop_score_annual", "year_grade", window)


def _rolled_up(daily: DataFrame, period: dict[str, Column]) -> DataFrame:
    dated = daily.withColumns({name: part.cast("bigint") for name, part in period.items()})
    return (
        dated.groupBy(*SHIP, *period)
        .agg(
            *[num(F.sum(name)).alias(name) for name in DISTANCES],
            mean(F.col("avg_speed_knots")).alias("avg_speed_knots"),
            F.min("min_timestamp").alias("min_timestamp"),
            F.max("max_timestamp").alias("max_timestamp"),
            F.sum("day_count").alias("day_count"),
            F.sum("seg_count").alias("seg_count"),
        )
        .withColumn("score", score())
    )


def _scorecard(
    rolled: DataFrame, period: list[str], score_name: str, grade_name: str, window
) -> DataFrame:
    """Rounded scorecard; its rolling score averages scores that are rounded already."""
    trailing = window.rowsBetween(-ROLLING_ROWS, Window.currentRow)
    shown = rolled.withColumn(score_name, rounded(F.col("score"), 2))

    def share(name: str) -> Column:
        return pct_text(percent(F.col(SHARES[name]), F.col("total_distance_nm")), 2)

    def distance(name: str) -> Column:
        return rounded(F.col(name), 2).alias(name)

    shares = []
    for name, column in SHARES.items():
        shares += [distance(column), share(name).alias(f"percent_distance_{name}")]
    return shown.select(
        *[c for c in SHIP if c != "gt"],
        *period,
        score_name,
        grade(F.col("score")).alias(grade_name),
        rounded(mean_over(F.col(score_name), trailing), 3).alias("rolling_coop_score"),
        distance("total_distance_nm"),
        *shares,
        rounded(F.col("avg_speed_knots"), 2).alias("avg_speed_knots"),
        "min_timestamp",
        "max_timestamp",
        "gt",
        "day_count",
        "seg_count",
    )
