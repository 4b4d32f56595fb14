"""Stage 6: cooperation scorecards per operator and day, month, year.

They are built from the daily ship scorecard, which is small: the lists of ships and
categories in a row are sets combined before the shuffle, and ship counts are their
sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwake.functions.numeric import grade, mean_over, num, plain_text, ratio, rounded
from fairwake.functions.text import listed, month_name
from fairwake.plans.ships import DISTANCES, ROLLING_ROWS, score

SEVERAL = "multi-category"


def operator_daily(daily: DataFrame) -> DataFrame:
    rolled = operator_rollup(daily, ["date"])
    so_far = Window.partitionBy("operator").orderBy("date")
    so_far = so_far.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rolled.select(
        "operator",
        "operator_code",
        "operator_ship_categories",
        "date",
        "vsr_region",
        rounded(F.col("score"), 2).alias("coop_score_daily"),
        grade(F.col("score")).alias("day_grade"),
        rounded(mean_over(F.col("score"), so_far), 2).alias("rolling_coop_score"),
        F.col("ship_count").alias("daily_ship_count"),
        *_figures(),
    )


def operator_monthly(daily: DataFrame) -> DataFrame:
    rolled = operator_rollup(_dated(daily), ["month", "year"])
    trailing = Window.partitionBy("operator", "year").orderBy(
        "month", "vsr_region", "operator_code"
    )
    trailing = trailing.rowsBetween(-ROLLING_ROWS, Window.currentRow)
    return rolled.select(
        "operator",
        "operator_code",
        "operator_ship_categories",
        "vsr_region",
        "month",
        "year",
        rounded(F.col("score"), 2).alias("coop_score_monthly"),
        score_text(month_name(F.col("month")), F.lit(" "), F.col("year").cast("string")).alias(
            "cooperation_score_monthly"
        ),
        grade(F.col("score")).alias("month_grade"),
        rounded(mean_over(F.col("score"), trailing), 2).alias("rolling_coop_score"),
        F.col("ship_count").alias("month_ship_count"),
        *_figures(),
    )


def operator_annual(daily: DataFrame) -> DataFrame:
    rolled = operator_rollup(_dated(daily), ["year"])
    so_far = Window.partitionBy("operator").orderBy("year")
    so_far = so_far.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rolled.select(
        "operator",
        "operator_code",
        "operator_ship_categories",
        "vsr_region",
        "year",
        rounded(F.col("score"), 2).alias("coop_score_annual"),
        score_text(F.col("year").cast("string")).alias("cooperation_score_annual"),
        grade(F.col("score")).alias("year_grade"),
        rounded(mean_over(F.col("score"), so_far), 2).alias("rolling_coop_score"),
        F.col("ship_count").alias("year_ship_count"),
        *_figures(),
    )


def operator_rollup(daily: DataFrame, period: list[str]) -> DataFrame:
    """One row per operator, zone region and period, not yet rounded.

    The mean speed divides by all rows, also those without a speed.
    """
    categories = F.collect_set("ship_category")
    return (
        daily.groupBy("operator", "operator_code", "vsr_region", *period)
        .agg(
            *[num(F.sum(name)).alias(name) for name in DISTANCES],
            ratio(F.sum("avg_speed_knots"), F.count("day_count")).alias("avg_speed_knots"),
            F.max("max_timestamp").alias("max_timestamp"),
            F.min("min_timestamp").alias("min_timestamp"),
            F.collect_set("mmsi").alias("ships"),
            listed(F.collect_set("shiptype")).alias("ship_types"),
            listed(F.collect_set("name_of_ship")).alias("name_of_ships"),
            listed(categories).alias("ship_categories_list"),
            F.when(F.size(categories) > 1, F.lit(SEVERAL))
            .when(F.size(categories) == 1, F.max("ship_category"))
            .alias("operator_ship_categories"),
        )
        .withColumn("ship_count", F.size("ships").cast("bigint"))
        .withColumn("mmsi_list", listed(F.col("ships").cast("array<string>")))
        .withColumn("score", score())
    )


def score_text(*period: Column) -> Column:
    """Score and period as one text: 85.25% (jan 2024)."""
    return F.concat(plain_text(F.col("score"), 2), F.lit("% ("), *period, F.lit(")"))


def _dated(daily: DataFrame) -> DataFrame:
    return daily.withColumns(
        {"month": F.month("date").cast("bigint"), "year": F.year("date").cast("bigint")}
    )


def _figures() -> list[Column]:
    return [
        *[rounded(F.col(name), 2).alias(name) for name in ["total_distance_nm", *DISTANCES[:-1]]],
        rounded(F.col("avg_speed_knots"), 2).alias("avg_speed_knots"),
        F.col("ship_categories_list"),
        F.col("mmsi_list"),
        F.col("name_of_ships"),
        F.col("max_timestamp"),
        F.col("min_timestamp"),
    ]
