"""Joins of ship rows with the registry and its dimensions.

None of them forces a broadcast: Spark broadcasts a side whose size is below the
session's threshold, and otherwise shuffles and splits skewed keys adaptively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_GROSS_TONNAGE = 300


def join_registry(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """Messages of registered ships of 300 gross tons or more, with `gt`.

    A ship with several registry rows gets its messages once per row; `start_date`
    (NULL where the registry has none) tells them apart.
    """
    if "start_date" not in registry.columns:
        registry = registry.withColumn("start_date", F.lit(None).cast("date"))
    large = registry.where(F.col("gt") >= MIN_GROSS_TONNAGE).select("mmsi", "gt", "start_date")
    return messages.join(large, "mmsi")


def left_join_registry(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """All messages, with every registry column where the ship is known."""
    return messages.join(registry, "mmsi", "left")


def join_valid_registry(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows with the registry entries valid for their whole time, without duplicates of `gt`.

    Entries without dates match nothing; overlapping entries repeat the row.
    """
    entries = registry.drop("gt")
    within = (F.col("timestamp_beg") >= F.col("start_date").cast("timestamp")) & (
        F.col("timestamp_end") <= F.col("end_date").cast("timestamp")
    )
    return rows.join(entries, "mmsi").where(within)


def join_category(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Add `ship_category` by ship type, blanks around it ignored; unmatched rows stay."""
    known = categories.select(trimmed("shiptype").alias("_type"), "ship_category")
    return rows.join(known, trimmed("shiptype") == F.col("_type"), "left").drop("_type")


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))
