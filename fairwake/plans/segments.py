"""Stage 2: consecutive messages of a vessel to movement segments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.functions import geo
from fairwake.functions.numeric import num, rounded
from fairwake.functions.speed import (
    M_TO_NM,
    calculated_knots,
    final_speed,
    final_speed_legacy,
    speed_bin,
)
from fairwake.operators.joins import MIN_GROSS_TONNAGE, join_registry
from fairwake.operators.ordered import SLICE_HOURS, Slices, sliced, with_next
from fairwake.operators.spatial import with_touch_flag
from fairwake.schemas import SEGMENTS, SEGMENTS_LEGACY, SEGMENTS_SIMPLE, conform

# Longest gap between two messages, shortest and longest distance.
MAX_GAP_MINUTES = 120


@dataclass(frozen=True)
class Reach:
    """Inclusive bounds of a segment's length in metres."""

    shortest: float
    longest: float


REACH = Reach(0.0001, 222240.0)
REACH_SIMPLE = Reach(0.0, 10000.0)


def time_order(rows: DataFrame) -> list[str]:
    """Order along a vessel's time line.

    Rows with one timestamp follow each other by their content, so the order does not
    depend on how they arrive. Naming every column also lets both uses of the shuffled
    rows share one shuffle.
    """
    return ["timestamp", *[c for c in rows.columns if c not in ("timestamp", "mmsi")]]


def newer(rows: DataFrame, since: dt.datetime) -> DataFrame:
    """Rows after the watermark.

    This comes before any look at neighbouring rows: a segment whose first message was
    already there at the last load is not formed.
    """
    return rows.where(F.col("timestamp") > F.lit(since).cast("timestamp"))


def point_pairs(
    messages: DataFrame, *, carry: list[str], slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Each message with the vessel's following one, numbered along the vessel's time."""
    rows = sliced(messages, "mmsi", "timestamp", slice_hours)
    order = time_order(messages)
    return with_next(rows, "mmsi", order, carry, number="num").select(
        "*",
        F.expr(geo.point("lon", "lat")).alias("point"),
        F.when(
            F.col("next").isNotNull(), F.expr(geo.point("next.lon", "next.lat"))
        ).alias("next_point"),
    )


def elapsed(unit: str) -> Column:
    """Whole units of time from a message to the following one."""
    return F.timestamp_diff(unit, F.col("timestamp"), F.col("next.timestamp"))


def is_segment(reach: Reach = REACH) -> Column:
    """Whether a pair of messages is close enough in time and space."""
    return (
        F.col("next").isNotNull()
        & (elapsed("MINUTE") <= MAX_GAP_MINUTES)
        & F.col("metres").between(reach.shortest, reach.longest)
    )


def measured(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("metres", F.expr(geo.haversine_m("next_point", "point")))


def build_segments(
    messages: DataFrame,
    registry: DataFrame,
    coast: DataFrame | None,
    since: dt.datetime,
    *,
    slice_hours: int | Slices = SLICE_HOURS,
    geodesic: bool = True,
) -> DataFrame:
    """Segments of large ships with distance, speeds, speed classes and coast contact.

    A segment carries the speeds reported at its end. Without `coast`, no segment
    touches it.
    """
    pairs = _registered_pairs(messages, registry, since, slice_hours)
    speeds = _measures(pairs, digits=4).withColumn(
        "final_speed_knots",
        final_speed(
            F.col("speed_knots"), F.col("calculated_knots"), F.col("implied_speed_knots")
        ),
    )
    if coast is None:
        flagged = speeds.withColumn("touches_coast", F.lit(False))
    else:
        flagged = with_touch_flag(
            speeds, "linestring", coast, "geom", "touches_coast", geodesic=geodesic
        )
    return conform(_with_bins(flagged), SEGMENTS)


def build_segments_legacy(
    messages: DataFrame, vessels: DataFrame, since: dt.datetime, *, slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Earlier form: calculated speed first, speeds not rounded, no region or coast."""
    pairs = _registered_pairs(messages, vessels, since, slice_hours)
    speeds = (
        _measures(pairs, digits=None)
        .withColumn(
            "final_speed_knots",
            final_speed_legacy(
                F.col("speed_knots"), F.col("calculated_knots"), F.col("implied_speed_knots")
            ),
        )
        .withColumn("lead_lon", F.col("next.lon"))
        .withColumn("lead_lat", F.col("next.lat"))
    )
    return conform(_with_bins(speeds), SEGMENTS_LEGACY)


def build_segments_simple(
    messages: DataFrame, registry: DataFrame, *, slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Earliest form: a message's own speeds, all registry columns, 10 km at most.

    All messages of known ships are numbered; the tonnage filter comes afterwards. Only the
    start, tonnage and hash of a message's registry row go along its time line; the other
    registry columns join the segments that are left.
    """
    entries = registry.withColumn("_entry", F.xxhash64(*registry.columns))
    known = messages.join(entries.select("mmsi", "start_date", "gt", "_entry"), "mmsi")
    pairs = measured(
        point_pairs(known, carry=["timestamp", "lon", "lat"], slice_hours=slice_hours)
    )
    kept = pairs.where(is_segment(REACH_SIMPLE) & (F.col("gt") >= MIN_GROSS_TONNAGE))
    return conform(
        kept.drop("start_date")
        .join(entries.drop("gt").dropDuplicates(["mmsi", "_entry"]), ["mmsi", "_entry"])
        .withColumn("date_diff_minutes", elapsed("MINUTE"))
        .withColumn("distance", num(F.col("metres")))
        .withColumn("linestring", F.array("point", "next_point")),
        SEGMENTS_SIMPLE,
    )


def _registered_pairs(
    messages: DataFrame, registry: DataFrame, since: dt.datetime, slice_hours: int | Slices
) -> DataFrame:
    joined = join_registry(newer(messages, since), registry)
    return measured(
        point_pairs(
            joined,
            carry=["timestamp", "lon", "lat", "speed_knots", "implied_speed_knots"],
            slice_hours=slice_hours,
        )
    ).where(is_segment())


def _measures(pairs: DataFrame, digits: int | None) -> DataFrame:
    def reported(name: str) -> Column:
        speed = F.col(f"next.{name}")
        return num(speed) if digits is None else rounded(speed, digits)

    metres = F.col("metres")
    return pairs.select(
        "timestamp",
        F.to_date("timestamp").alias("date"),
        "mmsi",
        "num",
        F.col("timestamp").alias("timestamp_beg"),
        F.col("next.timestamp").alias("timestamp_end"),
        reported("speed_knots").alias("speed_knots"),
        reported("implied_speed_knots").alias("implied_speed_knots"),
        calculated_knots(metres, elapsed("MILLISECOND")).alias("calculated_knots"),
        rounded(metres / 1000.0, 5).alias("distance_km"),
        rounded(metres * M_TO_NM, 5).alias("distance_nm"),
        rounded(elapsed("SECOND") / 60.0, 2).cast("double").alias("segment_time_minutes"),
        "lon",
        "lat",
        *(["source", "region"] if "region" in pairs.columns else ["source"]),
        num(F.col("gt")).alias("gt"),
        "point",
        F.array("point", "next_point").alias("linestring"),
        "next",
    )


def _with_bins(segments: DataFrame) -> DataFrame:
    return segments.withColumns(
        {
            "speed_bin_num": speed_bin(F.col("speed_knots")),
            "implied_speed_bin_num": speed_bin(F.col("implied_speed_knots")),
            "calculated_speed_bin_num": speed_bin(F.col("calculated_knots")),
            "final_speed_bin_num": speed_bin(F.col("final_speed_knots")),
        }
    )
