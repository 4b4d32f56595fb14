"""Stage 3: neighbouring segments of one speed class to runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.functions import geo
from fairwake.functions.numeric import mean, num, rounded
from fairwake.functions.simplify import with_straightened
from fairwake.functions.speed import (
    M_TO_NM,
    calculated_knots,
    speed_bin,
    speed_choice_legacy,
    speed_choice_legacy_2,
)
from fairwake.operators.joins import join_registry
from fairwake.operators.ordered import SLICE_HOURS, Slices, sliced, with_changes
from fairwake.plans.segments import elapsed, newer, point_pairs
from fairwake.schemas import RUNS, RUNS_LEGACY, conform

RUN_KEYS = ["mmsi", "date", "seg_id", "final_speed_bin_num", "touches_coast", "region"]
# Numbers start anew with each load, so the end time decides between loads.
SEGMENT_ORDER = ["timestamp", "num", "timestamp_end"]
# What runs need of a segment, apart from its line.
SEGMENT_COLUMNS = [
    *[c for c in RUN_KEYS if c != "seg_id"],
    *SEGMENT_ORDER,
    "timestamp_beg",
    "speed_knots",
    "implied_speed_knots",
    "calculated_knots",
    "final_speed_knots",
    "distance_nm",
    "segment_time_minutes",
]
RUN_KEYS_LEGACY = ["seg_id", "mmsi", "date", "speed_bin_num"]

# Fixed values of the earlier form: longest time span with a geometry, and the
# exclusive bounds of a run's distance.
LONGEST_SPAN_MINUTES = 120
LONGEST_RUN_NM = 100


def off_coast(segments: DataFrame) -> DataFrame:
    """Segments known not to touch the coast."""
    return segments.where(~F.coalesce("touches_coast", F.lit(True)))


def numbered_runs(segments: DataFrame, *, slice_hours: int | Slices = SLICE_HOURS) -> DataFrame:
    """Add `seg_chg`, `segid` and `seg_id` along each vessel's segments.

    A segment before a change of class closes its run, so it keeps the run's number. A
    vessel with a single segment has no number.
    """
    rows = sliced(segments, "mmsi", "timestamp", slice_hours)
    counted = with_changes(
        rows, "mmsi", SEGMENT_ORDER, "final_speed_bin_num", peers=["timestamp"]
    )
    return counted.withColumn("seg_id", run_number())


def run_number() -> Column:
    closes = F.coalesce(F.col("seg_chg") == 1, F.lit(False))
    return F.when(closes, F.col("segid") - 1).otherwise(F.col("segid"))


def run_measures() -> dict[str, Column]:
    """Aggregates of a run, all of them combined before the shuffle."""
    return {
        "avg_speed_knots": rounded(mean(F.col("speed_knots")), 2),
        "avg_implied_speed_knots": rounded(mean(F.col("implied_speed_knots")), 2),
        "avg_calculated_knots": rounded(mean(F.col("calculated_knots")), 2),
        "avg_speed_knots_final": rounded(mean(F.col("final_speed_knots")), 2),
        "total_distance_nm": rounded(F.sum("distance_nm"), 2),
        "seg_min": num(F.sum(num(F.col("segment_time_minutes")))),
        "unix_beg": F.unix_seconds(F.min("timestamp_beg")),
        "unix_end": F.unix_seconds(F.max("timestamp_end")),
        "timestamp_beg": F.min("timestamp_beg"),
        "timestamp_end": F.max("timestamp_end"),
    }


def run_lines(line: str) -> Column:
    """Aggregate: a run's lines, to be put in time order and chained into paths.

    The result holds every line of one vessel, day and run: the run's own geometry.
    """
    hop = F.struct(
        F.col("timestamp"),
        F.expr(geo.first(line)).alias("beg"),
        F.expr(geo.second(line)).alias("end"),
    )
    return F.collect_list(F.when(F.col(line).isNotNull(), hop))


def speed_runs(
    segments: DataFrame, since: dt.datetime, *, slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Runs without geometry."""
    fresh = off_coast(newer(segments, since)).select(*SEGMENT_COLUMNS)
    runs = numbered_runs(fresh, slice_hours=slice_hours)
    return _aggregated(runs, run_measures())


def run_geometries(
    segments: DataFrame, since: dt.datetime, *, slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Runs with `paths`, their geometry as it comes, and `npts`, its number of points."""
    fresh = off_coast(newer(segments, since)).select(*SEGMENT_COLUMNS, "linestring")
    runs = numbered_runs(fresh, slice_hours=slice_hours)
    collected = _aggregated(runs, run_measures() | {"hops": run_lines("linestring")})
    chained = geo.with_chained(collected, "hops", "paths")
    return chained.withColumn("npts", geo.point_count("paths"))


def build_runs(
    segments: DataFrame, since: dt.datetime, *, slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Runs of off-coast segments per vessel and day, with straightened geometry."""
    runs = run_geometries(segments, since, slice_hours=slice_hours)
    return conform(with_straightened(runs, "paths", "geom"), RUNS)


def _aggregated(runs: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return (
        runs.groupBy(*RUN_KEYS)
        .agg(*[c.alias(name) for name, c in measures.items()])
        .withColumnRenamed("final_speed_bin_num", "speed_bin_num")
    )


def choose_speeds_legacy(pairs: DataFrame) -> DataFrame:
    """Distance, speeds and class of each message's way to the next one, earlier form."""
    metres = F.expr(geo.haversine_m("point", "next_point"))
    return (
        pairs.withColumn("calculated_knots", calculated_knots(metres, elapsed("MILLISECOND")))
        .withColumn("distance_nm", metres * M_TO_NM)
        .withColumn("speed_knots_1", speed_choice_legacy(F.col("implied_speed_knots")))
        .withColumn(
            "speed_knots_2",
            speed_choice_legacy_2(F.col("calculated_knots"), F.col("speed_knots_1")),
        )
        .withColumn("speed_bin_num", speed_bin(F.col("speed_knots_2"), unknown=None))
        .withColumn("date", F.to_date("timestamp"))
    )


def numbered_runs_legacy(
    messages: DataFrame, vessels: DataFrame, since: dt.datetime, *, slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Run numbers straight from messages, counted row by row along each vessel."""
    joined = join_registry(newer(messages, since), vessels)
    pairs = point_pairs(joined, carry=["timestamp", "lon", "lat"], slice_hours=slice_hours)
    chosen = choose_speeds_legacy(pairs).withColumn("timestamp_end", F.col("next.timestamp"))
    marked = with_changes(chosen, "mmsi", ["timestamp", "num"], "speed_bin_num")
    return marked.withColumn("seg_id", run_number())


def build_runs_legacy(
    messages: DataFrame, vessels: DataFrame, since: dt.datetime, *, slice_hours: int | Slices = SLICE_HOURS
) -> DataFrame:
    """Earlier form of runs: gaps are bridged, and a geometry exists up to two hours."""
    rows = numbered_runs_legacy(messages, vessels, since, slice_hours=slice_hours)
    line = F.when(F.col("next_point").isNotNull(), F.array("point", "next_point"))
    seconds = F.timestamp_diff("SECOND", F.min("timestamp"), F.max("timestamp_end"))
    runs = (
        rows.withColumn("line", line)
        .groupBy(*RUN_KEYS_LEGACY)
        .agg(
            rounded(mean(F.col("speed_knots")), 2).alias("avg_speed_knots"),
            rounded(mean(F.col("implied_speed_knots")), 2).alias("avg_implied_speed_knots"),
            rounded(mean(F.col("calculated_knots")), 2).alias("avg_calculated_knots"),
            rounded(mean(F.col("speed_knots_1")), 2).alias("avg_speed_knots_1"),
            rounded(mean(F.col("speed_knots_2")), 2).alias("avg_speed_knots_final"),
            rounded(F.sum(num(F.col("distance_nm"))), 2).alias("total_distance_nm"),
            rounded(seconds / 60.0, 2).alias("seg_min"),
            F.unix_seconds(F.min("timestamp")).alias("unix_beg"),
            F.unix_seconds(F.max("timestamp_end")).alias("unix_end"),
            F.min("timestamp").alias("timestamp_beg"),
            F.max("timestamp_end").alias("timestamp_end"),
            F.when(seconds / 60.0 <= LONGEST_SPAN_MINUTES, run_lines("line")).alias("hops"),
        )
    )
    chained = geo.with_chained(runs, "hops", "geom")
    kept = chained.withColumn("npts", geo.point_count("geom")).where(
        (F.col("npts") > 1)
        & F.col("geom").isNotNull()
        & (F.col("total_distance_nm") > 0)
        & (F.col("total_distance_nm") < LONGEST_RUN_NM)
    )
    return conform(kept, RUNS_LEGACY)
