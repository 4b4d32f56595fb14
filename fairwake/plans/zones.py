"""Stage 4: segments and runs in seasonal speed-reduction zones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.functions import geo
from fairwake.operators.spatial import (
    CELL_COLUMNS,
    Index,
    is_whole,
    join_polygons,
    stored_index,
    with_clip,
)
from fairwake.plans.segments import newer
from fairwake.schemas import MULTILINE


def zone_index(zones: DataFrame, *, geodesic: bool = True) -> Index:
    """The zones' index, built once for a layer and stored."""
    named = zones.withColumnRenamed("region", "vsr_region")
    attributes = [c for c in named.columns if c != "geog"]
    return stored_index(named, "geog", attributes, geodesic=geodesic)


def segments_in_zones(
    segments: DataFrame, zones: DataFrame, *, geodesic: bool = True
) -> DataFrame:
    """One row per segment and zone it meets while its start lies in the season.

    Adds the zone's columns, `vsr_linestring` (the part within the zone, several lines
    where the segment leaves and comes back) and `covered`.
    """
    in_season = "timestamp between datetime_beg and datetime_end"
    index = zone_index(zones, geodesic=geodesic)
    met = join_polygons(segments, "linestring", index, in_season)
    return (
        with_clip(met, "linestring", "vsr_linestring")
        .withColumn("vsr_linestring", F.col("vsr_linestring").cast(MULTILINE))
        .withColumn("covered", F.expr(is_whole("vsr_linestring", "linestring")))
        .drop(*CELL_COLUMNS, "inside", "edges")
    )


def clip_to_zones(
    segments: DataFrame, zones: DataFrame, since: dt.datetime | None, *, geodesic: bool = True
) -> DataFrame:
    """Segments after the watermark within zones: the segment columns, then the zone's."""
    fresh = segments if since is None else newer(segments, since)
    found = segments_in_zones(fresh, zones, geodesic=geodesic)
    return found.select(*segments.columns, "vsr_category", "vsr_region", "vsr_linestring")


def last_season_end(zones: DataFrame, as_date: bool = False) -> DataFrame:
    """One row with the end of the latest season."""
    end = F.max(F.to_date("datetime_end") if as_date else F.col("datetime_end"))
    return zones.agg(end.alias("_last_end"))


def clip_to_zones_legacy(
    segments: DataFrame, zones: DataFrame, since: dt.datetime, *, geodesic: bool = True
) -> DataFrame:
    """Earlier form: also bounded by the end of the latest season, and without region."""
    bounded = newer(segments, since).join(
        F.broadcast(last_season_end(zones)), F.col("timestamp") <= F.col("_last_end")
    )
    found = segments_in_zones(bounded.drop("_last_end"), zones, geodesic=geodesic)
    return found.select(*segments.columns, "vsr_category", "vsr_linestring")


SEASON = ["datetime_beg", "datetime_end"]
# Run numbers restart with each load, so the times are part of what tells runs apart.
RUN_KEY = ["mmsi", "date", "seg_id", "speed_bin_num", "timestamp_beg", "timestamp_end"]


def clip_runs_to_zones(
    runs: DataFrame, zones: DataFrame, since: dt.datetime, *, geodesic: bool = True
) -> DataFrame:
    """Runs that lie in a zone's season as a whole and meet the zone.

    Each run's geometry is taken apart into its two-point lines, which find their zones
    as segments do; the parts found are put together again per run and zone, and only
    then is the run's own row joined to them. Rows that repeat a run each get its parts.
    """
    in_season = "timestamp_end <= datetime_end and timestamp_beg >= datetime_beg"
    bounded = (
        runs.where(F.col("date") > F.lit(since.date()))
        .join(F.broadcast(last_season_end(zones, as_date=True)), F.col("date") <= F.col("_last_end"))
        .drop("_last_end")
    )
    lines = (
        bounded.select(*RUN_KEY, F.posexplode("geom").alias("_path", "_points")).select(
            *RUN_KEY, "_path", F.posexplode(_two_point_lines("_points")).alias("_hop", "line")
        )
    )
    # Equal zones are counted and their rows repeated at the end.
    distinct = zones.groupBy(*zones.columns).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    zone_row = ["vsr_category", "vsr_region", *SEASON, "_zone", "_copies"]
    numbered = distinct.withColumn("_zone", F.xxhash64(*zones.columns))
    index = zone_index(numbered, geodesic=geodesic)
    met = join_polygons(lines, "line", index, in_season)
    # A line that only touches a zone keeps its run there, with no part.
    parts = with_clip(met, "line", "_parts").withColumn("_part", F.explode_outer("_parts"))
    hop = F.struct(
        "_path",
        "_hop",
        F.expr(geo.first("_part")).alias("beg"),
        F.expr(geo.second("_part")).alias("end"),
    )
    hops = parts.groupBy(*RUN_KEY, *zone_row).agg(
        F.collect_set(F.when(F.col("_part").isNotNull(), hop)).alias("_hops")
    )
    found = geo.with_chained(hops, "_hops", "vsr_geom").select(
        *[F.col(c).alias(f"_{c}") for c in RUN_KEY],
        "vsr_category",
        "vsr_region",
        F.coalesce(F.col("vsr_geom"), F.array()).cast(MULTILINE).alias("vsr_geom"),
        F.explode(F.array_repeat("_zone", F.col("_copies"))).alias("_repeated"),
    )
    same_run = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in RUN_KEY]
    return bounded.join(found, same_run).select(
        *runs.columns, "vsr_category", "vsr_region", "vsr_geom"
    )


def _two_point_lines(points: str) -> Column:
    line = f"array(get({points}, i - 1), get({points}, i))"
    return F.expr(f"transform(sequence(1, size({points}) - 1), i -> {line})")
