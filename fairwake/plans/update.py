"""One run of the whole pipeline: four loads, then six rebuilt scorecards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from fairwake import schemas
from fairwake.operators.ordered import Slices, counted_slices
from fairwake.plans import fleets, runs, segments, ships, zones
from fairwake.plans.ingest import ingest
from fairwake.sources import tables
from fairwake.streaming import incremental

# Where a table starts when it has no recent rows.
FIRST_MESSAGE = dt.datetime(2017, 1, 1, tzinfo=dt.timezone.utc)
FIRST_SEGMENT = dt.datetime(1990, 1, 1, tzinfo=dt.timezone.utc)
# Sort columns of the scorecard files.
CLUSTERS = {
    "ship_stats_daily": ["mmsi", "operator", "coop_score_daily", "rolling_coop_score"],
    "ship_stats_monthly": ["mmsi", "operator", "coop_score_monthly", "vsr_region"],
    "ship_stats_annual": ["mmsi", "operator", "coop_score_annual", "vsr_region"],
    "operator_stats_daily": ["operator", "operator_ship_categories", "date", "coop_score_daily"],
    "operator_stats_monthly": ["operator", "operator_ship_categories", "month", "coop_score_monthly"],
    "operator_stats_annual": ["operator", "operator_ship_categories", "year", "coop_score_annual"],
}
LOAD_LOG, STATS_LOG = "load_log", "stats_log"


def update(
    spark: SparkSession,
    folder: str,
    *,
    source: DataFrame,
    registry: DataFrame,
    coast: DataFrame,
    zone_table: DataFrame,
    categories: DataFrame,
    today: dt.date,
) -> None:
    """Bring every table below `folder` up to date.

    Each stage reads the tables of the stages before it, so no stage recomputes another
    and a failed run continues at the stage it stopped in.
    """
    update_loads(
        spark, folder, source=source, registry=registry, coast=coast, zone_table=zone_table, today=today
    )
    update_scorecards(spark, folder, registry=registry, categories=categories)


def update_loads(
    spark: SparkSession,
    folder: str,
    *,
    source: DataFrame,
    registry: DataFrame,
    coast: DataFrame,
    zone_table: DataFrame,
    today: dt.date,
) -> None:
    log = f"{folder}/{LOAD_LOG}"

    def stored(table: incremental.Loaded, since: dt.datetime) -> DataFrame:
        return tables.scan_table(spark, f"{folder}/{table.name}", table.schema, since.date())

    def run(table: incremental.Loaded, build, default: dt.datetime) -> None:
        incremental.load(
            spark, folder, table, build, today=today, default_since=default, log=log
        )

    run(incremental.MESSAGES, lambda since: ingest(source, since), FIRST_MESSAGE)
    def sliced(rows: DataFrame, since: dt.datetime) -> Slices:
        return counted_slices(segments.newer(rows, since), "mmsi", "timestamp")

    def new_segments(since: dt.datetime) -> DataFrame:
        rows = stored(incremental.MESSAGES, since)
        return segments.build_segments(rows, registry, coast, since, slice_hours=sliced(rows, since))

    def new_runs(since: dt.datetime) -> DataFrame:
        rows = stored(incremental.SEGMENTS, since)
        return runs.build_runs(rows, since, slice_hours=sliced(rows, since))

    run(incremental.SEGMENTS, new_segments, FIRST_SEGMENT)
    run(incremental.RUNS, new_runs, FIRST_MESSAGE)
    run(
        incremental.ZONE_SEGMENTS,
        lambda since: zones.clip_to_zones(stored(incremental.SEGMENTS, since), zone_table, since),
        FIRST_SEGMENT,
    )


def update_scorecards(
    spark: SparkSession, folder: str, *, registry: DataFrame, categories: DataFrame
) -> None:
    """Rebuild all scorecards from the zone segments; the daily one feeds the others."""

    def rebuild(name: str, scorecard: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        tables.rebuild(scorecard, path, CLUSTERS[name])
        stored = tables.scan_rebuilt(spark, path, scorecard.schema)
        tables.append_rows(incremental.stats_entry(stored, name), f"{folder}/{STATS_LOG}")
        return stored

    zone_segments = tables.scan_table(
        spark,
        f"{folder}/{incremental.ZONE_SEGMENTS.name}",
        schemas.ZONE_SEGMENTS,
        FIRST_SEGMENT.date(),
    )
    daily = rebuild("ship_stats_daily", ships.ship_daily(zone_segments, registry, categories))
    rebuild("ship_stats_monthly", ships.ship_monthly(daily))
    rebuild("ship_stats_annual", ships.ship_annual(daily))
    rebuild("operator_stats_daily", fleets.operator_daily(daily))
    rebuild("operator_stats_monthly", fleets.operator_monthly(daily))
    rebuild("operator_stats_annual", fleets.operator_annual(daily))
