"""High-watermark loads: each run takes what is newer than the table and appends it.

The order within a run is: read the watermark, log it, write the load, log the new
newest timestamp. A watermark is taken from complete loads only (see `sources.tables`), so
a run that died half-way is simply run again: it starts from the same watermark, has the
same load id and replaces what the lost one left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwake import schemas
from fairwake.sources import tables

# How far back each table is searched for its newest row, from today and
# from the watermark of the load before.
DAYS_28 = relativedelta(days=28)
DAYS_30 = relativedelta(days=30)
MONTHS_8 = relativedelta(months=8)
LOG_DAYS_21 = relativedelta(days=21)


@dataclass(frozen=True)
class Loaded:
    """A table that grows by loads."""

    name: str
    schema: T.StructType
    newest: str
    cluster: list[str]
    look_back: relativedelta
    log_look_back: relativedelta = LOG_DAYS_21
    day_of: str = "timestamp"

    def day(self) -> Column:
        return F.col("date") if self.day_of == "date" else F.to_date(self.day_of)


MESSAGES = Loaded("ais_data", schemas.MESSAGES, "timestamp", ["mmsi", "region"], DAYS_28)
SEGMENTS = Loaded(
    "ais_segments", schemas.SEGMENTS, "timestamp_end", ["mmsi", "region", "timestamp"], DAYS_28
)
RUNS = Loaded(
    "ais_segments_agg",
    schemas.RUNS,
    "timestamp_end",
    ["mmsi", "seg_id", "region"],
    DAYS_30,
    day_of="date",
)
ZONE_SEGMENTS = Loaded(
    "ais_vsr_segments",
    schemas.ZONE_SEGMENTS,
    "timestamp_end",
    ["mmsi", "vsr_region", "timestamp"],
    MONTHS_8,
    MONTHS_8,
)


def recent(rows: DataFrame, day: str, today: dt.date, look_back: relativedelta) -> DataFrame:
    """Rows of days after today minus the look-back; prunes day directories."""
    return rows.where(F.col(day) > F.lit(today - look_back))


def newest(rows: DataFrame, column: str) -> DataFrame:
    """One row with the newest timestamp, NULL if there are no rows."""
    return rows.agg(F.max(column).alias("newest_timestamp"))


def newest_or(rows: DataFrame, column: str, default: dt.datetime) -> DataFrame:
    """One row with the newest timestamp, or the default if there are no rows."""
    fallback = F.lit(default).cast("timestamp")
    return rows.agg(F.coalesce(F.max(column), fallback).alias("newest_timestamp"))


def watermark(
    spark: SparkSession,
    path: str,
    table: Loaded,
    today: dt.date,
    default: dt.datetime,
    log: str | None = None,
) -> dt.datetime:
    """Newest timestamp of a table's complete loads; the default if it has none.

    It is looked for among the days of the look-back. Where they hold nothing, as between
    two seasons, the load log knows it; only without a log the whole table is searched.
    """
    first_day = today - table.look_back + dt.timedelta(days=1)
    searched = [lambda: newest(tables.scan_table(spark, path, table.schema, first_day), table.newest)]
    if log is not None and tables.exists(spark, log):
        closed = spark.read.schema(schemas.LOAD_LOG).parquet(log).where(
            (F.col("table_name") == table.name) & (F.col("query_exec") == "query_end")
        )
        searched.append(lambda: newest(closed, "newest_timestamp"))
    else:
        searched.append(
            lambda: newest(tables.scan_table(spark, path, table.schema, tables.EVERY_DAY), table.newest)
        )
    for search in searched:
        # Read as microseconds: a timestamp would come back in the driver's time zone.
        micros = search().select(F.unix_micros("newest_timestamp")).first()[0]
        if micros is not None:
            return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)
    return default


def load(
    spark: SparkSession,
    folder: str,
    table: Loaded,
    build: Callable[[dt.datetime], DataFrame],
    *,
    today: dt.date,
    default_since: dt.datetime,
    log: str | None = None,
) -> dt.datetime:
    """Append what `build` returns for the table's watermark; returns that watermark."""
    path = f"{folder}/{table.name}"
    since = watermark(spark, path, table, today, default_since, log)
    if log is not None:
        write_log(spark.range(1).select(F.lit(since).alias("newest_timestamp")), log, table.name, "query_start")
    tables.append_load(
        build(since), path, tables.load_id(since), table.schema, day=table.day(), cluster=table.cluster
    )
    if log is not None:
        rows = tables.scan_table(
            spark,
            path,
            table.schema,
            first_day=(since - table.log_look_back).date() + dt.timedelta(days=1),
        )
        write_log(newest(rows, table.newest), log, table.name, "query_end")
    return since


def write_log(newest_row: DataFrame, path: str, table_name: str, phase: str) -> None:
    entry = newest_row.select(
        "newest_timestamp",
        F.current_timestamp().alias("date_accessed"),
        F.lit(table_name).alias("table_name"),
        F.lit(phase).alias("query_exec"),
    )
    tables.append_rows(schemas.conform(entry, schemas.LOAD_LOG), path)


def stats_entry(scorecard: DataFrame, table_name: str) -> DataFrame:
    """One log row about a rebuilt scorecard."""
    has_date = "date" in scorecard.columns
    newest_date = F.max("date") if has_date else F.to_date(F.max("max_timestamp"))
    entry = scorecard.agg(
        F.max("max_timestamp").alias("newest_timestamp"), newest_date.alias("newest_date")
    ).select(
        "*",
        F.current_timestamp().alias("date_accessed"),
        F.lit(table_name).alias("table_name"),
    )
    return schemas.conform(entry, schemas.STATS_LOG)


def freshness_entries(sources: list[tuple[str, DataFrame, str, str, relativedelta]], today: dt.date) -> DataFrame:
    """One row per (table name, rows, newest column, day column, look-back)."""
    rows = [
        newest(recent(frame, day, today, look_back), column).select(
            "newest_timestamp",
            F.current_timestamp().alias("date_accessed"),
            F.lit(name).alias("table_name"),
        )
        for name, frame, column, day, look_back in sources
    ]
    return schemas.conform(tables.union(rows), schemas.FRESHNESS_LOG)
