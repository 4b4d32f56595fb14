"""Inputs of the pipeline derived from the driver's tables.

Ship messages come from `events`, the vessel registry from `customer` and `nation`.
Zones, coast and ship categories are small fixed dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwake.functions import geo
from fairwake.schemas import REGISTRY, conform

# The polygons as rings of (longitude, latitude).
ZONE_Z1 = [(-121.0, 33.3), (-119.0, 33.3), (-119.0, 34.5), (-121.0, 34.5)]
ZONE_Z2 = [(-124.0, 36.5), (-122.0, 36.5), (-122.5, 38.5), (-124.5, 38.5)]
COAST_1 = [(-120.0, 34.0), (-119.0, 34.0), (-119.0, 34.3), (-120.0, 34.3)]
COAST_2 = [(-123.2, 37.0), (-122.8, 37.0), (-122.8, 37.4), (-123.2, 37.4)]
# Category, region, ring, first and last moment of the season.
ZONES = [
    ("A", "sc", ZONE_Z1, "2024-01-05", "2024-01-20"),
    ("B", "sf", ZONE_Z2, "2024-01-10", "2024-01-25"),
    ("A", "sf", ZONE_Z2, "2024-01-20", "2024-01-30"),
]
CATEGORIES = [
    ("AUTOMOBILE", "CARGO"),
    ("BUILDING", "TANKER"),
    ("FURNITURE", "CARGO"),
    ("HOUSEHOLD", "PASSENGER"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def messages_source(spark: SparkSession, folder: str) -> DataFrame:
    """Raw ship messages: ssvid, timestamp, date, position, speeds, source."""
    return (
        table(spark, folder, "events")
        .selectExpr(
            "event_id",
            "user_id",
            "event_type",
            "value",
            "cast(ts as timestamp) as timestamp",
            "(unix_micros(cast(ts as timestamp)) - 1704067200000000) / 3.6E9 as h",
            "cast(4 + user_id % 17 as double) as kn",
        )
        .selectExpr(
            "*",
            "round(33.3E0 + 5.7E0 - abs(((h*kn/60E0 + user_id*0.41E0) % 11.4E0) - 5.7E0), 6) as lat",
        )
        .selectExpr(
            "concat(cast(366000000 + user_id as string), "
            "case when event_id % 97 = 0 then 'x' else '' end) as ssvid",
            "timestamp",
            "cast(timestamp as date) as date",
            "round(-124.5E0 + (user_id*37 % 100)*0.06E0 - 0.2E0*(lat - 33.3E0), 6) as lon",
            "lat",
            "value as speed_knots",
            "case when event_id % 11 = 0 then null else kn + event_id % 7 - 3 end "
            "as implied_speed_knots",
            "case when event_type in ('view', 'click') then 'spire' else 'orbcomm' end as source",
        )
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Vessel registry; one ship in ten has two validity periods, one in ten has none."""
    ships = (
        table(spark, folder, "customer")
        .where("c_custkey % 13 <> 5")
        .join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
    )
    periods = F.expr(
        """case
             when c_custkey % 10 = 3 then array(
               named_struct('beg', date'2024-01-01', 'end', date'2024-01-15'),
               named_struct('beg', date'2024-01-15', 'end', date'2024-01-31'))
             when c_custkey % 10 = 7 then array(
               named_struct('beg', cast(null as date), 'end', cast(null as date)))
             else array(named_struct('beg', date'2024-01-01', 'end', date'2024-01-31'))
           end"""
    )
    known = ships.withColumn("period", F.explode(periods)).selectExpr(
        "366000000 + c_custkey as mmsi",
        "c_name as name_of_ship",
        "case when c_custkey % 2 = 0 then concat(' ', c_mktsegment) else c_mktsegment end as shiptype",
        "100 + (c_custkey * 97) % 5000 as gt",
        "concat('TM-', cast(c_nationkey % 7 as string)) as technical_manager",
        "n_name as operator",
        "cast(c_nationkey as bigint) as operator_code",
        "period.beg as start_date",
        "period.end as end_date",
    )
    absent = [f for f in REGISTRY.fields if f.name not in known.columns]
    return conform(
        known.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]), REGISTRY
    )


def vessel_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Vessel list with one size per vessel."""
    return registry(spark, folder).groupBy("mmsi").agg(F.max("gt").alias("gt"))


def zones(spark: SparkSession) -> DataFrame:
    return _inline(
        spark,
        [
            F.struct(
                F.lit(category).alias("vsr_category"),
                F.lit(region).alias("region"),
                _polygon(ring).alias("geog"),
                F.lit(beg).cast("timestamp").alias("datetime_beg"),
                F.lit(end).cast("timestamp").alias("datetime_end"),
            )
            for category, region, ring, beg, end in ZONES
        ],
    )


def coast(spark: SparkSession) -> DataFrame:
    return _inline(spark, [F.struct(_polygon(ring).alias("geom")) for ring in (COAST_1, COAST_2)])


def shiptype_categories(spark: SparkSession) -> DataFrame:
    return _inline(
        spark,
        [
            F.struct(F.lit(shiptype).alias("shiptype"), F.lit(category).alias("ship_category"))
            for shiptype, category in CATEGORIES
        ],
    )


def _polygon(ring: list[tuple[float, float]]) -> Column:
    points = ", ".join(geo.point(str(lon), str(lat)) for lon, lat in ring)
    return F.expr(f"array(array({points}))")


def _inline(spark: SparkSession, rows: list[Column]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*rows)))
