"""Column types and table schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough for sums over years of distances, and narrow enough that dividing
# two of them keeps 18 decimals instead of falling back to 6.
NUM = T.DecimalType(20, 9)

POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
LINE = T.ArrayType(POINT)
MULTILINE = T.ArrayType(LINE)
POLYGON = T.ArrayType(LINE)  # rings, the outer ring first


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


L, D, S, B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()

MESSAGES = _schema(
    mmsi=L, timestamp=TS, lon=D, lat=D, speed_knots=NUM, implied_speed_knots=NUM, source=S, region=S
)

MESSAGES_LEGACY = T.StructType([f for f in MESSAGES.fields if f.name != "region"])

SEGMENTS = _schema(
    timestamp=TS, date=DT, mmsi=L, num=L, timestamp_beg=TS, timestamp_end=TS,
    speed_knots=NUM, implied_speed_knots=NUM, calculated_knots=NUM,
    distance_km=NUM, distance_nm=NUM, segment_time_minutes=D,
    lon=D, lat=D, source=S, region=S, gt=NUM, point=POINT, linestring=LINE,
    final_speed_knots=NUM, touches_coast=B,
    speed_bin_num=L, implied_speed_bin_num=L, calculated_speed_bin_num=L, final_speed_bin_num=L,
)

SEGMENTS_LEGACY = _schema(
    timestamp=TS, date=DT, mmsi=L, num=L, timestamp_beg=TS, timestamp_end=TS,
    speed_knots=NUM, implied_speed_knots=NUM, calculated_knots=NUM,
    distance_km=NUM, distance_nm=NUM, segment_time_minutes=D,
    lon=D, lat=D, lead_lon=D, lead_lat=D, source=S, gt=NUM, point=POINT, linestring=LINE,
    final_speed_knots=NUM,
    speed_bin_num=L, implied_speed_bin_num=L, calculated_speed_bin_num=L, final_speed_bin_num=L,
)

SEGMENTS_SIMPLE = _schema(
    timestamp=TS, date_diff_minutes=L, mmsi=L, num=L, speed_knots=NUM, implied_speed_knots=NUM,
    lon=D, lat=D, source=S, distance=NUM, imo_lr_ihs_no=L, name_of_ship=S, callsign=S, shiptype=S,
    length=D, gt=L, operator=S, operator_code=L, point=POINT, linestring=LINE,
)

RUNS = _schema(
    mmsi=L, date=DT, speed_bin_num=L, seg_id=L, avg_speed_knots=NUM, avg_implied_speed_knots=NUM,
    avg_calculated_knots=NUM, avg_speed_knots_final=NUM, total_distance_nm=NUM, seg_min=NUM,
    unix_beg=L, unix_end=L, timestamp_beg=TS, timestamp_end=TS, touches_coast=B, region=S,
    npts=L, geom=MULTILINE,
)

RUNS_LEGACY = _schema(
    mmsi=L, date=DT, speed_bin_num=L, seg_id=L, avg_speed_knots=NUM, avg_implied_speed_knots=NUM,
    avg_calculated_knots=NUM, avg_speed_knots_1=NUM, avg_speed_knots_final=NUM,
    total_distance_nm=NUM, seg_min=NUM, unix_beg=L, unix_end=L, timestamp_beg=TS,
    timestamp_end=TS, geom=MULTILINE, npts=L,
)

ZONE_COLUMNS = _schema(vsr_category=S, vsr_region=S, vsr_linestring=MULTILINE)
ZONE_SEGMENTS = T.StructType(SEGMENTS.fields + ZONE_COLUMNS.fields)

REGISTRY = _schema(
    mmsi=L, imo_lr_ihs_no=L, name_of_ship=S, callsign=S, shiptype=S, length=D, gt=L,
    group_owner=S, technical_manager=S, ship_manager=S, registered_owner=S,
    operator=S, operator_code=L, start_date=DT, end_date=DT,
)

LOAD_LOG = _schema(newest_timestamp=TS, date_accessed=TS, table_name=S, query_exec=S)
STATS_LOG = _schema(newest_timestamp=TS, newest_date=DT, date_accessed=TS, table_name=S)
FRESHNESS_LOG = _schema(newest_timestamp=TS, date_accessed=TS, table_name=S)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, in order, with the declared types."""
    def typed(f: T.StructField) -> Column:
        same = df.schema[f.name].dataType == f.dataType
        return F.col(f.name) if same else F.col(f.name).cast(f.dataType).alias(f.name)

    return df.select([typed(f) for f in schema.fields])
