"""The registered queries: every operator run over the driver's tables as a whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwake import schemas
from fairwake.functions import area, geo, numeric, simplify, speed, text
from fairwake.operators import joins, ordered
from fairwake.plans import fleets, ingest, runs, segments, ships, update, zones
from fairwake.session import configure
from fairwake.sources import samples, tables
from fairwake.streaming import incremental

UTC = dt.timezone.utc
EVER = dt.datetime(1990, 1, 1, tzinfo=UTC)
# A moment in the middle of the sample month, to split it into two loads.
MIDDLE = dt.datetime(2024, 1, 15, 12, tzinfo=UTC)
# Days on which the look-backs reach the sample month wholly, partly and not at all.
AS_OF = [dt.date(2024, 1, 31), dt.date(2024, 2, 20), dt.date(2024, 4, 1)]

# Integer columns in which values can be missing; they are shown as doubles, because
# table libraries disagree on how to hold a missing integer.
SPARSE_INTEGERS = {
    "ais_ingest": ["mmsi"],
    "ais_ingest_legacy": ["mmsi"],
    "incremental_append": ["mmsi"],
    "create_if_absent": ["mmsi"],
    "load_after_failure": ["mmsi"],
    "safe_cast": ["mmsi"],
    "format_messages": ["mmsi"],
    "left_join_registry": ["mmsi", "gt"],
    "speed_bins_strict": ["speed_bin_num", "implied_speed_bin_num", "shifted_speed_bin_num"],
    "speed_choice_legacy": ["speed_bin_num"],
    "segment_filter": ["minutes"],
    "segment_filter_legacy": ["minutes"],
    "bin_change_flag": ["seg_chg"],
    "sessionize_bins": ["segid", "seg_id"],
    "sessionize_rows": ["seg_chg", "segid", "seg_id"],
    "speed_runs": ["seg_id"],
    "run_npts": ["seg_id"],
    "run_geometry": ["seg_id"],
    "run_tolerance": ["seg_id", "tolerance_m"],
    "run_simplify": ["seg_id"],
    "runs_legacy": ["seg_id", "speed_bin_num"],
    "vsr_runs_join": ["seg_id", "speed_bin_num"],
    "vsr_runs_two_loads": ["seg_id", "speed_bin_num"],
}

Query = Callable[["Chain"], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def plain(df: DataFrame, sparse: list[str]) -> DataFrame:
    """Comparable columns: naive UTC timestamps, doubles for decimals, no geometry."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType) or field.name in sparse:
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.ArrayType, T.StructType)):
            continue
        out.append(column.alias(field.name))
    return df.select(out)


class Chain:
    """The pipeline's stages as lazy DataFrames over one folder of the driver's tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    @cached_property
    def source(self) -> DataFrame:
        return samples.messages_source(self.spark, self.folder)

    @cached_property
    def registry(self) -> DataFrame:
        return samples.registry(self.spark, self.folder)

    @cached_property
    def vessels(self) -> DataFrame:
        return samples.vessel_sizes(self.spark, self.folder)

    @cached_property
    def zones(self) -> DataFrame:
        return samples.zones(self.spark)

    @cached_property
    def coast(self) -> DataFrame:
        return samples.coast(self.spark)

    @cached_property
    def categories(self) -> DataFrame:
        return samples.shiptype_categories(self.spark)

    @cached_property
    def messages(self) -> DataFrame:
        return ingest.ingest(self.source, EVER)

    @cached_property
    def messages_legacy(self) -> DataFrame:
        return ingest.ingest(self.source, EVER, area.AREA_LEGACY, label_region=False)

    @cached_property
    def segments(self) -> DataFrame:
        return segments.build_segments(self.messages, self.registry, self.coast, EVER)

    @cached_property
    def inland_segments(self) -> DataFrame:
        """Segments without the coast test, for what does not read it."""
        return segments.build_segments(self.messages, self.registry, None, EVER)

    @cached_property
    def segments_legacy(self) -> DataFrame:
        return segments.build_segments_legacy(self.messages, self.vessels, EVER)

    @cached_property
    def pairs(self) -> DataFrame:
        joined = joins.join_registry(self.messages, self.registry)
        carry = ["timestamp", "lon", "lat", "speed_knots", "implied_speed_knots"]
        return segments.measured(segments.point_pairs(joined, carry=carry))

    @cached_property
    def pairs_all(self) -> DataFrame:
        known = self.messages.join(self.registry, "mmsi")
        carry = ["timestamp", "lon", "lat"]
        return segments.measured(segments.point_pairs(known, carry=carry))

    @cached_property
    def runs_legacy(self) -> DataFrame:
        return runs.build_runs_legacy(self.messages, self.vessels, EVER)

    @cached_property
    def zone_segments(self) -> DataFrame:
        return zones.clip_to_zones(self.segments, self.zones, None)

    @cached_property
    def registered(self) -> DataFrame:
        return ships.registered_segments(self.zone_segments, self.registry, self.categories)

    @cached_property
    def daily(self) -> DataFrame:
        return ships.ship_daily(self.zone_segments, self.registry, self.categories)

    def scratch(self, name: str) -> str:
        return tables.new_folder(self.spark, name)

    def stored(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows as a table of their own, for what reads them several times."""
        path = self.scratch(name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def two_loads(self) -> str:
        """Folder of a message table loaded up to the middle of the month, then in full."""
        folder = self.scratch("two-loads")
        for source, today in [
            (self.source.where(F.col("date") < F.lit(MIDDLE.date())), MIDDLE.date()),
            (self.source, AS_OF[0]),
        ]:
            incremental.load(
                self.spark,
                folder,
                incremental.MESSAGES,
                lambda since, source=source: ingest.ingest(source, since),
                today=today,
                default_since=EVER,
                log=f"{folder}/{update.LOAD_LOG}",
            )
        return folder


def ends(df: DataFrame, line: str = "linestring") -> DataFrame:
    """Add the end point of a two-point line as columns."""
    end = F.get(F.col(line), F.lit(1))
    return df.withColumn("next_lon", end["lon"]).withColumn("next_lat", end["lat"])


# ---- scans, loads, logs ---------------------------------------------------------


@query
def ais_ingest(c: Chain) -> DataFrame:
    return c.messages


@query
def ais_ingest_legacy(c: Chain) -> DataFrame:
    return c.messages_legacy


@query
def vessel_registry(c: Chain) -> DataFrame:
    return c.registry.select(
        "mmsi", "name_of_ship", "shiptype", "gt", "technical_manager", "operator",
        "operator_code", "start_date", "end_date",
    )


@query
def watermark_lookback(c: Chain) -> DataFrame:
    messages = c.messages.withColumn("date", F.to_date("timestamp"))
    found = [
        incremental.newest(incremental.recent(frame, "date", today, look_back), column).select(
            "newest_timestamp", F.lit(name).alias("table_name"), F.lit(today).alias("as_of")
        )
        for today in AS_OF
        for name, frame, column, look_back in [
            ("ais_data", messages, "timestamp", incremental.DAYS_28),
            ("ais_segments", c.inland_segments, "timestamp_end", incremental.DAYS_28),
            ("ais_vsr_segments", c.zone_segments, "timestamp_end", incremental.MONTHS_8),
        ]
    ]
    return tables.union(found)


@query
def watermark_default(c: Chain) -> DataFrame:
    default = dt.datetime(2020, 1, 1, tzinfo=UTC)
    legacy = zones.clip_to_zones_legacy(c.segments_legacy, c.zones, EVER)
    found = [
        incremental.newest_or(
            incremental.recent(legacy, "date", today, incremental.MONTHS_8), "timestamp", default
        ).select("newest_timestamp", F.lit(today).alias("as_of"))
        for today in [AS_OF[0], dt.date(2025, 1, 1)]
    ]
    return tables.union(found)


@query
def sink_roundtrip(c: Chain) -> DataFrame:
    path = c.scratch("segments")
    table = incremental.SEGMENTS
    tables.append_load(
        c.segments, path, tables.load_id(EVER), table.schema, day=table.day(), cluster=table.cluster
    )
    return ends(tables.scan_table(c.spark, path, table.schema, EVER.date()))


@query
def incremental_append(c: Chain) -> DataFrame:
    path = f"{c.two_loads()}/{incremental.MESSAGES.name}"
    return tables.scan_table(c.spark, path, schemas.MESSAGES, EVER.date())


@query
def load_log(c: Chain) -> DataFrame:
    path = f"{c.two_loads()}/{update.LOAD_LOG}"
    return c.spark.read.schema(schemas.LOAD_LOG).parquet(path).drop("date_accessed")


@query
def scorecard_overwrite(c: Chain) -> DataFrame:
    path = c.scratch("ship-stats-daily")
    cluster = update.CLUSTERS["ship_stats_daily"]
    tables.rebuild(c.daily.where(F.col("date") < F.lit(MIDDLE.date())), path, cluster)
    tables.rebuild(c.daily, path, cluster)
    return tables.scan_rebuilt(c.spark, path, c.daily.schema)


@query
def create_if_absent(c: Chain) -> DataFrame:
    """The second attempt to create the table leaves it as it is."""
    path = c.scratch("created")
    tables.create_once(c.messages, path)
    tables.create_once(c.messages.where("false"), path)
    return c.spark.read.schema(schemas.MESSAGES).parquet(path)


@query
def load_after_failure(c: Chain) -> DataFrame:
    """A load dies after it wrote its last days; the next one starts it over."""
    folder, table = c.scratch("lost-load"), incremental.MESSAGES
    path, lost = f"{folder}/{table.name}", tables.load_id(EVER)
    late = c.messages.where(F.to_date("timestamp") >= F.lit(MIDDLE.date()))
    tables.append_load(late, path, lost, table.schema, day=table.day(), cluster=table.cluster)
    tables.unmark(c.spark, f"{path}/{tables.LOAD}={lost}")
    incremental.load(
        c.spark,
        folder,
        table,
        lambda since: ingest.ingest(c.source, since),
        today=AS_OF[0],
        default_since=EVER,
        log=f"{folder}/{update.LOAD_LOG}",
    )
    return tables.scan_table(c.spark, path, table.schema, EVER.date())


@query
def stats_log(c: Chain) -> DataFrame:
    entries = [
        incremental.stats_entry(scorecard, name)
        for name, scorecard in [
            ("ship_stats_daily", c.daily),
            ("ship_stats_monthly", ships.ship_monthly(c.daily)),
            ("ship_stats_annual", ships.ship_annual(c.daily)),
            ("operator_stats_daily", fleets.operator_daily(c.daily)),
            ("operator_stats_monthly", fleets.operator_monthly(c.daily)),
            ("operator_stats_annual", fleets.operator_annual(c.daily)),
        ]
    ]
    return tables.union(entries).drop("date_accessed")


@query
def freshness_log(c: Chain) -> DataFrame:
    days_14 = incremental.relativedelta(days=14)
    months_8 = incremental.MONTHS_8
    messages = c.messages.withColumn("date", F.to_date("timestamp"))
    zone_segments = zones.clip_to_zones_legacy(c.segments_legacy, c.zones, EVER)
    found_runs = c.stored(c.runs_legacy.select(*zones.RUN_KEY, "geom"), "runs-legacy")
    zone_runs = zones.clip_runs_to_zones(found_runs, c.zones, EVER)
    sources = [
        ("ais_data", messages, "timestamp", "date", days_14),
        ("ais_segments", c.segments_legacy, "timestamp", "date", days_14),
        ("ais_segments_agg", found_runs, "timestamp_end", "date", days_14),
        ("ais_vsr_segments", zone_segments, "timestamp", "date", months_8),
        ("ais_vsr_segments_agg", zone_runs, "timestamp_end", "date", months_8),
    ]
    return incremental.freshness_entries(sources, AS_OF[0]).drop("date_accessed")


# ---- values and predicates ------------------------------------------------------


@query
def safe_cast(c: Chain) -> DataFrame:
    moment = F.col("timestamp").cast("string")
    return c.source.select(
        "ssvid",
        F.col("ssvid").try_cast("bigint").alias("mmsi"),
        "timestamp",
        numeric.num(F.col("speed_knots")).alias("speed_knots"),
        numeric.num(F.col("implied_speed_knots")).alias("implied_speed_knots"),
        moment.try_cast("timestamp").alias("moment"),
        F.concat(F.lit("at "), moment).try_cast("timestamp").alias("no_moment"),
        F.col("source").try_cast("double").alias("no_number"),
    )


@query
def bbox_filter(c: Chain) -> DataFrame:
    lon, lat = F.col("lon"), F.col("lat")
    return c.source.where(area.AREA.contains(lon, lat)).select(
        "ssvid", "timestamp", "lon", "lat", area.AREA_LEGACY.contains(lon, lat).alias("in_small_box")
    )


@query
def region_label(c: Chain) -> DataFrame:
    label = area.region_label(F.col("lon"), F.col("lat"))
    return c.source.select("ssvid", "timestamp", "lon", "lat", label.alias("region"))


@query
def format_messages(c: Chain) -> DataFrame:
    return ingest.format_messages(c.source).where("source = 'spire'")


def _bins(c: Chain, **options) -> DataFrame:
    reported = numeric.num(F.col("speed_knots"))
    implied = numeric.num(F.col("implied_speed_knots"))
    return c.source.select(
        "ssvid",
        "timestamp",
        "speed_knots",
        "implied_speed_knots",
        speed.speed_bin(reported, **options).alias("speed_bin_num"),
        speed.speed_bin(implied, **options).alias("implied_speed_bin_num"),
        speed.speed_bin(reported - 50, **options).alias("shifted_speed_bin_num"),
    )


@query
def speed_bins(c: Chain) -> DataFrame:
    return _bins(c)


@query
def speed_bins_strict(c: Chain) -> DataFrame:
    return _bins(c, unknown=None)


SPEEDS = ["mmsi", "num", "speed_knots", "calculated_knots", "implied_speed_knots", "final_speed_knots"]


@query
def final_speed(c: Chain) -> DataFrame:
    return c.inland_segments.select(SPEEDS)


@query
def final_speed_legacy(c: Chain) -> DataFrame:
    return c.segments_legacy.select(SPEEDS)


@query
def speed_choice_legacy(c: Chain) -> DataFrame:
    joined = joins.join_registry(c.messages, c.vessels)
    pairs = segments.point_pairs(joined, carry=["timestamp", "lon", "lat"])
    return runs.choose_speeds_legacy(pairs).select(
        "mmsi", "num", "calculated_knots", "implied_speed_knots", "speed_knots_1", "speed_knots_2",
        "speed_bin_num",
    )


@query
def grade(c: Chain) -> DataFrame:
    reported = numeric.num(F.col("speed_knots"))
    implied = numeric.num(F.col("implied_speed_knots"))
    return c.source.select(
        "ssvid",
        "timestamp",
        numeric.grade(reported).alias("reported_grade"),
        numeric.grade(implied * 5).alias("implied_grade"),
    )


@query
def segment_filter(c: Chain) -> DataFrame:
    return c.pairs.select(
        "mmsi",
        "num",
        segments.elapsed("MINUTE").alias("minutes"),
        numeric.rounded(F.col("metres"), 3).alias("metres"),
        segments.is_segment().alias("kept"),
    )


@query
def segment_filter_legacy(c: Chain) -> DataFrame:
    large = F.col("gt") >= joins.MIN_GROSS_TONNAGE
    return c.pairs_all.select(
        "mmsi",
        "num",
        segments.elapsed("MINUTE").alias("minutes"),
        (segments.is_segment(segments.REACH_SIMPLE) & large).alias("kept"),
    )


@query
def incremental_filter(c: Chain) -> DataFrame:
    late = segments.build_segments(c.messages, c.registry, None, MIDDLE)
    return late.select("mmsi", "num", "timestamp_beg", "timestamp_end", "distance_nm")


@query
def off_coast_segments(c: Chain) -> DataFrame:
    return runs.off_coast(c.segments).select("mmsi", "num", "timestamp", "touches_coast")


@query
def time_functions(c: Chain) -> DataFrame:
    day = F.to_date("timestamp")
    noon = F.expr("make_timestamp(2024, 1, 10, 12, 0, 0.5)")
    return c.source.select(
        "ssvid",
        "timestamp",
        day.alias("day"),
        day.cast("timestamp").alias("midnight"),
        F.timestamp_diff("MILLISECOND", noon, F.col("timestamp")).alias("millis"),
        F.timestamp_diff("SECOND", noon, F.col("timestamp")).alias("seconds"),
        F.timestamp_diff("MINUTE", noon, F.col("timestamp")).alias("minutes"),
        F.date_sub(day, 28).alias("days_before"),
        F.add_months(day, -8).alias("months_before"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.unix_seconds("timestamp").alias("seconds_since_1970"),
    )


@query
def rounding(c: Chain) -> DataFrame:
    value = F.col("speed_knots") / 7.0
    return c.source.select(
        "ssvid",
        "timestamp",
        *[numeric.rounded(value, n).alias(f"digits_{n}") for n in range(1, 6)],
        numeric.rounded(F.col("speed_knots"), 1).alias("halves"),
    )


@query
def text_functions(c: Chain) -> DataFrame:
    return c.registry.select(
        "mmsi",
        "start_date",
        F.trim("shiptype").alias("trimmed"),
        F.coalesce("start_date", F.lit(dt.date(1900, 1, 1))).alias("start_or_default"),
        numeric.pct_text(F.col("gt") / 51.0, 1).alias("percent_1"),
        numeric.pct_text(F.col("gt") / 50.0, 2).alias("percent_2"),
        F.concat(
            text.month_name(F.month("start_date")), F.lit(" "), F.year("start_date").cast("string")
        ).alias("month_text"),
    )


# ---- joins ----------------------------------------------------------------------


@query
def join_registry(c: Chain) -> DataFrame:
    return joins.join_registry(c.messages, c.registry)


@query
def left_join_registry(c: Chain) -> DataFrame:
    joined = joins.left_join_registry(ingest.format_messages(c.source), c.registry)
    return joined.select(
        "mmsi", "timestamp", "lon", "lat", "source", "name_of_ship", "gt", "operator", "start_date"
    )


@query
def registry_validity_join(c: Chain) -> DataFrame:
    valid = joins.join_valid_registry(c.inland_segments, c.registry)
    return valid.select("mmsi", "num", "timestamp_beg", "timestamp_end", "start_date", "end_date", "operator")


@query
def category_join(c: Chain) -> DataFrame:
    return joins.join_category(c.registry, c.categories).select(
        "mmsi", "start_date", "shiptype", "ship_category"
    )


# ---- segments -------------------------------------------------------------------


@query
def segment_numbering(c: Chain) -> DataFrame:
    return c.pairs.select("mmsi", "timestamp", "start_date", "num")


@query
def lead_two(c: Chain) -> DataFrame:
    joined = joins.join_registry(c.messages, c.registry)
    rows = ordered.sliced(joined, "mmsi", "timestamp")
    order = segments.time_order(joined)
    speeds = ["speed_knots", "implied_speed_knots"]
    one = ordered.with_next(rows, "mmsi", order, speeds).select(
        *rows.columns, *[F.col(f"next.{s}").alias(f"next_{s}") for s in speeds]
    )
    two = ordered.with_next(one, "mmsi", order, [f"next_{s}" for s in speeds])
    return two.select(
        "mmsi",
        "timestamp",
        "start_date",
        *[f"next_{s}" for s in speeds],
        *[F.col(f"next.next_{s}").alias(f"second_{s}") for s in speeds],
    )


@query
def segment_distance(c: Chain) -> DataFrame:
    return c.pairs.select(
        "mmsi",
        "num",
        numeric.rounded(F.col("metres") / 1000.0, 5).alias("distance_km"),
        numeric.rounded(F.col("metres") * speed.M_TO_NM, 5).alias("distance_nm"),
    )


@query
def calculated_speed(c: Chain) -> DataFrame:
    knots = speed.calculated_knots(F.col("metres"), segments.elapsed("MILLISECOND"))
    return c.pairs.select("mmsi", "num", knots.alias("calculated_knots"))


@query
def touches_coast(c: Chain) -> DataFrame:
    return c.segments.select("mmsi", "num", "touches_coast")


@query
def segments_(c: Chain) -> DataFrame:
    return ends(c.segments)


@query
def segments_legacy(c: Chain) -> DataFrame:
    return c.segments_legacy


@query
def segments_simple(c: Chain) -> DataFrame:
    simple = segments.build_segments_simple(c.messages, c.registry)
    return _known_ship_columns(simple)


def _known_ship_columns(simple: DataFrame) -> DataFrame:
    return ends(simple).drop("imo_lr_ihs_no", "callsign", "length")


# ---- runs -----------------------------------------------------------------------


@query
def bin_change_flag(c: Chain) -> DataFrame:
    numbered = runs.numbered_runs(runs.off_coast(c.segments))
    return numbered.select("mmsi", "num", "final_speed_bin_num", "seg_chg")


@query
def sessionize_bins(c: Chain) -> DataFrame:
    numbered = runs.numbered_runs(runs.off_coast(c.segments))
    return numbered.select("mmsi", "num", "timestamp", "segid", "seg_id")


@query
def sessionize_rows(c: Chain) -> DataFrame:
    numbered = runs.numbered_runs_legacy(c.messages, c.vessels, EVER)
    return numbered.select("mmsi", "num", "timestamp", "seg_chg", "segid", "seg_id")


@query
def speed_runs(c: Chain) -> DataFrame:
    return runs.speed_runs(c.segments, EVER)


RUN = ["mmsi", "date", "seg_id", "speed_bin_num", "region"]


@query
def run_npts(c: Chain) -> DataFrame:
    found = runs.run_geometries(c.segments, EVER)
    return found.select(*RUN, "npts", F.size("paths").alias("paths"))


@query
def run_geometry(c: Chain) -> DataFrame:
    """Every vertex of every run, in order."""
    return vertices(runs.run_geometries(c.segments, EVER), "paths", RUN)


@query
def run_tolerance(c: Chain) -> DataFrame:
    found = runs.run_geometries(c.segments, EVER)
    chosen = simplify.with_tolerance(found, "paths", "tolerance_m", gap="gap")
    widest = numeric.rounded(F.col("gap"), 3)
    return chosen.select(*RUN, widest.alias("widest_gap_m"), "tolerance_m")


@query
def run_simplify(c: Chain) -> DataFrame:
    """Every vertex of every run's straightened geometry, in order."""
    found = runs.build_runs(c.segments, EVER)
    return vertices(found, "geom", RUN)


@query
def track_simplify(c: Chain) -> DataFrame:
    """Every vessel's positions of a week as one line, simplified to a tolerance that differs by vessel."""
    week = F.to_date(F.date_trunc("week", "timestamp")).alias("week")
    place = F.struct("timestamp", "lon", "lat")
    tracks = (
        c.messages.where("mmsi is not null")
        .groupBy("mmsi", week)
        .agg(F.array_sort(F.collect_list(place)).alias("places"))
        .withColumn("line", F.expr("transform(places, p -> named_struct('lon', p.lon, 'lat', p.lat))"))
        .withColumn("tolerance", F.expr("get(array(1000, 5000, 20000), int(mmsi % 3))"))
    )
    kept = simplify.with_kept_vertices(tracks, "line", "tolerance", "kept")
    line = F.expr("transform(kept, i -> get(line, i))")
    return kept.select("mmsi", "week", F.posexplode(line).alias("vertex", "point")).select(
        "mmsi", "week", "vertex", "point.lon", "point.lat"
    )


def vertices(rows: DataFrame, paths: str, keys: list[str], digits: int | None = None) -> DataFrame:
    """A row for each vertex of a multiline: the keys, path, vertex, lon, lat."""
    each = rows.select(*keys, F.posexplode(paths).alias("path", "points")).select(
        *keys, "path", F.posexplode("points").alias("vertex", "point")
    )
    lon_lat = [F.col(f"point.{c}") for c in ("lon", "lat")]
    if digits is not None:
        lon_lat = [numeric.rounded(c, digits).alias(name) for c, name in zip(lon_lat, ("lon", "lat"))]
    return each.select(*keys, "path", "vertex", *lon_lat)


@query
def runs_legacy(c: Chain) -> DataFrame:
    return c.runs_legacy


# ---- zones ----------------------------------------------------------------------


@query
def vsr_join(c: Chain) -> DataFrame:
    found = zones.segments_in_zones(c.inland_segments, c.zones)
    return found.select("mmsi", "num", "vsr_category", "vsr_region", "datetime_beg", "datetime_end")


@query
def vsr_covered(c: Chain) -> DataFrame:
    found = zones.segments_in_zones(c.inland_segments, c.zones)
    return found.select("mmsi", "num", "vsr_category", "vsr_region", "covered")


@query
def vsr_clip(c: Chain) -> DataFrame:
    found = zones.segments_in_zones(c.inland_segments, c.zones)
    length = geo.length_m("vsr_linestring")
    return found.select(
        "mmsi",
        "num",
        "vsr_category",
        "vsr_region",
        F.size("vsr_linestring").alias("lines"),
        numeric.rounded(length * speed.M_TO_NM, 4).alias("inside_nm"),
    )


@query
def vsr_segments(c: Chain) -> DataFrame:
    return c.zone_segments


@query
def vsr_vertices(c: Chain) -> DataFrame:
    """Every vertex of the parts of segments that lie in their zones."""
    return vertices(c.zone_segments, "vsr_linestring", ZONE_SEGMENT, digits=7)


@query
def vsr_dateline(c: Chain) -> DataFrame:
    """The same with segments and zones moved west, over the 180 degree meridian."""
    moved_segments = c.inland_segments.withColumn("linestring", F.expr(moved("linestring")))
    moved_zones = c.zones.withColumn("geog", F.expr(f"transform(geog, ring -> {moved('ring')})"))
    found = zones.segments_in_zones(moved_segments, moved_zones)
    return vertices(found, "vsr_linestring", ZONE_SEGMENT, digits=6)


ZONE_SEGMENT = ["mmsi", "num", "vsr_category", "vsr_region"]
WEST = 57  # degrees; puts the second zone on both sides of the meridian


def moved(points: str) -> str:
    lon = f"(p.lon - {WEST} + case when p.lon - {WEST} < -180 then 360 else 0 end)"
    return f"transform({points}, p -> {geo.point(lon, 'p.lat')})"


@query
def vsr_join_legacy(c: Chain) -> DataFrame:
    return zones.clip_to_zones_legacy(c.segments_legacy, c.zones, EVER)


@query
def vsr_runs_join(c: Chain) -> DataFrame:
    found = zones.clip_runs_to_zones(c.runs_legacy, c.zones, EVER)
    return found.withColumn(
        "inside_nm", numeric.rounded(geo.length_m("vsr_geom") * speed.M_TO_NM, 4)
    )


@query
def vsr_runs_two_loads(c: Chain) -> DataFrame:
    """Runs of two loads that meet at noon, so both number their runs of that day from 0."""
    noon = F.lit(MIDDLE).cast("timestamp")
    halves = [c.source.where(F.col("timestamp") < noon), c.source.where(F.col("timestamp") >= noon)]
    loads = [runs.build_runs_legacy(ingest.ingest(half, EVER), c.vessels, EVER) for half in halves]
    found = zones.clip_runs_to_zones(tables.union(loads), c.zones, EVER)
    return found.withColumn(
        "inside_nm", numeric.rounded(geo.length_m("vsr_geom") * speed.M_TO_NM, 4)
    )


@query
def chain_legacy(c: Chain) -> DataFrame:
    simple = segments.build_segments_simple(c.messages_legacy, c.registry)
    found = zones.segments_in_zones(simple, c.zones)
    return _known_ship_columns(found.select(*simple.columns, "vsr_category"))


# ---- scorecards -----------------------------------------------------------------


@query
def ship_daily_distances(c: Chain) -> DataFrame:
    days = ships.ship_days(c.registered)
    return days.select("mmsi", "date", "vsr_region", *ships.distance_measures())


@query
def ship_daily_extremes(c: Chain) -> DataFrame:
    extremes = ships.extreme_measures()
    days = ships.ship_days(c.registered, extremes)
    return days.select("mmsi", "date", "vsr_region", *extremes)


@query
def ship_rolling_daily(c: Chain) -> DataFrame:
    days = ships.ship_days(c.registered).withColumn("score", ships.score())
    return days.select(
        "mmsi", "date", "vsr_region", "score", ships.rolling_by_day().alias("rolling_coop_score")
    )


@query
def ship_daily(c: Chain) -> DataFrame:
    return c.daily


@query
def ship_monthly(c: Chain) -> DataFrame:
    return ships.ship_monthly(c.daily)


@query
def ship_annual(c: Chain) -> DataFrame:
    return ships.ship_annual(c.daily)


@query
def operator_daily(c: Chain) -> DataFrame:
    return fleets.operator_daily(c.daily)


@query
def operator_monthly(c: Chain) -> DataFrame:
    return fleets.operator_monthly(c.daily)


@query
def operator_annual(c: Chain) -> DataFrame:
    return fleets.operator_annual(c.daily)


@query
def operator_lists(c: Chain) -> DataFrame:
    rolled = fleets.operator_rollup(c.daily, ["date"])
    return rolled.select(
        "operator", "operator_code", "vsr_region", "date", "ship_count", "mmsi_list", "ship_types",
        "name_of_ships", "ship_categories_list", "operator_ship_categories",
    )


def registered_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(name: str, build: Query) -> Callable[[SparkSession, str], DataFrame]:
        sparse = SPARSE_INTEGERS.get(name, [])
        return lambda spark, folder: plain(build(Chain(spark, folder)), sparse)

    named = {name.rstrip("_"): build for name, build in QUERIES.items()}
    return {name: bound(name, build) for name, build in named.items()}

