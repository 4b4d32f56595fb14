"""Rules of the stages on hand-made messages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fairwake import schemas
from fairwake.functions import geo
from fairwake.plans import fleets, ingest, runs, segments, ships, zones

UTC = dt.timezone.utc
EVER = dt.datetime(1990, 1, 1, tzinfo=UTC)
START = dt.datetime(2024, 1, 10, 12, tzinfo=UTC)
METRE = 1 / 111195.08


def messages(spark, rows):
    """rows: (mmsi, seconds after the start, lon, lat, speed, implied speed)."""
    made = [
        (m, START + dt.timedelta(seconds=s), float(lon), float(lat), v, i, "spire", "sc")
        for m, s, lon, lat, v, i in rows
    ]
    text = "mmsi long, timestamp timestamp, lon double, lat double, speed_knots double, implied_speed_knots double, source string, region string"
    return schemas.conform(spark.createDataFrame(made, text), schemas.MESSAGES)


def registry(spark, rows):
    """rows: (mmsi, gt, start, end)."""
    text = "mmsi long, gt long, start_date date, end_date date"
    df = spark.createDataFrame([(m, g, a, b) for m, g, a, b in rows], text)
    absent = [f for f in schemas.REGISTRY.fields if f.name not in df.columns]
    return schemas.conform(
        df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]), schemas.REGISTRY
    )


DAY_1, DAY_31 = dt.date(2024, 1, 1), dt.date(2024, 1, 31)


def built(spark, rows, ships_=None, since=EVER, **options):
    reg = registry(spark, ships_ or [(1, 300, DAY_1, DAY_31)])
    df = segments.build_segments(messages(spark, rows), reg, None, since, **options)
    return df.orderBy("mmsi", "num").collect()


@pytest.mark.parametrize("seconds, kept", [(119 * 60, 1), (7200, 1), (7259, 1), (7260, 0)])
def test_gap_counts_whole_minutes(spark, seconds, kept):
    rows = [(1, 0, -120, 34, 5.0, None), (1, seconds, -120, 34.01, 5.0, None)]
    assert len(built(spark, rows)) == kept


@pytest.mark.parametrize(
    "metres, kept", [(0, 0), (0.00005, 0), (0.001, 1), (222200, 1), (222300, 0)]
)
def test_distance_bounds(spark, metres, kept):
    rows = [(1, 0, -120, 34, 5.0, None), (1, 600, -120, 34 + metres * METRE, 5.0, None)]
    assert len(built(spark, rows)) == kept


def test_small_and_unregistered_ships_have_no_segments(spark):
    rows = [(m, s, -120, 34 + s / 1e5, 5.0, None) for m in (1, 2, 3) for s in (0, 600)]
    found = built(spark, rows, [(1, 299, DAY_1, DAY_31), (2, 300, DAY_1, DAY_31)])
    assert [r.mmsi for r in found] == [2]


def test_a_segment_has_the_speeds_of_its_end(spark):
    rows = [(1, 0, -120, 34, 1.0, 2.0), (1, 600, -120, 34.01, 3.0, 4.0), (1, 1200, -120, 34.02, 5.0, 6.0)]
    found = built(spark, rows)
    assert [(float(r.speed_knots), float(r.implied_speed_knots)) for r in found] == [(3, 4), (5, 6)]
    assert [r.timestamp_end for r in found] == [r.timestamp_beg + dt.timedelta(minutes=10) for r in found]


def test_two_registry_rows_number_twice_and_leave_one_segment(spark):
    rows = [(1, 0, -120, 34, 1.0, 2.0), (1, 600, -120, 34.01, 3.0, 4.0)]
    found = built(spark, rows, [(1, 400, DAY_1, DAY_31), (1, 500, DAY_1, DAY_31)])
    assert [r.num for r in found] == [2] and float(found[0].gt) == 500.0


def test_equal_times_are_ordered_by_content(spark):
    rows = [(1, 0, -120, 34, 1.0, None), (1, 0, -120, 34.01, 2.0, None), (1, 600, -120, 34.02, 3.0, None)]
    first, second = built(spark, rows), built(spark, rows[::-1])
    assert first == second and len(first) == 2
    assert first[0].calculated_knots is None and first[1].calculated_knots is not None


def test_the_segment_across_two_loads_is_not_formed(spark):
    rows = [(1, 600 * k, -120, 34 + k / 100, 5.0, None) for k in range(5)]
    later = built(spark, rows, since=START + dt.timedelta(seconds=600))
    assert len(built(spark, rows)) == 4 and len(later) == 2


def test_a_single_message_gives_nothing(spark):
    assert built(spark, [(1, 0, -120, 34, 5.0, None)]) == []


def test_slice_width_does_not_change_segments(spark):
    rows = [(1, 431 * k, -120, 34 + k / 1000, 5.0, None) for k in range(120)]
    assert built(spark, rows, slice_hours=1) == built(spark, rows, slice_hours=1000)


def test_simple_segments_keep_zero_distance_and_own_speeds(spark):
    rows = [(1, 0, -120, 34, 1.0, None), (1, 60, -120, 34, 2.0, None), (1, 120, -120, 34.2, 3.0, None)]
    found = segments.build_segments_simple(messages(spark, rows), registry(spark, [(1, 300, DAY_1, DAY_31)]))
    assert [(r.num, float(r.speed_knots), float(r.distance)) for r in found.collect()] == [(1, 1.0, 0.0)]


def test_ingest_loads_whole_days_after_the_watermark(spark):
    source = spark.createDataFrame(
        [
            ("1", dt.datetime(2024, 1, 10, 23, tzinfo=UTC), dt.date(2024, 1, 10), -120.0, 34.0, 5.0, None, "s"),
            ("x", dt.datetime(2024, 1, 11, 1, tzinfo=UTC), dt.date(2024, 1, 11), -120.0, 34.0, 5.0, None, "s"),
            ("2", dt.datetime(2024, 1, 11, 2, tzinfo=UTC), dt.date(2024, 1, 11), -120.0, 33.287, 5.0, 1.0, "s"),
        ],
        "ssvid string, timestamp timestamp, date date, lon double, lat double, speed_knots double, implied_speed_knots double, source string",
    )
    found = ingest.ingest(source, START).orderBy("timestamp").collect()
    assert [(r.mmsi, r.region) for r in found] == [(None, "sc"), (2, "other")]


# ---- runs -----------------------------------------------------------------------


HOPS = "id int, hops array<struct<timestamp:int,beg:struct<lon:double,lat:double>,end:struct<lon:double,lat:double>>>"


def test_hops_are_chained_in_order_and_break_where_they_do_not_meet(spark):
    a, b, c, d = [(float(k), 0.0) for k in range(4)]
    rows = [(1, [(3, c, d), (1, a, b), (2, b, c)]), (2, [(2, c, d), (1, a, b)]), (3, []), (4, None)]
    found = geo.with_chained(spark.createDataFrame(rows, HOPS), "hops", "paths")
    assert found.columns == ["id", "paths"]
    paths = {r.id: r.paths and [[tuple(p) for p in path] for path in r.paths] for r in found.collect()}
    assert paths == {1: [[a, b, c, d]], 2: [[a, b], [c, d]], 3: None, 4: None}


def test_filters_on_chained_hops_do_not_repeat_the_steps(spark):
    """Put into each other, the steps sorted all hops once per hop."""
    found = geo.with_chained(spark.createDataFrame([], HOPS), "hops", "paths")
    many = found.where((geo.point_count("paths") > 1) & F.col("paths").isNotNull())
    for reader in (many, many.select("id", F.posexplode("paths"))):
        plan = reader._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("array_sort(") <= 1


def test_a_run_of_many_messages_is_chained(spark):
    """A message a second and no change of class: sorted once per hop, this took minutes."""
    rows = spark.range(7000).selectExpr(
        "cast(1 as bigint) as mmsi", "timestamp_seconds(1704844800 + id) as timestamp",
        "-120D as lon", "33.5D + id * 1E-5D as lat", "5D as speed_knots", "5D as implied_speed_knots",
        "'spire' as source", "'sc' as region",
    )
    vessels = spark.createDataFrame([(1, 300)], "mmsi long, gt long")
    built = runs.build_runs_legacy(schemas.conform(rows, schemas.MESSAGES), vessels, EVER)
    (run,) = built.selectExpr("size(geom) as paths", "npts").collect()
    assert tuple(run) == (1, 7000)


def segment_rows(spark, bins, *, gap=600, mmsi=1, touching=()):
    rows = [
        (mmsi, k + 1, START + dt.timedelta(seconds=gap * k), START + dt.timedelta(seconds=gap * (k + 1)),
         b, k in touching, [(-120.0, 34 + k / 100), (-120.0, 34 + (k + 1) / 100)])
        for k, b in enumerate(bins)
    ]
    df = spark.createDataFrame(
        rows,
        "mmsi long, num long, timestamp timestamp, timestamp_end timestamp, final_speed_bin_num long, touches_coast boolean, linestring array<struct<lon:double,lat:double>>",
    ).selectExpr("*", "timestamp as timestamp_beg", "to_date(timestamp) as date", "'sc' as region",
                 "0.6D as distance_nm", "10D as segment_time_minutes", "7.25D as final_speed_knots")
    absent = [f for f in schemas.SEGMENTS.fields if f.name not in df.columns]
    return schemas.conform(
        df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]), schemas.SEGMENTS
    )


def test_run_numbers_close_a_run_before_the_change(spark):
    numbered = runs.numbered_runs(segment_rows(spark, [1, 1, 2, 2, 1])).orderBy("num").collect()
    assert [r.seg_chg for r in numbered] == [0, 1, 0, 1, None]
    assert [r.seg_id for r in numbered] == [0, 0, 1, 1, 2]


def test_a_vessel_with_one_segment_has_no_run_number(spark):
    (run,) = runs.build_runs(segment_rows(spark, [3]), EVER).collect()
    assert run.seg_id is None and run.npts == 2 and run.speed_bin_num == 3


def test_runs_bridge_coast_segments_and_keep_a_wide_gap_open(spark):
    found = runs.run_geometries(segment_rows(spark, [1, 1, 1, 1], touching={1}), EVER).collect()
    (run,) = found
    assert [len(path) for path in run.paths] == [2, 3] and run.npts == 5
    (straight,) = runs.build_runs(segment_rows(spark, [1, 1, 1, 1], touching={1}), EVER).collect()
    assert len(straight.geom) == 2  # the gap of about 1.1 km exceeds every tolerance
    assert float(straight.total_distance_nm) == 1.8 and float(straight.seg_min) == 30.0


def test_unknown_coast_contact_is_left_out(spark):
    rows = segment_rows(spark, [1, 1]).withColumn("touches_coast", F.lit(None).cast("boolean"))
    assert runs.off_coast(rows).count() == 0


def test_runs_end_at_midnight(spark):
    found = runs.build_runs(segment_rows(spark, [1] * 10, gap=7200), EVER).orderBy("date").collect()
    assert [r.npts for r in found] == [7, 5] and {r.seg_id for r in found} == {0}


# ---- zones ----------------------------------------------------------------------


def zone_rows(spark, seasons):
    ring = [(-121.0, 33.0), (-119.0, 33.0), (-119.0, 35.0), (-121.0, 35.0)]
    return spark.createDataFrame(
        [("A", "sc", [ring], beg, end) for beg, end in seasons],
        "vsr_category string, region string, geog array<array<struct<lon:double,lat:double>>>, datetime_beg timestamp, datetime_end timestamp",
    )


def test_season_is_about_the_start_and_includes_its_ends(spark):
    rows = segment_rows(spark, [1, 1, 1])
    at = [START + dt.timedelta(seconds=600 * k) for k in range(3)]
    only_second = zone_rows(spark, [(at[1], at[1])])
    assert [r.num for r in zones.clip_to_zones(rows, only_second, None).collect()] == [2]


def test_overlapping_seasons_repeat_segments(spark):
    rows = segment_rows(spark, [1])
    season = (START - dt.timedelta(days=1), START + dt.timedelta(days=1))
    assert zones.clip_to_zones(rows, zone_rows(spark, [season, season]), None).count() == 2


def test_zone_segments_have_the_declared_schema(spark):
    found = zones.clip_to_zones(segment_rows(spark, [1]), zone_rows(spark, [(START, START)]), EVER)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in schemas.ZONE_SEGMENTS]


# ---- scorecards -----------------------------------------------------------------


def daily_rows(spark, rows):
    """rows: (mmsi, operator, category, date, region, under 10, over 15, speed)."""
    text = "mmsi long, operator string, ship_category string, date date, vsr_region string, under double, over double, speed double"
    df = spark.createDataFrame(rows, text)
    return df.selectExpr(
        "mmsi", "concat('S', mmsi) as name_of_ship", "operator", "1L as operator_code",
        "cast(null as string) as technical_manager", "'T' as shiptype", "ship_category", "date", "vsr_region",
        "cast(500 as decimal(20,9)) as gt", "cast(under + over as decimal(20,9)) as total_distance_nm",
        "cast(under as decimal(20,9)) as total_distance_nm_under_10",
        "cast(0 as decimal(20,9)) as total_distance_nm_btwn_10_12",
        "cast(0 as decimal(20,9)) as total_distance_nm_btwn_12_15",
        "cast(over as decimal(20,9)) as total_distance_nm_over_15",
        "cast(speed as decimal(20,9)) as avg_speed_knots",
        "timestamp(date) as min_timestamp", "timestamp(date) as max_timestamp",
        "1L as day_count", "3L as seg_count",
    )


def months(spark):
    """One ship: fifteen months, scores 0, 10, 20, ... of a hundred miles."""
    firsts = [dt.date(2023 + k // 12, k % 12 + 1, 1) for k in range(15)]
    return daily_rows(
        spark,
        [(1, "O", "CARGO", d, "sc", 6.0 * k, 100 - 6.0 * k, 8.0) for k, d in enumerate(firsts)],
    )


def test_monthly_rolling_restarts_each_year_and_annual_uses_years(spark):
    monthly = ships.ship_monthly(months(spark)).orderBy("year", "month").collect()
    rolling = [float(r.rolling_coop_score) for r in monthly]
    assert rolling[0] == 0.0 and rolling[11] == 33.0 and rolling[12] == 72.0 and rolling[14] == 78.0
    annual = ships.ship_annual(months(spark)).orderBy("year").collect()
    assert [float(r.coop_score_annual) for r in annual] == [33.0, 78.0]
    assert [float(r.rolling_coop_score) for r in annual] == [33.0, 55.5]
    assert [r.year_grade for r in annual] == ["D", "B"] and annual[0].day_count == 12


def test_rolling_rows_are_thirteen(spark):
    rows = [(1, "O", "CARGO", dt.date(2024, 1, 5), f"z{k:02d}", 100.0 if k == 0 else 0.0,
             0.0 if k == 0 else 100.0, 8.0) for k in range(15)]
    monthly = ships.ship_monthly(daily_rows(spark, rows)).orderBy("vsr_region").collect()
    rolling = [float(r.rolling_coop_score) for r in monthly]
    assert rolling[12] == pytest.approx(100 / 13, abs=0.001) and rolling[13] == 0.0


def test_operator_means_divide_by_all_rows_and_ship_means_do_not(spark):
    rows = [(1, "O", "CARGO", dt.date(2024, 1, 5), "sc", 1.0, 1.0, 8.0),
            (2, "O", "TANKER", dt.date(2024, 1, 5), "sc", 1.0, 1.0, None)]
    (operator,) = fleets.operator_daily(daily_rows(spark, rows)).collect()
    assert float(operator.avg_speed_knots) == 4.0 and operator.daily_ship_count == 2
    assert operator.operator_ship_categories == "multi-category"
    assert operator.mmsi_list == "1, 2" and operator.ship_categories_list == "CARGO, TANKER"
    again = [(1, "O", "CARGO", dt.date(2024, 1, d), "sc", 1.0, 1.0, v) for d, v in ((5, 8.0), (6, None))]
    (ship,) = ships.ship_monthly(daily_rows(spark, again)).collect()
    assert float(ship.avg_speed_knots) == 8.0


def test_operator_texts(spark):
    (month,) = fleets.operator_monthly(
        daily_rows(spark, [(1, "O", "CARGO", dt.date(2024, 3, 5), "sc", 1.0, 2.0, 8.0)])
    ).collect()
    assert month.cooperation_score_monthly == "33.33% (mar 2024)"
    assert month.operator_ship_categories == "CARGO"
    (year,) = fleets.operator_annual(
        daily_rows(spark, [(1, "O", "CARGO", dt.date(2024, 3, 5), "sc", 2.0, 0.0, 8.0)])
    ).collect()
    assert year.cooperation_score_annual == "100% (2024)" and year.year_grade == "A+"


def test_no_distance_gives_no_score_and_the_lowest_grade(spark):
    (month,) = ships.ship_monthly(
        daily_rows(spark, [(1, "O", "CARGO", dt.date(2024, 3, 5), "sc", 0.0, 0.0, None)])
    ).collect()
    assert month.coop_score_monthly is None and month.month_grade == "F"
    assert month.percent_distance_under_10 is None


def test_simple_segments_carry_no_registry_columns_along_the_time_line(spark):
    ship = [(1, 500, DAY_1, dt.date(2024, 1, 15)), (1, 500, dt.date(2024, 1, 15), DAY_31), (2, 200, DAY_1, DAY_31)]
    some = messages(spark, [(1, 0, 0, 0, 5.0, 5.0), (1, 600, 0, 0.01, 5.0, 5.0), (2, 0, 0, 0, 5.0, 5.0), (2, 600, 0, 0.01, 5.0, 5.0)])
    twice = registry(spark, ship).union(registry(spark, ship[:1]))  # and an equal row
    found = segments.build_segments_simple(some, twice)
    rows = found.collect()
    assert {r["mmsi"] for r in rows} == {1} and {r["gt"] for r in rows} == {500}
    assert [r["num"] for r in rows] == sorted(set(r["num"] for r in rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    shuffled = [plan[i + 1] for i, line in enumerate(plan) if "RepartitionByExpression" in line]
    assert shuffled and not any("name_of_ship" in line or "operator" in line for line in shuffled)
