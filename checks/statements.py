"""One DuckDB statement per registered query."""

from __future__ import annotations

from checks.sql import (
    BOX, IS_SEGMENT, IS_SIMPLE, MINUTES, MMSI, REGION, SMALL_BOX,
    big, calculated, crossing, dbl, dec, fraction, grade, mean_over, metres, percent, query, ray, rnd,
    speed_bin, text,
)

from fairwake.plans.catalog import MIDDLE, SPARSE_INTEGERS, WEST

FINALS: dict[str, str] = {}

_MESSAGE = f"""mmsi, timestamp, lon, lat, {dbl('speed_knots')} AS speed_knots,
  {dbl('implied_speed_knots')} AS implied_speed_knots, source"""
_AIS = f"SELECT {_MESSAGE}, region FROM ais"

FINALS["ais_ingest"] = _AIS
FINALS["ais_ingest_legacy"] = f"SELECT {_MESSAGE} FROM ais_small"
FINALS["incremental_append"] = _AIS
FINALS["create_if_absent"] = FINALS["load_after_failure"] = _AIS
FINALS["vessel_registry"] = """SELECT mmsi, name_of_ship, shiptype, gt, technical_manager, operator,
  operator_code, start_date, end_date FROM reg"""

_DAYS = "(VALUES (DATE '2024-01-31'), (DATE '2024-02-20'), (DATE '2024-04-01')) AS d(as_of)"


def _newest(table: str, column: str, name: str, look_back: str, day: str = "date") -> str:
    return f"""SELECT max({column}) AS newest_timestamp, '{name}' AS table_name, as_of
  FROM {_DAYS} LEFT JOIN (SELECT * FROM {table}) t ON CAST(t.{day} AS DATE) > CAST(as_of - {look_back} AS DATE)
  GROUP BY as_of"""


FINALS["watermark_lookback"] = "\nUNION ALL\n".join(
    [
        _newest("ais", "timestamp", "ais_data", "INTERVAL 28 DAY", "timestamp"),
        _newest("seg_plain", "timestamp_end", "ais_segments", "INTERVAL 28 DAY"),
        _newest("vsr", "timestamp_end", "ais_vsr_segments", "INTERVAL 8 MONTH"),
    ]
)
FINALS["watermark_default"] = """
SELECT coalesce(max(h.timestamp), TIMESTAMP '2020-01-01 00:00:00') AS newest_timestamp, as_of
FROM (VALUES (DATE '2024-01-31'), (DATE '2025-01-01')) AS d(as_of)
  LEFT JOIN (SELECT * FROM zone_hit_legacy) h ON CAST(h.timestamp AS DATE) > CAST(as_of - INTERVAL 8 MONTH AS DATE)
GROUP BY as_of"""
FINALS["load_log"] = """
SELECT TIMESTAMP '1990-01-01 00:00:00' AS newest_timestamp, 'ais_data' AS table_name, 'query_start' AS query_exec
UNION ALL SELECT max(timestamp), 'ais_data', 'query_end' FROM ais WHERE timestamp < TIMESTAMP '2024-01-15 00:00:00'
UNION ALL SELECT max(timestamp), 'ais_data', 'query_start' FROM ais WHERE timestamp < TIMESTAMP '2024-01-15 00:00:00'
UNION ALL SELECT max(timestamp), 'ais_data', 'query_end' FROM ais"""
FINALS["stats_log"] = "\nUNION ALL\n".join(
    f"SELECT max(max_timestamp) AS newest_timestamp, {newest_date} AS newest_date, '{name}' AS table_name FROM {table}"
    for name, table, newest_date in [
        ("ship_stats_daily", "daily", "max(date)"),
        ("ship_stats_monthly", "month_ship", "CAST(max(max_timestamp) AS DATE)"),
        ("ship_stats_annual", "year_ship", "CAST(max(max_timestamp) AS DATE)"),
        ("operator_stats_daily", "day_operator", "max(date)"),
        ("operator_stats_monthly", "month_operator", "CAST(max(max_timestamp) AS DATE)"),
        ("operator_stats_annual", "year_operator", "CAST(max(max_timestamp) AS DATE)"),
    ]
)

# ---- values and predicates ------------------------------------------------------

FINALS["safe_cast"] = f"""
SELECT ssvid, {MMSI} AS mmsi, timestamp, {dbl(dec('speed_knots'))} AS speed_knots,
  {dbl(dec('implied_speed_knots'))} AS implied_speed_knots,
  TRY_CAST(CAST(timestamp AS VARCHAR) AS TIMESTAMP) AS moment,
  TRY_CAST('at ' || CAST(timestamp AS VARCHAR) AS TIMESTAMP) AS no_moment,
  TRY_CAST(source AS DOUBLE) AS no_number
FROM src"""
FINALS["bbox_filter"] = f"SELECT ssvid, timestamp, lon, lat, {SMALL_BOX} AS in_small_box FROM src WHERE {BOX}"
FINALS["region_label"] = f"SELECT ssvid, timestamp, lon, lat, {REGION} AS region FROM src"
FINALS["format_messages"] = f"SELECT {_MESSAGE} FROM formatted WHERE source = 'spire'"


def _bins(otherwise: str) -> str:
    reported, implied = dec("speed_knots"), dec("implied_speed_knots")
    return f"""
SELECT ssvid, timestamp, speed_knots, implied_speed_knots,
  {speed_bin(reported, otherwise)} AS speed_bin_num, {speed_bin(implied, otherwise)} AS implied_speed_bin_num,
  {speed_bin(f'({reported} - 50)', otherwise)} AS shifted_speed_bin_num
FROM src"""


FINALS["speed_bins"] = _bins("5")
FINALS["speed_bins_strict"] = _bins("NULL")
_SPEEDS = ", ".join(
    f"{dbl(f'{n}_knots')} AS {n}_knots" for n in ["speed", "calculated", "implied_speed", "final_speed"]
)
FINALS["final_speed"] = f"SELECT mmsi, num, {_SPEEDS} FROM seg_plain"
FINALS["final_speed_legacy"] = f"SELECT mmsi, num, {_SPEEDS} FROM seg_legacy"
FINALS["speed_choice_legacy"] = f"""
SELECT mmsi, num, {dbl('calculated_knots')} AS calculated_knots, {dbl('implied_speed_knots')} AS implied_speed_knots,
  {dbl('speed_knots_1')} AS speed_knots_1, {dbl('speed_knots_2')} AS speed_knots_2, speed_bin_num
FROM chosen"""
FINALS["grade"] = f"""
SELECT ssvid, timestamp, {grade(dec('speed_knots'))} AS reported_grade,
  {grade(dec('implied_speed_knots * 5'))} AS implied_grade
FROM src"""
FINALS["segment_filter"] = f"""
SELECT mmsi, num, {big(MINUTES)} AS minutes, {dbl(rnd('metres', 3))} AS metres, {IS_SEGMENT} AS kept FROM pairs"""
FINALS["segment_filter_legacy"] = f"""
SELECT mmsi, num, {big(MINUTES)} AS minutes, {IS_SIMPLE} AND gt >= 300 AS kept FROM pairs_all"""
FINALS["incremental_filter"] = f"""
SELECT mmsi, num, timestamp AS timestamp_beg, next_ts AS timestamp_end,
  {dbl(rnd('metres * 0.000539957E0', 5))} AS distance_nm
FROM pairs_late WHERE {IS_SEGMENT}"""
FINALS["off_coast_segments"] = "SELECT mmsi, num, timestamp, touches_coast FROM seg WHERE NOT touches_coast"

_NOON = "TIMESTAMP '2024-01-10 12:00:00.5'"
_MICROS = f"(epoch_us(timestamp) - epoch_us({_NOON}))"


def _whole(units: int) -> str:
    return big(f"trunc({_MICROS} / {units}.0)")


FINALS["time_functions"] = f"""
SELECT ssvid, timestamp, date AS day, CAST(date AS TIMESTAMP) AS midnight,
  {_whole(1000)} AS millis, {_whole(1000000)} AS seconds, {_whole(60000000)} AS minutes,
  CAST(date - INTERVAL 28 DAY AS DATE) AS days_before, CAST(date - INTERVAL 8 MONTH AS DATE) AS months_before,
  {big('month(date)')} AS month, {big('year(date)')} AS year, epoch_us(timestamp) // 1000000 AS seconds_since_1970
FROM src"""
FINALS["rounding"] = "SELECT ssvid, timestamp, {}, {} AS halves FROM src".format(
    ", ".join(f"{dbl(rnd('speed_knots / 7E0', n))} AS digits_{n}" for n in range(1, 6)),
    dbl(rnd("speed_knots", 1)),
)
_MONTHS = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"
FINALS["text_functions"] = f"""
SELECT mmsi, start_date, trim(shiptype) AS trimmed, coalesce(start_date, DATE '1900-01-01') AS start_or_default,
  {text('gt / 51E0', 1)} || '%' AS percent_1, {text('gt / 50E0', 2)} || '%' AS percent_2,
  {_MONTHS}[month(start_date)] || ' ' || CAST(year(start_date) AS VARCHAR) AS month_text
FROM reg"""

# ---- joins ----------------------------------------------------------------------

FINALS["join_registry"] = f"""
SELECT a.mmsi, timestamp, lon, lat, {dbl('speed_knots')} AS speed_knots,
  {dbl('implied_speed_knots')} AS implied_speed_knots, source, region, gt, start_date
FROM ais a JOIN reg r ON a.mmsi = r.mmsi WHERE gt >= 300"""
FINALS["left_join_registry"] = """
SELECT f.mmsi, timestamp, lon, lat, source, name_of_ship, gt, operator, start_date
FROM formatted f LEFT JOIN reg r ON f.mmsi = r.mmsi"""
FINALS["registry_validity_join"] = """
SELECT s.mmsi, num, timestamp_beg, timestamp_end, start_date, end_date, operator
FROM seg_plain s JOIN reg r ON s.mmsi = r.mmsi
WHERE timestamp_beg >= CAST(start_date AS TIMESTAMP) AND timestamp_end <= CAST(end_date AS TIMESTAMP)"""
FINALS["category_join"] = """
SELECT mmsi, start_date, shiptype, ship_category FROM reg LEFT JOIN cat ON trim(shiptype) = trim(cat_type)"""

# ---- segments -------------------------------------------------------------------

FINALS["segment_numbering"] = "SELECT mmsi, timestamp, start_date, num FROM pairs"
FINALS["lead_two"] = f"""
SELECT mmsi, timestamp, start_date, {dbl('next_speed')} AS next_speed_knots,
  {dbl('next_implied')} AS next_implied_speed_knots,
  {dbl('lead(speed_knots, 2) OVER w')} AS second_speed_knots,
  {dbl('lead(implied_speed_knots, 2) OVER w')} AS second_implied_speed_knots
FROM pairs WINDOW w AS (PARTITION BY mmsi ORDER BY num)"""
FINALS["segment_distance"] = f"""
SELECT mmsi, num, {dbl(rnd('metres / 1000E0', 5))} AS distance_km,
  {dbl(rnd('metres * 0.000539957E0', 5))} AS distance_nm FROM pairs"""
FINALS["calculated_speed"] = f"SELECT mmsi, num, {dbl(calculated())} AS calculated_knots FROM pairs"
FINALS["touches_coast"] = "SELECT mmsi, num, touches_coast FROM seg"

_SEGMENT = f"""timestamp, date, mmsi, num, timestamp_beg, timestamp_end, {_SPEEDS},
  {dbl('distance_km')} AS distance_km, {dbl('distance_nm')} AS distance_nm, segment_time_minutes, lon, lat,
  source, {dbl('gt')} AS gt, speed_bin_num, implied_speed_bin_num, calculated_speed_bin_num, final_speed_bin_num"""
_ENDS = "next_lon, next_lat"
FINALS["segments"] = f"SELECT {_SEGMENT}, region, touches_coast, {_ENDS} FROM seg"
FINALS["sink_roundtrip"] = FINALS["segments"]
_SEGMENT_LEGACY = f"{_SEGMENT}, next_lon AS lead_lon, next_lat AS lead_lat"
FINALS["segments_legacy"] = f"SELECT {_SEGMENT_LEGACY} FROM seg_legacy"
_SIMPLE = f"""timestamp, date_diff_minutes, mmsi, num, {dbl('speed_knots')} AS speed_knots,
  {dbl('implied_speed_knots')} AS implied_speed_knots, lon, lat, source, {dbl('distance')} AS distance, name_of_ship,
  shiptype, gt, operator, operator_code, {_ENDS}"""
FINALS["segments_simple"] = f"SELECT {_SIMPLE} FROM seg_simple"

# ---- runs -----------------------------------------------------------------------

FINALS["bin_change_flag"] = f"SELECT mmsi, num, final_speed_bin_num, {big('seg_chg')} AS seg_chg FROM flagged"
FINALS["sessionize_bins"] = "SELECT mmsi, num, timestamp, segid, seg_id FROM numbered"
FINALS["sessionize_rows"] = f"""
SELECT mmsi, num, timestamp, {big('seg_chg')} AS seg_chg, segid, seg_id FROM numbered_rows"""


def _doubles(names: list[str]) -> str:
    return ", ".join(f"{dbl(n)} AS {n}" for n in names)


_RUN_AVERAGES = ["avg_speed_knots", "avg_implied_speed_knots", "avg_calculated_knots", "avg_speed_knots_final"]
_RUN_SUMS = ["total_distance_nm", "seg_min"]
_RUN_TIMES = "unix_beg, unix_end, timestamp_beg, timestamp_end"
FINALS["speed_runs"] = f"""
SELECT mmsi, date, seg_id, speed_bin_num, touches_coast, region, {_doubles(_RUN_AVERAGES + _RUN_SUMS)}, {_RUN_TIMES}
FROM runs"""
FINALS["runs_legacy"] = f"""
SELECT mmsi, date, speed_bin_num, seg_id, {_doubles(_RUN_AVERAGES + ['avg_speed_knots_1'] + _RUN_SUMS)}, {_RUN_TIMES},
  npts FROM runs_rows"""
_RUN = "mmsi, date, seg_id, final_speed_bin_num AS speed_bin_num, region"
_RUN_GROUP = "mmsi, date, seg_id, final_speed_bin_num, region"
FINALS["run_npts"] = f"""
SELECT {_RUN}, {big('count(*) + sum(opens)')} AS npts, {big('sum(opens)')} AS paths FROM hop GROUP BY {_RUN_GROUP}"""
FINALS["run_geometry"] = f"""
SELECT {_RUN}, {big('path - 1')} AS path,
  row_number() OVER (PARTITION BY {_RUN_GROUP}, path ORDER BY timestamp, part) - 1 AS vertex, lon, lat
FROM vertex"""
_GAP = f"max(CASE WHEN opens = 1 AND last_lon IS NOT NULL THEN {metres('last_lon', 'last_lat', 'lon', 'lat')} END)"
FINALS["run_tolerance"] = f"""
SELECT {_RUN}, {dbl(rnd(_GAP, 3))} AS widest_gap_m, CAST(CASE
  {" ".join(f"WHEN {_GAP} <= {t} THEN {t}" for t in [5, 10, 50, 100, 250, 500, 750, 1000])} END AS BIGINT) AS tolerance_m
FROM hop GROUP BY {_RUN_GROUP}"""

FINALS["run_simplify"] = f"""
SELECT {_RUN}, 0::BIGINT AS path, row_number() OVER (PARTITION BY p.run ORDER BY p.pos) - 1 AS vertex, lon, lat
FROM plane p JOIN stayed k ON k.run = p.run AND k.pos = p.pos
UNION ALL
SELECT {_RUN}, {big('path - 1')}, row_number() OVER (PARTITION BY run, path ORDER BY pos) - 1, lon, lat
FROM plane WHERE tolerance IS NULL"""

FINALS["track_simplify"] = """
SELECT mmsi, week, row_number() OVER (PARTITION BY p.run ORDER BY p.pos) - 1 AS vertex, lon, lat
FROM track_plane p JOIN track_stayed k ON k.run = p.run AND k.pos = p.pos"""

# ---- zones ----------------------------------------------------------------------

_ZONE = "vsr_category, vsr_region"
FINALS["vsr_join"] = f"SELECT mmsi, num, {_ZONE}, datetime_beg, datetime_end FROM zone_hit"
_WHOLE = "coalesce(t0 = 0 AND t1 = 1, false)"
FINALS["vsr_covered"] = f"SELECT mmsi, num, {_ZONE}, {_WHOLE} AS covered FROM vsr"


def _at(t: str, axis: str) -> str:
    return f"(CASE {t} WHEN 0 THEN {axis} WHEN 1 THEN next_{axis} ELSE {axis} + (next_{axis} - {axis}) * {t} END)"


_INSIDE = metres(_at("t0", "lon"), _at("t0", "lat"), _at("t1", "lon"), _at("t1", "lat"))
_INSIDE_NM = f"{dbl(rnd(f'CASE WHEN t0 < t1 THEN {_INSIDE} ELSE 0E0 END * 0.000539957E0', 4))}"
FINALS["vsr_clip"] = f"""
SELECT mmsi, num, {_ZONE}, {big('CASE WHEN t0 < t1 THEN 1 ELSE 0 END')} AS lines, {_INSIDE_NM} AS inside_nm FROM vsr"""
FINALS["vsr_segments"] = f"SELECT {_SEGMENT}, region, touches_coast, {_ZONE} FROM vsr"


def _vertices(lon: str, digits: int) -> str:
    """Both ends of the part inside a zone."""
    ends = " UNION ALL ".join(
        f"SELECT mmsi, num, {_ZONE}, 0::BIGINT AS path, {i}::BIGINT AS vertex, {dbl(rnd(lon.format(_at(t, 'lon')), digits))} AS lon, "
        f"{dbl(rnd(_at(t, 'lat'), digits))} AS lat FROM vsr WHERE t0 < t1"
        for i, t in enumerate(["t0", "t1"])
    )
    return f"SELECT * FROM ({ends})"


FINALS["vsr_vertices"] = _vertices("{0}", 7)
FINALS["vsr_dateline"] = _vertices(f"({{0}} - {WEST} + CASE WHEN {{0}} - {WEST} < -180 THEN 360 ELSE 0 END)", 6)
FINALS["vsr_join_legacy"] = f"""
SELECT s.*, h.vsr_category FROM (SELECT {_SEGMENT_LEGACY} FROM seg_legacy) s
  JOIN (SELECT * FROM zone_hit_legacy) h ON s.mmsi = h.mmsi AND s.num = h.num"""
FINALS["chain_legacy"] = f"""
SELECT s.*, h.vsr_category FROM (SELECT {_SIMPLE} FROM seg_small) s
  JOIN (SELECT * FROM zone_hit_small) h ON s.mmsi = h.mmsi AND s.num = h.num"""
# Lines of a run that meet a zone while the run as a whole lies in the zone's season.
_RUN_LINE = f"""
SELECT r.mmsi, r.date, r.seg_id, r.speed_bin_num, z.polygon, z.vsr_category, z.vsr_region, s.num,
  s.lon, s.lat, s.next_lon, s.next_lat,
  CASE WHEN sum({ray(('s.lon', 's.lat'))}) % 2 = 1 THEN 0E0 ELSE min({fraction()}) END AS t0,
  CASE WHEN sum({ray(('s.next_lon', 's.next_lat'))}) % 2 = 1 THEN 1E0 ELSE max({fraction()}) END AS t1
FROM runs_rows r
  JOIN hop_rows s ON s.mmsi = r.mmsi AND s.date = r.date AND s.seg_id IS NOT DISTINCT FROM r.seg_id
    AND s.speed_bin_num IS NOT DISTINCT FROM r.speed_bin_num AND s.next_ts IS NOT NULL
  JOIN zone z ON r.timestamp_end <= z.datetime_end AND r.timestamp_beg >= z.datetime_beg
    AND r.date > DATE '1990-01-01' AND r.date <= DATE '2024-01-30'
  JOIN zone_edge e ON e.polygon = z.polygon
GROUP BY ALL
HAVING bool_or({crossing()}) OR sum({ray(('s.lon', 's.lat'))}) % 2 = 1"""
FINALS["vsr_runs_join"] = f"""
SELECT r.mmsi, r.date, r.speed_bin_num, r.seg_id, {_doubles(_RUN_AVERAGES + ['avg_speed_knots_1'] + _RUN_SUMS)},
  {_RUN_TIMES}, npts, f.vsr_category, f.vsr_region, f.inside_nm
FROM runs_rows r JOIN (
  SELECT mmsi, date, seg_id, speed_bin_num, polygon, vsr_category, vsr_region,
    {dbl(rnd(f'sum(CASE WHEN t0 < t1 THEN {_INSIDE} ELSE 0E0 END) * 0.000539957E0', 4))} AS inside_nm
  FROM ({_RUN_LINE}) GROUP BY ALL) f
ON f.mmsi = r.mmsi AND f.date = r.date AND f.seg_id IS NOT DISTINCT FROM r.seg_id
  AND f.speed_bin_num IS NOT DISTINCT FROM r.speed_bin_num"""

_LOOK_14, _LOOK_8 = "DATE '2024-01-17'", "DATE '2023-05-31'"
FINALS["freshness_log"] = f"""
SELECT max(timestamp) AS newest_timestamp, 'ais_data' AS table_name FROM ais WHERE CAST(timestamp AS DATE) > {_LOOK_14}
UNION ALL SELECT max(timestamp), 'ais_segments' FROM seg_legacy WHERE date > {_LOOK_14}
UNION ALL SELECT max(timestamp_end), 'ais_segments_agg' FROM runs_rows WHERE date > {_LOOK_14}
UNION ALL SELECT max(timestamp), 'ais_vsr_segments' FROM zone_hit_legacy WHERE CAST(timestamp AS DATE) > {_LOOK_8}
UNION ALL SELECT max(timestamp_end), 'ais_vsr_segments_agg' FROM ({FINALS['vsr_runs_join']}) WHERE date > {_LOOK_8}"""

# ---- scorecards -----------------------------------------------------------------

_BANDS = [
    "total_distance_nm_under_10", "total_distance_nm_btwn_10_12", "total_distance_nm_btwn_12_15",
    "total_distance_nm_over_15",
]
FINALS["ship_daily_distances"] = f"""
SELECT mmsi, date, vsr_region,
  {_doubles(['total_distance_nm', *_BANDS, 'total_distance_nm_weird', 'total_distance_nm_wo_filter'])} FROM day"""
_EXTREMES = [
    f"{side}_{name}_knots"
    for name in ["speed", "implied_speed", "final_calculated_speed"]
    for side in ["max", "min"]
]
FINALS["ship_daily_extremes"] = f"SELECT mmsi, date, vsr_region, {_doubles(_EXTREMES)} FROM day"
FINALS["ship_rolling_daily"] = f"""
SELECT mmsi, date, vsr_region, {dbl('score')} AS score, {dbl('rolling')} AS rolling_coop_score FROM daily"""

_NAMES = f"""mmsi, name_of_ship, operator, operator_code, technical_manager, shiptype, ship_category, vsr_region,
  {dbl('gt')} AS gt"""


def _share(column: str, digits: int) -> str:
    return f"{text(percent(column, 'total_distance_nm'), digits)} || '%'"


FINALS["ship_daily"] = f"""
SELECT {_NAMES}, date, {text('score', 1)} || '%' AS cooperation_score_daily,
  {dbl(rnd('score', 2))} AS coop_score_daily, {grade('score')} AS coop_grade_daily,
  {dbl(rnd('rolling', 1))} AS rolling_coop_score, {grade('rolling')} AS rolling_coop_grade,
  {_doubles(['total_distance_nm', *_BANDS, 'total_distance_nm_weird', 'total_distance_nm_wo_filter'])},
  {_share(_BANDS[0], 1)} AS percent_under_10_knots, {_share(_BANDS[1], 1)} AS percent_10_12_knots,
  {_share(_BANDS[2], 1)} AS percent_12_15_knots, {_share(_BANDS[3], 1)} AS percent_over_15_knots,
  {dbl('avg_speed_knots')} AS avg_speed_knots, min_timestamp, max_timestamp, day_count, seg_count
FROM daily"""
FINALS["scorecard_overwrite"] = FINALS["ship_daily"]

_ROUNDED = ", ".join(f"{dbl(rnd(d, 2))} AS {d}" for d in ["total_distance_nm", *_BANDS, "avg_speed_knots"])
_OTHERS = ", ".join(
    f"{c} NULLS FIRST"
    for c in "name_of_ship, operator, operator_code, technical_manager, shiptype, ship_category, vsr_region, gt".split(", ")
)


def _ship_scorecard(table: str, period: str, kind: str, unit: str, partition: str) -> str:
    window = (
        f"PARTITION BY {partition} ORDER BY {unit}, {_OTHERS} ROWS BETWEEN 12 PRECEDING AND CURRENT ROW"
    )
    shares = ", ".join(
        f"{_share(b, 2)} AS percent_distance_{b.removeprefix('total_distance_nm_')}" for b in _BANDS
    )
    return f"""
SELECT {_NAMES}, {period}, {dbl('shown')} AS coop_score_{kind}, {grade('score')} AS {unit}_grade,
  {dbl(rnd(mean_over('shown', window), 3))} AS rolling_coop_score, {_ROUNDED}, {shares},
  min_timestamp, max_timestamp, day_count, seg_count
FROM (SELECT *, {rnd('score', 2)} AS shown FROM {table})"""


FINALS["ship_monthly"] = _ship_scorecard("month_ship", "month, year", "monthly", "month", "mmsi, year")
FINALS["ship_annual"] = _ship_scorecard("year_ship", "year", "annual", "year", "mmsi")

_LISTS = "ship_categories_list, mmsi_list, name_of_ships"


def _operator_scorecard(table: str, period: str, columns: str, window: str) -> str:
    return f"""
SELECT operator, operator_code, operator_ship_categories, vsr_region, {period}, {columns},
  {dbl(rnd(mean_over('score', window), 2))} AS rolling_coop_score, {_ROUNDED}, {_LISTS},
  max_timestamp, min_timestamp
FROM {table}"""


FINALS["operator_daily"] = _operator_scorecard(
    "day_operator",
    "date",
    f"{dbl(rnd('score', 2))} AS coop_score_daily, {grade('score')} AS day_grade, ship_count AS daily_ship_count",
    "PARTITION BY operator ORDER BY date",
)
FINALS["operator_monthly"] = _operator_scorecard(
    "month_operator",
    "month, year",
    f"""{dbl(rnd('score', 2))} AS coop_score_monthly, {grade('score')} AS month_grade, ship_count AS month_ship_count,
  {text('score', 2)} || '% (' || {_MONTHS}[month] || ' ' || CAST(year AS VARCHAR) || ')' AS cooperation_score_monthly""",
    "PARTITION BY operator, year ORDER BY month, vsr_region, operator_code "
    "ROWS BETWEEN 12 PRECEDING AND CURRENT ROW",
)
FINALS["operator_annual"] = _operator_scorecard(
    "year_operator",
    "year",
    f"""{dbl(rnd('score', 2))} AS coop_score_annual, {grade('score')} AS year_grade, ship_count AS year_ship_count,
  {text('score', 2)} || '% (' || CAST(year AS VARCHAR) || ')' AS cooperation_score_annual""",
    "PARTITION BY operator ORDER BY year",
)
FINALS["operator_lists"] = """
SELECT operator, operator_code, vsr_region, date, ship_count, mmsi_list, ship_types, name_of_ships,
  ship_categories_list, operator_ship_categories FROM day_operator"""



def _shown(name: str) -> str:
    sparse = SPARSE_INTEGERS.get(name)
    if sparse is None:
        return FINALS[name]
    casts = ", ".join(f"{dbl(column)} AS {column}" for column in sparse)
    return f"SELECT * REPLACE ({casts}) FROM ({FINALS[name]})"


STATEMENTS = {name: query(_shown(name)) for name in FINALS}


def _each_load(statement: str) -> str:
    """The statement over each half of the messages, one below the other."""
    halves = [
        statement.replace("FROM events", f"FROM (SELECT * FROM events WHERE ts {side} TIMESTAMP '{MIDDLE:%Y-%m-%d %H:%M:%S}')")
        for side in ("<", ">=")
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({half})" for half in halves)


STATEMENTS["vsr_runs_two_loads"] = _each_load(STATEMENTS["vsr_runs_join"])
