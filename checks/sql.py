"""DuckDB statements that compute the registered queries a second way.

Each statement is put together from named subqueries; `query` adds those it needs.
Timestamps are naive UTC, decimals carry nine places, results are cast to DOUBLE.
"""

from __future__ import annotations

import re

from fairwake.sources import samples


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(20,9))"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def rnd(x: str, digits: int) -> str:
    return f"round({dec(x)}, {digits})"


def mean(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


def mean_over(x: str, window: str) -> str:
    return f"CAST(sum({x}) OVER ({window}) AS DOUBLE) / nullif(count({x}) OVER ({window}), 0)"


def percent(part: str, whole: str) -> str:
    return dec(dec(f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)") + " * 100")


def text(x: str, digits: int) -> str:
    return rf"regexp_replace(CAST({rnd(x, digits)} AS VARCHAR), '\.?0+$', '')"


def grade(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 99 THEN 'A+' WHEN {x} >= 80 THEN 'A' WHEN {x} >= 60 THEN 'B' "
        f"WHEN {x} >= 40 THEN 'C' WHEN {x} >= 20 THEN 'D' ELSE 'F' END"
    )


def speed_bin(x: str, otherwise: str = "5") -> str:
    return (
        f"CAST(CASE WHEN {x} = 0 THEN 0 WHEN {x} > 0 AND {x} <= 10 THEN 1 "
        f"WHEN {x} > 10 AND {x} <= 12 THEN 2 WHEN {x} > 12 AND {x} <= 15 THEN 3 "
        f"WHEN {x} > 15 AND {x} <= 50 THEN 4 WHEN {x} > 50 THEN 5 ELSE {otherwise} END AS BIGINT)"
    )


def metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    half_lat = f"((radians({lat2}) - radians({lat1})) / 2.0)"
    half_lon = f"((radians({lon2}) - radians({lon1})) / 2.0)"
    h = (
        f"sin({half_lat}) * sin({half_lat}) + (cos(radians({lat1})) * cos(radians({lat2})) "
        f"* sin({half_lon}) * sin({half_lon}))"
    )
    return f"(asin(sqrt({h})) * 12742017.6E0)"


def side(ax: str, ay: str, bx: str, by: str, px: str, py: str) -> str:
    return f"(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"


P, Q = ("s.lon", "s.lat"), ("s.next_lon", "s.next_lat")
A, B = ("e.x1", "e.y1"), ("e.x2", "e.y2")


def crossing(p=P, q=Q) -> str:
    """The line p-q and edge e share a point."""
    return f"""(least({p[0]}, {q[0]}) <= greatest(e.x1, e.x2) AND least(e.x1, e.x2) <= greatest({p[0]}, {q[0]})
      AND least({p[1]}, {q[1]}) <= greatest(e.y1, e.y2) AND least(e.y1, e.y2) <= greatest({p[1]}, {q[1]})
      AND {side(*A, *B, *p)} * {side(*A, *B, *q)} <= 0
      AND {side(*p, *q, *A)} * {side(*p, *q, *B)} <= 0)"""


def ray(p) -> str:
    """1 where a ray from p to the east meets edge e, else 0; odd sums mean inside."""
    return f"""CASE WHEN (e.y1 > {p[1]}) <> (e.y2 > {p[1]})
      AND {p[0]} < (e.x2 - e.x1) * ({p[1]} - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END"""


def fraction() -> str:
    from_p, from_q = side(*A, *B, *P), side(*A, *B, *Q)
    return f"CASE WHEN {crossing()} AND {from_p} <> {from_q} THEN {from_p} / ({from_p} - {from_q}) END"


def _edges(polygons: dict[str, list[tuple[float, float]]]) -> str:
    """Polygon edges along great circles, in pieces of at most a tenth of a degree.

    From a corner, each edge turns by equal angles towards its other corner, within the
    plane of the two: a cos(turn) + d sin(turn), where d is square to a.
    """
    rows = []
    for name, ring in polygons.items():
        for i, ((x1, y1), (x2, y2)) in enumerate(zip(ring, ring[1:] + ring[:1])):
            rows.append(f"('{name}', {i}, {x1}E0, {y1}E0, {x2}E0, {y2}E0)")
    unit = ", ".join(
        f"cos(radians(y{i})) * cos(radians(x{i})) AS u{i}, "
        f"cos(radians(y{i})) * sin(radians(x{i})) AS v{i}, sin(radians(y{i})) AS w{i}"
        for i in (1, 2)
    )
    turned = {
        c: f"({c}1 * cos(turn) + ({c}2 - {c}1 * cos(arc)) / sin(arc) * sin(turn))"
        for c in "uvw"
    }
    lon = f"degrees(atan2({turned['v']}, {turned['u']}))"
    lat = f"degrees(asin({turned['w']}))"
    return f"""
  SELECT polygon, x AS x1, y AS y1, next_x AS x2, next_y AS y2
  FROM (
    SELECT *, lead(x) OVER w AS next_x, lead(y) OVER w AS next_y
    FROM (
      SELECT polygon, edge, k,
        CASE k WHEN 0 THEN x1 WHEN n THEN x2 ELSE round({lon}, 9) END AS x,
        CASE k WHEN 0 THEN y1 WHEN n THEN y2 ELSE round({lat}, 9) END AS y
      FROM (
        SELECT *, arc * k / n AS turn
        FROM (
          SELECT *, unnest(range(n + 1)) AS k
          FROM (
            SELECT *, CAST(ceil(degrees(arc) / 0.1E0 + 1E-9) AS BIGINT) AS n
            FROM (
              SELECT *, acos(u1 * u2 + v1 * v2 + w1 * w2) AS arc
              FROM (SELECT *, {unit}
                FROM (VALUES {', '.join(rows)}) AS t(polygon, edge, x1, y1, x2, y2)))))))
    WINDOW w AS (PARTITION BY polygon, edge ORDER BY k))
  WHERE next_x IS NOT NULL"""


_ZONE_RINGS = {f"z{i}": zone[2] for i, zone in enumerate(samples.ZONES, 1)}
_ZONE_ROWS = ", ".join(
    f"('z{i}', '{category}', '{region}', TIMESTAMP '{beg} 00:00:00', TIMESTAMP '{end} 00:00:00')"
    for i, (category, region, _, beg, end) in enumerate(samples.ZONES, 1)
)
_CATEGORY_ROWS = ", ".join(f"('{shiptype}', '{category}')" for shiptype, category in samples.CATEGORIES)

REGION = """CASE
    WHEN lon BETWEEN -125.013E0 AND -117.460E0 AND lat BETWEEN 33.290E0 AND 34.5739E0 THEN 'sc'
    WHEN lon BETWEEN -125.013E0 AND -117.460E0 AND lat > 34.5739E0 AND lat <= 35.557E0 THEN 'cc'
    WHEN lon BETWEEN -125.013E0 AND -117.460E0 AND lat > 35.557E0 AND lat <= 39.032E0 THEN 'sf'
    ELSE 'other' END"""
BOX = "lat BETWEEN 33.285E0 AND 39.032E0 AND lon BETWEEN -125.013E0 AND -117.455E0"
SMALL_BOX = "lat BETWEEN 33.3011E0 AND 34.5738E0 AND lon BETWEEN -121.0299E0 AND -117.4998E0"

MILLIS = "(date_diff('microsecond', timestamp, next_ts) // 1000)"
SECONDS = "(date_diff('microsecond', timestamp, next_ts) // 1000000)"
MINUTES = "(date_diff('microsecond', timestamp, next_ts) // 60000000)"


def calculated(distance: str = "metres") -> str:
    km = f"CAST({dec(f'{distance} / 1000E0')} AS DOUBLE)"
    return f"CASE WHEN {MILLIS} > 0 THEN {rnd(f'{km} / ({MILLIS} / 3.6E6) * 0.539957E0', 4)} END"


def plausible(names: list[str], low: str) -> str:
    cases = " ".join(f"WHEN {n} BETWEEN {low} AND 50 THEN {n}" for n in names)
    return f"CASE {cases} END"


def pairs(source: str, vessels: str, condition: str, columns: str = "") -> str:
    """Messages of registered ships with the following message of the same ship."""
    return f"""
  SELECT *, {metres('next_lon', 'next_lat', 'lon', 'lat')} AS metres
  FROM (
    SELECT a.*, r.gt, r.start_date {columns},
      row_number() OVER w AS num,
      lead(timestamp) OVER w AS next_ts,
      lead(lon) OVER w AS next_lon,
      lead(lat) OVER w AS next_lat,
      lead(speed_knots) OVER w AS next_speed,
      lead(implied_speed_knots) OVER w AS next_implied
    FROM {source} a JOIN {vessels} r ON a.mmsi = r.mmsi
    WHERE {condition}
    WINDOW w AS (PARTITION BY a.mmsi ORDER BY timestamp, lon, lat, start_date NULLS FIRST))"""


IS_SEGMENT = f"next_ts IS NOT NULL AND {MINUTES} <= 120 AND metres BETWEEN 0.0001 AND 222240"
IS_SIMPLE = f"next_ts IS NOT NULL AND {MINUTES} <= 120 AND metres <= 10000"

SUB: dict[str, str] = {}

SUB["src"] = """
  SELECT *, round(-124.5E0 + (user_id*37 % 100)*0.06E0 - 0.2E0*(lat - 33.3E0), 6) AS lon
  FROM (
    SELECT *, round(33.3E0 + 5.7E0 - abs(((h*kn/60E0 + user_id*0.41E0) % 11.4E0) - 5.7E0), 6) AS lat
    FROM (
      SELECT event_id, user_id, ts AS timestamp, CAST(ts AS DATE) AS date,
        CAST(366000000 + user_id AS VARCHAR) || CASE WHEN event_id % 97 = 0 THEN 'x' ELSE '' END AS ssvid,
        (epoch_us(ts) - 1704067200000000) / 3.6E9 AS h,
        CAST(4 + user_id % 17 AS DOUBLE) AS kn,
        value AS speed_knots,
        CASE WHEN event_id % 11 = 0 THEN NULL
             ELSE CAST(4 + user_id % 17 AS DOUBLE) + event_id % 7 - 3 END AS implied_speed_knots,
        CASE WHEN event_type IN ('view', 'click') THEN 'spire' ELSE 'orbcomm' END AS source
      FROM events))"""

MMSI = "CASE WHEN regexp_full_match(ssvid, '[0-9]+') THEN CAST(ssvid AS BIGINT) END"
_FORMATTED = f"""SELECT {MMSI} AS mmsi, timestamp, lon, lat, {dec('speed_knots')} AS speed_knots,
    {dec('implied_speed_knots')} AS implied_speed_knots, source"""
SUB["formatted"] = f"{_FORMATTED} FROM src"
SUB["ais"] = f"SELECT *, {REGION} AS region FROM formatted WHERE {BOX}"
SUB["ais_small"] = f"SELECT * FROM formatted WHERE {SMALL_BOX}"

SUB["reg"] = """
  SELECT 366000000 + c_custkey AS mmsi, c_name AS name_of_ship,
    CASE WHEN c_custkey % 2 = 0 THEN ' ' || c_mktsegment ELSE c_mktsegment END AS shiptype,
    100 + (c_custkey * 97) % 5000 AS gt,
    'TM-' || CAST(c_nationkey % 7 AS VARCHAR) AS technical_manager,
    n_name AS operator, CAST(c_nationkey AS BIGINT) AS operator_code,
    CASE WHEN c_custkey % 10 = 7 THEN NULL WHEN c_custkey % 10 = 3 AND half = 2 THEN DATE '2024-01-15'
         ELSE DATE '2024-01-01' END AS start_date,
    CASE WHEN c_custkey % 10 = 7 THEN NULL WHEN c_custkey % 10 = 3 AND half = 1 THEN DATE '2024-01-15'
         ELSE DATE '2024-01-31' END AS end_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    JOIN (VALUES (1), (2)) AS halves(half) ON half = 1 OR c_custkey % 10 = 3
  WHERE c_custkey % 13 <> 5"""
SUB["vessels"] = (
    "SELECT mmsi, max(gt) AS gt, CAST(NULL AS DATE) AS start_date FROM reg GROUP BY mmsi"
)

SUB["pairs"] = pairs("ais", "reg", "r.gt >= 300")
SUB["pairs_late"] = pairs(
    "ais", "reg", "r.gt >= 300 AND timestamp > TIMESTAMP '2024-01-15 12:00:00'"
)
SUB["pairs_vessels"] = pairs("ais", "vessels", "r.gt >= 300")
_REGISTRY_COLUMNS = ", r.name_of_ship, r.shiptype, r.operator, r.operator_code"
SUB["pairs_all"] = pairs("ais", "reg", "true", _REGISTRY_COLUMNS)
SUB["pairs_small"] = pairs("ais_small", "reg", "true", _REGISTRY_COLUMNS)

_MEASURES = f"""timestamp, CAST(timestamp AS DATE) AS date, mmsi, num, timestamp AS timestamp_beg,
    next_ts AS timestamp_end, {{speeds}}, {calculated()} AS calculated_knots,
    {rnd('metres / 1000E0', 5)} AS distance_km, {rnd('metres * 0.000539957E0', 5)} AS distance_nm,
    CAST({rnd(f'{SECONDS} / 60E0', 2)} AS DOUBLE) AS segment_time_minutes,
    lon, lat, next_lon, next_lat, source"""
_BINS = ", ".join(
    f"{speed_bin(f'{name}_knots')} AS {name}_bin_num"
    for name in ["speed", "implied_speed"]
) + f", {speed_bin('calculated_knots')} AS calculated_speed_bin_num" + (
    f", {speed_bin('final_speed_knots')} AS final_speed_bin_num"
)
_ROUNDED = f"{rnd('next_speed', 4)} AS speed_knots, {rnd('next_implied', 4)} AS implied_speed_knots"
_FINAL = rnd(plausible(["speed_knots", "calculated_knots", "implied_speed_knots"], "0.001"), 3)
SUB["seg_plain"] = f"""
  SELECT *, {_BINS} FROM (
    SELECT *, {_FINAL} AS final_speed_knots FROM (
      SELECT {_MEASURES.format(speeds=_ROUNDED)}, region, gt FROM pairs WHERE {IS_SEGMENT}))"""
SUB["coast_edge"] = _edges({"c1": samples.COAST_1, "c2": samples.COAST_2})
SUB["coast_hit"] = f"""
  SELECT DISTINCT mmsi, num FROM (
    SELECT s.mmsi, s.num FROM seg_plain s CROSS JOIN coast_edge e
    GROUP BY s.mmsi, s.num, e.polygon
    HAVING bool_or({crossing()}) OR sum({ray(P)}) % 2 = 1)"""
SUB["seg"] = """
  SELECT s.*, h.mmsi IS NOT NULL AS touches_coast
  FROM seg_plain s LEFT JOIN coast_hit h ON s.mmsi = h.mmsi AND s.num = h.num"""

_RAW = f"{dec('next_speed')} AS speed_knots, {dec('next_implied')} AS implied_speed_knots"
_FINAL_LEGACY = plausible(["calculated_knots", "implied_speed_knots", "speed_knots"], "0.000001")
SUB["seg_legacy"] = f"""
  SELECT *, {_BINS} FROM (
    SELECT *, {_FINAL_LEGACY} AS final_speed_knots FROM (
      SELECT {_MEASURES.format(speeds=_RAW)}, gt FROM pairs_vessels WHERE {IS_SEGMENT}))"""
_SIMPLE = f"""SELECT timestamp, {big(MINUTES)} AS date_diff_minutes, mmsi, num, speed_knots, implied_speed_knots,
    lon, lat, next_lon, next_lat, source, {dec('metres')} AS distance, name_of_ship, shiptype, gt, operator,
    operator_code"""
SUB["seg_simple"] = f"{_SIMPLE} FROM pairs_all WHERE {IS_SIMPLE} AND gt >= 300"
SUB["seg_small"] = f"{_SIMPLE} FROM pairs_small WHERE {IS_SIMPLE} AND gt >= 300"

SUB["zone"] = f"""SELECT * FROM (VALUES {_ZONE_ROWS})
    AS t(polygon, vsr_category, vsr_region, datetime_beg, datetime_end)"""
SUB["zone_edge"] = _edges(_ZONE_RINGS)


def zone_hits(segments: str) -> str:
    """Segments in season per zone they meet, with the part inside (convex zones)."""
    return f"""
  SELECT s.mmsi, s.num, s.timestamp, z.polygon, z.vsr_category, z.vsr_region, z.datetime_beg, z.datetime_end,
    sum({ray(P)}) % 2 = 1 AS beg_inside, sum({ray(Q)}) % 2 = 1 AS end_inside,
    min({fraction()}) AS first_cut, max({fraction()}) AS last_cut
  FROM {segments} s
    JOIN zone z ON s.timestamp BETWEEN z.datetime_beg AND z.datetime_end
    JOIN zone_edge e ON e.polygon = z.polygon
  GROUP BY ALL
  HAVING bool_or({crossing()}) OR sum({ray(P)}) % 2 = 1"""


SUB["zone_hit"] = zone_hits("seg")
SUB["zone_hit_legacy"] = zone_hits("seg_legacy")
SUB["zone_hit_small"] = zone_hits("seg_small")
SUB["vsr"] = """
  SELECT s.*, h.polygon, h.vsr_category, h.vsr_region, h.beg_inside, h.end_inside,
    CASE WHEN h.beg_inside THEN 0E0 ELSE h.first_cut END AS t0,
    CASE WHEN h.end_inside THEN 1E0 ELSE h.last_cut END AS t1
  FROM seg s JOIN zone_hit h ON s.mmsi = h.mmsi AND s.num = h.num"""

SUB["flagged"] = """
  SELECT *, CASE WHEN final_speed_bin_num = following THEN 0 WHEN final_speed_bin_num <> following THEN 1 END
    AS seg_chg
  FROM (
    SELECT *, lead(final_speed_bin_num) OVER (PARTITION BY mmsi ORDER BY timestamp, num, timestamp_end)
      AS following
    FROM seg WHERE NOT touches_coast)"""
SUB["numbered"] = """
  SELECT *, CASE WHEN seg_chg = 1 THEN segid - 1 ELSE segid END AS seg_id
  FROM (SELECT *, CAST(sum(seg_chg) OVER (PARTITION BY mmsi ORDER BY timestamp) AS BIGINT) AS segid FROM flagged)"""
SUB["runs"] = f"""
  SELECT mmsi, date, final_speed_bin_num AS speed_bin_num, seg_id,
    {rnd(mean('speed_knots'), 2)} AS avg_speed_knots,
    {rnd(mean('implied_speed_knots'), 2)} AS avg_implied_speed_knots,
    {rnd(mean('calculated_knots'), 2)} AS avg_calculated_knots,
    {rnd(mean('final_speed_knots'), 2)} AS avg_speed_knots_final,
    {rnd('sum(distance_nm)', 2)} AS total_distance_nm,
    sum({dec('segment_time_minutes')}) AS seg_min,
    epoch_us(min(timestamp_beg)) // 1000000 AS unix_beg, epoch_us(max(timestamp_end)) // 1000000 AS unix_end,
    min(timestamp_beg) AS timestamp_beg, max(timestamp_end) AS timestamp_end, touches_coast, region
  FROM numbered
  GROUP BY mmsi, date, seg_id, final_speed_bin_num, touches_coast, region"""

# Lines of a run in time order; a line that does not go on from the one before opens a path.
SUB["hop"] = """
  SELECT *, sum(opens) OVER (PARTITION BY mmsi, date, seg_id, final_speed_bin_num, region
      ORDER BY timestamp, lon, lat) AS path
  FROM (
    SELECT *, CASE WHEN lag(next_lon) OVER w = lon AND lag(next_lat) OVER w = lat THEN 0 ELSE 1 END AS opens,
      lag(next_lon) OVER w AS last_lon, lag(next_lat) OVER w AS last_lat
    FROM numbered
    WINDOW w AS (PARTITION BY mmsi, date, seg_id, final_speed_bin_num, region ORDER BY timestamp, lon, lat))"""
SUB["vertex"] = """
  SELECT mmsi, date, seg_id, final_speed_bin_num, region, path, timestamp, 1 AS part, next_lon AS lon, next_lat AS lat
  FROM hop
  UNION ALL
  SELECT mmsi, date, seg_id, final_speed_bin_num, region, path, timestamp, 0, lon, lat FROM hop WHERE opens = 1"""

_RUN_ID = "concat_ws('|', mmsi, date, coalesce(CAST(seg_id AS VARCHAR), '-'), final_speed_bin_num, region)"
_GAP_M = f"max(CASE WHEN opens = 1 AND last_lon IS NOT NULL THEN {metres('last_lon', 'last_lat', 'lon', 'lat')} END)"
SUB["ladder"] = f"""
  SELECT {_RUN_ID} AS run, CASE {" ".join(f"WHEN {_GAP_M} <= {t} THEN {t}" for t in [5, 10, 50, 100, 250, 500, 750, 1000])}
    END AS tolerance
  FROM hop GROUP BY ALL"""
# Vertices of a run in one row of numbers, on a plane in metres.
SUB["plane"] = f"""
  SELECT v.*, tolerance, pos + 1 = count(*) OVER (PARTITION BY v.run) AS at_end,
    radians(lon) * cos(radians(avg(lat) OVER (PARTITION BY v.run))) * 6371008.8E0 AS x, radians(lat) * 6371008.8E0 AS y
  FROM (SELECT *, {_RUN_ID} AS run, row_number() OVER (PARTITION BY {_RUN_ID} ORDER BY path, timestamp, part) - 1 AS pos
        FROM vertex) v
    JOIN ladder l ON l.run = v.run"""
_SHARE = """CASE WHEN power(b.x - a.x, 2) + power(b.y - a.y, 2) > 0 THEN least(1E0, greatest(0E0,
  ((v.x - a.x) * (b.x - a.x) + (v.y - a.y) * (b.y - a.y)) / (power(b.x - a.x, 2) + power(b.y - a.y, 2)))) ELSE 0E0 END"""
_OFF = f"round(sqrt(power(v.x - a.x - {_SHARE} * (b.x - a.x), 2) + power(v.y - a.y - {_SHARE} * (b.y - a.y), 2)), 6)"


def stayed(plane: str) -> str:
    """Positions that stay: a stretch between two of them is split at the vertex farthest from its chord."""
    return f"""
  WITH RECURSIVE stretch(run, tolerance, f, l) AS (
    SELECT run, tolerance, 0, pos FROM {plane} WHERE at_end AND tolerance IS NOT NULL
    UNION ALL
    SELECT run, tolerance, unnest([f, -best.back]), unnest([-best.back, l]) FROM (
      SELECT s.run, s.tolerance, s.f, s.l, max({{'off': {_OFF}, 'back': -v.pos}}) AS best
      FROM stretch s JOIN {plane} a ON a.run = s.run AND a.pos = s.f JOIN {plane} b ON b.run = s.run AND b.pos = s.l
        JOIN {plane} v ON v.run = s.run AND v.pos > s.f AND v.pos < s.l
      GROUP BY ALL)
    WHERE best.off > tolerance)
  SELECT run, f AS pos FROM stretch UNION SELECT run, l FROM stretch"""


SUB["stayed"] = stayed("plane")
SUB["track_plane"] = """
  SELECT *, pos + 1 = count(*) OVER (PARTITION BY run) AS at_end,
    radians(lon) * cos(radians(avg(lat) OVER (PARTITION BY run))) * 6371008.8E0 AS x, radians(lat) * 6371008.8E0 AS y
  FROM (
    SELECT mmsi, CAST(date_trunc('week', timestamp) AS DATE) AS week, lon, lat, concat_ws('|', mmsi, date_trunc('week', timestamp)) AS run,
      row_number() OVER (PARTITION BY mmsi, date_trunc('week', timestamp) ORDER BY timestamp, lon, lat) - 1 AS pos,
      CASE mmsi % 3 WHEN 0 THEN 1000 WHEN 1 THEN 5000 ELSE 20000 END AS tolerance
    FROM ais WHERE mmsi IS NOT NULL)"""
SUB["track_stayed"] = stayed("track_plane")

SUB["cat"] = f"SELECT * FROM (VALUES {_CATEGORY_ROWS}) AS t(cat_type, ship_category)"
SUB["valid"] = """
  SELECT v.*, r.name_of_ship, r.shiptype, r.operator, r.operator_code, r.technical_manager
  FROM vsr v JOIN reg r ON v.mmsi = r.mmsi AND v.timestamp_beg >= r.start_date AND v.timestamp_end <= r.end_date"""
SUB["ship_seg"] = """
  SELECT v.*, c.ship_category FROM valid v LEFT JOIN cat c ON trim(v.shiptype) = trim(c.cat_type)
  WHERE v.gt >= 300"""


def band(low: int, high: int) -> str:
    return (
        f"sum(CASE WHEN final_speed_knots > {low} AND final_speed_knots <= {high} "
        f"THEN distance_nm ELSE 0 END)"
    )


SHIP = "mmsi, name_of_ship, operator, operator_code, technical_manager, shiptype, ship_category, vsr_region, gt"
SUB["day"] = f"""
  SELECT * REPLACE (coalesce(ship_category, 'OTHER') AS ship_category),
    {percent('total_distance_nm_under_10', 'total_distance_nm')} AS score
  FROM (
    SELECT {SHIP}, date, {rnd(mean('final_speed_knots'), 1)} AS avg_speed_knots,
      {band(0, 10)} AS total_distance_nm_under_10, {band(10, 12)} AS total_distance_nm_btwn_10_12,
      {band(12, 15)} AS total_distance_nm_btwn_12_15, {band(15, 50)} AS total_distance_nm_over_15,
      {band(0, 50)} AS total_distance_nm,
      sum(CASE WHEN final_speed_knots IS NULL THEN distance_nm ELSE 0 END) AS total_distance_nm_weird,
      sum(distance_nm) AS total_distance_nm_wo_filter,
      count(num) AS seg_count, count(DISTINCT date) AS day_count,
      {rnd('max(final_speed_knots)', 3)} AS max_speed_knots, {rnd('min(final_speed_knots)', 3)} AS min_speed_knots,
      {rnd('max(implied_speed_knots)', 3)} AS max_implied_speed_knots,
      {rnd('min(implied_speed_knots)', 3)} AS min_implied_speed_knots,
      max(final_speed_knots) AS max_final_calculated_speed_knots,
      min(final_speed_knots) AS min_final_calculated_speed_knots,
      max(timestamp_end) AS max_timestamp, min(timestamp_beg) AS min_timestamp
    FROM ship_seg GROUP BY {SHIP}, date)"""
SUB["daily"] = f"""
  SELECT *, {rnd(mean_over('score', 'PARTITION BY mmsi ORDER BY date'), 3)} AS rolling FROM day"""

DISTANCES = [
    "total_distance_nm", "total_distance_nm_under_10", "total_distance_nm_btwn_10_12",
    "total_distance_nm_btwn_12_15", "total_distance_nm_over_15",
]
_SUMS = ", ".join(f"sum({d}) AS {d}" for d in DISTANCES)


def ship_rollup(period: str) -> str:
    parts = {"month": "month(date)", "year": "year(date)"}
    dated = ", ".join(f"{big(parts[p])} AS {p}" for p in period.split(", "))
    return f"""
  SELECT *, {percent('total_distance_nm_under_10', 'total_distance_nm')} AS score
  FROM (
    SELECT {SHIP}, {period}, {_SUMS}, {dec(mean('avg_speed_knots'))} AS avg_speed_knots,
      min(min_timestamp) AS min_timestamp, max(max_timestamp) AS max_timestamp,
      {big('sum(day_count)')} AS day_count, {big('sum(seg_count)')} AS seg_count
    FROM (SELECT *, {dated} FROM daily) GROUP BY {SHIP}, {period})"""


def operator_rollup(period: str) -> str:
    parts = {"month": "month(date)", "year": "year(date)"}
    dated = "".join(f", {big(parts[p])} AS {p}" for p in period.split(", ") if p in parts)

    def listing(x: str) -> str:
        return f"string_agg(DISTINCT {x}, ', ' ORDER BY {x})"

    return f"""
  SELECT *, {percent('total_distance_nm_under_10', 'total_distance_nm')} AS score
  FROM (
    SELECT operator, operator_code, vsr_region, {period}, count(DISTINCT mmsi) AS ship_count, {_SUMS},
      {dec('CAST(sum(avg_speed_knots) AS DOUBLE) / count(day_count)')} AS avg_speed_knots,
      max(max_timestamp) AS max_timestamp, min(min_timestamp) AS min_timestamp,
      {listing('CAST(mmsi AS VARCHAR)')} AS mmsi_list, {listing('shiptype')} AS ship_types,
      {listing('name_of_ship')} AS name_of_ships, {listing('ship_category')} AS ship_categories_list,
      CASE WHEN count(DISTINCT ship_category) > 1 THEN 'multi-category'
           WHEN count(DISTINCT ship_category) = 1 THEN max(ship_category) END AS operator_ship_categories
    FROM (SELECT * {dated} FROM daily) GROUP BY operator, operator_code, vsr_region, {period})"""


SUB["month_ship"] = ship_rollup("month, year")
SUB["year_ship"] = ship_rollup("year")
SUB["day_operator"] = operator_rollup("date")
SUB["month_operator"] = operator_rollup("month, year")
SUB["year_operator"] = operator_rollup("year")

_IMPLIED = "CASE WHEN implied_speed_knots > 0 AND implied_speed_knots <= 50 THEN implied_speed_knots END"
SUB["chosen"] = f"""
  SELECT *, {speed_bin('speed_knots_2', 'NULL')} AS speed_bin_num
  FROM (
    SELECT *, CASE WHEN calculated_knots > 0 AND calculated_knots <= 50 THEN calculated_knots
      ELSE speed_knots_1 END AS speed_knots_2
    FROM (
      SELECT *, CAST(timestamp AS DATE) AS date, {calculated()} AS calculated_knots,
        metres * 0.000539957E0 AS distance_nm, {_IMPLIED} AS speed_knots_1
      FROM pairs_vessels))"""
SUB["numbered_rows"] = """
  SELECT *, CASE WHEN seg_chg = 1 THEN segid - 1 ELSE segid END AS seg_id
  FROM (
    SELECT *, CAST(sum(seg_chg) OVER (PARTITION BY mmsi ORDER BY timestamp, num
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segid
    FROM (
      SELECT *, CASE WHEN speed_bin_num = following THEN 0 WHEN speed_bin_num <> following THEN 1 END AS seg_chg
      FROM (SELECT *, lead(speed_bin_num) OVER (PARTITION BY mmsi ORDER BY timestamp, num) AS following
            FROM chosen)))"""
_SPAN = "(date_diff('microsecond', min(timestamp), max(next_ts)) // 1000000)"
SUB["hop_rows"] = """
  SELECT *, CASE WHEN lag(next_lon) OVER w = lon AND lag(next_lat) OVER w = lat THEN 0 ELSE 1 END AS opens
  FROM numbered_rows
  WINDOW w AS (PARTITION BY mmsi, date, seg_id, speed_bin_num ORDER BY timestamp, num)"""
SUB["runs_rows"] = f"""
  SELECT * FROM (
    SELECT mmsi, date, speed_bin_num, seg_id, {rnd(mean('speed_knots'), 2)} AS avg_speed_knots,
      {rnd(mean('implied_speed_knots'), 2)} AS avg_implied_speed_knots,
      {rnd(mean('calculated_knots'), 2)} AS avg_calculated_knots,
      {rnd(mean('speed_knots_1'), 2)} AS avg_speed_knots_1,
      {rnd(mean('speed_knots_2'), 2)} AS avg_speed_knots_final,
      {rnd(f"sum({dec('distance_nm')})", 2)} AS total_distance_nm,
      {rnd(f'{_SPAN} / 60E0', 2)} AS seg_min,
      epoch_us(min(timestamp)) // 1000000 AS unix_beg, epoch_us(max(next_ts)) // 1000000 AS unix_end,
      min(timestamp) AS timestamp_beg, max(next_ts) AS timestamp_end,
      CASE WHEN {_SPAN} / 60E0 <= 120 THEN
        {big('sum(CASE WHEN next_ts IS NOT NULL THEN 1 + opens ELSE 0 END)')} END AS npts
    FROM hop_rows GROUP BY mmsi, date, seg_id, speed_bin_num)
  WHERE npts > 1 AND total_distance_nm > 0 AND total_distance_nm < 100"""


# Subqueries that a recursion reads in every round.
READ_OFTEN = {"plane", "track_plane"}


def query(final: str) -> str:
    """The statement with the subqueries it refers to, in dependency order."""
    ordered: list[str] = []

    def visit(statement: str) -> None:
        words = set(re.findall(r"\b\w+\b", statement))
        for name in SUB:
            if name in words and name not in ordered and _referred(name, statement):
                visit(SUB[name])
                ordered.append(name)

    visit(final)
    kept = {name: "MATERIALIZED " if name in READ_OFTEN else "" for name in ordered}
    head = ",\n".join(f"{name} AS {kept[name]}({SUB[name]})" for name in ordered)
    return f"WITH {head}\n{final}" if ordered else final


def _referred(name: str, statement: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{name}\b", statement) is not None
