"""Points, lines and their measures, as Spark SQL expression text.

A point is struct<lon, lat> in degrees, a line an array of points, a multiline an
array of lines, a polygon an array of rings, an edge struct<a, b> of two points. The
functions take the text of their operands (column or lambda variable names) and return
the text of the result, so that they nest within SQL's higher-order functions; wrap the
outermost one in `expr`.

Tests treat edges as straight in longitude and latitude; `operators.spatial` inserts
great-circle vertices first where long edges matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8


def point(lon: str, lat: str) -> str:
    return f"named_struct('lon', cast({lon} as double), 'lat', cast({lat} as double))"


def first(line: str) -> str:
    return f"get({line}, 0)"


def second(line: str) -> str:
    return f"get({line}, 1)"


def haversine_m(a: str, b: str, radius: float = EARTH_RADIUS_M) -> str:
    """Great-circle distance of two points in metres."""
    half_lat = f"((radians({b}.lat) - radians({a}.lat)) / 2D)"
    half_lon = f"((radians({b}.lon) - radians({a}.lon)) / 2D)"
    h = (
        f"sin({half_lat}) * sin({half_lat}) + (cos(radians({a}.lat)) * cos(radians({b}.lat))"
        f" * sin({half_lon}) * sin({half_lon}))"
    )
    return f"(asin(sqrt({h})) * {2 * radius!r}D)"


def same_point(a: str, b: str) -> str:
    return f"({a}.lon = {b}.lon and {a}.lat = {b}.lat)"


def side(a: str, b: str, p: str) -> str:
    """Positive when p lies left of the direction a to b, zero when on it."""
    return (
        f"(({b}.lon - {a}.lon) * ({p}.lat - {a}.lat)"
        f" - ({b}.lat - {a}.lat) * ({p}.lon - {a}.lon))"
    )


def spans_overlap(a0: str, a1: str, b0: str, b1: str) -> str:
    return (
        f"(least({a0}, {a1}) <= greatest({b0}, {b1}) and least({b0}, {b1}) <= greatest({a0}, {a1}))"
    )


def crosses(p: str, q: str, edge: str) -> str:
    """Whether the line p-q and the edge have a point in common, ends included."""
    a, b = f"{edge}.a", f"{edge}.b"
    return (
        f"({spans_overlap(f'{p}.lon', f'{q}.lon', f'{a}.lon', f'{b}.lon')}"
        f" and {spans_overlap(f'{p}.lat', f'{q}.lat', f'{a}.lat', f'{b}.lat')}"
        f" and {side(a, b, p)} * {side(a, b, q)} <= 0"
        f" and {side(p, q, a)} * {side(p, q, b)} <= 0)"
    )


def swaps_side(p: str, q: str, edge: str) -> str:
    """Whether going from p to q passes through the edge, for counting parity."""
    a, b = f"{edge}.a", f"{edge}.b"
    return (
        f"(({side(p, q, a)} > 0) <> ({side(p, q, b)} > 0)"
        f" and ({side(a, b, p)} > 0) <> ({side(a, b, q)} > 0))"
    )


def along(p: str, q: str, t: str) -> str:
    """Point at fraction t of the line p-q."""
    return point(f"{p}.lon + ({q}.lon - {p}.lon) * {t}", f"{p}.lat + ({q}.lat - {p}.lat) * {t}")


def crossing_fraction(p: str, q: str, edge: str) -> str:
    """Where along p-q the edge is met; NULL if they run parallel."""
    from_p, from_q = side(f"{edge}.a", f"{edge}.b", p), side(f"{edge}.a", f"{edge}.b", q)
    return f"case when {from_p} <> {from_q} then {from_p} / ({from_p} - {from_q}) end"


def length_m(paths: str) -> Column:
    """Total length of a multiline in metres."""
    hop = haversine_m("get(path, i - 1)", "get(path, i)")
    hops = f"transform(sequence(1, size(path) - 1), i -> {hop})"
    path = f"case when size(path) > 1 then aggregate({hops}, 0D, (sum, hop) -> sum + hop) else 0D end"
    return F.expr(f"aggregate(transform({paths}, path -> {path}), 0D, (sum, one) -> sum + one)")


def point_count(paths: str) -> Column:
    return F.expr(f"aggregate({paths}, 0L, (sum, path) -> sum + size(path))")


def with_chained(rows: DataFrame, hops: str, into: str) -> DataFrame:
    """Replace an array of struct<..., beg, end> hops, taken in order, by a multiline.

    A hop that starts where the one before ended continues its path; any other hop
    starts a new path. Done in steps, so that no array is computed once per element, each
    `once`: a filter on the result, also one that Spark adds before the result is exploded,
    would otherwise move below the steps with all of them put into each other.
    """
    goes_on = same_point(f"get({hops}, i).beg", f"get({hops}, i - 1).end")
    stop = f"coalesce(get(_starts, k + 1), size({hops}))"
    path = (
        f"concat(array(get({hops}, start).beg),"
        f" transform(slice({hops}, start + 1, {stop} - start), hop -> hop.end))"
    )
    positions = f"case when size({hops}) > 0 then sequence(0, size({hops}) - 1) end"
    return (
        rows.withColumn(hops, once(F.array_sort(hops)))
        .withColumn("_starts", once(F.expr(f"filter({positions}, i -> i = 0 or not {goes_on})")))
        .withColumn(into, once(F.expr(f"transform(_starts, (start, k) -> {path})")))
        .drop("_starts", hops)
    )


def once(value: Column) -> Column:
    """The value from a generator of one row.

    Spark neither repeats a generator's expression where its result is used nor moves
    filters on the result below it, which for long expressions takes the optimizer minutes.
    """
    return F.explode(F.array(value))


def path_gaps_m(paths: str) -> Column:
    """Distances from the end of each path to the start of the next one."""
    last = f"get(get({paths}, i - 1), size(get({paths}, i - 1)) - 1)"
    gap = haversine_m(last, f"get(get({paths}, i), 0)")
    return F.expr(
        f"case when size({paths}) > 1 then"
        f" transform(sequence(1, size({paths}) - 1), i -> {gap}) end"
    )
