"""Straightening of run geometries that consist of several paths.

The tolerance is chosen, and the line simplified, with array expressions; no row leaves
the JVM, and runs that need no straightening pass untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.functions import geo

# Tolerances tried, in metres.
TOLERANCES_M = [5, 10, 50, 100, 250, 500, 750, 1000]
# Distances from a chord count in whole micrometres, so that equal ones are equal on any platform.
DIGITS = 6


def with_tolerance(runs: DataFrame, paths: str, into: str, gap: str = "_gap") -> DataFrame:
    """Add the smallest tolerance that joins all paths into one, and the gap it bridges.

    NULL where there is a single path, or no tolerance is enough.
    """
    tolerance = F
    for metres in TOLERANCES_M:
        tolerance = tolerance.when(F.col(gap) <= metres, F.lit(metres))
    return runs.withColumn(gap, F.array_max(geo.path_gaps_m(paths))).withColumn(
        into, tolerance.otherwise(F.lit(None)).cast("bigint")
    )


def with_straightened(runs: DataFrame, paths: str, into: str) -> DataFrame:
    """Add the paths as one simplified line where a tolerance allows it, else unchanged."""
    needed = F.col("_tolerance").isNotNull()
    chosen = with_tolerance(runs, paths, "_ladder").withColumn("_tolerance", geo.once(F.col("_ladder")))
    joined = chosen.withColumn("_joined", geo.once(F.when(needed, F.flatten(paths))))
    line = F.expr("array(transform(_kept, i -> get(_joined, i)))")
    return (
        with_kept_vertices(joined, "_joined", "_tolerance", "_kept")
        .withColumn(into, geo.once(F.when(needed, line).otherwise(F.col(paths))))
        .drop("_gap", "_ladder", "_tolerance", "_joined", "_kept")
    )


def with_kept_vertices(rows: DataFrame, line: str, tolerance: str, into: str) -> DataFrame:
    """Add the positions of the vertices that stay when a line is simplified to a tolerance.

    In rounds: between every two neighbouring vertices that stay, the vertex farthest from
    their chord joins them while it is farther away than the tolerance (metres on a local
    plane; of equally far ones the first). A round looks at each vertex once, and rounds end
    when none joins, which takes as many as the longest chain of such choices.
    """
    turn = f"get({line}, 0).lon"
    near = f"(v.lon - case when v.lon - {turn} > 180 then 360D when {turn} - v.lon > 180 then -360D else 0D end)"
    metres = f"{geo.EARTH_RADIUS_M!r}D"
    mean = f"(aggregate({line}, 0D, (s, v) -> s + v.lat) / size({line}))"
    plane = (
        f"transform({line}, v -> named_struct('x', radians({near}) * _scale * {metres}, 'y', radians(v.lat) * {metres}))"
    )
    a, b, v = "get(_plane, f)", "get(_plane, l)", "get(_plane, m)"
    # the chord's ends once per stretch, by binding them as the element of a one-element array
    chord = f"named_struct('f', f, 'l', l, 'x', {a}.x, 'y', {a}.y, 'dx', {b}.x - {a}.x, 'dy', {b}.y - {a}.y)"
    px, py = f"({v}.x - c.x)", f"({v}.y - c.y)"
    length = "(c.dx * c.dx + c.dy * c.dy)"
    share = (
        f"case when {length} > 0 then least(1D, greatest(0D, ({px} * c.dx + {py} * c.dy) / {length})) else 0D end"
    )
    off = f"sqrt(power({px} - t * c.dx, 2) + power({py} - t * c.dy, 2))"
    distance = f"round(get(transform(array({share}), t -> {off}), 0), {DIGITS})"
    candidates = f"transform(sequence(c.f + 1, c.l - 1), m -> named_struct('off', {distance}, 'rank', -m))"
    farthest = f"array_max({candidates})"
    chords = (
        "transform(filter(transform(sequence(1, size(k) - 1), i -> struct(get(k, i - 1) as f, get(k, i) as l)),"
        f" s -> s.l - s.f > 1), s -> get(transform(array(s.f), f -> get(transform(array(s.l), l -> {chord}), 0)), 0))"
    )
    joining = f"transform(filter(transform({chords}, c -> {farthest}), d -> d.off > {tolerance}), d -> -d.rank)"
    grown = f"array_sort(concat(k, {joining}))"
    step = f"case when s.done then s else get(transform(array(s.kept), k -> {_state(grown)}), 0) end"
    ends = f"case when size({line}) > 0 then array_distinct(array(0, size({line}) - 1)) else array() end"
    begin = f"named_struct('kept', cast({ends} as array<int>), 'done', size({line}) < 3)"
    rounds = f"aggregate(sequence(1, greatest(size({line}), 1)), {begin}, (s, r) -> {step})"
    return (
        rows.withColumn("_scale", F.expr(f"cos(radians({mean}))"))
        .withColumn("_plane", geo.once(F.expr(f"case when {tolerance} is not null then {plane} end")))
        .withColumn(into, geo.once(F.expr(f"case when {tolerance} is not null then {rounds}.kept end")))
        .drop("_scale", "_plane")
    )


def _state(grown: str) -> str:
    """After a round: what is kept, and whether nothing joined."""
    return f"get(transform(array({grown}), g -> named_struct('kept', g, 'done', size(g) = size(k))), 0)"
