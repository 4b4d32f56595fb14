"""Distributed tests and clips of short lines against polygons.

Polygons are cut up by a grid, at several cell sizes. A row of the resulting index
holds one polygon as seen from one cell: its edges in the block of cells around that
cell, and whether the cell's reference point lies inside it. A line goes to the
smallest cell size that is at least its own extent, and there to the one cell of its
first point. As the line then lies inside the block, that row decides everything
about it: relation and clip need no other row. So each line meets each polygon at most
once, by an equi join on the cell, with no pairs to remove afterwards.

The index is built from edges as rows. They are spread over tasks whatever polygon they
belong to, joined to the cells whose blocks they reach, and grouped by polygon and cell.
Which cells have their reference point inside follows from where the border passes the
reference latitude of a row of cells: between its first and second pass, its third and
fourth, and so on. Cells far from the border carry no edges, and cells outside the
polygon's reach do not occur. The largest cell size spans the globe, so lines of any
length are covered.

Longitudes may jump at the 180 degree meridian. Rings and lines are unwrapped, so that
they go on beyond it, and polygons are indexed three times, a turn of the globe apart.
Rings around a pole are not supported.
"""

from __future__ import annotations

import hashlib
import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fairwake.functions import geo
from fairwake.sources import tables

CELL_SIZES = (0.125, 1.0, 8.0, 360.0)
CELL = ["_level", "_ix", "_iy"]
CELL_COLUMNS = [*CELL, "_size", "_p", "_q"]
# Largest index that is broadcast, and what a cell (with its polygon's attributes) and
# an edge take in memory, rounded up.
BROADCAST_LIMIT_BYTES = 64 << 20
CELL_BYTES, EDGE_BYTES = 256, 80
# Copies of an index that is not broadcast, where a join type cannot be split by Spark.
SALTS = 8
BUILD = 1  # changes with what the rows of a stored index mean
# Degrees by which a computed longitude may be off.
SLACK = "1E-9D"
# Reference points sit off-centre by an irrational share, so that polygon vertices and
# edges given in round degrees do not meet them.
OFF_CENTRE = 0.41421356237


# ---- polygons -------------------------------------------------------------------


def polygon_edges(rings: str) -> str:
    """Edges of a polygon as an array of struct<a, b>; rings need not repeat a point."""
    edges = "transform(ring, (p, i) -> named_struct('a', p, 'b', get(ring, (i + 1) % size(ring))))"
    proper = f"filter({edges}, e -> not {geo.same_point('e.a', 'e.b')})"
    return f"flatten(transform({rings}, ring -> {proper}))"


def geodesic_edges(edges: str, max_degrees: float = 0.1) -> str:
    """Split each edge along its great circle so that no piece is longer than given.

    New vertices are rounded to nine digits, a tenth of a millimetre, so that they do not
    depend on the last bits of the platform's trigonometry.
    """

    def vertex(k: str) -> str:
        def mixed(term: str) -> str:
            t = f"(({k}) / cast(e.n as double))"
            of_a, of_b = term.format("e.a"), term.format("e.b")
            return f"((sin((1D - {t}) * e.arc) * {of_a} + sin({t} * e.arc) * {of_b}) / sin(e.arc))"

        x = mixed("cos(radians({0}.lat)) * cos(radians({0}.lon))")
        y = mixed("cos(radians({0}.lat)) * sin(radians({0}.lon))")
        z = mixed("sin(radians({0}.lat))")
        lon = f"round(degrees(atan2({y}, {x})), 9)"
        between = geo.point(
            f"({lon} + 360D * round((e.a.lon - {lon}) / 360D))",
            f"round(degrees(atan2({z}, sqrt({x} * {x} + {y} * {y}))), 9)",
        )
        return f"case {k} when 0 then e.a when e.n then e.b else {between} end"

    arc = geo.haversine_m("e.a", "e.b", radius=1.0)
    n = f"int(greatest(1, ceil(degrees({arc}) / {max_degrees}D + 1E-9D)))"
    measured = f"transform({edges}, e -> named_struct('a', e.a, 'b', e.b, 'arc', {arc}, 'n', {n}))"
    pieces = (
        "transform(sequence(0, e.n - 1),"
        f" k -> named_struct('a', {vertex('k')}, 'b', {vertex('k + 1')}))"
    )
    return f"flatten(transform({measured}, e -> {pieces}))"


def polygon_index(
    polygons: DataFrame, rings: str, attributes: list[str], *, geodesic: bool = False
) -> DataFrame:
    """One row per polygon and cell it can matter in.

    Columns: the attributes, the cell, `inside` (the cell's reference point lies in the
    polygon) and `edges` (those in the block of cells around it). Equal polygons are
    indexed once and their rows repeated.
    """
    keyed = polygons.select(
        F.xxhash64(*attributes, rings).alias("_polygon"), *attributes, F.col(rings).alias("_rings")
    )
    distinct = keyed.groupBy("_polygon").agg(
        *[F.first(c).alias(c) for c in [*attributes, "_rings"]], F.count(F.lit(1)).cast("int").alias("_repeats")
    )
    edges = _edge_rows(distinct, geodesic)
    near = _edges_by_cell(edges)
    inner = _inner_cells(edges).withColumn("_edge", F.lit(None).cast(near.schema["_edge"].dataType))
    seen = near.unionByName(inner)
    cells = seen.groupBy("_polygon", *CELL).agg(
        F.max(F.col("_edge").isNull()).alias("inside"), F.collect_list("_edge").alias("edges")
    )
    return (
        cells.join(distinct.drop("_rings"), "_polygon")
        .withColumn("_copy", F.explode(F.array_repeat("_polygon", F.col("_repeats"))))
        .select(*attributes, *CELL, "inside", "edges")
    )


def _edge_rows(polygons: DataFrame, geodesic: bool) -> DataFrame:
    """(_polygon, _edge): every edge, unwrapped and a turn to either side, in as many tasks as rows allow."""
    jump = "abs(get(_points, i).lon - get(_points, i - 1).lon) > 180"
    turn = "if(get(_points, i).lon < get(_points, i - 1).lon, 1, -1)"
    later = "case when size(_points) > 1 then sequence(1, size(_points) - 1) else array() end"
    jumps = f"transform(filter({later}, i -> {jump}), i -> named_struct('i', i, 'turn', {turn}))"
    numbered = (
        "transform(_points, (p, i) -> named_struct('i', i, 'a', p, 'b', get(_points, (i + 1) % size(_points))))"
    )
    proper = f"filter({numbered}, e -> not {geo.same_point('e.a', 'e.b')})"
    turned = "aggregate(filter(_jumps, j -> j.i <= _e.i), 0, (n, j) -> n + j.turn)"
    spread = int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    raw = (
        polygons.select("_polygon", F.posexplode("_rings").alias("_ring", "_points"))
        .select("_polygon", "_ring", "_points", F.expr(jumps).alias("_jumps"))  # once a ring, not once an edge
        .select("_polygon", "_ring", "_jumps", F.explode(F.expr(proper)).alias("_e"))
        # a number keeps Spark from putting a layer of few bytes into one task
        .repartition(spread, "_polygon", "_ring", "_e.i")
    )
    begun = raw.select("_polygon", "_e.a", "_e.b", F.expr(f"_e.a.lon + 360D * {turned}").alias("_x"))
    end = "b.lon + 360D * round((_x - b.lon) / 360D)"
    whole = begun.selectExpr(
        "_polygon", f"named_struct('a', {geo.point('_x', 'a.lat')}, 'b', {geo.point(end, 'b.lat')}) as _edge"
    )
    if geodesic:
        whole = whole.select("_polygon", F.explode(F.expr(geodesic_edges("array(_edge)"))).alias("_edge"))
    moved = [geo.point(f"_edge.{v}.lon + _shift", f"_edge.{v}.lat") for v in "ab"]
    return whole.withColumn("_shift", F.explode(F.expr("array(-360D, 0D, 360D)"))).selectExpr(
        "_polygon", f"named_struct('a', {moved[0]}, 'b', {moved[1]}) as _edge"
    )


def _sized(edges: DataFrame) -> DataFrame:
    levels = F.explode(F.sequence(F.lit(0), F.lit(len(CELL_SIZES) - 1)))
    return edges.withColumn("_level", levels).withColumn("_size", _size_of("_level"))


def _edges_by_cell(edges: DataFrame) -> DataFrame:
    """Each edge in every cell whose block of cells it reaches: (_polygon, cell, _edge)."""
    a, b = "_edge.a", "_edge.b"
    rows = _sized(edges).withColumn(
        "_iy",
        F.explode(_range(f"floor(least({a}.lat, {b}.lat) / _size) - 1", f"floor(greatest({a}.lat, {b}.lat) / _size) + 1", 90)),
    )

    def longitude(row: str) -> str:  # of the edge where it enters or leaves the row's block
        share = f"(({row}) * _size - {a}.lat) / ({b}.lat - {a}.lat)"
        return f"({a}.lon + ({b}.lon - {a}.lon) * least(1D, greatest(0D, {share})))"

    ends = [f"if({a}.lat = {b}.lat, {v}.lon, {longitude(row)})" for v, row in ((a, "_iy - 1"), (b, "_iy + 2"))]
    reached = rows.selectExpr("*", f"{ends[0]} as _x0", f"{ends[1]} as _x1")
    columns = _range(
        f"floor((least(_x0, _x1) - {SLACK}) / _size) - 1", f"floor((greatest(_x0, _x1) + {SLACK}) / _size) + 1", 180
    )
    return reached.withColumn("_ix", F.explode(columns)).select("_polygon", *CELL, "_edge")


def _inner_cells(edges: DataFrame) -> DataFrame:
    """Cells whose reference point lies inside, from where the border passes a row's reference latitude."""
    a, b = "_edge.a", "_edge.b"
    rows = _sized(edges).withColumn(
        "_iy",
        F.explode(
            _range(
                f"floor(least({a}.lat, {b}.lat) / _size - {OFF_CENTRE}D)",
                f"floor(greatest({a}.lat, {b}.lat) / _size - {OFF_CENTRE}D) + 1",
                90,
            )
        ),
    )
    reference = _reference("_iy")
    passes = rows.where(f"({a}.lat > {reference}) <> ({b}.lat > {reference})").selectExpr(
        "_polygon",
        "_level",
        "_size",
        "_iy",
        f"{a}.lon + ({b}.lon - {a}.lon) * ({reference} - {a}.lat) / ({b}.lat - {a}.lat) as _x",
    )
    # the last cell of the row whose reference point lies before the pass
    counted = passes.withColumn("_before", F.expr(f"ceil(_x / _size - {OFF_CENTRE}D) - 1")).selectExpr(
        "*",
        "row_number() OVER (PARTITION BY _polygon, _level, _iy ORDER BY _x) as _pass",
        "lead(_before) OVER (PARTITION BY _polygon, _level, _iy ORDER BY _x) as _until",
    )
    runs = counted.where("_pass % 2 = 1")
    return runs.withColumn("_ix", F.explode(_range("_before + 1", "_until", 180))).select("_polygon", *CELL)


def _range(low: str, high: str, limit: int) -> Column:
    """Cells from low to high, as far as points within `limit` degrees have them."""
    first, last = f"greatest({low}, floor(-{limit}D / _size))", f"least({high}, floor({limit}D / _size))"
    return F.expr(f"case when {first} <= {last} then sequence({first}, {last}) else array() end")


def _size_of(level: str) -> Column:
    return F.expr(f"get(array({', '.join(f'{s}D' for s in CELL_SIZES)}), {level})")


def _reference(cell: str) -> str:
    return f"(({cell} + {OFF_CENTRE}D) * _size)"


# ---- lines ----------------------------------------------------------------------


def with_cell(lines: DataFrame, line: str) -> DataFrame:
    """Add the one index cell that decides about each two-point line, and its unwrapped ends."""
    p, q = geo.first(line), geo.second(line)
    over = f"case when {q}.lon - {p}.lon > 180 then -360D when {p}.lon - {q}.lon > 180 then 360D else 0D end"
    extent = "greatest(abs(_p.lon - _q.lon), abs(_p.lat - _q.lat))"
    cases = " ".join(f"when {extent} <= {s}D then {i}" for i, s in enumerate(CELL_SIZES[:-1]))
    return (
        lines.withColumn("_p", F.expr(p))
        .withColumn("_q", F.expr(geo.point(f"{q}.lon + {over}", f"{q}.lat")))
        .withColumn("_level", F.expr(f"case {cases} else {len(CELL_SIZES) - 1} end"))
        .withColumn("_size", _size_of("_level"))
        .withColumn("_ix", F.expr("floor(_p.lon / _size)"))
        .withColumn("_iy", F.expr("floor(_p.lat / _size)"))
    )


def contains(point: str, inside: str, edges: str) -> str:
    """Whether a point of the cell's block lies in the polygon."""
    reference = geo.point(_reference("_ix"), _reference("_iy"))
    swaps = f"size(filter({edges}, e -> {geo.swaps_side(point, reference, 'e')}))"
    return f"({inside} <> ({swaps} % 2 = 1))"


def intersects(inside: str, edges: str) -> str:
    """Whether the line that `with_cell` took apart meets the polygon."""
    meets_border = f"exists({edges}, e -> {geo.crosses('_p', '_q', 'e')})"
    return f"({meets_border} or {contains('_p', inside, edges)})"


def with_clip(lines: DataFrame, line: str, into: str) -> DataFrame:
    """Add the parts of each line within its polygon, as a multiline.

    `lines` comes from `join_polygons`. A line that lies within the polygon comes back
    as a single part equal to itself; one that only touches it gives no part.
    """
    p, q = "_p", "_q"
    crossed = f"filter(edges, e -> {geo.crosses(p, q, 'e')})"
    met = f"transform({crossed}, e -> {geo.crossing_fraction(p, q, 'e')})"
    cuts = (
        f"array_sort(array_distinct(concat(array(0D), filter({met}, t -> t > 0 and t < 1),"
        " array(1D))))"
    )
    middle = geo.along(p, q, "((get(_cuts, i - 1) + get(_cuts, i)) / 2D)")
    middles = f"transform(sequence(1, size(_cuts) - 1), i -> {middle})"

    def is_kept(i: str) -> str:
        return f"({i} >= 0 and coalesce(get(_kept, {i}), false))"

    def vertex(t: str) -> str:
        lat = f"{p}.lat + ({q}.lat - {p}.lat) * {t}"
        back = geo.point("x - case when x > 180 then 360D when x < -180 then -360D else 0D end", lat)
        between = f"get(transform(array({p}.lon + ({q}.lon - {p}.lon) * {t}), x -> {back}), 0)"
        return f"case {t} when 0D then {geo.first(line)} when 1D then {geo.second(line)} else {between} end"

    pieces = "sequence(0, size(_kept) - 1)"
    first = f"filter({pieces}, i -> {is_kept('i')} and not {is_kept('i - 1')})"
    last = f"filter({pieces}, i -> {is_kept('i')} and not {is_kept('i + 1')})"
    part = f"array({vertex('get(_cuts, i)')}, {vertex('get(_cuts, j + 1)')})"
    return (
        lines.withColumn("_cuts", F.expr(cuts))
        .withColumn("_kept", F.expr(f"transform({middles}, m -> {contains('m', 'inside', 'edges')})"))
        .withColumn(into, F.expr(f"zip_with({first}, {last}, (i, j) -> {part})"))
        .drop("_cuts", "_kept")
    )


def is_whole(parts: str, line: str) -> str:
    """Whether a clip kept the whole line, that is, the polygon covers it."""
    return f"(size({parts}) = 1 and get({parts}, 0) = {line})"


# ---- stored indexes -------------------------------------------------------------


class Index(NamedTuple):
    """A polygon index that is written, and its size."""

    rows: DataFrame
    cells: int
    edges: int


def stored_index(
    polygons: DataFrame, rings: str, attributes: list[str], *, geodesic: bool = False, folder: str | None = None
) -> Index:
    """The polygon index from below `folder`, written there if this layer was not yet.

    A layer is known by a hash of its rows. An index counts once its entry stands, which
    names its files and their size, so an index that was lost half-way is built again.
    """
    spark = polygons.sparkSession
    folder = folder or f"{tables.shared_folder(spark)}/polygon-indexes"
    columns = [*attributes, rings]
    state = polygons.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    options = [polygons.select(*columns).schema.json(), geodesic, CELL_SIZES, BUILD]
    layer = hashlib.sha256(json.dumps([*map(str, state), *options]).encode()).hexdigest()
    index = polygon_index(polygons, rings, attributes, geodesic=geodesic)
    entry = tables.read_note(spark, f"{folder}/{layer}.json")
    if entry is None:
        seen, path = Observation(), tables.unused(f"{folder}/{layer[:16]}")
        counted = F.count(F.lit(1)).alias("cells"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges")
        index.observe(seen, *counted).write.parquet(path)
        entry = {"path": path, **seen.get}
        tables.write_note(spark, f"{folder}/{layer}.json", entry)
    return Index(spark.read.schema(index.schema).parquet(entry["path"]), entry["cells"], entry["edges"])


# ---- joins ----------------------------------------------------------------------


def join_polygons(
    lines: DataFrame, line: str, index: DataFrame | Index, condition: str | None = None
) -> DataFrame:
    """One row per line and polygon that meet, plus `inside` and `edges` for a clip.

    An index too large to be broadcast meets the lines in a merge join by cell, whose hot
    cells adaptive execution splits.
    """
    rows, fits = measured(index)
    joined = with_cell(lines, line).join(F.broadcast(rows) if fits else rows.hint("merge"), CELL)
    if condition is not None:
        joined = joined.where(condition)
    return joined.where(intersects("inside", "edges"))


def with_touch_flag(
    lines: DataFrame, line: str, polygons: DataFrame | Index, rings: str = "", into: str = "touches", **options
) -> DataFrame:
    """Add whether each line meets any of the polygons; FALSE if there are none.

    A line looks for one polygon of its cell that it meets, so polygons need not be put
    together. Spark does not split this kind of join; where the index is not broadcast,
    its rows are repeated `SALTS` times and the lines of a cell are dealt to them.
    """
    index = polygons if isinstance(polygons, Index) else stored_index(polygons, rings, [], **options)
    rows, fits = measured(index)
    named = [F.col(c).alias(f"{c}_of") for c in CELL]
    salts = 1 if fits else SALTS
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    dealt = with_cell(lines, line).withColumn("_salt", F.expr(f"pmod(xxhash64(_p, _q), {salts})"))
    salted = rows.select(*named, "inside", "edges", copies.alias("_salt_of"))
    same_cell = " and ".join(f"{c} = {c}_of" for c in [*CELL, "_salt"])
    found = (
        f"exists(select /*+ {'broadcast' if fits else 'merge'}(i) */ 1 from {{polygons}} i"
        f" where {same_cell} and {intersects('inside', 'edges')})"
    )
    flagged = lines.sparkSession.sql(f"select *, {found} as {into} from {{lines}}", lines=dealt, polygons=salted)
    return flagged.drop(*CELL_COLUMNS, "_salt")


def measured(index: DataFrame | Index) -> tuple[DataFrame, bool]:
    """The index's rows, and whether they are few enough to be broadcast.

    Spark cannot foresee how many cells a polygon fills. A stored index knows its size;
    one that is not stored is counted, which builds it.
    """
    if not isinstance(index, Index):
        cells, edges = index.selectExpr("count(*)", "coalesce(sum(size(edges)), 0)").first()
        index = Index(index, cells, edges)
    return index.rows, index.cells * CELL_BYTES + index.edges * EDGE_BYTES <= BROADCAST_LIMIT_BYTES
