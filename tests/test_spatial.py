"""Spatial tests and clips against a brute-force check on small polygons."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fairwake.functions import geo
from fairwake.functions.simplify import with_kept_vertices, with_straightened, with_tolerance
from fairwake.operators import spatial

SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
CONCAVE = [(5.0, 0.0), (9.0, 0.0), (9.0, 3.0), (8.0, 3.0), (8.0, 1.0), (6.0, 1.0), (6.0, 3.0), (5.0, 3.0)]
HOLE = [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5)]


def polygons(spark, *shapes):
    rows = [(name, rings) for name, rings in shapes]
    return spark.createDataFrame(rows, "name string, geom array<array<struct<lon:double,lat:double>>>")


def lines(spark, points):
    rows = [(i, [p, q]) for i, (p, q) in enumerate(points)]
    return spark.createDataFrame(rows, "i int, line array<struct<lon:double,lat:double>>")


def inside(p, rings):
    odd = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > p[1]) != (y2 > p[1]) and p[0] < (x2 - x1) * (p[1] - y1) / (y2 - y1) + x1:
                odd += 1
    return odd % 2 == 1


def clipped(spark, shape, points):
    index = spatial.polygon_index(polygons(spark, ("p", shape)), "geom", ["name"])
    met = spatial.join_polygons(lines(spark, points), "line", index)
    found = spatial.with_clip(met, "line", "parts").withColumn(
        "covered", F.expr(spatial.is_whole("parts", "line"))
    )
    return {
        r.i: ([[tuple(v) for v in part] for part in r.parts], r.covered)
        for r in found.select("i", "parts", "covered").collect()
    }


def test_relations_with_a_square(spark):
    found = clipped(
        spark,
        [SQUARE],
        [
            ((0.5, 0.5), (1.5, 1.25)),  # inside
            ((3.0, 0.5), (4.0, 0.5)),  # outside
            ((1.0, 1.0), (3.0, 1.0)),  # leaves
            ((-1.0, 1.0), (3.0, 1.0)),  # passes through
            ((2.0, 3.0), (3.0, 2.0)),  # outside, near a corner
            ((1.0, 3.0), (3.0, 1.0)),  # touches a corner
            ((-50.0, 1.0), (50.0, 1.0)),  # longer than any cell but the last
        ],
    )
    assert found[0] == ([[(0.5, 0.5), (1.5, 1.25)]], True)
    assert 1 not in found and 4 not in found
    assert found[2] == ([[(1.0, 1.0), (2.0, 1.0)]], False)
    assert found[3] == ([[(0.0, 1.0), (2.0, 1.0)]], False)
    assert found[5] == ([], False)
    ((beg, end),), covered = found[6]
    assert not covered and beg == pytest.approx((0.0, 1.0)) and end == pytest.approx((2.0, 1.0))


def test_concave_polygon_and_hole_give_several_parts(spark):
    parts, covered = clipped(spark, [CONCAVE], [((4.5, 2.0), (9.5, 2.0))])[0]
    assert not covered and parts == [[(5.0, 2.0), (6.0, 2.0)], [(8.0, 2.0), (9.0, 2.0)]]
    parts, covered = clipped(spark, [SQUARE, HOLE], [((0.25, 1.0), (1.75, 1.0))])[0]
    assert not covered and parts == [[(0.25, 1.0), (0.5, 1.0)], [(1.5, 1.0), (1.75, 1.0)]]


def test_random_lines_against_sampling(spark):
    """The kept length matches the share of sample points inside, for all line lengths."""
    rng = random.Random(7)
    points = []
    for k in range(300):
        reach = [0.05, 0.5, 3.0][k % 3]
        p = (rng.uniform(4.5, 9.5), rng.uniform(-0.5, 3.5))
        points.append((p, (p[0] + rng.uniform(-reach, reach), p[1] + rng.uniform(-reach, reach))))
    found = clipped(spark, [CONCAVE], points)
    for i, (p, q) in enumerate(points):
        at = [(p[0] + (q[0] - p[0]) * t / 400, p[1] + (q[1] - p[1]) * t / 400) for t in range(401)]
        share = sum(inside(x, [CONCAVE]) for x in at) / 401
        parts, covered = found.get(i, ([], False))
        kept = sum(math.dist(a, b) for a, b in parts) / math.dist(p, q)
        assert kept == pytest.approx(share, abs=0.02)
        assert covered == (share == 1.0)


def test_touch_flag_is_about_the_union_and_false_without_polygons(spark):
    both = polygons(spark, ("a", [SQUARE]), ("b", [CONCAVE]))
    some = lines(spark, [((1.0, 1.0), (1.1, 1.1)), ((5.5, 0.5), (5.6, 0.5)), ((3.0, 1.0), (3.1, 1.0))])
    flags = spatial.with_touch_flag(some, "line", both, "geom", "hit").orderBy("i")
    assert [r.hit for r in flags.collect()] == [True, True, False]
    none = spatial.with_touch_flag(some, "line", both.where("false"), "geom", "hit")
    assert [r.hit for r in none.orderBy("i").collect()] == [False, False, False]
    assert flags.count() == 3


def test_equal_polygons_repeat_the_line(spark):
    twice = polygons(spark, ("a", [SQUARE]), ("a", [SQUARE]))
    index = spatial.polygon_index(twice, "geom", ["name"])
    met = spatial.join_polygons(lines(spark, [((1.0, 1.0), (1.1, 1.1))]), "line", index)
    assert met.count() == 2


def test_geodesic_edges_bulge_towards_the_pole(spark):
    shape = [(-124.0, 36.0), (-122.0, 36.0), (-122.0, 37.0), (-124.0, 37.0)]
    edges = spatial.geodesic_edges(spatial.polygon_edges("geom"), 0.1)
    split = polygons(spark, ("p", [shape])).select(F.explode(F.expr(edges)).alias("edge"))
    row = split.selectExpr(
        "max(edge.a.lat) as top",
        f"max({geo.haversine_m('edge.a', 'edge.b', 1.0)}) as longest",
        "count(*) as n",
    ).first()
    assert 37.002 < row.top < 37.006 and math.degrees(row.longest) <= 0.1 and row.n > 40


def test_geodesic_index_finds_a_line_under_the_bulge(spark):
    shape = [(-124.0, 36.0), (-122.0, 36.0), (-122.0, 37.0), (-124.0, 37.0)]
    under = lines(spark, [((-123.0, 37.001), (-122.99, 37.002)), ((-123.0, 37.1), (-122.99, 37.1))])
    for geodesic, expected in ((False, []), (True, [0])):
        index = spatial.polygon_index(polygons(spark, ("p", [shape])), "geom", ["name"], geodesic=geodesic)
        assert [r.i for r in spatial.join_polygons(under, "line", index).collect()] == expected


def test_same_rows_without_broadcast(spark, monkeypatch):
    points = [((x / 10, 1.0), (x / 10 + 0.07, 1.05)) for x in range(-5, 100)]
    some = lines(spark, points)
    shapes = polygons(spark, ("p", [CONCAVE]))
    with_broadcast = clipped(spark, [CONCAVE], points)
    flags = spatial.with_touch_flag(some, "line", shapes, "geom", "hit")
    expected = sorted((r.i, r.hit) for r in flags.collect())

    monkeypatch.setattr(spatial, "BROADCAST_LIMIT_BYTES", 0)
    assert clipped(spark, [CONCAVE], points) == with_broadcast
    merged = spatial.with_touch_flag(some, "line", shapes, "geom", "hit")
    assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.i, r.hit) for r in merged.collect()) == expected


def test_distance_of_a_degree(spark):
    text = geo.haversine_m(geo.point("0", "0"), geo.point("0", "1"))
    assert spark.range(1).selectExpr(text).first()[0] == pytest.approx(111195.08, abs=0.01)


def multilines(spark, *paths):
    rows = [(i, list(p)) for i, p in enumerate(paths)]
    return spark.createDataFrame(rows, "i int, paths array<array<struct<lon:double,lat:double>>>")


def test_tolerance_ladder(spark):
    metre = 1 / 111195.08
    gaps = [4, 9, 60, 999, 1001]
    shapes = [[[(0.0, 0.0), (0.0, 0.1)], [(0.0, 0.1 + g * metre), (0.0, 0.2)]] for g in gaps]
    df = with_tolerance(multilines(spark, *shapes, [[(0.0, 0.0), (0.0, 0.1)]]), "paths", "tolerance")
    assert [r.tolerance for r in df.orderBy("i").collect()] == [5, 10, 100, 1000, None, None]


def test_straightening_joins_paths_or_leaves_them(spark):
    metre = 1 / 111195.08
    bent = [[(0.0, 0.0), (0.0, 0.1)], [(0.0, 0.1 + 40 * metre), (0.1, 0.2)]]
    apart = [[(0.0, 0.0), (0.0, 0.1)], [(0.0, 0.5), (0.1, 0.6)]]
    single = [[(0.0, 0.0), (0.0, 0.05), (0.0, 0.1)]]
    found = with_straightened(multilines(spark, bent, apart, single), "paths", "geom").orderBy("i")
    a, b, c = [[[tuple(v) for v in path] for path in r.geom] for r in found.collect()]
    (joined,) = a  # of the two vertices at the bend, the one farther from the chord stays
    assert joined == [(0.0, 0.0), bent[1][0], (0.1, 0.2)] and b == apart and c == single


def kept_vertices(line, tolerance):
    """One stretch after the other, each split at its farthest vertex."""
    scale = math.cos(math.radians(sum(lat for _, lat in line) / len(line))) * 6371008.8
    x = [math.radians(lon) * scale for lon, _ in line]
    y = [math.radians(lat) * 6371008.8 for _, lat in line]

    def off(m, f, l):
        dx, dy = x[l] - x[f], y[l] - y[f]
        chord = dx * dx + dy * dy
        t = min(1, max(0, ((x[m] - x[f]) * dx + (y[m] - y[f]) * dy) / chord)) if chord else 0
        return round(math.hypot(x[m] - x[f] - t * dx, y[m] - y[f] - t * dy), 6)

    kept, stretches = {0, len(line) - 1}, [(0, len(line) - 1)]
    while stretches:
        f, l = stretches.pop()
        if l - f > 1:
            far = max(range(f + 1, l), key=lambda m: (off(m, f, l), -m))
            if off(far, f, l) > tolerance:
                kept.add(far)
                stretches += [(f, far), (far, l)]
    return sorted(kept)


def test_simplified_lines_against_the_recursive_form(spark):
    rng = random.Random(3)
    rows = []
    for n in (1, 2, 3, 4, 10, 60, 200, 200, 200):
        line, lon, lat = [], -120.0, 35.0
        for _ in range(n):
            lon, lat = lon + rng.gauss(0, 0.001), lat + rng.gauss(0, 0.001)
            line.append((lon, lat))
        rows += [(len(rows), line, t) for t in (None, 5, 100, 250, 1000)]
    back = [(0.0, 0.0), (0.01, 0.0), (0.0, 0.0), (0.01, 0.0), (0.0, 0.0)]  # equal distances, closed
    rows += [(100, back, 5), (101, [(1.0, 1.0)] * 5, 5)]
    schema = "i int, line array<struct<lon:double,lat:double>>, tolerance bigint"
    found = with_kept_vertices(spark.createDataFrame(rows, schema), "line", "tolerance", "kept").collect()
    plan = with_kept_vertices(spark.createDataFrame(rows, schema), "line", "tolerance", "kept")
    assert "Arrow" not in plan._jdf.queryExecution().executedPlan().toString()
    for r, (_, line, tolerance) in zip(sorted(found, key=lambda r: r.i), rows):
        if tolerance is None:
            assert r.kept is None
        else:
            assert r.kept == kept_vertices(line, tolerance)


def test_a_line_over_the_date_line_keeps_the_same_vertices(spark):
    line = [(179.99 + 0.003 * i, 10.0 + 0.001 * (i * 7 % 5)) for i in range(12)]
    over = [(lon - 360 if lon > 180 else lon, lat) for lon, lat in line]
    schema = "i int, line array<struct<lon:double,lat:double>>, tolerance bigint"
    rows = spark.createDataFrame([(0, line, 100), (1, over, 100)], schema)
    a, b = with_kept_vertices(rows, "line", "tolerance", "kept").orderBy("i").collect()
    assert a.kept == b.kept and 2 < len(a.kept) < 12


def ring_of(n, centre=(0.0, 0.0), radius=2.0):
    turn = [2 * math.pi * i / n for i in range(n)]
    return [(centre[0] + radius * math.cos(t), centre[1] + radius * math.sin(t)) for t in turn]


def test_a_ring_of_many_edges_is_spread(spark):
    ring = polygons(spark, ("ring", [ring_of(20_000, (10.0, 10.0))]))
    keyed = ring.select(F.lit(1).alias("_polygon"), F.col("geom").alias("_rings"))
    edges = spatial._edge_rows(keyed, geodesic=False)
    counts = [r["count"] for r in edges.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 60_000 and len(counts) == 8 and max(counts) < 10_000  # three turns of the globe

    index = spatial.polygon_index(ring, "geom", ["name"]).cache()
    most = {r._level: r.most for r in index.groupBy("_level").agg(F.max(F.size("edges")).alias("most")).collect()}
    assert most[0] < 1500  # edges of the finest cells are those of their blocks
    rng = random.Random(11)
    points = []
    for k in range(300):
        p = (rng.uniform(7.5, 12.5), rng.uniform(7.5, 12.5))
        reach = [0.02, 0.1][k % 2]
        points.append((p, (p[0] + rng.uniform(-reach, reach), p[1] + rng.uniform(-reach, reach))))
    found = {r.i for r in spatial.join_polygons(lines(spark, points), "line", index).select("i").collect()}

    def nearest(p, q):
        dx, dy = q[0] - p[0], q[1] - p[1]
        t = min(1, max(0, ((10 - p[0]) * dx + (10 - p[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[0] + t * dx - 10, p[1] + t * dy - 10)

    assert found == {i for i, (p, q) in enumerate(points) if nearest(p, q) < 2.0}


def moved(ring, by):
    out = []
    for lon, lat in ring:
        lon += by
        out.append((lon - 360 if lon > 180 else lon + 360 if lon <= -180 else lon, lat))
    return out


@pytest.mark.parametrize(("by", "geodesic"), [(173.0, False), (-185.5, True)])
def test_polygons_over_the_date_line(spark, by, geodesic):
    """The same hits and parts as away from it, for lines on both sides and across."""
    rng = random.Random(5)
    shapes = [("c", [CONCAVE]), ("h", [moved(SQUARE, 5), moved(HOLE, 5)]), ("w", [[(-9.0, -2.0), (15.0, -2.0), (15.0, 4.0), (-9.0, 4.0)]])]
    points = []
    for k in range(120):
        reach = [0.05, 0.5, 3.0, 9.0][k % 4]
        p = (rng.uniform(4.5, 9.5), rng.uniform(-0.5, 3.5))
        points.append((p, (p[0] + rng.uniform(-reach, reach), p[1] + rng.uniform(-reach, reach))))

    def parts(shift):
        there = polygons(spark, *((n, [moved(r, shift) for r in rings]) for n, rings in shapes))
        index = spatial.polygon_index(there, "geom", ["name"], geodesic=geodesic)
        some = lines(spark, [tuple(moved(line, shift)) for line in points])
        met = spatial.join_polygons(some, "line", index)
        rows = spatial.with_clip(met, "line", "parts").select("i", "name", "parts").collect()
        return {
            (r.i, r.name): [[(round((v.lon - shift + 180) % 360 - 180, 6), round(v.lat, 6)) for v in p] for p in r.parts]
            for r in rows
        }

    here, there = parts(0.0), parts(by)
    assert here.keys() == there.keys() and len(here) > 100
    for key, lines_here in here.items():
        assert len(lines_here) == len(there[key])
        for p, q in zip(lines_here, there[key]):
            assert [c for v in p for c in v] == pytest.approx([c for v in q for c in v], abs=2e-6)


def test_an_index_is_stored_once(spark, tmp_path):
    shapes = polygons(spark, ("p", [SQUARE]), ("q", [CONCAVE]))
    folder = str(tmp_path)
    one = spatial.stored_index(shapes, "geom", ["name"], folder=folder)
    before = {f.name for f in tmp_path.iterdir()}
    two = spatial.stored_index(shapes, "geom", ["name"], folder=folder)
    assert {f.name for f in tmp_path.iterdir()} == before and one[1:] == two[1:]
    assert one.cells == one.rows.count() and one.edges == one.rows.selectExpr("sum(size(edges))").first()[0]
    other = spatial.stored_index(shapes.where("name = 'p'"), "geom", ["name"], folder=folder)
    assert other.cells < one.cells and len(list(tmp_path.iterdir())) > len(before)
    # without its entry, an index was lost half-way and is built again
    for entry in tmp_path.glob("*.json"):
        entry.unlink()
    again = spatial.stored_index(shapes, "geom", ["name"], folder=folder)
    assert again[1:] == one[1:]
    key = lambda r: (r.name, r._level, r._ix, r._iy, r.inside, len(r.edges))
    assert sorted(map(key, again.rows.collect())) == sorted(map(key, one.rows.collect()))
    none = spatial.stored_index(shapes.where("false"), "geom", ["name"], folder=folder)
    assert (none.cells, none.edges) == (0, 0)


def test_overlapping_polygons_and_odd_rows_touch(spark):
    """Where polygons overlap, a line in both is inside; lines without points meet nothing."""
    both = polygons(spark, ("a", [SQUARE]), ("b", [moved(SQUARE, 1)]), ("none", []), ("null", None))
    rows = [(0, [(1.4, 1.0), (1.5, 1.0)]), (1, [(9.0, 9.0), (9.1, 9.0)]), (2, None), (3, [])]
    some = spark.createDataFrame(rows, "i int, line array<struct<lon:double,lat:double>>")
    flags = spatial.with_touch_flag(some, "line", both, "geom", "hit").orderBy("i").collect()
    assert [r.hit for r in flags] == [True, False, False, False]
    assert flags[0].asDict().keys() == {"i", "line", "hit"}
