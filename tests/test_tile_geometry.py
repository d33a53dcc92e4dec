"""Clipped tile geometry against closed forms, the plain cover and brute force."""

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reachmap.operators import dissolve
from reachmap.operators import tile_geometry as TG
from reachmap.operators import tiles as T
from reachmap.sources.schemas import GEOM

from .helpers import square

SCHEMA = "id string, geom " + GEOM.simpleString() + ", zmin int, zmax int"


def ring(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in [*pts, pts[0]]]


def star(r, cx, cy, k, size):
    return ring(*[
        (cx + size * r.uniform(0.2, 1) * math.cos(2 * math.pi * j / k), cy + size * r.uniform(0.2, 1) * math.sin(2 * math.pi * j / k))
        for j in range(k)
    ])


def shapes():
    r = random.Random(3)
    rows = [(f"s{i}", [[star(r, r.uniform(-150, 150), r.uniform(-60, 60), r.randint(3, 9), r.uniform(0.5, 15))]], 2, 7) for i in range(12)]
    rows.append(("hole", [[ring((0.3, 0.3), (20, 0.4), (20.2, 20), (0.1, 20)), ring((5, 5), (5, 15), (15, 15), (15, 5))]], 3, 6))
    rows.append(("fiji", [[ring((179.0, -10.0), (-179.0, -10.0), (-179.0, -12.0), (179.0, -12.0))]], 4, 6))
    rows.append(("two", [[ring((1, 1), (2, 1), (2, 2))], [ring((50, 1), (60, 1), (60, 9))]], 5, 6))
    return rows


def world(x, y, z):
    r = math.radians(y)
    return (x + 180) / 360 * 2**z, (1 - math.log(math.tan(r) + 1 / math.cos(r)) / math.pi) / 2 * 2**z


def shoelace(pts):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:]))) / 2


@pytest.fixture(scope="module")
def pieces(spark):
    rows = shapes()
    return rows, TG.tile_pieces(spark.createDataFrame(rows, SCHEMA), ["id"]).collect()


def test_descent_covers_what_the_plain_cover_does(spark, pieces):
    rows, got = pieces
    mine = {(p.id, p.z, p.x, p.y) for p in got}
    f = spark.createDataFrame(rows, SCHEMA).withColumn("z", F.explode(F.sequence("zmin", "zmax")))
    plain = {(r.id, r.z, r.x, r.y) for r in T.shape_cover(f, "id").collect()}
    assert mine <= plain
    # what only the plain one has is touched in a point or along the border
    assert len(plain - mine) <= 0.01 * len(plain)


def test_pieces_areas_sum_to_the_feature(pieces):
    rows, got = pieces
    total = defaultdict(float)
    for p in got:
        total[p.id, p.z] += p.area
    for name, geom, zmin, zmax in rows:
        for z in range(zmin, zmax + 1):
            want = 0
            for poly in geom:
                rings = [[world(p["x"] + 360 * (name == "fiji" and p["x"] < 0), p["y"], z) for p in q] for q in poly]
                want += shoelace(rings[0]) - sum(shoelace(q) for q in rings[1:])
            assert total[name, z] == pytest.approx(want, rel=1e-9)


def test_pieces_stay_within_the_margin_and_whole_tiles_have_none(pieces):
    _, got = pieces
    for p in got:
        assert p.whole == (p.rings is None)
        for r in p.rings or []:
            for q in r:
                assert p.ux - TG.MARGIN - 1e-9 <= q.x <= p.ux + 1 + TG.MARGIN + 1e-9
                assert p.y - TG.MARGIN - 1e-9 <= q.y <= p.y + 1 + TG.MARGIN + 1e-9
    assert any(p.whole for p in got) and any(len(p.rings or []) == 2 for p in got)


def test_shape_across_the_antimeridian_wraps(pieces):
    _, got = pieces
    assert {p.x for p in got if p.id == "fiji" and p.z == 6} == {0, 63}
    assert {p.ux for p in got if p.id == "fiji" and p.z == 6} == {63, 64}


def test_no_features_give_no_pieces(spark):
    assert TG.tile_pieces(spark.createDataFrame([], SCHEMA), ["id"]).count() == 0


def lattice(spark, n, zmin=9, zmax=11):
    rows = [(f"b{i:03d}", square(10 + 0.05 * (i % n), 20 + 0.05 * (i // n), 0.05, 0.05), zmin, zmax) for i in range(n * n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_coalesced_neighbours_lose_their_border_and_no_area(spark):
    _, f = lattice(spark, 8)
    f = f.withColumn("v", (F.floor(F.substring("id", 2, 3).cast("int") / 3) % 3).cast("string"))
    q = TG.quantised_pieces(TG.tile_pieces(f, ["id", "v"])).withColumn("layer", F.lit("l"))
    edges = TG.piece_edges(q, *T.TILE, "v")
    out = TG.coalesced_edges(q, [*T.TILE, "v"])
    assert out.filter("mult != 1").isEmpty() and out.count() < edges.count()
    area = lambda e: {tuple(r) for r in e.groupBy(*T.TILE, "v").agg(F.sum(F.expr("x1 * y2 - x2 * y1")).alias("a")).collect()}
    assert area(out) == area(edges)
    # every vertex has as many edges in as out: rings can be traced
    ends = out.select(*T.TILE, "v", F.inline(F.expr("array(struct(x1 as px, y1 as py, 1 as d), struct(x2 as px, y2 as py, -1 as d))")))
    assert ends.groupBy(*T.TILE, "v", "px", "py").agg(F.sum("d").alias("d")).filter("d != 0").isEmpty()
    ten = out.filter("z = 10").withColumnsRenamed({"x": "tx", "y": "ty"})
    assert dissolve.ring_points(ten, "layer", "z", "tx", "ty", "v").count() == ten.count()


def box_cover(spark, rows):
    df = spark.createDataFrame(rows, "id string, minx double, miny double, maxx double, maxy double, z int, size bigint, cost bigint")
    return T.tile_cover(df).withColumn("layer", F.lit("l"))


def brute_drop(rows, budget):
    side, out = 1 << TG.CURVE_BITS, {}
    by_tile = defaultdict(list)
    for r in rows:
        wx, wy = world((r.minx + r.maxx) / 2, (r.miny + r.maxy) / 2, r.z)
        c = [min(max(math.floor((w - t) * side), 0), side - 1) for w, t in ((wx, r.x), (wy, r.y))]
        key = sum(((c[0] >> b) & 1) << 2 * b | ((c[1] >> b) & 1) << 2 * b + 1 for b in range(TG.CURVE_BITS))
        by_tile[r.z, r.x, r.y].append((key, r.id))
    for tile, feats in by_tile.items():
        feats.sort()
        gaps, last = [], None
        for k, i in feats:
            gaps.append((0 if k == last else k - last if last is not None else side * side, int(f"{k:020b}"[::-1], 2), i))
            last = k
        for gap, _, i in sorted(gaps, key=lambda g: (-g[0], g[1], g[2]))[:budget] if len(gaps) > budget else gaps:
            out[tile, i] = gap
    return out


@pytest.mark.parametrize("budget", [1, 7, 60, 1000])
def test_drop_densest_equals_brute_force(spark, budget):
    r = random.Random(budget)
    rows = []
    for i in range(400):
        x, y = (r.uniform(0, 10), r.uniform(0, 10)) if i % 2 else (5 + 0.001 * (i % 40), 5.0)
        rows.append((f"f{i:04d}", x, y, x + 0.01, y + 0.01, r.choice([0, 4, 6]), 1, 1))
    c = box_cover(spark, rows)
    got = {((q.z, q.x, q.y), q.id): q.gap for q in TG.drop_densest(c, budget, "id").collect()}
    assert got == brute_drop(c.collect(), budget)


def test_coalesce_smallest_keeps_area_and_totals(spark):
    rows, f = lattice(spark, 9, 9, 10)
    r = random.Random(1)
    size = spark.createDataFrame([(i, r.randrange(5), 5) for i, *_ in rows] + [("far", 3, 5)], "id string, size bigint, cost bigint")
    far = spark.createDataFrame([("far", square(10.9, 20.9, 0.02, 0.02), 9, 10)], SCHEMA)
    q = TG.quantised_pieces(TG.tile_pieces(f.unionByName(far), ["id"])).withColumn("layer", F.lit("l"))
    edges = TG.piece_edges(q, *T.TILE, "id")
    cover = q.select(*T.TILE, "id").distinct().join(size, "id")
    features, merged = TG.coalesce_smallest(cover, edges, 30, "id")

    def per_tile(df, *aggs):
        return {(x.z, x.x, x.y): tuple(x)[4:] for x in df.groupBy(*T.TILE).agg(*aggs).collect()}

    area = F.sum(F.expr("x1 * y2 - x2 * y1"))
    assert per_tile(merged, area.alias("a")) == per_tile(edges, area.alias("a"))
    sums = [F.sum(c).alias(c) for c in ("one", "size", "cost")]
    after = features.selectExpr(*T.TILE, "1 + folded_n as one", "size + folded_size as size", "cost + folded_cost as cost")
    assert per_tile(after, *sums) == per_tile(cover.withColumn("one", F.lit(1)), *sums)
    assert features.filter("folded_n > 0").count() > 0
    # every outline belongs to a kept feature
    assert merged.join(features, [*T.TILE, "id"], "left_anti").isEmpty()
    # pointers followed one by one
    rank = {(x.z, x.x, x.y, x.id): (-x["size"], x.id) for x in cover.collect()}
    roots = {(x.z, x.x, x.y, x.id) for x in features.collect()}
    up = {}
    for b in TG.borders(edges, "id").collect():
        own, other = (b.z, b.x, b.y, b.id), (b.z, b.x, b.y, b.neighbour)
        if rank[other] < rank[own]:
            up[own] = min(up.get(own, (0,)), (-b.border, *rank[other]))
    want = {}
    for key in rank:
        at = key
        while at not in roots and at in up:
            at = (*key[:3], up[at][2])
        if at not in roots:
            at = min((k for k in roots if k[:3] == key[:3]), key=rank.get)
        want[key] = at[3]
    assert {(x.z, x.x, x.y, x.id): x.target for x in TG.merge_targets(cover, features, edges, "id").collect()} == want


def brute_circle(rings):
    """(west, east) of the shortest interval that covers arcs given as (low, high) with high - low < 360."""
    arcs = sorted(((lo + 180) % 360 - 180, hi - lo) for lo, hi in rings)
    best = None
    for start, _ in arcs:
        end = max((a - start) % 360 + n for a, n in arcs)
        if end < 360 and (best is None or end < best[1] - 1e-9):
            best = (start, end)
    return best


def test_boxes_on_the_circle(spark):
    from reachmap.operators import geometry

    r, rows, want = random.Random(6), [], {}
    for g in range(30):
        centre, arcs = r.uniform(-180, 180), []
        for _ in range(r.randint(1, 5)):
            lo = centre + r.uniform(-60, 60)
            hi = lo + r.uniform(0.5, 20)
            arcs.append((lo, hi))
            pts = [((x + 180) % 360 - 180, y) for x, y in ((lo, 1), (hi, 1), (hi, 5), (lo, 5))]
            rows.append((f"g{g}", [[ring(*pts)]]))
        want[f"g{g}"] = brute_circle(arcs)
    got = geometry.circle_bounds(spark.createDataFrame(rows, "id string, geom " + GEOM.simpleString()), "id").collect()
    assert len(got) == 30
    for b in got:
        west, width = want[b.id]
        assert (b.minx - west) % 360 == pytest.approx(0, abs=1e-6) or (b.minx - west) % 360 == pytest.approx(360, abs=1e-6)
        assert b.maxx - b.minx == pytest.approx(width, abs=1e-6)
        assert -360 <= b.minx and b.maxx <= 180 + 1e-9 and (b.miny, b.maxy) == (1, 5)
    assert any(b.minx < -180 for b in got)


def test_a_block_on_the_antimeridian_is_on_four_tiles_by_its_box_on_the_circle(spark):
    from reachmap.operators import geometry

    block = [[ring((179.99, 10.0), (-179.99, 10.0), (-179.99, 10.06), (179.99, 10.06))]]
    f = spark.createDataFrame([("b", block, 12, 12)], SCHEMA)
    box = geometry.circle_bounds(f, "id").withColumn("z", F.lit(12))
    by_box = {(t.x, t.y) for t in T.tile_cover(box).collect()}
    assert by_box == {(t.x, t.y) for t in TG.touched_tiles(f, ["id"]).collect()} and len(by_box) in (2, 4)


def test_descent_has_as_many_tasks_as_its_tiles_ask(spark, tmp_path, monkeypatch):
    """Small polygons, merged by their bytes, must not go down the tree in one task."""
    from reachmap import session

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(TG, "DESCENT_ROWS", 60, raising=False)
    rows = [(f"b{i}", square(-100 + 0.3 * (i % 20), 30 + 0.3 * (i // 20), 0.2, 0.2), 6, 8) for i in range(400)]
    got = TG.touched_tiles(spark.createDataFrame(rows, SCHEMA).coalesce(1), ["id"])
    assert "8" in {str(r.z) for r in got.select("z").distinct().collect()}
    for name in ("tile-seeds", "tile-pieces-8"):
        (table,) = tmp_path.glob(f"reachmap-{name}-" + "?" * 32)
        assert len(list(table.glob("part-*"))) >= 4, name


def test_touched_tiles_are_distinct_whatever_the_polygons(spark):
    rows = shapes()
    rows += [("again", rows[0][1], 2, 6), ("again", rows[1][1], 2, 6), ("again", rows[1][1], 2, 6)]
    near = [ring((1, 1), (2, 1), (2, 2))], [ring((2.1, 1), (2.2, 1), (2.2, 2))]
    rows += [("near", list(near), 3, 7), ("round", [[ring((170, 10), (-170, 10), (-170, 30), (170, 30))]], 0, 4)]
    rows += [(None, rows[2][1], 2, 5), (None, rows[2][1], 2, 5)]
    f = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(str, TG.touched_tiles(f, ["id"]).collect()))
    want = TG.tile_pieces(f, ["id"], margin=0.0).select("id", "z", "x", "y").distinct()
    assert got == sorted(map(str, want.collect()))


def test_rings_of_the_whole_circle(spark):
    from reachmap.operators import geometry

    rows = [(f"r{i}", [[ring((lo, 0), (lo + 59, 0), (lo + 59, 1), (lo, 1))]]) for i, lo in enumerate(range(-180, 180, 59)) if lo + 59 <= 180]
    rows.append(("last", [[ring((174, 0), (180, 0), (180, 1), (174, 1))]]))
    f = spark.createDataFrame(rows, "id string, geom " + GEOM.simpleString()).withColumn("g", F.lit(1))
    b = geometry.circle_bounds(f, "g").first()
    assert (b.minx, b.maxx) == (-180, 180)


def test_simplified_arcs_leave_no_gap_or_overlap(spark):
    import numpy as np

    from reachmap.operators import arcs

    # a lattice of wiggly cells: every border is a random walk that both neighbours have
    r, n, k = random.Random(2), 4, 16
    point = {(i, j): (i * 1000 + r.randint(-200, 200), j * 1000 + r.randint(-200, 200)) for i in range(n + 1) for j in range(n + 1)}

    def line(a, b):
        (x0, y0), (x1, y1) = point[a], point[b]
        mid = [(x0 + (x1 - x0) * t // k + r.randint(-30, 30), y0 + (y1 - y0) * t // k + r.randint(-30, 30)) for t in range(1, k)]
        return [(x0, y0), *mid, (x1, y1)]

    lines = {}
    for i in range(n + 1):
        for j in range(n + 1):
            for b in ((i + 1, j), (i, j + 1)):
                if b in point:
                    lines[(i, j), b] = line((i, j), b)

    def path(a, b):
        return lines[a, b] if (a, b) in lines else lines[b, a][::-1]

    rows = []
    for i in range(n):
        for j in range(n):
            corners = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)]
            for a, b in zip(corners, corners[1:]):
                pts = path(a, b)
                rows += [(f"c{i}{j}", *p, *q) for p, q in zip(pts, pts[1:])]
    # an island: a ring without a junction
    ring_ = [(10_000 + round(500 * math.cos(t / 40 * 2 * math.pi)), round(500 * math.sin(t / 40 * 2 * math.pi))) for t in range(40)]
    rows += [("island", *p, *q) for p, q in zip(ring_, ring_[1:] + ring_[:1])]
    edges = spark.createDataFrame(rows, "id string, x1 long, y1 long, x2 long, y2 long")

    def area(df, *keys):
        return df.groupBy(*keys).agg(F.sum(F.expr("x1 * y2 - x2 * y1")).alias("a"))

    whole = area(edges).first().a
    for tolerance, stretch in ((0.0, 8192), (45.0, 8192), (45.0, 5)):
        thin = arcs.simplify_arcs(edges, "id", tolerance, stretch)
        sides = arcs.sides_of(thin, "id")
        # each border once: the features' areas sum to that of the outer border
        assert area(sides).first().a == area(thin.filter("other is null")).first().a
        assert abs(area(sides).first().a - whole) < 0.02 * whole
        if tolerance:
            assert thin.count() < len(rows) / 4
            kept = {(x.x1, x.y1) for x in thin.collect()} | {(x.x2, x.y2) for x in thin.collect()}
            assert {p for (i, j), p in point.items() if 0 < i < n or 0 < j < n} - {point[c] for c in ((0, 0), (0, n), (n, 0), (n, n))} <= kept
        ends = sides.select("id", F.inline(F.expr("array(struct(x1 as x, y1 as y, 1 as d), struct(x2 as x, y2 as y, -1 as d))")))
        assert ends.groupBy("id", "x", "y").agg(F.sum("d").alias("d")).filter("d != 0").isEmpty()
    assert list(arcs.thin_line(np.array([[0, 0], [1, 0], [2, 0], [2, 2]]), 0.1)) == [0, 2, 3]


def test_closed_borders_begin_at_a_corner(spark):
    """Squares apart from each other, of 12 unit edges: four sides are left, wherever their edges' numbers begin."""
    from reachmap.operators import arcs

    rows = []
    for i in range(40):
        x = 10 * i
        path = [(x + a, 0) for a in range(4)] + [(x + 3, b) for b in (1, 2, 3)] + [(x + a, 3) for a in (2, 1, 0)] + [(x, b) for b in (2, 1)]
        rows += [(f"s{i}", *p, *q) for p, q in zip(path, path[1:] + path[:1])]
    edges = spark.createDataFrame(rows, "id string, x1 long, y1 long, x2 long, y2 long").repartition(7)
    thin = arcs.simplify_arcs(edges, "id", 0.1)
    want = {(f"s{i}", 10 * i + a, b, 10 * i + c, d) for i in range(40) for a, b, c, d in ((0, 0, 3, 0), (3, 0, 3, 3), (3, 3, 0, 3), (0, 3, 0, 0))}
    got = [(r.one, r.x1, r.y1, r.x2, r.y2) for r in thin.collect()]
    assert len(got) == len(want) and set(got) == want


def test_tiers_join_without_an_exchange(spark):
    from reachmap.operators import geometry

    features = spark.range(200).selectExpr("cast(id as string) as k", "id * 1.5 as minx")
    stats = spark.range(150).selectExpr("cast(id as string) as k", "explode(array('a', 'b')) as tier", "cast(id as double) as `n1`")
    df = geometry.attach_tiers(features, stats, "k", ["a", "b", "c"], ["n1"], buckets=4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    got = {(r.k, r.tier): r.n1 for r in df.collect()}
    assert got == {(str(i), t): float(i) if i < 150 and t != "c" else None for i in range(200) for t in "abc"}


def test_descent_clips_no_tile_outside_a_polygons_box(spark):
    ring = "array(array(struct(1.1D as x, 1.2D as y), struct(1.3D as x, 1.2D as y), struct(1.3D as x, 1.6D as y), struct(1.1D as x, 1.2D as y)))"
    row = spark.range(1).selectExpr(
        "id", "true as alone", "3 as zmin", "9 as zmax", "0 as poly", "1 as ux", "1 as y", "false as whole",
        "1.1D as low_x", "1.3D as high_x", "1.2D as low_y", "1.6D as high_y", f"{ring} as rings",
    )
    assert [(r.ux, r.y) for r in TG._children(row, ["id"], 4).orderBy("y").collect()] == [(2, 2), (2, 3)]
    assert TG._children(row.withColumn("whole", F.lit(True)), ["id"], 4).count() == 4


def test_statistics_of_speed_layers_meet_features_where_they_are_stored(spark):
    f = spark.range(3).selectExpr(
        "'block' as level", "'block' as stat_kind", "cast(id as string) as feature_id", "1L as size", "1L as cost",
        "0D as minx", "0D as miny", "1D as maxx", "1D as maxy",
    )
    touched = f.selectExpr("level", "feature_id", "11 as z", "inline(array(struct(1 as x, 2 as y), struct(2 as x, 2 as y)))")
    # Feature 0 has both tiers, 1 one of them, 2 none; one that is on no tile; a tier that is not asked for.
    values = [("a", "0", 1.0), ("b", "0", 2.0), ("b", "1", 3.0), ("a", "9", 4.0), ("c", "0", 5.0)]
    stats = spark.createDataFrame([(t, "block", i, v) for t, i, v in values], "tier string, kind string, feature_id string, n1 double")
    bands = (T.Band("block", 11, 11),)
    got = T.speed_layers(f, touched, stats, ["n1"], ["a", "b"], 10, bands)
    want = {(t, i, x, v) for t, i, v in [*values[:3], ("a", "1", None), ("a", "2", None), ("b", "2", None)] for x in (1, 2)}
    rows = got.collect()
    assert len(rows) == 12 and {(r.layer, r.feature_id, r.x, r.n1) for r in rows} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "stat_kind" not in " ".join(re.findall(r"hashpartitioning\([^)]*\)", plan))


def test_no_filter_moves_the_rings_of_a_polygon_again(spark, tmp_path):
    """In a filter on the moved rings each of a polygon's rings would move all of them: quadratic in its holes."""
    rows = shapes() + [("flat", [[ring((1, 1), (2, 1))]], 2, 4)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/shapes")
    seeds = TG._seeds(spark.read.parquet(f"{tmp_path}/shapes"), ["id"])
    plan = seeds._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not [line for line in plan if "Filter" in line and "transform(" in line]
    got = {r.id for r in seeds.collect()}
    assert got == {r[0] for r in rows} - {"flat"}


def test_statistics_made_where_they_are_stored_pass_no_other_shuffle(spark, tmp_path, monkeypatch):
    from reachmap import session

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(T, "STAT_ROWS", 20)
    f = spark.range(40).selectExpr(
        "if(id < 10, 'tract', 'block') as level", "if(id < 10, 'tract', 'block') as stat_kind", "cast(id as string) as feature_id",
        "1L as size", "1L as cost", "0D as minx", "0D as miny", "1D as maxx", "1D as maxy",
    )
    touched = f.selectExpr("level", "feature_id", "if(level = 'tract', 6, 11) as z", "inline(array(struct(1 as x, 2 as y), struct(2 as x, 2 as y)))")
    stats = spark.range(50).selectExpr(
        "explode(array('a', 'b', 'c')) as tier", "if(id < 12, 'tract', 'block') as kind", "cast(id as string) as feature_id", "id + 0.5D as n1"
    ).filter("(hash(tier, feature_id) & 3) > 0")
    bands, dealt = (T.Band("tract", 6, 6, coalesce=True), T.Band("block", 11, 11)), []

    def made(tasks):
        dealt.append(tasks)
        parts = [stats.filter(F.col("kind") == k).withColumn("stat", T.stat_key("kind", "feature_id")) for k in ("tract", "block")]
        return T.tile_union(*[p.repartition(tasks, "stat").select("stat", "tier", "n1") for p in parts])

    want = sorted(map(str, T.speed_layers(f, touched, stats, ["n1"], ["a", "b"], 10, bands).collect()))
    got = T.speed_layers(f, touched, made, ["n1"], ["a", "b"], 10, bands)
    assert sorted(map(str, got.collect())) == want and dealt == [4]
    # A bucket has a file of each part at most: every row was made in its bucket's task.
    files = [len(list(p.glob("part-*"))) for p in tmp_path.glob("reachmap-stats-by-key-*")]
    assert len(files) == 2 and all(4 <= n <= 8 for n in files)
