"""Tile operators against brute force and known places."""

import random

import pytest
from pyspark.sql import functions as F

from reachmap.functions import geom as G
from reachmap.operators import tiles as T
from reachmap.operators.dissolve import outline_area2
from reachmap.sources.schemas import GEOM

from .helpers import square

BOX = "id string, minx double, miny double, maxx double, maxy double, z int"


def cover(spark, *rows):
    return T.tile_cover(spark.createDataFrame(list(rows), BOX))


def test_known_tiles(spark):
    got = {(r.id, r.x, r.y) for r in cover(
        spark,
        ("world", -180.0, -85.0, 180.0, 85.0, 1),
        ("origin", 0.1, 0.1, 0.2, 0.2, 1),
        ("pole", 10.0, 89.0, 11.0, 90.0, 3),
    ).collect()}
    assert {k for k in got if k[0] == "world"} == {("world", x, y) for x in (0, 1) for y in (0, 1)}
    assert {k for k in got if k[0] != "world"} == {("origin", 1, 0), ("pole", 4, 0)}


def test_boxes_west_of_the_antimeridian_wrap(spark):
    got = {r.x for r in cover(spark, ("ak", -188.148909, 60.0, -179.0, 61.0, 5)).collect()}
    assert got == {31, 0}


def test_every_feature_has_a_tile_at_every_zoom(spark):
    r = random.Random(5)
    rows = []
    for i in range(60):
        x, y = r.uniform(-180, 179), r.uniform(-90, 89)
        rows.append((str(i), x, y, x + r.random(), y + r.random(), r.choice([0, 3, 7, 11])))
    got = cover(spark, *rows)
    assert {r.id for r in got.collect()} == {r[0] for r in rows}
    wide = got.withColumn("n", F.pow(F.lit(2), "z")).filter("x < 0 or y < 0 or x >= n or y >= n")
    assert wide.isEmpty()


def test_shape_cover_equals_sampling_and_wraps(spark):
    r = random.Random(8)
    shapes = {}
    for i in range(12):  # star-shaped, so that rings do not cross themselves
        import math

        cx, cy, k = r.uniform(-150, 150), r.uniform(-60, 60), r.randint(3, 9)
        pts = [
            (cx + r.uniform(1, 12) * math.cos(2 * math.pi * j / k), cy + r.uniform(1, 12) * math.sin(2 * math.pi * j / k))
            for j in range(k)
        ]
        shapes[f"s{i}"] = pts
    shapes["fiji"] = [(179.0, -10.0), (-179.0, -10.0), (-179.0, -12.0), (179.0, -12.0)]
    rows = [(k, [[[{"x": x, "y": y} for x, y in [*p, p[0]]]]], 6) for k, p in shapes.items()]
    f = spark.createDataFrame(rows, "id string, geom " + GEOM.simpleString() + ", z int")
    got = {}
    for row in T.shape_cover(f, "id").collect():
        got.setdefault(row.id, set()).add((row.x, row.y))
    assert {x for x, _ in got["fiji"]} == {0, 63}
    n = 64
    for name, pts in shapes.items():
        if name == "fiji":
            continue
        import math

        w = [((x + 180) / 360 * n, (1 - math.log(math.tan(math.radians(y)) + 1 / math.cos(math.radians(y))) / math.pi) / 2 * n) for x, y in pts]
        w.append(w[0])
        seen = set()
        for a, b in zip(w, w[1:]):  # points along the edges
            for i in range(2001):
                t = i / 2000
                seen.add((math.floor(a[0] + t * (b[0] - a[0])), math.floor(a[1] + t * (b[1] - a[1]))))
        xs, ys = [p[0] for p in w], [p[1] for p in w]
        inner = set()
        for x in range(math.floor(min(xs)), math.floor(max(xs)) + 1):
            for y in range(math.floor(min(ys)), math.floor(max(ys)) + 1):
                px, py, odd = x + 0.5, y + 0.5, False
                for a, b in zip(w, w[1:]):
                    if (a[1] <= py) != (b[1] <= py) and px < a[0] + (py - a[1]) * (b[0] - a[0]) / (b[1] - a[1]):
                        odd = not odd
                if odd:
                    inner.add((x, y))
        assert seen | inner <= got[name]
        # sampling may miss a tile that an edge only clips at a corner
        assert len(got[name] - seen - inner) <= 2


def random_cover(spark, seed, n=400):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = r.uniform(0, 10), r.uniform(0, 10)
        rows.append((f"f{i:04d}", x, y, x + 0.1, y + 0.1, r.choice([0, 4]), r.randrange(5), r.randrange(1, 9)))
    df = spark.createDataFrame(rows, BOX + ", size bigint, cost bigint")
    return T.tile_cover(df).withColumn("layer", F.lit("l"))


def brute_thin(rows, budget):
    kept, by_tile = {}, {}
    for r in rows:
        by_tile.setdefault((r.z, r.x, r.y), []).append(r)
    for tile, feats in by_tile.items():
        run = 0
        for i, r in enumerate(sorted(feats, key=lambda r: (-r["size"], r.id))):
            run += r.cost
            if run > budget and i:
                break
            kept[tile, r.id] = run
    return kept


@pytest.mark.parametrize("budget", [0, 1, 40, 5000])
@pytest.mark.parametrize("slices", [(4, 2), (16,), (1024, 32)])
def test_thinning_equals_one_ranking(spark, budget, slices):
    c = random_cover(spark, budget)
    got = {
        ((r.z, r.x, r.y), r.id): r.run_cost
        for r in T.thin_tiles(c, budget, "id", slices=slices).collect()
    }
    assert got == brute_thin(c.collect(), budget)


def test_folding_keeps_everything(spark):
    c = random_cover(spark, 9)
    total = {
        (r.z, r.x, r.y): (r.n, r.s, r.c)
        for r in c.groupBy("z", "x", "y").agg(
            F.count("*").alias("n"), F.sum("size").alias("s"), F.sum("cost").alias("c")
        ).collect()
    }
    got = {}
    for r in T.fold_smallest(c, 60, "id").collect():
        n, s, k = got.get((r.z, r.x, r.y), (0, 0, 0))
        got[r.z, r.x, r.y] = (
            n + 1 + r.folded_n, s + r["size"] + r.folded_size, k + r.cost + r.folded_cost
        )
    assert got == total


def test_simplified_neighbours_share_their_border(spark):
    rows = [("a", square(0, 0, 0.0103, 0.02)), ("b", square(0.0103, 0, 0.01, 0.02))]
    f = spark.createDataFrame(rows, "id string, geom " + GEOM.simpleString()).selectExpr(
        "*", "12 as z", "8 as simplify", "12 as detail"
    )
    rings = {r.id: {(p.x, p.y) for p in r.pts} for r in T.simplify_features(f, ["id"]).collect()}
    assert len(rings["a"] & rings["b"]) == 2


def test_simplify_drops_what_adds_nothing(spark):
    pts = [(0, 0), (0.5, 0), (1, 0), (1, 1), (1, 1), (0.5, 1), (0, 1), (0, 0)]
    line = [(0, 0), (1, 0), (0, 0), (0, 0)]
    rows = [
        (name, [[[{"x": float(a), "y": float(b)} for a, b in p]]])
        for name, p in (("square", pts), ("line", line))
    ]
    f = spark.createDataFrame(rows, "id string, geom " + GEOM.simpleString()).selectExpr(
        "*", "8 as z", "1 as simplify", "12 as detail"
    )
    got = {r.id: len(r.pts) for r in T.simplify_features(f, ["id"]).collect()}
    assert got == {"square": 5}


def test_coalesced_outline_loses_inner_borders(spark):
    rows = [(v, square(x * 0.1, 0, 0.1, 0.1)) for x, v in enumerate([1, 1, 2])]
    f = spark.createDataFrame(rows, "v int, geom " + GEOM.simpleString()).selectExpr(
        "*", "8 as z", "1 as simplify", "12 as detail"
    )
    rings = T.simplify_features(f, ["v"])
    outline = T.coalesced_outline(rings, ["z", "v"])
    n = {r.v: r["count"] for r in outline.groupBy("v").count().collect()}
    assert n == {1: 6, 2: 4}
    whole = outline_area2(outline, "v").agg(F.sum(F.abs("area2"))).first()[0]
    parts = rings.agg(F.sum(2 * F.abs(G.signed_area(F.col("pts"))))).first()[0]
    assert float(whole) == parts


def test_quantised_points_lie_in_their_tile(spark):
    f = spark.createDataFrame(
        [("a", square(-120.0, 30.0, 0.01, 0.01))], "id string, geom " + GEOM.simpleString()
    ).select("id", "geom", *G.bounds(F.col("geom")), F.lit(6).alias("z"))
    q = T.tile_quantise(T.tile_cover(f), ["id"], detail=14).collect()
    assert len(q) == 5 and all(0 <= r.qx < 2**14 and 0 <= r.qy < 2**14 for r in q)


def test_bands_cover_every_zoom_once_but_nine(spark):
    zooms = [(z, b.level) for b in T.SPEED_BANDS for z in range(b.zmin, b.zmax + 1)]
    assert sorted({z for z, _ in zooms}) == list(range(15))
    assert [level for z, level in zooms if z == 9] == ["smalltract", "bigtract_block"]
    assert len(zooms) == 16


def test_large_block_shows_at_every_zoom_of_its_band(spark):
    rows = [("a", 0.1, 0.1, 0.2, 0.2, 8)]
    df = spark.createDataFrame(rows, BOX.replace("z int", "min_zoom int"))
    assert sorted(r.z for r in T.xl_block_tiles(df).collect()) == [5, 6, 7, 8, 9]
