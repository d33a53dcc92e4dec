"""Dissolve on shapes whose outline is known."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmap.functions import geom as G
from reachmap.operators import dissolve as D
from reachmap.operators import geometry
from reachmap.sources.schemas import GEOM

from .helpers import square


def table(spark, *items):
    """Rows of (key, geometry)."""
    return spark.createDataFrame(list(items), "key string, geom " + GEOM.simpleString())


def cells(spark, key_cells):
    return table(spark, *[(k, square(x, y)) for k, pts in key_cells.items() for x, y in pts])


def packed(features, **kw):
    return {
        r.key: [[[(p.x, p.y) for p in ring] for ring in poly] for poly in r.geom]
        for r in D.dissolve(features, "key", grid=1, **kw).features.collect()
    }


def test_hole_is_nested(spark):
    around = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    (poly,) = packed(cells(spark, {"k": around}))["k"]
    shell, hole = poly
    assert len(shell) == 13 and len(hole) == 5
    area = D.outline_area2(D.dissolve_edges(cells(spark, {"k": around}), "key", grid=1), "key")
    assert area.first().area2 == 16


def test_island_in_a_hole_is_its_own_polygon(spark):
    ring = [(x, y) for x in range(5) for y in range(5) if x in (0, 4) or y in (0, 4)]
    polys = packed(cells(spark, {"k": [*ring, (2, 2)]}))["k"]
    assert sorted(len(p) for p in polys) == [1, 2]


def test_parts_touching_in_a_point_stay_apart(spark):
    polys = packed(cells(spark, {"k": [(0, 0), (1, 1)]}))["k"]
    assert [len(p) for p in polys] == [1, 1] and all(len(p[0]) == 5 for p in polys)


def test_direction_of_input_rings_does_not_matter(spark):
    turned = [[[*reversed(square(0, 0)[0][0])]]]
    both = table(spark, ("k", turned), ("k", square(1, 0)))
    outline = D.dissolve_edges(both, "key", grid=1)
    assert outline.count() == 6 and D.outline_area2(outline, "key").first().area2 == 4


def test_input_hole_is_kept(spark):
    donut = [[square(0, 0, 4, 4)[0][0], square(1, 1, 2, 2)[0][0]]]
    t = table(spark, ("k", donut))
    assert t.select(G.area(F.col("geom"))).first()[0] == 12.0
    (poly,) = packed(t)["k"]
    assert len(poly) == 2
    filled = table(spark, ("k", donut), ("k", square(1, 1, 2, 2)))
    assert [len(p) for p in packed(filled)["k"]] == [1]


def test_vertex_on_a_neighbours_edge_keeps_the_area(spark):
    t = table(spark, ("k", square(0, 0, 1, 2)), ("k", square(1, 0)), ("k", square(1, 1)))
    dissolved = D.dissolve(t, "key", grid=1).features
    assert dissolved.select(G.area(F.col("geom"))).first()[0] == 4.0
    points = D.ring_points(D.dissolve_edges(t, "key", grid=1), "key")
    assert sorted(r["count"] for r in points.groupBy("ring").count().collect()) == [4, 6]


def test_overlap_is_an_error(spark):
    t = table(spark, ("k", square(0, 0)), ("k", square(0, 0)))
    with pytest.raises(Exception, match="overlap"):
        D.dissolve(t, "key", grid=1).features.collect()


def _random_cells(seed):
    r = random.Random(seed)
    return {
        k: sorted({(r.randrange(8), r.randrange(8)) for _ in range(30)}) for k in ("a", "b", "c")
    }


@pytest.mark.parametrize("seed", [3, 4])
def test_short_and_long_outlines_agree(spark, seed):
    shapes = _random_cells(seed)
    t = cells(spark, shapes)
    outline = D.dissolve_edges(t, "key", grid=1)
    area = {r.key: r.area2 for r in D.outline_area2(outline, "key").collect()}
    assert area == {k: 2 * len(v) for k, v in shapes.items()}

    by_ring = {}
    points = D.ring_points(outline, "key").collect()
    assert len(points) == outline.count()
    for r in sorted(points, key=lambda r: r.seq):
        by_ring.setdefault((r.key, r.ring), []).append((float(r.x), float(r.y)))

    def canonical(ring):
        i = ring.index(min(ring))
        return tuple(ring[i:] + ring[:i])

    long_way = sorted((k, canonical(r)) for (k, _), r in by_ring.items())
    short_way = sorted(
        (k, canonical(ring[:-1])) for k, polys in packed(t).items() for p in polys for ring in p
    )
    assert [k for k, _ in long_way] == [k for k, _ in short_way]
    assert sorted(len(r) for _, r in long_way) == sorted(len(r) for _, r in short_way)
    edges = lambda way: sorted((k, a, b) for k, r in way for a, b in zip(r, r[1:] + r[:1]))
    assert edges(long_way) == edges(short_way)


def test_outlines_beyond_the_limit_stay_whole(spark):
    shapes = {"big": [(x, y) for x in range(6) for y in range(6) if (x + y) % 2], "small": [(9, 9)]}
    t = cells(spark, shapes)
    parts = D.dissolve(t, "key", grid=1, pack_edges=10)
    assert [r.key for r in parts.features.collect()] == ["small"]
    (big,) = D.outline_measures(parts.long_outlines, "key", grid=1).collect()
    assert (big.key, big.area, big.minx, big.maxx) == ("big", 18.0, 0.0, 6.0)
    assert D.ring_points(parts.long_outlines, "key").count() == 72


def test_long_outlines_are_exported_with_their_holes(spark, sf_dir, tmp_path):
    from reachmap.plans import catalog, products

    measured = lambda df: sorted(map(tuple, df.collect()))
    whole = measured(catalog.export_features_geojson(spark, sf_dir))
    assert measured(catalog.export_features_geojson(spark, sf_dir, pack_edges=4)) == whole

    ring = [(x, y) for x in range(5) for y in range(5) if x in (0, 4) or y in (0, 4)]
    long = D.dissolve(cells(spark, {"k": ring}), "key", grid=1, pack_edges=10).long_outlines
    points = D.closed_ring_points(long, "key", grid=1)
    signs = {r.sign: r["count"] for r in points.groupBy("sign").count().collect()}
    assert signs == {1: 21, -1: 13} and D.point_measures(points, "key").first().area == 16.0

    level = long.withColumnRenamed("key", "feature_id").withColumn("level", F.lit("tract"))
    # degrees, as the map reads grid units
    level = level.withColumns({c: (F.col(c) * D.GRID).cast("bigint") for c in D.EDGE})
    empty = lambda schema: spark.createDataFrame([], schema)
    made = {
        "features": empty("level string, feature_id string, geom " + GEOM.simpleString()),
        "long_outlines": level, "bigtract_blocks": empty("geoid10 string"),
    }
    made["tract_area"] = spark.createDataFrame([], "tract_id string, aland10 bigint, area_m2 double, area double")
    rows = products.map_rings(made, str(tmp_path)).filter("z = 8").collect()
    assert all(len(r.pts) == 1 for r in rows) and {r.sign for r in rows} == {1, -1}
    assert sum(r.sign == 1 for r in rows) == 20 and sum(r.sign == -1 for r in rows) == 12


def test_mercator(spark):
    deg = table(spark, ("k", square(0, 0)))
    m = deg.select(G.map_points(F.col("geom"), G.mercator).alias("geom"))
    xs = [p.x for p in m.first().geom[0][0]]
    assert max(xs) - min(xs) == pytest.approx(111319.4908, abs=1e-4)
    at60 = table(spark, ("k", square(0, 0, 1, 60)))
    top = max(p.y for p in at60.select(G.map_points(F.col("geom"), G.mercator).alias("g")).first().g[0][0])
    assert top == pytest.approx(8399737.8898, abs=1e-3)


def test_provider_footprint_ignores_technologies(spark):
    from reachmap.operators.geometry import provider_blocks

    from .helpers import B1, filings

    geom = spark.createDataFrame(
        [(B1, square(0, 0))], "geoid10 string, geom " + GEOM.simpleString()
    )
    once = filings(spark, (B1, 1, 50, 1.0, 1.0))
    twice = filings(spark, (B1, 1, 50, 1.0, 1.0), (B1, 1, 10, 1.0, 1.0))
    edges = [
        sorted(map(tuple, D.dissolve_edges(provider_blocks(f, geom), "hoconum", "county_fips", grid=1).collect()))
        for f in (once, twice)
    ]
    assert edges[0] == edges[1] and len(edges[0]) == 4


def _square_ring(x, y, w, shell=True):
    p = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    return np.array(p if shell else p[::-1])


def test_nesting_of_very_many_holes():
    k = 316
    rings = [_square_ring(0, 0, 10 * k + 10)]
    rings += [_square_ring(10 * i + 5, 10 * j + 5, 4, False) for i in range(k) for j in range(k)]
    (polygon,) = D.nest_rings(rings)
    assert len(polygon) == k * k + 1


def test_nesting_of_islands_in_holes():
    rings = [
        _square_ring(0, 0, 1000), _square_ring(10, 10, 900, False), _square_ring(20, 20, 100),
        _square_ring(30, 30, 20, False), _square_ring(200, 20, 100), _square_ring(210, 30, 20, False),
    ]
    got = {tuple(p[0][0]): sorted(tuple(h[0]) for h in p[1:]) for p in D.nest_rings(rings)}
    assert got == {(0, 0): [(10, 10)], (20, 20): [(30, 30)], (200, 20): [(210, 30)]}


def test_no_row_of_a_provider_and_an_edge_passes_a_shuffle(spark):
    # Blocks of two counties on a lattice of 12 by 12, and one that lies on another.
    geoid = "concat('01', lpad(cast(id % 2 as string), 3, '0'), lpad(cast(id as string), 10, '0'))"
    rows = [(i, square(i % 12, i // 12)) for i in range(144)] + [(144, square(4, 5))]
    geom = spark.createDataFrame(rows, "id long, geom " + GEOM.simpleString()).selectExpr(f"{geoid} as geoid10", "1L as aland10", "geom")
    filings = spark.range(145 * 8).selectExpr("id div 8 as id", "id % 8 as k").selectExpr(
        f"{geoid} as block_code", "1 as consumer", "cast(if((id * 7 + k * k) % 5 < 3, k, null) as int) as hoconum"
    )
    filings = filings.unionByName(filings)
    got = geometry.footprint_edges(filings, geom, grid=1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*hoconum", plan) and "hashpartitioning(edge" not in plan
    want = D.dissolve_edges(geometry.provider_blocks(filings, geom), "hoconum", "county_fips", grid=1)
    assert "mult" in got.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert got.agg({"mult": "max"}).first()[0] == 2


@pytest.mark.parametrize("pack_edges", [4, 12, 60, 1000])
def test_long_outlines_in_parts_are_the_whole_area(spark, pack_edges):
    r = random.Random(4)
    shapes = {k: [(x, y) for x in range(9) for y in range(9) if r.random() < 0.7] for k in "ab"}
    # triangles with one first point, a ring around an island, a feature of more edges than the limit
    fan = [((0, 0), (i, 40), (i + 1, 40)) for i in range(30)]
    ring = [(x, y) for x in range(7) for y in range(7) if x in (0, 6) or y in (0, 6)] + [(3, 3)]
    comb = [(0, 0), (41, 0), *[(x, 1 + x % 2) for x in range(41, -1, -1)]]
    closed = lambda pts: [[[{"x": float(x), "y": float(y)} for x, y in [*pts, pts[0]]]]]
    t = cells(spark, {**shapes, "ring": ring}).unionByName(
        table(spark, *[("fan", closed(p)) for p in fan], ("comb", closed(comb)), ("comb", square(0, -1, 41)))
    )
    long = D.dissolve(t, "key", grid=1, pack_edges=3).long_outlines
    rest = long.filter("key != 'b'")
    parts = D.outline_parts(t, rest, "key", grid=1, pack_edges=pack_edges)
    edges = lambda df: sorted(map(tuple, df.select("key", *D.EDGE, "mult").collect()))
    assert edges(D.dissolve_edges(parts, "key", grid=1)) == edges(rest)
    sizes = [(q.key, sum(len(x) - 1 for p in q.geom for x in p)) for q in parts.collect()]
    one = {k: max(len(f) for f in fs) for k, fs in {"a": [range(4)], "ring": [range(4)], "fan": fan, "comb": [comb]}.items()}
    assert all(n <= max(pack_edges, one[k]) for k, n in sizes)
    assert len(sizes) > len(one) and (pack_edges < 1000 or len(sizes) <= 4 * len(one))


def test_outlines_without_a_key_stay_beside_long_ones(spark):
    t = table(spark, (None, square(9, 9)), ("s", square(5, 5)), *[("big", square(2 * i, 0)) for i in range(4)])
    parts = D.dissolve(t, "key", grid=1, pack_edges=10)
    assert {r.key for r in parts.features.collect()} == {None, "s"}
    assert parts.long_outlines.count() == 16


def test_speed_layers_have_features_whose_outlines_are_too_long_for_a_row(spark, sf_dir, monkeypatch):
    from functools import partial

    from reachmap.plans.catalog import QUERIES
    from reachmap.plans.oracles import oracles

    from .compare import connect, difference

    monkeypatch.setattr(D, "dissolve", partial(D.dissolve, pack_edges=8))
    assert difference(QUERIES["speed_layer_tiles"](spark, sf_dir), connect(sf_dir), oracles()["speed_layer_tiles"]) is None
