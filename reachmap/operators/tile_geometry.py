"""Geometry inside tiles: a quadtree descent that clips, and what builds on the pieces.

A feature starts in the few tiles of the deepest zoom at which its box is no wider
than a tile, and from there goes to the children it touches, clipped to each one
and a margin around it. So work follows the shape and not its box, rings are clipped
from what their parent tile has left of them, and no zoom starts from the whole
ring. A tile inside the shape has no geometry of its own: it is marked `whole`, and
so are all its descendants. Features are dealt out once, to as many tasks as the tiles
they will make ask; then every level is one narrow step over rows (no shuffle)
that ends in a written table, which is also that zoom's result.

Coordinates are tiles of the zoom (world * 2^z); x is unwrapped, so a shape across
the antimeridian goes on in columns from 2^z on or below 0, which wrap in the result.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom as G
from ..functions.joins import in_tasks, spread_join
from ..session import cut
from .dissolve import EDGE, outline_edges
from .tiles import BASE_DETAIL, FOLDED, TILE, thin_tiles

# A tile's pieces reach this far (in tiles) over its sides, as a drawn line has a width.
MARGIN = 1 / 64
# Pieces that cover less of a tile are rounding.
LEAST_AREA = 1e-10
# Cells of the space-filling curve along a tile's side, as a power of two, and those of a block of it.
CURVE_BITS = 10
BLOCK_BITS = 6
# Tiles of a feature's deepest zoom, by its box, that one task of the descent makes.
DESCENT_ROWS = 10_000


POINTS = "array<struct<x:double,y:double>>"
# The box of a polygon's shell, in tiles of the zoom.
BOX = ["low_x", "high_x", "low_y", "high_y"]


def _let(value: str, name: str, body: str) -> str:
    """SQL text that evaluates `value` once, as `name`, for `body`."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _segments(ring: str) -> str:
    n = f"greatest(size({ring}) - 1, 0)"
    return f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), (a, b) -> struct(a as a, b as b))"


def half_plane(ring: str, axis: str, bound: str, above: bool, name: str = "r") -> str:
    """SQL text of the part of a closed ring on one side of a line across an axis; closed or empty.

    The point at which an edge meets the line is computed from its lower end, so that
    both neighbours of a border get the same point.
    """
    other = "y" if axis == "x" else "x"
    op, extreme = (">=", "array_min") if above else ("<=", "array_max")
    p, q = "least(s.a, s.b)", "greatest(s.a, s.b)"
    at = f"{p}.{other} + ({bound} - {p}.{axis}) / ({q}.{axis} - {p}.{axis}) * ({q}.{other} - {p}.{other})"
    meet = f"struct({bound} as x, {at} as y)" if axis == "x" else f"struct({at} as x, {bound} as y)"
    a, b = f"s.a.{axis} {op} {bound}", f"s.b.{axis} {op} {bound}"
    kept = (
        f"case when {a} and {b} then array(s.b) when {a} then array({meet}) "
        f"when {b} then array({meet}, s.b) else cast(array() as {POINTS}) end"
    )
    cut_off = _let(
        f"flatten(transform({_segments(name)}, s -> {kept}))", f"{name}o", f"concat({name}o, slice({name}o, 1, 1))"
    )
    all_in = f"{extreme}(transform({name}, p -> p.{axis})) {op} {bound}"
    return _let(ring, name, f"if(size({name}) = 0 or {all_in}, {name}, {cut_off})")


def ring_area(ring: str) -> str:
    """SQL text of a closed ring's area, from its first point."""
    o = f"element_at({ring}, 1)"
    cross = f"(s.a.x - {o}.x) * (s.b.y - {o}.y) - (s.b.x - {o}.x) * (s.a.y - {o}.y)"
    return f"abs(aggregate(transform({_segments(ring)}, s -> {cross}), 0D, (t, v) -> t + v)) / 2"


def clip(rings: str, x0: str, y0: str, x1: str, y1: str, name: str = "c") -> str:
    """SQL text of the rings (a shell, then holes) inside a rectangle; those of no area go.

    Pieces of one ring stay one ring, joined along the rectangle's sides.
    """
    one = name
    for i, (axis, bound, above) in enumerate((("x", x0, True), ("x", x1, False), ("y", y0, True), ("y", y1, False))):
        one = half_plane(one, axis, bound, above, f"{name}{i}")
    return _sizeable(f"transform({rings}, {name} -> {one})", name)


def _sizeable(rings: str, name: str) -> str:
    kept = f"size({name}k) > 3 and {ring_area(f'{name}k')} > {LEAST_AREA}"
    return f"filter({rings}, {name}k -> {kept})"


def rings_area(rings: str, name: str = "g") -> str:
    """SQL text of the shell minus the holes; the largest ring is the shell."""
    areas = f"transform({rings}, {name}r -> {ring_area(f'{name}r')})"
    return _let(areas, name, f"if(size({name}) > 0, 2 * array_max({name}) - aggregate({name}, 0D, (t, v) -> t + v), 0D)")


def _in_box(margin: float) -> str:
    """SQL text of whether a row's polygon lies within its tile and a margin."""
    return " and ".join(
        f"low_{axis} >= ({c} - {margin}D) and high_{axis} <= ({c} + {1 + margin}D)" for axis, c in (("x", "ux"), ("y", "y"))
    )


def _met(rows: DataFrame) -> DataFrame:
    """Rows whose polygon's box and tile have more than a border in common, and those on whole tiles."""
    return rows.filter("whole or (low_x < ux + 1 and high_x > ux and low_y < y + 1 and high_y > y)")


def _clipped(rows: DataFrame, margin: float) -> DataFrame:
    """Rows (ux, y, rings, box) on a tile each, clipped to it; untouched tiles go, inner ones become whole.

    The box is the polygon's, on all its tiles. What lies within a tile is not clipped.
    """
    low = [f"({c} - {margin}D)" for c in ("ux", "y")]
    high = [f"({c} + {1 + margin}D)" for c in ("ux", "y")]
    near = f"case when {_in_box(margin)} then {_sizeable('rings', 'n')} else {clip('rings', *low, *high)} end"
    inside = "covered"
    if margin:
        cut_off = rings_area(clip("near", "double(ux)", "double(y)", "(ux + 1D)", "(y + 1D)", "d"))
        inside = f"case when {_in_box(0.0)} then covered else {cut_off} end"
    full = f"size(near) = 1 and covered > {(1 + 2 * margin) ** 2 - LEAST_AREA}D"
    found = _let(rings_area("near", "h"), "covered", f"struct({inside} as area, {full} as full, near as near)")
    found = _let(near, "near", found)
    # A generator, so that the filter on the area does not clip a second time.
    rest = [c for c in rows.columns if c not in ("whole", "rings")]
    rows = rows.selectExpr(
        *[f"`{c}`" for c in rest],
        "whole",
        f"inline(array(if(whole, struct(1D as area, true as full, cast(null as array<{POINTS}>) as near), {found})))",
    )
    rows = rows.filter(F.col("area") > LEAST_AREA)
    return rows.selectExpr(*[f"`{c}`" for c in rest], "whole or full as whole", "area", "if(whole or full, null, near) as rings")


def _seeds(features: DataFrame, keys: list[str]) -> DataFrame:
    """Polygons in world coordinates (0 to 1) with the zoom at which they start.

    Shells of no area go by the polygon as it came: a filter on the moved rings would go down
    into their lambda, and each of a polygon's rings would move all of them again.
    """
    world = lambda p: G.point(G.world_x(p["x"]), G.world_y(p["y"]))
    rows = features.select(*keys, "zmin", "zmax", F.posexplode("geom").alias("poly", "polygon"))
    rows = rows.filter(F.size(F.get("polygon", F.lit(0))) > 3)
    rings = F.transform("polygon", lambda r: F.transform(G.unwrapped(r), world))
    rows = rows.select(*keys, "zmin", "zmax", "poly", rings.alias("rings"))
    # Holes may have been unwrapped to another turn of the globe than their shell.
    first = lambda r: F.element_at(r, 1)["x"]
    moved = F.transform(
        "rings",
        lambda r: G.let(
            F.round(first(F.element_at("rings", 1)) - first(r)),
            lambda d: F.when(d == 0, r).otherwise(F.transform(r, lambda p: G.point(p["x"] + d, p["y"]))),
        ),
    )
    rows = rows.withColumn("rings", moved)
    shell = F.element_at("rings", 1)
    xs, ys = F.transform(shell, lambda p: p["x"]), F.transform(shell, lambda p: p["y"])
    ends = [F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)]
    rows = rows.withColumns(dict(zip(BOX, ends)))
    widest = F.greatest(F.col("high_x") - F.col("low_x"), F.col("high_y") - F.col("low_y"), F.lit(2.0**-30))
    start = F.greatest(F.least(F.floor(-F.log2(widest)).cast("int"), F.col("zmin")), F.lit(0))
    return rows.withColumn("start", start)


def _dealt(seeds: DataFrame, keys: list[str]) -> DataFrame:
    """The polygons, written in tasks by feature, with `alone`: no two of the feature's pieces meet in a tile.

    That is so for a key's only polygon that keeps within one turn of the globe. Merged by
    their compressed bytes, thousands of small polygons would go down the tree in one task.
    """
    seeds = cut(seeds, "tile-polygons")
    n = F.pow(F.lit(2.0), "zmax")
    tiles = (F.floor((F.col("high_x") - F.col("low_x")) * n) + 1) * (F.floor((F.col("high_y") - F.col("low_y")) * n) + 1)
    count, rows = seeds.agg(F.count("*"), F.coalesce(F.sum(F.least(tiles, F.lit(DESCENT_ROWS))), F.lit(0))).first()
    dealt = in_tasks(seeds, min(rows, count * DESCENT_ROWS), DESCENT_ROWS, *keys)
    only = F.count("*").over(Window.partitionBy(*keys)) == 1
    return cut(dealt.withColumn("alone", only & (F.col("low_x") >= 0) & (F.col("high_x") <= 1)), "tile-seeds")


def _started(seeds: DataFrame, z: int, keys: list[str]) -> DataFrame:
    """The polygons that start at a zoom, on the tiles of their box: at most two each way."""
    n = 1 << z
    scaled = F.transform("rings", lambda r: F.transform(r, lambda p: G.point(p["x"] * n, p["y"] * n)))

    def span(axis):
        return F.floor(F.col(f"low_{axis}") * n).cast("int"), F.floor(F.col(f"high_{axis}") * n).cast("int")

    def row(y):
        return F.least(F.greatest(y, F.lit(0)), F.lit(n - 1))

    (x0, x1), (y0, y1) = span("x"), span("y")
    box = [(F.col(c) * n).alias(c) for c in BOX]
    return _met(
        seeds.filter(F.col("start") == z)
        .withColumn("ux", F.explode(F.sequence(x0, x1)))
        .withColumn("y", F.explode(F.sequence(row(y0), row(y1))))
        .select(*keys, "alone", "zmin", "zmax", "poly", "ux", "y", F.lit(False).alias("whole"), *box, scaled.alias("rings"))
    )


def _children(rows: DataFrame, keys: list[str], z: int) -> DataFrame:
    quarters = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    double = F.expr("transform(rings, r -> transform(r, p -> struct(p.x * 2 as x, p.y * 2 as y)))")
    rows = rows.filter(F.col("zmax") >= z).withColumn("q", quarters)
    ux, y = 2 * F.col("ux") + F.col("q.i"), 2 * F.col("y") + F.col("q.j")
    box = [(2 * F.col(c)).alias(c) for c in BOX]
    return _met(rows.select(*keys, "alone", "zmin", "zmax", "poly", ux.alias("ux"), y.alias("y"), "whole", *box, double.alias("rings")))


def tile_pieces(features: DataFrame, keys: list[str], margin: float = MARGIN) -> DataFrame:
    """The pieces of features on every tile they touch from zoom `zmin` to `zmax` (columns).

    `features` have (keys, geom, zmin, zmax). Gives (keys, poly, z, x, y, ux, whole,
    area, rings): a row for each polygon and tile. `area` is what the polygon covers
    of the tile itself, in tiles; `rings` reach `margin` over it, null where the tile
    is whole. The pieces' areas at a zoom sum to the feature's area.
    """
    return _descent(features, keys, margin).drop("alone")


def _descent(features: DataFrame, keys: list[str], margin: float) -> DataFrame:
    """`tile_pieces` with the features' `alone`."""
    seeds = _dealt(_seeds(features, keys), keys)
    zooms = seeds.agg(F.min("start"), F.max("zmax"), F.min("zmin")).first()
    names = [*keys, "alone", "poly", "z", "x", "y", "ux", "whole", "area", "rings"]
    parts, frontier = [], None
    for z in range(zooms[0] or 0, (zooms[1] if zooms[1] is not None else 0) + 1):
        rows = _started(seeds, z, keys)
        if frontier is not None:
            rows = rows.unionByName(_children(frontier, keys, z))
        frontier = cut(_clipped(rows, margin).withColumn("z", F.lit(z)), f"tile-pieces-{z}")
        if zooms[2] is None or z >= zooms[2]:
            shown = frontier.filter((F.col("zmin") <= z) & (F.col("zmax") >= z))
            parts.append(shown.withColumn("x", F.pmod("ux", F.lit(1 << z))).select(*names))
    return reduce(DataFrame.unionByName, parts)


def touched_tiles(features: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, z, x, y): the tiles each feature touches at its zooms, by the descent.

    Only features of several polygons, or around the globe, can come to a tile more than
    once; the tiles of the others pass no shuffle and no hash map.
    """
    pieces = _descent(features, keys, 0.0).select(*keys, "z", "x", "y", "alone")
    once, again = pieces.filter("alone"), pieces.filter("not alone")
    return once.drop("alone").unionByName(again.drop("alone").distinct())


def over_bands(features: DataFrame, bands) -> DataFrame:
    """Features of a `level` in the bands, with the level's first and last zoom."""
    ends = {}
    for b in bands:
        low, high = ends.get(b.level, (b.zmin, b.zmax))
        ends[b.level] = (min(low, b.zmin), max(high, b.zmax))
    cases = " ".join(f"when '{k}' then struct({a} as zmin, {b} as zmax)" for k, (a, b) in ends.items())
    return features.select("*", F.expr(f"inline(array(case level {cases} end))")).filter("zmin is not null")


def with_whole(pieces: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Pieces whose whole tiles have a ring too: the tile with its margin."""
    x0, y0 = F.col("ux") - F.lit(margin), F.col("y") - F.lit(margin)
    x1, y1 = F.col("ux") + F.lit(1 + margin), F.col("y") + F.lit(1 + margin)
    corners = [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]
    rect = F.array(F.array(*[G.point(a, b) for a, b in corners]))
    return pieces.withColumn("rings", F.when(F.col("whole"), rect).otherwise(F.col("rings")))


def quantised_pieces(pieces: DataFrame, margin: float = MARGIN, detail: int | Column = BASE_DETAIL) -> DataFrame:
    """Pieces with their rings as whole numbers, 2^detail units a tile side, from its upper left corner."""
    unit = F.pow(F.lit(2.0), F.lit(detail) if isinstance(detail, int) else detail)
    whole = lambda v, at: F.round((v - at) * unit).cast("bigint")
    rings = F.transform(
        "rings", lambda r: F.transform(r, lambda p: G.point(whole(p["x"], F.col("ux")), whole(p["y"], F.col("y"))))
    )
    return with_whole(pieces, margin).withColumn("rings", rings)


def piece_edges(quantised: DataFrame, *keys: str) -> DataFrame:
    """Directed edges of quantised pieces: shells and holes of a piece turn opposite ways.

    The largest ring of a piece is its shell. Points that became equal are one.
    """
    size = lambda r: G.signed_area(r)
    rings = quantised.withColumn("largest", F.array_max(F.transform("rings", lambda r: F.abs(size(r)))))
    ring = rings.select(*keys, "largest", F.explode("rings").alias("ring")).withColumn("turn", size(F.col("ring")))
    keep = (F.abs("turn") == F.col("largest")) == (F.col("turn") > 0)
    sides = ring.filter("turn != 0").select(*keys, keep.alias("keep"), F.inline(G.segments(F.col("ring"))))
    end = lambda a, b, c: F.when(F.col("keep"), F.col(f"{a}.{c}")).otherwise(F.col(f"{b}.{c}"))
    return sides.filter("a != b").select(
        *keys, end("a", "b", "x").alias("x1"), end("a", "b", "y").alias("y1"), end("b", "a", "x").alias("x2"), end("b", "a", "y").alias("y2")
    )


def coalesced_edges(quantised: DataFrame, group: list[str]) -> DataFrame:
    """Outline edges of all pieces of a tile with equal attributes, their common borders cancelled.

    `group` names the tile's and the attributes' columns. Rows stay rows, so a tile
    that holds all features is no large group; `dissolve.ring_edges` orders them.
    """
    return outline_edges(piece_edges(quantised, *group), *group)


# --- what does not fit a tile -------------------------------------------------
def curve_key(x: Column, y: Column, bits: int = CURVE_BITS) -> Column:
    """Place of a cell on the Z-order curve: the bits of both coordinates in turn."""
    key = F.lit(0)
    for b in range(bits):
        key = key + F.shiftleft(F.shiftright(x, b).bitwiseAND(1), 2 * b) + F.shiftleft(F.shiftright(y, b).bitwiseAND(1), 2 * b + 1)
    return key


def drop_densest(cover: DataFrame, budget: int, feature_id: str) -> DataFrame:
    """At most `budget` features of each tile: those with the widest gaps before them.

    Centres lie on a grid of 2^CURVE_BITS cells a side, along a space-filling curve.
    A feature's gap is the distance on the curve to the feature before; the first has
    the curve's length, and of features in one cell all but the smallest id have 0. A
    tile above its budget keeps gaps down to a threshold, and at the threshold as
    many as there is room for, in the order of the curve place's bits reversed, which
    spreads them over the tile. Adds `gap`. Tiles within the budget keep everything.

    No group grows with the data: a block of the curve has 2^(2*BLOCK_BITS) cells at
    most, and a tile's gaps take fewer than 2^(CURVE_BITS + 1) values, as they sum to the curve.
    """
    n = F.pow(F.lit(2.0), F.col("z"))
    side = 1 << CURVE_BITS

    def cell(world, tile):
        return F.least(F.greatest(F.floor((world * n - tile) * side), F.lit(0)), F.lit(side - 1)).cast("int")

    cx = cell(G.world_x((F.col("minx") + F.col("maxx")) / 2), F.col("x"))
    cy = cell(G.world_y((F.col("miny") + F.col("maxy")) / 2), F.col("y"))
    rows = cover.withColumn("place", curve_key(cx, cy))
    firsts = rows.groupBy(*TILE, "place").agg(F.min(feature_id).alias("first"))
    firsts = cut(firsts.withColumn("block", F.shiftright("place", 2 * BLOCK_BITS)), "curve-cells")
    ends = firsts.groupBy(*TILE, "block").agg(F.max("place").alias("end"))
    earlier = ends.withColumn("earlier", F.lag("end").over(Window.partitionBy(*TILE).orderBy("block"))).drop("end")
    before = F.lag("place").over(Window.partitionBy(*TILE, "block").orderBy("place"))
    gaps = firsts.withColumn("before", before).join(earlier, [*TILE, "block"])
    gaps = cut(
        gaps.select(*TILE, "place", "first", (F.col("place") - F.coalesce("before", "earlier", F.col("place") - side * side)).alias("gap")),
        "curve-gaps",
    )
    count = rows.groupBy(*TILE).agg(F.count("*").alias("all"))
    wide = gaps.groupBy(*TILE, "gap").agg(F.count("*").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy(*TILE).orderBy(F.desc("gap")))
    # The least gap of which all features fit, and the room left for the next one.
    fits = wide.withColumn("kept", up_to).filter(F.col("kept") <= budget).groupBy(*TILE).agg(F.min("gap").alias("least"), F.max("kept").alias("kept"))
    limit = count.filter(F.col("all") > budget).join(fits, TILE, "left").withColumns(
        {"least": F.coalesce("least", F.lit(side * side + 1)), "room": F.lit(budget) - F.coalesce("kept", F.lit(0))}
    )
    below = spread_join(wide.select(*TILE, "gap"), limit.select(*TILE, "least"), TILE).filter("gap < least")
    following = below.groupBy(*TILE).agg(F.max("gap").alias("next"))
    limit = limit.join(following, TILE, "left").select(*TILE, "least", "room", F.coalesce("next", F.lit(0)).alias("next"))
    tagged = rows.join(gaps, [*TILE, "place"]).withColumn("gap", F.when(F.col(feature_id) == F.col("first"), F.col("gap")).otherwise(0)).drop("first")
    tagged = spread_join(tagged, limit, TILE, "left")
    sure = tagged.filter(F.col("least").isNull() | (F.col("gap") >= F.col("least")))
    spread = F.reverse(F.lpad(F.bin("place"), 2 * CURVE_BITS, "0"))
    rank = F.row_number().over(Window.partitionBy(*TILE).orderBy(spread, feature_id))
    at = tagged.filter((F.col("gap") < F.col("least")) & (F.col("gap") == F.col("next"))).withColumn("rank", rank)
    at = at.filter(F.col("rank") <= budget).filter(F.col("rank") <= F.col("room")).drop("rank")
    return sure.unionByName(at).drop("place", "least", "room", "next")


def borders(edges: DataFrame, feature_id: str) -> DataFrame:
    """(tile, feature, neighbour, border): neighbours in a tile and how long their common border is.

    From directed edges of quantised pieces: an edge of one feature that another has the
    other way round. Lengths are whole numbers, the larger side of each edge's box.
    """
    up = "x1 < x2 or (x1 = x2 and y1 < y2)"
    way = [F.expr(f"if({up}, {a}, {b})").alias(n) for a, b, n in (("x1", "x2", "lx"), ("y1", "y2", "ly"), ("x2", "x1", "hx"), ("y2", "y1", "hy"))]
    sides = edges.select(*TILE, F.expr(f"if({up}, {feature_id}, null)").alias("left"), F.expr(f"if({up}, null, {feature_id})").alias("right"), *way)
    both = sides.groupBy(*TILE, "lx", "ly", "hx", "hy").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    both = both.filter("left is not null and right is not null and left != right")
    length = F.greatest(F.abs(F.col("hx") - F.col("lx")), F.abs(F.col("hy") - F.col("ly")))
    pairs = F.array(*[F.struct(F.col(a).alias(feature_id), F.col(b).alias("neighbour")) for a, b in (("left", "right"), ("right", "left"))])
    return both.select(*TILE, length.alias("border"), F.inline(pairs)).groupBy(*TILE, feature_id, "neighbour").agg(F.sum("border").alias("border"))


def merge_targets(cover: DataFrame, kept: DataFrame, edges: DataFrame, feature_id: str) -> DataFrame:
    """(tile, feature, target) for the features of a tile: where each one's geometry goes.

    A kept feature stays. Another merges into the neighbour with the longest common
    border among those before it in the ranking (by size, then id), with it into that
    one's target, and so on: pointers lead up the ranking, so they never run in circles,
    and doubling resolves them in rounds of the logarithm of the longest chain. What
    then points to no kept feature goes to the tile's largest.
    """
    mine = [*TILE, feature_id]
    ranked = cut(cover.select(*mine, "size"), "ranked")
    other = ranked.select(*TILE, F.col(feature_id).alias("neighbour"), F.col("size").alias("other_size"))
    near = borders(edges, feature_id).join(ranked, mine).join(other, [*TILE, "neighbour"])
    above = (F.col("other_size") > F.col("size")) | ((F.col("other_size") == F.col("size")) & (F.col("neighbour") < F.col(feature_id)))
    # Of equal borders the larger neighbour, then the smaller id.
    order = F.struct((-F.col("border")).alias("b"), (-F.col("other_size")).alias("s"), F.col("neighbour").alias("n"))
    best = near.filter(above).groupBy(*mine).agg(F.min_by("neighbour", order).alias("up"))
    flagged = ranked.join(kept.select(*mine, F.lit(True).alias("kept")), mine, "left").join(best, mine, "left")
    up = F.when(F.col("kept"), F.col(feature_id)).otherwise(F.coalesce("up", feature_id))
    state = cut(flagged.select(*mine, up.alias("target")), "merge-targets")
    while True:
        ahead = state.select(*TILE, F.col(feature_id).alias("target"), F.col("target").alias("further"))
        moved = cut(state.join(ahead, [*TILE, "target"]), "merge-targets")
        state = moved.select(*mine, F.col("further").alias("target"))
        if moved.filter("further != target").isEmpty():
            break
    largest = F.min_by(feature_id, F.struct((-F.col("size")).alias("s"), F.col(feature_id)))
    first = kept.groupBy(*TILE).agg(largest.alias("first"))
    roots = kept.select(*TILE, F.col(feature_id).alias("target"), F.lit(True).alias("good"))
    found = spread_join(state.join(roots, [*TILE, "target"], "left"), first, TILE)
    return found.select(*mine, F.when(F.col("good"), F.col("target")).otherwise(F.col("first")).alias("target"))


def coalesce_smallest(cover: DataFrame, edges: DataFrame, budget: int, feature_id: str):
    """(features, outline edges) of each tile with the smallest features merged into neighbours.

    `cover` has (tile, feature, size, cost), `edges` the directed edges of the
    features' quantised pieces. Features above the budget's cut stay; the others'
    geometry joins that of their target (`merge_targets`), common borders cancel, and
    what merged is on the target's row as number, size and cost. No area is lost.
    """
    mine = [*TILE, feature_id]
    cover = cut(cover.select(*mine, "size", "cost"), "to-merge")
    edges = cut(edges.select(*mine, *EDGE), "merge-edges")
    kept = cut(thin_tiles(cover, budget, feature_id).drop("run_cost"), "kept")
    targets = cut(merge_targets(cover, kept, edges, feature_id), "targets")
    folded = (
        targets.filter(F.col("target") != F.col(feature_id))
        .join(cover, mine)
        .groupBy(*TILE, F.col("target").alias(feature_id))
        .agg(F.count("*").alias("folded_n"), F.sum("size").alias("folded_size"), F.sum("cost").alias("folded_cost"))
    )
    features = kept.join(folded, mine, "left").fillna(0, subset=FOLDED)
    merged = edges.join(targets, mine).select(*TILE, F.col("target").alias(feature_id), *EDGE)
    return features, outline_edges(merged, *mine)


def base_tiles(shapes: DataFrame, boxes: DataFrame, bands, budget: int) -> DataFrame:
    """Base-map layers: each geography's features on the tiles they touch, at most `budget` a tile.

    `shapes` have (level, feature_id, geom), `boxes` (level, feature_id, box), the box
    to show. Where a tile has more features, the densest go (`drop_densest`).
    """
    touched = touched_tiles(over_bands(shapes, bands), ["level", "feature_id"])
    rows = touched.join(boxes, ["level", "feature_id"]).withColumn("layer", F.col("level")).drop("level")
    return drop_densest(rows, budget, "feature_id")
