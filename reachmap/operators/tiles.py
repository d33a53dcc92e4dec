"""Map pyramid as tables keyed by (layer, z, x, y).

Our own definitions of the steps, stated per function; the encoded tile file
itself is not produced.
"""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom as G
from ..functions.joins import in_tasks, spread_join
from ..session import by_key, by_key_in_place, cut, tasks_for
from .dissolve import outline_edges

TILE = ["layer", "z", "x", "y"]
# what a kept feature took in: number, size and cost
FOLDED = ["folded_n", "folded_size", "folded_cost"]
# rows of a provider's tiles that one task makes and counts
COVER_ROWS = 400_000
# wide rows of statistics, or rows of features on tiles, that one task joins
STAT_ROWS = 30_000
# resolution of a tile without extra detail: 2^12 units per side
BASE_DETAIL = 12


class Band(NamedTuple):
    """Treatment of one feature level over a range of zooms."""

    level: str
    zmin: int
    zmax: int
    simplify: int = 1
    coalesce: bool = False
    thin: bool = False
    detail: int = BASE_DETAIL
    drop_attr: str | None = None


# --- fixed values: zoom bands of the speed, large-block and provider layers --
SPEED_BANDS = (
    Band("county", 0, 4, drop_attr="geoid10"),
    Band("tract", 5, 5, simplify=8, coalesce=True, thin=True, drop_attr="tract_id"),
    Band("tract", 6, 8, drop_attr="tract_id"),
    Band("smalltract", 9, 9, drop_attr="tract_id"),
    Band("bigtract_block", 9, 9, drop_attr="geoid10"),
    Band("block", 10, 10, simplify=8, coalesce=True, thin=True, drop_attr="geoid10"),
    Band("block", 11, 14, detail=14),
)
XL_BLOCK_BANDS = (Band("xl_block", 5, 9, detail=14, drop_attr="min_zoom"),)
PROVIDER_BANDS = (
    Band("prov_lg", 0, 7, simplify=8, coalesce=True, drop_attr="county_fips"),
    Band("prov_lg", 8, 12, coalesce=True, detail=14, drop_attr="county_fips"),
    Band("prov_other", 0, 8, simplify=8, coalesce=True, drop_attr="county_fips"),
    Band("prov_other", 9, 12, coalesce=True, detail=14, drop_attr="county_fips"),
)
# ---------------------------------------------------------------------------


def base_bands(zooms: dict[str, tuple[int, int]]) -> tuple[Band, ...]:
    """Bands of the base-map layers from configured zoom ranges; they are thinned."""
    return tuple(Band(level, lo, hi, thin=True) for level, (lo, hi) in zooms.items())


def plan_of(level: str, bands=SPEED_BANDS) -> Column:
    """Array of (z and treatment) of the level named in a column."""

    def text(v):
        if v is None:
            return "cast(null as string)"
        return f"'{v}'" if isinstance(v, str) else str(v).lower()

    fields = Band._fields[3:]
    by_level: dict[str, list[str]] = {}
    for b in bands:
        rest = ", ".join(f"{text(getattr(b, f))} as {f}" for f in fields)
        by_level.setdefault(b.level, []).extend(
            f"struct({z} as z, {rest})" for z in range(b.zmin, b.zmax + 1)
        )
    cases = " ".join(f"when '{k}' then array({', '.join(v)})" for k, v in by_level.items())
    return F.expr(f"case `{level}` {cases} end")


def zoom_plan_features(features: DataFrame, bands=SPEED_BANDS) -> DataFrame:
    """Features of a `level` at each zoom of its bands, with the band's treatment.

    The plan is a constant, so it is an expression on the row and not a join.
    """
    return features.select("*", F.inline(plan_of("level", bands)))


def tile_of(world: Column, z: Column) -> Column:
    return F.floor(world * F.pow(F.lit(2.0), z)).cast("int")


def _box_range() -> tuple[Column, Column, Column, Column]:
    """First and last column and row of the tiles of a box at its zoom, columns before they wrap."""
    z = F.col("z")
    n = F.pow(F.lit(2.0), z).cast("int")

    def row(lat):
        return F.least(F.greatest(tile_of(G.world_y(F.col(lat)), z), F.lit(0)), n - 1)

    first, last = tile_of(G.world_x(F.col("minx")), z), tile_of(G.world_x(F.col("maxx")), z)
    # a box at +180 exactly ends in its own last column, and none needs a column twice
    last = F.when(F.col("maxx") == 180.0, F.greatest(last - 1, first)).otherwise(last)
    return first, F.least(last, first + n - 1), row("maxy"), row("miny")


def tile_cover(features: DataFrame) -> DataFrame:
    """Tiles (z, x, y) of each feature's bounding box at its zoom `z`.

    A superset of the tiles the shape itself touches. Columns wrap around the
    antimeridian (boxes may start west of -180), rows stay inside the world.
    """
    first, last, top, bottom = _box_range()
    return (
        features.withColumn("x", F.explode(F.sequence(first, last)))
        .withColumn("x", F.pmod("x", F.pow(F.lit(2.0), F.col("z")).cast("int")))
        .withColumn("y", F.explode(F.sequence(top, bottom)))
    )


def cover_size(features: DataFrame) -> int:
    """Rows of `tile_cover`, none of which is made for it."""
    first, last, top, bottom = (c.cast("long") for c in _box_range())
    n = F.greatest(last - first + 1, F.lit(1)) * (bottom - top + 1)
    return features.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]


def shape_cover(features: DataFrame, *keys: str) -> DataFrame:
    """Tiles (keys, z, x, y) which each feature's shape touches at its zoom `z`.

    Tiles that an edge crosses, and tiles between the crossings of an edge pair
    with the middle line of a tile row, where the inside is. So the rows grow with
    the shape and not with its box. Edges are straight in the projection. One
    group is one tile row of one feature. Shapes across the antimeridian wrap.
    """
    n = F.pow(F.lit(2.0), F.col("z"))
    world = lambda p: G.point(G.world_x(p["x"]) * F.col("n"), G.world_y(p["y"]) * F.col("n"))
    rings = (
        features.withColumn("n", n)
        .select(*keys, "z", "n", F.explode("geom").alias("poly"))
        .select(*keys, "z", "n", F.explode("poly").alias("ring"))
        .select(*keys, "z", "n", F.transform(G.unwrapped(F.col("ring")), world).alias("ring"))
    )
    edges = rings.select(*keys, "z", "n", F.inline(G.segments(F.col("ring")))).selectExpr(
        *keys, "z", "n", "a.x as ax", "a.y as ay", "b.x as bx", "b.y as by"
    )
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    last = F.col("n") - 1
    inside = lambda y: F.greatest(F.least(F.floor(y), last), F.lit(0)).cast("int")
    at = lambda y: F.when(F.col("ay") == F.col("by"), F.col("ax")).otherwise(
        F.col("ax") + (y - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    )
    level = F.col("ay") == F.col("by")
    x0 = F.when(level, F.least("ax", "bx")).otherwise(F.least(at(F.greatest(low, F.col("y"))), at(F.least(high, F.col("y") + 1))))
    x1 = F.when(level, F.greatest("ax", "bx")).otherwise(F.greatest(at(F.greatest(low, F.col("y"))), at(F.least(high, F.col("y") + 1))))
    middle = F.col("y") + 0.5
    rows = (
        edges.withColumn("y", F.explode(F.sequence(inside(low), inside(high))))
        .withColumn("span", F.struct(F.floor(x0).alias("x0"), F.floor(x1).alias("x1")))
        .withColumn("cross", F.when((F.col("ay") <= middle) != (F.col("by") <= middle), at(middle)))
        .groupBy(*keys, "z", "n", "y")
        .agg(F.collect_set("span").alias("spans"), F.sort_array(F.collect_list("cross")).alias("cross"))
    )
    between = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("cross") / 2) - 1),
        lambda i: F.struct(
            F.floor(F.get("cross", (2 * i).cast("int"))).alias("x0"),
            F.floor(F.get("cross", (2 * i + 1).cast("int"))).alias("x1"),
        ),
    )
    spans = F.when(F.size("cross") > 1, F.concat("spans", between)).otherwise(F.col("spans"))
    tiles_ = F.flatten(F.transform(spans, lambda s: F.sequence(s["x0"], F.least(s["x1"], s["x0"] + F.col("n").cast("long") - 1))))
    wrapped = F.array_distinct(F.transform(tiles_, lambda x: F.pmod(x, F.col("n").cast("long")).cast("int")))
    return rows.select(*keys, "z", F.explode(wrapped).alias("x"), "y")


def quantise(lon: Column, lat: Column, z: Column, x: Column, y: Column, detail: Column):
    """Coordinates inside a tile as integers, 2^detail units per side.

    The world column is taken at the tile's turn of the globe, so features
    across the antimeridian keep their shape.
    """
    n = F.pow(F.lit(2.0), z)
    unit = F.pow(F.lit(2.0), detail)
    wx = G.world_x(lon) * n - x
    qx = F.floor(wx * unit)
    qy = F.floor((G.world_y(lat) * n - y) * unit)
    return qx.cast("bigint"), qy.cast("bigint")


def tile_quantise(cover: DataFrame, keys: list[str], detail: int = BASE_DETAIL) -> DataFrame:
    """One row per vertex of each tiled feature: (keys, z, x, y, poly, ring, seq, qx, qy)."""
    qx, qy = quantise(
        F.col("p.x"), F.col("p.y"), F.col("z"), F.col("x"), F.col("y"), F.lit(detail)
    )
    at = [*keys, "z", "x", "y"]
    return (
        cover.select(*at, F.posexplode("geom").alias("poly", "rings"))
        .select(*at, "poly", F.posexplode("rings").alias("ring", "pts"))
        .select(*at, "poly", "ring", F.posexplode("pts").alias("seq", "p"))
        .select(*at, "poly", "ring", "seq", qx.alias("qx"), qy.alias("qy"))
    )


def _neighbours(open_ring: Column) -> Column:
    """Array of (a, b, c): each point b of an open ring between its neighbours."""

    def triples(r):
        n = F.size(r)
        rest = F.greatest(n - 1, F.lit(0))
        before = F.concat(F.slice(r, n, F.lit(1)), F.slice(r, F.lit(1), rest))
        after = F.concat(F.slice(r, F.lit(2), rest), F.slice(r, F.lit(1), F.lit(1)))
        pairs = F.zip_with(before, r, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.zip_with(
            pairs,
            after,
            lambda ab, c: F.struct(ab["a"].alias("a"), ab["b"].alias("b"), c.alias("c")),
        )

    # a ring that has shrunk to nothing has no neighbours to slice
    return F.when(F.size(open_ring) > 0, G.let(open_ring, triples))


def _without_repeats(open_ring: Column) -> Column:
    kept = F.filter(_neighbours(open_ring), lambda t: t["a"] != t["b"])
    return F.transform(kept, lambda t: t["b"])


def _corners(open_ring: Column) -> Column:
    """The points at which an open ring turns."""

    def turns(t):
        a, b, c = t["a"], t["b"], t["c"]
        return (b["x"] - a["x"]) * (c["y"] - b["y"]) != (b["y"] - a["y"]) * (c["x"] - b["x"])

    return F.transform(F.filter(_neighbours(open_ring), turns), lambda t: t["b"])


def _simple_ring(closed_ring: Column) -> Column:
    """Closed ring without repeated and collinear points, empty below a triangle."""
    out = G.let(
        closed_ring,
        lambda r: F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0))),
    )
    for step in (_without_repeats, _corners, _without_repeats):
        out = G.let(out, step)
    return G.let(
        out, lambda r: F.when(F.size(r) >= 3, F.concat(r, F.slice(r, 1, 1)))
    )


def _cells() -> Column:
    return F.pow(F.lit(2.0), F.col("z") + F.col("detail")) / F.col("simplify")


def _snapped(x: Column, y: Column) -> Column:
    return G.point(
        F.round(G.world_x(x) * F.col("cells")).cast("bigint"),
        F.round(G.world_y(y) * F.col("cells")).cast("bigint"),
    )


def simplify_points(points: DataFrame, keys: list[str]) -> DataFrame:
    """`simplify_features` for rings that are rows of points, each with the next one (nx, ny).

    (keys, z, sign, seq, pts) with one point in `pts`. A point that snaps to the
    next one goes, collinear ones stay. Nothing is collected by ring.
    """
    own = [*keys, "z"]
    moved = (
        points.withColumn("cells", _cells())
        .withColumn("p", _snapped(F.col("x"), F.col("y")))
        .withColumn("q", _snapped(F.col("nx"), F.col("ny")))
        .filter("p != q")
        .select(*own, "sign", "seq", F.array("p").alias("pts"))
    )
    large = moved.groupBy(*own).agg(F.count("*").alias("n")).filter("n >= 3").drop("n")
    return spread_join(moved, large, own, "left_semi")


def simplify_features(features: DataFrame, keys: list[str]) -> DataFrame:
    """Geometry snapped to the grid of its zoom, without points that add nothing.

    The grid cell is `simplify` units of 2^-`detail` tile sides. Equal vertices
    snap to equal points, so neighbours keep their shared border. Rings which
    shrink below a triangle disappear, with them features left without a ring.
    Works ring by ring: (keys, z, poly, ring, pts) on integer grid points.
    """

    def snap(p):
        return _snapped(p["x"], p["y"])

    rings = (
        features.withColumn("cells", _cells())
        .select(*keys, "z", "cells", F.posexplode("geom").alias("poly", "rings"))
        .select(*keys, "z", "cells", "poly", F.posexplode("rings").alias("ring", "pts"))
    )
    return (
        rings.withColumn("pts", _simple_ring(F.transform("pts", snap)))
        .filter(F.col("pts").isNotNull())
        .drop("cells")
    )


def coalesced_outline(rings: DataFrame, group: list[str]) -> DataFrame:
    """Outline edges of features which coalesce, from their rings on the tile grid.

    Features with equal attributes lose the borders between them: the same
    cancelling sum as a dissolve, whose rows stay rows however many there are.
    """
    seg = F.inline(G.segments(F.col("pts")))
    edges = rings.select(*group, seg).select(
        *group,
        F.col("a.x").alias("x1"),
        F.col("a.y").alias("y1"),
        F.col("b.x").alias("x2"),
        F.col("b.y").alias("y2"),
    )
    return outline_edges(edges, *group)


def coalesce_tiles(cover: DataFrame, attrs: list[str], feature_id: str) -> DataFrame:
    """Features of a tile with equal attributes as one.

    Gives their number, the first id as the order, and the joint box. The parts
    are not collected into a row, as the single tile of zoom 0 holds them all:
    `coalesced_outline` has the joint geometry as rows.
    """
    return cover.groupBy(*TILE, *attrs).agg(
        F.count("*").alias("n_features"),
        F.min(feature_id).alias("ord"),
        F.min("minx").alias("minx"),
        F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"),
        F.max("maxy").alias("maxy"),
        *[F.sum(c).cast("bigint").alias(c) for c in FOLDED if c in cover.columns],
    )


def thin_tiles(
    cover: DataFrame, budget: int, feature_id: str, slices: tuple[int, ...] = (1024, 32)
) -> DataFrame:
    """Largest features of each tile whose summed `cost` fits the budget.

    Order is size descending, then id; a feature is kept while the running cost
    up to and including it stays within the budget. The first is always kept,
    so no tile is emptied by a feature above the budget. Adds `run_cost`.

    A hot tile is not ranked in one task: zoom 0 has a single tile. Its features
    are ranked within slices by id first, then within ever fewer slices, and
    each slice keeps its rows up to and including the first one beyond the
    budget. Every row before the tile's own cut is before its slice's cut, and
    the first row beyond the tile's cut survives too, so the last ranking cuts
    at the same place as a ranking of everything. With costs of at least 1 it
    sees at most `slices[-1] * (budget + 1)` rows of a tile. Each slice count
    must divide the one before.
    """
    rank = [F.col("size").desc(), F.col(feature_id)]

    def running(*by):
        return F.sum("cost").over(
            Window.partitionBy(*by)
            .orderBy(*rank)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    rows = cover.withColumn("_hash", F.xxhash64(feature_id))
    for n in slices:
        rows = (
            rows.withColumn("_slice", F.pmod("_hash", F.lit(n)))
            .withColumn("_run", running(*TILE, "_slice"))
            .filter(F.col("_run") - F.col("cost") <= budget)
        )
    rows = rows.drop("_hash", "_slice", "_run")
    first = F.row_number().over(Window.partitionBy(*TILE).orderBy(*rank)) == 1
    ranked = rows.withColumn("run_cost", running(*TILE)).withColumn("_first", first)
    return ranked.filter((F.col("run_cost") <= budget) | F.col("_first")).drop("_first")


def fold_smallest(
    cover: DataFrame, budget: int, feature_id: str, depth: int = 3
) -> DataFrame:
    """Kept features with what the features below the cut add to them.

    A feature below the cut folds into the largest kept feature of the smallest
    quadtree cell of the tile, down to `depth` halvings, which holds its centre
    and the centre of a kept feature. What folds is summed per cell first, so a
    tile hands on at most 4^depth rows and no pairs are formed.

    Gives the kept rows plus `folded_n`, `folded_size` and `folded_cost`.
    """
    kept = thin_tiles(cover, budget, feature_id).drop("run_cost")
    placed = [f"c{d}" for d in range(depth + 1)]

    def cells(df):
        wx = G.world_x((F.col("minx") + F.col("maxx")) / 2)
        wy = G.world_y((F.col("miny") + F.col("maxy")) / 2)
        n = F.pow(F.lit(2.0), F.col("z"))

        def within(w, tile):
            side = 1 << depth
            return F.least(F.greatest(F.floor((w * n - tile) * side), F.lit(0)), F.lit(side - 1))

        cx, cy = within(wx, F.col("x")), within(wy, F.col("y"))
        return df.withColumns(
            {
                f"c{d}": F.shiftright(cx.cast("int"), depth - d) * (1 << d)
                + F.shiftright(cy.cast("int"), depth - d)
                for d in range(depth + 1)
            }
        )

    below = cells(cover).join(kept.select(*TILE, feature_id), TILE + [feature_id], "left_anti")
    # the smallest cell determines the larger ones
    sums = below.groupBy(*TILE, *placed).agg(
        F.count("*").alias("n"), F.sum("size").alias("size"), F.sum("cost").alias("cost")
    )
    levels = F.array(
        *[
            F.struct(F.lit(d).alias("d"), F.col(f"c{d}").alias("cell"))
            for d in range(depth + 1)
        ]
    )
    # ties in size go to the smallest id, as in the ranking
    leaders = (
        cells(kept)
        .select(*TILE, feature_id, "size", F.inline(levels))
        .groupBy(*TILE, "d", "cell")
        .agg(F.min_by(feature_id, F.struct((-F.col("size")).alias("s"), F.col(feature_id))).alias("target"))
    )
    folded = (
        sums.select(*TILE, "n", "size", "cost", F.col(f"c{depth}").alias("leaf"), F.inline(levels))
        .join(leaders, TILE + ["d", "cell"])
        .groupBy(*TILE, "leaf")
        .agg(
            F.max_by("target", "d").alias(feature_id),
            F.first("n").alias("n"),
            F.first("size").alias("size"),
            F.first("cost").alias("cost"),
        )
        .groupBy(*TILE, feature_id)
        .agg(
            F.sum("n").alias("folded_n"),
            F.sum("size").alias("folded_size"),
            F.sum("cost").alias("folded_cost"),
        )
    )
    return kept.join(folded, TILE + [feature_id], "left").fillna(
        0, subset=FOLDED
    )


def tile_union(*bands: DataFrame) -> DataFrame:
    """Tile sets of several bands as one; zooms may overlap between levels."""
    first, *rest = bands
    for b in rest:
        first = first.unionByName(b, allowMissingColumns=True)
    return first


def on_tiles(planned: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """Planned features (keys, z, ...) on the tiles (keys, z, x, y) that their shapes touch."""
    return planned.join(touched, [*keys, "z"])


def xl_block_tiles(large: DataFrame, touched: DataFrame | None = None, bands=XL_BLOCK_BANDS) -> DataFrame:
    """All large blocks at the zooms of their bands, without the attribute `min_zoom`.

    `touched` has the tiles (geoid10, z, x, y) of the blocks' shapes; without it
    blocks are on the tiles of their boxes.
    """
    shown = zoom_plan_features(large.withColumn("level", F.lit("xl_block")), bands)
    if touched is None:
        return tile_cover(shown).drop("min_zoom")
    return on_tiles(shown, touched, ["geoid10"]).drop("min_zoom")


def provider_tiles(footprints: DataFrame, is_large: Column, bands=PROVIDER_BANDS) -> DataFrame:
    """Provider footprints by county, coalesced per provider within a tile.

    `ord` keeps the order of providers, on which the styling depends.

    The footprints, written once, meet by provider, and their tiles are made and
    counted there: no tile goes through a shuffle. A provider has at most a footprint a
    county; tasks are as many as the tiles ask.
    """
    level = F.when(is_large, F.lit("prov_lg")).otherwise(F.lit("prov_other"))
    boxes = cut(footprints.withColumn("level", level), "footprints")
    rows = cover_size(zoom_plan_features(boxes, bands))
    shown = zoom_plan_features(in_tasks(boxes, rows, COVER_ROWS, "hoconum"), bands)
    cover = tile_cover(shown).withColumn("layer", F.col("level"))
    return coalesce_tiles(cover, ["hoconum"], "hoconum")


def placed_features(features: DataFrame, touched: DataFrame, budget: int, bands=SPEED_BANDS) -> DataFrame:
    """Features on the tiles of their bands; thinned bands fold small ones into kept ones.

    `features` have (level, feature_id, box, size, cost), `touched` the tiles (level,
    feature_id, z, x, y) that their shapes touch. Gives the treatment of
    the band with each row. This is the same for every tier, so it is made once
    and written; statistics come on last.
    """
    none = F.lit(0).cast("bigint")
    shown = on_tiles(zoom_plan_features(features, bands), touched, ["level", "feature_id"]).withColumn("layer", F.lit("speed"))
    parts = []
    for thin in sorted({b.thin for b in bands}):
        rows = shown.filter(F.col("thin") == thin)
        if thin:
            rows = fold_smallest(cut(rows, "to-thin"), budget, "feature_id")
        else:
            rows = rows.withColumns({c: none for c in FOLDED})
        parts.append(rows)
    return cut(tile_union(*parts), "placed")


def stat_key(kind: str | Column, feature_id: str | Column) -> Column:
    """Kind and feature as one key of statistics."""
    return F.concat(kind, F.lit(" "), feature_id)


def speed_layers(
    features: DataFrame,
    touched: DataFrame,
    stats: DataFrame | Callable[[int], DataFrame],
    attrs: list[str],
    tiers: list[str],
    budget: int,
    bands=SPEED_BANDS,
) -> DataFrame:
    """Tile tables of all tiers over all their zoom bands, one layer per tier.

    `stats` have (tier, kind, feature_id) and the attributes; a feature's kind is
    `stat_kind`. A feature without statistics stays, with nulls. Coalescing bands
    merge what is left by attribute, the others list every feature. Where a band
    drops the id attribute, `feature_id` is null; `ord` keeps the order. What
    folded into a row is on it: `folded_n`, `folded_size`, `folded_cost`; a
    tile's `n_features` and `folded_n` together are all features it covers.

    The wide statistics are made and shuffled once, into a table by feature. They are read
    past the features' narrow rows, which come to them once for all tiers. Statistics that
    are still to be made may be a function of the number of tasks, which gives them with
    `stat` (`stat_key`) for kind and feature_id, dealt out by it to so many: they are stored
    where they are made and pass no shuffle.
    """
    placed = placed_features(features, touched, budget, bands).drop("layer")
    placed = placed.withColumn("stat", stat_key("stat_kind", "feature_id"))
    tasks = tasks_for(max(features.count() * len(tiers), placed.count()), STAT_ROWS)

    def values(df, stat):
        return df.filter(F.col("tier").isin(*tiers)).select(stat, F.col("tier").alias("layer"), *[f"`{n}`" for n in attrs])

    if callable(stats):
        stored = by_key_in_place(values(stats(tasks), F.col("stat")), "stat", tasks, "stats-by-key")
    else:
        stored = by_key(values(stats, stat_key("kind", "feature_id").alias("stat")), "stat", tasks, "stats-by-key")
    # Features without statistics, or with those of some tiers only.
    had = stored.groupBy("stat").agg(F.collect_set("layer").alias("had"))
    lacks = F.array_except(F.array(*[F.lit(t) for t in tiers]), F.coalesce("had", F.array().cast("array<string>")))
    lacking = placed.join(had, "stat", "left").withColumn("layer", F.explode(lacks)).drop("had")
    # The narrow rows are the hash map's: the wide ones pass it unsorted.
    rows = tile_union(placed.hint("shuffle_hash").join(stored, "stat"), cut(lacking, "without-statistics")).drop("stat")
    columns = [*TILE, "level", "ord", "feature_id", *[f"`{n}`" for n in attrs], "minx", "miny", "maxx", "maxy"]
    merged = coalesce_tiles(rows.filter("coalesce"), ["level", *attrs], "feature_id")
    merged = merged.withColumn("feature_id", F.lit(None).cast("string"))
    listed = (
        rows.filter("not coalesce")
        .withColumn("ord", F.col("feature_id"))
        .withColumn("feature_id", F.when(F.col("drop_attr").isNull(), F.col("feature_id")))
        .withColumn("n_features", F.lit(1).cast("bigint"))
    )
    return tile_union(*[df.select(*columns, "n_features", *FOLDED) for df in (merged, listed)])
