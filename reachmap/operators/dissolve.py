"""Union of polygons which share vertices, by cancelling inner edges.

Polygons are cut into directed edges on an integer grid. An edge whose reverse
belongs to the same key is inner and cancels in a sum; what is left is the
outline. That is a plain aggregation, so it combines on the map side and has
no large groups. Only turning an outline into rings needs an order:
`ring_points` does it for outlines of any size with joins alone, `dissolve`
packs the usual small outlines into one geometry per key.

Polygons of a key must not overlap, so pass each block once per key. Where a
vertex lies on the middle of a neighbour's edge the border does not cancel: the
area stays right, and the two sides become polygons which touch.
"""

import sys
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geom as G
from ..functions.joins import spread_join
from ..session import cut
from ..sources.schemas import GEOM

# ship the ring helpers with the task, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# grid units per coordinate unit: seven decimals of a degree
GRID = 10_000_000
EDGE = ["x1", "y1", "x2", "y2"]
# outlines up to this many edges are packed in one task (about 50 MB)
PACK_EDGES = 500_000


def feature_edges(features: DataFrame, *keys: str, grid: int = GRID, geom: str = "geom"):
    """Directed edges of all rings, shells counter-clockwise and holes clockwise."""
    names = [f"`{k}`" for k in keys]
    snap = (
        f"transform(ring, p -> struct(cast(round(p.x * {grid}) as bigint) as x, "
        f"cast(round(p.y * {grid}) as bigint) as y))"
    )
    rings = (
        features.selectExpr(*names, f"explode(`{geom}`) as poly")
        .selectExpr(*names, "posexplode(poly) as (ring_no, ring)")
        .selectExpr(*names, "ring_no", f"{snap} as ring")
    )
    shell_turn = (F.col("ring_no") == 0) == (G.signed_area(F.col("ring")) > 0)
    sides = rings.withColumn("keep", shell_turn).select(
        *keys, "keep", F.inline(G.segments(F.col("ring")))
    )
    return sides.filter("a != b").selectExpr(
        *names,
        "if(keep, a.x, b.x) as x1",
        "if(keep, a.y, b.y) as y1",
        "if(keep, b.x, a.x) as x2",
        "if(keep, b.y, a.y) as y2",
    )


def outline_edges(edges: DataFrame, *keys: str) -> DataFrame:
    """Edges left after opposite ones cancel, with their multiplicity.

    `mult` is 1 wherever the polygons of a key do not overlap.
    """
    names = [f"`{k}`" for k in keys]
    up = "x1 < x2 or (x1 = x2 and y1 < y2)"
    net = (
        edges.selectExpr(
            *names,
            f"if({up}, x1, x2) as lx",
            f"if({up}, y1, y2) as ly",
            f"if({up}, x2, x1) as hx",
            f"if({up}, y2, y1) as hy",
            f"if({up}, 1, -1) as way",
        )
        .groupBy(*keys, "lx", "ly", "hx", "hy")
        .agg(F.sum("way").alias("net"))
        .filter("net != 0")
    )
    return net.selectExpr(
        *names,
        "if(net > 0, lx, hx) as x1",
        "if(net > 0, ly, hy) as y1",
        "if(net > 0, hx, lx) as x2",
        "if(net > 0, hy, ly) as y2",
        "abs(net) as mult",
    )


def dissolve_edges(features: DataFrame, *keys: str, grid: int = GRID) -> DataFrame:
    return outline_edges(feature_edges(features, *keys, grid=grid), *keys)


def outline_area2(outline: DataFrame, *keys: str) -> DataFrame:
    """Twice the enclosed area in grid units, exact."""
    d = {c: F.col(c).cast("decimal(18,0)") for c in EDGE}
    cross = (d["x1"] * d["y2"] - d["x2"] * d["y1"]) * F.col("mult")
    return outline.groupBy(*keys).agg(F.sum(cross).cast("decimal(38,0)").alias("area2"))


def simple_outline(outline: DataFrame) -> DataFrame:
    """The outline, failing on an edge that polygons of one key cover twice.

    Such polygons overlap; their outline has an area but no rings.
    """
    where = F.to_json(F.struct(*[c for c in outline.columns if c != "mult"]))
    overlap = F.raise_error(
        F.concat(F.lit("polygons of one key overlap; rings are undefined at "), where)
    )
    return outline.withColumn("mult", F.when(F.col("mult") == 1, F.lit(1)).otherwise(overlap))


def previous_edges(outline: DataFrame, *keys: str) -> DataFrame:
    """(keys, e, prv): for each outline edge the one before it on its ring.

    Around a vertex, the inside lies between an outgoing edge and the next edge
    counter-clockwise from it, which comes in. Pairing by that order also
    separates rings which only touch. An incoming edge sorts before an outgoing
    one of the same direction, as the inside lies before the one and after the
    other. The window spans the edges at one vertex of one outline.
    """
    # `mult` is part of the edge so that its check is not optimised away
    ids = simple_outline(outline).select(*keys, *EDGE, F.struct(*EDGE, "mult").alias("e"))
    ends = ids.select(
        *keys,
        F.inline(
            F.array(
                _end(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), "out"),
                _end(F.col("x2"), F.col("y2"), F.col("x1"), F.col("y1"), "in"),
            )
        ),
        "e",
    )
    w = Window.partitionBy(*keys, "vx", "vy").orderBy("angle", "side")
    incoming = F.when(F.col("side") == "in", F.col("e"))
    ahead = F.first(incoming, ignorenulls=True).over(
        w.rowsBetween(1, Window.unboundedFollowing)
    )
    around = F.first(incoming, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return (
        ends.withColumn("prv", F.coalesce(ahead, around))
        .filter(F.col("side") == "out")
        .select(*keys, "e", "prv")
    )


def _end(vx: Column, vy: Column, ox: Column, oy: Column, side: str) -> Column:
    return F.struct(
        vx.alias("vx"),
        vy.alias("vy"),
        F.atan2((oy - vy).cast("double"), (ox - vx).cast("double")).alias("angle"),
        F.lit(side).alias("side"),
    )


def ring_points(outline: DataFrame, *keys: str) -> DataFrame:
    """(keys, ring, seq, x, y): outline vertices in ring order, any outline size."""
    return ring_edges(outline, *keys).drop("nx", "ny")


def signed_ring_edges(outline: DataFrame, *keys: str) -> DataFrame:
    """`ring_edges` with the ring's number of points and sign, 1 for a shell and -1 for a hole."""
    edges = cut(ring_edges(outline, *keys), "ring-edges")
    d = {c: F.col(c).cast("decimal(18,0)") for c in ("x", "y", "nx", "ny")}
    rings = edges.groupBy(*keys, "ring").agg(
        F.count("*").alias("n_points"),
        F.signum(F.sum(d["x"] * d["ny"] - d["nx"] * d["y"]).cast("double")).cast("int").alias("sign"),
    )
    return spread_join(edges, rings, [*keys, "ring"])


def closed_ring_points(outline: DataFrame, *keys: str, grid: int = GRID) -> DataFrame:
    """(keys, ring, sign, seq, x, y): points in coordinate units; the last of a ring is its first again."""
    edges = signed_ring_edges(outline, *keys)
    end = edges.filter(F.col("seq") == 0).withColumn("seq", F.col("n_points"))
    return edges.unionByName(end).select(
        *keys, "ring", "sign", "seq", (F.col("x") / grid).alias("x"), (F.col("y") / grid).alias("y")
    )


def point_measures(points: DataFrame, *keys: str) -> DataFrame:
    """(keys, area, minx, miny, maxx, maxy) of closed rings that are rows of points."""
    ring = [*keys, "ring", "seq"]
    ahead = points.select(*keys, "ring", (F.col("seq") - 1).alias("seq"), F.col("x").alias("nx"), F.col("y").alias("ny"))
    sides = points.join(ahead, ring)
    return sides.groupBy(*keys).agg(
        (F.sum(F.col("x") * F.col("ny") - F.col("nx") * F.col("y")) / 2).alias("area"),
        *[f(c).alias(f"{name}{c}") for name, f in (("min", F.min), ("max", F.max)) for c in ("x", "y")],
    )


def ring_edges(outline: DataFrame, *keys: str) -> DataFrame:
    """(keys, ring, seq, x, y, nx, ny): outline vertices in ring order, each with the next one.

    Pointer doubling: after round i each edge knows the smallest edge among the
    2^i edges before it and how far back it is, so the longest ring sets the
    number of rounds by its logarithm. Each round is one self-join on a unique
    key and ends in a table in the shared folder. The smallest edge names the
    ring, and its distance is the position on it.
    """
    keys = list(keys)
    state = cut(
        previous_edges(outline, *keys).select(
            *keys, "e", "prv", F.col("e").alias("lab"), F.lit(0).cast("bigint").alias("off")
        ),
        "rings",
    )
    step = 1
    while True:
        back = state.select(
            *keys,
            F.col("e").alias("prv"),
            F.col("prv").alias("prv2"),
            F.col("lab").alias("lab2"),
            F.col("off").alias("off2"),
        )
        smaller = F.col("lab2") < F.col("lab")
        state = cut(
            state.join(back, keys + ["prv"]).select(
                *keys,
                "e",
                F.col("prv2").alias("prv"),
                F.when(smaller, F.col("lab2")).otherwise(F.col("lab")).alias("lab"),
                F.when(smaller, F.col("off2") + step).otherwise(F.col("off")).alias("off"),
                smaller.alias("moved"),
            ),
            "rings",
        )
        if state.filter("moved").isEmpty():
            break
        state = state.drop("moved")
        step *= 2
    ring = F.concat_ws(":", *[F.col(f"lab.{c}") for c in EDGE])
    return state.select(
        *keys,
        ring.alias("ring"),
        F.col("off").alias("seq"),
        F.col("e.x1").alias("x"),
        F.col("e.y1").alias("y"),
        F.col("e.x2").alias("nx"),
        F.col("e.y2").alias("ny"),
    )


class Dissolved(NamedTuple):
    """Dissolved features and the outlines too long to be one."""

    features: DataFrame  # (keys, geom)
    long_outlines: DataFrame  # (keys, x1, y1, x2, y2, mult), for `ring_points`


def dissolve(
    features: DataFrame, *keys: str, grid: int = GRID, pack_edges: int = PACK_EDGES
) -> Dissolved:
    """Dissolve by key.

    An outline of up to `pack_edges` edges becomes one geometry, its holes
    nested in their shells. A longer one would be too much for one task and one
    row: it stays a table of edges, which `ring_points` orders and
    `outline_measures` measures, and `outline_parts` has its area as geometries.
    Together the two parts are the whole result.
    """
    return pack_outlines(dissolve_edges(features, *keys, grid=grid), *keys, grid=grid, pack_edges=pack_edges)


def pack_outlines(outline: DataFrame, *keys: str, grid: int = GRID, pack_edges: int = PACK_EDGES) -> Dissolved:
    """`dissolve` from outlines (keys, x1, y1, x2, y2, mult) that are known already."""
    keys = list(keys)
    outline = cut(simple_outline(outline), "outline")
    sizes = outline.groupBy(*keys).agg(F.count("*").alias("n"))
    long_keys = sizes.filter(F.col("n") > pack_edges).select(*keys)
    schema = T.StructType([outline.schema[k] for k in keys] + [T.StructField("geom", GEOM)])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        geom = [
            [[{"x": x / grid, "y": y / grid} for x, y in ring] for ring in poly]
            for poly in nest_rings(trace_rings(pdf[EDGE].to_numpy(np.int64)))
        ]
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "geom": [geom]})

    if long_keys.isEmpty():
        return Dissolved(outline.groupBy(*keys).applyInPandas(pack, schema), outline.filter(F.lit(False)))
    # What is not long is short: a key may be null.
    short = spread_join(outline, long_keys, keys, "left_anti")
    return Dissolved(
        short.groupBy(*keys).applyInPandas(pack, schema),
        spread_join(outline, long_keys, keys, "left_semi"),
    )


def outline_parts(
    features: DataFrame, outlines: DataFrame, *keys: str, grid: int = GRID, pack_edges: int = PACK_EDGES
) -> DataFrame:
    """(keys, geom): all area inside outlines too long for a row, in several rows a key that share no area.

    `features` are what was dissolved by the keys, `outlines` are its `long_outlines`. A key's
    features meet in cells of a quadtree over the key's box, each in the cell of its first
    point: the largest cells whose features have up to `pack_edges` edges. Every cell is
    dissolved, its inner edges cancel, so its outline is no longer than that. Features with the
    same point are halved no further and stay as they are, each a row as before.
    """
    keys = list(keys)
    rows = spread_join(features.select(*keys, "geom"), outlines.select(*keys).distinct(), keys, "left_semi")
    first = F.get(G.vertices(F.col("geom")), F.lit(0))
    at = {f"_{c}": F.round(first[c] * grid).cast("bigint") for c in ("x", "y")}
    rows = cut(rows.withColumns({**at, "_n": F.size(G.vertices(F.col("geom")))}).filter("_n > 0"), "long-features")
    box = rows.groupBy(*keys).agg(
        F.min("_x").alias("_x0"),
        F.min("_y").alias("_y0"),
        # halvings after which a cell is one point
        F.length(F.bin(F.greatest(F.max("_x") - F.min("_x"), F.max("_y") - F.min("_y")))).alias("_bits"),
    )
    rows = spread_join(rows, box, keys, "inner").withColumns({"_x": F.col("_x") - F.col("_x0"), "_y": F.col("_y") - F.col("_y0")})
    rows, parts, depth = rows.drop("_x0", "_y0"), [], 0
    while depth == 0 or not rows.isEmpty():
        depth += 1
        corner = [F.expr(f"shiftright({c}, _bits - {depth})") for c in ("_x", "_y")]
        alone = F.col("_bits") < depth
        cell = F.when(alone, F.concat(F.lit("alone "), F.xxhash64("geom"))).otherwise(F.concat_ws(" ", F.lit(depth), *corner))
        rows = rows.withColumn("_cell", cell)
        edges = rows.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_all"))
        rows = cut(spread_join(rows, edges, [*keys, "_cell"], "inner"), "long-cells")
        fits = alone | (F.col("_all") <= pack_edges)
        parts.append(rows.filter(fits).select(*keys, "_cell", "geom"))
        rows = rows.filter(~fits).drop("_cell", "_all")
    cells = reduce(DataFrame.unionByName, parts)
    outline = dissolve_edges(cells, *keys, "_cell", grid=grid)
    return pack_outlines(outline, *keys, "_cell", grid=grid, pack_edges=sys.maxsize).features.drop("_cell")


def outline_measures(outline: DataFrame, *keys: str, grid: int = GRID) -> DataFrame:
    """(keys, area, minx, miny, maxx, maxy) of outlines of any size, by sums alone."""
    box = outline.groupBy(*keys).agg(
        *[
            (f("x1" if axis == "x" else "y1") / grid).alias(f"{name}{axis}")
            for name, f in (("min", F.min), ("max", F.max))
            for axis in ("x", "y")
        ]
    )
    area = F.col("area2").cast("double") / (2.0 * grid * grid)
    return (
        outline_area2(outline, *keys)
        .withColumn("area", area)
        .drop("area2")
        .join(box, list(keys))
    )


def trace_rings(edges: np.ndarray) -> list[np.ndarray]:
    """Closed rings (n, 2) from directed outline edges (x1, y1, x2, y2)."""
    e = edges[np.lexsort(edges.T[::-1])]
    n = len(e)
    d = (e[:, 2:] - e[:, :2]).astype(float)
    # one row per edge end: vertex, angle, side (0 = in, 1 = out)
    vert = np.vstack([e[:, :2], e[:, 2:]])
    ang = np.concatenate([np.arctan2(d[:, 1], d[:, 0]), np.arctan2(-d[:, 1], -d[:, 0])])
    side = np.repeat([1, 0], n)
    order = np.lexsort((side, ang, vert[:, 1], vert[:, 0]))
    v, s, idx = vert[order], side[order], order % n
    prv = np.full(n, -1)
    starts = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]).any(axis=1)])
    for lo, hi in zip(starts, np.r_[starts[1:], 2 * n]):
        seen = [i for i in range(lo, hi) if s[i] == 0]
        nxt = seen[0]
        for i in range(hi - 1, lo - 1, -1):
            if s[i] == 0:
                nxt = i
            else:
                prv[idx[i]] = idx[nxt]
    succ = np.empty(n, dtype=np.int64)
    succ[prv] = np.arange(n)
    rings, done = [], np.zeros(n, dtype=bool)
    for first in range(n):
        if done[first]:
            continue
        ring, at = [], first
        while not done[at]:
            done[at] = True
            ring.append(e[at, :2])
            at = succ[at]
        ring.append(ring[0])
        rings.append(np.array(ring))
    return rings


def ring_area2(ring: np.ndarray) -> int:
    p = ring - ring[0]
    # beyond this a sum of products may not fit 64 bits
    if int(np.abs(p).max()) ** 2 * len(p) * 2 >= 1 << 62:
        p = p.astype(object)
    return int((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum())


def ring_parents(rings: list[np.ndarray], area2: list[int]) -> list[int]:
    """For each ring the ring directly around it, -1 if there is none.

    From a point just outside of a ring, the nearest edge to the left belongs to
    the ring around it or to one beside it, whose own ring around is the same.
    Edges are listed by slabs of y, so a point looks at few of them.
    """
    n = len(rings)
    # The first edge from the leftmost vertex on: what is left of it begins further left.
    at = [0 if r[0, 0] <= r[:, 0].min() else int(r[:-1, 0].argmin()) for r in rings]
    (x0, y0), (x1, y1) = (np.array([r[k + j] for r, k in zip(rings, at)], dtype=float).T for j in (0, 1))
    length = np.hypot(x1 - x0, y1 - y0)
    # inside lies to the left of every edge; outside of a shell to its right, of a hole to its left
    side = np.where(np.array(area2) > 0, 1e-3, -1e-3)
    px = x0 + ((x1 - x0) * 0.25 + (y1 - y0) * side) / length
    py = y0 + ((y1 - y0) * 0.25 - (x1 - x0) * side) / length
    a = np.concatenate([r[:-1] for r in rings]).astype(float)
    b = np.concatenate([r[1:] for r in rings]).astype(float)
    of = np.repeat(np.arange(n), [len(r) - 1 for r in rings])
    slanted = a[:, 1] != b[:, 1]
    a, b, of = a[slanted], b[slanted], of[slanted]
    low, high = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
    borders = np.unique(np.quantile(low, np.linspace(0, 1, max(2, len(low) // 32))))
    s0 = np.maximum(np.searchsorted(borders, low, "right") - 1, 0)
    s1 = np.maximum(np.searchsorted(borders, high, "right") - 1, 0)
    count = s1 - s0 + 1
    edge = np.repeat(np.arange(len(of)), count)
    slab = np.repeat(s0, count) + np.arange(len(edge)) - np.repeat(np.cumsum(count) - count, count)
    order = np.argsort(slab, kind="stable")
    edge = edge[order]
    begin = np.searchsorted(slab[order], np.arange(len(borders) + 1))
    mine = np.clip(np.searchsorted(borders, py, "right") - 1, 0, len(borders) - 1)
    near, within = np.full(n, -1), np.zeros(n, bool)
    points = np.argsort(mine, kind="stable")
    for own in np.split(points, np.flatnonzero(np.diff(mine[points])) + 1):
        e = edge[begin[mine[own[0]]] : begin[mine[own[0]] + 1]]
        some = max(1, 1_000_000 // max(1, len(e)))
        for k in range(0, len(own) if len(e) else 0, some):
            i = own[k : k + some]
            y = py[i][:, None]
            x = a[e, 0] + (y - a[e, 1]) * (b[e, 0] - a[e, 0]) / (b[e, 1] - a[e, 1])
            x[(y < low[e]) | (y >= high[e]) | (x >= px[i][:, None])] = -np.inf
            best = x.argmax(1)
            hit = x[np.arange(len(i)), best] > -np.inf
            near[i[hit]] = of[e[best[hit]]]
            # a downward edge has the inside to its right
            within[i[hit]] = b[e[best[hit]], 1] < a[e[best[hit]], 1]
    shell = np.array(area2) > 0
    parent = np.full(n, -2)  # not known yet
    for i in np.argsort(px):
        chain, r = [], i
        while r >= 0 and parent[r] == -2:  # beside it: what is around the one is around the other
            parent[r] = -1  # also ends a chain that comes back to itself
            chain.append(r)
            up, inner = near[r], within[r]
            if up < 0 or shell[up] == inner:
                parent[r] = up
                break
            r = up
        parent[chain] = parent[chain[-1]] if r in chain[-1:] else parent[r]
    return parent.tolist()


def nest_rings(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons of a shell and its holes: a hole goes to the shell around it."""
    if not rings:
        return []
    area2 = [ring_area2(r) for r in rings]
    polygons = {i: [r] for i, r in enumerate(rings) if area2[i] > 0}
    if len(polygons) < len(rings):
        for i, up in enumerate(ring_parents(rings, area2)):
            if area2[i] > 0:
                continue
            if up in polygons:
                polygons[up].append(rings[i])
            else:
                polygons[i] = [rings[i]]
    return list(polygons.values())
