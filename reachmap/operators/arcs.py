"""Borders as arcs: each stretch between two neighbours once, simplified once.

Edges of all features meet in one table with the features to the left and right.
A vertex where other than two of these edges meet is a junction; between junctions
edges form chains that have the same two neighbours all along. A chain is simplified
once and used by both sides, so neighbours keep a common border, whatever the
tolerance. Chains are ordered by pointer doubling, with joins alone, and thinned in
batches of many chains.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import in_tasks
from ..session import cut
from .dissolve import EDGE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Longer arcs are simplified in stretches of this many edges, whose ends stay.
STRETCH = 8192
# Edges that a task simplifies.
TASK_EDGES = 100_000


def border_edges(edges: DataFrame, key: str) -> DataFrame:
    """(edge, one, other, x1, y1, x2, y2): every border edge once, with `one` to its left.

    From directed edges (key, x1 ...) with the inside to the left. `one` is the
    smaller key, `other` null where no feature lies on the other side. Edges with
    one feature on both sides are none. Features must not overlap.
    """
    up = "x1 < x2 or (x1 = x2 and y1 < y2)"
    ends = [f"if({up}, {a}, {b}) as {n}" for a, b, n in (("x1", "x2", "lx"), ("y1", "y2", "ly"), ("x2", "x1", "hx"), ("y2", "y1", "hy"))]
    sides = edges.selectExpr(f"if({up}, `{key}`, null) as left", f"if({up}, null, `{key}`) as right", *ends)
    met = sides.groupBy("lx", "ly", "hx", "hy").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    met = met.filter("not left <=> right")
    keep = "right is null or left < right"
    turned = [f"if({keep}, {a}, {b}) as {n}" for a, b, n in (("lx", "hx", "x1"), ("ly", "hy", "y1"), ("hx", "lx", "x2"), ("hy", "ly", "y2"))]
    rows = met.selectExpr(f"if({keep}, left, right) as one", f"if({keep}, right, left) as other", *turned)
    return cut(rows.withColumn("edge", F.monotonically_increasing_id()), "border-edges")


def arcs(borders: DataFrame) -> DataFrame:
    """The edges of `border_edges` with their arc and place on it: (arc, seq).

    An arc begins at a junction and is named by its first edge; one without a junction, a
    closed ring, begins at its leftmost point, of several the lowest. The ring turns
    there, so its beginning is never on a straight stretch. Each round of doubling
    ends in a written table.
    """
    ends = borders.select(
        F.inline(
            F.array(
                F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(None).cast("bigint").alias("come"), F.col("edge").alias("go")),
                F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"), F.col("edge").alias("come"), F.lit(None).cast("bigint").alias("go")),
            )
        )
    )
    meets = ends.groupBy("x", "y").agg(F.count("*").alias("n"), F.max("come").alias("prv"), F.max("go").alias("edge"))
    links = meets.filter("n = 2 and prv is not null and edge is not null").select("edge", "prv")
    zero = F.lit(0).cast("bigint")
    state = borders.select("edge", F.struct("x1", "y1", "edge").alias("low")).join(links, "edge", "left")
    # prv: the edge 2^i before, null past the beginning; head: the farthest edge known, dist edges before;
    # low: of those the edge that begins leftmost, then lowest, off edges before.
    state = state.select("edge", "prv", F.col("edge").alias("head"), zero.alias("dist"), "low", zero.alias("off"))
    state, step = cut(state, "arcs"), 1
    while True:
        back = state.select(*[F.col(a).alias(b) for a, b in (("edge", "prv"), ("prv", "prv2"), ("head", "head2"), ("dist", "dist2"), ("low", "low2"), ("off", "off2"))])
        more = F.col("prv").isNotNull()
        smaller = F.coalesce(F.col("low2") < F.col("low"), F.lit(False))
        state = cut(
            state.join(back, "prv", "left").select(
                "edge",
                F.col("prv2").alias("prv"),
                F.when(more, F.col("head2")).otherwise(F.col("head")).alias("head"),
                F.when(more, F.col("dist2") + step).otherwise(F.col("dist")).alias("dist"),
                F.when(smaller, F.col("low2")).otherwise(F.col("low")).alias("low"),
                F.when(smaller, F.col("off2") + step).otherwise(F.col("off")).alias("off"),
                (smaller | (more & F.col("prv2").isNull())).alias("moved"),
            ),
            "arcs",
        )
        if state.filter("moved").isEmpty():
            break
        state, step = state.drop("moved"), step * 2
    closed = F.col("prv").isNotNull()
    found = state.select(
        "edge", F.when(closed, F.col("low.edge")).otherwise(F.col("head")).alias("arc"), F.when(closed, F.col("off")).otherwise(F.col("dist")).alias("seq")
    )
    return borders.join(found, "edge")


def thin_line(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Numbers of the points of a line that stay: none of the others is farther than `tolerance` from the rest.

    Ramer, Douglas and Peucker's method; a closed line is halved at its farthest point first.
    """
    keep = np.zeros(len(points), dtype=bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p = points[a + 1 : b].astype(float) - points[a]
        d = points[b].astype(float) - points[a]
        length = np.hypot(*d)
        if length:
            # distance to the segment, not to its line
            t = np.clip((p @ d) / length**2, 0, 1)
            away = np.hypot(*(p - t[:, None] * d).T)
        else:
            away = np.hypot(*p.T)
        far = int(away.argmax())
        if away[far] > tolerance or not length:
            keep[a + 1 + far] = True
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return np.flatnonzero(keep)


def thin_table(table: pa.Table, tolerance: float) -> pa.Table:
    """Edges in order of (arc, part, seq), every part simplified."""
    name = {c: table.column(c).to_numpy() for c in ("arc", "part", *EDGE)}
    new = (name["arc"][1:] != name["arc"][:-1]) | (name["part"][1:] != name["part"][:-1])
    bounds = [0, *(np.flatnonzero(new) + 1), len(table)]
    begins, ends = np.column_stack([name["x1"], name["y1"]]), np.column_stack([name["x2"], name["y2"]])
    first, last = [], []
    for a, b in zip(bounds, bounds[1:]):
        kept = thin_line(np.vstack([begins[a : a + 1], ends[a:b]]), tolerance)
        first.append(a + kept[:-1])
        last.append(a + kept[1:] - 1)
    last = table.take(np.concatenate(last))
    out = table.take(np.concatenate(first))
    for c in ("x2", "y2"):
        out = out.set_column(out.column_names.index(c), c, last.column(c))
    return out


def simplify_arcs(edges: DataFrame, key: str, tolerance: float, stretch: int = STRETCH) -> DataFrame:
    """(one, other, arc, seq, x1, y1, x2, y2): the features' borders simplified by a tolerance, each once.

    Junctions stay, and every `stretch`-th point of a longer arc, so no task holds
    more than a stretch at once. Arcs that shrink to nothing on a closed line keep two edges.
    """
    borders = border_edges(edges, key)
    chain = arcs(borders).withColumn("part", F.floor(F.col("seq") / stretch))
    chain = chain.select("one", "other", "arc", "part", "seq", *EDGE)
    sorted_ = in_tasks(chain, borders.count(), TASK_EDGES, "arc", "part").sortWithinPartitions("arc", "part", "seq")

    def thin(batches):
        held = None  # the batch's last part, which may go on in the next
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held else table
            arc, part = table.column("arc").to_numpy(), table.column("part").to_numpy()
            done = int(np.argmax((arc == arc[-1]) & (part == part[-1])))
            held = table.slice(done)
            if done:
                yield from thin_table(table.slice(0, done), tolerance).combine_chunks().to_batches()
        if held:
            yield from thin_table(held, tolerance).combine_chunks().to_batches()

    return sorted_.mapInArrow(thin, chain.schema).drop("part")


def sides_of(borders: DataFrame, key: str) -> DataFrame:
    """Directed edges (key, x1, y1, x2, y2) of the features on both sides of borders."""
    one = F.struct(F.col("one").alias(key), *EDGE)
    other = F.struct(F.col("other").alias(key), F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    return borders.select(F.inline(F.array(one, other))).filter(F.col(key).isNotNull())
