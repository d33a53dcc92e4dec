"""Hard-negative mining (operator 13): best-first search in STR-packed R-trees.

Rows are dealt to blocks of bounded size by the hash of their id, so no label, copy
or cluster makes a block large; anchors are dealt to chunks, and a task gets one
block with one chunk. It packs the block's rows into an R-tree by sort-tile-recursive
steps: the label is the first coordinate, then those of the largest spread. A box
gives each component's interval; with an anchor's component it gives an interval
of their product, and the sums of these bound the inner products in the box from
both sides. Boxes wait in a queue by falling upper bound. A box goes when its labels
cannot serve, when its interval lies outside of every score window, or when its
upper bound is strictly below the worst score kept (an equal one stays, for ties go
by id). What tasks keep is at most k rows a block, anchor and window, and the k best
of these are the result, so it is exact whatever the boxes are worth.

Defined results: rows without an id, label or whole vector take no part (see
`vectors.whole_vectors`), nor do vectors of another length than most rows'. Of
rows that repeat an id, the one with the smallest label, then vector, counts.
Products beyond a long's range are compared exactly and written as its ends. An
empty table, one label only or no anchors give no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut
from .common import table
from .vectors import EXACT, LONG, exact, matrix, scaled, top_size, whole_vectors

LEAF = 256
FANOUT = 8
# Rows of a block and anchors of a chunk: at least and at most so many.
BLOCK = (4096, 65_536)
CHUNK = (256, 16_384)
POSITIVES = 5
NEGATIVES = 3
FACTOR = 256
# A negative's score is from LOW to HIGH hundredths of its positive's.
LOW, HIGH = 50, 95


def str_order(labels: np.ndarray, m: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Leaves of row numbers by sort-tile-recursive packing; a leaf has one label."""
    if not len(m):
        return []
    spread = np.argsort(-m.astype(np.float64).var(axis=0), kind="stable")
    order = np.argsort(labels, kind="stable")
    ends = np.flatnonzero(np.diff(labels[order])) + 1
    todo = [(part, 0) for part in np.split(order, ends)][::-1]
    leaves = []
    while todo:
        rows, depth = todo.pop()
        if len(rows) <= leaf or depth >= m.shape[1]:
            leaves += [rows[a : a + leaf] for a in range(0, len(rows), leaf)]
            continue
        count = -(-len(rows) // leaf)
        # With j coordinates left, count ** (1 / j) slabs; two at least.
        slabs = max(2, round(count ** (1 / max(1, m.shape[1] - depth))))
        rows = rows[np.argsort(m[rows, spread[depth]], kind="stable")]
        size = -(-count // slabs) * leaf
        todo += [(rows[a : a + size], depth + 1) for a in range(0, len(rows), size)][::-1]
    return leaves


class Tree:
    """Boxes of all nodes, leaves first, then level by level up to the root."""

    def __init__(self, ids, labels, m, leaf=LEAF, fanout=FANOUT):
        leaves = str_order(labels, m, leaf)
        order = np.concatenate(leaves) if leaves else np.zeros(0, int)
        self.ids, self.labels, self.rows = ids[order], labels[order], m[order]
        ends = np.cumsum([len(x) for x in leaves]).astype(int)
        spans = list(zip(np.r_[0, ends[:-1]], ends)) if leaves else []
        low = [self.rows[a:b].min(axis=0) for a, b in spans]
        high = [self.rows[a:b].max(axis=0) for a, b in spans]
        kinds = [(self.labels[a], self.labels[b - 1]) for a, b in spans]
        self.children = [None] * len(spans)
        level = list(range(len(spans)))
        while len(level) > 1:
            above = []
            for a in range(0, len(level), fanout):
                part = level[a : a + fanout]
                above.append(len(low))
                self.children.append(np.arange(part[0], part[-1] + 1))
                low.append(np.min([low[i] for i in part], axis=0))
                high.append(np.max([high[i] for i in part], axis=0))
                kinds.append((kinds[part[0]][0], kinds[part[-1]][1]))
            level = above
        self.spans, self.root = spans, level[0] if level else None
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.last = (np.array([k[j] for k in kinds]) for j in (0, 1))

    def prepared(self, largest):
        """Boxes and rows as numbers in which products with entries up to `largest` are exact."""
        most = largest * top_size(self.rows) * max(1, self.rows.shape[1])
        return exact(self.low, most), exact(self.high, most), exact(self.rows, most)


class Best:
    """The k best of one window: highest score first, then smallest id."""

    def __init__(self, k, low=None, high=None):
        self.k, self.low, self.high, self.kept = k, low, high, []

    def needs(self):
        """The least score that may still enter; None for any."""
        if len(self.kept) < self.k:
            return self.low
        return max(self.kept[-1][0], self.low) if self.low is not None else self.kept[-1][0]

    def wants(self, lower, upper):
        least = self.needs()
        return (least is None or upper >= least) and (self.high is None or lower <= self.high)

    def add(self, scores, ids):
        least = self.needs()
        good = np.ones(len(scores), dtype=bool) if least is None else scores >= least
        if self.high is not None:
            good &= scores <= self.high
        at = np.flatnonzero(good)
        if len(at):
            at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
            new = [(int(s), int(i)) for s, i in zip(scores[at], ids[at])]
            self.kept = sorted(self.kept + new, key=lambda p: (-p[0], p[1]))[: self.k]


def search(tree: Tree, boxes, q, label, same: bool, windows: list[Best], own=None):
    """Fill `windows` with the tree's rows of the same label, or of others, without the row `own`."""
    low, high, rows = boxes
    up, down = np.maximum(q, 0), np.minimum(q, 0)

    def bounds(nodes):
        lower = low[nodes] @ up + high[nodes] @ down
        upper = high[nodes] @ up + low[nodes] @ down
        if same:
            fit = (tree.first[nodes] <= label) & (label <= tree.last[nodes])
        else:
            fit = (tree.first[nodes] != label) | (tree.last[nodes] != label)
        return [(-u, int(n), lo) for n, u, lo, f in zip(nodes, upper, lower, fit) if f]

    queue = bounds(np.array([tree.root])) if tree.root is not None else []
    while queue:
        upper, node, lower = heapq.heappop(queue)
        if not any(w.wants(lower, -upper) for w in windows):
            if all((least := w.needs()) is not None and -upper < least for w in windows):
                break  # every other box is as low
            continue
        if tree.children[node] is not None:
            for child in bounds(tree.children[node]):
                if any(w.wants(child[2], -child[0]) for w in windows):
                    heapq.heappush(queue, child)
            continue
        a, b = tree.spans[node]
        scores, ids = rows[a:b] @ q, tree.ids[a:b]
        if own is not None and same:
            scores, ids = scores[ids != own], ids[ids != own]
        for w in windows:
            if w.wants(lower, -upper):
                w.add(scores, ids)
    return windows


def _block_tree(rows: pa.Table, d: int) -> Tree:
    """The R-tree of a block's Arrow rows."""
    labels = rows.column("label").to_numpy()
    return Tree(rows.column("vec_id").to_numpy(), labels, matrix(rows.column("x")).reshape(len(labels), d))


def _clipped(values):
    return pa.array([min(max(v, -LONG - 1), LONG) for v in values], pa.int64())


def _best_positives(count):
    def of_group(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = ([], [], [])
        if rows.num_rows and anchors.num_rows:
            q = matrix(anchors.column("q"))
            tree = _block_tree(rows, q.shape[1])
            boxes = tree.prepared(top_size(q))
            q = q.astype(boxes[2].dtype)
            for i, (a, label) in enumerate(zip(anchors.column("anchor_id").to_pylist(), anchors.column("anchor_label").to_pylist())):
                for score, j in search(tree, boxes, q[i], label, True, [Best(count)], own=a)[0].kept:
                    out[0].append(a), out[1].append(j), out[2].append(score)
        return pa.table({"anchor_id": pa.array(out[0], pa.int64()), "positive_id": pa.array(out[1], pa.int64()), "positive_score": _clipped(out[2])})

    return of_group


def _best_negatives(count, low, high):
    def of_group(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = tuple([] for _ in range(5))
        if rows.num_rows and anchors.num_rows:
            q = matrix(anchors.column("q"))
            tree = _block_tree(rows, q.shape[1])
            boxes = tree.prepared(top_size(q))
            q = q.astype(boxes[2].dtype)
            columns = [anchors.column(c).to_pylist() for c in ("anchor_id", "anchor_label", "positives")]
            for i, (a, label, positives) in enumerate(zip(*columns)):
                # low * p <= 100 * score <= high * p in whole numbers
                windows = [Best(count, -(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
                for p, w in zip(positives, search(tree, boxes, q[i], label, False, windows)):
                    for score, j in w.kept:
                        for column, value in zip(out, (a, p["id"], j, p["score"], score)):
                            column.append(value)
        names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        return pa.table({n: _clipped(v) for n, v in zip(names, out)})

    return of_group


def _ranked(df: DataFrame, keys, score, tie, most) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie)))
    return df.withColumn("rank", rank).filter(F.col("rank") <= most)


def _within(count, bounds, parallel):
    """How many parts to make of `count` rows: enough for the cluster, none outside the bounds."""
    least, most = bounds
    return max(1, -(-count // min(most, max(least, -(-count // parallel)))))


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives for the anchors among rows (vec_id long, label int, x array<long>).

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = rows.sparkSession
    rows = rows.filter("vec_id is not null and label is not null and x is not null")
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"))
    rows = cut(rows.select("vec_id", "row.label", "row.x", is_anchor.alias("is_anchor")), "negatives-rows")
    size = rows.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors")).first()
    parallel = max(2, spark.sparkContext.defaultParallelism)
    blocks = _within(size["n"], BLOCK, parallel)
    chunks = _within(size["anchors"], CHUNK, -(-2 * parallel // blocks))

    def numbers(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n, seed):
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")

    data = rows.select("vec_id", "label", "x", dealt(blocks, 1).alias("block"), numbers(chunks).alias("chunk"))
    anchors = rows.filter("is_anchor").select(
        F.col("vec_id").alias("anchor_id"),
        F.col("label").alias("anchor_label"),
        F.col("x").alias("q"),
        dealt(chunks, 2).alias("chunk"),
    )

    def over_blocks(queries, function, schema):
        queries = queries.withColumn("block", numbers(blocks))
        return data.groupBy("block", "chunk").cogroup(queries.groupBy("block", "chunk")).applyInArrow(
            lambda left, right: function(left, right), schema
        )

    found = over_blocks(anchors, _best_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = _ranked(found, ["anchor_id"], "positive_score", "positive_id", positives)
    best = cut(
        best.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")),
        "negatives-positives",
    )
    queries = anchors.join(best, "anchor_id")
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    found = over_blocks(queries, _best_negatives(negatives, low, high), ", ".join(f"{c} long" for c in names))
    out = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir):
    rows = whole_vectors(table(spark, sf_dir, "embeddings").filter("vec_id is not null and label is not null"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), scaled(F.col("embedding"), FACTOR).alias("x"))
    return mine(rows, F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           list_inner_product(a.x, r.x)::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
