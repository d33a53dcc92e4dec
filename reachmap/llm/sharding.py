"""Sharding (operator 9): minimax contiguous partition, with DataFrame functions only.

Equal texts form an atomic group. Groups are ordered by a digest of the text.
The smallest capacity for which the ordered groups fit the shards is searched on
a histogram of the order: a check takes intervals of digests either as
indivisible (its answer is then certain to fit) or as divisible anywhere (then
nothing smaller can fit). Where both differ, the intervals at the cuts are
counted more finely in Spark, until both agree; the driver sees a bounded
number of interval sums, never the groups.

Defined results: a null text counts as empty, with size 1. Ids may be null or
repeated; every row gets a slot of its own. An empty table gives no rows. Fewer
groups than shards leave shards empty.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut
from .common import table, text_of

SHARDS = 16
# Digests have this many bits; the first histogram uses the upper BIN_BITS of them.
KEY_BITS = 60
BIN_BITS = 12
# One more count divides each interval at a cut into this many.
FINER = 256
# Slots are numbered in blocks of about this many rows.
ROWS_PER_BLOCK = 200_000


class Interval:
    """Digests from first to last that occur, their bytes, and the bounds counted."""

    def __init__(self, low, high, first, last, size, rows):
        self.low, self.high, self.first, self.last = low, high, first, last
        self.size, self.rows = size, rows

    @property
    def atomic(self):
        return self.first == self.last


def fits(items, capacity, shards, divisible):
    """(whether the items fit, positions where a shard is full)."""
    used, load, cuts = 1, 0, []
    for i, x in enumerate(items):
        if load + x.size <= capacity:
            load += x.size
            continue
        cuts.append(i)
        if divisible and not x.atomic:
            over = x.size - (capacity - load)
            more = -(-over // capacity)
            used += more
            load = over - (more - 1) * capacity
        else:
            if x.size > capacity:
                return False, cuts
            used += 1
            load = x.size
        if used > shards:
            return False, cuts
    return True, cuts


def smallest_capacity(items, shards, divisible):
    total = sum(x.size for x in items)
    low, high = max(1, -(-total // shards)), max(1, total)
    while low < high:
        middle = (low + high) // 2
        if fits(items, middle, shards, divisible)[0]:
            high = middle
        else:
            low = middle + 1
    return low


def cut_places(items, capacity, shards):
    """First items of the shards after the first: near-equal loads within the capacity.

    Every shard may end only where the rest still fits the shards that are left.
    """
    n = len(items)
    need = [0] * (n + 1)
    end, load = n, 0
    for start in range(n - 1, -1, -1):  # greedy from the right: fewest shards from `start` on
        load += items[start].size
        while load > capacity:
            end -= 1
            load -= items[end].size
        need[start] = need[end] + 1
    places, start, left = [], 0, sum(x.size for x in items)
    for k in range(shards, 1, -1):
        goal, load, best, stop = left / k, 0, None, start
        while stop < n and load + items[stop].size <= capacity:
            load += items[stop].size
            stop += 1
            if need[stop] <= k - 1 and (best is None or abs(load - goal) < abs(best[1] - goal)):
                best = (stop, load)
        if best is None:
            break
        places.append(best[0])
        start, left = best[0], left - best[1]
    return [i for i in places if i < n]


def _count(rows, where, width, number):
    """Interval sums of the rows in given ranges, each divided evenly."""
    got = (
        rows.filter(where)
        .groupBy(number.alias("part"))
        .agg(
            F.min("key").alias("first"),
            F.max("key").alias("last"),
            F.sum("size").alias("size"),
            F.count("*").alias("n"),
        )
    )
    return {r["part"]: r for r in got.toLocalIterator()}


def _intervals(got, low, width, base=0, parts=None):
    out = []
    for part in sorted(p for p in got if base <= p < base + parts):
        r, at = got[part], low + (part - base) * width
        out.append(Interval(at, at + width, r["first"], r["last"], r["size"], r["n"]))
    return out


def minimax(rows: DataFrame, shards: int = SHARDS):
    """(smallest capacity, first digests of the shards after the first, rows per first bin)."""
    width = 1 << (KEY_BITS - BIN_BITS)
    number = F.shiftright("key", KEY_BITS - BIN_BITS).cast("int")
    got = _count(rows, F.lit(True), width, number)
    bins = {p: r["n"] for p, r in got.items()}
    items = _intervals(got, 0, width, 0, 1 << BIN_BITS)
    while True:
        best, certain = (smallest_capacity(items, shards, d) for d in (True, False))
        if best == certain:
            break
        at = {
            i
            for c in (best, certain)
            for d in (True, False)
            for i in fits(items, c, shards, d)[1]
            if not items[i].atomic
        }
        # The digests in an interval are known to lie between its first and last.
        spans = []
        for i in sorted(at):
            low, high = items[i].first, items[i].last + 1
            spans.append((i, low, max(1, -(-(high - low) // FINER))))
        where, number = F.lit(False), None
        for j, (i, low, step) in enumerate(spans):
            inside = F.col("key").between(low, items[i].last)
            part = F.lit(j * FINER) + F.expr(f"(key - {low}L) div {step}L")
            where = where | inside
            number = F.when(inside, part) if number is None else number.when(inside, part)
        got = _count(rows, where, None, number.cast("int"))
        fresh = {i: _intervals(got, low, step, j * FINER, FINER) for j, (i, low, step) in enumerate(spans)}
        items = [y for i, x in enumerate(items) for y in fresh.get(i, [x])]
    return certain, [items[i].first for i in cut_places(items, certain, shards)], bins


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = text_of(docs)
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
        ),
        "shard-rows",
    )
    _, starts, bins = minimax(rows, shards)
    shard = F.lit(0)
    for s in starts:
        shard = shard + (F.col("key") >= s).cast("int")
    salts = [1 + bins.get(i, 0) // ROWS_PER_BLOCK for i in range(1 << BIN_BITS)]
    part = F.shiftright("key", KEY_BITS - BIN_BITS).cast("int")
    rows = rows.withColumn("shard", shard).withColumn("bin", part)
    if max(salts) > 1:
        spread = F.array(*[F.lit(s) for s in salts])[F.col("bin")]
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), spread).cast("int"))
    else:
        rows = rows.withColumn("salt", F.lit(0))
    block = ["shard", "bin", "salt"]
    counts = rows.groupBy(*block).agg(F.count("*").alias("n"))
    # At most one row per bin, salt and shard: far fewer than rows.
    earlier = W.partitionBy("shard").orderBy("bin", "salt").rowsBetween(W.unboundedPreceding, -1)
    counts = cut(
        counts.select(*block, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "offsets"
    )
    inside = F.row_number().over(W.partitionBy(*block).orderBy("key", "doc_id", "text_crc32", "size"))
    return (
        rows.withColumn("i", inside - 1)
        .join(counts, block)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("i")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op9_sharding(spark, sf_dir):
    return assign(table(spark, sf_dir, "documents"))
