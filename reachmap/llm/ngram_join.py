"""N-gram Jaccard join (operator 3): T-occurrence search with DivideSkip.

Documents are sets of hashed 4-word shingles. Two link when
100 * |x and y| >= 85 * |x or y|. The result is the component of each document.

1. Shingles are counted over all documents, in Spark: chunks of documents send
   each range of shingle hashes its own distinct ones, sorted and difference-coded; a
   range counts them and returns how many of each document's shingles others have.
   A shingle of many documents reaches its range once a chunk, with a number.
   Linked sets share one of the first n - ceil(0.85 n) + 1 shingles in any
   order, so a document with as many unshared ones links with nothing. Those left are few.
2. Equal sets become one set. What is left is counted again, now with the
   counts returned: ordered by count, the prefixes are known. Sets that
   share prefix shingles, directly or through others, form a block; every link
   lies within a block. Rare shingles make blocks small.
3. Within a block, inverted lists are searched for each set: the long lists are
   set apart, the short ones merged, and sets that occur often enough in them
   are probed in the long lists by binary search (DivideSkip). Sets that
   are known to be in one component are not compared again.
4. A block of more than BLOCK_SETS sets or BLOCK_SHINGLES shingles first loses
   what one pivot settles: Jaccard distance is a metric, so a set linked to the
   pivot has all its links inside the pivot's component if no set that
   is not linked lies within its reach. What remains is searched in pairs of
   slices, so one task holds two slices at most.

Defined results: a text without words, or null, has n_shingles 0 and its own id.
One to three words are one shingle. Null ids never become a component's id; a
component of null ids has a null one. Repeated rows each give a row.
"""

import hashlib
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, tasks_for
from . import words as wd
from .common import fresh, in_small_batches, table
from .graph import components

SHINGLE = 4
NUMERATOR, DENOMINATOR = 85, 100
# Documents are counted in chunks of about this many shingles, in ranges of this much text.
CHUNK_SHINGLES = 1_000_000
RANGE_BYTES = 16 << 20
TOKEN_BITS = 48  # of a shingle's hash; equal numbers of different ones only add candidates
# A block above either is hot: 32 MB of shingles at most.
BLOCK_SETS = 1024
BLOCK_SHINGLES = 4_000_000
PIVOT_ROUNDS = 6
# Hashes of rows that go are broadcast up to this many, 8 bytes each; above it they are shuffled.
BROADCAST_KEYS = 1_000_000
# Texts of block members are found again through this many flags.
FLAG_BITS = 20


def least_overlap(n: int) -> int:
    """ceil(0.85 n)."""
    return -(-NUMERATOR * n // DENOMINATOR)


def prefix_length(n: int) -> int:
    return n - least_overlap(n) + 1


def shingle_sets(column, size: int = SHINGLE):
    """The sorted shingle hashes of every text of an Arrow column."""
    data, offs = wd.buffers(column)
    lower, member, values = wd.lower_table(), wd.not_white(), wd.byte_values()
    none = np.zeros(0, np.uint64)
    for a, b in wd.slices(offs):
        h, doc, _, _ = wd.word_hashes(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], member, lower, values)
        n = np.bincount(doc, minlength=b - a)
        at = np.cumsum(n) - n
        c = wd.chain(h, size)
        for i in range(b - a):
            if n[i] >= size:
                yield np.unique(c[at[i] : at[i] + n[i] - size + 1])
            elif n[i]:
                yield wd.chain(h[at[i] : at[i] + n[i]], int(n[i]))
            else:
                yield none


def digest(shingles) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


_SENT = "part int, chunk binary, first long, steps binary, wide boolean, owner binary, times binary, rows binary"


def _chunk(held, rows, bits, keep):
    """Rows of one chunk: its distinct shingles for each range, and the documents themselves with one of them.

    A shingle of one set travels with that set's number, one of several sets with
    how many they are; the sets themselves stay in the row of the documents, as a
    list with `keep`, else as the number of such shingles of each set. So a
    range holds a shingle once a chunk at most, in however many documents it is.
    `held` maps a digest to a set; `rows` are (doc_id, key, n, digest) of all documents.
    """
    names = sorted(held)
    sets = [held[d] for d in names]
    tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    tokens = (tokens >> np.uint64(64 - TOKEN_BITS)).astype(np.int64)
    owner = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(x) for x in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    begin = np.flatnonzero(np.append(True, np.diff(tokens) > 0)) if len(tokens) else np.zeros(0, np.int64)
    times = np.diff(np.append(begin, len(tokens)))
    common = np.repeat(times > 1, times)
    repeated = owner[common]
    stay = (tokens[common], repeated) if keep else np.bincount(repeated, minlength=len(sets))
    kind = np.dtype(np.uint32 if len(sets) >= 65535 else np.uint16)
    tokens, owner = tokens[begin], owner[begin].astype(kind)
    owner[times > 1] = np.iinfo(kind).max
    number = hashlib.blake2b(pickle.dumps((names, rows)), digest_size=16).digest()
    home = int.from_bytes(number[:4], "big") & ((1 << bits) - 1)
    of = tokens >> (TOKEN_BITS - bits)
    parts = np.union1d(of, [home])
    edge = np.append(np.searchsorted(of, parts), len(of))
    for i, part in enumerate(parts.tolist()):
        a, b = edge[i], edge[i + 1]
        steps = np.diff(tokens[a:b])
        wide = bool(len(steps) and steps.max() >= 1 << 32)
        some = times[a:b]
        yield (
            part,
            number,
            int(tokens[a]) if b > a else None,
            steps.astype(np.uint64 if wide else np.uint32).tobytes(),
            wide,
            owner[a:b].tobytes(),
            some[some > 1].astype(np.uint32).tobytes(),
            pickle.dumps((names, [len(x) for x in sets], rows, stay)) if part == home else None,
        )


def _as_batch(rows):
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in _SENT.split(", ")]
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def _send(bits, chunk_shingles, read, keep):
    """Chunks of the documents that `read` gives as (doc_id, key, set) of a batch."""

    def run(batches):
        held, rows, size = {}, [], 0
        for batch in batches:
            for doc_id, key, s in read(batch):
                d = digest(s)
                rows.append((doc_id, key, len(s), d))
                if len(s) >= 6 and d not in held:  # below six shingles only equal sets link
                    held[d] = s
                    size += len(s)
                if size >= chunk_shingles or len(rows) >= 50_000:
                    yield _as_batch(list(_chunk(held, rows, bits, keep)))
                    held, rows, size = {}, [], 0
        if rows:
            yield _as_batch(list(_chunk(held, rows, bits, keep)))

    return run


def _from_text(batch):
    keys = zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), strict=True)
    for (doc_id, key), s in zip(keys, shingle_sets(batch.column("text")), strict=True):
        yield doc_id, key, s


def _from_sets(batch):
    for s in batch.column("shingles").to_pylist():
        yield None, None, np.frombuffer(s, np.uint64)


_BACK = "chunk binary, owner binary, tokens binary, counts binary, rows binary"


def _count_range(with_tokens):
    def run(pdf):
        tokens, owners, weight, chunk = [], [], [], []
        for i, r in enumerate(pdf.itertuples()):
            wide = np.dtype(np.uint64 if r.wide else np.uint32)
            steps = np.frombuffer(r.steps, wide)
            n = 0 if r.first is None or r.first != r.first else len(steps) + 1
            t = np.zeros(n, np.int64)
            if n:
                t[0] = int(r.first)
                t[1:] = steps
            kind = np.dtype(np.uint32 if len(r.owner) == 4 * n else np.uint16)
            owner = np.frombuffer(r.owner, kind).astype(np.int64)
            owner[owner == np.iinfo(kind).max] = -1  # several sets of the chunk
            times = np.ones(n, np.int64)
            times[owner < 0] = np.frombuffer(r.times, np.uint32)
            tokens.append(np.cumsum(t))
            owners.append(owner)
            weight.append(times)
            chunk.append(np.full(n, i))
        tokens, owners, weight, chunk = map(np.concatenate, (tokens, owners, weight, chunk))
        order = np.argsort(tokens, kind="stable")
        new = np.append(True, np.diff(tokens[order]) > 0) if len(order) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        count = np.empty(len(order), np.int64)
        if len(order):
            count[order] = np.repeat(np.add.reduceat(weight[order], first), np.diff(np.append(first, len(order))))
        # Without counts a shingle of several sets of the chunk is known to be shared.
        back = count > 1 if with_tokens else (count > 1) & (owners >= 0)
        out = []
        at = np.searchsorted(chunk, np.arange(len(pdf) + 1))
        for i, r in enumerate(pdf.itertuples()):
            mine = slice(at[i], at[i + 1])
            keep = back[mine]
            own = owners[mine][keep]
            if with_tokens:
                row = own.astype(np.int32).tobytes(), tokens[mine][keep].tobytes(), count[mine][keep].tobytes()
            else:
                who, many = np.unique(own, return_counts=True)
                row = who.astype(np.int32).tobytes(), b"", many.tobytes()
            if len(own) or r.rows is not None:
                out.append((r.chunk, *row, r.rows))
        return pd.DataFrame(out, columns=["chunk", "owner", "tokens", "counts", "rows"])

    return run


def _documents(pdf):
    """All documents of a chunk: whether their sets may link with others."""
    whole = [pickle.loads(x) for x in pdf["rows"] if x is not None]
    names, sizes, rows, shared = whole[0]
    # A chunk's content may occur twice; then every count is there twice as well.
    times = len(whole)
    shared = shared * times
    for r in pdf.itertuples():
        np.add.at(shared, np.frombuffer(r.owner, np.int32), np.frombuffer(r.counts, np.int64))
    may = {d: n - k // times < prefix_length(n) for d, n, k in zip(names, sizes, shared, strict=True)}
    out = [(i, k, n, d, may.get(d, False)) for i, k, n, d in rows] * times
    return pd.DataFrame(out, columns=["doc_id", "key", "n", "digest", "may_link"]).astype({"doc_id": "Int64"})


def _prefixes(pdf):
    """Shared shingles in the prefix of every set of a chunk."""
    names, sizes, _, (common, members) = next(pickle.loads(x) for x in pdf["rows"] if x is not None)
    owner = np.concatenate([np.frombuffer(x, np.int32) for x in pdf["owner"]]).astype(np.int64)
    tokens = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["tokens"]])
    count = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["counts"]])
    # What several sets of the chunk have came back once, with its count.
    several = owner < 0
    known, counts = tokens[several], count[several]
    order = np.argsort(known, kind="stable")
    known, counts = known[order], counts[order]
    owner = np.concatenate([owner[~several], members.astype(np.int64)])
    tokens = np.concatenate([tokens[~several], common])
    count = np.concatenate([count[~several], counts[np.searchsorted(known, common)]])
    order = np.lexsort((tokens, count, owner))
    owner, tokens = owner[order], tokens[order]
    at = np.searchsorted(owner, np.arange(len(names) + 1))
    out = []
    for i, (d, n) in enumerate(zip(names, sizes, strict=True)):
        k = int(at[i + 1] - at[i])
        some = prefix_length(n) - (n - k)
        if some > 0:
            out.append((d, n, tokens[at[i] : at[i] + some]))
    return pd.DataFrame(out, columns=["digest", "n", "prefix"])


def _ranges(total: int, range_bytes: int) -> int:
    """Bits of the number of ranges for that many bytes of text."""
    return min(30, max(0, (max(1, total) // range_bytes).bit_length()))


def _flags(keys: DataFrame) -> np.ndarray:
    """Which last FLAG_BITS bits the keys have, from bitmaps of 4 KB made in Spark: one job, whatever the partitions."""
    place = F.col("key").bitwiseAND((1 << FLAG_BITS) - 1) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    flags = np.zeros(1 << FLAG_BITS, bool)
    for r in maps.collect():
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        flags[(r["k"] - 1) * len(bits) :][: len(bits)] = bits
    return flags


def _sets_of(flags):
    def run(batches):
        wanted = flags.value
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            some = batch.column("text").filter(pa.array(wanted[key & (len(wanted) - 1)]))
            for i in range(0, len(some), 2000):
                got = list(shingle_sets(some.slice(i, 2000)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "digest": pa.array([digest(s) for s in got], pa.binary()),
                        "shingles": pa.array([s.tobytes() for s in got], pa.binary()),
                    }
                )

    return run


class Forest:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n):
        self.up = np.arange(n)

    def find(self, x):
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def roots(self):
        up = self.up
        while True:
            nxt = up[up]
            if (nxt == up).all():
                return up
            self.up = up = nxt


def divide_skip(sets, split=None):
    """Roots of the components of `sets` (sorted uint64 arrays).

    With `split`, only links between the first `split` sets and the others are
    searched.
    """
    k = len(sets)
    forest = Forest(k)
    size = np.array([len(s) for s in sets])
    order = np.lexsort((np.arange(k), size))
    place = np.empty(k, np.int64)
    place[order] = np.arange(k)
    # Inverted lists: set numbers, by size, of each shingle with two sets or more.
    flat = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(k), size[order])
    _, ids, freq = np.unique(flat, return_inverse=True, return_counts=True)
    by = np.argsort(ids, kind="stable")
    lists, begin = owner[by], np.cumsum(freq) - freq
    at = np.cumsum(size[order]) - size[order]
    for q in range(k):
        n = int(size[order[q]])
        mine = ids[at[q] : at[q] + n]
        mine = mine[freq[mine] > 1]
        least = -(-2 * NUMERATOR * n // (NUMERATOR + DENOMINATOR))  # for the smallest partner, of n shingles
        if len(mine) < least:
            continue
        top = n * DENOMINATOR // NUMERATOR
        stop = int(np.searchsorted(size[order], top, "right"))
        mine = mine[np.argsort(freq[mine], kind="stable")]
        # Long lists, at most least - 1: by the usual rule, fewer when lists are short.
        long = min(least - 1, int(least / (0.01 * np.log2(max(2, freq[mine[-1]])) + 1)))
        short, probes = mine[: len(mine) - long], mine[len(mine) - long :]
        merged = np.concatenate([lists[begin[i] : begin[i] + freq[i]] for i in short])
        merged = merged[(merged > q) & (merged < stop)]
        if not len(merged):
            continue
        cand, count = np.unique(merged, return_counts=True)
        keep = count >= least - long
        cand, count = cand[keep], count[keep]
        if split is not None:
            keep = (order[cand] < split) != (order[q] < split)
            cand, count = cand[keep], count[keep]
        if not len(cand):
            continue
        home = forest.find(q)
        roots = forest.roots()
        keep = roots[cand] != home
        cand, count = cand[keep], count[keep]
        need = -(-NUMERATOR * (n + size[order[cand]]) // (NUMERATOR + DENOMINATOR))
        for j, i in enumerate(probes[::-1]):  # longest lists last to be needed, first to be probed
            keep = count + (long - j) >= need
            if not keep.all():
                cand, count, need = cand[keep], count[keep], need[keep]
            if not len(cand):
                break
            members = lists[begin[i] : begin[i] + freq[i]]
            p = np.searchsorted(members, cand)
            p[p == len(members)] = 0
            count = count + (members[p] == cand)
        for y in cand[count >= need]:
            forest.join(q, y)
    roots = forest.roots()
    # Back to the caller's numbers; any member may stand for its component.
    return order[roots[place]]


_EDGE = "digest binary, root binary"


def _edges(digests, roots):
    pairs = [(d, digests[r]) for d, r in zip(digests, roots, strict=True) if d != digests[r]]
    return pa.RecordBatch.from_pydict(
        {
            "digest": pa.array([p[0] for p in pairs], pa.binary()),
            "root": pa.array([p[1] for p in pairs], pa.binary()),
        }
    )


def _search_blocks(batches):
    """Sorted by block: search each block when its rows are complete."""
    block, digests, sets, sides = None, [], [], []

    def done():
        split = None
        if 1 in sides:  # two slices: the first side comes first
            split = sides.index(1)
        return _edges(digests, divide_skip(sets, split))

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("block", "digest", "shingles", "side")]
        for b, d, s, side in zip(*cols, strict=True):
            if b != block:
                if len(sets) > 1:
                    yield done()
                block, digests, sets, sides = b, [], [], []
            digests.append(d)
            sets.append(np.frombuffer(s, np.uint64))
            sides.append(side)
    if len(sets) > 1:
        yield done()


def _search(blocks: DataFrame) -> DataFrame:
    return (
        blocks.repartition("block")
        .sortWithinPartitions("block", "side", "digest")
        .mapInArrow(_search_blocks, _EDGE)
    )


def _to_pivot(batches):
    for batch in batches:
        out = []
        for s, p in zip(batch.column("shingles").to_pylist(), batch.column("pivot_shingles").to_pylist(), strict=True):
            x, y = np.frombuffer(s, np.uint64), np.frombuffer(p, np.uint64)
            out.append(len(np.intersect1d(x, y, assume_unique=True)))
        names = ["block", "digest", "n", "pivot", "pivot_n"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array(out, pa.int64())], names=[*names, "inter"]
        )


def _hot_edges(sets: DataFrame, most_sets: int, most_shingles: int) -> DataFrame:
    """Edges among hot blocks. `sets`: block, digest, n, shingles."""
    found = []
    for k in range(PIVOT_ROUNDS):
        sizes = sets.groupBy("block").agg(F.count("*").alias("k"), F.sum("n").alias("t"))
        hot = (F.col("k") > most_sets) | (F.col("t") > most_shingles)
        n_blocks, n_hot = sizes.agg(F.count("*"), F.count(F.when(hot, 1))).first()
        if not n_hot:
            break
        pick = (
            sets.groupBy("block")
            .agg(F.min(F.struct(F.xxhash64("digest", F.lit(k)).alias("h"), "digest")).alias("p"))
            .select("block", F.col("p.digest").alias("pivot"))
        )
        pivots = cut(
            pick.join(
                sets.select(F.col("digest").alias("pivot"), F.col("n").alias("pivot_n"), F.col("shingles").alias("pivot_shingles")),
                "pivot",
            ),
            "pivots",
            tasks_for(n_blocks, 1000),
        )
        near = sets.join(pivots, "block").mapInArrow(
            _to_pivot, "block long, digest binary, n long, pivot binary, pivot_n long, inter long"
        )
        union = F.col("n") + F.col("pivot_n") - F.col("inter")
        near = cut(
            near.withColumn("far", 1 - F.col("inter") / union).withColumn(
                "linked", F.col("inter") * DENOMINATOR >= union * NUMERATOR
            ),
            "near",
        )
        found.append(near.filter("linked and digest != pivot").select("digest", F.col("pivot").alias("root")))
        reach = 1 - NUMERATOR / DENOMINATOR + 1e-9
        gap = near.filter("not linked").groupBy("block").agg(F.min("far").alias("gap"))
        settled = (
            near.filter("linked")
            .join(gap, "block", "left")
            .filter(F.col("gap").isNull() | (F.col("far") + reach < F.col("gap")))
            .select("digest")
        )
        sets = cut(sets.join(settled, "digest", "left_anti"), "unsettled")
    # Slices of size bands within a block; pairs of slices whose sizes can link.
    band = F.floor(F.log("n") / np.log(DENOMINATOR / NUMERATOR)).alias("step")
    per = (
        sets.groupBy("block", band)
        .agg(F.count("*").alias("k"), F.sum("n").alias("t"))
        .withColumn(
            "parts",
            F.greatest(F.ceil(F.col("k") * 2 / most_sets), F.ceil(F.col("t") * 2 / most_shingles)),
        )
        .select("block", "step", "parts")
    )
    sliced = sets.withColumn("step", band).join(per, ["block", "step"])
    sliced = cut(
        sliced.withColumn("slice", F.pmod(F.xxhash64("digest"), F.col("parts"))).drop("parts"), "slices"
    )
    ends = sliced.groupBy("block", "step", "slice").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = ends.alias("a"), ends.alias("b")
    before = (F.col("a.step") < F.col("b.step")) | (
        (F.col("a.step") == F.col("b.step")) & (F.col("a.slice") <= F.col("b.slice"))
    )
    pairs = (
        a.join(b, F.col("a.block") == F.col("b.block"))
        .filter(before & (F.col("a.high") * DENOMINATOR >= F.col("b.low") * NUMERATOR))
        .select(
            "a.block",
            F.xxhash64("a.block", "a.step", "a.slice", "b.step", "b.slice").alias("pair"),
            F.col("a.step").alias("s0"),
            F.col("a.slice").alias("p0"),
            F.col("b.step").alias("s1"),
            F.col("b.slice").alias("p1"),
        )
    )
    same = (F.col("s0") == F.col("s1")) & (F.col("p0") == F.col("p1"))
    one = pairs.select("block", "pair", F.col("s0").alias("step"), F.col("p0").alias("slice"), F.lit(0).alias("side"))
    two = pairs.filter(~same).select(
        "block", "pair", F.col("s1").alias("step"), F.col("p1").alias("slice"), F.lit(1).alias("side")
    )
    rest = sliced.join(cut(one.union(two), "slice-pairs"), ["block", "step", "slice"])
    rest = rest.select(F.col("pair").alias("block"), "digest", "shingles", "side")
    edges = _search(rest)
    for e in found:
        edges = edges.union(e)
    return edges


def _with_components(
    docs: DataFrame,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
    chunk_shingles: int = CHUNK_SHINGLES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """doc_id, key (a hash of id and text), n (size of the set) and component_id of every row."""
    spark = in_small_batches(docs).sparkSession
    text = F.col("text").cast("string").alias("text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    total, n_docs = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    # Tables of narrow rows are written by as many tasks as their rows ask, not by one a shuffle partition.
    per_docs = tasks_for(n_docs)
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    sent = keyed.mapInArrow(_send(_ranges(total, range_bytes), chunk_shingles, _from_text, False), _SENT)
    counted = sent.groupBy("part").applyInPandas(_count_range(False), _BACK)
    signed = cut(
        counted.groupBy("chunk").applyInPandas(
            _documents, "doc_id long, key long, n long, digest binary, may_link boolean"
        ),
        "signatures",
        max(per_docs, tasks_for(total, range_bytes)),
    )
    # One row per distinct set; the row `key` points at is where its text is read again.
    sets = cut(
        signed.groupBy("digest").agg(
            F.min("doc_id").alias("low_id"),
            F.count("*").alias("copies"),
            F.max("n").alias("n"),
            F.min(F.struct("doc_id", "key")).alias("at"),
            F.max("may_link").alias("may_link"),
        ),
        "sets",
        per_docs,
    )
    left = sets.filter("may_link")
    flags = _flags(left.select(F.col("at.key").alias("key")))
    shingles = keyed.mapInArrow(_sets_of(spark.sparkContext.broadcast(flags)), "digest binary, shingles binary")
    held = shingles.dropDuplicates(["digest"]).join(left.select("digest", "n"), "digest")
    held = cut(held, "held")
    left_bytes, n_held = held.agg(F.coalesce(F.sum("n"), F.lit(0)) * 8, F.count("*")).first()
    per_bytes = tasks_for(left_bytes, range_bytes)
    sent = held.mapInArrow(_send(_ranges(left_bytes, range_bytes), chunk_shingles, _from_sets, True), _SENT)
    counted = sent.groupBy("part").applyInPandas(_count_range(True), _BACK)
    prefixes = cut(
        counted.groupBy("chunk").applyInPandas(_prefixes, "digest binary, n long, prefix array<long>"), "prefixes", per_bytes
    )
    # 60 bits of the digest: equal numbers of different sets only make blocks larger.
    rid = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long").alias("rid")
    tokens = prefixes.select(rid, F.explode("prefix").alias("token"))
    # Lookup sides are written first: the adaptive join can then split a frequent key of the other side.
    lead = cut(tokens.groupBy("token").agg(F.min("rid").alias("lead")), "leads", per_bytes)
    edges = tokens.join(lead, "token").filter("rid != lead").select("rid", "lead")
    blocks = components(edges, "rid", "lead")
    members = cut(
        prefixes.select(rid, "digest", "n")
        .join(blocks.select(F.col("node").alias("rid"), F.col("root").alias("block")), "rid")
        .drop("rid"),
        "members",
        tasks_for(n_held),
    )
    held = members.join(held.drop("n"), "digest")
    sizes = members.groupBy("block").agg(F.count("*").alias("k"), F.sum("n").alias("t"))
    hot = cut(
        sizes.filter((F.col("k") > block_sets) | (F.col("t") > block_shingles)).select("block"),
        "hot-blocks",
        tasks_for(n_held),
    )
    if hot.isEmpty():
        roots = _search(held.withColumn("side", F.lit(0)))
    else:
        calm = held.join(hot, "block", "left_anti")
        roots = _search(calm.withColumn("side", F.lit(0)))
        busy = _hot_edges(cut(held.join(hot, "block", "left_semi"), "busy"), block_sets, block_shingles)
        busy = components(busy, "digest", "root")
        roots = roots.union(busy.filter("node != root").select("node", "root"))
    roots = cut(roots, "roots")
    roots = roots.union(roots.select("root", "root").distinct())
    of = sets.join(roots, "digest").select("digest", "root", "low_id")
    low = cut(of.groupBy("root").agg(F.min("low_id").alias("component_id")), "low-ids", per_docs)
    joined = of.join(low, "root").select("digest", "component_id")
    groups = cut(
        sets.join(joined, "digest", "left")
        .filter("copies > 1 or component_id is not null")
        .select("digest", F.coalesce("component_id", "low_id").alias("component_id")),
        "groups",
        per_docs,
    )
    # An empty set links with nothing; without a group a document stands alone.
    return (
        signed.select("doc_id", "key", "n", "digest")
        .join(groups, "digest", "left")
        .select(
            "doc_id",
            "key",
            "n",
            F.when(F.col("n") == 0, F.col("doc_id"))
            .otherwise(F.coalesce("component_id", "doc_id"))
            .alias("component_id"),
        )
    )


def link_components(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return _with_components(docs, **limits).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near copies: of each component the row with the smallest id.

    Rows with a null id, and rows without words, stay. Of several rows with the
    smallest id one stays: that with the smallest hash of id and text, and of
    rows alike in both the one whose other columns come first.
    """
    found = cut(_with_components(docs), "near-copies").filter("n > 0 and doc_id is not null")
    first = found.filter("doc_id = component_id").groupBy("component_id").agg(F.min("key").alias("win"))
    first = cut(first, "first-rows")
    gone = found.join(first, "component_id").filter("doc_id != component_id or key != win").select("key")
    gone = cut(gone.distinct(), "gone")
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    names, own, whole = [f"`{c}`" for c in docs.columns], fresh(docs, "_key"), fresh(docs, "_row")
    rows = docs.withColumn(own, F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string")))
    rows = rows.join(gone.withColumnRenamed("key", own), own, "left_anti")
    alike = found.filter("doc_id = component_id").groupBy("key").agg(F.count("*").alias("k")).filter("k > 1")
    alike = cut(alike.select(F.col("key").alias(own)), "alike")
    if alike.isEmpty():
        return rows.select(*names)
    one = rows.join(alike, own, "left_semi").groupBy(own).agg(F.min(F.struct(*names)).alias(whole))
    return rows.join(alike, own, "left_anti").select(*names).unionByName(one.select(f"`{whole}`.*"))


def op3_ngram_join(spark, sf_dir):
    return link_components(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(
    CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS grams
  FROM d
), n AS (SELECT doc_id, len(grams) AS n, min(doc_id) OVER (PARTITION BY grams) AS same FROM s),
g AS (SELECT doc_id, n, unnest(grams) AS gram FROM s JOIN n USING (doc_id) WHERE same = doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM n WHERE same = doc_id
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles,
       CASE WHEN n.n = 0 THEN n.doc_id ELSE low.component_id END AS component_id
FROM n JOIN low ON low.x = n.same
"""
