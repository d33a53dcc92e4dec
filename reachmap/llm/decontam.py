"""Benchmark decontamination (operator 5): suffix arrays over the training text.

Training text is cut into shards of a few MB. A shard's suffix array orders the
suffixes that can match at all: those that begin with as many consecutive words
of the benchmark's vocabulary as the shortest window has. Every test suffix that
begins a window is binary-searched in it, all of them at once; the range it
finds gives the verbatim matches and their places, which are then extended to
their full length. Places of the benchmark that begin with the same window are in the order of what
follows them, so the longest match among all of them takes a binary search as well.

The benchmark is read in pieces of at most PIECE_BYTES of text (or one item);
one piece at a time is broadcast, and the matches found so far travel with the
rows, so no row is shuffled.

Defined results: null and empty texts have no words, items without words no
windows. Items of one id count once; a null id counts as the empty string.
Repeated rows each give a row. An empty benchmark contaminates nothing.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as wd
from .common import in_small_batches, table

WINDOW = 10
PIECE_BYTES = 16 << 20


def _item_words(texts):
    data, offs = wd.buffers(pa.array(texts, pa.string()))
    h, doc, _, _ = wd.word_hashes(data, offs, wd.alnum(), wd.lower_table())
    n = np.bincount(doc, minlength=len(texts))
    return h, np.cumsum(n) - n, n


def build_index(items, window=WINDOW):
    """Windows of the items [(id, text)] as sorted keys, and the items of each."""
    names = [i for i, _ in items]
    h, at, n = _item_words([t or "" for _, t in items])
    vocabulary = np.unique(h)
    ids = np.searchsorted(vocabulary, h).astype(np.uint64) + wd.U(1)
    widths = np.minimum(n, window)
    starts, width, owner = [], [], []
    for i in np.flatnonzero(n):
        k = int(n[i] - widths[i] + 1)
        starts.append(at[i] + np.arange(k))
        width.append(np.full(k, widths[i]))
        owner.append(np.full(k, i))
    index = {"names": names, "window": window, "vocabulary": vocabulary, "words": ids, "at": at, "n": n}
    if not starts:
        return index | {"shortest": 0}
    starts, width, owner = map(np.concatenate, (starts, width, owner))
    bits = max(1, int(len(vocabulary) + 1).bit_length())
    index |= {"bits": bits, "shortest": int(width.min()), "longest": int(width.max())}
    keys = pack(ids, starts, width, index)
    # Equal windows are one test suffix with several items.
    order = np.lexsort([*reversed(keys), width])
    keys, width, starts, owner = [k[order] for k in keys], width[order], starts[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = width[1:] != width[:-1]
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    owners = np.append(first, len(order))
    index |= {"starts": starts, "owner": owner, "owners": owners}
    order = follow_order(index, width)
    starts, owner = starts[order], owner[order]
    index |= {
        "keys": [k[first] for k in keys],
        "width": width[first],
        "source": np.argsort(order, kind="stable")[first],
        "starts": starts,
        "owner": owner,
    }
    return index


def follow_order(index, width):
    """The order of the places of equal windows by the words that follow, an item's end first."""
    starts, owner, words = index["starts"], index["owner"], index["words"]
    size = np.diff(index["owners"])
    slot = np.repeat(index["owners"][:-1], size)  # the first place of its group in the order
    depth, item_end = width.copy(), (index["at"] + index["n"])[owner]
    open_ = np.flatnonzero(np.repeat(size, size) > 1)
    while len(open_):
        at = starts[open_] + depth[open_]
        word = np.where(at < item_end[open_], words[np.minimum(at, len(words) - 1)], 0)
        order = np.lexsort((word, slot[open_]))
        open_, word = open_[order], word[order]
        group, number = slot[open_], np.arange(len(open_))
        new_group = np.append(True, group[1:] != group[:-1])
        new_part = new_group | np.append(True, word[1:] != word[:-1])
        head = np.maximum.accumulate(np.where(new_group, number, 0))
        part = np.maximum.accumulate(np.where(new_part, number, 0))
        slot[open_] = group + part - head
        alone = new_part & np.append(new_part[1:], True)
        depth[open_] += 1
        open_ = open_[~alone & (word > 0)]
    return np.argsort(slot, kind="stable")


def pack(ids, starts, width, index):
    """Sort keys of sequences: as many ids per 64-bit key as fit; shorter ones end with zeros."""
    per, longest = 63 // index["bits"], index["longest"]
    keys = []
    for j in range(0, longest, per):
        key = np.zeros(len(starts), np.uint64)
        for i in range(j, j + per):
            key <<= wd.U(index["bits"])
            if i < longest:
                inside = i < width
                key[inside] |= ids[starts[inside] + i]
        keys.append(key)
    return keys


def _less(keys, at, test, or_equal):
    """Whether the suffix at each position sorts before the test key."""
    less, equal = np.zeros(len(at), bool), np.ones(len(at), bool)
    for k, t in zip(keys, test, strict=True):
        v = k[at]
        less |= equal & (v < t)
        equal &= v == t
    return less | equal if or_equal else less


def bounds(keys, test, or_equal):
    """Binary search of all test keys at once in lexicographically sorted keys."""
    low = np.zeros(len(test[0]), np.int64)
    high = np.full(len(test[0]), len(keys[0]), np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        less = np.zeros(len(low), bool)
        less[open_] = _less(keys, middle[open_], [t[open_] for t in test], or_equal)
        low = np.where(open_ & less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)


def upper_keys(index):
    """The largest keys that begin with each window: its free places filled."""
    per, out = 63 // index["bits"], []
    for j, key in enumerate(index["keys"]):
        fill = np.zeros(len(key), np.uint64)
        for i in range(per):
            free = j * per + i >= index["width"]
            shift = wd.U(index["bits"] * (per - 1 - i))
            fill[free] |= wd.U((1 << index["bits"]) - 1) << shift
        out.append(key | fill)
    return out


def search_shard(data, offs, index):
    """(words per text, hits) of a shard; hits are (text, first word, window number, length, place in the benchmark's list)."""
    h, doc, _, _ = wd.word_hashes(data, offs, wd.alnum(), wd.lower_table())
    n = np.bincount(doc, minlength=len(offs) - 1)
    least = index["shortest"]
    none = (np.zeros(0, np.int64),) * 5
    if not least or len(h) < least:
        return n, none
    vocabulary = index["vocabulary"]
    if "filter" not in index:
        index["filter"] = np.zeros(1 << 20, bool)
        index["filter"][(vocabulary >> wd.U(44)).astype(np.int64)] = True
    ids = np.zeros(len(h), np.uint64)
    maybe = np.flatnonzero(index["filter"][(h >> wd.U(44)).astype(np.int64)])
    p = np.searchsorted(vocabulary, h[maybe])
    p[p == len(vocabulary)] = 0
    same = vocabulary[p] == h[maybe]
    ids[maybe[same]] = p[same].astype(np.uint64) + wd.U(1)
    known = ids > 0
    ok = known[: len(h) - least + 1] & (doc[: len(h) - least + 1] == doc[least - 1 :])
    for j in range(1, least):
        ok &= known[j : len(h) - least + 1 + j]
    suffixes = np.flatnonzero(ok)
    if not len(suffixes):
        return n, none
    # How far each suffix can be compared: known words of its own text.
    ends = np.flatnonzero(~known)
    ends = np.append(ends, len(h))
    texts_end = np.cumsum(n)
    reach = np.minimum(ends[np.searchsorted(ends, suffixes)], texts_end[doc[suffixes]]) - suffixes
    keys = pack(ids, suffixes, np.minimum(reach, index["longest"]), index)
    order = np.lexsort(list(reversed(keys)))  # the suffix array
    suffixes, keys = suffixes[order], [k[order] for k in keys]
    low = bounds(keys, index["keys"], False)
    if "upper" not in index:
        index["upper"] = upper_keys(index)
    high = bounds(keys, index["upper"], True)
    count = high - low
    found = np.flatnonzero(count)
    if not len(found):
        return n, none
    count = count[found]
    window = np.repeat(found, count)
    inside = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    place = suffixes[low[window] + inside]
    words, starts, owners = index["words"], index["starts"], index["owners"]
    ends_of = (index["at"] + index["n"])[index["owner"]]
    text_end = texts_end[doc[place]]

    def extended(hits, entry):
        """How many words from each hit on equal those from the place of the benchmark on."""
        length = index["width"][window[hits]].copy()
        alive = np.arange(len(hits))
        while len(alive):
            a, b = place[hits[alive]] + length[alive], starts[entry[alive]] + length[alive]
            go = (a < text_end[hits[alive]]) & (b < ends_of[entry[alive]])
            alive, a, b = alive[go], a[go], b[go]
            alive = alive[ids[a] == words[b]]
            length[alive] += 1
        return length

    everything = np.arange(len(window))
    entry = index["source"][window]
    length = extended(everything, entry)
    low, high = owners[window].copy(), owners[window + 1].copy()
    # The longest match of several places is next to where the text would stand among them.
    search = everything[high - low > 1]
    while len(search):
        middle = (low[search] + high[search]) // 2
        got = extended(search, middle)
        better = got > length[search]
        entry[search[better]], length[search[better]] = middle[better], got[better]
        a, b = place[search] + got, starts[middle] + got
        own = np.where(a < text_end[search], ids[np.minimum(a, len(ids) - 1)], 0)
        theirs = np.where(b < ends_of[middle], words[np.minimum(b, len(words) - 1)], 0)
        after = own > theirs
        low[search[after]] = middle[after] + 1
        high[search[~after]] = middle[~after]
        search = search[low[search] < high[search]]
    return n, (doc[place], place - (texts_end - n)[doc[place]], window, length, entry)


def _merge(spans, names, best, index, first, window, length, entry):
    """Word ranges hit, items and the longest match, with those of earlier pieces."""
    width = index["width"][window]
    spans = np.concatenate([spans, np.stack([first, first + width], 1)]) if len(first) else spans
    if len(spans):
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        reach = np.maximum.accumulate(spans[:, 1])
        new = np.append(True, spans[1:, 0] > reach[:-1])
        spans = np.stack([spans[new, 0], np.append(reach[:-1][new[1:]], reach[-1])], 1)
    for w in np.unique(window):
        owners = index["owner"][index["owners"][w] : index["owners"][w + 1]]
        names = names | {index["names"][o] for o in owners}
    if len(length):
        k = np.lexsort((first, -length))[0]
        if length[k] > best[0] or (length[k] == best[0] and first[k] < best[1]):
            item = index["owner"][entry[k]]
            best = (int(length[k]), int(first[k]), index["names"][item], int(index["starts"][entry[k]] - index["at"][item]))
    return spans, names, best


_REPORT = (
    "n_words long, n_hit long, spans binary, items array<string>, "
    "longest long, longest_at long, longest_item string, longest_item_at long"
)
_NAMES = [x.split()[0] for x in _REPORT.split(", ")]


def scan(batch, text, index):
    """Report columns of a batch; earlier reports in the batch are added to."""
    data, offs = wd.buffers(batch.column(text))
    old = {c: batch.column(c).to_pylist() for c in _NAMES} if "spans" in batch.schema.names else None
    out = {c: [] for c in _NAMES}
    for a, b in wd.slices(offs):
        n, hits = search_shard(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], index)
        order = np.argsort(hits[0], kind="stable")
        hits = [x[order] for x in hits]
        edge = np.searchsorted(hits[0], np.arange(b - a + 1))
        for i in range(b - a):
            spans, names, best = np.zeros((0, 2), np.int64), frozenset(), (0, None, None, None)
            if old:
                spans = np.frombuffer(old["spans"][a + i], np.int64).reshape(-1, 2)
                names = frozenset(old["items"][a + i])
                best = tuple(old[c][a + i] for c in _NAMES[4:])
            if edge[i + 1] > edge[i]:
                own = slice(edge[i], edge[i + 1])
                spans, names, best = _merge(spans, names, best, index, *(x[own] for x in hits[1:]))
            row = (int(n[i]), int((spans[:, 1] - spans[:, 0]).sum()), spans.tobytes(), sorted(names), *best)
            for c, v in zip(_NAMES, row, strict=True):
                out[c].append(v)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    return {c: pa.array(out[c], k) for c, k in zip(_NAMES, kinds, strict=True)}


def pieces(benchmark: DataFrame, window: int = WINDOW, piece_bytes: int = PIECE_BYTES):
    """Indexes of the benchmark, each of about `piece_bytes` of text at most."""
    item = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.col("text").cast("string").alias("text"),
    ).filter(F.length("text") > 0)
    total = item.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    k = max(1, -(-total // piece_bytes))
    for j in range(k):
        part = item.filter(F.pmod(F.xxhash64("item", "text"), F.lit(k)) == j)
        index = build_index(sorted((r["item"], r["text"]) for r in part.collect()), window)
        if index["shortest"]:
            yield index


def _report_with(index):
    def run(batches):
        for batch in batches:
            more = scan(batch, "text", index.value)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": batch.column("text"), **more})

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Per document: words, hit words, items, and the longest verbatim match with its places."""
    spark = in_small_batches(docs).sparkSession
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, text string, " + _REPORT
    searched = False
    for index in pieces(benchmark, window, piece_bytes):
        out = out.mapInArrow(_report_with(spark.sparkContext.broadcast(index)), kind)
        searched = True
    if not searched:
        out = out.mapInArrow(_report_with(spark.sparkContext.broadcast({"shortest": 0})), kind)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest",
        "longest_at",
        "longest_item",
        "longest_item_at",
    )


def _clean_with(index):
    def run(batches):
        for batch in batches:
            hit = scan(batch.select(["text"]), "text", index.value)["n_hit"].to_numpy()
            yield batch.filter(pa.array(hit == 0))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The rows of `docs` without a window of the benchmark, all columns kept."""
    in_small_batches(docs)
    for index in pieces(benchmark, window, piece_bytes):
        docs = docs.mapInArrow(_clean_with(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs


def op5_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    # Which of several items with equally long matches is named is left open, so not in the result.
    return found.drop("longest_item", "longest_item_at")


OP5_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, row_number() OVER () AS number, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), k AS (SELECT *, least(10, len(w)) AS width FROM i WHERE len(w) > 0),
p AS (SELECT *, unnest(range(1, len(w) - width + 2)) AS start FROM k),
windows AS (SELECT item, number, width, start, array_to_string(w[start : start + width - 1], ' ') AS words FROM p),
q AS (
  SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS start
  FROM d JOIN (SELECT DISTINCT width FROM windows) ON len(w) >= width
), places AS (SELECT doc_id, width, start, array_to_string(w[start : start + width - 1], ' ') AS words FROM q),
hits AS (
  SELECT doc_id, item, number, width, places.start AS start, places.start - windows.start AS shift
  FROM places JOIN windows USING (width, words)
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + width)) AS word FROM hits) GROUP BY doc_id
), names AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY doc_id),
runs AS (
  SELECT *, start - row_number() OVER (PARTITION BY doc_id, number, shift ORDER BY start) AS run FROM hits
), matches AS (
  SELECT doc_id, count(*) + min(width) - 1 AS longest, min(start) - 1 AS longest_at
  FROM runs GROUP BY doc_id, number, shift, run
), best AS (
  SELECT doc_id, longest, longest_at FROM matches
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY longest DESC, longest_at) = 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(longest, 0) AS BIGINT) AS longest, longest_at
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN names USING (doc_id) LEFT JOIN best USING (doc_id)
"""
