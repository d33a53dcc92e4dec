"""Language ID (operator 4): prediction by partial matching with frozen statistics.

Every language has a tree of byte contexts up to MAX_ORDER. A byte's probability
in a context is its count over (bytes seen + distinct bytes seen); the share of
the distinct ones is the escape to the next shorter context, in which bytes of
the longer ones are excluded; below the empty context all bytes left are equal.
The code length of a text is the sum over its bytes, exact for the frozen
counts; the shortest code wins, and the score is its posterior probability.

A context and the byte after it are one number, a gram. All grams of the sample
count, of every context however rare; grams of lower order are sums of those of
full order. A byte seen in a context was seen in all shorter ones, so what is
excluded after an escape depends on one context alone and is summed up
beforehand. Code lengths of the grams that any language has seen are tabled;
those of others are worked out from the trees, each once a slice.

Trained on a bounded sample: TRAIN_DOCS documents per language, those with the
smallest hash of their id, whole texts. Spark counts the grams; those counts,
some megabytes a language, are the model.

Defined results: `und` with score 0 for a text that is null or has no letter,
or if nothing could be learned. Ties go to the language first in order. Null
ids are never learned from and not held out.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import words as wd
from .common import fold, held_out, in_small_batches, table

MAX_ORDER = 3
TRAIN_DOCS = 400
# The sample is first chosen in so many parts of a language, then among those chosen.
SALTS = 16
# Texts are scored in slices of about this many bytes, some 60 times as many in arrays.
SLICE_BYTES = 1 << 20
START = 10  # the byte taken to stand before a text
UNDETERMINED = "und"


def training_rows(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """lang and text of the sample. The ids sampled are at most train_docs per language."""
    known = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang")).filter(
        (fold(F.col("doc_id")) != 1) & F.col("lang").isNotNull()
    )
    ids = known.withColumn("h", F.xxhash64("doc_id")).withColumn("salt", F.pmod("h", F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        first = W.partitionBy(*keys).orderBy("h", "doc_id")
        ids = ids.withColumn("i", F.row_number().over(first)).filter(F.col("i") <= train_docs)
    ids = ids.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")


def previous(data, offs, k):
    """The byte k places before each byte, START before a text."""
    out = np.full(len(data), START, np.uint8)
    if len(data) > k:
        out[k:] = data[:-k]
    begin = offs[:-1][offs[1:] > offs[:-1]]
    size = np.diff(offs)[offs[1:] > offs[:-1]]
    for j in range(k):
        at = begin[size > j] + j
        out[at] = START
    return out


def grams(data, offs):
    """Every byte (the lowest eight bits) with the MAX_ORDER bytes before it, the nearest lowest."""
    out = data.astype(np.int64)
    for k in range(1, MAX_ORDER + 1):
        out |= previous(data, offs, k).astype(np.int64) << (8 * k)
    return out


def _counts(pdf):
    """Grams of a batch of the sample and how often each language has them."""
    parts = []
    for lang, text in pdf.groupby("lang", sort=True)["text"]:
        data, offs = wd.buffers(pa.array(text, pa.string()))
        for a, b in wd.slices(offs, SLICE_BYTES):
            gram, n = np.unique(grams(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]), return_counts=True)
            parts.append(pd.DataFrame({"lang": lang, "gram": gram, "n": n}))
    return pd.concat(parts) if parts else pd.DataFrame({"lang": [], "gram": [], "n": []})


def find(ordered, wanted):
    """(place, whether it is there) of every wanted number in an ordered array."""
    if not len(ordered):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return at, ordered[at] == wanted


def tree(gram, n):
    """A language's contexts by order, from its grams of full order in order and their counts.

    Of each order: the grams with the logarithms of their counts and the
    contexts with the bits of an escape and the logarithm of what counts are
    divided by, once where coding starts in the context (`start`), once in its
    suffix after an escape from it (`after`).
    """
    levels = []
    for order in range(MAX_ORDER + 1):
        low = gram & ((1 << 8 * (order + 1)) - 1)
        pair, back = np.unique(low, return_inverse=True)
        count = np.bincount(back, n)
        context, first = np.unique(pair >> 8, return_index=True)
        total = np.add.reduceat(count, first)
        distinct = np.diff(np.append(first, len(pair))).astype(float)
        level = {"pair": pair, "count": count, "bits": np.log2(count), "context": context, "total": total, "distinct": distinct}
        level["start"] = shares(total, distinct, 256.0)
        if order:
            up = levels[-1]
            suffix, _ = find(up["context"], context & ((1 << 8 * (order - 1)) - 1))
            same, _ = find(up["pair"], pair & ((1 << 8 * order) - 1))
            excluded = np.add.reduceat(up["count"][same], first)
            level["after"] = shares(up["total"][suffix] - excluded, up["distinct"][suffix] - distinct, 256.0 - distinct)
        levels.append(level)
    return levels


def shares(total, distinct, left):
    """(logarithm of what counts are divided by, bits of the escape) with `left` bytes not excluded.

    With all bytes left seen there is no escape, with none seen only that.
    """
    whole = np.log2(np.maximum(np.where(distinct == left, total, total + distinct), 1.0))
    return whole, np.where((distinct > 0) & (distinct < left), whole - np.log2(np.maximum(distinct, 1.0)), 0.0)


def gram_bits(gram, levels):
    """Bits of the byte of every gram after its context in one language."""
    out, open_ = np.zeros(len(gram)), np.ones(len(gram), bool)
    longer = np.full(len(gram), -1)
    for order in range(MAX_ORDER, -1, -1):
        level = levels[order]
        pair = gram & ((1 << 8 * (order + 1)) - 1)
        context, known = find(level["context"], pair >> 8)
        whole, escape = (x[context] for x in level["start"])
        if order < MAX_ORDER:
            begun = longer >= 0
            above = levels[order + 1]["after"]
            whole, escape = (np.where(begun, x[longer], y) for x, y in zip(above, (whole, escape), strict=True))
        at, seen = find(level["pair"], pair)
        now = open_ & seen
        out[now] += whole[now] - level["bits"][at[now]]
        open_ &= ~seen
        some = open_ & known
        out[some] += escape[some]
        longer = np.where(known, context, -1)
    out[open_] += np.log2(256.0 - levels[0]["distinct"][0])
    return out


def build_model(rows):
    """The trees and tabled code lengths, from (lang, gram, n) rows in any order."""
    rows = pd.DataFrame(rows, columns=["lang", "gram", "n"]).sort_values(["lang", "gram"])
    langs, trees = [], []
    for lang, part in rows.groupby("lang", sort=True):
        langs.append(lang)
        trees.append(tree(part["gram"].to_numpy(np.int64), part["n"].to_numpy(float)))
    known = np.unique(rows["gram"].to_numpy(np.int64))
    return {"langs": langs, "trees": trees, "gram": known, "bits": [gram_bits(known, t) for t in trees]}


def code_lengths(data, offs, model):
    """Bits of every text in every language."""
    gram = grams(data, offs)
    at, tabled = find(model["gram"], gram)
    new = np.flatnonzero(~tabled)
    rare, back = np.unique(gram[new], return_inverse=True)
    out = np.zeros((len(offs) - 1, len(model["langs"])))
    some = np.flatnonzero(np.diff(offs) > 0)
    if len(some):
        for j, (bits, levels) in enumerate(zip(model["bits"], model["trees"], strict=True)):
            cost = bits[at]
            cost[new] = gram_bits(rare, levels)[back]
            out[some, j] = np.add.reduceat(cost, offs[some])
    return out


def predict(column, model):
    """(language, score, bits per byte) of every text of an Arrow column."""
    data, offs = wd.buffers(column)
    size = np.diff(offs)
    n = len(size)
    lang, score, rate = np.full(n, UNDETERMINED, object), np.zeros(n), np.zeros(n)
    if not model["langs"]:
        return lang, score, rate
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    bare = []  # texts without an ASCII letter
    for a, b in wd.slices(offs, SLICE_BYTES):
        part, at = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        seen = np.append(0, np.cumsum(ascii_letter[part], dtype=np.int32))
        bare += (a + np.flatnonzero(seen[at[1:]] == seen[at[:-1]])).tolist()
        bits = code_lengths(part, at, model)
        best = bits.argmin(1)
        least = bits.min(1)
        score[a:b] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
        rate[a:b] = least / np.maximum(1, size[a:b])
        lang[a:b] = np.array(model["langs"], object)[best]
    # A letter of ASCII is seen in the bytes; only texts without one are looked at as text.
    for i in bare:
        if not any(map(str.isalpha, bytes(data[offs[i] : offs[i + 1]]).decode("utf-8", "replace"))):
            lang[i], score[i] = UNDETERMINED, 0.0
    return lang, score, rate


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS):
    """The model, from the counts that Spark makes of the sample's grams."""

    def count(frames):
        for pdf in frames:
            yield _counts(pdf)

    sample = training_rows(docs, train_docs).filter(F.length("text") > 0).select("lang", "text")
    counts = sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return build_model(counts.toArrow().to_pandas())


def _predict_with(model, names):
    def run(batches):
        for batch in batches:
            lang, score, rate = predict(batch.column("text"), model.value)
            out = {c: batch.column(c) for c in names}
            out |= {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score), "bits_per_byte": pa.array(rate)}
            yield pa.RecordBatch.from_pydict(out)

    return run


def identify(docs: DataFrame, model=None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte of every document."""
    model = in_small_batches(docs).sparkSession.sparkContext.broadcast(model or train(docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(
        _predict_with(model, ["doc_id", "held_out"]), kind + ", lang_pred string, score double, bits_per_byte double"
    )


def _known_with(model):
    def run(batches):
        for batch in batches:
            lang, _, _ = predict(batch.column("text").cast(pa.string()), model.value)
            yield batch.filter(pa.array(lang != UNDETERMINED))

    return run


def with_language(docs: DataFrame, model=None) -> DataFrame:
    """The rows of `docs` whose language can be told, all columns kept."""
    model = in_small_batches(docs).sparkSession.sparkContext.broadcast(model or train(docs))
    return docs.mapInArrow(_known_with(model), docs.schema)


def op4_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
