"""Toxicity (operator 1): multiple-instance learning with noisy-or.

A document is a bag of sentences. A sentence's score is a logistic model of its
words, whole and as beginnings of 3 to 7 letters, hashed to a fixed number of
weights. A word counts once in a sentence, a beginning once for each different word
with it, in training as in scoring, so repeated words add nothing. The document's score is the noisy-or of its sentences,
1 - product(1 - p), and only document labels are used in training. Afterwards
the sentence scores tell where the offending sentences are.

The level of the scores is set on a fifth of the sample that the weights have not
seen: all documents' log odds are shifted by one number (`calibration`).

Trained on a bounded sample: the TRAIN_DOCS labelled documents with the smallest
hash of their id, whole texts. Rows of fold 1 are never learned from.

Defined results: a null or text without words is one empty sentence and gets
its score. Labels other than 0 and 1 are ignored; a document labelled twice
counts as toxic if one label says so. Without labels of both kinds every score
is that of the prior.
"""

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, held_out, in_small_batches, table

TRAIN_DOCS = 7500
# Every so many-th of them is not fitted on but sets the scores' level: a share FALSE_ALARMS of the clean ones
# is at the threshold, unless that takes raw scores below LEAST_RAW.
CALIBRATE = 5
FALSE_ALARMS = 0.015
LEAST_RAW = 0.4
HASH_BITS = 20
BEGINNINGS = range(3, 8)
# A feature must occur in this many documents of the sample.
LEAST_DOCS = 4
EPOCHS = 60
RATE = 0.3
PENALTY = 5e-4
PRIOR = -6.0
# Toxic documents are rarer: each weighs up to this much more.
MOST_WEIGHT = 8.0
THRESHOLD = 0.7

# A word, or the end of a sentence.
PIECES = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = frozenset(".!?\n")


def features(word: str):
    """Numbers of a word's features: the word and its beginnings."""
    mask = (1 << HASH_BITS) - 1
    raw = [word.encode() + b"$"] + [word[:k].encode() for k in BEGINNINGS if k <= len(word)]
    return [zlib.crc32(x) & mask for x in raw]


def training_rows(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, toxic, text of the sample: at most `train_docs` ids."""
    ids = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_docs)
    )
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = text.join(F.broadcast(ids), "doc_id")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(train_docs)


def bags(texts):
    """(feature numbers, sentence of each, how many of its words have it, document of each sentence)."""
    cache, numbers, owner, words, sents = {}, [], [], [], []
    for i, text in enumerate(texts):
        owner.append(i)
        open_ = False
        for x in PIECES.findall(text.lower()):
            if x in ENDS:
                if open_:
                    owner.append(i)
                    open_ = False
                continue
            word = cache.get(x)
            if word is None:
                word = cache[x] = len(numbers)
                numbers.append(sorted(set(features(x))))
            words.append(word)
            sents.append(len(owner) - 1)
            open_ = True
    if not words:
        return *(np.zeros(0, np.int64),) * 3, np.array(owner, np.int64)
    # Each word of a sentence once, then its features with their number of words.
    kinds = len(numbers)
    pairs = np.unique(np.array(sents, np.int64) * kinds + np.array(words, np.int64))
    sizes = np.array([len(x) for x in numbers])
    first, flat = np.cumsum(sizes) - sizes, np.concatenate([np.array(x, np.int64) for x in numbers])
    word, sent = pairs % kinds, pairs // kinds
    n = sizes[word]
    at = np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    feature, sent = flat[at], np.repeat(sent, n)
    pairs, count = np.unique(sent << HASH_BITS | feature, return_counts=True)
    return pairs & ((1 << HASH_BITS) - 1), pairs >> HASH_BITS, count, np.array(owner, np.int64)


def fit(texts, labels):
    """(weights, bias): gradient descent on the noisy-or likelihood, AdaGrad steps."""
    size = 1 << HASH_BITS
    w, b = np.zeros(size), PRIOR
    y = np.asarray(labels, np.float64)
    if not (y == 1).any() or not (y == 0).any():
        return w.astype(np.float32), b
    f, s, c, owner = bags(texts)
    docs_with = np.unique(f * len(y) + owner[s]) // len(y)
    keep = np.bincount(docs_with, minlength=size)[f] >= LEAST_DOCS
    f, s, c = f[keep], s[keep], c[keep]
    used, f = np.unique(f, return_inverse=True)
    v, square, square_b = np.zeros(len(used)), np.full(len(used), 1e-4), 1e-4
    weight = np.where(y == 1, np.clip((y == 0).sum() / (y == 1).sum(), 1.0, MOST_WEIGHT), 1.0)
    for _ in range(EPOCHS):
        z = np.bincount(s, v[f] * c, minlength=len(owner)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(owner, np.log1p(-p + 1e-12), minlength=len(y)))
        toxic = np.clip(1 - clean, 1e-9, 1)
        g_doc = np.where(y == 1, -clean / toxic, 1.0) * weight
        g = g_doc[owner] * p
        grad = np.bincount(f, g[s] * c, minlength=len(used)) / len(y) + PENALTY * v
        square += grad**2
        v -= RATE * grad / np.sqrt(square)
        gb = g.sum() / len(y)
        square_b += gb**2
        b -= RATE * gb / np.sqrt(square_b)
    w[used] = v
    return w.astype(np.float32), float(b)


class WordWeights(dict):
    """Sum of the weights of a word's features, computed once per word."""

    def __init__(self, w):
        self.w = w

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        self[word] = value = float(sum(self.w[i] for i in set(features(word))))
        return value


def sentence_scores(text, weights, bias):
    """Scores of the sentences of a lower-cased text, in order, with their words' sums."""
    out, words = [], set()
    get = weights.__getitem__
    for x in PIECES.findall(text):
        if x not in ENDS:
            words.add(x)
        elif words:
            out.append(bias + sum(map(get, words)))
            words = set()
    if words or not out:
        out.append(bias + sum(map(get, words)))
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def noisy_or(p):
    return float(1 - np.prod(1 - p))


def calibration(texts, labels, weights, bias):
    """The shift of log odds by which FALSE_ALARMS of the clean texts reach the threshold; 0 without any."""
    raw = [noisy_or(sentence_scores(t.lower(), weights, bias)) for t, y in zip(texts, labels, strict=True) if y == 0]
    if not raw or not any(labels):
        return 0.0
    level = min(max(float(np.quantile(raw, 1 - FALSE_ALARMS)), LEAST_RAW), 1 - 1e-6)
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - np.log(level / (1 - level)))


def shifted(score, shift):
    """A score with its log odds shifted."""
    up = score * np.exp(shift)
    return float(up / (up + 1 - score))


def places(text):
    """(first, end) in code points of every sentence, as sentence_scores counts them."""
    out, first, end = [], None, 0
    for m in PIECES.finditer(text):
        if m.group() in ENDS:
            if first is not None:
                out.append((first, m.end()))
                first = None
        else:
            first = m.start() if first is None else first
            end = m.end()
    if first is not None or not out:
        out.append((first or 0, end))
    return out


def _train(batches):
    rows = pd.concat([b.to_pandas() for b in batches] or [pd.DataFrame({"doc_id": [], "toxic": [], "text": []})])
    rows = rows.sort_values(["doc_id", "text"], kind="stable")
    apart = np.arange(len(rows)) % CALIBRATE == CALIBRATE - 1
    seen, unseen = rows[~apart], rows[apart]
    w, b = fit(list(seen["text"]), list(seen["toxic"]))
    shift = calibration(list(unseen["text"]), list(unseen["toxic"]), WordWeights(w), b) if w.any() else 0.0
    yield pa.RecordBatch.from_pydict(
        {"w": pa.array([w.tobytes()], pa.binary()), "b": pa.array([b], pa.float64()), "shift": pa.array([shift], pa.float64())}
    )


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS):
    """(weights, bias, shift of log odds); the bounded sample is fitted in one task."""
    sample = training_rows(docs, labels, train_docs).coalesce(1)
    row = sample.mapInArrow(_train, "w binary, b double, shift double").first()
    if row is None:
        return np.zeros(1 << HASH_BITS, np.float32), PRIOR, 0.0
    return np.frombuffer(row["w"], np.float32), row["b"], row["shift"]


def _score_with(model):
    def run(batches):
        w, b, shift = model.value
        weights = WordWeights(w)
        for batch in batches:
            out = {c: [] for c in ("score", "n_toxic", "worst_at", "worst_end")}
            for text in batch.column("text").to_pylist():
                # Lower-casing can change a text's length in rare scripts; places are of the text as given.
                p = sentence_scores(text.lower(), weights, b)
                total = shifted(noisy_or(p), shift)
                first = end = None
                if total >= THRESHOLD:
                    spots = places(text)
                    k = int(p.argmax())
                    first, end = spots[min(k, len(spots) - 1)]
                out["score"].append(total)
                out["n_toxic"].append(int((p >= 0.5).sum()))
                out["worst_at"].append(first)
                out["worst_end"].append(end)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(out["score"], pa.float64()),
                    "predicted": pa.array([int(x >= THRESHOLD) for x in out["score"]], pa.int32()),
                    "n_toxic": pa.array(out["n_toxic"], pa.int32()),
                    "worst_at": pa.array(out["worst_at"], pa.int64()),
                    "worst_end": pa.array(out["worst_end"], pa.int64()),
                }
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, model=None) -> DataFrame:
    """Per document: score, prediction, sentences over 0.5, and the place of the worst one."""
    model = in_small_batches(docs).sparkSession.sparkContext.broadcast(model or train(docs, labels))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        _score_with(model),
        "doc_id long, held_out boolean, score double, predicted int, n_toxic int, worst_at long, worst_end long",
    )


def op1_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
