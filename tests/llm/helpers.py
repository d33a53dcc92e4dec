"""Small tables for the tests of the training-data operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
EXTRA = ("key", "digest", "n", "size", "copies", "block", "_key", "_row", "_mix_source", "_MIX_RATE", "shard", "score", "host", "templates", "base")


def documents(spark, rows, extra=False):
    """Rows of (doc_id, text) or of all five columns; with `extra`, clashing columns beside."""
    full = [(*r, *(None, "s", None)[len(r) - 2 :])[:5] if len(r) < 5 else r for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for c in EXTRA:
            df = df.withColumn(c, F.lit("x"))
    return df


def words(n, seed, alphabet="abcdefghij"):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(2, 6))) for _ in range(n)]


def odd_rows():
    """Nulls, empty and very long texts, repeated rows."""
    long = " ".join(words(30_000, 1))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "One."), (4, "One."), (5, long), (6, long), (None, "One."), (None, None),
        (7, "£ ½ — ☃"), (8, "ein kurzer Satz ohne Belang"),
    ]


def rows_of(df, *columns):
    out = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(out, key=repr)
