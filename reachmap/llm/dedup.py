"""Exact dedup (operator 10): skew-safe combining of equal normalised texts.

Only digests travel for all rows. Texts travel for digests that occur more than
once, and there every stage compares them in full: equal rows of a task are
combined first (the map side of the first aggregate), then within a digest and
salt, then the winners of all salts.

Defined results: a null text counts as empty. A group whose ids are all null
keeps one row under a null id; otherwise nulls never win. Of repeated rows with
the winning id, one is kept. An empty table gives no rows. Other columns are
not looked at.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import table, text_of

SALTS = 64
# Repeated digests are broadcast up to this many rows of about 100 bytes; above it they are shuffled.
BROADCAST_ROWS = 200_000


def normalised(text: Column) -> Column:
    """Each run of white space as one space.

    Only runs that change are replaced: one that begins with another white-space
    character, or a space followed by more.
    """
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def exact_duplicates(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    `digest` groups candidates; texts with equal digests are still compared.
    """
    texts = docs.select("doc_id", normalised(text_of(docs)).alias("body"))
    texts = texts.select("doc_id", "body", digest(F.col("body")).alias("digest"))
    rows = cut(texts.select("doc_id", "digest", sha256(F.col("body")).alias("text_sha256")), "digests")
    repeated = cut(
        rows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "repeated"
    )
    repeated = _small(repeated)
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")
    winners = (
        texts.join(repeated, "digest", "left_semi")
        .groupBy("digest", salt, "body")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    classes = cut(
        winners.groupBy("digest", "body").agg(
            F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        ),
        "classes",
    )
    mixed = cut(
        classes.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "mixed"
    )
    if mixed.isEmpty():
        found = rows.join(classes.drop("body"), "digest", "left")
    else:  # different texts share a digest: there the text itself is the key
        mixed = _small(mixed)
        plain = rows.join(mixed, "digest", "left_anti").join(
            classes.join(mixed, "digest", "left_anti").drop("body"), "digest", "left"
        )
        told_apart = (
            texts.join(mixed, "digest", "left_semi")
            .join(classes, ["digest", "body"])
            .withColumn("text_sha256", sha256(F.col("body")))
        )
        found = plain.unionByName(told_apart.select(*plain.columns))
    single = F.col("group_size").isNull()
    found = found.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
    )
    wins = (F.col("group_size") > 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rest = found.filter(~wins).withColumn("kept", F.col("group_size") == 1)
    # Rows with the winning id are alike in every column, so their number says all.
    best = (
        found.filter(wins)
        .groupBy(*found.columns)
        .agg(F.count("*").alias("n"))
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        .withColumn("kept", F.col("i") == 1)
    )
    return rest.unionByName(best.select(*rest.columns)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op10_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
