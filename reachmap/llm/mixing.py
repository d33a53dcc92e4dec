"""Mixing sources to target weights (operator 8), with DataFrame functions only.

Sizes are summed per source. Targets share all words by weight; a target stops
at `cap` times its source's words and the excess goes to the others by weight.
Each document is emitted floor(rate) times, and once more with the fraction as
the probability; the draw is a hash of seed and id, so reruns agree.

Defined results: a null text has size 0, a null source is a source, last in
order. A source without words has target 0 and its documents are not emitted.
Repeated rows draw alike. An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut
from .common import fresh, table, text_of

CAP = 3
CYCLE = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, cap: int = CAP, cycle: int = CYCLE) -> DataFrame:
    """One row per source: source, source_size, target.

    `sizes` has source and size. Sources are ordered by code point, null last,
    and weigh 1, 2, ... `cycle`, repeating. By rising cap / weight a source
    reaches its cap as long as its share of what the earlier ones left is above
    it. The windows run over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    per = (
        per.withColumn("w", (F.row_number().over(order) - 1) % cycle + 1)
        .withColumn("cap", F.col("source_size") * cap)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn(
            "left_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
        )
        .withColumn(
            "full",
            F.col("cap").cast("double") * F.col("left_w")
            <= F.col("left_words").cast("double") * F.col("w"),
        )
    )
    open_words = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    per = per.withColumn("open_words", open_words).withColumn("open_w", open_w)
    share = F.col("open_words").cast("double") * F.col("w") / F.col("open_w")
    return per.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 32 bits of a digest of seed and id."""
    bits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 8)
    return F.conv(bits, 16, 10).cast("double") / F.lit(4294967296.0)


def with_copies(sized: DataFrame, per: DataFrame, seed: str = SEED) -> DataFrame:
    """`sized` (doc_id, source, ...) with source_size, target and copies."""
    per = per.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    more = (draw(F.col("doc_id"), seed) < F.col("_rate") - F.floor("_rate")).cast("int")
    return (
        sized.join(per, sized["source"].eqNullSafe(per["_source"]), "left")
        .withColumn("_rate", rate)
        .withColumn("copies", (F.floor("_rate") + more).cast("int"))
        .drop("_source", "_rate")
    )


def _sizes(docs: DataFrame) -> DataFrame:
    return cut(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(text_of(docs)).alias("size")),
        "sizes",
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document."""
    sizes = _sizes(docs)
    per = cut(targets(sizes), "targets")
    return with_copies(sizes, per).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    source, size, target, rate, copy = (fresh(docs, f"_mix_{n}") for n in ("source", "size", "target", "rate", "copy"))
    per = cut(targets(_sizes(docs)), "targets").toDF(source, size, target)
    names = docs.columns
    share = F.when(F.col(size) > 0, F.col(target) / F.col(size)).otherwise(0.0)
    times = (F.floor(rate) + (draw(F.col("doc_id")) < F.col(rate) - F.floor(rate)).cast("int")).cast("int")
    return (
        docs.join(per, docs["source"].cast("string").eqNullSafe(per[source]), "left")
        .withColumn(rate, share)
        .withColumn(copy, times)
        .filter(F.col(copy) >= 1)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy))))
        .select(*[f"`{c}`" for c in names])
    )


def op8_mixing(spark, sf_dir):
    return mix_report(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap,
         sum(source_size) OVER () AS total FROM p
), q AS (
  SELECT *, total - coalesce(sum(cap) OVER before, 0) AS left_words,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS left_w
  FROM r WINDOW before AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (SELECT *, cap::DOUBLE * left_w <= left_words::DOUBLE * w AS "full" FROM q),
o AS (
  SELECT *, total - coalesce(sum(CASE WHEN "full" THEN cap END) OVER (), 0) AS open_words,
         sum(CASE WHEN NOT "full" THEN w END) OVER () AS open_w FROM f
), t AS (
  SELECT source, source_size,
         CASE WHEN "full" THEN cap::DOUBLE ELSE open_words::DOUBLE * w / open_w END AS target FROM o
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), n AS (SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM c)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM n
"""
