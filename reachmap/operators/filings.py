"""Filings: consumer filter, block joins and the maximum per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TECH_CLASSES
from ..functions.joins import with_group_totals
from ..functions.speeds import tech_class

KEY = ["block_code", "hoconum", "tech_code"]


def consumer_filings(filings: DataFrame) -> DataFrame:
    """Filings for consumers. A NaN speed is missing: it would pass every threshold."""
    kept = filings.filter(F.col("consumer") == 1).drop("consumer")
    missing = F.lit(None).cast("double")
    return kept.withColumns(
        {c: F.nanvl(F.col(c), missing) for c in ("max_ad_down", "max_ad_up") if c in kept.columns}
    )


def filings_with_pop(filings: DataFrame, blocks: DataFrame) -> DataFrame:
    """Consumer filings with the population of their block, null if unknown.

    Both sides are plain scans under one shuffle each, which is the shape the
    adaptive skew join can split for a hot block.
    """
    pop = blocks.select(F.col("geoid10").alias("block_code"), "pop")
    return consumer_filings(filings).join(pop, "block_code", "left")


def filings_block_outer(filings: DataFrame, blocks: DataFrame) -> DataFrame:
    """Consumer filings and blocks without any, missing values as 0.

    Written as filings plus the blocks nobody filed for: that is the full outer
    join, but no task has to hold all filings of one block, because the anti
    join only needs each filed block once.
    """
    f = consumer_filings(filings)
    filed = f.select(F.col("block_code").alias("geoid10")).distinct()
    bare = blocks.select("geoid10").join(filed, "geoid10", "left_anti")
    return f.unionByName(
        bare.withColumnRenamed("geoid10", "block_code"), allowMissingColumns=True
    ).fillna(0, subset=["hoconum", "tech_code", "max_ad_down", "max_ad_up"])


def max_speed_by(filings: DataFrame, keys) -> DataFrame:
    """Maximum speeds per key over all filings of it.

    The maxima of download and upload may come from different filings, so speed
    thresholds must be tested on this result and never pushed below it.
    """
    down = "max_down" if "max_down" in filings.columns else "max_ad_down"
    up = "max_up" if "max_up" in filings.columns else "max_ad_up"
    complete = filings
    for k in keys:
        complete = complete.filter(F.col(k).isNotNull())
    return complete.groupBy(*keys).agg(
        F.max(down).alias("max_down"), F.max(up).alias("max_up")
    )


def collapse_filings(filings: DataFrame) -> DataFrame:
    """Consumer filings as one row per (block, provider, technology), nulls kept.

    The result is filings again, with the maxima as its speeds. A maximum of
    maxima is the maximum, so every operator gives the same result on it; a job
    with several outputs reads the raw filings once and continues from this.
    """
    return (
        consumer_filings(filings)
        .groupBy(*KEY)
        .agg(F.max("max_ad_down").alias("max_ad_down"), F.max("max_ad_up").alias("max_ad_up"))
        .withColumn("consumer", F.lit(1))
    )


def max_speed_block_provider_tech(filings: DataFrame) -> DataFrame:
    return max_speed_by(consumer_filings(filings), KEY)


def max_speed_block_provider(filings: DataFrame) -> DataFrame:
    return max_speed_by(max_speed_block_provider_tech(filings), KEY[:2])


def max_speed_block_provider_class(filings: DataFrame, classes=TECH_CLASSES) -> DataFrame:
    d1 = max_speed_block_provider_tech(filings).withColumn(
        "tech_class", tech_class("tech_code", classes)
    )
    return max_speed_by(d1, ["block_code", "hoconum", "tech_class"])


def max_speed_window(filings: DataFrame) -> DataFrame:
    """Every consumer filing with the maxima of its (block, provider, technology)."""
    return with_group_totals(
        consumer_filings(filings),
        KEY,
        max_down=F.max("max_ad_down"),
        max_up=F.max("max_ad_up"),
    )
