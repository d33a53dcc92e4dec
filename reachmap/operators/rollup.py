"""Population-weighted mean provider counts per area of a key prefix."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TECH_CLASSES, TIERS, combo_names
from ..functions.joins import in_tasks, with_group_totals
from ..functions.keys import prefix
from ..session import cut
from .numprov import NARROW_ROWS, combo_sums, mask_histogram


def prefix_pop(blocks: DataFrame, length: int, name: str) -> DataFrame:
    """Population per key prefix."""
    return blocks.groupBy(prefix("geoid10", length).alias(name)).agg(
        F.coalesce(F.sum("pop"), F.lit(0)).alias("pop")
    )


def block_with_prefix_pop(blocks: DataFrame, length: int, name: str, total: str) -> DataFrame:
    """Each block with the population of its area."""
    keyed = blocks.select("geoid10", "pop", prefix("geoid10", length).alias(name))
    return with_group_totals(keyed, name, **{total: F.sum("pop")})


def weighted_numprov(
    filings: DataFrame,
    blocks: DataFrame,
    length: int,
    name: str,
    tiers=TIERS,
    classes=TECH_CLASSES,
) -> DataFrame:
    """Mean providers per person, one decimal, by (area, tier) and combination.

    sum(pop * count_k) over blocks equals the sum, over the masks meeting k, of
    population times providers with that mask. So only a histogram of masks per
    area is kept, at most 2^classes rows per (area, tier), and the wide sums run
    over that. An area without people keeps its undivided sum of 0, an area the
    block master does not know gets 0, both with is_populated false.
    """
    histogram = mask_histogram(filings, tiers, classes)
    return weighted_of(histogram, blocks, length, name, tiers, classes)


def area_weights(histogram: DataFrame, blocks: DataFrame, length: int, name: str) -> DataFrame:
    """(area, tier, mask, w): people times providers with the mask over the blocks of each area.

    A written table. A filed block may be missing from the master; it weighs nothing. The
    master's people are the hash map's, so the histogram's rows are not sorted.
    """
    known = cut(blocks.select("geoid10", F.coalesce("pop", F.lit(0)).alias("pop")), "block-people")
    rows = in_tasks(histogram, histogram.count() + known.count(), NARROW_ROWS, "geoid10")
    joined = rows.join(known.hint("shuffle_hash"), "geoid10", "left")
    weights = joined.groupBy(prefix("geoid10", length).alias(name), "tier", "mask").agg(
        F.coalesce(F.sum(F.col("n") * F.col("pop")), F.lit(0)).alias("w")
    )
    return cut(weights, "area-weights")


def weighted_of(
    histogram: DataFrame,
    blocks: DataFrame,
    length: int,
    name: str,
    tiers=TIERS,
    classes=TECH_CLASSES,
    weights: DataFrame | None = None,
) -> DataFrame:
    """`weighted_numprov` from a mask histogram, which is counted: give it as a table.

    `weights` are `area_weights` of the same or of smaller areas, named (area, ...), where
    they are known already: then nothing of the blocks but their areas is read again.
    """
    if weights is None:
        weights = area_weights(histogram, blocks, length, "area")
    weights = weights.select(prefix("area", length).alias(name), "tier", "mask", "w")
    # every area of the master is a row at every tier
    weights = weights.groupBy(name, "tier", "mask").agg(F.sum("w").alias("w"))
    own = blocks.select(prefix("geoid10", length).alias(name)).distinct()
    names = F.array(*[F.lit(t.name) for t in tiers])
    none = own.select(name, F.explode(names).alias("tier"), F.lit(0).alias("mask"), F.lit(0).cast("bigint").alias("w"))
    weights = weights.unionByName(none)
    sums = (
        weights.repartition(name)
        .groupBy(name, "tier")
        .agg(*combo_sums("w", classes))
    )
    total = prefix_pop(blocks, length, name)
    ratios = [
        f"if(pop > 0, bround(`{n}` / pop, 1), cast(`{n}` as double)) as `{n}`"
        for n in combo_names(classes)
    ]
    return sums.join(total, name, "left").selectExpr(
        name, "tier", *ratios, "coalesce(pop > 0, false) as is_populated"
    )
