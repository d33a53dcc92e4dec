"""Block flags and row filters on keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ISLAND_STATES, LARGE_PROVIDERS
from ..functions.keys import state_of


def land_blocks(block_geom: DataFrame) -> DataFrame:
    return block_geom.filter(F.col("aland10") > 0)


def water_only_blocks(block_geom: DataFrame) -> DataFrame:
    return block_geom.filter(F.col("aland10") == 0)


def h2only_undev(block_hu_pop: DataFrame, block_geom: DataFrame) -> DataFrame:
    """1 = water only, 2 = neither housing nor people, 0 = otherwise.

    A block without a water row is not water: the comparison with the missing
    land area has to be true there, hence the null-safe one.
    """
    water = water_only_blocks(block_geom).select(
        F.col("geoid10").alias("block_fips"), "aland10"
    )
    empty = (F.col("hu2016") == 0) & (F.col("pop2016") == 0)
    flag = (
        F.when(F.col("aland10").eqNullSafe(0), 1)
        .when(~F.col("aland10").eqNullSafe(0) & empty, 2)
        .otherwise(0)
    )
    return block_hu_pop.join(water, "block_fips", "left").select(
        "block_fips", flag.cast("int").alias("h2only_undev")
    )


def in_island_state(key, states=ISLAND_STATES) -> Column:
    return state_of(key).isin(*states)


def large_provider(col, providers=LARGE_PROVIDERS) -> Column:
    return F.col(col).cast("int").isin(*providers)
