"""Filings and blocks derived from the star-schema test tables.

The column rules are listed in FIXTURES.md. Nothing here is a fixed-size
input: every row comes from a row of the given tables.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import county_of, tract_of
from .schemas import GEOM

# fixed values: the technology code at position l_partkey % 15
TECH_CODES = (10, 11, 12, 13, 40, 41, 42, 43, 0, 20, 30, 90, 50, 60, 70)
GRID_WIDTH = 40
# the test data has states 00-24: these stand for the island areas and PR
ISLANDS = ("20", "21", "22", "23")
CARTO_EXTRA_STATE = "24"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customer_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey with its block code.

    A tract holds 40,000 consecutive customer keys of one state and residue, so
    block codes stay unique and tracts stay small however many customers exist.
    """
    keyed = table(spark, sf_dir, "customer").selectExpr(
        "*",
        "lpad(cast(c_nationkey as string), 2, '0') as state_fips",
        "c_custkey % 4 as t",
        "c_custkey div 4 as q",
    )
    return keyed.selectExpr(
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        "state_fips",
        """concat(
            state_fips,
            lpad(cast(t div 2 as string), 3, '0'),
            lpad(cast((q div 10000) * 4 + t as string), 6, '0'),
            lpad(cast(q % 10000 as string), 4, '0')
        ) as geoid10""",
        """if(c_nationkey = 24, 0L, cast(floor(greatest(c_acctbal, 0D)) as bigint)) as pop""",
        "c_custkey % 50 as hu",
        "if(c_custkey % 13 = 0, 0L, c_custkey * 1000) as aland10",
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block master."""
    nation = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as c_nationkey", "n_regionkey"
    )
    return (
        _customer_blocks(spark, sf_dir)
        .join(nation, "c_nationkey")
        .selectExpr(
            "geoid10",
            "pop",
            "hu",
            "c_custkey % 40 as hh",
            "if(c_custkey % 11 = 0, lpad(cast(c_custkey % 3 as string), 4, '0'), null) as aianhhcc",
            "concat('S', state_fips) as stateabbr",
            """cast(case when aland10 = 0 then 1 when hu = 0 and pop = 0 then 2 else 0 end
                as tinyint) as h2only_undev""",
            "state_fips",
            "substring(geoid10, 1, 5) as county_fips",
            "if(c_custkey % 5 = 0, null, concat('M', cast(n_regionkey as string))) as cbsa_code",
            "concat(state_fips, cast(c_custkey % 2 as string)) as cdist_id",
            "if(c_custkey % 11 = 0, concat('T', cast(c_custkey % 3 as string)), null) as tribal_id",
            "if(c_custkey % 7 = 0, '', concat('P', cast(c_custkey % 20 as string))) as cplace_id",
            "if(c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'MACHINERY'), 'U', 'R') as urban_rural",
            "if(c_custkey % 11 = 0, 'T', 'N') as tribal_non",
        )
    )


def block_hu_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_blocks(spark, sf_dir).selectExpr(
        "geoid10 as block_fips", "hu as hu2016", "pop as pop2016"
    )


def large_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All blocks, most without one zoom or both."""
    return _customer_blocks(spark, sf_dir).selectExpr(
        "geoid10 as block_fips",
        "if(c_custkey % 29 = 0, cast(5 + c_custkey % 6 as int), null) as x_zoom",
        "if(c_custkey % 29 = 0 or c_custkey % 31 = 0, cast(5 + c_custkey % 5 as int), null) as y_zoom",
    )


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as l_orderkey", "o_custkey as c_custkey"
    )
    order_block = orders.join(
        _customer_blocks(spark, sf_dir).select("c_custkey", "geoid10"), "c_custkey"
    )
    codes = ", ".join(str(c) for c in TECH_CODES)
    v = "cast((l_orderkey * 31 + l_partkey * 17) % 1200 as double)"
    return (
        table(spark, sf_dir, "lineitem")
        .join(order_block.hint("merge"), "l_orderkey")
        .selectExpr(
            """if(l_suppkey % 10 = 0 and c_custkey % 97 = 0,
                concat('99', substring(geoid10, 3, 13)), geoid10) as block_code""",
            # blocks of every 17th customer have business filings only
            "if(l_returnflag = 'R' or c_custkey % 17 = 0, 0, 1) as consumer",
            "if(l_orderkey % 89 = 0, null, cast(l_suppkey + 130000 as int)) as hoconum",
            f"if(l_orderkey % 83 = 0, null, array({codes})[cast(l_partkey % 15 as int)]) as tech_code",
            """case when l_orderkey % 79 = 0 then null
                when l_linenumber = 1 then l_quantity / 10 else l_extendedprice / 100 end as max_ad_down""",
            f"""case when l_orderkey % 73 = 0 then double('NaN')
                when l_linenumber <= 3 then {v} / 40 else {v} end as max_ad_up""",
        )
    )


def block_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with their place on a lattice: geoid10, aland10, cx, cy.

    The place follows the rank of the block code. The rank is the number of
    blocks in earlier counties and earlier tracts of the county plus the rank
    within the tract; a tract has at most 10,000 blocks and there are 50
    counties, so no window holds more than the tracts of one county.
    """
    b = _customer_blocks(spark, sf_dir).selectExpr(
        "geoid10",
        "aland10",
        "substring(geoid10, 1, 11) as tract",
        "substring(geoid10, 1, 5) as county",
    )
    before = "rows between unbounded preceding and 1 preceding"
    tracts = b.groupBy("county", "tract").agg(F.count("*").alias("n"))
    counties = (
        tracts.groupBy("county")
        .agg(F.sum("n").alias("n"))
        .selectExpr(
            "county",
            f"coalesce(sum(n) over (partition by 0 order by county {before}), 0) as county_base",
        )
    )
    base = tracts.selectExpr(
        "county",
        "tract",
        f"coalesce(sum(n) over (partition by county order by tract {before}), 0) as tract_base",
    ).join(counties, "county")
    return (
        b.drop("county")
        .join(base.selectExpr("tract", "county_base + tract_base as base"), "tract")
        .selectExpr(
            "geoid10",
            "aland10",
            "base + row_number() over (partition by tract order by geoid10) - 1 as rn",
        )
        .selectExpr(
            "geoid10",
            "aland10",
            f"cast(rn % {GRID_WIDTH} as double) as cx",
            f"cast(rn div {GRID_WIDTH} as double) as cy",
        )
    )


def block_geom(spark: SparkSession, sf_dir: str, lonlat: bool = False) -> DataFrame:
    """Blocks with a unit-square polygon, on the lattice or in degrees."""
    x, y = ("-120D + 0.01D * ({})", "30D + 0.01D * ({})") if lonlat else ("{}", "{}")
    corners = ", ".join(
        f"struct({x.format(cx)} as x, {y.format(cy)} as y)"
        for cx, cy in (
            ("cx", "cy"), ("cx + 1", "cy"), ("cx + 1", "cy + 1"), ("cx", "cy + 1"), ("cx", "cy")
        )
    )
    return block_cells(spark, sf_dir).select(
        "geoid10", "aland10", F.expr(f"array(array(array({corners})))").cast(GEOM).alias("geom")
    )


def carto_tract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generalized mainland tracts: the bounding rectangle of each tract's blocks."""
    return _rectangles(spark, sf_dir, tract_of("geoid10"), "1400000US").filter(
        ~F.substring("geo_id", 10, 2).isin(*ISLANDS, CARTO_EXTRA_STATE)
    )


def extra_tract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generalized tracts of the state which comes in a file of its own."""
    return _rectangles(spark, sf_dir, tract_of("geoid10"), "1400000US").filter(
        F.substring("geo_id", 10, 2) == CARTO_EXTRA_STATE
    )


def carto_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generalized counties outside the islands."""
    return _rectangles(spark, sf_dir, county_of("geoid10"), "0500000US").filter(
        ~F.substring("geo_id", 10, 2).isin(*ISLANDS)
    )


def _rectangles(spark: SparkSession, sf_dir: str, key: Column, head: str) -> DataFrame:
    box = (
        block_cells(spark, sf_dir)
        .groupBy(key.alias("key"))
        .agg(
            F.min("cx").alias("x0"),
            F.min("cy").alias("y0"),
            (F.max("cx") + 1).alias("x1"),
            (F.max("cy") + 1).alias("y1"),
        )
    )
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in corners])
    return box.select(
        F.concat(F.lit(head), "key").alias("geo_id"),
        F.array(F.array(ring)).cast(GEOM).alias("geom"),
    )
