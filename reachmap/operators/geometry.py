"""Feature bounds, areas, size classes and the assembly of feature tables."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import BBOX_OVERRIDES, BIG_TRACT_M2, ISLAND_STATES
from ..functions import geom as G
from ..functions.joins import in_tasks, spread_join
from ..functions.keys import county_of, tail, tract_of
from ..session import by_key, cut
from . import dissolve
from .flags import in_island_state, land_blocks

BOX = ("minx", "miny", "maxx", "maxy")
# Rows of a provider and a side that one task unfolds and sums.
FOOTPRINT_ROWS = 500_000


def feature_bounds(features: DataFrame, *keep: str, geom: str = "geom") -> DataFrame:
    return features.select(*keep, *G.bounds(F.col(geom)))


def group_bounds(bounds: DataFrame, *keys: str) -> DataFrame:
    """Bounds of the union of features; no geometry is shuffled."""
    return bounds.groupBy(*keys).agg(
        F.min("minx").alias("minx"),
        F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"),
        F.max("maxy").alias("maxy"),
    )


def circle_bounds(features: DataFrame, *keys: str, geom: str = "geom") -> DataFrame:
    """Boxes of groups of features with the shortest interval of longitudes on the circle.

    A ring, followed across the antimeridian, is an arc; a group's box is what is left
    of the circle without the widest gap between arcs. Arcs meet in whole degrees
    first, so a group takes 360 rows at most, whatever its size (gaps inside one degree
    do not count). Of equal gaps the one at the antimeridian wins, so a box that
    needs no crossing is the plain one. A box that crosses starts west of -180.
    """
    rings = features.select(*keys, F.explode(F.flatten(geom)).alias("ring")).filter(F.size("ring") > 0)
    unrolled = F.transform(G.unwrapped(F.col("ring")), lambda p: p["x"])
    lats = F.transform("ring", lambda p: p["y"])
    arcs = rings.select(
        *keys,
        F.array_min(unrolled).alias("west"),
        F.array_max(unrolled).alias("east"),
        F.array_min(lats).alias("south"),
        F.array_max(lats).alias("north"),
    )
    # A ring of a whole turn or more, as around a pole, is all of the circle.
    round_ = F.col("east") - F.col("west") >= 360
    turns = F.when(round_, 0).otherwise(360.0 * F.floor((F.col("west") + 180) / 360))
    arcs = arcs.withColumns(
        {
            "west": F.when(round_, -180.0).otherwise(F.col("west") - turns),
            "east": F.when(round_, 180.0).otherwise(F.col("east") - turns),
        }
    )
    # What lies beyond +180 belongs to the circle's beginning.
    degree = F.explode(F.sequence(F.floor("west"), F.greatest(F.floor("west"), F.ceil("east") - 1)))
    pieces = arcs.withColumn("d", degree).select(
        *keys,
        "south",
        "north",
        F.when(F.col("d") >= 180, F.col("d") - 360).otherwise(F.col("d")).alias("d"),
        (F.greatest("west", "d") - F.when(F.col("d") >= 180, 360.0).otherwise(0.0)).alias("low"),
        (F.least("east", F.col("d") + 1) - F.when(F.col("d") >= 180, 360.0).otherwise(0.0)).alias("high"),
    )
    cells = pieces.groupBy(*keys, "d").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("south").alias("south"), F.max("north").alias("north")
    )
    own = Window.partitionBy(*keys).orderBy("d")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("high").over(own), F.max("high").over(whole) - 360)
    gaps = cells.withColumns({"before": before, "first": F.lag("high").over(own).isNull()})
    # The widest gap; the one at the antimeridian first among equals.
    widest = F.struct(
        F.greatest(F.col("low") - F.col("before"), F.lit(0.0)).alias("gap"), F.col("first").cast("int").alias("first"), "low", "before"
    )
    boxes = gaps.groupBy(*keys).agg(
        F.max(widest).alias("w"), F.min("south").alias("miny"), F.max("north").alias("maxy")
    )
    crosses = F.col("w.first") == 0
    return boxes.select(
        *keys,
        (F.col("w.low") - F.when(crosses, 360.0).otherwise(0.0)).alias("minx"),
        "miny",
        (F.col("w.before") + F.when(crosses, 0.0).otherwise(360.0)).alias("maxx"),
        "maxy",
    )


def bbox_overrides(spark: SparkSession, overrides=BBOX_OVERRIDES) -> DataFrame:
    rows = [(layer, geoid, *box) for layer, geoid, box in overrides]
    return spark.createDataFrame(
        rows, "layer string, geoid string, o_minx double, o_miny double, o_maxx double, o_maxy double"
    )


def bbox_override(bounds: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace the boxes of areas across the antimeridian, by (layer, geoid).

    The override table is a handful of constants, so it is broadcast.
    """
    joined = bounds.join(F.broadcast(overrides), ["layer", "geoid"], "left")
    return joined.withColumns({c: F.coalesce(f"o_{c}", c) for c in BOX}).drop(
        *[f"o_{c}" for c in BOX]
    )


def mercator_features(features: DataFrame, geom: str = "geom") -> DataFrame:
    return features.withColumn(geom, G.map_points(F.col(geom), G.mercator))


def tract_area(block_geom: DataFrame) -> DataFrame:
    """Web-Mercator area of the land blocks of each tract.

    Blocks of a tract do not overlap, so the area of their union is the sum of
    their areas and no union has to be built for it.
    """
    return (
        land_blocks(block_geom)
        .dropDuplicates(["geoid10"])
        .select(
            tract_of("geoid10").alias("tract_id"),
            G.area(G.map_points(F.col("geom"), G.mercator)).alias("area"),
        )
        .groupBy("tract_id")
        .agg(F.sum("area").alias("area"))
    )


def big_tracts(areas: DataFrame, threshold: float | Column = BIG_TRACT_M2) -> DataFrame:
    return areas.filter(F.col("area") > threshold)


def notbig_tracts(areas: DataFrame, threshold: float | Column = BIG_TRACT_M2) -> DataFrame:
    return areas.filter(F.col("area") <= threshold)


def blocks_in_big_tracts(
    block_geom: DataFrame, areas: DataFrame, threshold: float | Column = BIG_TRACT_M2
) -> DataFrame:
    keyed = block_geom.withColumn("tract_id", tract_of("geoid10"))
    big = big_tracts(areas, threshold).select("tract_id")
    return spread_join(keyed, big, "tract_id", "left_semi")


def large_blocks_zoom(block_geom: DataFrame, large_blocks: DataFrame) -> DataFrame:
    """Listed blocks with the smaller of their two zooms."""
    zooms = large_blocks.select(
        F.col("block_fips").alias("geoid10"), F.least("x_zoom", "y_zoom").alias("min_zoom")
    )
    return block_geom.join(zooms, "geoid10")


def provider_pairs(filings: DataFrame) -> DataFrame:
    """(hoconum, geoid10): who files for which block, each pair once."""
    known = (F.col("consumer") == 1) & F.col("hoconum").isNotNull() & F.col("block_code").isNotNull()
    return filings.filter(known).select("hoconum", F.col("block_code").alias("geoid10")).distinct()


def provider_blocks(filings: DataFrame, block_geom: DataFrame) -> DataFrame:
    """(hoconum, county_fips, geoid10, geom): the blocks each provider files for.

    A block filed under several technologies counts once. The distinct pairs
    and the geometry meet right after one shuffle each, so the adaptive skew
    join can split a block with very many providers.
    """
    return provider_pairs(filings).join(block_geom.select("geoid10", "geom"), "geoid10").select(
        "hoconum", county_of("geoid10").alias("county_fips"), "geoid10", "geom"
    )


def footprint_edges(filings: DataFrame, block_geom: DataFrame, grid: int = dissolve.GRID) -> DataFrame:
    """(hoconum, county_fips, x1, y1, x2, y2, mult): outlines of providers' blocks, by topology.

    An edge bounds a provider's area in a county when the blocks on its two sides do not
    cancel. A block's providers are one list, which goes to each of its sides; sides meet
    by their place, and their lists unfold there. So no row of one provider and one edge
    passes a shuffle. A list is no longer than there are providers; tasks are as many as
    the lists will unfold to.
    """
    up = "x1 < x2 or (x1 = x2 and y1 < y2)"
    side = [f"if({up}, {a}, {b}) as {n}" for a, b, n in (("x1", "x2", "lx"), ("y1", "y2", "ly"), ("x2", "x1", "hx"), ("y2", "y1", "hy"))]
    ends = ["lx", "ly", "hx", "hy"]
    half = dissolve.feature_edges(block_geom.select("geoid10", "geom"), "geoid10", grid=grid)
    half = cut(half.selectExpr("geoid10", f"if({up}, 1L, -1L) as way", *side), "half-edges")
    lists = provider_pairs(filings).groupBy("geoid10").agg(F.collect_list("hoconum").alias("providers"))
    lists = cut(lists, "block-providers")
    length = F.size("providers").cast("bigint")
    filed, pairs = lists.agg(F.count("*"), F.coalesce(F.sum(length), F.lit(0))).first()
    rows = half.count() * -(-pairs // max(filed, 1))
    met = half.join(lists, "geoid10").select(county_of("geoid10").alias("county_fips"), "way", *ends, "providers")
    net = (
        in_tasks(met, rows, FOOTPRINT_ROWS, *ends)
        .select(F.explode("providers").alias("hoconum"), "county_fips", "way", *ends)
        .groupBy("hoconum", "county_fips", *ends)
        .agg(F.sum("way").alias("net"))
        .filter("net != 0")
    )
    ahead = F.col("net") > 0
    columns = [F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("lx", "hx", "x1"), ("ly", "hy", "y1"), ("hx", "lx", "x2"), ("hy", "ly", "y2"))]
    return net.select("hoconum", "county_fips", *columns, F.abs("net").alias("mult"))


def keyed_features(features: DataFrame, geo_id: str, key: str, length: int) -> DataFrame:
    """Features keyed by the code at the end of a long geo id."""
    return features.select(tail(geo_id, length).alias(key), "geom")


def carto_tracts(
    generalized: DataFrame, extra: DataFrame, tracts: DataFrame, islands=ISLAND_STATES
) -> DataFrame:
    """Generalized tracts, full island tracts and the extra state's tracts.

    `generalized` and `extra` carry `geo_id` ending in the tract code; `tracts`
    are dissolved tracts with `tract_id`.
    """
    full = tracts.filter(in_island_state("tract_id", islands)).select("tract_id", "geom")
    return (
        keyed_features(generalized, "geo_id", "tract_id", 11)
        .unionByName(full)
        .unionByName(keyed_features(extra, "geo_id", "tract_id", 11))
    )


def carto_counties(
    generalized: DataFrame, island_counties: DataFrame
) -> DataFrame:
    """Generalized counties and the dissolved island counties."""
    return keyed_features(generalized, "geo_id", "geoid10", 5).unionByName(
        island_counties.select(F.col("county_id").alias("geoid10"), "geom")
    )


def attach_statistics(features: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Statistics on features; a feature without a row stays, with nulls."""
    return features.join(stats, key, "left")


def attach_tiers(
    features: DataFrame, stats: DataFrame, key: str, tiers: list[str], columns: list[str], buckets: int | None = None
) -> DataFrame:
    """Every feature once a tier, with the tier's statistics or nulls.

    Both sides are written once, bucketed and sorted by the key; the statistics of a
    key become one row first, with an array of a few tiers. The join of all tiers then
    reads stored order and moves no row.
    """
    spark = features.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    value = F.struct("tier", *[F.col(f"`{c}`") for c in columns])
    stored = by_key(stats.groupBy(key).agg(F.collect_list(value).alias("values")), key, buckets, "stats-by-key")
    shapes = by_key(features, key, buckets, "features-by-key")
    joined = shapes.join(stored.hint("merge"), key, "left")
    found = F.get(F.filter("values", lambda v: v["tier"] == F.col("tier")), F.lit(0))
    rows = joined.withColumn("tier", F.explode(F.array(*[F.lit(t) for t in tiers]))).withColumn("value", found)
    return rows.select(*features.columns, "tier", *[F.col(f"value.`{c}`") for c in columns])
