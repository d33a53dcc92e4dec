"""Named queries: each operator bound to the test tables.

Every entry takes (spark, sf_dir) and returns a DataFrame over whole tables.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import COUNTY_LEN, TECH_CLASSES, TIERS, TRACT_LEN, combo_layout, combo_names
from ..functions import geom as G
from ..functions.keys import county_of, pad_block, state_of, tail, tract_of
from ..functions.speeds import tech_class, tech_class_bit, tier_speed_of_file
from ..operators import (
    arcs,
    area,
    dissolve,
    filings,
    flags,
    geometry,
    numprov,
    providers,
    rollup,
    tile_geometry as tg,
    tiles,
)
from ..session import cut, scratch_path
from ..sinks import writers
from ..sources import fixtures as fx
from ..sources import readers
from ..sources.schemas import FILING_HEADERS
from . import products

TIER = next(t for t in TIERS if t.name == "25_3")
ALL_TECH = "".join(TECH_CLASSES)
# base-map zoom ranges and budgets are job parameters; these suit the test data
BASE_ZOOMS = {"state": (3, 6), "county": (5, 8), "cd115": (4, 7)}
THIN_BUDGET = 150
BLOCK_COST = 5
# features of a tile where the densest are dropped
DENSE_BUDGET = 40
BASE_BUDGET = 4

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and sinks -------------------------------------------------------
@query
def scan_filings(spark, sf):
    path = scratch_path(spark, "filings")
    headers = {n: h for h, (n, _) in FILING_HEADERS.items()}
    full = fx.filings(spark, sf).withColumn("State", state_of("block_code"))
    # read by name: the file has its columns in another order
    writers.write_csv(full, path, columns=sorted(full.columns, reverse=True), headers=headers)
    return readers.read_filings(spark, path)


@query
def scan_blocks(spark, sf):
    path = scratch_path(spark, "blocks")
    blocks = fx.blocks(spark, sf)
    writers.write_csv(blocks, path, columns=sorted(blocks.columns))
    return readers.read_blocks(spark, path)


@query
def scan_numprov_dir(spark, sf):
    path = scratch_path(spark, "numprov")
    f, b = fx.filings(spark, sf), fx.blocks(spark, sf)
    counts = numprov.numprov_with_flag(numprov.tier_counts(f, b), b)
    names = combo_names()
    writers.write_numprov_dir(counts.select("geoid10", "tier", "h2only_undev", *names), path)
    return readers.read_numprov_dir(spark, path, names)


@query
def scan_large_blocks(spark, sf):
    path = scratch_path(spark, "large")
    columns = ["y_zoom", "block_fips", "x_zoom"]
    writers.write_csv(fx.large_blocks(spark, sf), path, columns, sep="|", quote="'", quoteAll=True)
    return readers.read_large_blocks(spark, path)


def _geojson_round_trip(spark, sf, compression):
    path = scratch_path(spark, "geojson")
    blocks = fx.block_geom(spark, sf)
    writers.write_geojson(
        blocks, path, ["geoid10", "aland10"], ["geoid10"], compression=compression
    )
    return readers.read_geojson(spark, path, "geoid10: string, aland10: bigint")


@query
def scan_geojson(spark, sf):
    """Files with a feature per line, with a collection per line, and with features that span lines."""
    path = scratch_path(spark, "geojson")
    lines = writers.geojson_lines(fx.block_geom(spark, sf), ["geoid10", "aland10"])
    group = F.pmod(F.xxhash64("value"), F.lit(64))
    single = lines.filter(group < 24)
    # A line break behind each brace and comma; the properties have none in their values.
    spanning = lines.filter((group >= 24) & (group < 32)).select(F.regexp_replace("value", "([{,])", "$1\n").alias("value"))
    spanning.write.text(f"{path}/spanning")
    head, tail_ = F.lit('{"type": "FeatureCollection", "features": ['), F.lit("]}")
    together = (
        lines.filter(group >= 32)
        .groupBy(F.pmod(F.xxhash64("value"), F.lit(4096)).alias("g"))
        .agg(F.concat(head, F.concat_ws(", ", F.collect_list("value")), tail_).alias("value"))
        .select("value")
    )
    single.union(together).write.text(f"{path}/lines")
    back = readers.read_geojson(spark, [f"{path}/lines", f"{path}/spanning"], "geoid10: string, aland10: bigint")
    return geometry.feature_bounds(back, "geoid10", "aland10")


@query
def export_geojson(spark, sf):
    back = _geojson_round_trip(spark, sf, "gzip")
    return back.select("geoid10", G.area(F.col("geom")).alias("area"))


@query
def export_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "providers")
    table = providers.provider_table(fx.filings(spark, sf), fx.blocks(spark, sf))
    writers.write_csv(table, path, order=["hoconum", "tech"], compression="gzip")
    return spark.read.schema(table.schema).option("header", True).csv(path)


@query
def export_area_csv(spark, sf):
    """The area table as its CSV file has it, read back by name."""
    path = scratch_path(spark, "area")
    products.export_area(area_table(spark, sf), path)
    return readers.read_table(spark, path, ", ".join(
        [f"{c} string" for c in ("type", "id", "tech", "speed", "urban_rural", "tribal_non")]
        + [f"{c} bigint" for c in area.HAS]
    ))


@query
def export_numprov_null(spark, sf):
    """Counts of a tier with blanks for 0 and columns named by combination and tier."""
    path = scratch_path(spark, "numprov-null")
    products.export_numprov_null(_flagged(spark, sf), TIER, path)
    names = [f"{n}_{TIER.name}" for n in combo_layout()]
    return readers.read_table(
        spark,
        path,
        ", ".join(["geoid10 string", "h2only_undev tinyint"] + [f"{n} int" for n in names]),
        decimals=False,
    )


@query
def export_features_geojson(spark, sf, pack_edges=dissolve.PACK_EDGES):
    """Dissolved tracts as GeoJSON with their area, and long outlines as rows of points, read back."""
    path = scratch_path(spark, "tracts")
    tracts = dissolve.dissolve(_land_with_tract(spark, sf), "tract_id", grid=1, pack_edges=pack_edges)
    features = tracts.features.withColumn("area", G.area(F.col("geom")))
    writers.write_geojson(features, path, ["tract_id", "area"], ["tract_id"])
    whole = geometry.feature_bounds(
        readers.read_geojson(spark, path, "tract_id: string, area: double"), "tract_id", "area"
    )
    if tracts.long_outlines.isEmpty():
        return whole
    path = scratch_path(spark, "tract-points")
    points = dissolve.closed_ring_points(tracts.long_outlines, "tract_id", grid=1)
    writers.write_ring_points(points, path, ["tract_id"])
    back = spark.read.schema(points.schema).option("header", True).csv(path)
    return whole.unionByName(dissolve.point_measures(back, "tract_id"))


# --- filings -----------------------------------------------------------------
@query
def consumer_filings(spark, sf):
    return filings.consumer_filings(fx.filings(spark, sf))


@query
def filings_with_pop(spark, sf):
    return filings.filings_with_pop(fx.filings(spark, sf), fx.blocks(spark, sf))


@query
def filings_block_outer(spark, sf):
    return filings.filings_block_outer(fx.filings(spark, sf), fx.blocks(spark, sf))


@query
def tech_class_filter(spark, sf):
    f = filings.consumer_filings(fx.filings(spark, sf))
    return f.filter(F.col("tech_code").isin(*TECH_CLASSES["c"]))


@query
def tech_class_bits(spark, sf):
    return (
        fx.filings(spark, sf)
        .groupBy("tech_code")
        .agg(F.count("*").alias("n"))
        .withColumn("tech_class", tech_class("tech_code"))
        .withColumn("bit", tech_class_bit("tech_code"))
        .withColumn("bits", F.lpad(F.bin("bit"), 6, "0"))
    )


@query
def max_speed_block_provider_tech(spark, sf):
    return filings.max_speed_block_provider_tech(fx.filings(spark, sf))


@query
def max_speed_block_provider(spark, sf):
    return filings.max_speed_block_provider(fx.filings(spark, sf))


@query
def max_speed_block_provider_class(spark, sf):
    return filings.max_speed_block_provider_class(fx.filings(spark, sf))


@query
def max_speed_window(spark, sf):
    return filings.max_speed_window(fx.filings(spark, sf))


# --- provider table ----------------------------------------------------------
@query
def provider_pop_by_tech(spark, sf):
    return providers.provider_pop_by_tech(fx.filings(spark, sf), fx.blocks(spark, sf))


@query
def provider_pop_all(spark, sf):
    return providers.provider_pop_all(fx.filings(spark, sf), fx.blocks(spark, sf))


@query
def provider_pop_by_class(spark, sf):
    return providers.provider_pop_by_class(fx.filings(spark, sf), fx.blocks(spark, sf))


@query
def provider_table(spark, sf):
    return providers.provider_table(fx.filings(spark, sf), fx.blocks(spark, sf))


# --- provider counts ---------------------------------------------------------
def _wide(spark, sf):
    return numprov.block_numprov_wide(fx.filings(spark, sf), fx.blocks(spark, sf), TIER)


@query
def tier_qualified(spark, sf):
    return numprov.tier_qualified(fx.filings(spark, sf), TIER, TECH_CLASSES["c"])


@query
def numprov_25_3_acfosw(spark, sf):
    return numprov.numprov_one(fx.filings(spark, sf), fx.blocks(spark, sf), TIER, ALL_TECH)


@query
def block_numprov_wide(spark, sf):
    return _wide(spark, sf)


@query
def block_numprov_long(spark, sf):
    return numprov.block_numprov_long(fx.filings(spark, sf), fx.blocks(spark, sf))


def _flagged(spark, sf):
    return numprov.numprov_with_flag(_wide(spark, sf), fx.blocks(spark, sf))


@query
def numprov_with_flag(spark, sf):
    return _flagged(spark, sf)


@query
def numprov_capped(spark, sf):
    return numprov.numprov_capped(_wide(spark, sf))


@query
def numprov_int8(spark, sf):
    return numprov.numprov_int8(_wide(spark, sf))


@query
def numprov_export_layout(spark, sf):
    return numprov.export_layout(_flagged(spark, sf), TIER.name)


@query
def numprov_sorted(spark, sf):
    return _wide(spark, sf).orderBy("geoid10")


@query
def blank_zeros(spark, sf):
    return numprov.blank_zeros(_flagged(spark, sf))


@query
def fill_zero(spark, sf):
    return numprov.fill_zero(numprov.blank_zeros(_flagged(spark, sf)))


# --- area table --------------------------------------------------------------
def _county_pop_by_nprov(spark, sf):
    return area.area_pop_by_nprov(
        fx.filings(spark, sf), fx.blocks(spark, sf), TIER, ALL_TECH, "county"
    )


@query
def area_pop_by_nprov(spark, sf):
    return _county_pop_by_nprov(spark, sf)


@query
def area_pivot(spark, sf):
    return area.area_pivot(_county_pop_by_nprov(spark, sf))


@query
def area_table(spark, sf):
    return area.area_table(fx.filings(spark, sf), fx.blocks(spark, sf))


@query
def area_table_sorted(spark, sf):
    return area.area_table_sorted(area_table(spark, sf))


# --- weighted means ----------------------------------------------------------
@query
def tract_pop(spark, sf):
    return rollup.prefix_pop(fx.blocks(spark, sf), TRACT_LEN, "tract_id")


@query
def county_pop(spark, sf):
    return rollup.prefix_pop(fx.blocks(spark, sf), COUNTY_LEN, "county_id")


@query
def block_with_tract_pop(spark, sf):
    return rollup.block_with_prefix_pop(
        fx.blocks(spark, sf), TRACT_LEN, "tract_id", "tract_pop"
    )


def _means(spark, sf, length, name, tiers=TIERS):
    return rollup.weighted_numprov(
        fx.filings(spark, sf), fx.blocks(spark, sf), length, name, tiers
    )


@query
def tract_numprov(spark, sf):
    return _means(spark, sf, TRACT_LEN, "tract_id")


@query
def county_numprov(spark, sf):
    return _means(spark, sf, COUNTY_LEN, "county_id")


# --- flags and keys ----------------------------------------------------------
@query
def h2only_undev(spark, sf):
    return flags.h2only_undev(fx.block_hu_pop(spark, sf), fx.block_geom(spark, sf))


@query
def land_blocks(spark, sf):
    return flags.land_blocks(fx.block_geom(spark, sf)).select("geoid10", "aland10")


@query
def island_tracts(spark, sf):
    return (
        flags.land_blocks(fx.block_geom(spark, sf))
        .select(tract_of("geoid10").alias("tract_id"))
        .filter(flags.in_island_state("tract_id", fx.ISLANDS))
        .distinct()
    )


@query
def fips_parts(spark, sf):
    key = F.col("geoid10")
    unpadded = key.cast("bigint").cast("string")
    return fx.blocks(spark, sf).select(
        key,
        state_of(key).alias("state"),
        county_of(key).alias("county"),
        tract_of(key).alias("tract"),
        tail(F.concat(F.lit("1400000US"), tract_of(key)), TRACT_LEN).alias("tract_tail"),
        unpadded.alias("unpadded"),
        pad_block(unpadded).alias("padded"),
    )


@query
def tier_speeds(spark, sf):
    """Speed parsed from export file names, for the blocks of each export."""
    names = [F.lit(f"csv/block_numprov_{t.name}.csv") for t in TIERS]
    return (
        fx.blocks(spark, sf)
        .select("geoid10", F.explode(F.array(*names)).alias("file"))
        .select("file", tier_speed_of_file("file").alias("speed"))
        .groupBy("file", "speed")
        .agg(F.count("*").alias("n_blocks"))
    )


# --- geometry ----------------------------------------------------------------
def _lonlat(spark, sf):
    return fx.block_geom(spark, sf, lonlat=True)


def _block_bounds(spark, sf, *keep, lonlat=False):
    return geometry.feature_bounds(fx.block_geom(spark, sf, lonlat), "geoid10", *keep)


@query
def feature_bounds(spark, sf):
    return _block_bounds(spark, sf)


@query
def bbox_text(spark, sf):
    box = [F.col(c) for c in geometry.BOX]
    return _block_bounds(spark, sf).select("geoid10", G.bbox_text(*box).alias("bbox_arr"))


@query
def bbox_decimal(spark, sf):
    box = G.bbox_decimal(*[F.col(c) for c in geometry.BOX])
    as_text = F.concat_ws(",", F.transform(box, lambda d: d.cast("string")))
    return _block_bounds(spark, sf, lonlat=True).select("geoid10", as_text.alias("bbox_arr"))


def _geographies(spark, sf):
    """(layer, geoid, geom): the blocks of states, counties and districts dissolved, in degrees."""
    layers = F.array(
        F.struct(F.lit("state").alias("layer"), state_of("geoid10").alias("geoid")),
        F.struct(F.lit("county").alias("layer"), county_of("geoid10").alias("geoid")),
        F.struct(F.lit("cd115").alias("layer"), F.concat(state_of("geoid10"), F.substring("geoid10", 4, 2)).alias("geoid")),
    )
    return dissolve.dissolve(_lonlat(spark, sf).select("geom", F.inline(layers)), "layer", "geoid").features


def _layer_bounds(spark, sf):
    """Bounds of states, counties and districts, lattice coordinates."""
    bounds = _block_bounds(spark, sf)
    layers = F.array(
        F.struct(F.lit("state").alias("layer"), state_of("geoid10").alias("geoid")),
        F.struct(F.lit("county").alias("layer"), county_of("geoid10").alias("geoid")),
        F.struct(
            F.lit("cd115").alias("layer"),
            F.concat(state_of("geoid10"), F.substring("geoid10", 4, 2)).alias("geoid"),
        ),
    )
    return geometry.group_bounds(
        bounds.select(F.inline(layers), *geometry.BOX), "layer", "geoid"
    )


@query
def bbox_override(spark, sf):
    return geometry.bbox_override(_layer_bounds(spark, sf), geometry.bbox_overrides(spark))


def _micro_degrees():
    return [F.round(F.col(c) * 1_000_000).cast("bigint").alias(c) for c in geometry.BOX]


@query
def bbox_on_circle(spark, sf):
    """Boxes of the layers on a lattice that lies across the antimeridian, in millionths of a degree."""
    # -120 goes to 179.8, what is beyond 180 to the west
    turned = "if(p.x >= -119.8D, p.x - 60.2D, p.x + 299.8D)"
    around = f"transform(geom, g -> transform(g, r -> transform(r, p -> struct({turned} as x, p.y as y))))"
    layers = F.array(
        F.struct(F.lit("state").alias("layer"), state_of("geoid10").alias("geoid")),
        F.struct(F.lit("county").alias("layer"), county_of("geoid10").alias("geoid")),
        F.struct(F.lit("tract").alias("layer"), tract_of("geoid10").alias("geoid")),
    )
    shapes = _lonlat(spark, sf).select(F.expr(around).alias("geom"), F.inline(layers))
    boxes = geometry.circle_bounds(shapes, "layer", "geoid")
    return boxes.select("layer", "geoid", *_micro_degrees())


@query
def mercator_coords(spark, sf):
    m = geometry.mercator_features(_lonlat(spark, sf))
    mm = lambda c: F.round(F.col(c) * 1000).cast("bigint")
    return (
        m.select("geoid10", F.posexplode(G.vertices(F.col("geom"))).alias("seq", "p"))
        .select("geoid10", "seq", mm("p.x").alias("x_mm"), mm("p.y").alias("y_mm"))
    )


def _areas(spark, sf):
    return geometry.tract_area(_lonlat(spark, sf))


def _whole_m2(areas):
    return areas.select("tract_id", F.round("area").cast("bigint").alias("area_m2"))


def _typical(areas) -> Column:
    """Size limit for the test data: its mean tract area plus 0.5 m2, off any tie."""
    return _whole_m2(areas).select(F.avg("area_m2") + 0.5).scalar()


@query
def tract_area(spark, sf):
    return _whole_m2(_areas(spark, sf))


@query
def big_tracts(spark, sf):
    areas = _areas(spark, sf)
    return _whole_m2(geometry.big_tracts(areas, _typical(areas)))


@query
def notbig_tracts(spark, sf):
    areas = _areas(spark, sf)
    return _whole_m2(geometry.notbig_tracts(areas, _typical(areas)))


def _blocks_of_big_tracts(spark, sf):
    areas = cut(_areas(spark, sf), "areas")
    return geometry.blocks_in_big_tracts(_lonlat(spark, sf), areas, _typical(areas))


@query
def blocks_in_big_tracts(spark, sf):
    return _blocks_of_big_tracts(spark, sf).select("geoid10", "tract_id")


@query
def large_blocks_zoom(spark, sf):
    return geometry.large_blocks_zoom(
        fx.block_geom(spark, sf), fx.large_blocks(spark, sf)
    ).select("geoid10", "aland10", "min_zoom")


def _land_with_tract(spark, sf):
    return flags.land_blocks(fx.block_geom(spark, sf)).withColumn(
        "tract_id", tract_of("geoid10")
    )


@query
def dissolve_tract_edges(spark, sf):
    return dissolve.dissolve_edges(_land_with_tract(spark, sf), "tract_id", grid=1)


@query
def dissolve_tract(spark, sf):
    tracts = dissolve.dissolve(_land_with_tract(spark, sf), "tract_id", grid=1)
    return _measured_all(tracts, "tract_id")


@query
def dissolve_ring_points(spark, sf):
    edges = dissolve.dissolve_edges(_land_with_tract(spark, sf), "tract_id", grid=1)
    return dissolve.ring_points(edges, "tract_id")


@query
def simplify_arcs(spark, sf):
    """Borders between tracts, each once and without the points on straight stretches."""
    land = _land_with_tract(spark, sf)
    outline = dissolve.dissolve_edges(land, "tract_id", grid=1).drop("mult")
    return arcs.simplify_arcs(outline, "tract_id", tolerance=0.1).drop("arc", "seq")


def _island_land(spark, sf):
    return _land_with_tract(spark, sf).filter(flags.in_island_state("tract_id", fx.ISLANDS))


@query
def dissolve_county_edges(spark, sf):
    """Island counties from island tracts: two dissolves, the second on outlines."""
    tracts = dissolve.dissolve_edges(_island_land(spark, sf), "tract_id", grid=1)
    counties = tracts.withColumn("county_id", county_of("tract_id")).select(
        "county_id", *dissolve.EDGE
    )
    return dissolve.outline_edges(counties, "county_id")


def _provider_blocks(spark, sf, lonlat=False):
    return geometry.provider_blocks(fx.filings(spark, sf), fx.block_geom(spark, sf, lonlat))


@query
def provider_blocks(spark, sf):
    return _provider_blocks(spark, sf).drop("geom")


@query
def provider_footprint_edges(spark, sf):
    return geometry.footprint_edges(fx.filings(spark, sf), fx.block_geom(spark, sf), grid=1)


def _footprints(spark, sf):
    keys = ("hoconum", "county_fips")
    bounds = geometry.feature_bounds(_provider_blocks(spark, sf, lonlat=True), *keys)
    return geometry.group_bounds(bounds, *keys)


@query
def provider_split_large(spark, sf):
    return _footprints(spark, sf).filter(flags.large_provider("hoconum"))


@query
def provider_split_other(spark, sf):
    return _footprints(spark, sf).filter(~flags.large_provider("hoconum"))


def _measured(features, key):
    return geometry.feature_bounds(
        features.withColumn("area", G.area(F.col("geom"))), key, "area"
    )


def _measured_all(dissolved, key):
    """Measures of dissolved features and of the outlines too long for a row."""
    return _measured(dissolved.features, key).unionByName(
        dissolve.outline_measures(dissolved.long_outlines, key, grid=1)
    )


@query
def carto_tracts(spark, sf):
    islands = dissolve.dissolve(_island_land(spark, sf), "tract_id", grid=1)
    features = geometry.carto_tracts(
        fx.carto_tract(spark, sf), fx.extra_tract(spark, sf), islands.features, fx.ISLANDS
    )
    return _measured(features, "tract_id").unionByName(
        dissolve.outline_measures(islands.long_outlines, "tract_id", grid=1)
    )


@query
def carto_counties(spark, sf):
    land = _island_land(spark, sf).withColumn("county_id", county_of("tract_id"))
    islands = dissolve.dissolve(land, "county_id", grid=1)
    features = geometry.carto_counties(fx.carto_county(spark, sf), islands.features)
    long = dissolve.outline_measures(islands.long_outlines, "county_id", grid=1)
    return _measured(features, "geoid10").unionByName(
        long.withColumnRenamed("county_id", "geoid10")
    )


# --- features with statistics ------------------------------------------------
@query
def county_features(spark, sf):
    stats = _means(spark, sf, COUNTY_LEN, "geoid10", [TIER]).drop("tier")
    return geometry.attach_statistics(carto_counties(spark, sf), stats, "geoid10")


@query
def tract_features(spark, sf):
    stats = _means(spark, sf, TRACT_LEN, "tract_id", [TIER]).drop("tier")
    return geometry.attach_statistics(carto_tracts(spark, sf), stats, "tract_id")


@query
def smalltract_features(spark, sf):
    stats = _means(spark, sf, TRACT_LEN, "tract_id", [TIER]).drop("tier")
    return geometry.attach_statistics(notbig_tracts(spark, sf), stats, "tract_id")


@query
def bigtract_block_features(spark, sf):
    blocks = geometry.feature_bounds(_blocks_of_big_tracts(spark, sf), "geoid10")
    return geometry.attach_statistics(blocks, _wide(spark, sf), "geoid10")


@query
def block_features(spark, sf):
    return geometry.attach_statistics(_block_bounds(spark, sf), _wide(spark, sf), "geoid10")


@query
def features_all_tiers(spark, sf):
    """Carto counties, carto tracts and blocks with the statistics of all seven tiers."""
    histogram = numprov.mask_histogram(fx.filings(spark, sf))
    master, names = fx.blocks(spark, sf), combo_names()

    def values(df, kind, key):
        doubles = [f"cast(`{n}` as double) as `{n}`" for n in names]
        return df.selectExpr(f"concat('{kind}:', {key}) as feature", "tier", *doubles)

    stats = tiles.tile_union(
        values(rollup.weighted_of(histogram, master, COUNTY_LEN, "county_id"), "county", "county_id"),
        values(rollup.weighted_of(histogram, master, TRACT_LEN, "tract_id"), "tract", "tract_id"),
        values(numprov.counts_of(histogram, master), "block", "geoid10"),
    )

    def boxes(df, kind, key):
        return df.select(F.concat(F.lit(f"{kind}:"), key).alias("feature"), *geometry.BOX)

    features = tiles.tile_union(
        boxes(carto_counties(spark, sf), "county", "geoid10"),
        boxes(carto_tracts(spark, sf), "tract", "tract_id"),
        boxes(_block_bounds(spark, sf), "block", "geoid10"),
    )
    return geometry.attach_tiers(features, stats, "feature", [t.name for t in TIERS], names)


# --- tiles -------------------------------------------------------------------
def _levels(spark, sf):
    """Boxes of all feature levels in degrees: (level, feature_id, box).

    Five levels read the boxes and three the areas, so both are written once.
    """
    blocks = cut(_block_bounds(spark, sf, "aland10", lonlat=True), "boxes")
    areas = cut(_areas(spark, sf), "areas")
    limit = _typical(areas)
    land = F.col("aland10") > 0

    def level(df, name, key):
        return geometry.group_bounds(
            df.select(F.lit(name).alias("level"), key.alias("feature_id"), *geometry.BOX),
            "level",
            "feature_id",
        )

    tract = tract_of("geoid10")
    whole = [
        level(blocks, "county", county_of("geoid10")),
        level(blocks, "tract", tract),
    ]
    small = geometry.notbig_tracts(areas, limit).select(F.col("tract_id").alias("feature_id"))
    whole.append(
        level(blocks.filter(land), "smalltract", tract).join(small, "feature_id", "left_semi")
    )
    in_big = geometry.blocks_in_big_tracts(blocks, areas, limit)
    for name, df in (("bigtract_block", in_big), ("block", blocks)):
        whole.append(
            df.select(F.lit(name).alias("level"), F.col("geoid10").alias("feature_id"), *geometry.BOX)
        )
    return tiles.tile_union(*whole)


@query
def zoom_plan_features(spark, sf):
    planned = tiles.zoom_plan_features(_levels(spark, sf))
    base = geometry.bbox_override(_layer_bounds(spark, sf), geometry.bbox_overrides(spark))
    base = tiles.zoom_plan_features(
        base.select(
            F.col("layer").alias("level"), F.col("geoid").alias("feature_id"), *geometry.BOX
        ),
        tiles.base_bands(BASE_ZOOMS),
    )
    columns = ["level", "feature_id", "z", "simplify", "coalesce", "thin", "detail", "drop_attr"]
    return planned.select(
        F.lit("speed").alias("layer"), *columns
    ).unionByName(base.select(F.lit("base").alias("layer"), *columns))


def _block_cover(spark, sf, zmin, zmax, *keep):
    boxes = _block_bounds(spark, sf, *keep, lonlat=True)
    zoomed = boxes.withColumn("z", F.explode(F.sequence(F.lit(zmin), F.lit(zmax))))
    return tiles.tile_cover(zoomed)


@query
def tile_cover(spark, sf):
    return _block_cover(spark, sf, 11, 14).select("geoid10", "z", "x", "y")


def _triangles(spark, sf):
    """Half of each tract's box: from its south-west corner along both sides."""
    boxes = _block_bounds(spark, sf, lonlat=True).withColumn("tract_id", tract_of("geoid10"))
    corners = (("minx", "miny"), ("maxx", "miny"), ("minx", "maxy"), ("minx", "miny"))
    ring = F.array(*[G.point(F.col(x), F.col(y)) for x, y in corners])
    return geometry.group_bounds(boxes, "tract_id").select("tract_id", F.array(F.array(ring)).alias("geom"))


@query
def tile_cover_shapes(spark, sf):
    zooms = F.explode(F.sequence(F.lit(6), F.lit(13)))
    return tiles.shape_cover(_triangles(spark, sf).withColumn("z", zooms), "tract_id")


@query
def tile_quantise(spark, sf):
    features = fx.block_geom(spark, sf, lonlat=True).select(
        "geoid10", "geom", *G.bounds(F.col("geom")), F.lit(14).alias("z")
    )
    return tiles.tile_quantise(tiles.tile_cover(features), ["geoid10"], detail=14)


def _el_shapes(spark, sf):
    """Each tract's box without its north-east quarter."""
    boxes = _block_bounds(spark, sf, lonlat=True).withColumn("tract_id", tract_of("geoid10"))
    box = geometry.group_bounds(boxes, "tract_id").selectExpr("*", "(minx + maxx) / 2 as midx", "(miny + maxy) / 2 as midy")
    corners = (("minx", "miny"), ("maxx", "miny"), ("maxx", "midy"), ("midx", "midy"), ("midx", "maxy"), ("minx", "maxy"), ("minx", "miny"))
    ring = F.array(*[G.point(F.col(x), F.col(y)) for x, y in corners])
    return box.select("tract_id", F.array(F.array(ring)).alias("geom"))


@query
def tile_quantise_clipped(spark, sf):
    """Triangles and L-shapes clipped to the tiles of eight zooms: what they cover of a tile, in
    millionths, and the box of the quantised piece, which reaches over the tile by its margin."""
    shapes = _triangles(spark, sf).withColumn("shape", F.lit("triangle"))
    shapes = shapes.unionByName(_el_shapes(spark, sf).withColumn("shape", F.lit("el")))
    shapes = shapes.withColumns({"zmin": F.lit(6), "zmax": F.lit(13)})
    pieces = tg.quantised_pieces(tg.tile_pieces(shapes, ["shape", "tract_id"]))
    points = F.flatten("rings")
    ends = [f(F.transform(points, p)).alias(n) for n, f, p in (
        ("qminx", F.array_min, lambda p: p["x"]), ("qminy", F.array_min, lambda p: p["y"]),
        ("qmaxx", F.array_max, lambda p: p["x"]), ("qmaxy", F.array_max, lambda p: p["y"]),
    )]
    area = F.round(F.col("area") * 1_000_000).cast("bigint").alias("area_ppm")
    return pieces.select("shape", "tract_id", "z", "x", "y", area, *ends)


@query
def simplify_features(spark, sf):
    features = _lonlat(spark, sf).select(
        "geoid10", "geom", F.lit(10).alias("z"), F.lit(8).alias("simplify"), F.lit(12).alias("detail")
    )
    rings = tiles.simplify_features(features, ["geoid10"])
    return rings.select(
        "geoid10",
        "z",
        "poly",
        "ring",
        F.size("pts").alias("n_points"),
        F.abs(2 * G.signed_area(F.col("pts"))).cast("bigint").alias("area2"),
    )


@query
def tile_coalesce(spark, sf):
    stats = numprov.numprov_one(
        fx.filings(spark, sf), fx.blocks(spark, sf), TIER, ALL_TECH
    ).select("geoid10", F.least("nprovs", F.lit(3)).alias("nprovs"))
    cover = _block_cover(spark, sf, 10, 10).withColumn("layer", F.lit(TIER.name))
    joined = geometry.attach_statistics(cover, stats, "geoid10")
    return tiles.coalesce_tiles(joined, ["nprovs"], "geoid10")


def _block_pieces(spark, sf, zmin, zmax, layer):
    blocks = _lonlat(spark, sf).select("geoid10", "geom", F.lit(zmin).alias("zmin"), F.lit(zmax).alias("zmax"))
    pieces = tg.tile_pieces(blocks, ["geoid10"])
    return tg.quantised_pieces(pieces).withColumn("layer", F.lit(layer))


@query
def tile_coalesce_edges(spark, sf):
    """Joint outlines of the blocks of a tile with equally many providers, in tile units."""
    stats = numprov.numprov_one(
        fx.filings(spark, sf), fx.blocks(spark, sf), TIER, ALL_TECH
    ).select("geoid10", F.least("nprovs", F.lit(3)).alias("nprovs"))
    pieces = geometry.attach_statistics(_block_pieces(spark, sf, 9, 10, TIER.name), stats, "geoid10")
    return tg.coalesced_edges(pieces.fillna(-1, ["nprovs"]), [*tiles.TILE, "nprovs"])


@query
def tile_coalesce_smallest(spark, sf):
    """Tiles whose smallest blocks merge into neighbours; `area2` is twice the area of what was merged."""
    pieces = _block_pieces(spark, sf, 8, 10, "block")
    edges = tg.piece_edges(pieces, *tiles.TILE, "geoid10")
    size = _block_bounds(spark, sf, "aland10").select("geoid10", F.col("aland10").alias("size"), F.lit(BLOCK_COST).cast("bigint").alias("cost"))
    cover = pieces.select(*tiles.TILE, "geoid10").join(size, "geoid10")
    features, outlines = tg.coalesce_smallest(cover, edges, THIN_BUDGET, "geoid10")
    area = outlines.groupBy(*tiles.TILE, "geoid10").agg(
        F.sum(F.expr("(x1 * y2 - x2 * y1) * mult")).alias("area2"), F.count("*").alias("n_edges")
    )
    return features.join(area, [*tiles.TILE, "geoid10"])


def _sized_cover(spark, sf):
    """Tiles of blocks and counties; the cost is the number of vertices.

    The largest counties cost more than the budget of a tile.
    """
    boxes = _lonlat(spark, sf).select(
        "geoid10",
        F.col("aland10").alias("size"),
        F.size(G.vertices(F.col("geom"))).cast("bigint").alias("cost"),
        *G.bounds(F.col("geom")),
    )
    counties = boxes.groupBy(county_of("geoid10").alias("geoid10")).agg(
        F.sum("size").alias("size"),
        F.sum("cost").alias("cost"),
        *[f(c).alias(c) for c, f in zip(geometry.BOX, (F.min, F.min, F.max, F.max))],
    )

    def layer(df, name, zmin, zmax):
        zooms = F.explode(F.sequence(F.lit(zmin), F.lit(zmax)))
        return df.select(F.lit(name).alias("layer"), "*", zooms.alias("z"))

    cover = tiles.tile_cover(layer(boxes, "block", 5, 14).unionByName(layer(counties, "county", 0, 9)))
    return cover.select(*tiles.TILE, "geoid10", "size", "cost", *geometry.BOX)


@query
def tile_thin(spark, sf):
    return tiles.thin_tiles(_sized_cover(spark, sf), THIN_BUDGET, "geoid10").drop(*geometry.BOX)


@query
def tile_fold_smallest(spark, sf):
    return tiles.fold_smallest(_sized_cover(spark, sf), THIN_BUDGET, "geoid10").drop(*geometry.BOX)


@query
def tile_drop_densest(spark, sf):
    return tg.drop_densest(_sized_cover(spark, sf), DENSE_BUDGET, "geoid10").select(*tiles.TILE, "geoid10", "gap")


@query
def base_map_tiles(spark, sf):
    """States, counties and districts on the tiles of their zooms, the densest dropped, with boxes on the circle."""
    shapes = cut(_geographies(spark, sf), "geographies")
    boxes = geometry.circle_bounds(shapes, "layer", "geoid")
    boxes = geometry.bbox_override(boxes, geometry.bbox_overrides(spark))
    boxes = boxes.withColumnsRenamed({"layer": "level", "geoid": "feature_id"})
    shapes = shapes.withColumnsRenamed({"layer": "level", "geoid": "feature_id"})
    rows = tg.base_tiles(shapes, boxes, tiles.base_bands(BASE_ZOOMS), BASE_BUDGET)
    return rows.select(*tiles.TILE, "feature_id", "gap", *_micro_degrees())


@query
def tile_union(spark, sf):
    """All zoom bands of one speed layer: county, tract, mixed zoom 9, block."""
    shown = tiles.zoom_plan_features(_levels(spark, sf))
    cover = tiles.tile_cover(shown).withColumn("layer", F.lit(TIER.name))
    # the two levels of zoom 9 stay apart by `level`; everything else is disjoint
    return cover.select(*tiles.TILE, "level", "feature_id")


@query
def speed_layer_tiles(spark, sf):
    """The speed layers of all seven tiers over all bands with all combinations."""
    geom = cut(_lonlat(spark, sf), "block-geom")
    blocks = cut(
        geom.select(
            "geoid10",
            "aland10",
            F.size(G.vertices(F.col("geom"))).cast("bigint").alias("cost"),
            *G.bounds(F.col("geom")),
        ),
        "boxes",
    )
    areas = cut(_areas(spark, sf), "areas")
    limit = _typical(areas)
    tract = tract_of("geoid10")

    def whole(key, level, kind):
        # areas are of land blocks
        return (
            blocks.filter("aland10 > 0")
            .groupBy(key.alias("feature_id"))
            .agg(
                F.sum("aland10").alias("size"),
                F.sum("cost").alias("cost"),
                *[f(c).alias(c) for c, f in zip(geometry.BOX, (F.min, F.min, F.max, F.max))],
            )
            .select(F.lit(level).alias("level"), F.lit(kind).alias("stat_kind"), "*")
        )

    def single(df, level):
        return df.select(
            F.lit(level).alias("level"),
            F.lit("block").alias("stat_kind"),
            F.col("geoid10").alias("feature_id"),
            F.col("aland10").alias("size"),
            "cost",
            *geometry.BOX,
        )

    small = geometry.notbig_tracts(areas, limit).select(F.col("tract_id").alias("feature_id"))
    features = tiles.tile_union(
        whole(county_of("geoid10"), "county", "county"),
        whole(tract, "tract", "tract"),
        whole(tract, "smalltract", "tract").join(small, "feature_id", "left_semi"),
        single(geometry.blocks_in_big_tracts(blocks, areas, limit), "bigtract_block"),
        single(blocks, "block"),
    )
    land = flags.land_blocks(geom)

    def outlines(keyed):
        made = dissolve.dissolve(keyed, "feature_id")
        if made.long_outlines.isEmpty():
            return made.features
        # an outline too long for a row is on the tiles of its parts
        return made.features.unionByName(dissolve.outline_parts(keyed, made.long_outlines, "feature_id"))

    shapes = {
        level: outlines(land.withColumn("feature_id", key))
        for level, key in (("county", county_of("geoid10")), ("tract", tract))
    }
    shapes["tract"] = cut(shapes["tract"], "tract-shapes")
    in_big = geometry.blocks_in_big_tracts(geom, areas, limit)
    shapes |= {
        "smalltract": shapes["tract"].join(small, "feature_id", "left_semi"),
        "bigtract_block": in_big.withColumnRenamed("geoid10", "feature_id"),
        "block": geom.withColumnRenamed("geoid10", "feature_id"),
    }
    shapes = tiles.tile_union(*[df.select(F.lit(level).alias("level"), "feature_id", "geom") for level, df in shapes.items()])
    touched = tg.touched_tiles(tg.over_bands(shapes, tiles.SPEED_BANDS), ["level", "feature_id"])
    names = combo_names()
    histogram = numprov.mask_histogram(fx.filings(spark, sf))
    master = fx.blocks(spark, sf)

    weights = rollup.area_weights(histogram, master, TRACT_LEN, "area")

    def values(df, stat):
        return df.select(stat.alias("stat"), "tier", *[F.col(f"`{n}`").cast("double").alias(n) for n in names])

    def of_areas(length, kind):
        means = rollup.weighted_of(histogram, master, length, "area", weights=weights)
        return values(means, tiles.stat_key(F.lit(kind), "area"))

    def of_block(df):
        return df.withColumn("geoid10", tiles.stat_key(F.lit("block"), "geoid10"))

    def stats(tasks):
        areas_ = of_areas(COUNTY_LEN, "county").unionByName(of_areas(TRACT_LEN, "tract"))
        # the key first, so that the wide counts are where they are stored
        counts = numprov.counts_of(of_block(histogram), of_block(master), tasks=tasks)
        return areas_.repartition(tasks, "stat").unionByName(values(counts, F.col("geoid10")))

    return tiles.speed_layers(features, touched, stats, names, [t.name for t in TIERS], THIN_BUDGET)


@query
def xl_block_tiles(spark, sf):
    large = cut(geometry.large_blocks_zoom(_lonlat(spark, sf), fx.large_blocks(spark, sf)), "large")
    shapes = tg.over_bands(large.withColumn("level", F.lit("xl_block")), tiles.XL_BLOCK_BANDS)
    boxes = geometry.feature_bounds(large, "geoid10", "min_zoom")
    return tiles.xl_block_tiles(boxes, tg.touched_tiles(shapes, ["geoid10"])).select("geoid10", "z", "x", "y")


@query
def provider_tiles(spark, sf):
    return tiles.provider_tiles(_footprints(spark, sf), flags.large_provider("hoconum"))
