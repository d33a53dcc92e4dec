"""All outputs of a release, from filings, block master and geometry.

The raw filings are read once: collapsed filings and the mask histogram are
written as tables and every later product starts from those. A lost executor
costs its own tasks only.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    BIG_TRACT_M2,
    COUNTY_LEN,
    ISLAND_STATES,
    TECH_CLASSES,
    TIERS,
    TRACT_LEN,
    combo_layout,
    combo_names,
)
from ..functions import geom as G
from ..functions.keys import county_of, tract_of
from ..functions.speeds import tier_rank
from ..operators import (
    area,
    dissolve,
    filings as fl,
    flags,
    geometry,
    numprov,
    providers,
    rollup,
    tile_geometry as tg,
    tiles,
)
from ..sinks import writers

# features per tile of a thinned band, in vertices
TILE_BUDGET = 200_000
# features per tile of the base map
BASE_BUDGET = 50_000


def _save(df: DataFrame, out: str, name: str, *partition: str) -> DataFrame:
    path = f"{out}/{name}"
    df.write.mode("overwrite").partitionBy(*partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def statistics(
    filings: DataFrame, blocks: DataFrame, out: str, tiers=TIERS, classes=TECH_CLASSES
) -> dict[str, DataFrame]:
    """Provider table, block counts, area table, tract and county means."""
    names = combo_names(classes)
    compact = _save(fl.collapse_filings(filings), out, "filings")
    histogram = _save(numprov.mask_histogram(compact, tiers, classes), out, "mask_histogram")
    made = {"provider_table": _save(providers.provider_table(compact, blocks), out, "provider_table")}
    counts = numprov.counts_of(histogram, blocks, tiers, classes)
    flagged = numprov.numprov_with_flag(counts, blocks)
    counts = made["block_numprov"] = _save(
        flagged.select("geoid10", "h2only_undev", *names, "tier"), out, "block_numprov", "tier"
    )
    made["area_table"] = _save(
        area.area_of(counts.drop("h2only_undev"), blocks, tiers, classes), out, "area_table"
    )
    for name, length in (("tract", TRACT_LEN), ("county", COUNTY_LEN)):
        means = rollup.weighted_of(histogram, blocks, length, f"{name}_id", tiers, classes)
        made[f"{name}_numprov"] = _save(
            means.select(f"{name}_id", *names, "is_populated", "tier"), out, f"{name}_numprov", "tier"
        )
    return made


def export_area(table: DataFrame, path: str) -> None:
    """The area table without the tier's name, ordered by six keys, speeds as numbers."""
    order = ["type", "id", "tech", "speed", "urban_rural", "tribal_non"]
    writers.write_csv(
        table.withColumn("tier_rank", tier_rank("tier")),
        path,
        columns=[*order, *area.HAS],
        order=["type", "id", "tech", "tier_rank", "urban_rural", "tribal_non"],
    )


def export_numprov_null(counts: DataFrame, tier, path: str, classes=TECH_CLASSES) -> None:
    """Counts of one tier with blanks for 0, their columns named <combination>_<tier>."""
    blanked = numprov.blank_zeros(counts.select("geoid10", "h2only_undev", *combo_layout(classes)))
    writers.write_csv(numprov.export_layout(blanked, tier.name, classes), path, order=["geoid10"])


def exports(made: dict[str, DataFrame], out: str, classes=TECH_CLASSES, tiers=TIERS) -> None:
    """The CSV files of the statistics."""
    writers.write_csv(made["provider_table"], f"{out}/csv/provider_table", order=["hoconum", "tech"])
    export_area(made["area_table"], f"{out}/csv/area_table")
    layout = ["geoid10", "tier", "h2only_undev", *combo_layout(classes)]
    counts = made["block_numprov"].select(*layout)
    writers.write_numprov_dir(counts, f"{out}/csv/block_numprov_with0")
    for tier in tiers:
        export_numprov_null(
            counts.filter(F.col("tier") == tier.name),
            tier,
            f"{out}/csv/block_numprov_withnull/block_numprov_{tier.name}",
            classes,
        )
    for name in ("tract_numprov", "county_numprov"):
        for tier in tiers:
            writers.write_csv(
                made[name].filter(F.col("tier") == tier.name).drop("tier"),
                f"{out}/csv/{name}/{name}_{tier.name}",
                order=[name.replace("numprov", "id")],
            )


def export_shapes(made: dict[str, DataFrame], out: str, threshold: float = BIG_TRACT_M2) -> None:
    """Block flags and tract areas as CSV, features as GeoJSON.

    Besides blocks, tracts and counties: large blocks, big and not-big tracts, blocks of
    big tracts and the footprints of large and of other providers.

    Outlines too long for a feature are CSV rows of points: ring, sign (1 for a
    shell, -1 for a hole), place on the ring. Both together are all features.
    """
    writers.write_csv(made["h2only_undev"], f"{out}/csv/h2only_undev", order=["block_fips"])
    writers.write_csv(made["tract_area"], f"{out}/csv/tract_area", order=["tract_id"])
    for level in ("block", "tract", "county"):
        writers.write_geojson(
            made["features"].filter(F.col("level") == level),
            f"{out}/geojson/{level}",
            ["feature_id"],
            ["feature_id"],
        )
    points = dissolve.closed_ring_points(made["long_outlines"], "level", "feature_id")
    writers.write_ring_points(points, f"{out}/csv/long_outlines", ["level", "feature_id"])
    block, tract = (
        made["features"].filter(F.col("level") == level).select(F.col("feature_id").alias(key), "geom")
        for level, key in (("block", "geoid10"), ("tract", "tract_id"))
    )
    parts = {
        "xl_blocks": (block.join(made["xl_blocks"].select("geoid10", "min_zoom"), "geoid10"), ["geoid10", "min_zoom"]),
        "bigtract_blocks": (block.join(made["bigtract_blocks"].select("geoid10"), "geoid10"), ["geoid10"]),
    }
    for name, kept in (("big_tracts", geometry.big_tracts), ("notbig_tracts", geometry.notbig_tracts)):
        parts[name] = (tract.join(kept(made["tract_area"], threshold), "tract_id"), ["tract_id", "area"])
    foot = dissolve.pack_outlines(made["footprint_outlines"], "hoconum", "county_fips")
    large = flags.large_provider("hoconum")
    for name, kept in (("large_footprints", large), ("other_footprints", ~large)):
        parts[name] = (foot.features.filter(kept), ["hoconum", "county_fips"])
    for name, (features, columns) in parts.items():
        writers.write_geojson(features, f"{out}/geojson/{name}", columns, columns[:2] if "hoconum" in columns else columns[:1])
    points = dissolve.closed_ring_points(foot.long_outlines, "hoconum", "county_fips")
    writers.write_ring_points(points, f"{out}/csv/long_footprints", ["hoconum", "county_fips"])


def base_map(geographies: DataFrame, out: str, zooms: dict[str, tuple[int, int]], budget: int = BASE_BUDGET) -> DataFrame:
    """Base-map tiles of geographies (level, feature_id, geom) at the zooms of their levels.

    Boxes are those on the circle, so areas across the antimeridian need no table of
    exceptions. A tile with more than `budget` features drops the densest.
    """
    boxes = _save(geometry.circle_bounds(geographies, "level", "feature_id"), out, "base_boxes")
    rows = tg.base_tiles(geographies, boxes, tiles.base_bands(zooms), budget)
    return _save(rows, out, "base_tiles", "layer", "z")


def export_carto(
    generalized: DataFrame, extra: DataFrame, counties: DataFrame, made: dict[str, DataFrame], out: str, islands=ISLAND_STATES
) -> None:
    """Cartographic tracts and counties as GeoJSON, islands from the dissolved features."""
    tract = made["features"].filter("level = 'tract'").select(F.col("feature_id").alias("tract_id"), "geom")
    county = made["features"].filter("level = 'county'").select(F.col("feature_id").alias("county_id"), "geom")
    island = county.filter(flags.in_island_state("county_id", islands))
    for name, key, features in (
        ("carto_tracts", "tract_id", geometry.carto_tracts(generalized, extra, tract, islands)),
        ("carto_counties", "geoid10", geometry.carto_counties(counties, island)),
    ):
        writers.write_geojson(features, f"{out}/geojson/{name}", [key], [key])


def shapes(
    filings: DataFrame,
    block_geom: DataFrame,
    block_hu_pop: DataFrame,
    large_blocks: DataFrame,
    out: str,
    threshold: float = BIG_TRACT_M2,
    pack_edges: int = dissolve.PACK_EDGES,
) -> dict[str, DataFrame]:
    """Block flags, boxes, tract areas, outlines and provider footprints."""
    land = flags.land_blocks(block_geom).withColumn("tract_id", tract_of("geoid10"))
    areas = _save(geometry.tract_area(block_geom), out, "tract_area")
    boxes = block_geom.select(
        "geoid10", "aland10", F.size(G.vertices(F.col("geom"))).alias("cost"), *G.bounds(F.col("geom"))
    )
    made = {
        "tract_area": areas,
        "block_boxes": _save(boxes, out, "block_boxes"),
        "h2only_undev": _save(flags.h2only_undev(block_hu_pop, block_geom), out, "h2only_undev"),
        "tract_outlines": _save(dissolve.dissolve_edges(land, "tract_id"), out, "tract_outlines"),
    }
    made["footprint_outlines"] = _save(
        geometry.footprint_edges(filings, block_geom), out, "footprint_outlines"
    )
    # counties from the tracts' outlines: the borders between tracts cancel
    county = made["tract_outlines"].withColumn("county_id", F.substring("tract_id", 1, COUNTY_LEN)).drop("mult")
    made["county_outlines"] = _save(dissolve.outline_edges(county, "county_id"), out, "county_outlines")
    # one geometry per area, for the rings of the map; what is too long for a
    # row stays as outline edges
    by_level = {
        level: dissolve.pack_outlines(made[f"{level}_outlines"], f"{level}_id", pack_edges=pack_edges)
        for level in ("tract", "county")
    }
    levels = [
        d.features.select(
            F.lit(level).alias("level"), F.col(f"{level}_id").alias("feature_id"), "geom"
        )
        for level, d in by_level.items()
    ]
    levels.append(
        block_geom.select(
            F.lit("block").alias("level"), F.col("geoid10").alias("feature_id"), "geom"
        )
    )
    made["features"] = _save(tiles.tile_union(*levels), out, "features", "level")
    long = [
        d.long_outlines.withColumnRenamed(f"{level}_id", "feature_id").withColumn(
            "level", F.lit(level)
        )
        for level, d in by_level.items()
    ]
    made["long_outlines"] = _save(tiles.tile_union(*long), out, "long_outlines", "level")
    made["bigtract_blocks"] = _save(
        geometry.blocks_in_big_tracts(made["block_boxes"], areas, threshold), out, "bigtract_blocks"
    )
    made["xl_blocks"] = _save(
        geometry.large_blocks_zoom(made["block_boxes"], large_blocks), out, "xl_blocks"
    )
    return made


def map_rings(
    made: dict[str, DataFrame], out: str, threshold: float = BIG_TRACT_M2
) -> DataFrame:
    """Geometry of the speed layers: simplified rings of each feature at each zoom.

    All tiers share it. Rings are kept once per feature and zoom instead of once
    per tile; the tile tables say which tiles a feature is in. A ring of an outline
    too long for one row has a row for each point: `part` names the ring, `seq`
    is the place on it, and `poly` and `ring` are null. `sign` is 1 for a shell and -1 for
    a hole of either kind.
    """
    small = geometry.notbig_tracts(made["tract_area"], threshold).select(
        F.col("tract_id").alias("feature_id")
    )
    in_big = made["bigtract_blocks"].select(F.col("geoid10").alias("feature_id"))

    def shown(features):
        at_nine = [
            features.filter(F.col("level") == whole)
            .join(part, "feature_id", "left_semi")
            .withColumn("level", F.lit(name))
            for whole, name, part in (
                ("tract", "smalltract", small),
                ("block", "bigtract_block", in_big),
            )
        ]
        return tiles.zoom_plan_features(tiles.tile_union(features, *at_nine))

    features = made["features"].select("level", "feature_id", F.lit(None).cast("string").alias("part"), "geom")
    keys = ["level", "feature_id", "part", "simplify", "detail"]
    rings = tiles.simplify_features(shown(features), keys).withColumns(
        {"sign": F.when(F.col("ring") == 0, 1).otherwise(-1), "seq": F.lit(None).cast("bigint")}
    )
    long = dissolve.signed_ring_edges(made["long_outlines"], "level", "feature_id")
    degrees = {c: F.col(c) / dissolve.GRID for c in ("x", "y", "nx", "ny")}
    long = shown(long.withColumns(degrees).withColumnRenamed("ring", "part").drop("n_points"))
    points = tiles.simplify_points(long, keys)
    return _save(rings.unionByName(points, allowMissingColumns=True), out, "rings", "level", "z")


def map_levels(made: dict[str, DataFrame], threshold: float = BIG_TRACT_M2) -> DataFrame:
    """(level, feature_id, geom) of the speed layers; an outline too long for a row is there as its blocks."""
    small = geometry.notbig_tracts(made["tract_area"], threshold).select(F.col("tract_id").alias("feature_id"))
    in_big = made["bigtract_blocks"].select(F.col("geoid10").alias("feature_id"))
    features = made["features"].select("level", "feature_id", "geom")
    long = made["long_outlines"].select("level", "feature_id").distinct()
    land = made["block_boxes"].filter("aland10 > 0").select(F.col("geoid10").alias("id"))
    blocks = features.filter("level = 'block'").select(F.col("feature_id").alias("id"), "geom").join(land, "id")
    area = F.array(*[F.struct(F.lit(n).alias("level"), k("id").alias("feature_id")) for n, k in (("tract", tract_of), ("county", county_of))])
    parts = blocks.select("geom", F.inline(area)).join(long, ["level", "feature_id"], "left_semi")
    features = features.unionByName(parts)
    at_nine = [
        features.filter(F.col("level") == whole).join(part, "feature_id", "left_semi").withColumn("level", F.lit(name))
        for whole, name, part in (("tract", "smalltract", small), ("block", "bigtract_block", in_big))
    ]
    return tiles.tile_union(features, *at_nine)


def map_pieces(made: dict[str, DataFrame], out: str, threshold: float = BIG_TRACT_M2) -> DataFrame:
    """Geometry of the speed layers tile by tile: rings clipped to the tile and its margin.

    All tiers share it. Points are whole numbers in the tile, by the detail of the
    level's band at the zoom. `whole` tiles lie inside the feature.
    """
    shapes_ = tg.over_bands(map_levels(made, threshold), tiles.SPEED_BANDS)
    pieces = tg.tile_pieces(shapes_, ["level", "feature_id"])
    plan = F.filter(tiles.plan_of("level"), lambda b: b["z"] == F.col("z"))
    pieces = pieces.withColumn("detail", F.get(plan, F.lit(0))["detail"]).filter("detail is not null")
    pieces = tg.quantised_pieces(pieces, detail=F.col("detail"))
    return _save(pieces.drop("ux"), out, "pieces", "level", "z")


def map_tiles(
    stats: dict[str, DataFrame],
    made: dict[str, DataFrame],
    out: str,
    tiers=TIERS,
    classes=TECH_CLASSES,
    threshold: float = BIG_TRACT_M2,
    budget: int = TILE_BUDGET,
) -> DataFrame:
    """Tile tables of every speed tier, the large blocks and the providers.

    Features are on the tiles that their pieces (`map_pieces`, in `made`) are on.
    """
    names = combo_names(classes)
    boxes = made["block_boxes"]
    small = geometry.notbig_tracts(made["tract_area"], threshold).select("tract_id")

    def areas(key, name, level):
        # as the shapes, areas are of land blocks only
        return (
            boxes.filter("aland10 > 0").groupBy(key.alias(name))
            .agg(
                F.sum("aland10").alias("size"),
                F.sum("cost").cast("bigint").alias("cost"),
                *[f(c).alias(c) for c, f in zip(geometry.BOX, (F.min, F.min, F.max, F.max))],
            )
            .withColumn("level", F.lit(level))
        )

    tract = areas(tract_of("geoid10"), "tract_id", "tract")
    county = areas(county_of("geoid10"), "county_id", "county")

    def blocks(df, level):
        cost = F.col("cost").cast("bigint").alias("cost")
        return df.select("geoid10", F.col("aland10").alias("size"), cost, *geometry.BOX).withColumn(
            "level", F.lit(level)
        )

    levels = [
        county.withColumnRenamed("county_id", "feature_id").withColumn("stat_kind", F.lit("county")),
        tract.withColumnRenamed("tract_id", "feature_id").withColumn("stat_kind", F.lit("tract")),
        tract.join(small, "tract_id", "left_semi")
        .withColumn("level", F.lit("smalltract"))
        .withColumnRenamed("tract_id", "feature_id")
        .withColumn("stat_kind", F.lit("tract")),
        *[
            blocks(df, level).withColumnRenamed("geoid10", "feature_id").withColumn("stat_kind", F.lit("block"))
            for df, level in ((made["bigtract_blocks"], "bigtract_block"), (boxes, "block"))
        ],
    ]
    values = [
        stats[f"{kind}_numprov"].selectExpr(
            "tier",
            f"'{kind}' as kind",
            f"{key} as feature_id",
            *[f"cast(`{n}` as double) as `{n}`" for n in names],
        )
        for kind, key in (("county", "county_id"), ("tract", "tract_id"), ("block", "geoid10"))
    ]
    touched = made["pieces"].select("level", "feature_id", "z", "x", "y").distinct()
    layers = [
        tiles.speed_layers(
            tiles.tile_union(*levels), touched, tiles.tile_union(*values), names, [t.name for t in tiers], budget
        )
    ]
    xl_blocks = made["xl_blocks"].drop("aland10", "cost")
    outlines = made["features"].filter("level = 'block'").select(F.col("feature_id").alias("geoid10"), "geom")
    outlines = outlines.join(xl_blocks.select("geoid10"), "geoid10").withColumn("level", F.lit("xl_block"))
    on = tg.touched_tiles(tg.over_bands(outlines, tiles.XL_BLOCK_BANDS), ["geoid10"])
    xl = tiles.xl_block_tiles(xl_blocks, on)
    layers.append(
        xl.select(
            F.lit("xl_blocks").alias("layer"), "z", "x", "y", "level",
            F.col("geoid10").alias("ord"), F.col("geoid10").alias("feature_id"), *geometry.BOX,
        )
    )
    foot = dissolve.outline_measures(made["footprint_outlines"], "hoconum", "county_fips")
    provider = tiles.provider_tiles(foot, flags.large_provider("hoconum"))
    layers.append(
        provider.withColumn("ord", F.lpad(F.col("ord").cast("string"), 10, "0"))
        .withColumn("feature_id", F.col("hoconum").cast("string"))
        .drop("hoconum")
    )
    # one write: a failure leaves no half of a release
    writers.write_tiles(tiles.tile_union(*layers), f"{out}/tiles")
    return boxes.sparkSession.read.parquet(f"{out}/tiles")
