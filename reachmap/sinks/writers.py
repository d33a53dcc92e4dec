"""CSV and GeoJSON exports.

Results are folders of part files which many tasks write. Where the order of
the rows matters, the parts are ranges of the key and sorted inside, so they
are in order when read one after the other.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_key_order(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_csv(
    df: DataFrame,
    path: str,
    columns: list[str] | None = None,
    order: list[str] | None = None,
    headers: dict[str, str] | None = None,
    compression: str = "none",
    **options,
) -> None:
    """CSV with a header. `headers` renames columns, `order` sorts by key."""
    out = df if order is None else in_key_order(df, *order)
    out = out.select(*columns) if columns else out
    if headers:
        out = out.withColumnsRenamed(headers)
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("compression", compression)
        .options(**options)
        .csv(path)
    )


def write_numprov_dir(counts: DataFrame, path: str, compression: str = "none") -> None:
    """Provider counts with a `tier` column as one folder `block_numprov_<tier>` per tier."""
    named = counts.withColumn("file", F.concat(F.lit("block_numprov_"), "tier")).drop("tier")
    (
        named.repartitionByRange("file", "geoid10")
        .sortWithinPartitions("file", "geoid10")
        .write.mode("overwrite")
        .partitionBy("file")
        .option("header", True)
        .option("compression", compression)
        .csv(path)
    )


def coordinates(geom: Column) -> Column:
    """Point structs to nested [lon, lat] arrays."""
    return F.transform(
        geom,
        lambda poly: F.transform(
            poly, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
        ),
    )


def geojson_lines(features: DataFrame, properties: list[str], geom: str = "geom") -> DataFrame:
    """One GeoJSON feature per row, in the column `value`."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        F.struct(
            F.lit("MultiPolygon").alias("type"), coordinates(F.col(geom)).alias("coordinates")
        ).alias("geometry"),
    )
    return features.select(F.to_json(feature).alias("value"))


def write_geojson(
    features: DataFrame,
    path: str,
    properties: list[str],
    order: list[str],
    geom: str = "geom",
    compression: str = "none",
) -> None:
    """Newline-delimited GeoJSON ordered by key."""
    lines = geojson_lines(in_key_order(features, *order), properties, geom)
    lines.write.mode("overwrite").option("compression", compression).text(path)


def write_ring_points(points: DataFrame, path: str, keys: list[str]) -> None:
    """Outlines too long for a feature each, as CSV rows of points in ring order."""
    write_csv(points, path, [*keys, "ring", "sign", "seq", "x", "y"], order=[*keys, "ring", "seq"])


def write_tiles(tiles: DataFrame, path: str) -> None:
    """Tile table as Parquet by layer and zoom."""
    tiles.write.mode("overwrite").partitionBy("layer", "z").parquet(path)
