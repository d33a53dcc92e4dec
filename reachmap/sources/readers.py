"""File and database sources."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import spread_join
from ..functions.keys import pad_block
from ..session import cut
from .schemas import BLOCK, BLOCK_HU_POP, FILING_HEADERS, GEOM, LARGE_BLOCK, TRACT_AREA


def number_or_null(col: Column) -> Column:
    """NaN is a missing speed, and Spark would rank it above every threshold."""
    return F.nanvl(col, F.lit(None).cast("double"))


def read_table(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    names: dict[str, str] | None = None,
    decimals: bool = True,
    **options,
) -> DataFrame:
    """CSV with a header, read by column name in any order.

    `names` maps a column to its header. Every needed header must be in each
    file's header, other columns are left out. Numbers may be written as
    decimals (130077.0); text that is neither blank nor a number is an error,
    not a null.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = names or {}
    raw = spark.read.option("header", True).option("enforceSchema", False).options(**options).csv(path)
    missing = [h for h in (names.get(f.name, f.name) for f in schema) if h not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {raw.columns}")
    return raw.select(
        [typed(F.col(f"`{names.get(f.name, f.name)}`"), f.dataType, f.name, decimals).alias(f.name) for f in schema]
    )


def typed(text: Column, kind: T.DataType, name: str, decimals: bool = True) -> Column:
    """Text as a value of a type; blank is null, anything else that does not fit an error.

    With `decimals`, whole numbers may be written with a decimal point.
    """
    if isinstance(kind, T.StringType):
        return text
    blank = text.isNull() | (F.trim(text) == "")
    value = F.trim(text).try_cast(kind)
    if decimals and isinstance(kind, T.IntegralType):
        number = F.trim(text).try_cast("double")
        value = F.coalesce(value, F.when(number == F.floor(number), F.floor(number)).try_cast(kind))
    wrong = F.raise_error(F.concat(F.lit(f"column {name}: not a {kind.simpleString()}: "), text))
    return F.when(blank, F.lit(None).cast(kind)).otherwise(F.coalesce(value, wrong.cast(kind)))


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    """Filings CSV with a header; the six needed columns are found by name."""
    schema = T.StructType(
        [T.StructField(n, T._parse_datatype_string(t)) for n, t in FILING_HEADERS.values()]
    )
    return normalise_filings(read_table(spark, path, schema, {n: h for h, (n, _) in FILING_HEADERS.items()}))


def normalise_filings(filings: DataFrame) -> DataFrame:
    return filings.withColumns(
        {
            "block_code": pad_block("block_code"),
            "max_ad_down": number_or_null(F.col("max_ad_down")),
            "max_ad_up": number_or_null(F.col("max_ad_up")),
        }
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Block master CSV with a header."""
    return read_table(spark, path, BLOCK).withColumn("geoid10", pad_block("geoid10"))


def read_block_hu_pop(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, BLOCK_HU_POP)


def read_tract_area(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, TRACT_AREA)


def read_large_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated, single-quoted list of blocks with their zoom per axis."""
    return read_table(spark, path, LARGE_BLOCK, sep="|", quote="'")


def read_numprov_dir(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Provider counts of all tiers from one folder of CSV files.

    The tier is not in the rows; it is taken from `block_numprov_<tier>` in the
    path of the file each row came from. `names` are the combination columns.
    """
    schema = T._parse_datatype_string(
        ", ".join(["geoid10 string", "h2only_undev tinyint"] + [f"{n} int" for n in names])
    )
    tier = F.regexp_extract("_metadata.file_path", r"block_numprov_([0-9_]+[0-9])", 1)
    raw = spark.read.options(header=True, enforceSchema=False, recursiveFileLookup=True).csv(path)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    columns = {f.name: typed(F.col(f"`{f.name}`"), f.dataType, f.name, False).alias(f.name) for f in schema}
    return raw.select(columns["geoid10"], tier.alias("tier"), *[columns[n] for n in ["h2only_undev", *names]])


# a JSON string; one of brackets and braces; anything between
_TOKEN = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]]|[^"{}\[\]]+)'
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def read_geojson(spark: SparkSession, path: str | list[str], properties: str) -> DataFrame:
    """GeoJSON features to attributes and a geometry column.

    Files with a feature or a collection per line, also between the wrapping lines
    of a collection, are parsed line by line. Other files, such as pretty-printed
    ones, are taken apart by the depth of their brackets (`spanning_features`). One
    look at the lines tells which file is which. Both kinds split into many tasks.

    Polygons, multipolygons and null geometries are read; another type of geometry is
    an error, and so is anything that is no whole feature, with its file and line.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    bare = F.regexp_replace("value", _STRING, "")
    delta = _count(bare, "{[") - _count(bare, "}]")
    whole = F.ltrim("value").startswith("{") & (delta == 0)
    kinds = lines.select("file", delta.alias("delta"), whole.alias("whole"), F.col("value").contains('"features"').alias("named"))
    kinds = kinds.groupBy("file").agg(
        F.sum(F.greatest("delta", F.lit(0))).alias("opened"),
        F.sum("delta").alias("left"),
        F.bool_or(~F.col("whole") & F.col("named")).alias("wrapped"),
    )
    by_line, spanning = {True: [], False: []}, []
    for r in kinds.toLocalIterator():  # the driver knows the list of files anyhow
        if r["opened"] == 0 and r["left"] == 0:
            by_line[False].append(r["file"])
        elif r["opened"] == 2 and r["left"] == 0 and r["wrapped"]:
            by_line[True].append(r["file"])
        else:
            spanning.append(r["file"])
    units = []
    for wrapped, files in by_line.items():
        if files:
            units.append(_features_by_line(spark.read.text(files), wrapped))
    if spanning:
        units.append(spanning_features(spark, spanning))
    if not units:
        units.append(_features_by_line(spark.read.text(path).filter(F.lit(False)), False))
    texts = units[0]
    for more in units[1:]:
        texts = texts.unionByName(more)
    return _parsed_features(texts, properties)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _place(file: Column, line: Column) -> Column:
    """File and line for messages; the number is counted from the beginning of a piece of the file."""
    return F.concat(file, F.lit(" near line "), line.cast("string"))


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their piece of the file and their number in the piece (rising, from the task's first row)."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("piece"),
        (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1).alias("line"),
    )


def _features_by_line(lines: DataFrame, wrapped: bool) -> DataFrame:
    """(text, at) of the lines that are whole objects; blank ones and a wrapper's go, others are an error."""
    rows = _numbered(lines)
    text = F.rtrim(F.trim("value"), F.lit(","))
    at = _place(F.col("file"), F.col("line"))
    whole = F.col("value").rlike(r"^\s*\{") & F.col("value").rlike(r"\}\s*,?\s*$")
    if not wrapped:
        wrong = F.raise_error(F.concat(F.lit("no GeoJSON feature: "), at, F.lit(": "), F.substring("value", 1, 80)))
        rows = rows.filter(F.when(whole | (F.trim("value") == ""), F.lit(True)).otherwise(wrong.cast("boolean")))
    return rows.filter(whole).select(text.alias("text"), at.alias("at"))


def spanning_features(spark: SparkSession, files: list[str]) -> DataFrame:
    """(text, at) of features that span lines, found by the depth of braces and brackets.

    Lines become tokens; sums within a piece of a file and over the pieces before it
    give each token's depth, whichever task reads it. In a collection a feature begins
    with a brace at depth one brace and one bracket, in other files at depth 0, and goes on to the
    matching one. A string never spans lines, as JSON has it. Unmatched brackets, text
    outside of objects and broken strings are errors.
    """
    rows = _numbered(spark.read.text(files))
    tokens = F.regexp_extract_all("value", F.lit(_TOKEN), 1)
    lost = F.length(F.array_join(tokens, "")) != F.length("value")
    at = _place(F.col("file"), F.col("line"))
    wrong = F.raise_error(F.concat(F.lit("broken string in GeoJSON: "), at))
    rows = rows.filter(F.when(lost, wrong.cast("boolean")).otherwise(F.lit(True)))
    rows = rows.select("file", "piece", "line", F.posexplode(tokens).alias("pos", "token"))
    brace = F.when(F.col("token") == "{", 1).when(F.col("token") == "}", -1).otherwise(0)
    bracket = F.when(F.col("token") == "[", 1).when(F.col("token") == "]", -1).otherwise(0)
    rows = cut(rows.withColumns({"brace": brace, "bracket": bracket}), "geojson-tokens")
    pieces = rows.groupBy("file", "piece").agg(F.sum("brace").alias("braces"), F.sum("bracket").alias("brackets"))
    broken = pieces.groupBy("file").agg(F.sum("braces").alias("a"), F.sum("brackets").alias("b")).filter("a != 0 or b != 0").first()
    if broken:
        raise ValueError(f"unmatched brackets in {broken['file']}")
    earlier = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = {f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("braces", "brackets")}
    offsets = cut(pieces.withColumns(before).drop("braces", "brackets"), "geojson-offsets")
    inside = Window.partitionBy("file", "piece").orderBy("line", "pos")
    rows = rows.join(offsets, ["file", "piece"]).withColumns(
        {
            # the depth before the token
            "b": F.col("braces_before") + F.sum("brace").over(inside) - F.col("brace"),
            "k": F.col("brackets_before") + F.sum("bracket").over(inside) - F.col("bracket"),
        }
    )
    rows = cut(rows.drop("braces_before", "brackets_before"), "geojson-depths")
    named = (F.col("token") == '"features"') & (F.col("b") == 1) & (F.col("k") == 0)
    collections = rows.groupBy("file").agg(F.bool_or(named).cast("int").alias("base"))
    rows = spread_join(rows, collections, "file")
    stray = (F.col("b") == 0) & ~F.col("token").isin("{", "}") & F.col("token").rlike(r"[^\s,\x1e]")
    wrong = F.raise_error(F.concat(F.lit("text outside of GeoJSON objects: "), _place(F.col("file"), F.col("line"))))
    rows = rows.filter(F.when(stray, wrong.cast("boolean")).otherwise(F.lit(True)))
    begins = (F.col("token") == "{") & (F.col("b") == F.col("base")) & (F.col("k") == F.col("base"))
    within = begins | ((F.col("b") > F.col("base")) & (F.col("k") >= F.col("base")))
    rows = rows.filter(within).withColumn("own", F.when(begins, F.struct("piece", "line", "pos")))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut(rows.withColumn("unit", F.last("own", ignorenulls=True).over(running)), "geojson-units")
    # A feature that goes on in the next piece of the file began in one before.
    last = rows.groupBy("file", "piece").agg(F.max("own").alias("last"))
    carried = last.withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).drop("last")
    rows = rows.join(cut(carried, "geojson-carried"), ["file", "piece"])
    rows = rows.withColumn("unit", F.coalesce("unit", "carried"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "line", "pos", "token"))), lambda t: t["token"]), "")
    texts = rows.groupBy("file", "unit").agg(text.alias("text"))
    return texts.select("text", _place(F.col("file"), F.col("unit.line")).alias("at"))


def _parsed_features(texts: DataFrame, properties: str) -> DataFrame:
    feature = f"type: string, properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>"
    whole = f"struct<{feature}, features: array<struct<{feature}>>, broken: string>"
    rows = texts.select("at", F.from_json("text", whole, {"columnNameOfCorruptRecord": "broken"}).alias("j"))
    wrong = F.raise_error(F.concat(F.lit("no GeoJSON feature: "), F.col("at"), F.lit(": "), F.substring("j.broken", 1, 80)))
    rows = rows.filter(F.when(F.col("j.broken").isNotNull(), wrong.cast("boolean")).otherwise(F.lit(True)))
    one = F.array(F.struct("j.type", "j.properties", "j.geometry"))
    # Objects of another type are members of the file that are no features.
    features = rows.select(
        F.explode(
            F.when(F.col("j.type") == "Feature", one).when(F.col("j.type") == "FeatureCollection", F.col("j.features"))
        ).alias("f")
    )
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygon = F.array(F.from_json(text, "array<array<array<double>>>"))
    multi = F.from_json(text, "array<array<array<array<double>>>>")
    other = F.raise_error(F.concat(F.lit("geometry of type "), kind))
    polygons = (
        F.when(kind == "Polygon", polygon)
        .when(kind == "MultiPolygon", multi)
        .when(kind.isNotNull(), other.cast("array<array<array<array<double>>>>"))
    )
    return features.select(F.col("f.properties").alias("props"), points_of(polygons).alias("geom")).select(
        "props.*", "geom"
    )


def points_of(polygons: Column) -> Column:
    """Nested [lon, lat] arrays to nested point structs."""
    return F.transform(
        polygons,
        lambda rings: F.transform(
            rings,
            lambda ring: F.transform(
                ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
            ),
        ),
    ).cast(GEOM)


def read_features_jdbc(spark: SparkSession, options: dict, query: str) -> DataFrame:
    """Attributes and well-known-binary geometry from a relational database.

    `query` runs on the server, e.g. `select geoid10, aland10, st_asbinary(geom)
    as wkb from block`. Connection and credentials come from `options` only.
    """
    return spark.read.format("jdbc").options(**options).option("query", query).load()
