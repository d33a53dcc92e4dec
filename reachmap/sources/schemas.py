"""Explicit input schemas; nothing is inferred, so FIPS codes keep their zeros."""

from pyspark.sql import types as T

# geometry: polygons -> rings -> points
POINT = T.StructType(
    [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
)
GEOM = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))

# header in the filings file -> (column, type)
FILING_HEADERS = {
    "Census Block FIPS Code": ("block_code", "string"),
    "Consumer": ("consumer", "int"),
    "Holding Company Number": ("hoconum", "int"),
    "Technology Code": ("tech_code", "int"),
    "Max Advertised Downstream Speed (mbps)": ("max_ad_down", "double"),
    "Max Advertised Upstream Speed (mbps)": ("max_ad_up", "double"),
}

BLOCK = (
    "geoid10 string, pop bigint, hu bigint, hh bigint, aianhhcc string, "
    "stateabbr string, h2only_undev tinyint, state_fips string, "
    "county_fips string, cbsa_code string, cdist_id string, tribal_id string, "
    "cplace_id string, urban_rural string, tribal_non string"
)
BLOCK_HU_POP = "block_fips string, hu2016 bigint, pop2016 bigint"
LARGE_BLOCK = "block_fips string, x_zoom int, y_zoom int"
TRACT_AREA = "tract_fips string, area double"
