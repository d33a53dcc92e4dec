"""Small inputs for the tests."""

FILING = (
    "block_code string, consumer int, hoconum int, tech_code int, "
    "max_ad_down double, max_ad_up double"
)
BLOCK = (
    "geoid10 string, pop bigint, hu bigint, h2only_undev tinyint, state_fips string, "
    "county_fips string, cbsa_code string, cdist_id string, tribal_id string, "
    "cplace_id string, urban_rural string, tribal_non string"
)
B1, B2, B3 = "010010000010001", "010010000010002", "010030000020001"
LOST = "990010000010001"


def filings(spark, *rows):
    """Rows of (block, hoconum, tech, down, up), all consumer filings."""
    return spark.createDataFrame([(r[0], 1, *r[1:]) for r in rows], FILING)


def blocks(spark, *rows):
    """Rows of (block, pop) with optional cbsa, urban_rural, tribal_non, flag."""
    full = []
    for r in rows:
        geoid, pop, cbsa, ur, tn, flag = (*r, *("M1", "U", "N", 0)[len(r) - 2 :])
        full.append(
            (geoid, pop, 1, flag, geoid[:2], geoid[:5], cbsa, geoid[:2] + "01", None, "", ur, tn)
        )
    return spark.createDataFrame(full, BLOCK)


def square(x, y, w=1.0, h=1.0):
    """Counter-clockwise rectangle as a one-polygon geometry."""
    pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return [[[{"x": float(a), "y": float(b)} for a, b in pts]]]
