"""The catalogue's queries as DuckDB SQL over the same test tables.

Written by other plans than the engine's: distinct counts per combination
instead of masks, windows instead of aggregate-and-join, a search for the
reverse edge instead of a cancelling sum, a recursive walk instead of pointer
doubling.
"""

from ..constants import (
    BBOX_OVERRIDES,
    DOWN_THRESHOLDS,
    LARGE_PROVIDERS,
    PROVIDER_GROUPS,
    TECH_CLASSES,
    TIERS,
    UP_THRESHOLDS,
    combo_layout,
    combos,
)
from ..operators.tile_geometry import CURVE_BITS, LEAST_AREA, MARGIN
from ..operators.tiles import PROVIDER_BANDS, SPEED_BANDS, XL_BLOCK_BANDS, base_bands
from ..sources.fixtures import CARTO_EXTRA_STATE, GRID_WIDTH, ISLANDS, TECH_CODES
from .catalog import ALL_TECH, BASE_BUDGET, BASE_ZOOMS, BLOCK_COST, DENSE_BUDGET, THIN_BUDGET, TIER


def _strings(values):
    return ", ".join(f"'{v}'" for v in values)


def _numbers(values):
    return ", ".join(str(v) for v in values)


def _bands(bands):
    rows = []
    for b in bands:
        drop = "NULL" if b.drop_attr is None else f"'{b.drop_attr}'"
        rows.append(
            f"('{b.level}', {b.zmin}, {b.zmax}, {b.simplify}, {b.coalesce}, {b.thin}, "
            f"{b.detail}, {drop})"
        )
    head = "(level, zmin, zmax, simplify, coalesce, thin, detail, drop_attr)"
    return f"(VALUES {', '.join(rows)}) AS p{head}"


_LETTERS = list(TECH_CLASSES)
_BITS = {c: 1 << (len(_LETTERS) - 1 - i) for i, c in enumerate(_LETTERS)}

# common table expressions, in order of use
CTES = {
    "cust": f"""
SELECT *, lpad(c_nationkey::VARCHAR, 2, '0') AS state_fips,
  lpad(c_nationkey::VARCHAR, 2, '0')
  || lpad(((c_custkey % 4) // 2)::VARCHAR, 3, '0')
  || lpad((((c_custkey // 4) // 10000) * 4 + c_custkey % 4)::VARCHAR, 6, '0')
  || lpad(((c_custkey // 4) % 10000)::VARCHAR, 4, '0') AS geoid10,
  CASE WHEN c_nationkey = 24 THEN 0
       ELSE floor(greatest(c_acctbal, 0))::BIGINT END AS pop,
  c_custkey % 50 AS hu,
  CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE c_custkey * 1000 END AS aland10
FROM customer""",
    "block": """
SELECT geoid10, pop, hu, c_custkey % 40 AS hh,
  CASE WHEN c_custkey % 11 = 0 THEN lpad((c_custkey % 3)::VARCHAR, 4, '0') END AS aianhhcc,
  'S' || state_fips AS stateabbr,
  (CASE WHEN aland10 = 0 THEN 1 WHEN hu = 0 AND pop = 0 THEN 2 ELSE 0 END)::TINYINT
    AS h2only_undev,
  state_fips, substr(geoid10, 1, 5) AS county_fips,
  CASE WHEN c_custkey % 5 <> 0 THEN 'M' || n_regionkey::VARCHAR END AS cbsa_code,
  state_fips || (c_custkey % 2)::VARCHAR AS cdist_id,
  CASE WHEN c_custkey % 11 = 0 THEN 'T' || (c_custkey % 3)::VARCHAR END AS tribal_id,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'P' || (c_custkey % 20)::VARCHAR END AS cplace_id,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 'U' ELSE 'R' END
    AS urban_rural,
  CASE WHEN c_custkey % 11 = 0 THEN 'T' ELSE 'N' END AS tribal_non
FROM cust JOIN nation ON c_nationkey = n_nationkey""",
    "filing": f"""
SELECT CASE WHEN l_suppkey % 10 = 0 AND o_custkey % 97 = 0
            THEN '99' || substr(geoid10, 3) ELSE geoid10 END AS block_code,
  CASE WHEN l_returnflag = 'R' OR o_custkey % 17 = 0 THEN 0 ELSE 1 END AS consumer,
  CASE WHEN l_orderkey % 89 <> 0 THEN (130000 + l_suppkey)::INTEGER END AS hoconum,
  CASE WHEN l_orderkey % 83 <> 0
       THEN ([{_numbers(TECH_CODES)}])[(l_partkey % 15)::INTEGER + 1] END AS tech_code,
  CASE WHEN l_orderkey % 79 = 0 THEN NULL
       WHEN l_linenumber = 1 THEN l_quantity / 10 ELSE l_extendedprice / 100 END
    AS max_ad_down,
  CASE WHEN l_orderkey % 73 = 0 THEN NULL WHEN l_linenumber <= 3
       THEN ((l_orderkey * 31 + l_partkey * 17) % 1200)::DOUBLE / 40
       ELSE ((l_orderkey * 31 + l_partkey * 17) % 1200)::DOUBLE END AS max_ad_up
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN cust ON o_custkey = c_custkey""",
    "large": """
SELECT geoid10 AS block_fips,
  CASE WHEN c_custkey % 29 = 0 THEN (5 + c_custkey % 6)::INTEGER END AS x_zoom,
  CASE WHEN c_custkey % 29 = 0 OR c_custkey % 31 = 0 THEN (5 + c_custkey % 5)::INTEGER END AS y_zoom
FROM cust""",
    "cf": "SELECT * EXCLUDE (consumer) FROM filing WHERE consumer = 1",
    # providers and their maxima know no missing key; block counts take one as 0
    "known": "SELECT * FROM cf WHERE hoconum IS NOT NULL AND tech_code IS NOT NULL",
    "tech": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({code}, '{c}', {_BITS[c]})" for c, codes in TECH_CLASSES.items() for code in codes
    )
    + ") t(code, class, bit)",
    "tier": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{t.name}', {t.down}::DOUBLE, {t.up}::DOUBLE, '{t.speed}', {i})"
        for i, t in enumerate(TIERS)
    )
    + ") t(tier, down, up, speed, tier_no)",
    "combo": "SELECT * FROM (VALUES "
    + ", ".join(f"({k}, '{n}')" for k, n in combos())
    + ") t(k, combo)",
    "d1": """
SELECT block_code, hoconum, tech_code, max(max_ad_down) AS max_down, max(max_ad_up) AS max_up
FROM known GROUP BY ALL""",
    "d0": """
SELECT block_code, coalesce(hoconum, 0) AS hoconum, coalesce(tech_code, 0) AS tech_code,
  max(max_ad_down) AS max_down, max(max_ad_up) AS max_up
FROM cf GROUP BY ALL""",
    "cnt": """
SELECT block_code AS geoid10, tier, k, count(DISTINCT hoconum) AS n
FROM d0 JOIN tech ON tech_code = code
JOIN tier ON max_down >= down AND max_up >= up
JOIN combo ON k & bit <> 0
GROUP BY ALL""",
    "spine": "SELECT geoid10 FROM block UNION SELECT block_code FROM cf",
    "counts": """
SELECT s.geoid10, t.tier, c.k, c.combo, coalesce(n, 0) AS n
FROM spine s CROSS JOIN tier t CROSS JOIN combo c
LEFT JOIN cnt ON cnt.geoid10 = s.geoid10 AND cnt.tier = t.tier AND cnt.k = c.k""",
    "wide": "SELECT geoid10, "
    + ", ".join(f'max(n) FILTER (k = {k}) AS "{n}"' for k, n in combos())
    + f" FROM counts WHERE tier = '{TIER.name}' GROUP BY geoid10",
    "flagged": """
SELECT wide.geoid10, h2only_undev, wide.* EXCLUDE (geoid10)
FROM wide LEFT JOIN block USING (geoid10)""",
    "cell": f"""
SELECT geoid10, aland10, substr(geoid10, 1, 11) AS tract_id,
  (rn % {GRID_WIDTH})::BIGINT AS cx, (rn // {GRID_WIDTH})::BIGINT AS cy
FROM (SELECT geoid10, aland10, row_number() OVER (ORDER BY geoid10) - 1 AS rn FROM cust)""",
    "box": """
SELECT geoid10, aland10, tract_id, cx::DOUBLE AS minx, cy::DOUBLE AS miny,
  cx::DOUBLE + 1 AS maxx, cy::DOUBLE + 1 AS maxy FROM cell""",
    "degree": """
SELECT geoid10, aland10, tract_id,
  -120::DOUBLE + 0.01::DOUBLE * minx AS minx, 30::DOUBLE + 0.01::DOUBLE * miny AS miny,
  -120::DOUBLE + 0.01::DOUBLE * maxx AS maxx, 30::DOUBLE + 0.01::DOUBLE * maxy AS maxy
FROM box""",
    "corner": """
SELECT geoid10, tract_id, aland10, seq,
  CASE WHEN seq IN (1, 2) THEN maxx ELSE minx END AS lon,
  CASE WHEN seq IN (2, 3) THEN maxy ELSE miny END AS lat
FROM degree CROSS JOIN range(5) s(seq)""",
    "metre": """
SELECT geoid10, tract_id, aland10, seq, radians(lon) * 6378137.0::DOUBLE AS mx,
  ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0::DOUBLE AS my FROM corner""",
    # a block is a rectangle in Mercator metres too
    "tractm2": """
SELECT tract_id, round(sum(w * h))::BIGINT AS area_m2, sum(w * h) AS area
FROM (SELECT geoid10, tract_id, max(mx) - min(mx) AS w, max(my) - min(my) AS h
      FROM metre WHERE aland10 > 0 GROUP BY ALL)
GROUP BY tract_id""",
    "typical": "SELECT avg(area_m2) + 0.5 AS m2 FROM tractm2",
    "side": """
SELECT geoid10, tract_id, aland10, unnest([
  {'x1': cx, 'y1': cy, 'x2': cx + 1, 'y2': cy},
  {'x1': cx + 1, 'y1': cy, 'x2': cx + 1, 'y2': cy + 1},
  {'x1': cx + 1, 'y1': cy + 1, 'x2': cx, 'y2': cy + 1},
  {'x1': cx, 'y1': cy + 1, 'x2': cx, 'y2': cy}], recursive := true)
FROM cell""",
    "provblock": """
SELECT DISTINCT hoconum, substr(geoid10, 1, 5) AS county_fips, geoid10
FROM cf JOIN cell ON block_code = geoid10 WHERE hoconum IS NOT NULL""",
    "footprint": """
SELECT hoconum, county_fips, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx,
  max(maxy) AS maxy
FROM provblock JOIN degree USING (geoid10) GROUP BY ALL""",
    "wtract": "WEIGHTED:tract_id:11",
    "wcounty": "WEIGHTED:county_id:5",
    "rects": f"""
SELECT tract_id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
FROM box WHERE substr(tract_id, 1, 2) NOT IN ({_strings(ISLANDS)}) GROUP BY ALL""",
    "cartotract": f"""
SELECT tract_id, (maxx - minx) * (maxy - miny) AS area, minx, miny, maxx, maxy FROM rects
UNION ALL
SELECT tract_id, count(*)::DOUBLE, min(minx), min(miny), max(maxx), max(maxy) FROM box
WHERE aland10 > 0 AND substr(tract_id, 1, 2) IN ({_strings(ISLANDS)}) GROUP BY ALL""",
    "cartocounty": f"""
SELECT geoid10, (maxx - minx) * (maxy - miny) AS area, minx, miny, maxx, maxy
FROM (SELECT substr(tract_id, 1, 5) AS geoid10, min(minx) AS minx, min(miny) AS miny,
        max(maxx) AS maxx, max(maxy) AS maxy FROM rects GROUP BY ALL)
UNION ALL
SELECT substr(geoid10, 1, 5) AS geoid10, count(*)::DOUBLE, min(minx), min(miny), max(maxx),
  max(maxy) FROM box
WHERE aland10 > 0 AND substr(tract_id, 1, 2) IN ({_strings(ISLANDS)})
GROUP BY substr(geoid10, 1, 5)""",
    "layerbox": """
SELECT layer, geoid, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
FROM (SELECT 'state' AS layer, substr(geoid10, 1, 2) AS geoid, box.* FROM box
      UNION ALL SELECT 'county', substr(geoid10, 1, 5), box.* FROM box
      UNION ALL SELECT 'cd115', substr(geoid10, 1, 2) || substr(geoid10, 4, 2), box.* FROM box)
GROUP BY ALL""",
    "level": """
SELECT 'county' AS level, substr(geoid10, 1, 5) AS feature_id, min(minx) AS minx,
  min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM degree GROUP BY ALL
UNION ALL
SELECT 'tract', tract_id, min(minx), min(miny), max(maxx), max(maxy) FROM degree GROUP BY ALL
UNION ALL
SELECT 'smalltract', tract_id, min(minx), min(miny), max(maxx), max(maxy) FROM degree
WHERE aland10 > 0 AND tract_id IN
  (SELECT tract_id FROM tractm2 WHERE area <= (SELECT m2 FROM typical)) GROUP BY ALL
UNION ALL
SELECT 'bigtract_block', geoid10, minx, miny, maxx, maxy FROM degree WHERE tract_id IN
  (SELECT tract_id FROM tractm2 WHERE area > (SELECT m2 FROM typical))
UNION ALL
SELECT 'block', geoid10, minx, miny, maxx, maxy FROM degree""",
}


def _weighted(name, length):
    ratios = ", ".join(
        f"coalesce(CASE WHEN tp > 0 THEN round_even(max(s) FILTER (k = {k}) / tp, 1) "
        f'ELSE (max(s) FILTER (k = {k}))::DOUBLE END, 0) AS "{n}"'
        for k, n in combos()
    )
    return f"""
SELECT {name}, tier, {ratios}, coalesce(tp > 0, false) AS is_populated
FROM (SELECT substr(c.geoid10, 1, {length}) AS {name}, tier, k,
        coalesce(sum(n * pop), 0)::BIGINT AS s
      FROM counts c LEFT JOIN block USING (geoid10) GROUP BY ALL) w
LEFT JOIN (SELECT substr(geoid10, 1, {length}) AS {name}, sum(pop)::BIGINT AS tp
           FROM block GROUP BY ALL) p USING ({name})
GROUP BY {name}, tier, tp"""


def _with(*names: str, recursive: str = "") -> str:
    """WITH clause of the named tables and all they build on."""
    order = list(CTES)
    needed = set(names)
    for name in reversed(order):
        if name not in needed:
            continue
        body = _body(name)
        for other in order[: order.index(name)]:
            if f" {other} " in f" {body} ".replace("\n", " ").replace("(", " ").replace(
                ")", " "
            ).replace(",", " "):
                needed.add(other)
    parts = [f"{n} AS ({_body(n)})" for n in order if n in needed]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts + ([recursive] if recursive else [])) + "\n"


def _body(name):
    body = CTES[name]
    if body.startswith("WEIGHTED:"):
        _, column, length = body.split(":")
        return _weighted(column, int(length))
    return body


def _threshold_sums():
    cols = []
    for letter, speed, values in (("d", "max_down", DOWN_THRESHOLDS), ("u", "max_up", UP_THRESHOLDS)):
        for i, t in enumerate(values, 1):
            cols.append(
                f"CASE WHEN count(*) = count(pop) THEN "
                f"coalesce(sum(pop) FILTER ({speed} >= {t}::DOUBLE), 0)::BIGINT END AS {letter}_{i}"
            )
    return ", ".join(cols)


def _provider_grain(source, keys):
    return f"""
SELECT {keys}, {_threshold_sums()}
FROM ({source}) g LEFT JOIN (SELECT geoid10, pop FROM block) b ON block_code = geoid10
GROUP BY ALL"""


_ALL = "SELECT block_code, hoconum, max(max_ad_down) AS max_down, max(max_ad_up) AS max_up FROM known GROUP BY ALL"
# a filing without a technology code adds its block to the provider, but no speed
_ALL_BLOCKS = (
    "SELECT block_code, hoconum, max(max_ad_down) FILTER (tech_code IS NOT NULL) AS max_down, "
    "max(max_ad_up) FILTER (tech_code IS NOT NULL) AS max_up FROM cf WHERE hoconum IS NOT NULL GROUP BY ALL"
)
_CLASSES = "\nUNION ALL\n".join(
    f"SELECT block_code, hoconum, '{g}' AS tech, max(max_ad_down) AS max_down, "
    f"max(max_ad_up) AS max_up FROM known WHERE tech_code IN ({_numbers(codes)}) GROUP BY ALL"
    for g, codes in PROVIDER_GROUPS.items()
)
_PROVIDER_TABLE = (
    _with("block", "cf", "known", "d1")
    + _provider_grain(f"SELECT *, 'all' AS tech FROM ({_ALL_BLOCKS})", "hoconum, tech")
    + " UNION ALL "
    + _provider_grain(_CLASSES, "hoconum, tech")
    + " UNION ALL "
    + _provider_grain(
        "SELECT block_code, hoconum, tech_code::VARCHAR AS tech, max_down, max_up FROM d1",
        "hoconum, tech",
    )
)

_COUNTY_NPROV = """
SELECT county_fips AS id, least(n, 3) AS nprovs, urban_rural, tribal_non,
  sum(pop)::BIGINT AS pop
FROM block JOIN counts USING (geoid10)
WHERE tier = '%s' AND combo = '%s' GROUP BY ALL""" % (TIER.name, ALL_TECH)

_HAS = ", ".join(
    f"coalesce(sum(pop) FILTER ({cond}), 0)::BIGINT AS {name}"
    for cond, name in (("n = 0", "has_0"), ("n = 1", "has_1"), ("n = 2", "has_2"), ("n >= 3", "has_3plus"))
)
_AREA_TABLE = (
    _with("block", "counts", "tier")
    + f"""
SELECT type, id, combo AS tech, tier, speed, urban_rural, tribal_non, {_HAS}
FROM (
  SELECT 'nation' AS type, '0' AS id, geoid10, pop, urban_rural, tribal_non FROM block
  UNION ALL SELECT 'state', state_fips, geoid10, pop, urban_rural, tribal_non FROM block
  UNION ALL SELECT 'county', county_fips, geoid10, pop, urban_rural, tribal_non FROM block
  UNION ALL SELECT 'cbsa', cbsa_code, geoid10, pop, urban_rural, tribal_non FROM block
  UNION ALL SELECT 'cd', cdist_id, geoid10, pop, urban_rural, tribal_non FROM block
  UNION ALL SELECT 'tribal', tribal_id, geoid10, pop, urban_rural, tribal_non FROM block
  UNION ALL SELECT 'place', cplace_id, geoid10, pop, urban_rural, tribal_non FROM block
) JOIN counts USING (geoid10) JOIN tier USING (tier)
WHERE id IS NOT NULL AND id <> '' GROUP BY ALL"""
)


def _outline(source, keys):
    """Sides whose reverse does not occur under the same key."""
    ks = keys.split(", ")
    same = " AND ".join(f"r.{k} = s.{k}" for k in ks)
    return f"""
SELECT {keys}, x1::BIGINT AS x1, y1::BIGINT AS y1, x2::BIGINT AS x2, y2::BIGINT AS y2,
  1::BIGINT AS mult
FROM ({source}) s WHERE NOT EXISTS (
  SELECT 1 FROM ({source}) r WHERE {same}
  AND r.x1 = s.x2 AND r.y1 = s.y2 AND r.x2 = s.x1 AND r.y2 = s.y1)"""


_LAND_SIDES = "SELECT tract_id, x1, y1, x2, y2 FROM side WHERE aland10 > 0"

# walk each ring from every edge, turning left first, and keep the walk that
# starts at the ring's smallest edge
_RINGS = f"""
edge AS ({_outline(_LAND_SIDES, "tract_id")}),
step AS (
  SELECT tract_id, x1, y1, x2, y2, nx, ny FROM (
    SELECT a.*, b.x2 AS nx, b.y2 AS ny, row_number() OVER (
        PARTITION BY a.tract_id, a.x1, a.y1, a.x2, a.y2
        ORDER BY (a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1) DESC) AS turn
    FROM edge a JOIN edge b ON b.tract_id = a.tract_id AND b.x1 = a.x2 AND b.y1 = a.y2)
  WHERE turn = 1),
walk AS (
  SELECT tract_id, x1 AS sx1, y1 AS sy1, x2 AS sx2, y2 AS sy2, 0::BIGINT AS seq, x1, y1, x2, y2
  FROM edge
  UNION ALL
  SELECT w.tract_id, sx1, sy1, sx2, sy2, seq + 1, s.x2, s.y2, s.nx, s.ny
  FROM walk w JOIN step s ON s.tract_id = w.tract_id AND s.x1 = w.x1 AND s.y1 = w.y1
    AND s.x2 = w.x2 AND s.y2 = w.y2
  WHERE (s.x2, s.y2, s.nx, s.ny) <> (sx1, sy1, sx2, sy2)
    AND (s.x2, s.y2, s.nx, s.ny) > (sx1, sy1, sx2, sy2))"""


def _world(lon, lat, z):
    wx = f"((({lon}) + 180::DOUBLE) / 360::DOUBLE) * pow(2, {z})"
    r = f"radians({lat})"
    wy = f"((1 - ln(tan({r}) + 1 / cos({r})) / pi()) / 2) * pow(2, {z})"
    return wx, wy


def _cover(source, columns):
    """Tiles of the boxes in `source`, which has a zoom z."""
    x0, y1 = _world("minx", "miny", "z")
    x1, y0 = _world("maxx", "maxy", "z")
    return f"""
SELECT {columns}, z, x::INTEGER AS x, unnest(range(y0, y1 + 1))::INTEGER AS y
FROM (SELECT *, unnest(range(x0, x1 + 1)) AS x
      FROM (SELECT *, floor({x0})::BIGINT AS x0, floor({x1})::BIGINT AS x1,
              floor({y0})::BIGINT AS y0, floor({y1})::BIGINT AS y1
            FROM ({source})))"""


def _zoomed(zmin, zmax, source="degree"):
    return f"SELECT *, unnest(range({zmin}, {zmax + 1}))::INTEGER AS z FROM {source}"


_PLAN_COLUMNS = "level, feature_id, z, simplify, coalesce, thin, detail, drop_attr"


def _planned(source, bands):
    return f"""
SELECT *, unnest(range(zmin, zmax + 1))::INTEGER AS z
FROM {source} JOIN {_bands(bands)} USING (level)"""


_COUNTIES = f"""(SELECT substr(geoid10, 1, 5) AS geoid10, sum(aland10)::BIGINT AS aland10,
  (count(*) * {BLOCK_COST})::BIGINT AS cost, min(minx) AS minx, min(miny) AS miny,
  max(maxx) AS maxx, max(maxy) AS maxy FROM degree GROUP BY ALL)"""
_SIZED = f"""
SELECT 'block' AS layer, z, x, y, geoid10, aland10 AS size, {BLOCK_COST}::BIGINT AS cost,
  minx, miny, maxx, maxy
FROM ({_cover(_zoomed(5, 14), "geoid10, aland10, minx, miny, maxx, maxy")})
UNION ALL
SELECT 'county', z, x, y, geoid10, aland10, cost, minx, miny, maxx, maxy
FROM ({_cover(_zoomed(0, 9, _COUNTIES), "geoid10, aland10, cost, minx, miny, maxx, maxy")})"""
_RANKED = f"""
SELECT *, run_cost <= {THIN_BUDGET} OR place = 1 AS keep FROM (
  SELECT *, (sum(cost) OVER ranks)::BIGINT AS run_cost, row_number() OVER ranks AS place
  FROM ({_SIZED})
  WINDOW ranks AS (PARTITION BY layer, z, x, y ORDER BY size DESC, geoid10 ROWS UNBOUNDED PRECEDING))"""

# position of a box centre among the 8 x 8 cells of its tile
_CX, _CY = _world("(minx + maxx) / 2", "(miny + maxy) / 2", "z")
_CELLED = f"""
SELECT *, least(greatest(floor(({_CX} - x) * 8), 0), 7)::INTEGER AS gx,
  least(greatest(floor(({_CY} - y) * 8), 0), 7)::INTEGER AS gy FROM ({_RANKED})"""
_FOLDING = f"""
pair AS (
  SELECT b.layer, b.z, b.x, b.y, b.size, b.cost, b.geoid10 AS small, k.geoid10,
    row_number() OVER (PARTITION BY b.layer, b.z, b.x, b.y, b.geoid10 ORDER BY
      CASE WHEN b.gx = k.gx AND b.gy = k.gy THEN 3
           WHEN b.gx // 2 = k.gx // 2 AND b.gy // 2 = k.gy // 2 THEN 2
           WHEN b.gx // 4 = k.gx // 4 AND b.gy // 4 = k.gy // 4 THEN 1 ELSE 0 END DESC,
      k.size DESC, k.geoid10) AS choice
  FROM ranked b JOIN ranked k ON b.z = k.z AND b.x = k.x AND b.y = k.y
    AND b.layer = k.layer AND NOT b.keep AND k.keep),
folded AS (
  SELECT layer, z, x, y, geoid10, count(*) AS folded_n, sum(size)::BIGINT AS folded_size,
    sum(cost)::BIGINT AS folded_cost
  FROM pair WHERE choice = 1 GROUP BY ALL)"""
_FOLD = f"""
ranked AS ({_CELLED}),{_FOLDING}"""


def _areas_of(level, key, where):
    return f"""
SELECT '{level}' AS level, {key} AS geoid10, sum(aland10)::BIGINT AS size,
  (count(*) * {BLOCK_COST})::BIGINT AS cost, min(minx) AS minx, min(miny) AS miny,
  max(maxx) AS maxx, max(maxy) AS maxy FROM degree WHERE aland10 > 0 {where} GROUP BY ALL"""


_BIG = "(SELECT tract_id FROM tractm2 WHERE area > (SELECT m2 FROM typical))"
_ONE = f"SELECT '%s', geoid10, aland10, {BLOCK_COST}::BIGINT, minx, miny, maxx, maxy FROM degree %s"
_SPEED_FEATURES = " UNION ALL ".join(
    [
        _areas_of("county", "substr(geoid10, 1, 5)", ""),
        _areas_of("tract", "tract_id", ""),
        _areas_of("smalltract", "tract_id", f"AND tract_id NOT IN {_BIG}"),
        _ONE % ("bigtract_block", f"WHERE tract_id IN {_BIG}"),
        _ONE % ("block", ""),
    ]
)
# an area is on the tiles of its land blocks
_MEMBERS = " UNION ALL ".join(
    [
        "SELECT 'county' AS level, substr(geoid10, 1, 5) AS geoid10, minx, miny, maxx, maxy FROM degree WHERE aland10 > 0",
        "SELECT 'tract', tract_id, minx, miny, maxx, maxy FROM degree WHERE aland10 > 0",
        f"SELECT 'smalltract', tract_id, minx, miny, maxx, maxy FROM degree WHERE aland10 > 0 AND tract_id NOT IN {_BIG}",
        f"SELECT 'bigtract_block', geoid10, minx, miny, maxx, maxy FROM degree WHERE tract_id IN {_BIG}",
        "SELECT 'block', geoid10, minx, miny, maxx, maxy FROM degree",
    ]
)
_SPEED_COVER = f"""
SELECT f.level, f.geoid10, f.size, f.cost, f.minx, f.miny, f.maxx, f.maxy, f.coalesce, f.thin, f.drop_attr, z, x, y
FROM ({_planned(f"({_SPEED_FEATURES})", SPEED_BANDS)}) f
JOIN (SELECT DISTINCT level, geoid10, z, x, y
      FROM ({_cover(_planned(f"({_MEMBERS})", SPEED_BANDS), "level, geoid10")})) t USING (level, geoid10, z)"""


def _pieces(zmin, zmax):
    """Blocks clipped to the tiles they are on, with the margin: sides in tile units."""
    wx0, wy1 = _world("minx", "miny", "z")
    wx1, wy0 = _world("maxx", "maxy", "z")
    m, u = f"{MARGIN}::DOUBLE", "4096"
    return f"""
SELECT *, qx1 > qx0 AND qy1 > qy0 AS solid FROM (
SELECT geoid10, aland10, z, x, y, round((greatest({wx0}, x - {m}) - x) * {u})::BIGINT AS qx0,
  round((least({wx1}, x + 1 + {m}) - x) * {u})::BIGINT AS qx1,
  round((greatest({wy0}, y - {m}) - y) * {u})::BIGINT AS qy0,
  round((least({wy1}, y + 1 + {m}) - y) * {u})::BIGINT AS qy1
FROM ({_cover(_zoomed(zmin, zmax), "geoid10, aland10, minx, miny, maxx, maxy")}))"""


_SIDES = """unnest([
  {'x1': qx0, 'y1': qy0, 'x2': qx1, 'y2': qy0}, {'x1': qx1, 'y1': qy0, 'x2': qx1, 'y2': qy1},
  {'x1': qx1, 'y1': qy1, 'x2': qx0, 'y2': qy1}, {'x1': qx0, 'y1': qy1, 'x2': qx0, 'y2': qy0}
], recursive := true)"""
_MERGE = f"""
piece AS ({_pieces(8, 10)}),
ranked AS (
  SELECT *, (sum({BLOCK_COST}) OVER ranks)::BIGINT <= {THIN_BUDGET} OR row_number() OVER ranks = 1 AS keep,
    row_number() OVER ranks AS place FROM piece
  WINDOW ranks AS (PARTITION BY z, x, y ORDER BY aland10 DESC, geoid10 ROWS UNBOUNDED PRECEDING)),
beside AS (
  SELECT a.z, a.x, a.y, a.geoid10, a.keep, a.place, b.geoid10 AS other, b.place AS other_place, b.aland10 AS other_size,
    CASE WHEN a.qx0 = b.qx0 THEN a.qx1 - a.qx0 ELSE a.qy1 - a.qy0 END AS border
  FROM ranked a JOIN ranked b ON a.z = b.z AND a.x = b.x AND a.y = b.y AND a.solid AND b.solid AND (
    (a.qy0 = b.qy0 AND a.qy1 = b.qy1 AND (a.qx1 = b.qx0 OR a.qx0 = b.qx1))
    OR (a.qx0 = b.qx0 AND a.qx1 = b.qx1 AND (a.qy1 = b.qy0 OR a.qy0 = b.qy1)))),
up AS (
  SELECT z, x, y, geoid10, other FROM beside WHERE NOT keep AND other_place < place
  QUALIFY row_number() OVER (PARTITION BY z, x, y, geoid10 ORDER BY border DESC, other_size DESC, other) = 1),
chain AS (
  SELECT z, x, y, geoid10, geoid10 AS at FROM ranked
  UNION ALL
  SELECT c.z, c.x, c.y, c.geoid10, up.other FROM chain c JOIN up ON up.z = c.z AND up.x = c.x AND up.y = c.y AND up.geoid10 = c.at),
target AS (
  SELECT c.z, c.x, c.y, c.geoid10, CASE WHEN r.keep THEN c.at ELSE f.geoid10 END AS target
  FROM chain c JOIN ranked r ON r.z = c.z AND r.x = c.x AND r.y = c.y AND r.geoid10 = c.at
  JOIN ranked f ON f.z = c.z AND f.x = c.x AND f.y = c.y AND f.place = 1
  WHERE NOT EXISTS (SELECT 1 FROM up WHERE up.z = c.z AND up.x = c.x AND up.y = c.y AND up.geoid10 = c.at)),
inner_border AS (
  SELECT b.z, b.x, b.y, s.target, count(*) AS n FROM beside b
  JOIN target s ON s.z = b.z AND s.x = b.x AND s.y = b.y AND s.geoid10 = b.geoid10
  JOIN target t ON t.z = b.z AND t.x = b.x AND t.y = b.y AND t.geoid10 = b.other
  WHERE s.target = t.target GROUP BY ALL)"""
_MERGED = f"""
SELECT 'block' AS layer, p.z, p.x, p.y, t.target AS geoid10,
  max(aland10) FILTER (p.geoid10 = t.target) AS size, {BLOCK_COST}::BIGINT AS cost,
  (count(*) - 1)::BIGINT AS folded_n, coalesce(sum(aland10) FILTER (p.geoid10 <> t.target), 0)::BIGINT AS folded_size,
  ((count(*) - 1) * {BLOCK_COST})::BIGINT AS folded_cost,
  (sum(2 * (qx1 - qx0) * (qy1 - qy0)))::BIGINT AS area2,
  (4 * count(*) FILTER (solid) - coalesce(any_value(n), 0))::BIGINT AS n_edges
FROM piece p JOIN target t ON t.z = p.z AND t.x = p.x AND t.y = p.y AND t.geoid10 = p.geoid10
LEFT JOIN inner_border i ON i.z = p.z AND i.x = p.x AND i.y = p.y AND i.target = t.target
GROUP BY p.z, p.x, p.y, t.target HAVING bool_or(solid)"""


def _densest(source, feature_id, budget, rest=""):
    """The features with the widest gaps on the curve, of a table with tile and box."""
    wx, wy = _world("(minx + maxx) / 2", "(miny + maxy) / 2", "z")
    side = 1 << CURVE_BITS
    cell = f"least(greatest(floor((%s - %s) * {side}), 0), {side - 1})::BIGINT"
    key = " + ".join(f"(((cx >> {b}) & 1) << {2 * b}) + (((cy >> {b}) & 1) << {2 * b + 1})" for b in range(CURVE_BITS))
    return f"""
SELECT layer, z, x, y, {feature_id}, gap {rest} FROM (
  SELECT *, count(*) OVER (PARTITION BY layer, z, x, y) AS n, row_number() OVER (PARTITION BY layer, z, x, y
      ORDER BY gap DESC, reverse(lpad(bin(place), {2 * CURVE_BITS}, '0')), {feature_id}) AS choice
  FROM (SELECT *, coalesce(place - lag(place) OVER (PARTITION BY layer, z, x, y ORDER BY place, {feature_id}), {side * side}) AS gap
        FROM (SELECT *, {key} AS place
              FROM (SELECT *, {cell % (wx, "x")} AS cx, {cell % (wy, "y")} AS cy FROM ({source})))))
WHERE n <= {budget} OR choice <= {budget}"""


_GEOGRAPHY = """
SELECT 'state' AS level, substr(geoid10, 1, 2) AS feature_id, minx, miny, maxx, maxy FROM degree
UNION ALL SELECT 'county', substr(geoid10, 1, 5), minx, miny, maxx, maxy FROM degree
UNION ALL SELECT 'cd115', substr(geoid10, 1, 2) || substr(geoid10, 4, 2), minx, miny, maxx, maxy FROM degree"""
_BASE = f"""
SELECT t.level AS layer, t.z, t.x, t.y, t.feature_id, coalesce(o.minx, b.minx) AS minx, coalesce(o.miny, b.miny) AS miny,
  coalesce(o.maxx, b.maxx) AS maxx, coalesce(o.maxy, b.maxy) AS maxy
FROM (SELECT DISTINCT level, feature_id, z, x, y
      FROM ({_cover(_planned(f"({_GEOGRAPHY})", base_bands(BASE_ZOOMS)), "level, feature_id")})) t
JOIN (SELECT level, feature_id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
      FROM ({_GEOGRAPHY}) GROUP BY ALL) b USING (level, feature_id)
LEFT JOIN (VALUES {", ".join(f"('{layer}', '{geoid}', {', '.join(f'{v}::DOUBLE' for v in box)})" for layer, geoid, box in BBOX_OVERRIDES)})
  o(level, feature_id, minx, miny, maxx, maxy) USING (level, feature_id)"""
_MICRO = ", ".join(f"round({c} * 1000000)::BIGINT AS {c}" for c in ("minx", "miny", "maxx", "maxy"))


def _clipped_shapes():
    """Right triangles and L-shapes on tiles by closed forms, in the box of each tract.

    A triangle is u + v <= 1 with u from the left and v from the bottom, as shares of
    its sides; what it has of a rectangle follows from what it has of a corner.
    """
    x0, y1 = _world("minx", "miny", "z")
    x1, y0 = _world("maxx", "maxy", "z")
    xm, ym = _world("(minx + maxx) / 2", "(miny + maxy) / 2", "z")
    boxes = "(SELECT tract_id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM degree GROUP BY ALL)"
    m = f"{MARGIN}::DOUBLE"

    def corner(u, v):
        u, v = (f"least(greatest({c}, 0), 1)" for c in (u, v))
        return f"({u} * {v} - pow(greatest({u} + {v} - 1, 0), 2) / 2)"

    u0, u1, v0, v1 = "(x - x0) / w", "(x + 1 - x0) / w", "(y1 - y - 1) / h", "(y1 - y) / h"
    triangle = f"({corner(u1, v1)} - {corner(u0, v1)} - {corner(u1, v0)} + {corner(u0, v0)}) * w * h"

    def over(low, high, at):
        return f"greatest(least({at} + 1, {high}) - greatest({at}, {low}), 0)"

    el = f"{over('x0', 'x1', 'x')} * {over('ym', 'y1', 'y')} + {over('x0', 'xm', 'x')} * {over('y0', 'ym', 'y')}"
    q = lambda v, at: f"round(({v} - {at}) * 4096)::BIGINT"
    return f"""
, tile AS (
  SELECT tract_id, z, x, y, x0, x1, y0, y1, xm, ym, x1 - x0 AS w, y1 - y0 AS h,
    greatest(x - {m}, x0) AS gx0, least(x + 1 + {m}, x1) AS gx1, greatest(y - {m}, y0) AS gy0, least(y + 1 + {m}, y1) AS gy1
  FROM (SELECT *, {x0} AS x0, {x1} AS x1, {y0} AS y0, {y1} AS y1, {xm} AS xm, {ym} AS ym
        FROM ({_cover(_zoomed(6, 13, boxes), "tract_id, minx, miny, maxx, maxy")})))
SELECT 'triangle' AS shape, tract_id, z, x, y, round(area * 1000000)::BIGINT AS area_ppm, {q("gx0", "x")} AS qminx,
  {q("greatest(gy0, y1 - h * (1 - (gx0 - x0) / w))", "y")} AS qminy,
  {q("least(gx1, x0 + w * (1 - (y1 - gy1) / h))", "x")} AS qmaxx, {q("gy1", "y")} AS qmaxy
FROM (SELECT *, {triangle} AS area FROM tile) WHERE area > {LEAST_AREA}
UNION ALL
SELECT 'el', tract_id, z, x, y, round(area * 1000000)::BIGINT, {q("gx0", "x")},
  {q("CASE WHEN gx0 < xm THEN gy0 ELSE greatest(gy0, ym) END", "y")},
  {q("CASE WHEN gy1 > ym THEN gx1 ELSE least(gx1, xm) END", "x")}, {q("gy1", "y")}
FROM (SELECT *, {el} AS area FROM tile) WHERE area > {LEAST_AREA}"""
# budget and folding within a tile are those of the thinning query, for the thinned bands only
_SPEED = f"""
covered AS (SELECT 'speed' AS layer, * FROM ({_SPEED_COVER})),
ranked AS (
  SELECT *, least(greatest(floor(({_CX} - x) * 8), 0), 7)::INTEGER AS gx,
    least(greatest(floor(({_CY} - y) * 8), 0), 7)::INTEGER AS gy,
    run_cost <= {THIN_BUDGET} OR place = 1 AS keep
  FROM (SELECT *, (sum(cost) OVER ranks)::BIGINT AS run_cost, row_number() OVER ranks AS place
        FROM covered WHERE thin
        WINDOW ranks AS (PARTITION BY z, x, y ORDER BY size DESC, geoid10 ROWS UNBOUNDED PRECEDING))),
{_FOLDING.strip()},
placed AS (
  SELECT level, z, x, y, geoid10, minx, miny, maxx, maxy, coalesce, drop_attr,
    coalesce(folded_n, 0) AS folded_n, coalesce(folded_size, 0) AS folded_size,
    coalesce(folded_cost, 0) AS folded_cost
  FROM ranked LEFT JOIN folded USING (layer, z, x, y, geoid10) WHERE keep
  UNION ALL
  SELECT level, z, x, y, geoid10, minx, miny, maxx, maxy, coalesce, drop_attr, 0, 0, 0
  FROM covered WHERE NOT thin),
value AS (
  SELECT 'county' AS kind, county_id AS geoid10, tier, %(doubles)s FROM wcounty
  UNION ALL SELECT 'tract', tract_id, tier, %(doubles)s FROM wtract
  UNION ALL SELECT 'block', geoid10, tier, %(pivot)s FROM counts GROUP BY geoid10, tier),
shown AS (
  SELECT t.tier AS layer, p.*, v.* EXCLUDE (kind, geoid10, tier)
  FROM placed p CROSS JOIN tier t LEFT JOIN value v ON v.tier = t.tier AND v.geoid10 = p.geoid10
    AND v.kind = CASE p.level WHEN 'county' THEN 'county' WHEN 'tract' THEN 'tract'
      WHEN 'smalltract' THEN 'tract' ELSE 'block' END)"""
_SPEED_LAYERS = """
SELECT layer, z, x, y, level, min(geoid10) AS ord, NULL::VARCHAR AS feature_id, %(names)s,
  min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy,
  count(*) AS n_features, sum(folded_n)::BIGINT AS folded_n, sum(folded_size)::BIGINT AS folded_size,
  sum(folded_cost)::BIGINT AS folded_cost
FROM shown WHERE coalesce GROUP BY layer, z, x, y, level, %(names)s
UNION ALL
SELECT layer, z, x, y, level, geoid10, CASE WHEN drop_attr IS NULL THEN geoid10 END, %(names)s,
  minx, miny, maxx, maxy, 1, folded_n, folded_size, folded_cost
FROM shown WHERE NOT coalesce"""


def oracles() -> dict[str, str]:
    w, f = _with, "filing"
    o = {}
    o["scan_filings"] = w(f) + "SELECT * FROM filing"
    # a blank field of a CSV file is a missing value
    o["scan_blocks"] = (
        w("block") + "SELECT * REPLACE (nullif(cplace_id, '') AS cplace_id) FROM block"
    )
    o["scan_numprov_dir"] = (
        w("counts", "block")
        + "SELECT geoid10, tier, h2only_undev, "
        + ", ".join(f'max(n) FILTER (k = {k}) AS "{n}"' for k, n in combos())
        + " FROM counts LEFT JOIN block USING (geoid10) GROUP BY geoid10, tier, h2only_undev"
    )
    o["scan_large_blocks"] = w("large") + "SELECT * FROM large"
    o["scan_geojson"] = (
        w("box") + "SELECT geoid10, aland10, minx, miny, maxx, maxy FROM box"
    )
    o["export_geojson"] = w("cell") + "SELECT geoid10, 1::DOUBLE AS area FROM cell"
    o["export_csv_roundtrip"] = _PROVIDER_TABLE
    o["provider_table"] = _PROVIDER_TABLE
    o["export_area_csv"] = f"SELECT * EXCLUDE (tier) FROM ({_AREA_TABLE})"
    o["export_numprov_null"] = (
        w("flagged")
        + "SELECT lpad(geoid10, 15, '0') AS geoid10, nullif(h2only_undev, 0)::TINYINT AS h2only_undev, "
        + ", ".join(f'nullif("{n}", 0)::INTEGER AS "{n}_{TIER.name}"' for n in combo_layout())
        + " FROM flagged"
    )

    o["consumer_filings"] = w("cf") + "SELECT * FROM cf"
    o["filings_with_pop"] = (
        w("cf", "block")
        + "SELECT cf.*, pop FROM cf LEFT JOIN block ON block_code = geoid10"
    )
    o["filings_block_outer"] = (
        w("cf", "block")
        + "SELECT coalesce(block_code, geoid10) AS block_code, coalesce(hoconum, 0) AS hoconum, "
        "coalesce(tech_code, 0) AS tech_code, coalesce(max_ad_down, 0) AS max_ad_down, "
        "coalesce(max_ad_up, 0) AS max_ad_up FROM cf FULL JOIN block ON block_code = geoid10"
    )
    o["tech_class_filter"] = (
        w("cf") + f"SELECT * FROM cf WHERE tech_code IN ({_numbers(TECH_CLASSES['c'])})"
    )
    o["tech_class_bits"] = (
        w(f, "tech")
        + "SELECT tech_code, class AS tech_class, coalesce(bit, 0) AS bit, "
        "lpad(bin(coalesce(bit, 0)), 6, '0') AS bits, count(*) AS n "
        "FROM filing LEFT JOIN tech ON tech_code = code GROUP BY ALL"
    )
    o["max_speed_block_provider_tech"] = w("d1") + "SELECT * FROM d1"
    o["max_speed_block_provider"] = w("known") + _ALL
    o["max_speed_block_provider_class"] = (
        w("known", "tech")
        + "SELECT block_code, hoconum, class AS tech_class, max(max_ad_down) AS max_down, "
        "max(max_ad_up) AS max_up FROM known JOIN tech ON tech_code = code GROUP BY ALL"
    )
    part = "PARTITION BY block_code, hoconum, tech_code"
    known = "hoconum IS NOT NULL AND tech_code IS NOT NULL"
    o["max_speed_window"] = (
        w("cf")
        + f"SELECT cf.*, CASE WHEN {known} THEN max(max_ad_down) OVER ({part}) END AS max_down, "
        f"CASE WHEN {known} THEN max(max_ad_up) OVER ({part}) END AS max_up FROM cf"
    )

    o["provider_pop_by_tech"] = w("block", "d1") + _provider_grain(
        "SELECT * FROM d1", "hoconum, tech_code"
    )
    o["provider_pop_all"] = w("block", "cf") + _provider_grain(_ALL_BLOCKS, "hoconum")
    o["provider_pop_by_class"] = w("block", "known") + _provider_grain(_CLASSES, "hoconum, tech")

    o["tier_qualified"] = (
        w("d0")
        + f"SELECT * FROM d0 WHERE max_down >= {TIER.down} AND max_up >= {TIER.up} "
        f"AND tech_code IN ({_numbers(TECH_CLASSES['c'])})"
    )
    o["numprov_25_3_acfosw"] = (
        w("d0", "spine")
        + f"""SELECT geoid10, count(DISTINCT hoconum) AS nprovs FROM spine LEFT JOIN (
          SELECT * FROM d0 WHERE max_down >= {TIER.down} AND max_up >= {TIER.up}
          AND tech_code IN ({_numbers(c for v in TECH_CLASSES.values() for c in v)})) q
        ON block_code = geoid10 GROUP BY geoid10"""
    )
    o["block_numprov_wide"] = w("wide") + "SELECT * FROM wide"
    o["block_numprov_long"] = (
        w("counts") + "SELECT geoid10, tier, combo, n AS nprovs FROM counts"
    )
    o["numprov_with_flag"] = w("flagged") + "SELECT * FROM flagged"
    names = [n for _, n in combos()]
    q = lambda n: f'"{n}"'
    o["numprov_capped"] = (
        w("wide")
        + "SELECT geoid10, "
        + ", ".join(f"least({q(n)}, 3) AS {q(n)}" for n in names)
        + " FROM wide"
    )
    o["numprov_int8"] = (
        w("wide")
        + "SELECT geoid10, "
        + ", ".join(f"{q(n)}::INTEGER AS {q(n)}" for n in names)
        + " FROM wide"
    )
    o["numprov_export_layout"] = (
        w("flagged")
        + "SELECT lpad(geoid10, 15, '0') AS geoid10, h2only_undev, "
        + ", ".join(f'{q(n)} AS "{n}_{TIER.name}"' for n in combo_layout())
        + " FROM flagged"
    )
    o["numprov_sorted"] = w("wide") + "SELECT * FROM wide ORDER BY geoid10"
    o["blank_zeros"] = (
        w("flagged")
        + "SELECT geoid10, "
        + ", ".join(f"nullif({q(n)}, 0) AS {q(n)}" for n in ["h2only_undev", *names])
        + " FROM flagged"
    )
    o["fill_zero"] = (
        w("flagged")
        + "SELECT geoid10, coalesce(h2only_undev, 0)::TINYINT AS h2only_undev, "
        + "flagged.* EXCLUDE (geoid10, h2only_undev) FROM flagged"
    )

    o["area_pop_by_nprov"] = w("block", "counts") + _COUNTY_NPROV
    o["area_pivot"] = (
        w("block", "counts")
        + "SELECT id, urban_rural, tribal_non, "
        + ", ".join(
            f"coalesce(sum(pop) FILTER (nprovs = {i}), 0)::BIGINT AS {n}"
            for i, n in enumerate(("has_0", "has_1", "has_2", "has_3plus"))
        )
        + f" FROM ({_COUNTY_NPROV}) GROUP BY ALL"
    )
    o["area_table"] = _AREA_TABLE
    o["area_table_sorted"] = (
        _AREA_TABLE.replace("SELECT type, id, combo", "SELECT * EXCLUDE (tier_no) FROM (SELECT type, id, combo")
        .replace("tribal_non, coalesce", "tribal_non, tier_no, coalesce", 1)
        + ") ORDER BY type, id, tech, tier_no, urban_rural, tribal_non"
    )

    for name, length in (("tract", 11), ("county", 5)):
        o[f"{name}_pop"] = (
            w("block")
            + f"SELECT substr(geoid10, 1, {length}) AS {name}_id, sum(pop)::BIGINT AS pop "
            "FROM block GROUP BY ALL"
        )
        o[f"{name}_numprov"] = w(f"w{name}") + f"SELECT * FROM w{name}"
    o["block_with_tract_pop"] = (
        w("block")
        + "SELECT geoid10, pop, substr(geoid10, 1, 11) AS tract_id, "
        "(sum(pop) OVER (PARTITION BY substr(geoid10, 1, 11)))::BIGINT AS tract_pop FROM block"
    )

    o["h2only_undev"] = (
        w("cust")
        + "SELECT geoid10 AS block_fips, CASE WHEN aland10 = 0 THEN 1 "
        "WHEN hu = 0 AND pop = 0 THEN 2 ELSE 0 END AS h2only_undev FROM cust"
    )
    o["land_blocks"] = w("cust") + "SELECT geoid10, aland10 FROM cust WHERE aland10 > 0"
    o["island_tracts"] = (
        w("cell")
        + "SELECT DISTINCT tract_id FROM cell WHERE aland10 > 0 "
        f"AND substr(tract_id, 1, 2) IN ({_strings(ISLANDS)})"
    )
    o["fips_parts"] = (
        w("block")
        + "SELECT geoid10, substr(geoid10, 1, 2) AS state, substr(geoid10, 1, 5) AS county, "
        "substr(geoid10, 1, 11) AS tract, right('1400000US' || substr(geoid10, 1, 11), 11) "
        "AS tract_tail, geoid10::BIGINT::VARCHAR AS unpadded, "
        "lpad(geoid10::BIGINT::VARCHAR, 15, '0') AS padded FROM block"
    )
    o["tier_speeds"] = (
        w("block", "tier")
        + "SELECT 'csv/block_numprov_' || tier || '.csv' AS file, down AS speed, "
        "count(*) AS n_blocks FROM block CROSS JOIN tier GROUP BY ALL"
    )

    o["feature_bounds"] = w("box") + "SELECT geoid10, minx, miny, maxx, maxy FROM box"
    o["bbox_text"] = (
        w("cell")
        + "SELECT geoid10, '[' || cx || '.0, ' || cy || '.0, ' || (cx + 1) || '.0, ' "
        "|| (cy + 1) || '.0]' AS bbox_arr FROM cell"
    )
    o["bbox_decimal"] = (
        w("cell")
        + "SELECT geoid10, concat_ws(',', "
        + ", ".join(
            f"(({base} + {sign}{d} * 0.01::DECIMAL(10,7))::DECIMAL(10,7))::VARCHAR"
            for base, sign, d in (
                (-120, "", "cx"), (30, "", "cy"), (-120, "", "(cx + 1)"), (30, "", "(cy + 1)")
            )
        )
        + ") AS bbox_arr FROM cell"
    )
    box_rows = ", ".join(
        f"('{layer}', '{g}', {', '.join(f'{v}::DOUBLE' for v in b)})" for layer, g, b in BBOX_OVERRIDES
    )
    overridden = f"""SELECT layer, geoid, coalesce(a, minx) AS minx, coalesce(b, miny) AS miny,
      coalesce(c, maxx) AS maxx, coalesce(d, maxy) AS maxy
    FROM layerbox LEFT JOIN (VALUES {box_rows}) v(layer, geoid, a, b, c, d) USING (layer, geoid)"""
    o["bbox_override"] = w("layerbox") + overridden
    o["mercator_coords"] = (
        w("metre")
        + "SELECT geoid10, seq::INTEGER AS seq, round(mx * 1000)::BIGINT AS x_mm, "
        "round(my * 1000)::BIGINT AS y_mm FROM metre"
    )
    o["tract_area"] = w("tractm2") + "SELECT tract_id, area_m2 FROM tractm2"
    o["big_tracts"] = (
        w("typical", "tractm2")
        + "SELECT tract_id, area_m2 FROM tractm2 WHERE area > (SELECT m2 FROM typical)"
    )
    o["notbig_tracts"] = (
        w("typical", "tractm2")
        + "SELECT tract_id, area_m2 FROM tractm2 WHERE area <= (SELECT m2 FROM typical)"
    )
    big = "tract_id IN (SELECT tract_id FROM tractm2 WHERE area > (SELECT m2 FROM typical))"
    o["blocks_in_big_tracts"] = (
        w("typical", "tractm2", "cell") + f"SELECT geoid10, tract_id FROM cell WHERE {big}"
    )
    o["large_blocks_zoom"] = (
        w("large", "cust")
        + "SELECT geoid10, aland10, least(x_zoom, y_zoom) AS min_zoom "
        "FROM cust JOIN large ON block_fips = geoid10"
    )
    o["dissolve_tract_edges"] = w("side") + _outline(_LAND_SIDES, "tract_id")
    o["dissolve_tract"] = (
        w("box")
        + "SELECT tract_id, count(*)::DOUBLE AS area, min(minx) AS minx, "
        "min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy "
        "FROM box WHERE aland10 > 0 GROUP BY ALL"
    )
    o["export_features_geojson"] = o["dissolve_tract"]
    o["dissolve_ring_points"] = (
        w("side", recursive=_RINGS.strip())
        + """, whole AS (
          -- a walk is a ring if its last edge leads back to its first
          SELECT w.tract_id, sx1, sy1, sx2, sy2 FROM walk w JOIN step s
          ON s.tract_id = w.tract_id AND s.x1 = w.x1 AND s.y1 = w.y1 AND s.x2 = w.x2
            AND s.y2 = w.y2
          WHERE (s.x2, s.y2, s.nx, s.ny) = (sx1, sy1, sx2, sy2))
        SELECT tract_id, concat_ws(':', sx1, sy1, sx2, sy2) AS ring, seq, x1 AS x, y1 AS y
        FROM walk JOIN whole USING (tract_id, sx1, sy1, sx2, sy2)"""
    )
    o["dissolve_county_edges"] = w("side") + _outline(
        "SELECT substr(tract_id, 1, 5) AS county_id, x1, y1, x2, y2 FROM side "
        f"WHERE aland10 > 0 AND substr(tract_id, 1, 2) IN ({_strings(ISLANDS)})",
        "county_id",
    )
    o["provider_blocks"] = w("provblock") + "SELECT * FROM provblock"
    o["provider_footprint_edges"] = w("provblock", "side") + _outline(
        "SELECT hoconum, county_fips, x1, y1, x2, y2 FROM provblock JOIN side USING (geoid10)",
        "hoconum, county_fips",
    )
    large = f"hoconum IN ({_numbers(LARGE_PROVIDERS)})"
    o["provider_split_large"] = w("footprint") + f"SELECT * FROM footprint WHERE {large}"
    o["provider_split_other"] = w("footprint") + f"SELECT * FROM footprint WHERE NOT {large}"
    o["carto_tracts"] = w("cartotract") + "SELECT * FROM cartotract"
    o["carto_counties"] = w("cartocounty") + "SELECT * FROM cartocounty"

    at_tier = f"WHERE tier = '{TIER.name}'"
    o["county_features"] = (
        w("wcounty", "cartocounty")
        + "SELECT c.*, s.* EXCLUDE (county_id, tier) FROM cartocounty c LEFT JOIN "
        f"(SELECT * FROM wcounty {at_tier}) s ON geoid10 = county_id"
    )
    o["tract_features"] = (
        w("wtract", "cartotract")
        + "SELECT c.*, s.* EXCLUDE (tract_id, tier) FROM cartotract c LEFT JOIN "
        f"(SELECT * FROM wtract {at_tier}) s USING (tract_id)"
    )
    o["smalltract_features"] = (
        w("wtract", "tractm2", "typical")
        + "SELECT t.tract_id, area_m2, s.* EXCLUDE (tract_id, tier) FROM tractm2 t LEFT JOIN "
        f"(SELECT * FROM wtract {at_tier}) s USING (tract_id) "
        "WHERE area <= (SELECT m2 FROM typical)"
    )
    o["bigtract_block_features"] = (
        w("wide", "degree", "tractm2", "typical")
        + "SELECT d.geoid10, minx, miny, maxx, maxy, wide.* EXCLUDE (geoid10) FROM degree d "
        f"LEFT JOIN wide USING (geoid10) WHERE {big}"
    )
    o["block_features"] = (
        w("wide", "box")
        + "SELECT b.geoid10, minx, miny, maxx, maxy, wide.* EXCLUDE (geoid10) FROM box b "
        "LEFT JOIN wide USING (geoid10)"
    )

    base = f"(SELECT layer AS level, geoid AS feature_id FROM layerbox WHERE layer IN ({_strings(BASE_ZOOMS)}))"
    o["zoom_plan_features"] = (
        w("level", "layerbox")
        + f"SELECT 'speed' AS layer, {_PLAN_COLUMNS} FROM ({_planned('level', SPEED_BANDS)}) "
        f"UNION ALL SELECT 'base', {_PLAN_COLUMNS} FROM ({_planned(base, base_bands(BASE_ZOOMS))})"
    )
    o["tile_cover"] = w("degree") + _cover(_zoomed(11, 14), "geoid10")
    tx0, ty1 = _world("minx", "miny", "z")
    tx1, ty0 = _world("maxx", "maxy", "z")
    # a tile meets the triangle if its corner nearest to the right angle does
    o["tile_cover_shapes"] = (
        w("degree")
        + f"""SELECT tract_id, z, x, y FROM (
          SELECT *, {tx0} AS x0, {tx1} AS x1, {ty0} AS y0, {ty1} AS y1
          FROM ({_cover(_zoomed(6, 13, "(SELECT tract_id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM degree GROUP BY ALL)"), "tract_id, minx, miny, maxx, maxy")}))
        WHERE (greatest(x, x0) - x0) / (x1 - x0) + (y1 - least(y + 1, y1)) / (y1 - y0) <= 1"""
    )
    qx, qy = _world("lon", "lat", "z")
    o["tile_quantise"] = (
        w("degree", "corner")
        + f"""SELECT c.geoid10, z, x, y, 0 AS poly, 0 AS ring, seq::INTEGER AS seq,
          floor(({qx} - x) * pow(2, 14))::BIGINT AS qx,
          floor(({qy} - y) * pow(2, 14))::BIGINT AS qy
        FROM ({_cover(_zoomed(14, 14), "geoid10")}) c JOIN corner USING (geoid10)"""
    )
    sx, sy = _world("lon", "lat", "10")
    cells = "pow(2, 12) / 8"
    o["simplify_features"] = (
        w("corner")
        + f"""SELECT geoid10, 10 AS z, 0 AS poly, 0 AS ring, 5 AS n_points,
          (2 * (max(gx) - min(gx)) * (max(gy) - min(gy)))::BIGINT AS area2
        FROM (SELECT geoid10, round({sx} * {cells}) AS gx, round({sy} * {cells}) AS gy FROM corner)
        GROUP BY geoid10 HAVING max(gx) > min(gx) AND max(gy) > min(gy)"""
    )
    o["tile_coalesce"] = (
        w("degree", "counts")
        + f"""SELECT '{TIER.name}' AS layer, z, x, y, least(n, 3) AS nprovs,
          count(*) AS n_features, min(geoid10) AS ord, min(minx) AS minx, min(miny) AS miny,
          max(maxx) AS maxx, max(maxy) AS maxy
        FROM ({_cover(_zoomed(10, 10), "geoid10, minx, miny, maxx, maxy")})
        LEFT JOIN (SELECT * FROM counts {at_tier} AND combo = '{ALL_TECH}') USING (geoid10)
        GROUP BY ALL"""
    )
    every = {
        "names": ", ".join(q(n) for n in names),
        "doubles": ", ".join(f"{q(n)}::DOUBLE AS {q(n)}" for n in names),
        "pivot": ", ".join(f"(max(n) FILTER (k = {k}))::DOUBLE AS {q(n)}" for k, n in combos()),
    }
    value_rows = " UNION ALL ".join(
        f"SELECT '{kind}:' || {k} AS feature, tier, {every_number} FROM {source}"
        for kind, k, source, every_number in (
            ("county", "county_id", "wcounty", every["doubles"]),
            ("tract", "tract_id", "wtract", every["doubles"]),
            ("block", "geoid10", "counts GROUP BY geoid10, tier", every["pivot"]),
        )
    )
    o["features_all_tiers"] = (
        w("cartocounty", "cartotract", "box", "wcounty", "wtract", "counts", "tier")
        + f"""SELECT feature, tier, minx, miny, maxx, maxy, v.* EXCLUDE (feature, tier) FROM (
          SELECT 'county:' || geoid10 AS feature, minx, miny, maxx, maxy FROM cartocounty
          UNION ALL SELECT 'tract:' || tract_id, minx, miny, maxx, maxy FROM cartotract
          UNION ALL SELECT 'block:' || geoid10, minx, miny, maxx, maxy FROM box) f
        CROSS JOIN (SELECT tier FROM tier) LEFT JOIN ({value_rows}) v USING (feature, tier)"""
    )
    # unit sides of the lattice; runs of one direction, border and line end at junctions and where they break
    o["simplify_arcs"] = (
        w("side")
        + """, unit AS (
          SELECT least(a.t, b.t) AS one, CASE WHEN a.t IS NULL OR b.t IS NULL THEN NULL ELSE greatest(a.t, b.t) END AS other,
            CASE WHEN b.t IS NULL OR a.t < b.t THEN a.x1 ELSE a.x2 END AS x1, CASE WHEN b.t IS NULL OR a.t < b.t THEN a.y1 ELSE a.y2 END AS y1,
            CASE WHEN b.t IS NULL OR a.t < b.t THEN a.x2 ELSE a.x1 END AS x2, CASE WHEN b.t IS NULL OR a.t < b.t THEN a.y2 ELSE a.y1 END AS y2
          FROM (SELECT tract_id AS t, x1, y1, x2, y2 FROM side WHERE aland10 > 0) a
          LEFT JOIN (SELECT tract_id AS t, x1, y1, x2, y2 FROM side WHERE aland10 > 0) b
            ON a.x1 = b.x2 AND a.y1 = b.y2 AND a.x2 = b.x1 AND a.y2 = b.y1
          WHERE b.t IS NULL OR a.t < b.t),
        junction AS (
          SELECT x, y FROM (SELECT x1 AS x, y1 AS y FROM unit UNION ALL SELECT x2, y2 FROM unit) GROUP BY ALL HAVING count(*) <> 2),
        run AS (
          SELECT u.*, x2 - x1 AS dx, y2 - y1 AS dy, sum(CASE WHEN j.x IS NOT NULL OR p.one IS NULL THEN 1 ELSE 0 END) OVER (
              PARTITION BY u.one, u.other, u.x2 - u.x1, u.y2 - u.y1, CASE WHEN u.x1 = u.x2 THEN u.x1 ELSE u.y1 END
              ORDER BY (u.x1 + u.y1) * (u.x2 - u.x1 + u.y2 - u.y1)) AS nr,
            CASE WHEN u.x1 = u.x2 THEN u.x1 ELSE u.y1 END AS line
          FROM unit u LEFT JOIN junction j ON j.x = u.x1 AND j.y = u.y1
          LEFT JOIN (SELECT one, other, x1 + 2 * (x2 - x1) AS ex2, y1 + 2 * (y2 - y1) AS ey2, x2 AS ex1, y2 AS ey1 FROM unit) p
            ON p.one = u.one AND p.other IS NOT DISTINCT FROM u.other AND p.ex1 = u.x1 AND p.ey1 = u.y1 AND p.ex2 = u.x2 AND p.ey2 = u.y2)
        SELECT one, other, arg_min(x1, pos) AS x1, arg_min(y1, pos) AS y1, arg_max(x2, pos) AS x2, arg_max(y2, pos) AS y2
        FROM (SELECT *, (x1 + y1) * (dx + dy) AS pos FROM run) GROUP BY one, other, dx, dy, line, nr"""
    )
    o["tile_quantise_clipped"] = w("degree") + _clipped_shapes()
    rect = (
        f"SELECT '{TIER.name}' AS layer, z, x, y, coalesce(least(n, 3), -1) AS nprovs, geoid10, qx0, qx1, qy0, qy1 "
        f"FROM ({_pieces(9, 10)}) LEFT JOIN (SELECT * FROM counts {at_tier} AND combo = '{ALL_TECH}') USING (geoid10) WHERE solid"
    )
    o["tile_coalesce_edges"] = (
        w("degree", "counts")
        + _outline(f"SELECT layer, z, x, y, nprovs, {_SIDES} FROM ({rect})", "layer, z, x, y, nprovs")
    )
    o["tile_coalesce_smallest"] = w("degree", recursive=_MERGE.strip()) + _MERGED
    o["tile_drop_densest"] = w("degree") + _densest(_SIZED, "geoid10", DENSE_BUDGET)
    o["base_map_tiles"] = (
        w("degree") + f"SELECT layer, z, x, y, feature_id, gap, {_MICRO} FROM ("
        + _densest(_BASE, "feature_id", BASE_BUDGET, ", minx, miny, maxx, maxy") + ")"
    )
    lattice = "SELECT '{0}' AS layer, {1} AS geoid, cx, cy FROM cell"
    every_layer = " UNION ALL ".join(
        lattice.format(n, k)
        for n, k in (("state", "substr(geoid10, 1, 2)"), ("county", "substr(geoid10, 1, 5)"), ("tract", "tract_id"))
    )
    o["bbox_on_circle"] = (
        w("cell")
        + f"""SELECT layer, geoid, low - turn AS minx, 30000000 + 10000 * y0 AS miny, high - turn AS maxx,
          30000000 + 10000 * (y1 + 1) AS maxy
        FROM (SELECT *, CASE WHEN high > 180000000 THEN 360000000 ELSE 0 END AS turn FROM (
          SELECT layer, geoid, 179800000 + 10000 * min(cx) AS low, 179800000 + 10000 * (max(cx) + 1) AS high,
            min(cy) AS y0, max(cy) AS y1 FROM ({every_layer}) GROUP BY ALL))"""
    )
    o["tile_thin"] = (
        w("degree")
        + f"SELECT * EXCLUDE (minx, miny, maxx, maxy, keep, place) FROM ({_RANKED}) WHERE keep"
    )
    o["tile_fold_smallest"] = (
        w("degree", recursive=_FOLD.strip())
        + f"""SELECT layer, z, x, y, geoid10, size, cost, coalesce(folded_n, 0) AS folded_n,
          coalesce(folded_size, 0) AS folded_size, coalesce(folded_cost, 0) AS folded_cost
        FROM ranked LEFT JOIN folded USING (layer, z, x, y, geoid10) WHERE keep"""
    )
    o["speed_layer_tiles"] = (
        w("degree", "tractm2", "typical", "wcounty", "wtract", "counts", "tier", recursive=(_SPEED % every).strip())
        + _SPEED_LAYERS % every
    )
    o["tile_union"] = (
        w("level")
        + f"SELECT '{TIER.name}' AS layer, * FROM ("
        + _cover(_planned("level", SPEED_BANDS), "level, feature_id")
        + ")"
    )
    xl = _planned(
        "(SELECT 'xl_block' AS level, degree.*, least(x_zoom, y_zoom) AS min_zoom "
        "FROM degree JOIN large ON block_fips = geoid10)",
        XL_BLOCK_BANDS,
    )
    o["xl_block_tiles"] = w("degree", "large") + _cover(
        xl, "geoid10"
    )
    prov = _planned(
        f"(SELECT *, CASE WHEN {large} THEN 'prov_lg' ELSE 'prov_other' END AS level "
        "FROM footprint)",
        PROVIDER_BANDS,
    )
    o["provider_tiles"] = (
        w("footprint")
        + "SELECT level AS layer, z, x, y, hoconum, count(*) AS n_features, min(hoconum) AS ord, "
        "min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM ("
        + _cover(prov, "level, hoconum, minx, miny, maxx, maxy")
        + ") GROUP BY ALL"
    )
    return o
