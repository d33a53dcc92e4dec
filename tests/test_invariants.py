"""Properties which hold for any filings, on random ones."""

import random

import pytest

from reachmap.constants import GEOGRAPHIES, TECH_CLASSES, TIERS, combos
from reachmap.operators import area, numprov, providers
from reachmap.sources import fixtures as fx

from .helpers import blocks, filings

CODES = [c for codes in TECH_CLASSES.values() for c in codes] + [99]
SPEEDS = [None, 0.1, 0.2, 1.0, 3.0, 4.0, 10.0, 25.0, 100.0, 250.0, 1000.0]


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    r = random.Random(request.param)
    ids = [f"{s:02d}00{c}00000{t}{b:04d}" for s in (1, 2) for c in (1, 2) for t in (1, 2) for b in range(3)]
    known = ids[:-2]
    rows = [
        (r.choice(ids), r.choice([None, 1, 2, 3, 4, 5]), r.choice([None, *CODES]), r.choice(SPEEDS), r.choice(SPEEDS))
        for _ in range(400)
    ]
    b = blocks(
        spark,
        *[(i, r.choice([0, 1, 7, 100]), r.choice(["M1", "M2", None, ""]), r.choice("UR"), r.choice("TN")) for i in known],
    )
    return rows, filings(spark, *rows), b.cache(), known


def test_counts_equal_a_direct_count(case):
    rows, f, b, known = case
    best = {}
    for block, prov, tech, down, up in rows:
        key = (block, prov or 0, tech or 0)
        d, u = best.get(key, (0, 0))
        best[key] = (max(d, down or 0), max(u, up or 0))
    spine = set(known) | {r[0] for r in rows}
    want = {}
    for t in TIERS:
        for _, name in combos():
            codes = {c for letter in name for c in TECH_CLASSES[letter]}
            seen = {}
            for (block, prov, tech), (d, u) in best.items():
                if d >= t.down and u >= t.up and tech in codes:
                    seen.setdefault(block, set()).add(prov)
            for block in spine:
                want[block, t.name, name] = len(seen.get(block, ()))
    got = {
        (r.geoid10, r.tier, r.combo): r.nprovs for r in numprov.block_numprov_long(f, b).collect()
    }
    assert got == want


def test_counts_are_monotone(case):
    _, f, b, _ = case
    names = dict(combos())
    by_tier = {
        (r.geoid10, r.tier): r.asDict() for r in numprov.tier_counts(f, b).collect()
    }
    for (block, tier), row in by_tier.items():
        for k, name in names.items():
            for bit in (1, 2, 4, 8, 16, 32):
                if k & bit and k != bit:
                    less = row[names[k ^ bit]]
                    assert less <= row[name] <= less + row[names[bit]]
    for lower, higher in zip(TIERS, TIERS[1:]):
        for (block, tier), row in by_tier.items():
            if tier == lower.name:
                above = by_tier[block, higher.name]
                assert all(above[n] <= row[n] for n in names.values())


def test_areas_conserve_population(case):
    _, f, b, _ = case
    rows = area.area_table(f, b).collect()
    cells = {}
    for r in rows:
        cells.setdefault((r.type, r.id, r.urban_rural, r.tribal_non), set()).add(
            r.has_0 + r.has_1 + r.has_2 + r.has_3plus
        )
    assert all(len(v) == 1 for v in cells.values())
    nation = sum(next(iter(v)) for k, v in cells.items() if k[0] == "nation")
    states = sum(next(iter(v)) for k, v in cells.items() if k[0] == "state")
    assert nation == states == b.groupBy().sum("pop").first()[0]
    assert {r.type for r in rows} <= set(GEOGRAPHIES)


def test_provider_thresholds_fall(case):
    _, f, b, _ = case
    table = providers.provider_table(f, b, unmatched="ignore")
    rows = {(r.hoconum, r.tech): r.asDict() for r in table.collect()}
    for (prov, tech), r in rows.items():
        d, u = [r[f"d_{i}"] for i in range(1, 9)], [r[f"u_{i}"] for i in range(1, 10)]
        assert d == sorted(d, reverse=True) and u == sorted(u, reverse=True)
        assert all(rows[prov, "all"][c] >= r[c] for c in r if c[0] in "du" and c[1] == "_")


@pytest.mark.parametrize("unmatched", ["poison", "ignore"])
def test_provider_table_two_ways(case, unmatched):
    _, f, b, _ = case
    one = providers.provider_table(f, b, unmatched=unmatched)
    # a filing without a technology is only in the one-pass table's 'all' speeds as missing
    coded = f.filter("tech_code is not null")
    two = providers.provider_table_by_grain(coded, b, unmatched=unmatched).select(one.columns)
    one = providers.provider_table(coded, b, unmatched=unmatched)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_geoids_stay_unique_at_scale(spark, tmp_path):
    """Customer keys far beyond the test data still give unique 15 digit blocks."""
    keys = spark.range(0, 2_000_000, 37).selectExpr(
        "id * 4001 as c_custkey", "cast(id % 25 as int) as c_nationkey", "1D as c_acctbal",
        "'BUILDING' as c_mktsegment",
    )
    keys.write.parquet(f"{tmp_path}/customer.parquet")
    b = fx.block_hu_pop(spark, str(tmp_path))
    row = b.selectExpr(
        "count(*) n", "count(distinct block_fips) d", "max(length(block_fips)) a", "min(length(block_fips)) b"
    ).first()
    assert row.n == row.d and (row.a, row.b) == (15, 15)
