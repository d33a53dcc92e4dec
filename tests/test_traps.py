"""One hand-made table per result that is easy to get wrong."""

import pytest

from reachmap.constants import TIERS, combo_layout, combo_names, combos
from reachmap.functions.speeds import tier_speed_of_file
from reachmap.operators import area, filings as fl, flags, geometry, numprov, providers, rollup

from .helpers import B1, B2, B3, FILING, LOST, blocks, filings

TIER = {t.name: t for t in TIERS}


def by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def counts(spark, f, b, tier="25_3"):
    return by(numprov.block_numprov_wide(f, b, TIER[tier]), "geoid10")


def test_combination_names():
    names = dict(combos())
    assert len(names) == 63
    assert [names[k] for k in (1, 2, 4, 8, 16, 32, 48, 63)] == [
        "w", "s", "o", "f", "c", "a", "ac", "acfosw",
    ]
    layout = combo_layout()
    assert layout[:3] == ["acfosw", "acfos", "acfow"] and layout[-6:] == list("acfosw")


def test_one_unknown_block_makes_the_group_null(spark):
    f = filings(spark, (B1, 1, 50, 30.0, 5.0), (LOST, 1, 50, 0.1, 0.1), (B1, 2, 50, 30.0, 5.0))
    b = blocks(spark, (B1, 5))
    for table in (providers.provider_table, providers.provider_table_by_grain):
        t = by(table(f, b), "hoconum", "tech")
        assert all(t[1, tech][c] is None for tech in ("all", "50") for c in ("d_1", "d_8", "u_9"))
        assert (t[2, "all"]["d_4"], t[2, "all"]["d_5"], t[2, "50"]["u_3"]) == (5, 0, 5)
    t = by(providers.provider_table(f, b, unmatched="ignore"), "hoconum", "tech")
    assert (t[1, "all"]["d_1"], t[1, "all"]["d_8"]) == (5, 0)
    with pytest.raises(ValueError):
        providers.threshold_sums("drop")


def test_filing_without_provider_is_not_in_the_provider_table(spark):
    f = filings(spark, (B1, None, 50, 30.0, 5.0), (B1, 7, 50, 30.0, 5.0))
    t = providers.provider_table(f, blocks(spark, (B1, 5)))
    assert {r.hoconum for r in t.collect()} == {7}


def test_filing_without_technology_only_gives_an_all_row(spark):
    f = filings(spark, (B1, 7, None, 30.0, 5.0))
    t = providers.provider_table(f, blocks(spark, (B1, 5))).collect()
    assert [(r.tech, r.d_1) for r in t] == [("all", 0)]


def test_missing_and_blank_areas(spark):
    f = filings(spark, (B1, 1, 50, 30.0, 5.0))
    b = blocks(spark, (B1, 1, None), (B2, 2, ""), (B3, 4, "M1"))
    t = area.area_table(f, b).filter("tech = 'f' and tier = '25_3'")
    got = by(t, "type", "id")
    assert [k for k in got if k[0] == "cbsa"] == [("cbsa", "M1")]
    nation = got["nation", "0"]
    assert (nation["has_0"], nation["has_1"], nation["has_2"], nation["has_3plus"]) == (6, 1, 0, 0)
    assert not any(k[0] in ("tribal", "place") for k in got)


def test_empty_block_without_water_row_is_undeveloped(spark):
    pop = spark.createDataFrame(
        [(B1, 0, 0), (B2, 0, 0), (B3, 1, 0)], "block_fips string, hu2016 bigint, pop2016 bigint"
    )
    geom = spark.createDataFrame([(B2, 0), (B3, 9)], "geoid10 string, aland10 bigint")
    got = {r.block_fips: r.h2only_undev for r in flags.h2only_undev(pop, geom).collect()}
    assert got == {B1: 2, B2: 1, B3: 0}


def test_missing_speeds(spark):
    f = filings(
        spark,
        (B1, 1, 50, None, None), (B1, 1, 50, 30.0, 5.0),
        (B1, 2, 50, None, None),
    )
    t = by(providers.provider_table(f, blocks(spark, (B1, 5))), "hoconum", "tech")
    assert t[1, "50"]["d_4"] == 5 and t[1, "50"]["d_5"] == 0
    assert all(t[2, "50"][c] == 0 for c in ("d_1", "d_8", "u_1", "u_9"))


def test_nan_speed_is_missing(spark):
    from reachmap.sources.readers import normalise_filings

    f = normalise_filings(filings(spark, ("1001", 1, 50, float("nan"), float("nan"))))
    row = f.first()
    assert row.max_ad_down is None and row.block_code == "000000000001001"


@pytest.mark.parametrize("n,pop,want", [(1, 4, 0.2), (7, 20, 0.4), (9, 20, 0.4), (41, 20, 2.0)])
def test_half_even_rounding(spark, n, pop, want):
    got = spark.sql(f"select bround({n} / {pop}, 1) as r").first().r
    assert got == want


def test_block_without_filing_counts_zero(spark):
    c = counts(spark, filings(spark, (B1, 1, 50, 30.0, 5.0)), blocks(spark, (B1, 5), (B2, 1)))
    assert all(c[(B2,)][n] == 0 for n in combo_names())
    outer = fl.filings_block_outer(
        filings(spark, (B1, 1, 50, 30.0, None)), blocks(spark, (B1, 5), (B2, 1))
    )
    assert by(outer, "block_code")[(B2,)] == {
        "block_code": B2, "hoconum": 0, "tech_code": 0, "max_ad_down": 0.0, "max_ad_up": 0.0,
    }
    assert by(outer, "block_code")[(B1,)]["max_ad_up"] == 0.0


def test_filed_block_outside_the_master(spark):
    f, b = filings(spark, (LOST, 1, 50, 30.0, 5.0)), blocks(spark, (B1, 5))
    wide = numprov.block_numprov_wide(f, b, TIER["25_3"])
    flagged = by(numprov.numprov_with_flag(wide, b), "geoid10")
    assert flagged[(LOST,)]["h2only_undev"] is None and flagged[(LOST,)]["f"] == 1
    assert flagged[(B1,)]["h2only_undev"] == 0
    total = area.area_table(f, b).filter("type = 'nation' and tech = 'f' and tier = '25_3'").first()
    assert (total.has_0, total.has_1) == (5, 0)
    tract = by(rollup.weighted_numprov(f, b, 11, "tract_id"), "tract_id", "tier")
    lost = tract[LOST[:11], "25_3"]
    assert lost["f"] == 0.0 and lost["is_populated"] is False


def test_missing_provider_counts_as_one(spark):
    f = filings(spark, (B1, None, 50, 30.0, 5.0), (B1, None, None, 30.0, 5.0))
    c = counts(spark, f, blocks(spark, (B1, 5)))[(B1,)]
    assert (c["f"], c["o"], c["fo"]) == (1, 1, 1)


def test_combination_counts_are_not_sums(spark):
    f = filings(spark, (B1, 1, 10, 30.0, 5.0), (B1, 1, 40, 30.0, 5.0))
    c = counts(spark, f, blocks(spark, (B1, 5)))[(B1,)]
    assert (c["a"], c["c"], c["ac"], c["f"]) == (1, 1, 1, 0)


def test_five_providers_are_three_plus(spark):
    f = filings(spark, *[(B1, i, 50, 30.0, 5.0) for i in range(5)])
    b = blocks(spark, (B1, 5))
    pop = area.area_pop_by_nprov(f, b, TIER["25_3"], "f", "state")
    row = area.area_pivot(pop).first()
    assert (row.has_0, row.has_1, row.has_2, row.has_3plus) == (0, 0, 0, 5)
    capped = numprov.numprov_capped(numprov.block_numprov_wide(f, b, TIER["25_3"]))
    assert capped.first()["f"] == 3


def test_tract_without_people(spark):
    f = filings(spark, (B1, 1, 50, 30.0, 5.0), (B3, 1, 50, 30.0, 5.0), (B3, 2, 50, 30.0, 5.0))
    t = by(
        rollup.weighted_numprov(f, blocks(spark, (B1, 0), (B3, 3)), 11, "tract_id"),
        "tract_id", "tier",
    )
    empty, full = t[B1[:11], "25_3"], t[B3[:11], "25_3"]
    assert (empty["f"], empty["is_populated"]) == (0.0, False)
    assert (full["f"], full["is_populated"]) == (2.0, True)


def test_row_order_does_not_matter(spark):
    f = filings(spark, (B1, 1, 50, 30.0, 5.0), (B2, 1, 50, 30.0, 5.0), (B2, 2, 50, 30.0, 5.0))
    rows = [(B1, 3), (B2, 1)]
    a = rollup.weighted_numprov(f, blocks(spark, *rows), 11, "tract_id").collect()
    b = rollup.weighted_numprov(f, blocks(spark, *rows[::-1]), 11, "tract_id").collect()
    assert sorted(a) == sorted(b)
    assert by(rollup.weighted_numprov(f, blocks(spark, *rows), 11, "tract_id"), "tier")[
        ("25_3",)
    ]["f"] == 1.2


def test_blank_zeros_keeps_the_key(spark):
    df = spark.createDataFrame([("0", 0, 0, 1)], "geoid10 string, h2only_undev int, a int, c int")
    blanked = numprov.blank_zeros(df)
    assert tuple(blanked.first()) == ("0", None, None, 1)
    assert tuple(numprov.fill_zero(blanked).first()) == ("0", 0, 0, 1)


def test_speed_labels(spark):
    assert [t.speed for t in TIERS] == ["0.2", "4", "10", "25", "100", "250", "1000"]
    files = spark.createDataFrame(
        [("x/block_numprov_200.csv",), ("x/block_numprov_25_3.csv",)], "file string"
    )
    got = [r.s for r in files.select(tier_speed_of_file("file").alias("s")).collect()]
    assert got == [0.2, 25.0]
    f, b = filings(spark, (B1, 1, 50, 30.0, 5.0)), blocks(spark, (B1, 5))
    speeds = {(r.tier, r.speed) for r in area.area_table(f, b).collect()}
    assert ("25_3", "25") in speeds and ("200", "0.2") in speeds


def test_repeated_filing_is_one_key(spark):
    f = filings(spark, (B1, 1, 50, 30.0, 5.0), (B1, 1, 50, 30.0, 5.0))
    assert fl.max_speed_block_provider_tech(f).count() == 1
    assert fl.max_speed_window(f).count() == 2


def test_minimum_zoom_skips_missing(spark):
    geom = spark.createDataFrame([(B1,), (B2,)], "geoid10 string")
    large = spark.createDataFrame(
        [(B1, None, 9), (B3, 5, 5)], "block_fips string, x_zoom int, y_zoom int"
    )
    assert [tuple(r) for r in geometry.large_blocks_zoom(geom, large).collect()] == [(B1, 9)]


def test_counts_stay_integers(spark):
    f = filings(spark, (LOST, 1, 50, 30.0, 5.0), (B1, 1, 50, 30.0, 5.0))
    b = blocks(spark, (B1, 5))
    flagged = numprov.numprov_with_flag(numprov.block_numprov_wide(f, b, TIER["25_3"]), b)
    assert dict(flagged.dtypes)["f"] == "bigint"
    assert dict(flagged.dtypes)["h2only_undev"] == "tinyint"


def test_maxima_combine_over_filings_before_the_threshold(spark):
    f = filings(spark, (B1, 1, 50, 30.0, 1.0), (B1, 1, 50, 10.0, 5.0))
    b = blocks(spark, (B1, 5))
    assert counts(spark, f, b)[(B1,)]["f"] == 1
    assert numprov.tier_qualified(f, TIER["25_3"], (50,)).count() == 1


def test_narrowing_keeps_every_count(spark):
    row = {"geoid10": "x", **{n: 300 if n == "f" else 1 for n in combo_names()}}
    df = spark.createDataFrame([row])
    assert numprov.numprov_int8(df).first()["f"] == 300


def test_consumer_only(spark):
    f = spark.createDataFrame(
        [(B1, 0, 1, 50, 30.0, 5.0), (B1, None, 2, 50, 30.0, 5.0), (B1, 1, 3, 50, 30.0, 5.0)], FILING
    )
    assert [r.hoconum for r in fl.consumer_filings(f).collect()] == [3]


def test_bbox_override_by_layer(spark):
    rows = [("state", "02"), ("county", "02016"), ("cd115", "0200"), ("county", "02"), ("state", "01")]
    bounds = spark.createDataFrame(
        [(*r, 0.0, 0.0, 1.0, 1.0) for r in rows],
        "layer string, geoid string, minx double, miny double, maxx double, maxy double",
    )
    got = by(geometry.bbox_override(bounds, geometry.bbox_overrides(spark)), "layer", "geoid")
    assert got["state", "02"]["minx"] == -188.148909 and got["cd115", "0200"]["maxy"] == 71.365162
    assert got["county", "02016"]["maxx"] == -165.77847
    assert got["county", "02"]["minx"] == 0.0 and got["state", "01"]["maxx"] == 1.0


def test_collapsed_filings_change_nothing(spark, sf_dir):
    from reachmap.sources import fixtures as fx

    f, b = fx.filings(spark, sf_dir), fx.blocks(spark, sf_dir)
    small = fl.collapse_filings(f)
    for make in (
        lambda x: providers.provider_table(x, b),
        lambda x: numprov.block_numprov_wide(x, b, TIER["25_3"]),
    ):
        a, c = make(f), make(small)
        assert a.exceptAll(c).isEmpty() and c.exceptAll(a).isEmpty()


def test_area_sum_ignores_missing_population(spark):
    f = filings(spark, (B1, 1, 50, 30.0, 5.0))
    b = blocks(spark, (B1, None), (B2, 2))
    row = area.area_table(f, b).filter("type = 'nation' and tech = 'f' and tier = '25_3'").first()
    assert (row.has_0, row.has_1) == (2, 0)


def test_means_of_counties_from_the_weights_of_their_tracts(spark):
    f = filings(
        spark, (B1, 1, 50, 30.0, 5.0), (B2, 1, 50, 30.0, 5.0), (B2, 2, 10, 30.0, 5.0), (B3, 2, 10, 0.1, 0.1), (LOST, 3, 50, 30.0, 5.0)
    )
    b = blocks(spark, (B1, 5), (B2, 3), (B3, 0), ("010050000030001", 7))
    histogram = numprov.mask_histogram(f)
    weights = rollup.area_weights(histogram, b, 11, "area")
    means = rollup.weighted_of(histogram, b, 5, "county_id", weights=weights)
    want = rollup.weighted_numprov(f, b, 5, "county_id")
    assert by(means, "county_id", "tier") == by(want, "county_id", "tier")
    assert {r.county_id for r in means.collect()} == {"01001", "01003", "01005", "99001"}
    assert by(means, "county_id", "tier")["01001", "25_3"]["a"] == pytest.approx(0.4)
    assert means.count() == 4 * len(TIERS)
