"""Hot keys are split, and results do not change for it."""

import contextlib

import pytest
from pyspark.sql import functions as F

from reachmap.functions import joins
from reachmap.operators import filings as fl, geometry, providers
from reachmap.plans.catalog import QUERIES
from reachmap.sources import fixtures as fx

from .helpers import square


@contextlib.contextmanager
def conf(spark, **settings):
    old = {}
    for k, v in settings.items():
        k = k.replace("__", ".")
        old[k] = spark.conf.get(k, None)
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def many(spark):
    """A third of 30,000 rows under key 7, some identical, some without a key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(30_000).select(key.alias("key"), (F.col("id") % 11).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_spread_join_equals_join(spark, many, how):
    one = spark.range(0, 6000, 7).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w"))
    assert rows(joins.spread_join(many, one, "key", how)) == rows(many.join(one, "key", how))


def test_group_totals_equal_a_window(many):
    got = joins.with_group_totals(many, "key", total=F.sum("v"))
    want = many.withColumn(
        "total", F.when(F.col("key").isNotNull(), F.expr("sum(v) over (partition by key)"))
    )
    assert rows(got) == rows(want)


def test_tasks_of_the_counts_grow_with_their_rows(spark, monkeypatch):
    """The adaptive reader must not merge the narrow rows that are widened in hash maps."""
    from reachmap.operators import numprov

    monkeypatch.setattr(numprov, "WIDE_ROWS", 500, raising=False)
    monkeypatch.setattr(numprov, "NARROW_ROWS", 500, raising=False)
    f, b = _hot_block(spark, 1000)
    histogram = numprov.mask_histogram(f)
    counts = numprov.counts_of(histogram, b)
    n = histogram.count() + b.count() * 7
    assert counts.rdd.getNumPartitions() == -(-n // 500)
    got = {(r.geoid10, r.tier): r.f for r in counts.collect()}
    assert len(got) == 7 * b.select("geoid10").union(f.select("block_code")).distinct().count()
    assert got["010010000010001", "25_3"] == f.filter("block_code = '010010000010001'").count()


def test_tiles_of_providers_pass_no_shuffle(spark):
    from reachmap.operators import tiles

    prints = spark.range(60).selectExpr(
        "cast(id % 6 as int) as hoconum", "lpad(cast(id as string), 5, '0') as county_fips",
        "-100D + id / 7 as minx", "30D + id % 9 as miny", "-99.9D + id / 7 as maxx", "30.2D + id % 9 as maxy",
    )
    large = F.col("hoconum") < 2
    shown = prints.withColumn("level", F.when(large, "prov_lg").otherwise("prov_other"))
    shown = tiles.zoom_plan_features(shown, tiles.PROVIDER_BANDS)
    cover = tiles.tile_cover(shown)
    got = tiles.provider_tiles(prints, large)
    assert "hashpartitioning(layer" not in got._jdf.queryExecution().executedPlan().toString()
    assert tiles.cover_size(shown) == cover.count()
    want = tiles.coalesce_tiles(cover.withColumn("layer", F.col("level")), ["hoconum"], "hoconum")
    assert rows(got) == rows(want)


def _hot_block(spark, n=20_000):
    """Filings of many providers, a third of them in one block."""
    f = spark.range(n).selectExpr(
        "if(id % 3 = 0, '010010000010001', lpad(cast(id as string), 15, '0')) as block_code",
        "1 as consumer", "cast(id as int) as hoconum", "50 as tech_code",
        "30D as max_ad_down", "5D as max_ad_up",
    )
    b = spark.range(n).selectExpr(
        "if(id = 0, '010010000010001', lpad(cast(id as string), 15, '0')) as geoid10", "1L as pop"
    )
    return f, b


SPLIT = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="5000",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="5000",
    spark__sql__adaptive__coalescePartitions__enabled="false",
    spark__sql__shuffle__partitions="20",
)


def test_spread_join_splits_the_hot_key(spark, many):
    one = many.filter("key is not null").groupBy("key").agg(F.sum("v").alias("w"))
    with conf(spark, **SPLIT):
        assert "skew=true" in final_plan(joins.spread_join(many, one, "key"))
        assert "skew=true" in final_plan(joins.with_group_totals(many, "key", total=F.sum("v")))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_adaptive_join_can_split_a_hot_block(spark):
    f, b = _hot_block(spark)
    with conf(spark, **SPLIT):
        for df in (providers.provider_table(f, b), fl.filings_with_pop(f, b)):
            assert "skew=true" in final_plan(df)
        table = providers.provider_table(f, b)
        assert table.count() == 2 * f.count()


def test_adaptive_join_can_split_a_block_of_many_footprints(spark):
    f, b = _hot_block(spark)
    geom = b.select("geoid10", F.lit(1).alias("aland10"), F.from_json(F.lit(_json(square(0, 0))), _GEOM).alias("geom"))
    with conf(spark, **SPLIT):
        assert "skew=true" in final_plan(geometry.provider_blocks(f, geom).drop("geom"))


_GEOM = "array<array<array<struct<x: double, y: double>>>>"


def _json(geom):
    import json

    return json.dumps(geom)


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_has_no_cross_join_limit_or_row_udf(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "LocalLimit", "Sample"):
        assert bad not in plan
    if name not in ("dissolve_tract", "carto_tracts", "carto_counties", "tract_features", "county_features"):
        assert "InPandas" not in plan


def test_scan_reads_and_filters_only_what_is_needed(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/filings"
    fx.filings(spark, sf_dir).withColumn("name", F.lit("x")).write.parquet(path)
    d1 = fl.max_speed_block_provider(spark.read.parquet(path))
    plan = d1._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(consumer,1)" in plan and "name" not in plan.split("ReadSchema")[1]
