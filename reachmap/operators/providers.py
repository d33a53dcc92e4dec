"""Population covered per provider and technology at speed thresholds."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DOWN_THRESHOLDS, PROVIDER_GROUPS, UP_THRESHOLDS
from .filings import KEY, consumer_filings, max_speed_block_provider_tech, max_speed_by

POISON, IGNORE = "poison", "ignore"


def threshold_sums(
    unmatched=POISON, down=DOWN_THRESHOLDS, up=UP_THRESHOLDS
) -> list[Column]:
    """d_1.., u_1..: population of the blocks whose speed reaches each threshold.

    A block missing from the block master has no population. With 'poison' one
    such block makes every sum of its group null, reached threshold or not; with
    'ignore' it adds nothing.
    """
    if unmatched not in (POISON, IGNORE):
        raise ValueError(f"unmatched must be '{POISON}' or '{IGNORE}'")

    def total(speed, threshold, name):
        # SQL text: one parsed expression instead of a chain of column calls
        s = f"sum(if({speed} >= {float(threshold)}D, coalesce(pop, 0L), 0L))"
        if unmatched == POISON:
            s = f"if(bool_or(pop is null), null, {s})"
        return F.expr(f"{s} as {name}")

    return [total("max_down", t, f"d_{i}") for i, t in enumerate(down, 1)] + [
        total("max_up", t, f"u_{i}") for i, t in enumerate(up, 1)
    ]


def with_pop(speeds: DataFrame, blocks: DataFrame) -> DataFrame:
    pop = blocks.select(F.col("geoid10").alias("block_code"), "pop")
    return speeds.join(pop, "block_code", "left")


def provider_pop_by_tech(filings: DataFrame, blocks: DataFrame, unmatched=POISON) -> DataFrame:
    d1 = with_pop(max_speed_block_provider_tech(filings), blocks)
    return d1.groupBy("hoconum", "tech_code").agg(*threshold_sums(unmatched))


def provider_pop_all(filings: DataFrame, blocks: DataFrame, unmatched=POISON) -> DataFrame:
    """Grain 'all': a filing without a technology code adds its block but no speed."""
    known = F.col("tech_code").isNotNull()
    f = consumer_filings(filings)
    f = f.withColumns({c: F.when(known, F.col(c)) for c in ("max_ad_down", "max_ad_up")})
    d2 = max_speed_by(f, KEY[:2])
    return with_pop(d2, blocks).groupBy("hoconum").agg(*threshold_sums(unmatched))


def provider_pop_by_class(
    filings: DataFrame, blocks: DataFrame, groups=PROVIDER_GROUPS, unmatched=POISON
) -> DataFrame:
    """All technology groups at once; a code may be in several groups."""
    labels = F.array_compact(
        F.array(*[F.when(F.col("tech_code").isin(*c), F.lit(g)) for g, c in groups.items()])
    )
    f = consumer_filings(filings).withColumn("tech", F.explode(labels))
    d3 = max_speed_by(f, ["block_code", "hoconum", "tech"])
    return with_pop(d3, blocks).groupBy("hoconum", "tech").agg(*threshold_sums(unmatched))


def provider_table(
    filings: DataFrame, blocks: DataFrame, groups=PROVIDER_GROUPS, unmatched=POISON
) -> DataFrame:
    """Union of the grains: all, technology groups and raw codes.

    One pass instead of one per grain. Filings collapse to (block, provider,
    technology) and then to one row per (block, provider) which carries the
    maxima of every label: the population is joined once to the smallest set
    of rows, the labels are unpacked afterwards and summed with map-side
    combining. A row's list has one entry per technology code, whose domain is
    a small fixed code list.

    A filing without a technology code counts towards no label's speed, but its
    provider still gets an 'all' row.
    """
    known = F.col("tech_code").isNotNull()
    f = consumer_filings(filings).filter(
        F.col("block_code").isNotNull() & F.col("hoconum").isNotNull()
    )
    d1 = f.groupBy(*KEY).agg(
        F.max(F.when(known, F.col("max_ad_down"))).alias("max_down"),
        F.max(F.when(known, F.col("max_ad_up"))).alias("max_up"),
    )

    def entry(tech, down, up):
        return f"struct({tech} as tech, {down} as max_down, {up} as max_up)"

    raw = entry("cast(tech_code as string)", "max_down", "max_up")
    group_max = []
    for g, codes in groups.items():
        inside = f"tech_code in ({', '.join(str(c) for c in codes)})"
        group_max += [
            F.expr(f"bool_or({inside}) as in_{g}"),
            F.expr(f"max(if({inside}, max_down, null)) as down_{g}"),
            F.expr(f"max(if({inside}, max_up, null)) as up_{g}"),
        ]
    per_provider = d1.groupBy("block_code", "hoconum").agg(
        F.expr(f"collect_list(if(tech_code is null, null, {raw})) as raw"),
        F.max("max_down").alias("down_all"),
        F.max("max_up").alias("up_all"),
        *group_max,
    )
    fixed = [entry("'all'", "down_all", "up_all")] + [
        f"if(in_{g}, {entry(repr(g), f'down_{g}', f'up_{g}')}, null)" for g in groups
    ]
    labels = per_provider.selectExpr(
        "block_code",
        "hoconum",
        f"concat(array_compact(array({', '.join(fixed)})), raw) as labels",
    )
    return (
        with_pop(labels, blocks)
        .select("hoconum", "pop", F.inline("labels"))
        .groupBy("hoconum", "tech")
        .agg(*threshold_sums(unmatched))
    )


def provider_table_by_grain(
    filings: DataFrame, blocks: DataFrame, groups=PROVIDER_GROUPS, unmatched=POISON
) -> DataFrame:
    """The same table as a union of separately computed grains."""
    parts = [
        provider_pop_all(filings, blocks, unmatched).withColumn("tech", F.lit("all")),
        provider_pop_by_class(filings, blocks, groups, unmatched),
        provider_pop_by_tech(filings, blocks, unmatched)
        .withColumn("tech", F.col("tech_code").cast("string"))
        .drop("tech_code"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
