"""Distinct providers per block for every technology combination and tier.

A provider's technologies at a tier are a set of class bits, so it counts for
combination k exactly when `mask & k` is not 0. One histogram of masks per
(block, tier), at most 2^classes rows, holds the counts of all combinations.

Filings, masks and histogram are written once each, so that every step's tasks
are as many as its rows ask, and a task's hash maps keep their size whatever
the input's.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TECH_CLASSES, TIERS, combo_layout, combo_names, combos
from ..functions.joins import in_tasks
from ..functions.keys import pad_block
from ..functions.speeds import meets, tech_class_bit
from ..session import cut
from .filings import KEY, consumer_filings, max_speed_by

# Rows of a task: filings or masks into narrow maps, histogram rows into wide sums.
NARROW_ROWS, WIDE_ROWS = 250_000, 100_000


def numprov_filings(filings: DataFrame) -> DataFrame:
    """Consumer filings as the counts see them: a missing provider or code is 0."""
    return (
        consumer_filings(filings)
        .filter(F.col("block_code").isNotNull())
        .fillna(0, subset=["hoconum", "tech_code"])
    )


def tier_qualified(filings: DataFrame, tier, codes) -> DataFrame:
    """(block, provider, technology) keys which reach a tier with one of the codes."""
    d1 = max_speed_by(numprov_filings(filings), ["block_code", "hoconum", "tech_code"])
    return d1.filter(meets(tier) & F.col("tech_code").isin(*codes))


def provider_masks(filings: DataFrame, tiers=TIERS, classes=TECH_CLASSES) -> DataFrame:
    """One row per (block, provider) with its class bits at each tier, m_<tier>.

    A provider's filings of a block meet in one shuffle; a block's do not, so a block
    of very many providers is no single task.
    """
    rows = cut(numprov_filings(filings).select(*KEY, "max_ad_down", "max_ad_up"), "numprov-filings")
    d1 = max_speed_by(in_tasks(rows, rows.count(), NARROW_ROWS, "block_code", "hoconum"), KEY)
    bit = tech_class_bit("tech_code", classes)
    masks = [
        F.expr(
            f"bit_or(if(max_down >= {t.down}D and max_up >= {t.up}D, bit, 0)) as `m_{t.name}`"
        )
        for t in tiers
    ]
    return d1.withColumn("bit", bit).groupBy("block_code", "hoconum").agg(*masks)


def mask_histogram(filings: DataFrame, tiers=TIERS, classes=TECH_CLASSES) -> DataFrame:
    """(geoid10, tier, mask, n): providers per set of technologies.

    Providers which reach no tier stay with mask 0, so each filed block is in
    the result for every tier. The result is a written table.
    """
    # tier and mask share one integer, so the rows of the widest shuffle stay narrow
    width = len(classes)
    codes = ", ".join(
        f"{i << width} | `m_{t.name}`" for i, t in enumerate(tiers)
    )
    names = ", ".join(f"'{t.name}'" for t in tiers)
    masks = cut(provider_masks(filings, tiers, classes).drop("hoconum"), "provider-masks")
    counted = (
        in_tasks(masks, masks.count(), NARROW_ROWS, "block_code")
        .selectExpr("block_code as geoid10", f"explode(array({codes})) as code")
        .groupBy("geoid10", "code")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            "geoid10",
            f"element_at(array({names}), 1 + shiftright(code, {width})) as tier",
            f"code & {(1 << width) - 1} as mask",
            "n",
        )
    )
    return cut(counted, "mask-histogram")


def combo_sums(weight: str, classes=TECH_CLASSES) -> list[Column]:
    """Sum of the column `weight` over the masks which meet each combination."""
    return [
        F.expr(f"sum(if(mask & {k} != 0, {weight}, 0L)) as `{name}`")
        for k, name in combos(classes)
    ]


def spine(blocks: DataFrame, tiers=TIERS) -> DataFrame:
    """Every block at every tier with an empty mask."""
    names = F.array(*[F.lit(t.name) for t in tiers])
    return blocks.select(
        "geoid10",
        F.explode(names).alias("tier"),
        F.lit(0).alias("mask"),
        F.lit(0).cast("bigint").alias("n"),
    )


def tier_counts(
    filings: DataFrame, blocks: DataFrame, tiers=TIERS, classes=TECH_CLASSES
) -> DataFrame:
    """(geoid10, tier, one column per combination), zeros included.

    The narrow histogram is partitioned by block before it is widened, so the
    wide counts never pass through a shuffle and later joins on the block find
    them in place. A block brings at most tiers x 2^classes histogram rows, so
    this partitioning cannot be skewed.
    """
    return counts_of(mask_histogram(filings, tiers, classes), blocks, tiers, classes)


def counts_of(
    histogram: DataFrame, blocks: DataFrame, tiers=TIERS, classes=TECH_CLASSES, tasks: int | None = None
) -> DataFrame:
    """`tier_counts` from a mask histogram, which is counted: give it as a table.

    With `tasks`, blocks are dealt out to so many, and the histogram is not counted.
    """
    rows = histogram.unionByName(spine(blocks, tiers))
    dealt = in_tasks(rows, rows.count(), WIDE_ROWS, "geoid10") if tasks is None else rows.repartition(tasks, "geoid10")
    return (
        dealt.groupBy("geoid10", "tier")
        .agg(*combo_sums("n", classes))
    )


def numprov_one(filings: DataFrame, blocks: DataFrame, tier, combo: str, classes=TECH_CLASSES):
    """(geoid10, nprovs) of one tier and one combination, as a plain distinct count."""
    codes = [c for letter in combo for c in classes[letter]]
    hits = tier_qualified(filings, tier, codes).select("block_code", "hoconum")
    rows = (
        hits.select(F.col("block_code").alias("geoid10"), "hoconum")
        .unionByName(
            numprov_filings(filings).select(
                F.col("block_code").alias("geoid10"), F.lit(None).cast("int").alias("hoconum")
            )
        )
        .unionByName(blocks.select("geoid10", F.lit(None).cast("int").alias("hoconum")))
    )
    return rows.groupBy("geoid10").agg(F.countDistinct("hoconum").alias("nprovs"))


def block_numprov_wide(filings: DataFrame, blocks: DataFrame, tier, classes=TECH_CLASSES):
    """Counts of one tier, one column per combination."""
    return tier_counts(filings, blocks, [tier], classes).drop("tier")


def to_long(counts: DataFrame, classes=TECH_CLASSES) -> DataFrame:
    """Unpivot the combination columns to (.., combo, nprovs) rows."""
    names = combo_names(classes)
    keys = [c for c in counts.columns if c not in names]
    values = ", ".join(f"`{n}`" for n in names)
    labels = ", ".join(f"'{n}'" for n in names)
    return counts.selectExpr(*keys, f"posexplode(array({values})) as (i, nprovs)").selectExpr(
        *keys, f"array({labels})[i] as combo", "nprovs"
    )


def block_numprov_long(
    filings: DataFrame, blocks: DataFrame, tiers=TIERS, classes=TECH_CLASSES
) -> DataFrame:
    return to_long(tier_counts(filings, blocks, tiers, classes), classes)


def numprov_with_flag(counts: DataFrame, blocks: DataFrame) -> DataFrame:
    """Block flag on the counts; filed blocks outside the master keep a null flag."""
    return blocks.select("geoid10", "h2only_undev").join(counts, "geoid10", "right")


def numprov_capped(counts: DataFrame, cap: int = 3, classes=TECH_CLASSES) -> DataFrame:
    return _map_counts(counts, f"least(`{{}}`, {cap}L)", classes)


def numprov_int8(counts: DataFrame, classes=TECH_CLASSES) -> DataFrame:
    """Counts narrowed to INT, which no count outgrows; a byte would not hold them all."""
    return _map_counts(counts, "cast(`{}` as int)", classes)


def _map_counts(counts: DataFrame, expr: str, classes) -> DataFrame:
    names = set(combo_names(classes))
    return counts.selectExpr(
        *[f"{expr.format(c)} as `{c}`" if c in names else f"`{c}`" for c in counts.columns]
    )


def export_layout(counts: DataFrame, tier_name: str, classes=TECH_CLASSES) -> DataFrame:
    """Padded block code, flag, then `<combo>_<tier>` columns, longest combination first."""
    return counts.select(
        pad_block("geoid10").alias("geoid10"),
        "h2only_undev",
        *[F.expr(f"`{n}` as `{n}_{tier_name}`") for n in combo_layout(classes)],
    )


def blank_zeros(df: DataFrame, *keys: str) -> DataFrame:
    """0 to null in every column but the keys."""
    keys = keys or ("geoid10",)
    return df.selectExpr(
        *[f"`{c}`" if c in keys else f"nullif(`{c}`, 0) as `{c}`" for c in df.columns]
    )


def fill_zero(df: DataFrame, *keys: str) -> DataFrame:
    """Null to 0 in every column but the keys."""
    keys = keys or ("geoid10",)
    return df.fillna(0, subset=[c for c in df.columns if c not in keys])


def signature(counts: DataFrame, classes=TECH_CLASSES, cap: int = 3) -> DataFrame:
    """Counts capped at 3 as two BIGINTs with two bits per combination.

    Keeps (geoid10, tier); combination k is at bit 2*(k % 32) of `lo` for k < 32
    and of `hi` otherwise.
    """

    def pack(ks, name):
        fields = [f"shiftleft(least(`{n}`, {cap}L), {2 * (k % 32)})" for k, n in ks]
        return f"{' | '.join(fields) or '0L'} as {name}"

    every = combos(classes)
    return counts.selectExpr(
        "geoid10",
        "tier",
        pack([c for c in every if c[0] < 32], "lo"),
        pack([c for c in every if c[0] >= 32], "hi"),
    )


def signature_octets(classes=TECH_CLASSES) -> Column:
    """The signature as an array of 16-bit words, combination k = 8 * octet + j at bit 2 * j."""
    words = [
        f"cast(shiftrightunsigned({'lo' if g < 4 else 'hi'}, {16 * (g % 4)}) & 65535 as int)"
        for g in range(max(1, (1 << len(classes)) // 8))
    ]
    return F.expr(f"array({', '.join(words)})")
