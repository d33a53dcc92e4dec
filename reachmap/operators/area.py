"""Population with 0, 1, 2 and 3 or more providers by geography."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import GEOGRAPHIES, TECH_CLASSES, TIERS, combos
from ..functions.speeds import speed_label, tier_rank
from .numprov import numprov_one, signature, signature_octets, tier_counts

HAS = ("has_0", "has_1", "has_2", "has_3plus")
CELL = ["urban_rural", "tribal_non"]


def present(col: Column) -> Column:
    """Neither null nor blank: the block lies in an area of this type."""
    return col.isNotNull() & (col != "")


def geo_ids(geographies=GEOGRAPHIES) -> Column:
    """Array of (type, id) of the areas a block lies in."""
    entries = []
    for kind, column in geographies.items():
        if column is None:
            entries.append(f"struct('{kind}' as type, '0' as id)")
        else:
            entries.append(
                f"if({column} is not null and {column} != '', "
                f"struct('{kind}' as type, {column} as id), null)"
            )
    return F.expr(f"array_compact(array({', '.join(entries)}))")


def area_pop_by_nprov(
    filings: DataFrame, blocks: DataFrame, tier, combo: str, geography: str
) -> DataFrame:
    """Population by (id, nprovs, urban_rural, tribal_non) for one geography."""
    column = GEOGRAPHIES[geography]
    counts = numprov_one(filings, blocks, tier, combo)
    located = blocks.withColumn(
        "id", F.lit("0") if column is None else F.col(column)
    ).filter(present(F.col("id")) & F.col("urban_rural").isNotNull() & F.col("tribal_non").isNotNull())
    return (
        located.join(counts, "geoid10", "left")
        .withColumn("nprovs", F.least("nprovs", F.lit(3)))
        .groupBy("id", "nprovs", *CELL)
        .agg(F.coalesce(F.sum("pop"), F.lit(0)).alias("pop"))
    )


def area_pivot(pop_by_nprov: DataFrame) -> DataFrame:
    """One row per (id, urban_rural, tribal_non) with has_0 .. has_3plus."""
    pivoted = (
        pop_by_nprov.groupBy("id", *CELL).pivot("nprovs", [0, 1, 2, 3]).agg(F.sum("pop"))
    )
    return pivoted.select(
        "id", *CELL, *[F.col(f"`{i}`").alias(n) for i, n in enumerate(HAS)]
    ).fillna(0, subset=list(HAS))


def area_table(
    filings: DataFrame,
    blocks: DataFrame,
    tiers=TIERS,
    classes=TECH_CLASSES,
    geographies=GEOGRAPHIES,
) -> DataFrame:
    """All geographies, combinations and tiers in one plan."""
    counts = tier_counts(filings, blocks, tiers, classes)
    return area_of(counts, blocks, tiers, classes, geographies)


def area_of(
    counts: DataFrame,
    blocks: DataFrame,
    tiers=TIERS,
    classes=TECH_CLASSES,
    geographies=GEOGRAPHIES,
) -> DataFrame:
    """`area_table` from the provider counts of all blocks.

    The capped counts of a block at a tier are packed into two BIGINTs, and
    blocks which agree in those, in all area ids and in the cell collapse before
    anything is exploded. Then the areas are exploded and collapse again, and
    only the distinct signatures of an area are unpacked into combinations.
    Each step is a sum, so map-side combining covers the nation's single id.
    """
    id_columns = [c for c in geographies.values() if c is not None]
    master = blocks.filter(
        F.col("urban_rural").isNotNull() & F.col("tribal_non").isNotNull()
    ).select("geoid10", F.coalesce("pop", F.lit(0)).alias("pop"), *id_columns, *CELL)
    sig = signature(counts, classes)
    packed = ["tier", "lo", "hi"]
    located = (
        master.join(sig, "geoid10")
        .groupBy(*id_columns, *CELL, *packed)
        .agg(F.sum("pop").alias("pop"))
    )
    per_area = (
        located.select(F.inline(geo_ids(geographies)), *CELL, *packed, "pop")
        .groupBy("type", "id", *CELL, *packed)
        .agg(F.sum("pop").alias("pop"))
    )
    # eight combinations per row: one group lookup serves eight of them
    octet = per_area.select(
        "type", "id", *CELL, "tier", "pop", F.posexplode(signature_octets(classes)).alias("g", "w")
    )
    sums = [
        F.expr(f"sum(if((shiftright(w, {2 * j}) & 3) = {i}, pop, 0L)) as s{j}_{i}")
        for j in range(8)
        for i in range(3)
    ]
    wide = octet.groupBy("type", "id", *CELL, "tier", "g").agg(F.sum("pop").alias("pop"), *sums)
    names = ", ".join(f"'{n}'" for _, n in combos(classes))
    entries = ", ".join(
        f"struct(8 * g + {j} as k, s{j}_0 as has_0, s{j}_1 as has_1, s{j}_2 as has_2, "
        f"pop - s{j}_0 - s{j}_1 - s{j}_2 as has_3plus)"
        for j in range(8)
    )
    return (
        wide.select("type", "id", *CELL, "tier", F.expr(f"inline(array({entries}))"))
        .filter(F.col("k").between(1, len(combos(classes))))
        .select(
            "type",
            "id",
            F.expr(f"element_at(array({names}), k) as tech"),
            "tier",
            speed_label("tier", tiers).alias("speed"),
            *CELL,
            *HAS,
        )
    )


def area_table_sorted(table: DataFrame, tiers=TIERS) -> DataFrame:
    """Six-key order, with the speed compared as a number."""
    return table.orderBy(
        "type", "id", "tech", tier_rank("tier", tiers), "urban_rural", "tribal_non"
    )
