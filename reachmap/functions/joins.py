"""Joins from many rows to one row per key which survive a hot key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _keys(on):
    return [on] if isinstance(on, str) else list(on)


def _all_set(df: DataFrame, keys) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].isNotNull()
    return cond


def spread_join(many: DataFrame, one: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join of `many` rows to a lookup side with one row per key.

    The adaptive skew join splits a hot key by the bytes of a task, but only
    where both sides come straight from a shuffle; it cannot when the lookup side
    is itself an aggregate on the key. So the lookup side, small beside the
    other, is written first. `many` is read once. `how` is left, inner or
    left_semi.
    """
    return many.join(cut(one, "lookup"), _keys(on), how)


def in_tasks(df: DataFrame, rows: int, per_task: int, *keys: str) -> DataFrame:
    """`df` of `rows` rows, hash-partitioned by keys into tasks of about `per_task` rows.

    The adaptive reader merges shuffle partitions by their compressed bytes. Narrow rows
    compress well and a hash map of them, or of what they widen to, is dozens of times that,
    so a task's memory would be what the merged bytes happen to unfold to. A given
    number of partitions stays.
    """
    return df.repartition(max(1, -(-rows // per_task)), *keys)


def with_group_totals(df: DataFrame, on, **aggs: Column) -> DataFrame:
    """Aggregates of each row's group on the row itself.

    A window would hold a whole group in one task; this aggregates with
    map-side combining and joins the one row per group back. The rows are
    written once, and both steps read them from there. Rows with a null key
    keep null totals.
    """
    keys = _keys(on)
    rows = cut(df, "group-rows")
    totals = (
        rows.filter(_all_set(rows, keys))
        .groupBy(*keys)
        .agg(*[c.alias(n) for n, c in aggs.items()])
    )
    return spread_join(rows, totals, keys, "left")
