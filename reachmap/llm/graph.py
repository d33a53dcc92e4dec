"""Connected components by alternating stars, in rounds that are written tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, tasks_for


def _state(edges: DataFrame):
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge; the root is the smallest node reached.

    Nodes are of one orderable type. Each round links every node's larger
    neighbours to its smallest one, then its smaller neighbours. The aggregates
    combine on the map side; smallest neighbours are a written table, so that
    the adaptive skew join can split the edges of a node with very many. A round's
    tables are written by as many tasks as the edges ask.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    e = cut(e, "edges")
    state = _state(e)
    while state[0]:
        tasks = tasks_for(2 * state[0])
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = cut(low.select("u", F.least("u", "m").alias("m")), "low", tasks)
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.distinct(), "large", tasks)
        low = large.groupBy("u").agg(F.min("v").alias("v"))
        inner = large.join(low.withColumnRenamed("v", "m"), "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(low.union(inner).distinct(), "edges", tasks)
        now = _state(e)
        if now == state:
            break
        state = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(e.select("v", "v").distinct())
