"""Rows with whole vectors, and vectors in Arrow batches as matrices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Matrices are handled in slices of about this many entries.
ENTRIES = 1 << 20
# Doubles hold whole numbers up to this size exactly.
EXACT = 1 << 53
LONG = (1 << 63) - 1


def whole_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector has finite entries only, none of them null, and the table's usual length.

    The usual length is the one most rows have, of equals the longest: vectors of
    another length have no place in the same space.
    """
    v = F.col(column)
    good = df.filter(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))))
    most = good.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return good.filter(F.size(v) == (most["size"] if most else 0))


def scaled(vector: Column, factor: int, base: int = 0) -> Column:
    """floor(factor * c) + base of every entry as long; entries past a long's range stop at its ends."""
    bound = float(LONG - 2 * base - 2047)

    def one(c):
        x = F.lit(float(factor)) * c.cast("double")
        return F.floor(F.greatest(F.least(x, F.lit(bound)), F.lit(-bound))).cast("long") + F.lit(base).cast("long")

    return F.transform(vector, one)


def matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists of longs as a matrix, without a copy if it is one chunk."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = len(column)
    return flat.reshape(n, len(flat) // n if n else 0)


def exact(m: np.ndarray, largest: int) -> np.ndarray:
    """`m` as doubles if sums up to `largest` are exact in them, else as Python's integers."""
    return m.astype(np.float64 if largest < EXACT else object)


def top_size(m: np.ndarray) -> int:
    """The largest absolute value of a matrix of longs, as a Python integer."""
    return max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0
