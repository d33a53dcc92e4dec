"""FIPS key parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BLOCK_LEN, COUNTY_LEN, STATE_LEN, TRACT_LEN


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def prefix(col, n: int) -> Column:
    return F.substring(_c(col), 1, n)


def state_of(col) -> Column:
    return prefix(col, STATE_LEN)


def county_of(col) -> Column:
    return prefix(col, COUNTY_LEN)


def tract_of(col) -> Column:
    return prefix(col, TRACT_LEN)


def tail(col, n: int) -> Column:
    """The last n characters, e.g. the tract code at the end of a long geo id."""
    return F.right(_c(col), F.lit(n))


def pad_block(col) -> Column:
    """Block code with the leading zeros an integer column has lost."""
    c = _c(col).cast("string")
    return F.when(F.length(c) < BLOCK_LEN, F.lpad(c, BLOCK_LEN, "0")).otherwise(c)
