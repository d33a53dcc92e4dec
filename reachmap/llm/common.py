"""Reading the tables and small pieces that several operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Texts go to Python in batches of this many rows at most: long ones would make
# batches of Spark's usual 10,000 rows too large for an executor's memory.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, whose session hands rows to Python in small batches from now on."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    """True for fold 1. A row without an id is not held out, and never learned from."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))
