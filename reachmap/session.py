"""Session helpers."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores="*", app="reachmap", partitions=8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by the session.

    A local session (unit tests) without one falls back to a temporary folder;
    on a cluster executors would not see each other's, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="reachmap-"))
        folder = context.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written intermediate."""
    return f"{shared_folder(spark).rstrip('/')}/reachmap-{name}-{uuid.uuid4().hex}"


# Narrow rows that one task writes.
CUT_ROWS = 20_000


def tasks_for(rows: int, per_task: int = CUT_ROWS) -> int:
    """Tasks for so many rows."""
    return max(1, -(-rows // per_task))


def cut(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Cuts the lineage of iterative plans; the table survives lost executors. With
    `tasks`, as many write it at most: a file has its price, however many
    shuffle partitions a session has.
    """
    if tasks is not None:
        df = df.coalesce(tasks)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_key(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """`df` as a table in the shared folder, bucketed and sorted by a key: joins on it need no exchange."""
    return _bucketed(df.repartition(buckets, key), key, buckets, name)


def by_key_in_place(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """`by_key` for rows that are hash-partitioned by the key into `buckets` already: no row moves.

    Of a union, every part is; a bucket then has a file of each.
    """
    return _bucketed(df, key, buckets, name)


def _bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = "t_" + path.rsplit("-", 1)[-1]
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)
