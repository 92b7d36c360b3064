"""Intermediate tables under the cluster's shared checkpoint folder.

A staged table cuts the lineage (a lost executor reads it again instead of computing it again), is
scanned with column pruning and filters like any table, and lets several passes read one computation.
What was shuffled for it is dropped once it is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from coursematch.config import checkpoint_dir

#: Drops what a query shuffled once it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a table written meanwhile goes with the write, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet under ``spark.checkpoint.dir`` and read back. Whoever owns the folder clears it,
    as with checkpoints; ``unstage`` removes a table earlier."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged table."""
    delete_folder(df.sparkSession, df._staged_path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_bucketed(df: DataFrame, name: str, buckets: int, by: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    """``df`` as a table with ``buckets`` buckets of ``by``, each sorted by ``sort``: joins, aggregates and windows
    on (a superset of) these columns read it without another shuffle.

    The data lie under ``spark.checkpoint.dir``; the table's name is in the session's catalog until ``drop_bucketed``.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{table}"
    writer = (df.repartition(buckets, *by).sortWithinPartitions(*by, *[c for c in sort if c not in by])
              .write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *by))
    with shuffles_dropped(spark):
        writer.sortBy(*by, *[c for c in sort if c not in by]).saveAsTable(table)
    out = spark.table(table)
    out._staged_table, out._staged_path = table, path
    return out


def drop_bucketed(df: DataFrame) -> None:
    """Remove a bucketed table, its name and its files."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._staged_table}")
    delete_folder(df.sparkSession, df._staged_path)
