"""Readers for the source tables: parquet (default), JDBC, and the crosswalk CSV."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursematch.sources import schemas

CROSSWALK_DESIGNATION_HEADERS = ("PS Requirement Designation", "PS")
CROSSWALK_EXPR_HEADER = "DARS Subreq AC1-AC5"


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A source table from files, cast to its declared schema.

    Parquet keeps predicate and column pushdown: the casts are no-ops when the
    files already carry the declared types.
    """
    schema = schemas.TABLES[name]
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class JdbcSource:
    """Connection of the source database; credentials come from the environment.

    ``user_env`` / ``password_env`` name environment variables set by the
    platform's secret provider; nothing secret is stored in code.
    """

    url: str
    user_env: str = "COURSEMATCH_DB_USER"
    password_env: str = "COURSEMATCH_DB_PASSWORD"
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "fetchsize": str(self.fetch_size),
                "user": os.environ.get(self.user_env, ""),
                "password": os.environ.get(self.password_env, "")}


def read_jdbc(spark: SparkSession, source: JdbcSource, table: str, name: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """One base table over JDBC, read in parallel slices of ``partition_column``.

    Filters and column selections written on the DataFrame are pushed into
    the database query by Spark's JDBC source, so the source SQL files are not
    needed: their logic is the DataFrame code of ``plans``.
    """
    reader = spark.read.format("jdbc").options(**source.options()).option("dbtable", table)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                        .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                        .option("numPartitions", str(num_partitions or 8)))
    df = reader.load()
    if name is None:
        return df
    schema = schemas.TABLES[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_crosswalk_csv(spark: SparkSession, path: str) -> DataFrame:
    """The crosswalk CSV (header row) as (designation, expr).

    Read with every column as string (no inference); the designation column
    may be headed 'PS Requirement Designation' or 'PS'.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    header = next((h for h in CROSSWALK_DESIGNATION_HEADERS if h in raw.columns), None)
    if header is None or CROSSWALK_EXPR_HEADER not in raw.columns:
        raise ValueError(f"crosswalk file {path} lacks the designation or expression column")
    return raw.select(F.col(f"`{header}`").alias("designation"),
                      F.col(f"`{CROSSWALK_EXPR_HEADER}`").alias("expr"))
