"""JDBC tables.

Reads are split into ``num_partitions`` range queries on a numeric column
when bounds are given, so a large table is not pulled through one
connection. The URL is always an argument.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """A5: read a table (or ``(subquery) alias``); filters and projections on
    the result are pushed into the SQL sent to the database."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions or 8)))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: dict | None = None, batch_size: int = 10_000,
               num_partitions: int | None = None) -> None:
    """Write a table; ``num_partitions`` caps concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def list_databases(spark: SparkSession) -> list[str]:
    """Catalog databases."""
    return [d.name for d in spark.catalog.listDatabases()]
