"""Partitioned JDBC read (no database in the test environment: untested).

The read is split into ``num_partitions`` range queries on a numeric
column, so a large table is fetched by many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, properties: dict | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions, properties=props)
