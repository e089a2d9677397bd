"""Table scans: batch or stream, with the optional root-column unwrap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, path: str, *, stream: bool = False,
               schema=None, root_column: str | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Scan a Parquet table as a static or a streaming DataFrame.

    A stream needs a schema; when none is given it is taken from the files
    already present (same as a batch read of the path).  ``root_column``
    unwraps one struct column into top-level columns.
    """
    if stream:
        if schema is None:
            schema = spark.read.parquet(path).schema
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.parquet(path)
    else:
        df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    if root_column:
        df = df.select(F.col(f"{root_column}.*"))
    return df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of one driver table."""
    return spark.read.parquet(table_path(sf_dir, name))
