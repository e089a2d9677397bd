"""CSV and text files: read with header / quote escape, bad rows set aside.

``read_csv_checked`` reads with an explicit schema in PERMISSIVE mode and a
corrupt-record column, so a row whose field does not fit its type keeps its
good fields, carries its raw text, and can be written to a quarantine path
instead of failing the job or vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def write_csv(df: DataFrame, path: str, partitions: int | None = None) -> None:
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("header", True).option("escape", '"')
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType
                     ) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: bad rows keep their parsed fields plus the raw line."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).schema(full).csv(path))
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull())
    return good, bad


SOURCE_FILE = "_source_file"


def stream_csv_checked(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None,
                       header: bool = False) -> DataFrame:
    """CSV files as a stream: the schema's columns, the raw text of records
    that do not fit it (``_corrupt_record``), and each record's file."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    r = (spark.readStream.option("header", header).option("escape", '"').option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT).schema(full))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path).withColumn(SOURCE_FILE, F.col("_metadata.file_name"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of records read with a corrupt-record column: good ones
    with their columns, bad ones as raw text and file.

    ``df`` is to be persisted where it is a file scan: Spark does not parse
    columns that a query does not ask for, and so would find other records
    corrupt in each half.
    """
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT, SOURCE_FILE)
    bad = df.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw_record"), F.col(SOURCE_FILE).alias("source_file"))
    return good, bad


def write_quarantine(bad: DataFrame, path: str) -> None:
    bad.write.mode("append").parquet(path)


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
