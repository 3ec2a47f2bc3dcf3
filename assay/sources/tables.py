"""Sources and sinks (S1-S3): parquet tables, delimited files, in-memory records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   header: bool = True, mode: str = "PERMISSIVE",
                   corrupt_column: str | None = None) -> DataFrame:
    """Delimited text with a declared schema (never inferred).

    ``mode='PERMISSIVE'`` keeps malformed rows as nulls (optionally with the raw
    line in ``corrupt_column``); ``'FAILFAST'`` raises; a missing path raises an
    ``AnalysisException`` the caller can catch instead of crashing the job.
    """
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
    reader = (spark.read.schema(schema).option("sep", sep).option("header", header)
              .option("mode", mode))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def from_records(spark: SparkSession, records, schema: T.StructType) -> DataFrame:
    """A small table from in-memory records (one sample or a scoring batch)."""
    return spark.createDataFrame(records, schema)


def write_table(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                fmt: str = "parquet", mode: str = "overwrite") -> str:
    """S3: write a result table, optionally partitioned by segment for pruning."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)
