"""Table sources (O1) and result sinks (O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of the test layout ``{folder}/{name}.parquet``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header row and an explicit schema (no inference pass over
    the data, so the read is one scan and types are stable)."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .csv(path))


def write_result(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> None:
    """Persist a result table (the data behind a figure or printed metric)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
