"""Inputs: the trade table, the reference data and the text feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.schemas import FEED_SCHEMA

def read_table(
    spark: SparkSession,
    source: str | None = None,
    format: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A table from files, the catalog (``format="table"``) or any reader format.

    A ``jdbc`` source takes its connection, partition column and bounds as
    ``options``; without the partition options Spark reads it in one task.
    """
    if format == "table":
        return spark.table(source)
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source) if source is not None else reader.load()


def read_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The result of a SQL query, to be checked like a table."""
    return spark.sql(query, **tables)


def read_feed(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    ingested_at: dt.datetime | Column | None = None,
    **options: str,
) -> DataFrame:
    """The all-text feed with the name of the file each row came from."""
    if format == "csv":
        options = {"header": "true", **options}
    rows = spark.read.format(format).schema(FEED_SCHEMA).options(**options).load(path)
    return _with_origin(rows, ingested_at)


def stream_feed(
    spark: SparkSession, path: str, format: str = "csv", **options: str
) -> DataFrame:
    """The same feed as a stream of files; each file is read once."""
    if format == "csv":
        options = {"header": "true", **options}
    rows = spark.readStream.format(format).schema(FEED_SCHEMA).options(**options).load(path)
    return _with_origin(rows, None)


def _with_origin(rows: DataFrame, ingested_at: dt.datetime | Column | None) -> DataFrame:
    if ingested_at is None:
        ingested_at = F.current_timestamp()
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    return rows.select(
        *FEED_SCHEMA.fieldNames(),
        F.col("_metadata.file_name").alias("source_file"),
        stamp.alias("ingested_at"),
    )
