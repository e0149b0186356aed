"""Table readers: columnar partitions, tab-separated raw files, streams over tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.dates import OPEN_DATE, as_date, window_start


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Parquet or ORC table (vectorised reader, filters and columns pushed by the optimizer)."""
    return spark.read.format(fmt).load(path)


def read_day(spark: SparkSession, path: str, as_of: str | dt.date, fmt: str = "parquet",
             column: str = "dt") -> DataFrame:
    """One business date of a date-partitioned table."""
    return read_table(spark, path, fmt).where(F.col(column) == F.lit(as_date(as_of)))


def read_days(spark: SparkSession, path: str, as_of: str | dt.date, days: int | None = None,
              with_open: bool = False, fmt: str = "parquet", column: str = "dt") -> DataFrame:
    """Partitions up to ``as_of``; the last ``days`` of them; optionally the open partition too."""
    col = F.col(column)
    keep = col <= F.lit(as_date(as_of))
    if days is not None:
        keep = keep & (col >= F.lit(window_start(as_of, days)))
    if with_open:
        keep = keep | (col == F.lit(OPEN_DATE))
    return read_table(spark, path, fmt).where(keep)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Tab-separated raw table with a declared schema; bad fields become null."""
    return spark.read.schema(schema).option("sep", "\t").option("mode", "PERMISSIVE").csv(path)


def stream_table(spark: SparkSession, path: str, fmt: str = "parquet",
                 files_per_trigger: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Unbounded view of a table's files, whether the table is one file or a folder of them.

    The last character goes into a one-letter glob class, so the source takes either shape;
    new files are picked up incrementally through the checkpoint.
    """
    schema = schema or spark.read.format(fmt).load(path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    return reader.load(f"{path[:-1]}[{path[-1]}]")
