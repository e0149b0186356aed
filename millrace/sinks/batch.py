"""Batch write semantics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.functions.dates import as_date


def write_partitions(df: DataFrame, path: str, partition: str = "dt", fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``; a re-run gives the same table.

    Rows are rebalanced by partition value before the write: few files per partition, and a
    partition with a large share of the rows is split over several tasks.
    """
    (df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).format(fmt).save(path))


def write_day(df: DataFrame, path: str, as_of: str | dt.date, partition: str = "dt",
              fmt: str = "parquet") -> None:
    """Replace one static partition."""
    write_partitions(df.withColumn(partition, F.lit(as_date(as_of))), path, partition, fmt)


def recreate(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Drop and recreate a table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt).save(path)


def append_report(new: DataFrame, path: str, date: str = "dt") -> None:
    """Accumulating report: the dates in ``new`` are replaced by their distinct rows, all others stay as they are.

    A day costs what its own rows cost, and a repeated run changes nothing.
    """
    write_partitions(new.distinct(), path, date)


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON text column ``value`` with snake_case keys."""
    named = df.select(*[F.col(c).alias(snake(c)) for c in df.columns])
    return named.select(F.to_json(F.struct("*")).alias("value"))


def snake(name: str) -> str:
    out = [("_" + ch.lower()) if ch.isupper() else ch for ch in name]
    return "".join(out).lstrip("_")


def day_bucketed(df: DataFrame, ts: str) -> DataFrame:
    """Add ``day``: seconds are taken as seconds, millis as millis, anything else goes to an error bucket."""
    number = F.expr(f"try_cast({ts} as bigint)")
    millis = F.when(F.length(number.cast("string")) == 10, number * 1000).when(
        F.length(number.cast("string")) == 13, number)
    return df.withColumn("day", F.coalesce(F.date_format(F.timestamp_millis(millis), "yyyyMMdd"),
                                           F.lit("error_bucket")))


# Column type names of the export target per Spark type name.
EXPORT_TYPES = {
    "string": "string", "tinyint": "smallint", "smallint": "smallint", "int": "int",
    "bigint": "bigint", "float": "float", "double": "double", "boolean": "boolean",
    "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
}


def export_frame(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Typed export: the first of columns that differ only by case wins, types follow the map,
    nested values become JSON text."""
    unique = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    seen: set[str] = set()
    cols = []
    for i, field in enumerate(df.schema.fields):
        low, col = field.name.lower(), F.col(f"_c{i}")
        if low in seen:
            continue
        seen.add(low)
        kind = field.dataType.simpleString()
        target = (overrides or {}).get(low)
        if target is None and kind.startswith(("array", "map", "struct")):
            cols.append(F.to_json(col).alias(low))
            continue
        target = target or (kind if kind.startswith("decimal") else EXPORT_TYPES.get(kind, "string"))
        cols.append(col.cast(target).alias(low))
    return unique.select(*cols)


def export_table(df: DataFrame, target: str, fmt: str = "parquet", overrides: dict[str, str] | None = None,
                 **options: str) -> None:
    """Distributed full-table export; ``fmt='jdbc'`` takes the usual options."""
    writer = export_frame(df, overrides).write.mode("overwrite").format(fmt).options(**options)
    writer.save() if fmt == "jdbc" else writer.save(target)


def audited(df: DataFrame, name: str = "audit") -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
