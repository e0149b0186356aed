"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dim_date(days: DataFrame, column: str = "dt", holidays: DataFrame | None = None) -> DataFrame:
    """One row per day between the first and the last day of ``days``.

    ``holidays`` (date_id) overrides the weekday rule of the workday flag.
    """
    span = days.agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a is not null")
    cal = span.select(F.explode(F.sequence("a", "b")).alias("date_id"))
    out = cal.select(
        "date_id", F.date_trunc("week", "date_id").cast("date").alias("week_start"),
        F.weekofyear("date_id").alias("week_id"), (F.weekday("date_id") + 1).alias("week_day"),
        F.dayofmonth("date_id").alias("day"), F.month("date_id").alias("month"),
        F.quarter("date_id").alias("quarter"), F.year("date_id").alias("year"),
        F.when(F.weekday("date_id") < 5, 1).otherwise(0).alias("is_workday"))
    if holidays is None:
        return out.withColumn("holiday_id", F.lit(None).cast("string"))
    off = holidays.select("date_id", F.col("holiday_id"))
    joined = out.join(off, "date_id", "left")
    return joined.withColumn("is_workday", F.when(F.col("holiday_id").isNotNull(), 0).otherwise(F.col("is_workday")))
