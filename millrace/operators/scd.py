"""Zipper (validity-interval) dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import OPEN_DATE, as_date, back


def open_zipper(snapshot: DataFrame, as_of: str | dt.date) -> DataFrame:
    """First load: every row is valid from ``as_of`` with an open end."""
    return (snapshot.withColumn("start_date", F.lit(as_date(as_of)))
            .withColumn("end_date", F.lit(OPEN_DATE)))


def advance_zipper(zipper: DataFrame, changes: DataFrame, key: str, as_of: str | dt.date) -> DataFrame:
    """Daily step: close the open version of changed keys the day before, open the new version.

    ``changes`` holds one row per key. Closed history is passed through untouched.
    """
    is_open = F.col("end_date") == F.lit(OPEN_DATE)
    touched = changes.select(key).withColumn("_changed", F.lit(True))
    current = zipper.where(is_open).join(touched, key, "left")
    kept = current.withColumn(
        "end_date", F.when(F.col("_changed"), F.lit(back(as_of, 1))).otherwise(F.col("end_date"))
    ).drop("_changed")
    fresh = open_zipper(changes, as_of)
    return zipper.where(~is_open).unionByName(kept).unionByName(fresh.select(*zipper.columns))
