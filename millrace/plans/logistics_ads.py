"""Logistics reports.

Reports with a one-day row take the daily summary and derive all periods from it in one pass;
shift, line, driver and truck reports read the rolling shift summary.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import as_date
from millrace.functions.numbers import ratio
from millrace.operators.rolling import DAYS, recent_days
from millrace.operators.joins import full_outer, level_region, lookup

Day = str | dt.date
TRANS = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]
ORDER = ["order_count", "order_amount"]


def _periods(daily: DataFrame, keys: list[str], sums: list[str], as_of: Day) -> DataFrame:
    """Sums of the last 1, 7 and 30 days at the report grain: one pass over the daily summary."""
    return recent_days(daily, keys, sums, as_of, DAYS)


def _stamp(df: DataFrame, as_of: Day) -> DataFrame:
    return df.withColumn("dt", F.lit(as_date(as_of)))


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.withColumnsRenamed(names)


def _averages(df: DataFrame) -> DataFrame:
    n = F.col("trans_finish_count")
    return (df.withColumn("avg_trans_finish_distance", ratio(F.col("trans_finish_distance"), n, 2))
            .withColumn("avg_trans_finish_dur_sec", ratio(F.col("trans_finish_dur_sec"), n, 2)))


def trans_order_stats(receive_1d: DataFrame, dispatch_1d: DataFrame, as_of: Day) -> DataFrame:
    got = _renamed(_periods(receive_1d, [], ORDER, as_of),
                   order_count="receive_order_count", order_amount="receive_order_amount")
    sent = _renamed(_periods(dispatch_1d, [], ORDER, as_of),
                    order_count="dispatch_order_count", order_amount="dispatch_order_amount")
    return _stamp(full_outer([got, sent], ["recent_days"]), as_of)


def trans_stats(truck_1d: DataFrame, as_of: Day) -> DataFrame:
    return _stamp(_periods(truck_1d, [], TRANS, as_of), as_of)


def trans_order_stats_td(dispatch_td: DataFrame, finish_td: DataFrame, as_of: Day) -> DataFrame:
    """Waybills on the way: dispatched minus arrived, by a signed union."""
    out = finish_td.select(*[(-F.col(c)).alias(c) for c in ORDER])
    net = dispatch_td.select(*ORDER).unionByName(out)
    return _stamp(net.agg(F.sum("order_count").alias("bounding_order_count"),
                          F.sum("order_amount").alias("bounding_order_amount")), as_of)


def order_stats(cargo_1d: DataFrame, as_of: Day) -> DataFrame:
    return _stamp(_periods(cargo_1d, [], ORDER, as_of), as_of)


def order_cargo_type_stats(cargo_1d: DataFrame, as_of: Day) -> DataFrame:
    return _stamp(_periods(cargo_1d, ["cargo_type", "cargo_type_name"], ORDER, as_of), as_of)


def city_stats(cargo_1d: DataFrame, truck_1d: DataFrame, organ: DataFrame, region: DataFrame, as_of: Day) -> DataFrame:
    keys = ["city_id", "city_name"]
    by_org = _periods(truck_1d, ["org_id"], TRANS, as_of)
    placed = lookup(by_org, organ, {"org_id": "id"}, _level="org_level", _region="region_id")
    placed = level_region(placed, region, "_region", "_level")
    by_city = placed.groupBy("recent_days", *keys).agg(*[F.sum(c).alias(c) for c in TRANS])
    orders = _periods(cargo_1d, keys, ORDER, as_of)
    trans = _averages(by_city)
    return _stamp(full_outer([orders, trans], ["recent_days", *keys]), as_of)


def org_stats(cargo_1d: DataFrame, truck_1d: DataFrame, organ: DataFrame, as_of: Day) -> DataFrame:
    """Station names come from the dimension on both sides, so they cannot split a station."""
    keys = ["org_id"]
    orders = _periods(cargo_1d, keys, ORDER, as_of)
    trans = _averages(_periods(truck_1d, keys, TRANS, as_of))
    both = full_outer([orders, trans], ["recent_days", *keys])
    return _stamp(lookup(both, organ, {"org_id": "id"}, org_name="org_name"), as_of)


def shift_stats(shift_nd, as_of: Day) -> DataFrame:
    cols = [*TRANS, "trans_finish_order_count"]
    return _stamp(shift_nd.groupBy("recent_days", "shift_id").agg(*[F.sum(c).alias(c) for c in cols]), as_of)


def line_stats(shift_nd, as_of: Day) -> DataFrame:
    cols = [*TRANS, "trans_finish_order_count"]
    return _stamp(shift_nd.groupBy("recent_days", "line_id", "line_name").agg(*[F.sum(c).alias(c) for c in cols]), as_of)


def driver_stats(shift_nd, as_of: Day) -> DataFrame:
    """Two drivers share distance and duration by halves; counts go to both."""
    pair = F.col("driver2_emp_id").isNotNull()
    first = F.struct(F.col("driver1_emp_id").alias("id"), F.col("driver1_name").alias("name"))
    second = F.struct(F.col("driver2_emp_id").alias("id"), F.col("driver2_name").alias("name"))
    crew = shift_nd.withColumn("d", F.explode(F.when(pair, F.array(first, second)).otherwise(F.array(first))))
    share = F.when(pair, F.lit(2)).otherwise(F.lit(1))
    rows = crew.select(
        "recent_days", F.col("d.id").alias("driver_emp_id"), F.col("d.name").alias("driver_name"), "trans_finish_count",
        (F.col("trans_finish_distance") / share).cast("decimal(20,3)").alias("trans_finish_distance"),
        (F.col("trans_finish_dur_sec") / share).cast("decimal(20,1)").alias("trans_finish_dur_sec"),
        F.col("trans_finish_delay_count").alias("trans_finish_late_count"))
    agg = rows.groupBy("recent_days", "driver_emp_id", "driver_name").agg(
        *[F.sum(c).alias(c) for c in [*TRANS, "trans_finish_late_count"]])
    return _stamp(_averages(agg), as_of)


def truck_stats(shift_nd, as_of: Day) -> DataFrame:
    agg = shift_nd.groupBy("recent_days", "truck_model_type", "truck_model_type_name").agg(
        *[F.sum(c).alias(c) for c in TRANS])
    return _stamp(_averages(agg), as_of)


def express_stats(keys: list[str], deliver_1d: DataFrame, sort_1d: DataFrame, as_of: Day,
                  receive_1d: DataFrame | None = None) -> DataFrame:
    """Delivered, sorted and (by place) received counts; full outer on coalesced keys.

    Keys: none (overall), province, city or station.
    """
    sides = [_renamed(_periods(deliver_1d, keys, ["order_count"], as_of), order_count="deliver_suc_count"),
             _periods(sort_1d, keys, ["sort_count"], as_of)]
    if receive_1d is not None:
        sides.append(_renamed(_periods(receive_1d, keys, ORDER, as_of),
                              order_count="receive_order_count", order_amount="receive_order_amount"))
    return _stamp(full_outer(sides, ["recent_days", *keys]), as_of)
