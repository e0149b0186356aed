"""Logistics summaries.

A waybill has several cargo rows that repeat its amount, so every order measure is taken at
order level first (``max`` per order) and then summed. Stations are joined after the data is
reduced to station or district level.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.operators.joins import level_region, lookup, region_path
from millrace.operators.rolling import recent_days

Day = str | dt.date
PLACE = ["city_id", "city_name", "province_id", "province_name"]


def _dealt(detail: DataFrame, *columns: str) -> DataFrame:
    """Columns of the detail, dealt anew for an aggregate that has about as many groups as rows.

    Its tasks are the session's shuffle partitions, which are not merged up to a size on disk, and not those
    that hold the sorted sides of the join before.
    """
    parts = int(detail.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return detail.select(*columns).repartition(parts, *[c for c in columns if c != "amount"])


def _orders(detail: DataFrame, *keys: str) -> DataFrame:
    return _dealt(detail, "order_id", *keys, "dt", "amount").groupBy("order_id", *keys, "dt").agg(F.max("amount").alias("amount"))


def _station(reduced: DataFrame, organ: DataFrame, district: str) -> DataFrame:
    return lookup(reduced, organ, {district: "region_id"}, org_id="id", org_name="org_name", _region="region_id")


def org_cargo_type_order_1d(detail: DataFrame, organ: DataFrame, region: DataFrame, dic: DataFrame) -> DataFrame:
    orders = _orders(detail, "cargo_type", "sender_district_id", "sender_city_id")
    keys = ["cargo_type", "sender_city_id", "dt"]
    reduced = orders.groupBy("sender_district_id", *keys).agg(
        F.count("order_id").alias("n"), F.sum("amount").alias("a"))
    placed = _station(reduced, organ, "sender_district_id")
    out = placed.groupBy("org_id", "org_name", *keys).agg(
        F.sum("n").alias("order_count"), F.sum("a").alias("order_amount"))
    out = out.withColumnRenamed("sender_city_id", "city_id")
    out = lookup(out, region, {"city_id": "id"}, city_name="name")
    return lookup(out, dic, {"cargo_type": "id"}, cargo_type_name="name")


def org_receive_1d(detail: DataFrame, organ: DataFrame, region: DataFrame) -> DataFrame:
    reduced = _orders(detail, "sender_district_id").groupBy("sender_district_id", "dt").agg(
        F.count("order_id").alias("n"), F.sum("amount").alias("a"))
    placed = region_path(_station(reduced, organ, "sender_district_id"), region, "_region")
    return placed.groupBy("org_id", "org_name", *PLACE, "dt").agg(
        F.sum("n").alias("order_count"), F.sum("a").alias("order_amount"))


def dispatch_1d(detail: DataFrame) -> DataFrame:
    return _orders(detail).groupBy("dt").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


def org_truck_type_1d(finished: DataFrame, truck: DataFrame) -> DataFrame:
    """Reduced per truck first; the truck dimension meets one row per station, truck and day."""
    reduced = finished.groupBy(F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"),
                               "truck_id", "dt").agg(
        F.count("id").alias("n"), F.sum("actual_distance").alias("d"), F.sum("finish_dur_sec").alias("s"))
    named = lookup(reduced, truck, {"truck_id": "id"}, truck_model_type="truck_model_type",
                   truck_model_type_name="truck_model_type_name")
    return named.groupBy("org_id", "org_name", "truck_model_type", "truck_model_type_name", "dt").agg(
        F.sum("n").alias("trans_finish_count"), F.sum("d").alias("trans_finish_distance"),
        F.sum("s").alias("trans_finish_dur_sec"))


def org_deliver_1d(detail: DataFrame, organ: DataFrame, region: DataFrame) -> DataFrame:
    orders = _dealt(detail, "order_id", "receiver_district_id", "dt").distinct()
    reduced = orders.groupBy("receiver_district_id", "dt").agg(F.count("order_id").alias("n"))
    placed = region_path(_station(reduced, organ, "receiver_district_id"), region, "_region")
    return placed.groupBy("org_id", "org_name", *PLACE, "dt").agg(F.sum("n").alias("order_count"))


def org_sort_1d(sorts: DataFrame, organ: DataFrame, region: DataFrame) -> DataFrame:
    counts = sorts.groupBy("org_id", "dt").agg(F.count(F.lit(1)).alias("sort_count"))
    named = lookup(counts, organ, {"org_id": "id"}, org_name="org_name", org_level="org_level", region_id="region_id")
    return level_region(named, region, "region_id", "org_level").select("org_id", "org_name", *PLACE, "sort_count", "dt")


def org_cargo_type_order_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    keys = ["org_id", "org_name", "city_id", "city_name", "cargo_type", "cargo_type_name"]
    return recent_days(daily, keys, ["order_count", "order_amount"], as_of)


def org_receive_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return recent_days(daily, ["org_id", "org_name", *PLACE], ["order_count", "order_amount"], as_of)


def dispatch_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return recent_days(daily, [], ["order_count", "order_amount"], as_of)


def org_deliver_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return recent_days(daily, ["org_id", "org_name", *PLACE], ["order_count"], as_of)


def org_sort_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return recent_days(daily, ["org_id", "org_name", *PLACE], ["sort_count"], as_of)


def shift_finish_nd(finished: DataFrame, organ: DataFrame, region: DataFrame, shift: DataFrame, truck: DataFrame,
                    as_of: Day) -> DataFrame:
    keys = ["shift_id", "line_id", "truck_id", "org_id", "org_name", "driver1_emp_id", "driver1_name",
            "driver2_emp_id", "driver2_name"]
    rows = finished.select(
        "shift_id", "line_id", "truck_id", F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"),
        "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name", "dt",
        F.lit(1).alias("trans_finish_count"), F.col("actual_distance").alias("trans_finish_distance"),
        F.col("finish_dur_sec").alias("trans_finish_dur_sec"), F.col("order_num").alias("trans_finish_order_count"),
        F.col("is_late").alias("trans_finish_delay_count"))
    sums = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec", "trans_finish_order_count",
            "trans_finish_delay_count"]
    out = recent_days(rows, keys, sums, as_of)
    out = lookup(out, organ, {"org_id": "id"}, _level="org_level", _region="region_id")
    out = level_region(out, region, "_region", "_level").drop("province_id", "province_name", "_level", "_region")
    out = lookup(out, shift, {"shift_id": "id"}, line_name="line_name")
    return lookup(out, truck, {"truck_id": "id"}, truck_model_type="truck_model_type",
                  truck_model_type_name="truck_model_type_name")


def dispatch_td(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def bound_finish_td(detail: DataFrame) -> DataFrame:
    orders = _dealt(detail, "order_id", "amount").groupBy("order_id").agg(F.max("amount").alias("amount"))
    return orders.agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


