"""Logistics detail facts.

The cargo facts share one shape and differ by the waybill statuses they admit, so they are one
parameterised function. Where the admitted set is not spelled out for a stage (cancelled,
arrived, delivered, signed) it is the set of statuses that have reached the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import OPEN_DATE, millis_to_date, millis_to_text, repair_iso_text
from millrace.functions.text import masked_name
from millrace.operators.joins import lookup, role_names

# Waybill status codes in order.
UNPAID, PAID, COLLECTED, AT_STATION, DISPATCHED = "60010", "60020", "60030", "60040", "60050"
IN_TRANSIT, DELIVERED, SIGNED, CANCELLED = "60060", "60070", "60080", "60999"

# stage -> (excluded statuses, or None for all; admitted statuses, or None)
STAGES: dict[str, tuple[list[str], list[str]]] = {
    "order": ([], []),
    "pay_suc": ([UNPAID, CANCELLED], []),
    "cancel": ([], [CANCELLED]),
    "receive": ([UNPAID, PAID, CANCELLED], []),
    "dispatch": ([UNPAID, PAID, COLLECTED, AT_STATION, CANCELLED], []),
    "bound_finish": ([], [IN_TRANSIT, DELIVERED, SIGNED]),
    "deliver_suc": ([], [DELIVERED, SIGNED]),
    "sign": ([], [SIGNED]),
}

ORDER_COLUMNS = [
    "order_no", "status", "collect_type", "payment_type", "user_id", "receiver_complex_id", "receiver_province_id",
    "receiver_city_id", "receiver_district_id", "receiver_name", "sender_complex_id", "sender_province_id",
    "sender_city_id", "sender_district_id", "sender_name", "cargo_num", "amount", "estimate_arrive_time", "distance",
    "update_date"]


def _cargo(cargo: DataFrame) -> DataFrame:
    live = cargo.where(F.col("is_deleted") == "0")
    return live.withColumn("order_time", repair_iso_text(F.col("create_time"))).drop("create_time", "is_deleted")


def _orders(orders: DataFrame) -> DataFrame:
    return (orders.where(F.col("is_deleted") == "0")
            .withColumn("receiver_name", masked_name(F.col("receiver_name")))
            .withColumn("sender_name", masked_name(F.col("sender_name")))
            .withColumn("estimate_arrive_time", millis_to_text(F.col("estimate_arrive_time"))))


def _named(facts: DataFrame, dic: DataFrame) -> DataFrame:
    return role_names(facts, dic, {"cargo_type": "cargo_type_name", "status": "status_name",
                                   "collect_type": "collect_type_name", "payment_type": "payment_type_name"})


def stage_rows(cargo: DataFrame, orders: DataFrame, stage: str) -> DataFrame:
    """Cargo rows of the waybills that have reached ``stage``, without dictionary names.

    Summaries start here: names they need are joined after the rows are reduced. The partition
    date is the order date, i.e. the raw partition, so date filters reach the scan.
    """
    excluded, admitted = STAGES[stage]
    info = _orders(orders)
    if excluded:
        info = info.where(~F.col("status").isin(excluded))
    if admitted:
        info = info.where(F.col("status").isin(admitted))
    how = "inner" if excluded or admitted else "left"
    return lookup(_cargo(cargo), info, {"order_id": "id"}, how, **{c: c for c in ORDER_COLUMNS})


def waybill_stage(cargo: DataFrame, orders: DataFrame, dic: DataFrame, stage: str) -> DataFrame:
    """The named detail fact of one stage."""
    return _named(stage_rows(cargo, orders, stage), dic)


def order_process(cargo: DataFrame, orders: DataFrame, dic: DataFrame) -> DataFrame:
    """Accumulating snapshot: signed and cancelled waybills end on their update date, others stay open."""
    out = lookup(_cargo(cargo), _orders(orders), {"order_id": "id"}, "left", **{c: c for c in ORDER_COLUMNS})
    closed = F.col("status").isin(SIGNED, CANCELLED)
    return (_named(out, dic).withColumn("start_date", F.col("dt"))
            .withColumn("end_date", F.when(closed, F.col("update_date")).otherwise(F.lit(OPEN_DATE)))
            .withColumn("dt", F.col("end_date")))


def trans_finish(tasks: DataFrame, shift: DataFrame) -> DataFrame:
    """Finished transport tasks; the planned end is the real start plus the shift's planned duration."""
    done = tasks.where((F.col("is_deleted") == "0") & F.col("actual_end_time").isNotNull())
    out = lookup(done, shift, {"shift_id": "id"}, estimated_time="estimated_time")
    dur = ((F.col("actual_end_time") - F.col("actual_start_time")) / 1000).cast("bigint")
    planned = F.col("actual_start_time") + F.col("estimated_time") * 1000
    return out.select(
        "id", "shift_id", "line_id", "start_org_id", "start_org_name", "end_org_id", "end_org_name", "order_num",
        "driver1_emp_id", masked_name(F.col("driver1_name")).alias("driver1_name"), "driver2_emp_id",
        masked_name(F.col("driver2_name")).alias("driver2_name"), "truck_id", F.md5("truck_no").alias("truck_no"),
        millis_to_text(F.col("actual_start_time")).alias("actual_start_time"),
        millis_to_text(F.col("actual_end_time")).alias("actual_end_time"),
        millis_to_text(planned).alias("estimate_end_time"), "actual_distance", dur.alias("finish_dur_sec"),
        F.when(F.col("actual_end_time") > planned, 1).otherwise(0).alias("is_late"),
        millis_to_date(F.col("actual_end_time")).alias("dt"))


def bound_events(bounds: DataFrame, kind: str) -> DataFrame:
    """``inbound``, ``sort`` or ``outbound`` records that carry their time."""
    time = f"{kind}_time"
    emp = {"inbound": "inbound_emp_id", "sort": "sorter_emp_id", "outbound": "outbound_emp_id"}[kind]
    return bounds.where(F.col(time).isNotNull()).select(
        "id", "order_id", "org_id", millis_to_text(F.col(time)).alias(time), emp, millis_to_date(F.col(time)).alias("dt"))
