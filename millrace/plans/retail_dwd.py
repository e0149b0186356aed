"""Retail detail facts. Date columns are typed; every fact carries its business date ``dt``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import millis_to_date, millis_to_text
from millrace.functions.numbers import or_zero
from millrace.operators.dedup import first_per_key
from millrace.operators.joins import lookup
from millrace.sources.logs import page_fields

PAID, RECEIVED = "1602", "1004"


def cart_add(cart: DataFrame) -> DataFrame:
    return cart.select("id", "user_id", "sku_id", F.to_date("create_time").alias("date_id"),
                       "create_time", "sku_num", "dt")


def cart_full(cart: DataFrame) -> DataFrame:
    return cart.where(F.col("is_ordered") == 0).select("id", "user_id", "sku_id", "sku_num", "dt")


def _promoted_lines(detail: DataFrame, activity: DataFrame, coupon: DataFrame) -> DataFrame:
    """Order lines with activity and coupon ids (both keyed by line id, on the same date)."""
    out = lookup(detail, activity, {"id": "order_detail_id", "dt": "dt"},
                 activity_id="activity_id", activity_rule_id="activity_rule_id")
    return lookup(out, coupon, {"id": "order_detail_id", "dt": "dt"}, coupon_id="coupon_id")


def order_lines(detail: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with buyer and province: the measures of the detail fact without promotion ids."""
    out = lookup(detail, orders, {"order_id": "id"}, user_id="user_id", province_id="province_id")
    return out.withColumns({
        "split_original_amount": (F.col("sku_num") * F.col("order_price")).cast("decimal(16,2)"),
        "split_activity_amount": or_zero(F.col("split_activity_amount")).cast("decimal(16,2)"),
        "split_coupon_amount": or_zero(F.col("split_coupon_amount")).cast("decimal(16,2)")})


def paid_lines(detail: DataFrame, payment: DataFrame) -> DataFrame:
    """Lines of paid orders with the paid amount (no promotion ids, no names)."""
    paid = payment.where(F.col("payment_status") == PAID)
    return lookup(detail.drop("dt"), paid, {"order_id": "order_id"}, "inner", user_id="user_id", dt="dt").withColumn(
        "split_payment_amount", F.col("split_total_amount"))


def order_detail(detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame) -> DataFrame:
    out = order_lines(_promoted_lines(detail, activity, coupon), orders)
    return out.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        F.to_date("create_time").alias("date_id"), "create_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", "split_total_amount", "dt")


def pay_detail_suc(detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame,
                   payment: DataFrame, dic: DataFrame) -> DataFrame:
    """Lines of successfully paid orders on the payment date."""
    paid = payment.where(F.col("payment_status") == PAID)
    names = dic.where(F.col("parent_code") == "11")
    lines = _promoted_lines(detail, activity, coupon).drop("dt")
    out = lookup(lines, paid, {"order_id": "order_id"}, "inner", user_id="user_id", payment_type="payment_type",
                 callback_time="callback_time", dt="dt")
    out = lookup(out, orders, {"order_id": "id"}, province_id="province_id")
    out = lookup(out, names, {"payment_type": "dic_code"}, payment_type_name="dic_name")
    act, cou = or_zero(F.col("split_activity_amount")), or_zero(F.col("split_coupon_amount"))
    return out.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "payment_type", "payment_type_name", F.to_date("callback_time").alias("date_id"), "callback_time", "sku_num",
        (act + cou + F.col("split_total_amount")).alias("split_original_amount"),
        act.alias("split_activity_amount"), cou.alias("split_coupon_amount"),
        F.col("split_total_amount").alias("split_payment_amount"), "dt")


def trade_flow(orders: DataFrame, payment: DataFrame, status_log: DataFrame) -> DataFrame:
    """Accumulating snapshot order -> payment -> receipt; unfinished rows sit in the open partition."""
    paid = payment.where(F.col("payment_status") == PAID)
    received = status_log.where(F.col("order_status") == RECEIVED)
    out = lookup(orders, paid, {"id": "order_id"}, payment_time="callback_time")
    out = lookup(out, received, {"id": "order_id"}, finish_time="create_time")
    total = F.col("total_amount") + F.col("activity_reduce_amount") + F.col("coupon_reduce_amount")
    return out.select(
        F.col("id").alias("order_id"), "user_id", "province_id",
        F.to_date("create_time").alias("order_date_id"), F.col("create_time").alias("order_time"),
        F.to_date("payment_time").alias("payment_date_id"), "payment_time",
        F.to_date("finish_time").alias("finish_date_id"), "finish_time",
        total.alias("order_original_amount"), F.col("activity_reduce_amount").alias("order_activity_amount"),
        F.col("coupon_reduce_amount").alias("order_coupon_amount"),
        F.col("total_amount").alias("order_total_amount"),
        F.when(F.col("payment_time").isNotNull(), F.col("total_amount")).alias("payment_amount"),
        F.coalesce(F.to_date("finish_time"), F.to_date(F.lit("9999-12-31"))).alias("dt"))


def coupon_used(use: DataFrame) -> DataFrame:
    return use.where(F.col("used_time").isNotNull()).select(
        "id", "coupon_id", "user_id", "order_id", F.to_date("used_time").alias("date_id"), "used_time", "dt")


def favor_add(favor: DataFrame) -> DataFrame:
    return favor.where(F.col("is_cancel") == "0").select(
        "id", "user_id", "sku_id", F.to_date("create_time").alias("date_id"), "create_time", "dt")


def page_view(docs: DataFrame) -> DataFrame:
    return (page_fields(docs).withColumn("date_id", millis_to_date(F.col("ts")))
            .withColumn("view_time", millis_to_text(F.col("ts"))))


def sessions(docs: DataFrame) -> DataFrame:
    """First page row of each session of a known user."""
    pages = page_fields(docs).where(F.col("user_id").isNotNull())
    keep = ["session_id", "user_id", "channel", "province_id", "version_code", "mid_id", "brand", "model",
            "operate_system", "ts"]
    return first_per_key(pages.select(*keep), ["session_id"], ["ts"])


def user_login(docs: DataFrame, zone: str = "GMT+8") -> DataFrame:
    first = sessions(docs)
    return (first.withColumn("date_id", millis_to_date(F.col("ts"), zone))
            .withColumn("login_time", millis_to_text(F.col("ts"), zone)))


def user_register(users: DataFrame, docs: DataFrame) -> DataFrame:
    """New users with the device of their first logged page (one row per user)."""
    pages = page_fields(docs).where(F.col("user_id").isNotNull())
    keep = ["channel", "province_id", "version_code", "mid_id", "brand", "model", "operate_system"]
    first = first_per_key(pages.select("user_id", "ts", *keep), ["user_id"], ["ts"])
    out = users.select(F.col("id").alias("uid"), "create_time").withColumn("_u", F.col("uid").cast("string"))
    out = lookup(out, first, {"_u": "user_id"}, **{k: k for k in keep})
    return out.select(F.col("uid").alias("user_id"), F.to_date("create_time").alias("date_id"), "create_time", *keep)
