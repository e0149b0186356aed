"""Retail summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.functions.numbers import or_zero
from millrace.operators.joins import lookup
from millrace.operators.rolling import to_date, wide_days

CATEGORY = ["category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name"]
BRAND = ["tm_id", "tm_name"]
SKU = ["sku_name", *CATEGORY, *BRAND]
PROVINCE = ["province_name", "area_code", "iso_code", "iso_3166_2"]
ORDER_SUMS = {"order_num": "sku_num", "order_original_amount": "split_original_amount",
              "activity_reduce_amount": "split_activity_amount", "coupon_reduce_amount": "split_coupon_amount",
              "order_total_amount": "split_total_amount"}


def _sums(names: dict[str, str], suffix: str):
    return [F.sum(src).alias(f"{name}{suffix}") for name, src in names.items()]


def user_sku_order_1d(detail: DataFrame, sku: DataFrame) -> DataFrame:
    agg = detail.groupBy("dt", "user_id", "sku_id").agg(
        F.count("id").alias("order_count_1d"), *_sums(ORDER_SUMS, "_1d"))
    return lookup(agg, sku, {"sku_id": "id"}, **{c: c for c in SKU})


def user_sku_count_1d(detail: DataFrame, sku: DataFrame, *columns: str) -> DataFrame:
    """Orders per user, sku and day with only the sku columns that a report groups by."""
    agg = detail.groupBy("dt", "user_id", "sku_id").agg(F.count("id").alias("order_count_1d"))
    return lookup(agg, sku, {"sku_id": "id"}, **{c: c for c in columns})


def user_order_1d(detail: DataFrame) -> DataFrame:
    return detail.groupBy("dt", "user_id").agg(F.count("order_id").alias("order_count_1d"), *_sums(ORDER_SUMS, "_1d"))


def user_cart_add_1d(cart_add: DataFrame) -> DataFrame:
    return cart_add.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d"))


def user_payment_1d(paid: DataFrame) -> DataFrame:
    """Order level first, so the distinct count is a plain count."""
    per_order = paid.groupBy("dt", "user_id", "order_id").agg(
        F.sum("sku_num").alias("n"), F.sum("split_payment_amount").alias("a"))
    return per_order.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("payment_count_1d"), F.sum("n").alias("payment_num_1d"),
        F.sum("a").alias("payment_amount_1d"))


def province_order_1d(detail: DataFrame, province: DataFrame) -> DataFrame:
    sums = {k: v for k, v in ORDER_SUMS.items() if k != "order_num"}
    per_order = detail.groupBy("dt", "province_id", "order_id").agg(
        *[F.sum(or_zero(F.col(src))).alias(name) for name, src in sums.items()])
    agg = per_order.groupBy("dt", "province_id").agg(
        F.count("order_id").alias("order_count_1d"), *[F.sum(n).alias(f"{n}_1d") for n in sums])
    return lookup(agg, province, {"province_id": "id"}, **{c: c for c in PROVINCE})


def user_coupon_used_1d(used: DataFrame, coupon: DataFrame) -> DataFrame:
    agg = used.groupBy("dt", "user_id", "coupon_id").agg(F.count(F.lit(1)).alias("used_count_1d"))
    return lookup(agg, coupon, {"coupon_id": "id"}, coupon_name="coupon_name", coupon_type_code="coupon_type",
                  coupon_type_name="coupon_type_name", benefit_rule="benefit_rule")


def sku_favor_add_1d(favor: DataFrame, sku: DataFrame) -> DataFrame:
    agg = favor.groupBy("dt", "sku_id").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    return lookup(agg, sku, {"sku_id": "id"}, **{c: c for c in SKU})


DEVICE = ["mid_id", "brand", "model", "operate_system"]


def session_page_view_1d(pages: DataFrame) -> DataFrame:
    return pages.groupBy(F.col("date_id").alias("dt"), "session_id", *DEVICE, "version_code", "channel").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d"))


def page_visitor_1d(pages: DataFrame) -> DataFrame:
    return pages.groupBy(F.col("date_id").alias("dt"), *DEVICE, "page_id").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d"))


def _wide(daily: DataFrame, names: list[str]) -> dict[str, str]:
    return {n: f"{n}_1d" for n in names}


def user_sku_order_nd(daily: DataFrame, as_of: str | dt.date) -> DataFrame:
    names = ["order_count", *ORDER_SUMS]
    return wide_days(daily, ["user_id", "sku_id", *SKU], _wide(daily, names), as_of)


def province_order_nd(daily: DataFrame, as_of: str | dt.date) -> DataFrame:
    names = ["order_count", *[n for n in ORDER_SUMS if n != "order_num"]]
    return wide_days(daily, ["province_id", *PROVINCE], _wide(daily, names), as_of)


def user_order_td(daily: DataFrame) -> DataFrame:
    names = ["order_count", *ORDER_SUMS]
    return to_date(daily, ["user_id"], {f"{n}_td": f"{n}_1d" for n in names}, "order_date_first", "order_date_last")


def user_login_td(users: DataFrame, logins: DataFrame) -> DataFrame:
    """First date = registration; last date and count from logins, else the registration itself."""
    seen = logins.groupBy("user_id").agg(F.max("date_id").alias("last"), F.count(F.lit(1)).alias("n"))
    out = users.select(F.col("id").cast("string").alias("user_id"), F.to_date("create_time").alias("login_date_first"))
    out = lookup(out, seen, {"user_id": "user_id"}, _last="last", _n="n")
    return out.select("user_id", F.coalesce("_last", "login_date_first").alias("login_date_last"),
                      "login_date_first", F.coalesce("_n", F.lit(1)).alias("login_count_td"))
