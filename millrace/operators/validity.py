"""Validity rules of the ranking-board inputs (work on batch and streaming frames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.numbers import floor_zero
from millrace.functions.text import filled

# Excluded order types, admitted behaviours and sources.
EXCLUDED_TYPES = ["subsidy_managed", "official_bidding"]
VISIT_BEHAVIOURS = ["直播间观看", "短视频观看", "图文浏览", "微详情浏览", "详情页访问"]
VISIT_SOURCES = ["日志采集", "接口同步"]


def _known(*cols: str):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def valid_payments(payments: DataFrame) -> DataFrame:
    """Successful payments of admitted types; presale only when paid at least seven days after the
    deposit. A presale row without deposit time is dropped (unknown is not true)."""
    early = (F.col("order_type") == "presale") & (
        F.col("payment_time") < F.col("deposit_pay_time") + F.expr("INTERVAL 7 DAYS"))
    kept = payments.where((F.col("payment_status") == "success") & ~F.col("order_type").isin(EXCLUDED_TYPES)
                          & ~early & _known("user_id", "goods_id", "shop_id"))
    total = F.col("payment_amount") + F.col("refund_amount") + F.col("freight_amount")
    return kept.withColumn("total_payment_amount", total).withColumn(
        "payment_hour", F.date_format("payment_time", "HH"))


def valid_carts(carts: DataFrame) -> DataFrame:
    kept = carts.where((F.col("cart_status") == "normal") & _known("user_id", "goods_id", "shop_id"))
    return kept.withColumn("cart_quantity", floor_zero(F.col("cart_quantity"))).withColumn(
        "cart_hour", F.date_format("cart_time", "HH"))


def valid_visits(visits: DataFrame) -> DataFrame:
    return visits.where(filled(F.col("user_id")) & filled(F.col("shop_id")) & F.col("visit_time").isNotNull()
                        & filled(F.col("dt")) & F.col("visit_behavior").isin(VISIT_BEHAVIOURS)
                        & F.col("data_source").isin(VISIT_SOURCES))
