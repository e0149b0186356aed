"""Ranking boards: top goods per shop."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.topk import top_per_group

TOP = 50


def _board(agg: DataFrame, measure: str, k: int) -> DataFrame:
    return top_per_group(agg, ["shop_id"], [F.desc(measure), F.asc("goods_id")], k, "rk", ties=False)


def cart_board(carts: DataFrame, k: int = TOP) -> DataFrame:
    agg = carts.groupBy("shop_id", "goods_id").agg(F.sum("cart_quantity").alias("cart_quantity"))
    return _board(agg, "cart_quantity", k)


def visitor_board(visits: DataFrame, k: int = TOP) -> DataFrame:
    pairs = visits.where(F.col("goods_id").isNotNull()).select("shop_id", "goods_id", "user_id").distinct()
    return _board(pairs.groupBy("shop_id", "goods_id").agg(F.count(F.lit(1)).alias("visitors")), "visitors", k)


def payment_board(payments: DataFrame, k: int = TOP) -> DataFrame:
    agg = payments.groupBy("shop_id", "goods_id").agg(F.sum("total_payment_amount").alias("paid_amount"))
    return _board(agg, "paid_amount", k)
