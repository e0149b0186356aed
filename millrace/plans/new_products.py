"""New products: cleaned detail, summaries, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.bands import sales_tier
from millrace.functions.numbers import or_zero
from millrace.operators.dedup import distinct_rows
from millrace.operators.joins import lookup

INFO = ["product_id", "product_name", "product_image", "product_sku", "category_name", "release_date"]


def info_detail(product: DataFrame) -> DataFrame:
    return distinct_rows(product.where(F.col("product_id").isNotNull()).select(*INFO))


def sales_detail(sales: DataFrame) -> DataFrame:
    """Reduced per order first, so distinct orders are a plain count."""
    keys = ["product_id", "sales_date"]
    per_order = sales.where(F.col("product_id").isNotNull()).groupBy(*keys, "order_id").agg(
        F.sum("sales_amount").alias("a"), F.sum("sales_count").alias("n"), F.max("update_time").alias("t"))
    return per_order.groupBy(*keys).agg(
        F.sum("a").alias("total_sales"), F.sum("n").alias("total_sales_count"),
        F.count("order_id").alias("total_orders"), F.max("t").alias("last_update_time"))


def monitoring_detail(sales: DataFrame, product: DataFrame) -> DataFrame:
    agg = sales.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("sales_amount").alias("total_sales"), F.sum("sales_count").alias("total_sales_count"),
        F.min("sales_date").alias("first_sale_date"), F.max("sales_date").alias("last_sale_date"),
        F.max("update_time").alias("last_update_time"))
    return lookup(agg, product, {"product_id": "product_id"}, product_name="product_name")


def behaviour_detail(behaviour: DataFrame) -> DataFrame:
    return behaviour.where(F.col("user_id").isNotNull()).groupBy("user_id", "product_id", "behavior_type").agg(
        F.count(F.lit(1)).alias("total_behavior_count"), F.min("action_time").alias("first_action_time"),
        F.max("action_time").alias("last_action_time"))


def stock_detail(stock: DataFrame) -> DataFrame:
    agg = stock.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("stock_count").alias("total_stock"), F.max("update_time").alias("last_update_time"))
    return agg.withColumn("stock_status", F.when(F.col("total_stock") > 0, "available").otherwise("out_of_stock"))


def sales_summary(daily: DataFrame) -> DataFrame:
    return daily.groupBy("product_id").agg(
        F.sum("total_sales").alias("total_sales"), F.sum("total_sales_count").alias("total_sales_count"),
        F.sum("total_orders").alias("total_orders"), F.max("last_update_time").alias("last_update_time"),
        F.min("sales_date").alias("first_sale_date"), F.max("sales_date").alias("last_sale_date"))


def info_summary(info: DataFrame, sales: DataFrame) -> DataFrame:
    out = lookup(info, sales, {"product_id": "product_id"}, _s="total_sales", _n="total_sales_count", _f="first_sale_date", _l="last_sale_date")
    return out.select(
        *INFO, sales_tier(F.col("_s")).alias("sales_category"), or_zero(F.col("_s")).alias("total_sales"),
        or_zero(F.col("_n")).alias("total_sales_count"), F.coalesce("_f", "release_date").alias("first_sale_date"),
        F.coalesce("_l", "release_date").alias("last_sale_date"))


def info_report(info: DataFrame, stock: DataFrame) -> DataFrame:
    return lookup(info, stock, {"product_id": "product_id"}, stock_status="stock_status")


def sales_report(sales: DataFrame) -> DataFrame:
    """The trend label is constant: the source holds no series to judge it by."""
    return sales.select("product_id", "total_sales", "total_sales_count", "total_orders", F.lit("Stable").alias("sales_trend"))


def behaviour_report(behaviour: DataFrame) -> DataFrame:
    return behaviour.select("user_id", "product_id", "total_behavior_count", "first_action_time", "last_action_time", "behavior_type")


def stock_report(stock: DataFrame) -> DataFrame:
    return stock.select("product_id", "total_stock", "stock_status")
