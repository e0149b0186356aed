"""Price strength, sales and traffic conversion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import as_date, in_last
from millrace.functions.numbers import ratio, within_or
from millrace.functions.text import percent_value
from millrace.operators.joins import lookup
from millrace.operators.ordered import global_rank
from millrace.operators.topk import top_k

Day = str | dt.date


def product_detail(product: DataFrame) -> DataFrame:
    """Stars outside 1..5, or missing, become 3."""
    return product.where(F.col("product_id").isNotNull()).withColumn(
        "price_strength_star", within_or(F.col("price_strength_star"), 1, 5, 3))


def order_detail(trade: DataFrame) -> DataFrame:
    return trade.where(F.col("pay_time").isNotNull()).withColumn("dt", F.to_date("pay_time"))


def traffic_detail(traffic: DataFrame) -> DataFrame:
    return traffic.where(F.col("visitor_count") > 0).withColumn("dt", F.to_date("visit_time"))


def inventory_detail(inventory: DataFrame, as_of: Day) -> DataFrame:
    return inventory.where(F.to_date("update_time") == F.lit(as_date(as_of))).withColumn("dt", F.lit(as_date(as_of)))


def sales_7d(orders: DataFrame, product: DataFrame, as_of: Day) -> DataFrame:
    agg = orders.where(in_last(F.col("dt"), as_of, 7)).groupBy("product_id").agg(
        F.sum("pay_amount").alias("total_sales"), F.sum("pay_quantity").alias("total_quantity"),
        F.sum("buyer_count").alias("total_buyer_count"))
    out = lookup(agg, product, {"product_id": "product_id"}, "inner", category_id="category_id")
    return out.withColumn("stat_period", F.lit("7d")).withColumn("dt", F.lit(as_date(as_of)))


def traffic_conversion(traffic: DataFrame, orders: DataFrame, as_of: Day) -> DataFrame:
    """Visitors per product, source and word; buyers of the product come from a reduced side."""
    day = F.lit(as_date(as_of))
    visits = traffic.where(F.col("dt") == day).groupBy(
        "product_id", "source", F.coalesce("search_word", F.lit("")).alias("search_word")).agg(
        F.sum("visitor_count").alias("total_visitor"))
    buyers = orders.where(F.col("dt") == day).groupBy("product_id").agg(F.sum("buyer_count").alias("b"))
    out = lookup(visits, buyers, {"product_id": "product_id"}, _b="b")
    rate = F.when(F.col("total_visitor") == 0, F.lit(0).cast("decimal(20,2)")).otherwise(
        ratio(F.col("_b") * 100, F.col("total_visitor"), 2))
    return out.withColumn("pay_conversion_rate", F.concat(rate.cast("string"), F.lit("%"))).drop("_b").withColumn("dt", day)


def price_strength(product: DataFrame, conversion: DataFrame, as_of: Day) -> DataFrame:
    """Price warning at two stars or less; product warning below five percent conversion."""
    best = conversion.groupBy("product_id").agg(F.max(percent_value(F.col("pay_conversion_rate"))).alias("rate"))
    stars = product.groupBy("product_id").agg(F.max("price_strength_star").alias("price_strength_star"))
    out = lookup(stars, best, {"product_id": "product_id"}, _rate="rate")
    return out.select("product_id", "price_strength_star",
                      F.when(F.col("price_strength_star") <= 2, 1).otherwise(0).alias("is_price_warn"),
                      F.when(F.col("_rate") < 5, 1).otherwise(0).alias("is_product_warn"),
                      F.lit(as_date(as_of)).alias("dt"))


def product_ranking(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Running position by sales, then quantity; both rank columns carry that position."""
    named = lookup(sales, product, {"product_id": "product_id"}, "inner", product_name="product_name")
    out = global_rank(named, [F.desc("total_sales"), F.desc("total_quantity"), F.asc("product_id")], "sales_rank")
    return out.withColumn("quantity_rank", F.col("sales_rank"))


def source_top10(conversion: DataFrame, k: int = 10) -> DataFrame:
    """Sources by visitors with the mean of the percent texts."""
    rate = percent_value(F.col("pay_conversion_rate"))
    agg = conversion.groupBy("source").agg(
        F.sum("total_visitor").alias("total_visitor"), F.sum(rate).alias("_s"), F.count(rate).alias("_n"))
    top = top_k(agg, [F.desc("total_visitor"), F.asc("source")], k, "rank_num")
    text = F.concat(ratio(F.col("_s"), F.col("_n"), 2).cast("string"), F.lit("%"))
    return top.select("source", "total_visitor", text.alias("pay_conversion_rate"), "rank_num")


def warnings(strength: DataFrame) -> DataFrame:
    """Price warnings and product warnings under each other."""
    def part(flag: str, text: str) -> DataFrame:
        return strength.where(F.col(flag) == 1).select(
            "product_id", F.lit(text).alias("warn_type"), "price_strength_star", "dt")

    return part("is_price_warn", "价格力预警").unionByName(part("is_product_warn", "商品力预警"))
