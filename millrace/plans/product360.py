"""Product 360: latest valid rows, day summaries, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.bands import age_group
from millrace.functions.numbers import money_ratio, ratio
from millrace.operators.dedup import first_per_key, latest_per_key
from millrace.operators.joins import key_flag, lookup
from millrace.operators.topk import rank_in

PRODUCT = ["product_name", "category_id", "category_name"]
# Channel labels of the wide report.
CHANNELS = {"search": "搜索", "recommend": "推荐", "zhituche": "直通车", "activity": "活动"}


def _named(df: DataFrame, product: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return lookup(df, product, {"product_id": "product_id"}, **{c: c for c in (*PRODUCT, *extra)})


def fact_order(orders: DataFrame, product: DataFrame) -> DataFrame:
    done = orders.where(F.col("order_status") == "completed")
    return _named(latest_per_key(done, ["order_id"], ["order_time"]), product, ("brand_id", "brand_name"))


def fact_traffic(log: DataFrame, product: DataFrame) -> DataFrame:
    return _named(latest_per_key(log, ["log_id"], ["visit_time"]), product)


def valid_prices(history: DataFrame) -> DataFrame:
    valid = history.where((F.col("old_price") > 0) & (F.col("new_price") > 0))
    return latest_per_key(valid, ["product_id", "change_time"], ["new_price"])


def fact_price(history: DataFrame, product: DataFrame) -> DataFrame:
    return _named(valid_prices(history), product)


def fact_review(review: DataFrame, product: DataFrame) -> DataFrame:
    valid = review.where(F.col("rating").between(1, 5))
    return _named(latest_per_key(valid, ["review_id"], ["review_time"]), product)


def dim_user(profile: DataFrame) -> DataFrame:
    return latest_per_key(profile.where(F.col("age").between(18, 100)), ["user_id"], ["age"])


def dim_product(product: DataFrame) -> DataFrame:
    cols = ["product_id", "product_name", "category_id", "category_name", "brand_id", "brand_name"]
    return first_per_key(product.select(*cols), ["product_id"], ["product_name"])


def product_day(orders: DataFrame, traffic: DataFrame) -> DataFrame:
    """Sales from orders, uv and pv from traffic; conversion is buyers over visitors."""
    keys = ["dt", "product_id"]
    per_buyer = orders.groupBy(*keys, *PRODUCT, "user_id").agg(
        F.sum("quantity").alias("q"), F.sum("order_amount").alias("a"))
    sales = per_buyer.groupBy(*keys, *PRODUCT).agg(
        F.sum("q").alias("sales_qty"), F.sum("a").alias("gmv"), F.count(F.lit(1)).alias("buyers"))
    per_visitor = traffic.groupBy(*keys, "user_id").agg(F.count(F.lit(1)).alias("n"))
    views = per_visitor.groupBy(*keys).agg(F.count(F.lit(1)).alias("uv"), F.sum("n").alias("pv"))
    out = lookup(sales, views, {"dt": "dt", "product_id": "product_id"}, _uv="uv", _pv="pv")
    out = out.withColumn("uv", F.coalesce("_uv", F.lit(0))).withColumn("pv", F.coalesce("_pv", F.lit(0)))
    rate = F.coalesce(ratio(F.col("buyers"), F.col("uv"), 4), F.lit(0).cast("decimal(20,4)"))
    return out.withColumn("conversion_rate", rate).drop("_uv", "_pv")


def sku_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy("dt", "product_id", "sku_id").agg(
        F.sum("quantity").alias("sales_qty"), F.sum("order_amount").alias("gmv"))


def price_day(prices: DataFrame) -> DataFrame:
    """Prices per product and day; join names afterwards where a report shows them."""
    return prices.groupBy("dt", "product_id").agg(
        ratio(F.sum("new_price"), F.count("new_price"), 2).alias("avg_price"),
        F.min("new_price").alias("min_price"), F.max("new_price").alias("max_price"))


def named_price_day(prices: DataFrame, product: DataFrame) -> DataFrame:
    return _named(price_day(prices), product)


def channel_day(traffic: DataFrame, orders: DataFrame) -> DataFrame:
    """Visitors and views per channel; conversion is the share of visitors who ordered that day."""
    per_user = traffic.groupBy("dt", "product_id", "user_id", *PRODUCT, "channel").agg(F.count(F.lit(1)).alias("n"))
    flagged = key_flag(per_user, orders, ["dt", "product_id", "user_id"], "bought")
    agg = flagged.groupBy("dt", "product_id", *PRODUCT, "channel").agg(
        F.count(F.lit(1)).alias("uv"), F.sum("n").alias("pv"), F.sum("bought").alias("_b"))
    return agg.withColumn("channel_conv_rate", ratio(F.col("_b"), F.col("uv"), 4)).drop("_b")


def review_day(reviews: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    good, bad = F.count(F.when(F.col("rating") >= 4, 1)), F.count(F.when(F.col("rating") <= 2, 1))
    return reviews.groupBy("dt", "product_id", "product_name").agg(
        n.alias("total_reviews"), good.alias("positive_reviews"), bad.alias("negative_reviews"),
        ratio(F.sum("rating"), n, 2).alias("avg_rating"), ratio(good, n, 4).alias("positive_rate"))


def audience_day(orders: DataFrame, users: DataFrame) -> DataFrame:
    buyers = orders.select("dt", "product_id", "product_name", "user_id").distinct()
    out = lookup(buyers, users, {"user_id": "user_id"}, gender="gender", age="age", location="location")
    return out.groupBy("dt", "product_id", "product_name", "gender", age_group(F.col("age")).alias("age_group"),
                       "location").agg(F.count(F.lit(1)).alias("uv"))


def sku_rank(skus: DataFrame) -> DataFrame:
    return rank_in(skus, ["dt", "product_id"], [F.desc("sales_qty")], "rank")


def price_trend(prices: DataFrame) -> DataFrame:
    """Change against the day before and the day 365 days before.

    Both are frames of one day in the product's row of days, so the day summary is computed and moved once and nothing
    is joined; a product has one row per day. Rows with a null day or product have no other day.
    """
    days = prices.select("dt", "product_id", "avg_price", "min_price", "max_price").withColumn("_day", F.unix_date("dt"))
    known = F.col("dt").isNotNull() & F.col("product_id").isNotNull()
    row = Window.partitionBy("product_id").orderBy("_day")
    back = lambda n: F.when(known, F.max("avg_price").over(row.rangeBetween(-n, -n)))
    out = days.withColumns({"_m": back(1), "_y": back(365)})
    now = F.col("avg_price")
    return out.withColumn("yoy_change", money_ratio(now - F.col("_y"), F.col("_y"), 4)).withColumn(
        "mom_change", money_ratio(now - F.col("_m"), F.col("_m"), 4)).drop("_y", "_m", "_day")


def wide_360(days: DataFrame, prices: DataFrame, channels: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per product-day: sales, prices, four channels side by side, reviews."""
    on = {"dt": "dt", "product_id": "product_id"}
    cols = []
    for name, label in CHANNELS.items():
        hit = F.col("channel") == label
        cols += [F.max(F.when(hit, F.col("uv")).otherwise(0)).alias(f"{name}_uv"),
                 F.max(F.when(hit, F.col("channel_conv_rate")).otherwise(0)).alias(f"{name}_conv_rate")]
    pivot = channels.groupBy("dt", "product_id").agg(*cols)
    names = [f"{n}_{k}" for n in CHANNELS for k in ("uv", "conv_rate")]
    out = lookup(days, prices, on, avg_price="avg_price", min_price="min_price", max_price="max_price")
    out = lookup(out, pivot, on, **{n: n for n in names}).fillna(0, names)
    return lookup(out, reviews, on, total_reviews="total_reviews", positive_reviews="positive_reviews",
                  negative_reviews="negative_reviews", avg_rating="avg_rating", positive_rate="positive_rate")


def channel_report(channels: DataFrame) -> DataFrame:
    return channels.select("dt", "product_id", "channel", "uv", "pv", "channel_conv_rate")


def review_report(reviews: DataFrame) -> DataFrame:
    return reviews.select("dt", "product_id", "total_reviews", "positive_reviews", "negative_reviews", "avg_rating", "positive_rate")


def audience_report(audience: DataFrame) -> DataFrame:
    return audience.select("dt", "product_id", "gender", "age_group", "location", "uv")
