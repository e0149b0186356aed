"""Product event analysis: cleaned events, day summaries, day / week / month reports."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.dates import month_key, since, week_start
from millrace.functions.numbers import or_zero, ratio
from millrace.operators.joins import lookup

Day = str | dt.date
NAMES = ["product_name", "category_id", "category_name"]


def _named(events: DataFrame, product: DataFrame) -> DataFrame:
    return lookup(events, product, {"product_id": "product_id"}, "inner", **{c: c for c in NAMES})


def events_detail(events: DataFrame, product: DataFrame, time: str, as_of: Day, days: int = 30) -> DataFrame:
    """Events of known products in the last ``days`` days, with product names."""
    return _named(events.where(since(F.to_date(time), as_of, days)), product)


def visit_detail(visits: DataFrame, product: DataFrame, as_of: Day) -> DataFrame:
    return events_detail(visits.where(F.col("stay_seconds") > 0), product, "visit_time", as_of)


def payment_detail(payments: DataFrame, orders: DataFrame, product: DataFrame, as_of: Day) -> DataFrame:
    """Positive payments of known orders, paid at or after the order time."""
    kept = payments.where(F.col("pay_amount") > 0)
    timed = lookup(kept, orders, {"order_id": "order_id"}, "inner", order_time="order_time")
    timed = timed.where(F.col("pay_time") >= F.col("order_time")).drop("order_time")
    return events_detail(timed, product, "pay_time", as_of)


def _user_day_product(visits: DataFrame, favs: DataFrame, carts: DataFrame, orders: DataFrame, pays: DataFrame,
                      refunds: DataFrame) -> DataFrame:
    """One row per (day, user, product) with the measures of all six event tables.

    The tables are stacked as measure rows and reduced by one aggregate (partial sums before the
    single shuffle): no join between event tables, so measures cannot multiply. Rows without a
    visit that day are left out.
    """
    def side(df: DataFrame, time: str, **measures: Column) -> DataFrame:
        return df.select(F.to_date(time).alias("summary_date"), "user_id", "product_id",
                         *[m.cast("decimal(16,2)" if n in money else "bigint").alias(n) for n, m in measures.items()])

    money = {"order_amount", "pay_amount", "juhua", "refund_amount"}
    one = F.lit(1)
    sides = [
        side(visits, "visit_time", pv=one, stay=F.col("stay_seconds"), bounce=F.when(F.col("stay_seconds") <= 3, 1).otherwise(0),
             micro=F.when(F.col("is_micro_detail") == 1, 1)),
        side(favs, "fav_time", fav=one),
        side(carts, "cart_time", cart=one, cart_qty=F.col("quantity")),
        side(orders, "order_time", orders=one, order_qty=F.col("quantity"), order_amount=F.col("order_amount")),
        side(pays, "pay_time", pays=one, pay_qty=F.when(F.col("pay_amount") > 0, 1).otherwise(0), pay_amount=F.col("pay_amount"),
             juhua=F.when(F.col("activity_type") == "JUHUASUAN", F.col("pay_amount"))),
        side(refunds, "refund_time", refund_amount=F.col("refund_amount")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    keys = ["summary_date", "user_id", "product_id"]
    merged = stacked.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in stacked.columns if c not in keys])
    return merged.where(F.col("pv") > 0)


def _users(flag: str) -> Column:
    return F.count(F.when(F.col(flag) > 0, 1))


def product_day(visits, favs, carts, orders, pays, refunds, product: DataFrame) -> DataFrame:
    rows = _user_day_product(visits, favs, carts, orders, pays, refunds)
    agg = rows.groupBy("summary_date", "product_id").agg(
        F.count(F.lit(1)).alias("uv"), F.sum("pv").alias("pv"), F.sum("stay").alias("_stay"), F.sum("bounce").alias("_bounce"),
        _users("micro").alias("micro_detail_uv"), _users("fav").alias("fav_users"), _users("cart").alias("cart_users"),
        F.sum("cart_qty").alias("cart_qty"), _users("orders").alias("order_users"), F.sum("order_qty").alias("order_qty"),
        F.sum("order_amount").alias("order_amount"), _users("pays").alias("pay_users"),
        or_zero(F.sum("pay_qty")).alias("pay_qty"), F.sum("pay_amount").alias("pay_amount"),
        or_zero(F.sum("juhua")).alias("juhuasuan_pay_amount"), F.sum("refund_amount").alias("refund_amount"))
    out = agg.withColumns({
        "avg_stay_seconds": ratio(F.col("_stay"), F.col("pv"), 2),
        "bounce_rate": ratio(F.col("_bounce"), F.col("pv"), 4),
        "active_products": F.when(F.col("pay_amount") > 0, 1).otherwise(0),
        "item_unit_price": ratio(F.col("pay_amount"), F.col("order_qty"), 2)}).drop("_stay", "_bounce")
    return _named(out, product)


def user_day(visits, favs, carts, orders, pays, refunds) -> DataFrame:
    rows = _user_day_product(visits, favs, carts, orders, pays, refunds)
    return rows.groupBy("summary_date", "user_id").agg(
        F.count(F.lit(1)).alias("visit_products"), F.sum("pv").alias("pv"), _users("fav").alias("fav_count"),
        _users("cart").alias("cart_count"), _users("orders").alias("order_count"), _users("pays").alias("pay_count"),
        or_zero(F.sum("pay_amount")).alias("total_pay_amount"), or_zero(F.sum("refund_amount")).alias("total_refund_amount"))


def _order_money(orders: DataFrame, pays: DataFrame, refunds: DataFrame) -> DataFrame:
    """One row per order with its paid and refunded totals."""
    paid = pays.groupBy("order_id").agg(F.sum("pay_amount").alias("pay_amount"), F.max("user_id").alias("pay_user_id"))
    back = refunds.groupBy("order_id").agg(F.sum("refund_amount").alias("refund_amount"))
    out = lookup(orders, paid, {"order_id": "order_id"}, pay_amount="pay_amount", pay_user_id="pay_user_id")
    out = lookup(out, back, {"order_id": "order_id"}, refund_amount="refund_amount")
    return out.withColumn("summary_date", F.to_date("order_time"))


def activity_day(orders, pays, refunds) -> DataFrame:
    keys = ["summary_date", "activity_type"]
    per_user = _order_money(orders, pays, refunds).groupBy(*keys, "user_id").agg(
        F.sum("order_amount").alias("o"), F.sum("pay_amount").alias("p"), F.sum("refund_amount").alias("r"))
    return per_user.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("uv"), F.sum("o").alias("total_order_amount"),
        or_zero(F.sum("p")).alias("total_pay_amount"), or_zero(F.sum("r")).alias("total_refund_amount"))


def trade_day(orders, pays, refunds) -> DataFrame:
    """Reduced per (day, user) first: distinct users and payers become plain counts."""
    per_user = _order_money(orders, pays, refunds).groupBy("summary_date", "user_id").agg(
        F.count("order_id").alias("n"), F.max("pay_user_id").alias("payer"), F.sum("order_amount").alias("o"),
        F.sum("pay_amount").alias("p"), F.sum("refund_amount").alias("r"))
    return per_user.groupBy("summary_date").agg(
        F.count(F.lit(1)).alias("uv"), F.sum("n").alias("order_count"), F.sum("o").alias("total_order_amount"),
        F.count("payer").alias("pay_user_count"), F.sum("p").alias("total_pay_amount"),
        F.sum("r").alias("total_refund_amount"))


PRODUCT_SUMS = ["uv", "pv", "fav_users", "cart_users", "order_users", "pay_users", "pay_amount", "refund_amount"]
TRADE_SUMS = ["uv", "order_count", "total_order_amount", "pay_user_count", "total_pay_amount", "total_refund_amount"]
PERIODS = {"week": week_start, "month": month_key}


def _period(daily: DataFrame, period: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    out = daily.groupBy(PERIODS[period](F.col("summary_date")).alias("period"), *keys).agg(
        F.min("summary_date").alias("first_date"), *aggs)
    if period == "week":
        return out.withColumnRenamed("first_date", "week_start")
    return out.withColumn("month_key", F.col("period")).drop("first_date")


def product_report(daily: DataFrame, visits: DataFrame, period: str) -> DataFrame:
    """Week or month report: daily uv summed, plus ``uv_distinct`` counted from the visits."""
    keys = ["product_id", *NAMES]
    n = F.count(F.lit(1))
    out = _period(daily, period, keys, [
        *[F.sum(c).alias(c) for c in PRODUCT_SUMS],
        ratio(F.sum("avg_stay_seconds"), n, 2).alias("avg_stay_seconds"), ratio(F.sum("bounce_rate"), n, 4).alias("bounce_rate")])
    seen = visits.select(PERIODS[period](F.to_date("visit_time")).alias("period"), "product_id", "user_id").distinct()
    exact = seen.groupBy("period", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return lookup(out, exact, {"period": "period", "product_id": "product_id"}, uv_distinct="n").drop("period")


def trade_report(daily: DataFrame, orders: DataFrame, period: str) -> DataFrame:
    out = _period(daily, period, [], [F.sum(c).alias(c) for c in TRADE_SUMS])
    seen = orders.select(PERIODS[period](F.to_date("order_time")).alias("period"), "user_id").distinct()
    exact = seen.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    return lookup(out, exact, {"period": "period"}, uv_distinct="n").drop("period")
