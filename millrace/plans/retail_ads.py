"""Retail reports. Each takes the summaries it needs and a business date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.dates import as_date, back, in_last, seconds_between, window_start
from millrace.functions.numbers import ratio
from millrace.operators.joins import lookup, side_by_side
from millrace.operators.ordered import with_neighbours
from millrace.operators.rolling import DAYS, counts_by_last_seen, recent_days
from millrace.operators.topk import top_per_group
from millrace.plans.retail_dws import BRAND, CATEGORY, PROVINCE

Day = str | dt.date


def _stamp(df: DataFrame, as_of: Day, *cols: str) -> DataFrame:
    return df.select(F.lit(as_date(as_of)).alias("dt"), *cols)


def traffic_by_channel(sessions: DataFrame, as_of: Day) -> DataFrame:
    """Visitors, mean stay, mean pages, sessions and bounce rate per channel for 1/7/30 days.

    Visitors are distinct devices: reduced to the newest date per (channel, device) first, then
    counted per N, so no row is fanned out before the shuffle.
    """
    visitors = (sessions.where(in_last(F.col("dt"), as_of, max(DAYS)))
                .groupBy("channel", "mid_id").agg(F.max("dt").alias("last")))
    uv = counts_by_last_seen(visitors, ["channel"], as_of, "last", {"uv_count": None})
    marked = sessions.withColumn("_one", F.lit(1)).withColumn(
        "_bounce", F.when(F.col("page_count_1d") == 1, 1).otherwise(0))
    sums = recent_days(marked, ["channel"], ["during_time_1d", "page_count_1d", "_one", "_bounce"], as_of, DAYS)
    out = uv.join(sums, ["channel", "recent_days"])
    return out.select(
        "dt", "recent_days", "channel", "uv_count",
        F.floor(F.col("during_time_1d") / F.col("_one") / 1000).cast("bigint").alias("avg_duration_sec"),
        F.floor(F.col("page_count_1d") / F.col("_one")).cast("bigint").alias("avg_page_count"),
        F.col("_one").alias("sv_count"), ratio(F.col("_bounce"), F.col("_one"), 2).alias("bounce_rate"))


def page_path(pages: DataFrame, as_of: Day | None) -> DataFrame:
    """Step-numbered page transitions per session; safe for a session that holds a large share of rows."""
    views = pages if as_of is None else pages.where(F.col("date_id") == F.lit(as_date(as_of)))
    steps = with_neighbours(views.select("session_id", "page_id", F.timestamp_millis("ts").alias("at")),
                            ["session_id"], "at", ["page_id"], ["page_id"])
    named = steps.select(
        F.concat(F.lit("step-"), F.col("row_no"), F.lit(":"), F.col("page_id")).alias("source"),
        F.concat(F.lit("step-"), F.col("row_no") + 1, F.lit(":"), F.col("next")["page_id"]).alias("target"))
    return named.groupBy("source", F.coalesce("target", F.lit("null")).alias("target")).agg(
        F.count(F.lit(1)).alias("path_count"))


def user_change(today: DataFrame, yesterday: DataFrame, as_of: Day) -> DataFrame:
    """Churned users (last login seven days ago) and won-back users (gap of eight days or more)."""
    day = as_date(as_of)
    churn = today.where(F.col("login_date_last") == F.lit(back(day, 7))).agg(F.count(F.lit(1)))
    before = yesterday.select("user_id", F.col("login_date_last").alias("previous"))
    again = (today.where(F.col("login_date_last") == F.lit(day)).join(before, "user_id")
             .where(F.datediff("login_date_last", "previous") >= 8).agg(F.count(F.lit(1))))
    return _stamp(side_by_side({"user_churn_count": churn, "user_back_count": again}), as_of,
                  "user_churn_count", "user_back_count")


def user_retention(login_td: DataFrame, as_of: Day) -> DataFrame:
    day = F.lit(as_date(as_of))
    cohort = login_td.where((F.col("login_date_first") >= F.lit(back(as_of, 7))) & (F.col("login_date_first") < day))
    agg = cohort.groupBy(F.col("login_date_first").alias("create_date")).agg(
        F.count(F.when(F.col("login_date_last") == day, 1)).alias("retention_count"),
        F.count(F.lit(1)).alias("new_user_count"))
    return agg.select(day.alias("dt"), "create_date", F.datediff(day, F.col("create_date")).alias("retention_day"),
                      "retention_count", "new_user_count",
                      ratio(F.col("retention_count") * 100, F.col("new_user_count"), 2).alias("retention_rate"))


def user_stats(login_td: DataFrame, as_of: Day) -> DataFrame:
    return counts_by_last_seen(login_td, [], as_of, "login_date_last",
                               {"new_user_count": F.col("login_date_first"), "active_user_count": None})


def user_action(page_visitors: DataFrame, carts: DataFrame, orders: DataFrame, payments: DataFrame,
                as_of: Day) -> DataFrame:
    """Funnel home -> detail -> cart -> order -> payment of one day."""
    def day(df: DataFrame) -> DataFrame:
        return df.where(F.col("dt") == F.lit(as_date(as_of)))

    views = day(page_visitors)
    counts = {
        "home_count": views.where(F.col("page_id") == "home"),
        "good_detail_count": views.where(F.col("page_id") == "good_detail"),
        "cart_count": day(carts), "order_count": day(orders), "payment_count": day(payments),
    }
    wide = side_by_side({k: v.agg(F.count(F.lit(1))) for k, v in counts.items()})
    return _stamp(wide, as_of, *counts)


def new_order_users(order_td: DataFrame, as_of: Day) -> DataFrame:
    return counts_by_last_seen(order_td, [], as_of, "order_date_first", {"new_order_user_count": None})


def streak_buyers(user_days: DataFrame, as_of: Day, days: int = 7, streak: int = 3) -> DataFrame:
    """Users with ``streak`` order days in a row among the last ``days`` days.

    Input has one row per user and day, so a window partition holds at most ``days`` rows.
    """
    scope = user_days.where(in_last(F.col("dt"), as_of, days)).select("user_id", "dt").distinct()
    w = Window.partitionBy("user_id").orderBy("dt")
    gap = F.datediff(F.lead("dt", streak - 1).over(w), F.col("dt"))
    users = scope.withColumn("gap", gap).where(F.col("gap") == streak - 1).select("user_id").distinct()
    return users.agg(F.count(F.lit(1)).alias("order_continuously_user_count")).select(
        F.lit(as_date(as_of)).alias("dt"), F.lit(days).alias("recent_days"), "order_continuously_user_count")


def repeat_purchase(user_sku_daily: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    """Share of a brand's buyers with two orders or more (counted per user first)."""
    scope = user_sku_daily.where(in_last(F.col("dt"), as_of, days))
    per_user = scope.groupBy(*BRAND, "user_id").agg(F.sum("order_count_1d").alias("n"))
    agg = per_user.groupBy(*BRAND).agg(F.count(F.when(F.col("n") >= 2, 1)).alias("again"),
                                       F.count(F.when(F.col("n") >= 1, 1)).alias("any"))
    return agg.select(F.lit(as_date(as_of)).alias("dt"), F.lit(days).alias("recent_days"), *BRAND,
                      ratio(F.col("again"), F.col("any"), 2).alias("order_repeat_rate"))


def _order_stats(user_sku_daily: DataFrame, keys: list[str], as_of: Day) -> DataFrame:
    """Orders and distinct buyers per key for 1/7/30 days in one pass.

    One row per (key, user) with a count per N is the only shuffle of detail size; the distinct
    buyer count is then a count of non-zero rows.
    """
    scope = user_sku_daily.where(in_last(F.col("dt"), as_of, max(DAYS)))
    per_user = scope.groupBy(*keys, "user_id").agg(*[
        F.coalesce(F.sum(F.when(F.col("dt") >= F.lit(window_start(as_of, n)), F.col("order_count_1d"))),
                   F.lit(0)).alias(f"n{n}") for n in DAYS])
    agg = per_user.groupBy(*keys).agg(
        *[F.sum(f"n{n}").alias(f"o{n}") for n in DAYS],
        *[F.count(F.when(F.col(f"n{n}") > 0, 1)).alias(f"u{n}") for n in DAYS])
    rows = F.array(*[F.struct(F.lit(n).alias("recent_days"), F.col(f"o{n}").alias("order_count"),
                              F.col(f"u{n}").alias("order_user_count")) for n in DAYS])
    return (agg.select(*keys, F.explode(rows).alias("r")).where(F.col("r.order_count") > 0)
            .select(F.lit(as_date(as_of)).alias("dt"), "r.recent_days", *keys, "r.order_count", "r.order_user_count"))


def order_stats_by_brand(user_sku_daily: DataFrame, trademark: DataFrame, as_of: Day) -> DataFrame:
    """Reduced by brand id; the names meet the finished rows."""
    return lookup(_order_stats(user_sku_daily, ["tm_id"], as_of), trademark, {"tm_id": "id"}, tm_name="tm_name")


def order_stats_by_category(user_sku_daily: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame, as_of: Day) -> DataFrame:
    """Reduced by the lowest category; the levels above and all names meet the finished rows."""
    out = _order_stats(user_sku_daily, ["category3_id"], as_of)
    out = lookup(out, c3, {"category3_id": "id"}, category3_name="name", category2_id="category2_id")
    out = lookup(out, c2, {"category2_id": "id"}, category2_name="name", category1_id="category1_id")
    return lookup(out, c1, {"category1_id": "id"}, category1_name="name")


def cart_top3_by_category(cart_full: DataFrame, sku: DataFrame, as_of: Day, k: int = 3) -> DataFrame:
    per_sku = cart_full.groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    named = lookup(per_sku, sku, {"sku_id": "id"}, sku_name="sku_name", **{c: c for c in CATEGORY})
    top = top_per_group(named, ["category1_id", "category2_id", "category3_id"], [F.desc("cart_num")], k)
    return _stamp(top, as_of, *CATEGORY, "sku_id", "sku_name", "cart_num", "rk")


def favor_top3_by_brand(favor_daily: DataFrame, as_of: Day, k: int = 3) -> DataFrame:
    scope = favor_daily.where(F.col("dt") == F.lit(as_date(as_of)))
    top = top_per_group(scope, ["tm_id"], [F.desc("favor_add_count_1d")], k)
    return _stamp(top, as_of, *BRAND, "sku_id", "sku_name", F.col("favor_add_count_1d").alias("favor_count"), "rk")


def order_to_pay_interval(flow: DataFrame, as_of: Day) -> DataFrame:
    paid = flow.where(F.col("payment_date_id") == F.lit(as_date(as_of)))
    gap = seconds_between(F.col("order_time"), F.col("payment_time"))
    return paid.agg(F.floor(F.avg(gap)).cast("bigint").alias("order_to_pay_interval_avg")).select(
        F.lit(as_date(as_of)).alias("dt"), "order_to_pay_interval_avg")


def order_by_province(daily: DataFrame, as_of: Day) -> DataFrame:
    out = recent_days(daily, ["province_id", *PROVINCE], ["order_count_1d", "order_total_amount_1d"], as_of, DAYS)
    return out.select(F.lit(as_date(as_of)).alias("dt"), "recent_days", "province_id", *PROVINCE,
                      F.col("order_count_1d").alias("order_count"),
                      F.col("order_total_amount_1d").alias("order_total_amount"))


def coupon_stats(used_daily: DataFrame, as_of: Day) -> DataFrame:
    scope = used_daily.where(F.col("dt") == F.lit(as_date(as_of)))
    agg = scope.groupBy("coupon_id", "coupon_name").agg(
        F.sum("used_count_1d").alias("used_count"), F.count(F.lit(1)).alias("used_user_count"))
    return _stamp(agg, as_of, "coupon_id", "coupon_name", "used_count", "used_user_count")
