"""Marketing: cleaned detail, activity / segment / channel summaries, rankings, segment value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.bands import age_group, city_level, device_class, province_of_city
from millrace.functions.dates import as_date, is_weekend, since, spans_weekend
from millrace.functions.numbers import floor_zero, money_ratio, or_zero, ratio
from millrace.functions.text import canonical
from millrace.operators.joins import key_flag, lookup
from millrace.operators.topk import composite_rank

Day = str | dt.date
BEHAVIOURS = ["click", "view", "share", "participate"]


def user_detail(users: DataFrame, behaviour: DataFrame, as_of: Day) -> DataFrame:
    recent = behaviour.where(since(F.col("behavior_date"), as_of, 30))
    out = users.select(
        "user_id", "user_name", "gender", "age", age_group(F.col("age")).alias("age_group"), "city",
        city_level(F.col("city")).alias("city_level"), "register_time", F.to_date("register_time").alias("register_date"), "channel")
    return key_flag(out, recent, ["user_id"], "is_active")


def activity_detail(activity: DataFrame, as_of: Day) -> DataFrame:
    """Invalid status codes are inferred from the period; negative budgets become zero."""
    now = F.lit(as_date(as_of)).cast("timestamp")
    inferred = F.when(F.col("end_time") < now, 2).when(F.col("start_time") > now, 0).otherwise(1)
    return activity.select(
        "activity_id", "activity_name", "activity_type", "start_time", "end_time",
        F.when(~F.col("status").isin(0, 1, 2), inferred).otherwise(F.col("status")).alias("status"), "channel",
        floor_zero(F.col("budget")).cast("decimal(15,2)").alias("budget"), F.datediff("end_time", "start_time").alias("duration_days"),
        spans_weekend(F.col("start_time"), F.col("end_time")).alias("is_weekend_included"))


def behaviour_detail(behaviour: DataFrame, users: DataFrame) -> DataFrame:
    out = lookup(behaviour, users, {"user_id": "user_id"}, city="city")
    return out.select(
        "behavior_id", "user_id", "activity_id", canonical(F.col("behavior_type"), BEHAVIOURS, "other").alias("behavior_type"),
        "behavior_time", "behavior_date", F.hour("behavior_time").alias("behavior_hour"),
        F.when(is_weekend(F.col("behavior_time")), 1).otherwise(0).alias("is_weekend"), "device",
        device_class(F.col("device")).alias("device_type"), province_of_city(F.col("city")).alias("province"))


def effect_detail(effect: DataFrame, users: DataFrame) -> DataFrame:
    out = lookup(effect, users, {"user_id": "user_id"}, register_time="register_time", age="age")
    return out.select(
        "effect_id", "activity_id", "user_id", "conversion_time", F.to_date("conversion_time").alias("conversion_date"),
        "conversion_type", floor_zero(F.col("amount")).cast("decimal(16,2)").alias("amount"),
        F.when(F.datediff("conversion_time", "register_time") <= 30, 1).otherwise(0).alias("is_new_user"),
        age_group(F.col("age"), open_ended=False).alias("user_age_group"))


def _effects_per(effects: DataFrame, keys: list[str]) -> DataFrame:
    return effects.groupBy(*keys).agg(F.count("effect_id").alias("n"), F.sum("amount").alias("a"))


def activity_effect(activity: DataFrame, behaviour: DataFrame, effect: DataFrame) -> DataFrame:
    """Per activity and behaviour date; activities without behaviour keep one row without date."""
    def kind(name: str):
        return F.count(F.when(F.col("behavior_type") == name, 1))

    days = behaviour.groupBy("activity_id", "behavior_date", "user_id").agg(
        F.count(F.lit(1)).alias("n"), kind("view").alias("v"), kind("click").alias("c"), kind("share").alias("s"),
        kind("participate").alias("p"))
    days = days.groupBy("activity_id", "behavior_date").agg(
        F.sum("n").alias("n"), F.sum("v").alias("pv"), F.count(F.when(F.col("v") > 0, 1)).alias("uv"),
        F.sum("c").alias("click_count"), F.sum("s").alias("share_count"), F.sum("p").alias("participate_count"))
    made = _effects_per(effect.withColumn("d", F.to_date("conversion_time")), ["activity_id", "d"])
    cols = ["pv", "uv", "click_count", "share_count", "participate_count", "n"]
    out = lookup(activity.select("activity_id", "activity_name"), days, {"activity_id": "activity_id"},
                 stat_date="behavior_date", **{f"_{c}" if c == "n" else c: c for c in cols})
    out = lookup(out, made, {"activity_id": "activity_id", "stat_date": "d"}, _e="n", total_amount="a")
    filled = out.withColumns({c: or_zero(F.col(c)) for c in (*[c for c in cols if c != "n"], "_n", "_e")})
    zero4 = F.lit(0).cast("decimal(20,4)")
    return filled.withColumns({
        "conversion_count": F.col("_e"),
        "conversion_rate": F.coalesce(ratio(F.col("_e"), F.col("_n"), 4), zero4),
        "avg_amount": F.coalesce(ratio(F.col("total_amount"), F.col("_e"), 2), F.lit(0).cast("decimal(20,2)"))}).drop("_e", "_n")


def segment_activity(users: DataFrame, behaviour: DataFrame, effect: DataFrame) -> DataFrame:
    """Per age band, city tier and date; effects count on days with behaviour of the same user."""
    days = behaviour.groupBy("user_id", "behavior_date").agg(
        F.max(F.when(F.col("behavior_type") == "participate", 1).otherwise(0)).alias("joined"))
    made = _effects_per(effect, ["user_id", "conversion_date"])
    out = lookup(days, made, {"user_id": "user_id", "behavior_date": "conversion_date"}, n="n", a="a")
    out = lookup(out, users, {"user_id": "user_id"}, "inner", age_group="age_group", city_level="city_level")
    agg = out.groupBy("age_group", "city_level", F.col("behavior_date").alias("stat_date")).agg(
        F.count(F.lit(1)).alias("total_uv"), F.sum("joined").alias("j"), F.count("n").alias("buyers"),
        F.sum("n").alias("n"), F.sum("a").alias("a"))
    zero4 = F.lit(0).cast("decimal(20,4)")
    return agg.where(F.col("age_group").isNotNull()).select(
        "age_group", "city_level", "stat_date", "total_uv", ratio(F.col("j"), F.col("total_uv"), 4).alias("participate_rate"),
        F.coalesce(ratio(F.col("buyers"), F.col("j"), 4), zero4).alias("conversion_rate"),
        F.coalesce(ratio(F.col("a"), F.col("n"), 2), F.lit(0).cast("decimal(20,2)")).alias("avg_amount"))


def channel_effect(activity: DataFrame, behaviour: DataFrame, effect: DataFrame) -> DataFrame:
    """Channel-day return on investment; each activity's budget counts once per day."""
    group = ["channel", "activity_type", "duration_days", "stat_date"]
    running = activity.select("activity_id", "channel", "activity_type", "duration_days", "budget",
                              F.to_date("start_time").alias("d0"), F.to_date("end_time").alias("d1"))
    users = behaviour.groupBy("activity_id", F.col("behavior_date").alias("stat_date"), "user_id").agg(
        F.count(F.when(F.col("behavior_type") == "view", 1)).alias("v"))
    inside = users.join(running, "activity_id").where(F.col("stat_date").between(F.col("d0"), F.col("d1")))
    uv = inside.select(*group, "user_id").distinct().groupBy(*group).agg(F.count(F.lit(1)).alias("uv"))
    days = inside.groupBy(*group, "activity_id", "budget").agg(F.sum("v").alias("v"))
    made = _effects_per(effect, ["activity_id", "conversion_date"])
    days = lookup(days, made, {"activity_id": "activity_id", "stat_date": "conversion_date"}, n="n", a="a")
    agg = days.groupBy(*group).agg(F.sum("v").alias("pv"), F.sum("budget").alias("b"),
                                   or_zero(F.sum("n")).alias("conversion_count"), F.sum("a").alias("total_amount"))
    out = lookup(agg, uv, {g: g for g in group if g != "duration_days"} | {"duration_days": "duration_days"}, "inner", uv="uv")
    cost = ratio(F.col("b"), F.col("duration_days"), 2)
    out = out.withColumn("cost", cost).drop("b")
    roi = F.when(F.col("cost") == 0, F.lit(0).cast("decimal(20,4)")).otherwise(
        money_ratio(F.col("total_amount") - F.col("cost"), F.col("cost"), 4))
    return out.withColumn("roi", roi)


def marketing_analysis(channels: DataFrame) -> DataFrame:
    agg = channels.groupBy("stat_date", "channel", "activity_type").agg(
        F.sum("pv").alias("total_pv"), F.sum("uv").alias("total_uv"), F.sum("conversion_count").alias("total_conversion_count"),
        F.sum("total_amount").alias("total_amount"), ratio(F.sum("roi"), F.count("roi"), 4).alias("roi"))
    return agg.withColumns({
        "total_conversion_rate": F.coalesce(ratio(F.col("total_conversion_count"), F.col("total_pv"), 4), F.lit(0).cast("decimal(20,4)")),
        "avg_conversion_amount": F.when(F.col("total_conversion_count") == 0, F.lit(0).cast("decimal(20,2)")).otherwise(
            ratio(F.col("total_amount"), F.col("total_conversion_count"), 2))})


def activity_ranking(effects: DataFrame, activity: DataFrame, channels: DataFrame) -> DataFrame:
    """Three positions per day and the weighted score; the channel side is reduced before the join."""
    roi = channels.groupBy("activity_type", "channel", "stat_date").agg(
        ratio(F.sum("roi"), F.count("roi"), 6).alias("roi"))
    out = effects.where(F.col("stat_date").isNotNull())
    out = lookup(out, activity, {"activity_id": "activity_id"}, activity_type="activity_type", channel="channel")
    out = lookup(out, roi, {"activity_type": "activity_type", "channel": "channel", "stat_date": "stat_date"}, roi="roi")
    return composite_rank(out, ["stat_date"], {
        "conversion_rate_rank": (F.col("conversion_rate"), 40), "roi_rank": (F.col("roi"), 30),
        "total_amount_rank": (F.col("total_amount"), 30)}, "activity_id", "comprehensive_score")


def segment_value(users: DataFrame, behaviour: DataFrame, effect: DataFrame, as_of: Day) -> DataFrame:
    """Value per age band and city tier. The score ranks descending, so the best segment scores 0;
    ``user_value_score_asc`` turns it around."""
    made = _effects_per(effect, ["user_id"])
    recent = behaviour.where(since(F.col("behavior_date"), as_of, 30))
    rows = key_flag(lookup(users, made, {"user_id": "user_id"}, n="n", a="a"), recent, ["user_id"], "active")
    agg = rows.where(F.col("age_group").isNotNull()).groupBy("age_group", "city_level").agg(
        F.count(F.lit(1)).alias("user_count"), or_zero(F.sum("n")).alias("n"), F.sum("a").alias("total_purchase_amount"),
        F.sum("active").alias("act"))
    out = agg.withColumns({
        "avg_purchase_count": ratio(F.col("n"), F.col("user_count"), 2),
        "avg_purchase_amount": ratio(F.col("total_purchase_amount"), F.col("user_count"), 2),
        "last_30d_active_rate": ratio(F.col("act"), F.col("user_count"), 4),
        "mean_amount": ratio(F.col("total_purchase_amount"), F.col("n"), 6)})
    # the frame has one row per band and tier, so a window over all rows is small
    def place(col: str):
        return F.percent_rank().over(Window.orderBy(F.col(col).desc_nulls_last()))

    score = place("total_purchase_amount") * 0.4 + place("n") * 0.3 + place("mean_amount") * 0.3
    return out.withColumn("user_value_score", F.round(score * 100, 6)).withColumn(
        "user_value_score_asc", F.round((1 - score) * 100, 6)).drop("act", "mean_amount")
