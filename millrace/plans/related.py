"""Related products: relation scores, behaviour sequences, guide rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import as_date, minutes_between, since
from millrace.functions.numbers import ratio
from millrace.operators.joins import lookup
from millrace.operators.ordered import global_rank
from millrace.operators.topk import top_k

Day = str | dt.date
# Behaviour code -> (name, weight).
WEIGHTS = {1: ("visit", 1), 2: ("favor", 2), 3: ("cart", 3), 4: ("pay", 5)}


def _name(df: DataFrame, product: DataFrame, key: str, out: str) -> DataFrame:
    return lookup(df, product, {key: "product_id"}, **{out: "product_name"})


def behaviour_detail(behaviour: DataFrame, product: DataFrame, as_of: Day) -> DataFrame:
    kept = behaviour.where(since(F.col("dt"), as_of, 7) & F.col("main_product_id").isNotNull())
    out = _name(kept, product, "main_product_id", "main_product_name")
    return _name(out, product, "related_product_id", "related_product_name")


def _kind(code: int):
    return F.count(F.when(F.col("behavior_type") == code, 1))


def relation_stats(behaviour: DataFrame, day: Day) -> DataFrame:
    """Per product pair: counts by behaviour, guided visits and the weighted score."""
    scope = behaviour.where(F.col("related_product_id").isNotNull() & (F.col("dt") == F.lit(as_date(day))))
    weight = F.lit(0)
    for code, (_, w) in WEIGHTS.items():
        weight = F.when(F.col("behavior_type") == code, w).otherwise(weight)
    guided = (F.col("is_guide_from_detail") == 1) & (F.col("behavior_type") == 1)
    return scope.groupBy("main_product_id", "related_product_id", F.col("dt").alias("stat_date")).agg(
        *[_kind(code).alias(f"same_{name}_count") for code, (name, _) in WEIGHTS.items()],
        F.count(F.when(guided, 1)).alias("guide_visit_count"), F.sum(weight).alias("total_relation_score"))


def sequence_stats(behaviour: DataFrame, day: Day) -> DataFrame:
    """Rates of related behaviour per main product and the mean minutes between both roles."""
    scope = behaviour.where(F.col("dt") == F.lit(as_date(day)))
    mains = scope.groupBy("main_product_id", F.col("dt").alias("stat_date")).agg(
        _kind(1).alias("visits"), _kind(3).alias("carts"))
    pairs = scope.where(F.col("related_product_id").isNotNull())
    cols = ["user_id", "behavior_type", "behavior_time"]
    both = pairs.select("main_product_id", "related_product_id", *cols, F.lit(1).alias("is_main")).unionByName(
        pairs.select(F.col("related_product_id").alias("main_product_id"),
                     F.col("main_product_id").alias("related_product_id"), *cols, F.lit(0).alias("is_main")))
    per_user = both.groupBy("main_product_id", "related_product_id", "user_id").agg(
        *[_kind(code).alias(name) for code, (name, _) in WEIGHTS.items()],
        minutes_between(F.max(F.when(F.col("is_main") == 1, F.col("behavior_time"))),
                        F.max(F.when(F.col("is_main") == 0, F.col("behavior_time")))).alias("gap"))
    agg = per_user.groupBy("main_product_id").agg(
        *[F.sum(name).alias(name) for name, _ in WEIGHTS.values()], F.sum("gap").alias("gaps"), F.count("gap").alias("gap_n"))
    out = lookup(mains, agg, {"main_product_id": "main_product_id"},
                 **{c: c for c in ("visit", "favor", "cart", "pay", "gaps", "gap_n")})
    zero = F.lit(0).cast("decimal(20,2)")

    def rate(part: str, whole: str):
        return F.when(F.col(whole) == 0, zero).otherwise(ratio(F.col(part) * 100, F.col(whole), 2))

    return out.select(
        "main_product_id", "stat_date", rate("visit", "visits").alias("visit_to_visit_rate"),
        rate("favor", "visits").alias("visit_to_favor_rate"), rate("cart", "visits").alias("visit_to_cart_rate"),
        rate("pay", "carts").alias("cart_to_pay_rate"), ratio(F.col("gaps"), F.col("gap_n"), 4).alias("avg_behavior_interval"))


def _top_mains(stats: DataFrame, k: int = 10) -> DataFrame:
    """The k main products with most guided visits; at most k rows, joined back on the key."""
    total = stats.groupBy("main_product_id").agg(F.sum("guide_visit_count").alias("total_guide"))
    return top_k(total, [F.desc("total_guide"), F.asc("main_product_id")], k)


def top_guides(stats: DataFrame, product: DataFrame) -> DataFrame:
    rows = stats.join(F.broadcast(_top_mains(stats)), "main_product_id")
    rows = rows.withColumn("conversion_rate", F.when(F.col("same_visit_count") == 0, F.lit(0).cast("decimal(20,2)")).otherwise(
        ratio(F.col("same_pay_count") * 100, F.col("same_visit_count"), 2)))
    rows = _name(_name(rows, product, "main_product_id", "main_product_name"), product, "related_product_id", "related_product_name")
    return global_rank(rows, [F.desc("total_guide"), F.desc("guide_visit_count"), F.asc("main_product_id"),
                              F.asc("related_product_id")], "rank")


def monitored(stats: DataFrame, product: DataFrame) -> DataFrame:
    rows = stats.join(F.broadcast(_top_mains(stats)), "main_product_id")
    rows = lookup(rows, product, {"main_product_id": "product_id"}, monitor_product_name="product_name", _valid="is_valid")
    rows = _name(rows.where(F.col("_valid") == 1), product, "related_product_id", "related_product_name")
    return rows.select(F.col("main_product_id").alias("monitor_product_id"), "monitor_product_name", "related_product_id",
                       "related_product_name", "guide_visit_count", F.col("same_pay_count").alias("conversion_count"), "stat_date")


def sequence_ranking(sequences: DataFrame, stats: DataFrame, product: DataFrame) -> DataFrame:
    """At most ten rows, so the position comes from a small window."""
    rows = sequences.join(F.broadcast(_top_mains(stats)), "main_product_id")
    named = _name(rows, product, "main_product_id", "main_product_name")
    return top_k(named, [F.desc("visit_to_cart_rate"), F.asc("main_product_id")], 10, "rank")
