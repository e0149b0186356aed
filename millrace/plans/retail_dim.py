"""Retail dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import discount_rule
from millrace.operators.joins import lookup


def _attributes(values: DataFrame, key: str, *cols: str) -> DataFrame:
    """All attribute rows of a sku as one sorted array, so the sku stays one row."""
    return values.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(*cols))).alias("attrs"))


def sku_names(sku: DataFrame, spu: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame,
              trademark: DataFrame) -> DataFrame:
    """Snowflake flattened to one row per sku (what the summaries need)."""
    out = lookup(sku, spu, {"spu_id": "id"}, spu_name="spu_name", _c3="category3_id")
    out = out.drop("category3_id").withColumnRenamed("_c3", "category3_id")
    out = lookup(out, c3, {"category3_id": "id"}, category3_name="name", category2_id="category2_id")
    out = lookup(out, c2, {"category2_id": "id"}, category2_name="name", category1_id="category1_id")
    out = lookup(out, c1, {"category1_id": "id"}, category1_name="name")
    return lookup(out, trademark, {"tm_id": "id"}, tm_name="tm_name")


def sku_category(sku: DataFrame, spu: DataFrame) -> DataFrame:
    """Lowest category of each sku."""
    return lookup(sku.select("id", "spu_id"), spu, {"spu_id": "id"}, category3_id="category3_id")


def dim_sku(names: DataFrame, attr: DataFrame, sale_attr: DataFrame) -> DataFrame:
    """Full sku dimension: names plus attribute lists as arrays."""
    attrs = _attributes(attr, "sku_id", "attr_id", "value_id", "attr_name", "value_name")
    sale = _attributes(sale_attr, "sku_id", "id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name")
    out = lookup(names, attrs, {"id": "sku_id"}, sku_attr_values="attrs")
    return lookup(out, sale, {"id": "sku_id"}, sku_sale_attr_values="attrs")


def _dic(dic: DataFrame, parent: str) -> DataFrame:
    return dic.where(F.col("parent_code") == parent)


def dim_coupon(coupon: DataFrame, dic: DataFrame) -> DataFrame:
    out = lookup(coupon, _dic(dic, "32"), {"coupon_type": "dic_code"}, coupon_type_name="dic_name")
    out = lookup(out, _dic(dic, "33"), {"range_type": "dic_code"}, range_type_name="dic_name")
    cut = F.concat(F.lit("减"), F.col("benefit_amount"), F.lit("元"))
    rule = discount_rule(F.col("coupon_type"), ("3201", "3202", "3203"), cut, F.col("condition_amount"),
                         F.col("condition_num"), F.col("benefit_amount"), F.col("benefit_discount"))
    return out.withColumn("benefit_rule", rule)


def dim_activity(rule: DataFrame, info: DataFrame, dic: DataFrame) -> DataFrame:
    out = lookup(rule, info, {"activity_id": "id"}, activity_name="activity_name", activity_desc="activity_desc")
    out = lookup(out, _dic(dic, "31"), {"activity_type": "dic_code"}, activity_type_name="dic_name")
    off = F.concat(F.lit("打"), F.col("benefit_discount"), F.lit("折"))
    text = discount_rule(F.col("activity_type"), ("3101", "3102", "3103"), off, F.col("condition_amount"),
                         F.col("condition_num"), F.col("benefit_amount"), F.col("benefit_discount"))
    return out.withColumn("benefit_rule", text).withColumnRenamed("id", "activity_rule_id")


def dim_province(province: DataFrame, region: DataFrame) -> DataFrame:
    out = lookup(province, region, {"region_id": "id"}, region_name="region_name")
    return out.withColumnRenamed("name", "province_name")


def dim_promotion_pos(pos: DataFrame) -> DataFrame:
    return pos.select("id", "pos_location", "pos_type", "promotion_type")


def dim_promotion_refer(refer: DataFrame) -> DataFrame:
    return refer.select("id", "refer_name")
