"""Weights of the age-band label model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Fixed values, one block: bands, coefficients, and per model the keys with their six band weights.
BANDS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"]
COEFFICIENTS = {"device": "0.1", "search": "0.15", "pay_time": "0.1", "amount": "0.15", "brand": "0.2", "category": "0.3"}
WEIGHTS = {
    "device": [
        (["iOS"], [0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
        (["Android"], [0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    ],
    "search": [
        (["时尚与潮流"], [0.9, 0.7, 0.5, 0.3, 0.2, 0.1]),
        (["性价比"], [0.2, 0.4, 0.6, 0.7, 0.8, 0.8]),
        (["健康与养生", "家庭与育儿"], [0.1, 0.2, 0.4, 0.6, 0.8, 0.7]),
        (["科技与数码"], [0.8, 0.6, 0.4, 0.3, 0.2, 0.1]),
        (["学习与发展"], [0.4, 0.5, 0.6, 0.7, 0.8, 0.7]),
        (["default"], [0, 0, 0, 0, 0, 0]),
    ],
    "pay_time": [
        (["凌晨"], [0.2, 0.1, 0.1, 0.1, 0.1, 0.1]),
        (["早晨"], [0.1, 0.1, 0.1, 0.1, 0.2, 0.3]),
        (["上午"], [0.2, 0.2, 0.2, 0.2, 0.3, 0.4]),
        (["中午"], [0.4, 0.4, 0.4, 0.4, 0.4, 0.3]),
        (["下午"], [0.4, 0.5, 0.5, 0.5, 0.5, 0.4]),
        (["晚上"], [0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
        (["夜间"], [0.9, 0.7, 0.5, 0.3, 0.2, 0.1]),
    ],
    "amount": [
        (["low"], [0.8, 0.6, 0.4, 0.3, 0.2, 0.1]),
        (["mid"], [0.2, 0.4, 0.6, 0.7, 0.8, 0.7]),
        (["high"], [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]),
    ],
    "brand": [
        (["TCL"], [0.2, 0.3, 0.4, 0.5, 0.6, 0.7]),
        (["苹果", "联想", "小米"], [0.9, 0.8, 0.7, 0.7, 0.7, 0.5]),
        (["欧莱雅"], [0.5, 0.6, 0.8, 0.8, 0.9, 0.2]),
        (["香奈儿"], [0.3, 0.4, 0.6, 0.8, 0.9, 0.2]),
        (["default"], [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]),
    ],
    "category": [
        (["数码", "手机", "电脑办公", "个护化妆", "服饰内衣"], [0.9, 0.8, 0.6, 0.4, 0.2, 0.1]),
        (["家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"], [0.2, 0.4, 0.6, 0.8, 0.9, 0.7]),
        (["default"], [0.1, 0.2, 0.4, 0.5, 0.8, 0.9]),
    ],
}


def keys(model: str) -> list[str]:
    return [k for group, _ in WEIGHTS[model] for k in group]


def weight_rows() -> list[tuple[str, str, str, int, Decimal, Decimal]]:
    """(model, key, band, band position, weight, coefficient)."""
    return [(model, key, band, i, Decimal(str(w)), Decimal(COEFFICIENTS[model]))
            for model, groups in WEIGHTS.items() for group, weights in groups for key in group
            for i, (band, w) in enumerate(zip(BANDS, weights, strict=True))]


def weight_table(spark: SparkSession) -> DataFrame:
    """The fixed weight table (a few hundred rows, safe to broadcast)."""
    return spark.createDataFrame(
        weight_rows(), "model string, key string, band string, band_no int, weight decimal(3,1), coefficient decimal(3,2)")
