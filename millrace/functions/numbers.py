"""Exact ratios and outlier repair."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(16,2)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def ratio(numerator: Column, denominator: Column, scale: int = 4) -> Column:
    """Half-up rounded quotient in decimals, null on a zero denominator.

    Both sides are narrowed so that the quotient keeps more than ten digits
    beyond ``scale``: rounding happens once.
    """
    top = numerator.cast("decimal(20,4)")
    bottom = denominator.cast("decimal(14,0)")
    return F.round(F.try_divide(top, F.nullif(bottom, F.lit(0).cast("decimal(14,0)"))), scale).cast(
        f"decimal(20,{scale})"
    )


def money_ratio(numerator: Column, denominator: Column, scale: int = 4) -> Column:
    """Quotient of two money sums, rounded half up once."""
    top = numerator.cast("decimal(18,2)")
    bottom = denominator.cast("decimal(16,2)")
    return F.round(F.try_divide(top, F.nullif(bottom, F.lit(0).cast("decimal(16,2)"))), scale).cast(
        f"decimal(20,{scale})"
    )


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def floor_zero(col: Column) -> Column:
    """Negative money becomes zero; null stays null."""
    return F.when(col < 0, F.lit(0)).otherwise(col)


def within_or(col: Column, low: int, high: int, default: int) -> Column:
    return F.when(col.between(low, high), col).otherwise(F.lit(default))
