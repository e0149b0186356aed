"""Top-k and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.numbers import ratio
from millrace.operators.joins import null_safe
from millrace.sinks.workspace import cut


def top_per_group(df: DataFrame, group: list[str], by: list[Column], k: int, out: str = "rk",
                  ties: bool = True) -> DataFrame:
    """Rank within the group, keep ranks up to k.

    The planner puts a group limit before the shuffle, so each task forwards only its best rows.
    """
    w = Window.partitionBy(*group).orderBy(*by)
    rank = F.rank() if ties else F.row_number()
    return df.withColumn(out, rank.over(w)).where(F.col(out) <= k)


def rank_in(df: DataFrame, group: list[str], by: list[Column], out: str = "rk") -> DataFrame:
    return df.withColumn(out, F.rank().over(Window.partitionBy(*group).orderBy(*by)))


def top_k(df: DataFrame, by: list[Column], k: int, out: str | None = None) -> DataFrame:
    """The k best rows overall; ``out`` numbers them (a window over at most k rows)."""
    best = df.orderBy(*by).limit(k)
    if out is None:
        return best
    return best.withColumn(out, F.row_number().over(Window.orderBy(*by)))


def group_positions(df: DataFrame, group: list[str], ranked: dict[str, Column], tie: str, pieces: int = 32) -> DataFrame:
    """Add the row's position in its group for each measure (largest first, nulls last, then by ``tie``), and ``_n``, its size.

    A group is cut into ranges of the measure, so no task holds a group: ranges end at the measure's approximate
    percentiles, one aggregate for all measures. A value that is itself such an end, like one many rows share, is a range of its own,
    and it and the nulls are cut again by percentiles of ``tie``. Positions inside a range plus the counts of the
    ranges before it make the position; the window over a group's ranges has at most some ``pieces`` squared rows.
    """
    cuts = F.array(*[F.lit(k / pieces) for k in range(1, pieces)])
    # written once: the ends, the ranges' counts and the positions inside them read the same rows
    measured = cut(df.withColumns({f"_m_{name}": measure for name, measure in ranked.items()}), "measured")
    ends = measured.groupBy(*group).agg(F.percentile_approx(tie, cuts).alias("_e_tie"), *[
        F.percentile_approx(f"_m_{name}", cuts).alias(f"_e_{name}") for name in ranked])
    out = null_safe(measured, ends, group)
    among = F.size(F.filter(F.coalesce("_e_tie", F.array()), lambda e: e < F.col(tie)))
    for name in ranked:
        x, e = F.col(f"_m_{name}"), F.col(f"_e_{name}")
        alone = x.isNull() | F.coalesce(F.array_contains(e, x), F.lit(False))
        place = F.when(x.isNull(), 2 * pieces + 2).otherwise(2 * F.size(F.filter(e, lambda v: v > x)) + F.when(alone, 1).otherwise(0))
        out = out.withColumn(f"_c_{name}", F.struct(place.alias("c"), F.when(alone, among).otherwise(0).alias("t")))
    base = out = out.drop("_e_tie", *[f"_e_{name}" for name in ranked])
    for k, name in enumerate(ranked):
        inside = Window.partitionBy(*group, f"_c_{name}").orderBy(F.col(f"_m_{name}").desc_nulls_last(), F.col(tie))
        counts = base.groupBy(*group, f"_c_{name}").agg(F.count(F.lit(1)).alias("_k"))
        over = Window.partitionBy(*group)
        before = F.sum("_k").over(over.orderBy(f"_c_{name}").rowsBetween(Window.unboundedPreceding, -1))
        sizes = {} if k else {"_n": F.sum("_k").over(over)}
        counts = counts.withColumns({"_before": F.coalesce(before, F.lit(0)), **sizes}).drop("_k")
        ranks = out.withColumn("_in", F.row_number().over(inside))
        out = null_safe(ranks, counts, [*group, f"_c_{name}"]).withColumn(name, (F.col("_in") + F.col("_before")).cast("int")).drop("_in", "_before")
    return out.drop(*[f"_{p}_{name}" for name in ranked for p in "mc"])


def composite_rank(df: DataFrame, group: list[str], ranked: dict[str, tuple[Column, int]],
                   tie: str, score: str) -> DataFrame:
    """Independent positions per measure and the score ``sum percent * (n - rank) / n``.

    ``ranked`` maps the rank column to (measure, weight in percent).
    """
    out = group_positions(df, group, {name: measure for name, (measure, _) in ranked.items()}, tie)
    total = F.lit(0)
    for name, (_, percent) in ranked.items():
        total = total + F.lit(percent) * (F.col("_n") - F.col(name))
    return out.withColumn(score, ratio(total, F.col("_n"), 2)).drop("_n")
