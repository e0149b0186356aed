"""Last-N-day and to-date summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.dates import as_date, in_last, window_start

DAYS = (1, 7, 30)


def recent_days(df: DataFrame, keys: list[str], sums: list[str], as_of: str | dt.date,
                days: tuple[int, ...] = (7, 30), dt_col: str = "dt") -> DataFrame:
    """Long form: one row per key and N, sums over the last N days.

    One scan of the widest window and one aggregate hold all N (no row fan-out); the result
    is turned long and an N without rows in its window is left out.
    """
    scope = df.where(in_last(F.col(dt_col), as_of, max(days)))
    cols: list[Column] = []
    for n in days:
        hit = F.col(dt_col) >= F.lit(window_start(as_of, n))
        cols.append(F.count(F.when(hit, 1)).alias(f"_n_{n}"))
        cols += [F.sum(F.when(hit, F.col(c))).alias(f"{c}_{n}") for c in sums]
    wide = scope.groupBy(*keys).agg(*cols)
    rows = F.array(*[F.struct(F.lit(n).alias("recent_days"), F.col(f"_n_{n}").alias("_n"),
                              *[F.col(f"{c}_{n}").alias(c) for c in sums]) for n in days])
    return (wide.select(*keys, F.explode(rows).alias("r")).where(F.col("r._n") > 0)
            .select(*keys, "r.recent_days", *[F.col("r")[c].alias(c) for c in sums]))


def wide_days(df: DataFrame, keys: list[str], sums: dict[str, str], as_of: str | dt.date,
              days: tuple[int, ...] = (7, 30), dt_col: str = "dt") -> DataFrame:
    """Wide form: ``{name}_{n}d`` columns, each bounded to its own window."""
    scope = df.where(in_last(F.col(dt_col), as_of, max(days)))
    cols = []
    for n in days:
        hit = F.col(dt_col) >= F.lit(window_start(as_of, n))
        cols += [F.coalesce(F.sum(F.when(hit, F.col(src))), F.lit(0)).alias(f"{name}_{n}d")
                 for name, src in sums.items()]
    return scope.groupBy(*keys).agg(*cols)


def counts_by_last_seen(df: DataFrame, keys: list[str], as_of: str | dt.date, last: str,
                        metrics: dict[str, Column | None], days: tuple[int, ...] = DAYS) -> DataFrame:
    """Per N: number of rows whose ``last`` date falls into the last N days.

    ``metrics`` maps output names to an extra date column (counted if inside the window too)
    or None for a plain count.
    """
    scope = df.where(F.col(last) >= F.lit(window_start(as_of, max(days))))
    cols = []
    for n in days:
        start = F.lit(window_start(as_of, n))
        hit = F.col(last) >= start
        cols.append(F.count(F.when(hit, 1)).alias(f"_n_{n}"))
        for name, extra in metrics.items():
            cond = hit if extra is None else hit & (extra >= start)
            cols.append(F.count(F.when(cond, 1)).alias(f"{name}_{n}"))
    agg = scope.groupBy(*keys).agg(*cols) if keys else scope.agg(*cols)
    rows = F.array(*[F.struct(F.lit(n).alias("recent_days"), F.col(f"_n_{n}").alias("_n"),
                              *[F.col(f"{m}_{n}").alias(m) for m in metrics]) for n in days])
    return (agg.select(*keys, F.explode(rows).alias("r")).where(F.col("r._n") > 0)
            .select(F.lit(as_date(as_of)).alias("dt"), "r.recent_days", *keys,
                    *[F.col("r")[m].alias(m) for m in metrics]))


def to_date(df: DataFrame, keys: list[str], sums: dict[str, str], first: str, last: str,
            dt_col: str = "dt") -> DataFrame:
    """Cumulative totals with the first and last date seen."""
    aggs = [F.min(dt_col).alias(first), F.max(dt_col).alias(last),
            *[F.sum(src).alias(name) for name, src in sums.items()]]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
