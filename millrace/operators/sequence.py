"""Batch forms of the keyed, order-dependent rules.

Each is written as aggregates per key plus an equi join, or over bounded partitions, so that a
key with a large share of the rows does not end up in one task. A null key is a key of its own, and
rows with a null time come first: no rule drops a row for a null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.dedup import first_per_key, latest_per_key
from millrace.operators.joins import null_safe
from millrace.operators.ordered import running_max, with_neighbours


def newest_wins(df: DataFrame, keys: list[str], arrival: str, ties: list[str], version: str,
                grain: str = "minute", image: DataFrame | None = None) -> DataFrame:
    """Rows whose version exceeds every version seen earlier for the key.

    ``image`` (keys, version) holds what was seen before this frame.
    """
    seen = running_max(df, keys, arrival, ties, version, "_seen", grain)
    if image is not None:
        known = image.select(*keys, F.col(version).alias("_known"))
        seen = null_safe(seen, known, keys, "left").withColumn("_seen", F.greatest("_seen", "_known")).drop("_known")
    return seen.where(F.col("_seen").isNull() | (F.col(version) > F.col("_seen"))).select(*df.columns)


def _copies(df: DataFrame, keys: list[str], image: DataFrame | None) -> DataFrame:
    """Each row once with the number of its ``copies``; rows of ``image`` whose keys occur are ``old``."""
    rows = df.select(*df.columns, F.lit(1).cast("bigint").alias("copies"), F.lit(0).alias("old"))
    if image is not None:
        held = image.select(*df.columns, F.lit(0).cast("bigint").alias("copies"), F.lit(1).alias("old"))
        rows = rows.unionByName(null_safe(held, df.select(*keys).distinct(), keys, "left_semi"))
    return rows.groupBy(*df.columns).agg(F.sum("copies").alias("copies"), F.max("old").alias("old"))


def retractions(df: DataFrame, keys: list[str], order: list[str], image: DataFrame | None = None) -> DataFrame:
    """Change log of a stream with repeated keys: every row once with sign +1, and every row that
    a later one replaces once more with sign -1. ``copies`` counts identical rows.

    ``image`` holds the newest row per key from before this frame; a replaced one gets its -1.
    The newest row per key comes from a partial aggregate; nothing is ordered inside a key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [*order, *rest]
    # the keys as one struct: nulls inside are equal, and what is grouped by it needs no other shuffle to be joined on it
    rows = _copies(df, keys, image).withColumn("_of", F.struct(*keys)).drop(*keys)
    newest = rows.groupBy("_of").agg(F.max(F.struct(*ordered)).alias("_newest"))
    marked = rows.join(newest, "_of")
    is_newest = F.struct(*ordered).eqNullSafe(F.col("_newest"))
    taken_back = F.col("copies") + F.col("old") - F.when(is_newest, 1).otherwise(0)
    plus = F.struct(F.lit(1).alias("sign"), F.col("copies").alias("copies"))
    minus = F.struct(F.lit(-1).alias("sign"), taken_back.alias("copies"))
    return (marked.withColumn("c", F.explode(F.array(plus, minus))).where(F.col("c.copies") > 0)
            .select(*[F.col("_of")[c].alias(c) if c in keys else F.col(c) for c in df.columns], "c.sign", "c.copies"))


def retractions_within(df: DataFrame, keys: list[str], order: list[str], ttl: int, image: DataFrame | None = None,
                       grain: str = "minute") -> DataFrame:
    """Like ``retractions``, but a row is taken back only by one of its key that follows it in less than ``ttl`` seconds.

    A key that comes back later than that starts anew. Neighbours in time are found in (key, ``grain``) chunks, so a hot
    key is cut. ``image`` holds the newest row per key from before this frame.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    marked = with_neighbours(_copies(df, keys, image), keys, order[0], [*order[1:], *rest], [order[0]], grain)
    soon = F.col("next")[order[0]] < F.col(order[0]) + F.make_interval(secs=F.lit(ttl))
    taken_back = F.col("copies") + F.col("old") - F.when(F.coalesce(soon, F.lit(False)), 0).otherwise(1)
    plus = F.struct(F.lit(1).alias("sign"), F.col("copies").alias("copies"))
    minus = F.struct(F.lit(-1).alias("sign"), taken_back.alias("copies"))
    return (marked.withColumn("c", F.explode(F.array(plus, minus))).where(F.col("c.copies") > 0)
            .select(*df.columns, "c.sign", "c.copies"))


def newest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key by the same order as the change log."""
    return latest_per_key(df, keys, [*order])


def first_of_day(df: DataFrame, keys: list[str], time: str, ties: list[str]) -> DataFrame:
    """First row per key and date (the daily-unique flag)."""
    dated = df.withColumn("cur_date", F.to_date(time))
    return first_per_key(dated, [*keys, "cur_date"], [time, *ties])


def login_flags(df: DataFrame, user: str, time: str, gap: int = 8) -> DataFrame:
    """First login of each user and date; ``back`` = 1 after ``gap`` days of absence.

    Reduced to one row per (user, date) first, so a partition holds at most one row per day.
    """
    days = df.groupBy(user, F.to_date(time).alias("login_date")).agg(F.min(time).alias("first_time"))
    previous = F.lag("login_date").over(Window.partitionBy(user).orderBy("login_date"))
    return days.withColumn("uu", F.lit(1)).withColumn(
        "back", F.when(F.datediff("login_date", previous) >= gap, 1).otherwise(0))


def first_seen(df: DataFrame, device: str, flag: str, time: str, ties: list[str]) -> DataFrame:
    """Date kept for a device: that of its first row, or the day before when that row says "not new"."""
    first = first_per_key(df.select(device, F.col(time).alias("_t"), F.col(flag).alias("_f"), *ties),
                          [device], ["_t", *ties])
    return first.select(device, F.when(F.col("_f") == "1", F.to_date("_t")).otherwise(
        F.date_sub(F.to_date("_t"), 1)).alias("first_date"))


def repair_new_flag(df: DataFrame, device: str, flag: str, time: str, known: DataFrame) -> DataFrame:
    """Correct the new-visitor flag: "new" on another date than the kept one becomes "not new"."""
    kept = known.select(F.col(device).alias("_d"), F.col("first_date").alias("_first"))
    joined = df.join(kept, F.col(device).eqNullSafe(F.col("_d")))
    wrong = (F.col(flag) == "1") & (F.to_date(time) != F.col("_first"))
    return joined.withColumn("is_new_fixed", F.when(wrong, "0").otherwise(F.col(flag))).select(*df.columns, "is_new_fixed")


def profile(df: DataFrame, user: str, sets: dict[str, Column], version: str) -> DataFrame:
    """Running profile per user: row count, newest version, distinct values as joined text.

    Distinct values are found before they are collected (partial aggregation removes repeats).
    """
    return df.groupBy(user).agg(
        F.count(F.lit(1)).alias("pv"), F.max(version).alias(version),
        *[F.array_join(F.array_sort(F.collect_set(col)), ",").alias(name) for name, col in sets.items()])
