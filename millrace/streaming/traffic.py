"""Log and traffic streams. Functions take and return streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.keywords import explode_words
from millrace.sources import logs


def split_log(text: DataFrame, column: str = "log") -> DataFrame:
    """Raw text to tagged records: err, start, display, action, page, and dirty for bad text."""
    good, bad = logs.split_dirty(text, column)
    dirty = bad.select(F.lit(None).cast("string").alias("mid"), F.lit(None).cast("bigint").alias("ts"),
                       F.lit("dirty").alias("channel"), F.col("dirty_text").alias("payload"))
    return logs.route(good).unionByName(dirty)


def _window(time: str, length: str) -> Column:
    return F.window(time, length).alias("w")


def edges(df: DataFrame) -> DataFrame:
    """Window start, end and date columns instead of the window struct."""
    cols = [c for c in df.columns if c != "w"]
    return df.select(F.col("w.start").alias("stt"), F.col("w.end").alias("edt"),
                     F.date_format("w.start", "yyyyMMdd").alias("cur_date"), *cols)


def first_of_day(df: DataFrame, keys: list[str], time: str = "ts", keep: str = "1 day") -> DataFrame:
    """First arriving row per key and date; state is dropped one day after the event time.

    For sources that deliver in event-time order; ``images.first_of_day`` takes any order.
    """
    dated = df.withColumn("cur_day", F.to_date(time))
    return dated.withWatermark(time, keep).dropDuplicatesWithinWatermark([*keys, "cur_day"])


def unique_cart_users(firsts: DataFrame, length: str = "5 seconds") -> DataFrame:
    """Daily-first users per window, from the change log of first rows; windows that lost all of theirs have 0."""
    return firsts.groupBy(_window("ts", length)).agg(F.sum("sign").alias("cart_add_uu_ct"))


def tag_home(pages: DataFrame) -> DataFrame:
    return pages.withColumn("is_home", F.coalesce(F.col("page_id") == "home", F.lit(False)))


def home_detail_visitors(firsts: DataFrame, length: str = "5 seconds") -> DataFrame:
    """Daily-first visits of the home page and of all other pages, counted separately."""
    return firsts.groupBy(_window("ts", length)).agg(
        F.sum(F.when(F.col("is_home"), F.col("sign")).otherwise(0)).alias("home_uv_ct"),
        F.sum(F.when(~F.col("is_home"), F.col("sign")).otherwise(0)).alias("detail_uv_ct"))


TRAFFIC_DIMS = ["vc", "ch", "ar", "is_new"]


_MEASURES = ("uv", "sv", "pv", "dur")


def _measured(rows: DataFrame, **measures: Column) -> DataFrame:
    """Window time, dimensions and measures; those not given are 0."""
    return rows.select("ts", *TRAFFIC_DIMS, *[measures.get(c, F.lit(0)).cast("bigint").alias(c) for c in _MEASURES])


def view_rows(pages: DataFrame) -> DataFrame:
    """Sessions, views and stay of page views, as rows to be added up."""
    entry = F.coalesce(F.col("last_page_id"), F.lit("")) == ""
    return _measured(pages, sv=F.when(entry, 1).otherwise(0), pv=F.lit(1), dur=F.col("during_time"))


def visitor_rows(firsts: DataFrame) -> DataFrame:
    """Changes of daily-first visits as rows to be added up."""
    return _measured(firsts, uv=F.col("sign"))


def traffic(rows: DataFrame, length: str = "10 seconds") -> DataFrame:
    """Visitors, sessions, views and stay by version, channel, area and new flag."""
    return rows.groupBy(_window("ts", length), *TRAFFIC_DIMS).agg(
        *[F.sum(c).alias(f"{c}_{'sum' if c == 'dur' else 'ct'}") for c in ("uv", "sv", "pv", "dur")])


def keyword_counts(pages: DataFrame, length: str = "10 seconds") -> DataFrame:
    searched = pages.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & F.col("item").isNotNull())
    words = explode_words(searched.withWatermark("ts", "5 seconds").select("ts", "item"), "item")
    return words.groupBy(_window("ts", length), "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))


def login_windows(flags: DataFrame, length: str = "1 second") -> DataFrame:
    """Unique and win-back logins per window, from the change log of flagged days."""
    return flags.groupBy(_window("ts", length)).agg(
        F.sum(F.col("uu") * F.col("sign")).alias("uu_ct"), F.sum(F.col("back") * F.col("sign")).alias("back_ct"))


def closed_windows(rows: DataFrame, key: str, time: str = "ts", length: str = "10 seconds") -> DataFrame:
    """Amount and lines per window and key in append mode, by a watermark without delay: a window comes once, when it is over."""
    return rows.withWatermark(time, "0 seconds").groupBy(_window(time, length), key).agg(
        F.sum("amount").alias("order_amount"), F.count(F.lit(1)).alias("line_count"))


def order_cells(changes: DataFrame, key: str, length: str = "10 seconds") -> DataFrame:
    """Net amount per window, key and order over a change log: sums that micro-batches can add up."""
    return changes.groupBy(_window("ts", length), key, "order_id").agg(
        F.sum(F.col("sign") * F.col("copies") * F.col("amount")).alias("amount"))


def order_windows(cells: DataFrame, key: str) -> DataFrame:
    """Net amount and distinct orders per window and key."""
    return cells.groupBy("w", key).agg(F.sum("amount").alias("order_amount"), F.count("order_id").alias("order_count"))


def profiles(events: DataFrame) -> DataFrame:
    """Running profile per user (update mode): page views, distinct device values, newest search."""
    known = events.where(F.col("uid") != "-1")
    return known.groupBy("uid").agg(
        F.count(F.lit(1)).alias("pv"), F.max("ts_ms").alias("ts_ms"),
        F.max_by("search_item", F.when(F.col("search_item").isNotNull(), F.col("ts_ms"))).alias("search_item"),
        *[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c) for c in ("os", "ch", "md", "ba")])


def distinct_events(df: DataFrame, columns: list[str], time: str = "ts", keep: str = "1 hour") -> DataFrame:
    """Exact repeat removal inside the watermark."""
    return df.withWatermark(time, keep).dropDuplicatesWithinWatermark(columns)
