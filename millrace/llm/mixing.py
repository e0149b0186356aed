"""Mixing sources to target word counts by entropy balancing.

A document's size is its number of words. Sources in code-point order (null last) weigh 3, 1, 2, 3, 1, 2, ...; a share
of all words is split by weight, no source gets more than ``most`` times its own words, and what that frees is
shared by weight again. Among all document rates between 0 and ``most`` that meet a source's target, entropy
balancing takes those closest to the design rate ``most`` / 2: the dual has one multiplier per source, and its solution
tilts the odds of a rate exponentially in the document's size. Newton steps on the dual run as Spark aggregates over
(source, size) counts for all sources at once. Rates become whole copies by diffusing the rounding error over a source's sizes, from
long to short, so that a source's words end within about one short document of the target.

Defined cases: a null text has size 0, an empty one too; documents of size 0 are kept once at most and count nothing; a null source is a source
of its own; repeated rows are documents of their own; an empty table or one without words gives targets of 0; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import cut, decide, fresh

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
#: Residual, relative to the target, at which the Newton iteration ends; steps after which it ends anyway.
CLOSE, STEPS = 1e-6, 40
#: Documents that share a source and a size are ranked in buckets of about so many.
BUCKET = 4096


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source key and number of words."""
    return cut(docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("skey"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: key, documents, words and target. One row per source is all that the windows see."""
    by_source = sized.groupBy("skey").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy((F.col("skey") == "").cast("int"), "skey")
    place = (F.row_number().over(order) - 1) % len(weights)
    weighed = by_source.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    # sources reach their bound in the order of words per weight; all that do so at the common level are bounded
    rising = Window.orderBy(F.col("source_size") / F.col("w"), "skey")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    bound = F.col("source_size") * most
    level = bound / F.col("w") * F.sum("w").over(after) + F.coalesce(F.sum(bound).over(before), F.lit(0.0))
    found = weighed.withColumn("all", F.sum("source_size").over(whole) * share).withColumn("full", level <= F.col("all"))
    free = F.col("all") - F.coalesce(F.sum(F.when(F.col("full"), bound)).over(whole), F.lit(0.0))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)
    return found.select("skey", "n", "source_size", "full",
                        F.when(F.col("full"), bound).otherwise(F.least(bound, free * F.col("w") / open_w)).alias("target"))


def _rate(size: Column, tilt: Column, most: float) -> Column:
    return most / (1 + F.exp(-tilt * size))


def balance(cells: DataFrame, wanted: DataFrame, most: float = MOST) -> DataFrame:
    """``wanted`` with ``tilt``, the multiplier of each source; sources at their bound need none."""
    spark = cells.sparkSession
    state = wanted.filter(~F.col("full")).select(
        "skey", "target", (F.col("source_size") / F.col("n")).alias("scale"), F.lit(0.0).alias("tilt"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(float("inf")).alias("off"))
    state = cut(state, "tilts")
    for _ in range(STEPS):
        words = F.col("size") * F.col("count")
        at = F.col("size") / F.col("scale")
        rate = _rate(at, F.col("tilt"), most)
        sums = cells.join(state, "skey").groupBy("skey").agg(
            F.sum(words * rate).alias("got"), F.sum(words * at * rate * (1 - rate / most)).alias("slope"))
        miss = F.col("target") - F.col("got")
        low = F.when(miss > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("high")).otherwise(F.col("tilt"))
        step = F.col("tilt") + F.greatest(F.lit(-8.0), F.least(F.lit(8.0), miss / F.col("slope")))
        inside = (step > low) & (step < high)
        middle = F.when(F.isnan(low + high) | (F.abs(low + high) == float("inf")), step).otherwise((low + high) / 2)
        state = cut(state.join(sums, "skey").select(
            "skey", "target", "scale",
            F.when(F.abs(miss) <= CLOSE * F.col("target"), F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
            low.alias("low"), high.alias("high"), (F.abs(miss) / F.col("target")).alias("off")), "tilts")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= CLOSE:
            break
    return wanted.join(state.select("skey", "scale", "tilt"), "skey", "left")


def _whole_copies(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies of a source's documents by size, long ones first; each takes up what the ones before were off."""
    cells = cells.sort_values("size", ascending=False)
    owed = 0.0
    out = np.zeros(len(cells), np.int64)
    for i, (size, n, rate, most) in enumerate(zip(cells["size"], cells["count"], cells["rate"], cells["most"])):
        owed += n * rate * size
        out[i] = min(max(round(owed / size), 0), int(most) * n)
        owed -= float(out[i]) * size
    return cells.assign(copies=out)[["skey", "size", "count", "copies"]]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: size, its source's words and target, its rate, copies and words taken."""
    sized = sizes(docs, id_col, text_col, source_col)
    wanted = cut(targets(sized, weights, share, most), "targets")
    cells = cut(sized.filter("size > 0").groupBy("skey", "size").count(), "cells")
    solved = cut(balance(cells, wanted, most), "solved")
    rated = cells.join(solved.filter("target > 0"), "skey").withColumns({
        "rate": F.when(F.col("full"), most).otherwise(_rate(F.col("size") / F.col("scale"), F.col("tilt"), most)),
        "most": F.lit(most)})
    # a group has one row per distinct size of a source, however many documents there are
    whole = cut(rated.groupBy("skey").applyInPandas(
        _whole_copies, "skey string, size long, count long, copies long"), "copies")
    # a size's copies are dealt to buckets of its documents, then to the documents of a bucket
    bucket = F.pmod(F.xxhash64("doc_id", F.lit("bucket")), F.ceil(F.col("count") / BUCKET))
    dealt = sized.filter("size > 0").join(whole, ["skey", "size"]).withColumn("bucket", bucket)
    counts = dealt.groupBy("skey", "size", "count", "copies", "bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
    upto = F.sum("in_bucket").over(Window.partitionBy("skey", "size").orderBy("bucket"))
    parts = counts.withColumn("upto", upto).select(
        "skey", "size", "bucket", "in_bucket",
        F.expr("copies * upto div count - copies * (upto - in_bucket) div count").alias("part"))
    rank = F.row_number().over(Window.partitionBy("skey", "size", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id"))
    each = dealt.drop("copies").withColumn("rank", rank).join(parts, ["skey", "size", "bucket"]).withColumn(
        "copies", F.expr("part div in_bucket + CAST(rank <= part % in_bucket AS BIGINT)"))
    empty = sized.filter("size = 0").withColumn("copies", F.lit(1).cast("long"))
    columns = ["doc_id", "text_hash", "skey", "size", "copies"]
    taken = each.select(*columns).unionByName(empty.select(*columns))
    return taken.join(wanted.select("skey", "source_size", "target"), "skey").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        F.when(F.col("skey") != "", F.expr("substr(skey, 2)")).alias("source"), "text_hash")


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    found = mix(docs, id_col, text_col, source_col).withColumnRenamed("doc_id", id_col)
    times = decide(docs, found, "copies", id_col, text_col)
    n = times.columns[-1]
    each = F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))
    return times.filter(F.col(n) > 0).withColumn(fresh(times, "copy")[0], each).select(*docs.columns)
