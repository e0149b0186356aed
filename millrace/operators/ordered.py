"""Ordered neighbours and ranks that survive a hot key.

A plain window puts all rows of a key into one task. Here the key is cut into time chunks
(a minute by default): windows run per (key, chunk), a small per-chunk summary carries the
boundary values, and both are joined on (key, chunk). The heaviest task holds one chunk. Rows with a
null key are a key of their own; rows with a null time come before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import null_safe
from millrace.sinks.workspace import cut


def with_neighbours(df: DataFrame, keys: list[str], time: str, ties: list[str], value: list[str],
                    grain: str = "minute") -> DataFrame:
    """Add ``row_no`` (1-based), ``prev`` and ``next`` (structs of ``value``) per key in time order."""
    chunked = df.withColumn("_chunk", F.date_trunc(grain, F.col(time)))
    order = [F.col(time), *[F.col(t) for t in ties]]
    local = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    picked = F.struct(*[F.col(v) for v in value])
    inner = (chunked.withColumn("_rn", F.row_number().over(local))
             .withColumn("_next", F.lead(picked).over(local))
             .withColumn("_prev", F.lag(picked).over(local)))
    edge = F.struct(F.col(time).alias("_t"), *[F.col(t).alias(f"_k{i}") for i, t in enumerate(ties)],
                    picked.alias("v"))
    chunks = chunked.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), F.min(edge)["v"].alias("_first"), F.max(edge)["v"].alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    before = F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1))
    chunks = chunks.select(*keys, "_chunk", F.coalesce(before, F.lit(0)).alias("_before"),
                           F.lead("_first").over(across).alias("_after_first"),
                           F.lag("_last").over(across).alias("_before_last"))
    return null_safe(inner, chunks, [*keys, "_chunk"]).select(
        *df.columns, (F.col("_rn") + F.col("_before")).alias("row_no"),
        F.coalesce("_prev", "_before_last").alias("prev"),
        F.coalesce("_next", "_after_first").alias("next"))


def running_max(df: DataFrame, keys: list[str], time: str, ties: list[str], value: str, out: str,
                grain: str = "minute") -> DataFrame:
    """Maximum of ``value`` over the strictly earlier rows of the key (in time, then tie order)."""
    chunked = df.withColumn("_chunk", F.date_trunc(grain, F.col(time)))
    local = (Window.partitionBy(*keys, "_chunk").orderBy(F.col(time), *[F.col(t) for t in ties])
             .rowsBetween(Window.unboundedPreceding, -1))
    inner = chunked.withColumn("_in", F.max(value).over(local))
    chunks = chunked.groupBy(*keys, "_chunk").agg(F.max(value).alias("_m"))
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(*keys, "_chunk", F.max("_m").over(across).alias("_prior"))
    joined = null_safe(inner, chunks, [*keys, "_chunk"])
    return joined.select(*df.columns, F.greatest("_in", "_prior").alias(out))


def global_rank(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Position of each row in a total order without a single-task window.

    Range sort, row position inside each sorted partition, plus the row counts of the
    partitions before it. The sorted rows are cut once so both uses see the same partitions.
    """
    placed = cut(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    part = F.shiftright("_pos", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per sort partition
    run = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_off"))
    inner = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).join(offsets, "_part")
            .withColumn(out, F.col("_off") + inner + 1).select(*df.columns, out))
