"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.session import configure
from millrace.sinks.workspace import cut

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A small table between two steps, of which there are many here, is one file and one task and not one of each per core.
SMALL_PART = ("spark.sql.adaptive.coalescePartitions.minPartitionSize", "8m")
__all__ = ["settled", "table", "cut", "ascii_lower", "id_key", "held_out", "decide", "text_bytes", "fresh", "slices", "per_process"]


def settled(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators of this package rely on."""
    configure(spark).conf.set(*SMALL_PART)
    return spark


def per_process(name: str, make: Callable[[], object]) -> object:
    """``make()``, kept for later tasks of a worker; functions that travel by value bring no state of their own."""
    kept = vars(sys).setdefault("_llm_kept", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def id_key(id_col: str) -> Column:
    """Join key of an id that may be null: its text, empty for null."""
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def held_out(id_col: str) -> Column:
    """True for the fifth of the ids that no model may learn from; a null id counts as empty text."""
    return F.crc32(id_key(id_col)) % 5 == 0


def decide(docs: DataFrame, decisions: DataFrame, value: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one more column, the last: how often each row stays.

    ``decisions`` has one row per document with its id, ``text_hash`` (xxhash64 of the text) and ``value``
    (how often that document stays). Rows that repeat an id and a text share the sum of their decisions, the
    first ones getting the larger parts; with the decision "one of them stays" exactly one does. Docs move once.
    """
    key, part, total, rank, rows, copies = fresh(docs, "key", "part", "total", "rank", "rows", "copies")
    per_key = decisions.groupBy(id_key(id_col).alias(key), F.col("text_hash").alias(part)).agg(
        F.sum(F.col(value).cast("long")).alias(total))
    keyed = docs.withColumns({key: id_key(id_col), part: F.xxhash64(F.col(text_col))})
    same = Window.partitionBy(key, part)
    ranked = keyed.join(per_key, [key, part]).withColumns({
        rank: F.row_number().over(same.orderBy(F.lit(0))), rows: F.count(F.lit(1)).over(same)})
    k, m, t = F.col(rank), F.col(rows), F.col(total)
    share = F.floor((t * k + m - 1) / m) - F.floor((t * (k - 1) + m - 1) / m)
    return ranked.select(*docs.columns, share.alias(copies))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, marked so that no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    mark = "_"
    while any(mark + n in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or of one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to
