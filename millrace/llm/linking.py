"""Connected components of links, and groups of sorted rows in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): root is the smallest node it is linked to, itself included.

    Each round takes the smallest label among neighbours and then the label's own label; the rows of a round are one
    per node, labels are reduced before they are shuffled, and every round is written to the shared folder.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .filter("a <> b").distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        low = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("further"))
        found = cut(low.join(jump, "low", "left").select(
            "node", "was", F.least("low", F.coalesce("further", "low")).alias("root")), "labels")
        labels = found.select("node", "root")
        if not found.filter("was <> root").limit(1).count():
            return labels


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and where these begin and end, of rows sorted by the first ``n_keys`` columns."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        edges = _edges(table, n_keys)
        if len(edges):
            last = int(edges[-1])
            yield table.slice(0, last), np.concatenate(([0], edges))
            table = table.slice(last)
        rest = table
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def _edges(table: pa.Table, n_keys: int) -> np.ndarray:
    new = np.zeros(max(0, len(table) - 1), bool)
    for k in range(n_keys):
        column = table.column(k).to_numpy()
        new |= column[1:] != column[:-1]
    return np.flatnonzero(new) + 1


def block_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index each index is linked to, directly or not, by a symmetric boolean matrix."""
    roots = np.arange(len(linked))
    while True:
        near = np.where(linked, roots[None, :], len(linked)).min(axis=1, initial=len(linked))
        low = np.minimum(roots, near)
        low = low[low]
        if (low == roots).all():
            return roots
        roots = low
