"""Near-duplicate vectors by spherical-cap filters with list-decoded product codes.

Unit vectors are turned by seeded random rotations and cut into two blocks; each block has random unit code words, and a
filter is a pair of words. The middle of two vectors at the threshold is at most ``REACH`` away from both, and lies in the filter of the
words it exceeds most. So a vector enters every filter in which a point so near to it can lie; list decoding finds those from the
sorted distances of one block. Two vectors at the threshold thus share a filter, whatever the table: no pair is lost.
The number of filters grows with the table. Of ``CODES`` codes the one is used in which a bounded sample (``SAMPLE`` vectors)
has the fewest pairs to compare; any of them finds all pairs. Vectors of one label that meet in a filter are compared exactly, in
blocks; a pair counts in its first common filter only, and a filter reports links per vector and a spanning forest, not pairs. Equal
vectors are compared once, with their number as weight.

Defined cases: a null label, a null or empty vector, one of length zero or with null or non-finite
components links with nothing; vectors of different dimension do not link; repeated rows are equal vectors and
link with each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut
from millrace.llm.jaccard import in_blocks
from millrace.llm.linking import block_roots, components, sorted_groups

THRESHOLD, CODES, SAMPLE, BLOCK = 0.98, 3, 512, 512
#: Half the distance of unit vectors at the threshold, and a little more for rounding.
REACH = float(np.sqrt((1 - THRESHOLD) / 2)) * 1.001
#: Scores of vectors by words that are held at a time, and best words of a vector that the others are held against.
CELLS, BEST = 1 << 18, 4
#: Vectors of the whole table per filter.
PER_FILTER = 16
#: Members up to which filters are compared together, pairs of such filters at a time, and near pairs whose filters are looked up at a time.
FEW, PAIRS, HITS = 32, 1 << 17, 1 << 14


class Codes:
    """Product codes for vectors of one dimension."""

    def __init__(self, dim: int, n_words: int, seed: int = 7):
        rng = np.random.default_rng([seed, dim, n_words])
        self.n_words, self.half = n_words, max(1, dim // 2)
        self.turns, self.words = [], []
        for _ in range(CODES):
            turn, r = np.linalg.qr(rng.standard_normal((dim, dim)))
            self.turns.append(turn * np.sign(np.diag(r)))
            words = [rng.standard_normal((n_words, d)) for d in (self.half, dim - self.half)]
            self.words.append([_distinct(w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)) for w in words])
        self.code = 0

    def scores(self, vectors: np.ndarray, code: int) -> tuple[np.ndarray, np.ndarray]:
        turned = vectors @ self.turns[code]
        return turned[:, :self.half] @ self.words[code][0].T, turned[:, self.half:] @ self.words[code][1].T

    def set_heights(self, sample: np.ndarray) -> None:
        """Take the code in whose filters the sample has the fewest pairs."""
        pairs = []
        for self.code in range(CODES):
            entered = self.entered(sample)
            sizes = np.unique(np.concatenate(entered), return_counts=True)[1] if entered else np.zeros(1)
            pairs.append((sizes.astype(float) ** 2).sum())
        self.code = int(np.argmin(pairs))

    @property
    def kind(self) -> type:
        """The smallest type that holds a filter's number."""
        return np.int32 if CODES * self.n_words ** 2 < 1 << 31 else np.int64

    def entered(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Sorted filters of each vector; vectors are scored some at a time, however many words there are."""
        step = max(1, CELLS // self.n_words)
        return [f for at in range(0, len(vectors), step) for f in self._entered(vectors[at:at + step])]

    def _entered(self, vectors: np.ndarray) -> list[np.ndarray]:
        away = [_away(scores, words) for scores, words in zip(self.scores(vectors, self.code), self.words[self.code])]
        order = np.argsort(away[1], axis=1)
        found = []
        for a, b, by in zip(*away, order):
            some = np.flatnonzero(a <= REACH)
            reach = np.searchsorted(b[by], np.sqrt(REACH ** 2 - a[some] ** 2), "right")  # words of the right block that suffice
            found.append(np.sort(np.concatenate([w * self.n_words + by[:n] for w, n in zip(some, reach)]) + self.code * self.n_words ** 2).astype(self.kind))
        return found


def _distinct(words: np.ndarray) -> np.ndarray:
    """Words that differ: a block of one dimension has two at most, an empty one has one."""
    return np.unique(words, axis=0) if words.shape[1] else words[:1]


def _away(scores: np.ndarray, words: np.ndarray) -> np.ndarray:
    """How far vectors have to move, at least, for each word to be the one they exceed most: 0 for the best.

    A word takes over from a better one half way between them, so that is (difference of scores) / (distance of the words) away.
    The few best words are tried; with fewer the distances only get smaller, and vectors enter more filters.
    """
    best = np.argpartition(-scores, min(BEST, scores.shape[1]) - 1, axis=1)[:, :BEST]
    away = np.zeros_like(scores)
    for word in best.T:
        apart = 2 - 2 * (words[word] @ words.T)
        ahead = np.take_along_axis(scores, word[:, None], axis=1) - scores
        np.divide(ahead, np.sqrt(np.maximum(apart, 1e-12)), out=ahead)
        ahead[apart < 1e-12] = 0  # one word, but for rounding
        np.maximum(away, ahead, out=away)
    return away


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """One row per vector: number, id, label, dimension and components; no dimension if it links with nothing.

    Single-precision components stay so wherever they are moved, and become doubles where they are compared.
    """
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    given = F.col(vector_col).cast("array<float>" if single else "array<double>")
    bad = F.exists(given, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    usable = F.col(label_col).isNotNull() & given.isNotNull() & ~bad & F.exists(given, lambda x: x != 0)
    return cut(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"), F.when(usable, F.size(given)).alias("dim"),
        F.when(usable, given).alias("vector")), "vectors")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vectors it links with, smallest id that links reach, and whether that is its own."""
    base = unit_vectors(vectors, id_col, vector_col, label_col)
    usable = base.filter("dim IS NOT NULL")
    classes = cut(usable.groupBy("label", "dim", "vector").agg(
        F.min("row").alias("rep"), F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("weight")), "classes")
    sizes = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}  # one row per dimension
    codes = {}
    for dim, n in sizes.items():
        codes[dim] = Codes(dim, int(max(16, np.ceil(np.sqrt(n / PER_FILTER)))))
        drawn = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("vector"), "rep").select("vector").limit(SAMPLE).collect()
        sample = np.array([r["vector"] for r in drawn])
        codes[dim].set_heights(_units(sample))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            flat = batch.column(2).flatten().to_numpy()
            ends = np.cumsum(dims)
            filters: list[bytes] = [b""] * len(dims)
            spread: list[list[int]] = [[]] * len(dims)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                matrix = _units(np.stack([flat[ends[i] - dim:ends[i]] for i in rows]))
                for i, f in zip(rows, codes[dim].entered(matrix)):
                    filters[i], spread[i] = f.tobytes(), f.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(filters, pa.binary()), pa.array(spread, pa.list_(pa.int64()))],
                                             ["rep", "filters", "each"])

    entered = cut(classes.select("rep", "dim", "vector").mapInArrow(enter, "rep long, filters binary, each array<long>"), "filters")
    met = entered.select("rep", F.explode("each").alias("filter")).join(classes.select("rep", "label", "dim"), "rep")
    counts = met.groupBy("label", "dim", "filter").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumn(
        "bucket", F.xxhash64("label", "dim", "filter"))
    rows = met.join(counts, ["label", "dim", "filter"]).join(entered.select("rep", "filters"), "rep").join(
        classes.select("rep", "vector", "weight"), "rep").withColumnRenamed("rep", "row")
    dealt = in_blocks(rows, "bucket", "size", BLOCK).select(
        "bucket", "label", "dim", "filter", "p", "q", "at", "row", "weight", "filters", "vector")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in sorted_groups(batches, 6):
            dims, names, p, q, at, row, weight = (table.column(k).to_numpy() for k in (2, 3, 4, 5, 6, 7, 8))
            lists = table.column(9).to_pylist()
            flat = table.column(10).combine_chunks().flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(dims, dtype=np.int64)))
            sizes = np.diff(edges)
            few = (sizes <= FEW) & (p[edges[:-1]] == q[edges[:-1]])
            for dim in np.unique(dims):
                # rows of one dimension: their vectors are scaled once, their filters stand side by side
                own = np.flatnonzero(dims == dim)
                units = _units(flat[ends[own][:, None] + np.arange(dim)])
                filters = _Filters([np.frombuffer(lists[k], codes[int(dim)].kind) for k in own], CODES * codes[int(dim)].n_words ** 2 + 1)
                place = np.full(len(dims), -1)
                place[own] = np.arange(len(own))
                for a, b in _few_hits(units, place[edges[:-1][few & (dims[edges[:-1]] == dim)]], sizes[few & (dims[edges[:-1]] == dim)]):
                    first = filters.meet_first(a, b, names[own[a]])
                    i, j = own[a[first]], own[b[first]]
                    yield _links(np.concatenate((row[i], row[j])), np.concatenate((weight[j], weight[i])), np.tile(np.minimum(row[i], row[j]), 2))
                for lo, hi in zip(edges[:-1][~few], edges[1:][~few]):
                    if dims[lo] != dim:
                        continue
                    matrix, start = units[place[lo]:place[lo] + hi - lo], place[lo]
                    left = np.flatnonzero(at[lo:hi] == p[lo])
                    right = left if p[lo] == q[lo] else np.flatnonzero(at[lo:hi] == q[lo])
                    i, j = np.nonzero(matrix[left] @ matrix[right].T >= THRESHOLD)
                    if p[lo] == q[lo]:
                        i, j = i[i < j], j[i < j]
                    i, j = left[i], right[j]
                    first = filters.meet_first(start + i, start + j, np.full(len(i), names[lo]))
                    linked = np.zeros((hi - lo, hi - lo), bool)
                    linked[i[first], j[first]] = linked[j[first], i[first]] = True
                    some = np.flatnonzero(linked.any(axis=1))
                    yield _links(row[lo:hi][some], linked[some] @ weight[lo:hi], row[lo:hi][block_roots(linked)[some]])

    keys = ["bucket", "label", "dim", "filter", "p", "q"]
    links = cut(dealt.repartition(*keys).sortWithinPartitions(*keys, "row").mapInArrow(compare, "row long, links long, towards long"), "links")
    groups = components(links.select(F.col("row").alias("a"), F.col("towards").alias("b")))
    by_class = classes.select(F.col("rep").alias("row"), "class_id", "weight").join(
        links.groupBy("row").agg(F.sum("links").alias("links")), "row", "left").join(
        groups.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    smallest = by_class.groupBy("root").agg(F.min("class_id").alias("component_id"))
    found = cut(by_class.join(smallest, "root").select(F.col("row").alias("rep"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                                       "component_id"), "groups")
    by_vector = cut(classes.select("label", "dim", "vector", "rep").join(found, "rep").drop("rep"), "by_vector")
    joined = usable.join(by_vector, ["label", "dim", "vector"]).select("vec_id", "n_links", "component_id")
    alone = base.filter("dim IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(rows: np.ndarray, links: np.ndarray, towards: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (rows, links, towards)], ["row", "links", "towards"])


def _few_hits(units: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a < b) at the threshold within small groups of neighbouring rows: groups of one size are multiplied together.

    Products in single precision choose, those in double precision decide.
    """
    single = units.astype(np.float32)
    for size in np.unique(sizes).tolist():
        own = starts[sizes == size]
        step = max(1, PAIRS // (size * size))
        above = np.triu(np.ones((size, size), bool), 1)
        for at in range(0, len(own), step):
            rows = own[at:at + step, None] + np.arange(size)
            block = single[rows]
            group, i, j = np.nonzero((block @ block.transpose(0, 2, 1) >= THRESHOLD - 1e-4) & above)
            a, b = rows[group, i], rows[group, j]
            near = np.einsum("ij,ij->i", units[a], units[b]) >= THRESHOLD
            yield a[near], b[near]


class _Filters:
    """Sorted filters of rows as one sorted array of (row, filter) numbers."""

    def __init__(self, lists: list[np.ndarray], span: int):
        counts = np.array([len(x) for x in lists], np.int64)
        self.span, self.begin = span, np.cumsum(counts) - counts
        values = np.concatenate(lists).astype(np.int64) if lists else np.empty(0, np.int64)
        self.keys = values + np.repeat(np.arange(len(lists)), counts) * span

    def meet_first(self, a: np.ndarray, b: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Whether the filter ``name``, in which rows a and b meet, is the first that both are in."""
        out = np.ones(len(a), bool)
        for lo in range(0, len(a), HITS):
            x, y, here = a[lo:lo + HITS], b[lo:lo + HITS], name[lo:lo + HITS]
            before = np.searchsorted(self.keys, x * self.span + here) - self.begin[x]
            pair = np.repeat(np.arange(len(x)), before)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(before) - before, before) + np.repeat(self.begin[x], before)
            wanted = self.keys[at] + (y - x)[pair] * self.span
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            out[lo + pair[self.keys[place] == wanted]] = False
        return out


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows as doubles of length one; scaled by their largest component first, so that no square over- or underflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
