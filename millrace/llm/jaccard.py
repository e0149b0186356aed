"""Near-duplicate join on word shingles with Bayesian candidate pruning.

Documents with the same set of shingles form a class; the join works on classes. MinHash signatures are cut into
bands; classes that agree in a band meet in a bucket. There, signatures are compared a step at a time: a pair is
dropped once the posterior probability (uniform prior) that its similarity reaches the threshold falls below
``TOLERANCE``. A pair that survives counts in the first band it agrees in. What leaves a bucket is its classes with such a
pair, not the pairs, so a group of n near copies gives some n rows, not n squared, and texts move only to the buckets where
they are wanted: a few, one for each band at most, however large a chain of groups is. There the same pairs are checked exactly on their shingles, block against
block, and each class gets the number of its links and one link towards its group's first class. Bands are as wide as
miss a pair at the threshold with a probability of at most ``MISS``.

Defined cases: a null text is empty; a text without words links with nothing; one of fewer than five words has one
shingle, of all its words; a null id is the smallest; rows that repeat an id and a text are copies of each other; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut, decide, id_key
from millrace.llm.linking import block_roots, components, sorted_groups
from millrace.llm.shingles import MIX_1, mixed, shingle_sets

WORDS, THRESHOLD = 5, 0.8
HASHES, STEP = 128, 16
MISS, TOLERANCE = 4e-6, 1e-6
#: Members of a bucket that one task compares with as many others by their signatures, and by their texts.
BUCKET_BLOCK, VERIFY_BLOCK = 768, 384
LEAST_ID = -(2 ** 63)
SKETCH = "doc_id long, text_hash long, n_shingles int, key1 long, key2 long, sig binary"


def _factors() -> np.ndarray:
    return mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * MIX_1) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest 32-bit value of the shingles under each hash function."""
    a, b = _factors()[:HASHES], _factors()[HASHES:]
    best = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingles), 2048):
        values = (shingles[at:at + 2048, None] * a + b) >> np.uint64(32)
        best = np.minimum(best, values.min(axis=0).astype(np.uint32))
    return best


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per document: number of shingles, two checksums of their set, and the signature."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([t or "" for t in batch.column(2).to_pylist()], words)
            out: list[tuple] = [(len(s), mixed(s).sum(dtype=np.uint64), mixed(s ^ MIX_1).sum(dtype=np.uint64),
                                 signature(s).tobytes()) for s in sets]
            n, k1, k2, sig = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(np.array(k1, np.uint64).view(np.int64)),
                 pa.array(np.array(k2, np.uint64).view(np.int64)), pa.array(sig, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "key1", "key2", "sig"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))
    return cut(read.mapInArrow(sketch, SKETCH).withColumn("row", F.monotonically_increasing_id()), "sketches")


def bands_and_rows(threshold: float = THRESHOLD) -> tuple[int, int]:
    """The most rows a band can have, and the bands it then takes to miss a pair at the threshold with ``MISS`` at most."""
    for rows in range(HASHES, 0, -1):
        agree = threshold ** rows
        bands = ceil(log(MISS) / log1p(-agree)) if 0 < agree < 1 else int(agree >= 1) or HASHES + 1
        if bands * rows <= HASHES:
            return bands, rows
    raise ValueError(f"{HASHES} hashes cannot find pairs at {threshold} with a miss of {MISS}")


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """After 16, 32, ... hashes: the fewest matches with which a pair still has a chance above the tolerance."""
    grid = (np.arange(4000) + 0.5) / 4000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid) + lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            if np.exp(logs)[grid >= threshold].mean() * (grid >= threshold).mean() >= tolerance:
                break
        out.append(m)
    return out


def surviving(left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks of signatures that no step of the comparison drops."""
    found = []
    for at in range(0, len(left), 128):
        same = np.zeros((min(128, len(left) - at), len(right)), np.uint8)
        for k in range(STEP):
            same += left[at:at + 128, None, k] == right[None, :, k]
        i, j = np.nonzero(same >= least[0])
        m = same[i, j].astype(np.int32)
        i += at
        for step in range(1, HASHES // STEP):
            part = slice(step * STEP, (step + 1) * STEP)
            m += (left[i, part] == right[j, part]).sum(axis=1)
            keep = m >= least[step]
            i, j, m = i[keep], j[keep], m[keep]
        found.append((i, j))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def in_blocks(rows: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """``rows`` dealt to block pairs (p, q) of their group, so that every two members meet in one; ``at`` is a row's own block."""
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("row", F.lit(block)), n).cast("int")
    others = F.sequence(F.lit(0), n - 1)
    dealt = rows.withColumn("at", own).withColumn("other", F.explode(others))
    return dealt.withColumns({"p": F.least("at", "other"), "q": F.greatest("at", "other")}).drop("other", size)


def _in_first_band(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, band: int, rows: int) -> np.ndarray:
    """Which of the index pairs of two blocks of signatures agree in the band and in none before it."""
    out = np.ones(len(i), bool)
    for lo in range(0, len(i), 1 << 15):
        a, b = left[i[lo:lo + (1 << 15)]], right[j[lo:lo + (1 << 15)]]
        for k in range(band):
            out[lo:lo + len(a)] &= (a[:, k * rows:(k + 1) * rows] != b[:, k * rows:(k + 1) * rows]).any(axis=1)
    return out


def candidates(reps: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(bucket, band, row): classes with a partner that survives the comparison and that they meet in this bucket first.

    A pair counts in the first band it agrees in, so most pairs of a group count in a few buckets, and only there the
    classes' texts are needed.
    """
    bands, rows = bands_and_rows(threshold)
    band = F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))
    banded = reps.select("row", "sig", band.alias("band")).select(
        "row", "band", F.xxhash64("band", F.substring(F.col("sig"), F.col("band") * 4 * rows + 1, F.lit(4 * rows))).alias("bucket"))
    # of buckets with the same members that of the first band is enough: their pairs agree there
    members = banded.groupBy("bucket", "band").agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("first"),
                                                   F.sum(F.xxhash64("row").cast("decimal(20,0)")).alias("sum")).filter("size > 1")
    buckets = members.groupBy("size", "first", "sum").agg(F.min(F.struct("band", "bucket")).alias("b")).select("b.band", "b.bucket", "size")
    met = banded.join(buckets, ["bucket", "band"]).join(reps.select("row", "sig"), "row")
    dealt = in_blocks(met, "bucket", "size", BUCKET_BLOCK).select("bucket", "p", "q", "at", "row", "band", "sig")
    least = least_matches(threshold)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in sorted_groups(batches, 3):
            bucket, p, q, at, row, own = (table.column(k).to_numpy() for k in range(6))
            sigs = np.frombuffer(b"".join(table.column(6).to_pylist()), np.uint32).reshape(-1, HASHES)
            found = []
            for lo, hi in zip(edges, edges[1:]):
                part, same = slice(lo, hi), p[lo] == q[lo]
                if hi - lo == 2 and same:  # the most frequent case
                    i, j = np.array([0]), np.array([1])
                    if all((sigs[lo, :n] == sigs[lo + 1, :n]).sum() >= m for n, m in zip(range(STEP, HASHES + 1, STEP), least)):
                        if _in_first_band(sigs[part], sigs[part], i, j, own[lo], rows)[0]:
                            found.append(np.arange(lo, hi))
                    continue
                left = np.flatnonzero(at[part] == p[lo])
                right = left if same else np.flatnonzero(at[part] == q[lo])
                i, j = surviving(sigs[part][left], sigs[part][right], least)
                if same:
                    i, j = i[i < j], j[i < j]
                i, j = left[i], right[j]
                here = _in_first_band(sigs[part], sigs[part], i, j, own[lo], rows)
                found.append(lo + np.unique(np.concatenate((i[here], j[here]))))
            if found:
                some = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (bucket, own, row)], ["bucket", "band", "row"])

    return dealt.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "row").mapInArrow(
        link, "bucket long, band int, row long").distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Shared shingles of the pairs (i, j) of two blocks."""
    if len(i) <= 4 * (len(left) + len(right)):
        return np.array([len(np.intersect1d(left[x], right[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    shared = np.zeros((len(left), len(right)))
    for lo in range(0, len(both), 4096):
        part = both[lo:lo + 4096]
        has = []
        for block in (left, right):
            matrix = np.zeros((len(block), len(part)), np.float32)
            for k, s in enumerate(block):
                s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], "right")]
                at = np.minimum(np.searchsorted(part, s), len(part) - 1)
                matrix[k, at[part[at] == s]] = 1
            has.append(matrix)
        shared += has[0] @ has[1].T
    return shared[i, j].astype(np.int64)


def verified_links(members: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """Per class and block: documents of other classes it links with, and a class of its group it leads to.

    ``members``: bucket, its band and size, row, documents of the class, signature, text.
    """
    _, band_rows = bands_and_rows(threshold)
    dealt = in_blocks(members, "bucket", "size", VERIFY_BLOCK).select(
        "bucket", "p", "q", "at", "row", "n_docs", "band", "sig", "text")
    least = least_matches(threshold)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in sorted_groups(batches, 3):
            p, q, at, row, n_docs, band = (table.column(k).to_numpy() for k in range(1, 7))
            sigs = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint32).reshape(-1, HASHES)
            for lo, hi in zip(edges, edges[1:]):
                part = slice(lo, hi)
                left = np.flatnonzero(at[part] == p[lo])
                right = left if p[lo] == q[lo] else np.flatnonzero(at[part] == q[lo])
                i, j = surviving(sigs[part][left], sigs[part][right], least)
                if p[lo] == q[lo]:
                    i, j = i[i < j], j[i < j]
                here = _in_first_band(sigs[part][left], sigs[part][right], i, j, band[lo], band_rows)
                i, j = i[here], j[here]
                if not len(i):
                    continue
                sets = list(shingle_sets([t or "" for t in table.column(8).slice(lo, hi - lo).to_pylist()], words))
                counts = np.array([len(s) for s in sets])
                shared = _overlaps([sets[x] for x in left], [sets[x] for x in right], i, j)
                i, j = left[i], right[j]
                near = shared >= threshold * (counts[i] + counts[j] - shared) - 1e-9
                i, j = i[near], j[near]
                linked = np.zeros((hi - lo, hi - lo), bool)
                linked[i, j] = linked[j, i] = True
                some = np.flatnonzero(linked.any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[part][some]), pa.array((linked[some] @ n_docs[part]).astype(np.int64)),
                     pa.array(row[part][block_roots(linked)[some]])], ["row", "links", "towards"])

    return dealt.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "row").mapInArrow(
        verify, "row long, links long, towards long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its class and the class's size, its links, its group, and whether it is the one that stays.

    ``n_links`` counts the other documents at or above the threshold, copies included; ``component_id`` is the
    smallest id of the group that links connect; the document of that id stays.
    """
    sketched = sketches(docs, id_col, text_col, words)
    number = F.coalesce("doc_id", F.lit(LEAST_ID))
    with_words = sketched.filter("n_shingles > 0")
    classes = cut(with_words.groupBy("key1", "key2", "n_shingles").agg(
        F.min_by("row", number).alias("rep"), F.min(number).alias("class_id"), F.count(F.lit(1)).alias("n_docs")), "classes")
    reps = cut(with_words.select("row", "text_hash", "doc_id", "sig").join(
        classes.select(F.col("rep").alias("row"), "class_id", "n_docs"), "row"), "representatives")
    found = cut(candidates(reps, threshold), "candidates")
    sized = found.join(found.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "bucket")
    # as many buckets per class as there are bands, at most
    buckets = sized.groupBy("row").agg(F.collect_list(F.struct("bucket", "band", "size")).alias("buckets"))
    members = reps.join(buckets, "row").withColumn("id_key", id_key("doc_id"))
    texts = docs.select(id_key(id_col).alias("id_key"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    # rows that repeat an id and a text are one class, so one of them stands for it
    whole = texts.join(members, ["id_key", "text_hash"]).dropDuplicates(["id_key", "text_hash"])
    dealt = whole.select("row", "n_docs", "sig", "text", F.explode("buckets").alias("b")).select("row", "n_docs", "sig", "text", "b.*")
    links = cut(verified_links(dealt, words, threshold), "links")
    groups = components(links.select(F.col("row").alias("a"), F.col("towards").alias("b")))
    by_class = reps.select("row", "class_id", "n_docs").join(
        links.groupBy("row").agg(F.sum("links").alias("links")), "row", "left").join(
        groups.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    firsts = by_class.groupBy("root").agg(F.min("class_id").alias("component_id"), F.min_by("row", "class_id").alias("first"))
    found = cut(by_class.join(firsts, "root").select(F.col("row").alias("rep"), "links", "component_id", "first"), "groups")
    by_key = cut(classes.join(found, "rep"), "by_class")
    nothing = sketched.filter("n_shingles = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "text_hash")
    real = lambda c: F.when(F.col(c) != LEAST_ID, F.col(c)).alias(c)
    return with_words.drop("sig").join(by_key, ["key1", "key2", "n_shingles"]).select(
        "doc_id", real("class_id"), F.col("n_docs").alias("class_size"),
        (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), real("component_id"),
        (F.col("row") == F.col("first")).alias("kept"), "text_hash").unionByName(nothing)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group."""
    found = near_duplicates(docs, id_col, text_col).withColumnRenamed("doc_id", id_col)
    decided = decide(docs, found, "kept", id_col, text_col)
    return decided.filter(F.col(decided.columns[-1]) > 0).select(*docs.columns)
