"""Packing of tokenised documents into sequences by minimum bin slack.

Documents become token ids plus an end id; those longer than a sequence are cut into whole sequences, the first
piece taking the rest. Packing looks only at how many pieces there are of each length: a table of at most
``capacity`` rows. A bin starts with the longest piece left; a subset-sum over the lengths left, kept as bits of an
integer, finds the combination that leaves the least slack. The combination is used for as many bins as the counts
allow, so every search uses up a length: at most the sum of capacity / length searches, whatever the input's size.
Pieces get their places from their rank among pieces of the same length, counted in buckets.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; an empty table gives no rows; a
text of any length is read whole; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import cut, per_process

CAPACITY, END_ID = 1024, 2
BUCKET = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Encoder:
    """Ids of texts by a byte-level BPE file of the ``tokenizers`` library.

    The file's vocabulary ranks its merges, so ``tiktoken`` finds the same ids in a fraction of the time; a text
    that holds an added token's string goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.own = Tokenizer.from_file(path)
        self.added = [t["content"] for t in model["added_tokens"]]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(shown[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in self.added}
        self.fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(t in text for t in self.added):
            return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")


def encoder(path: str) -> _Encoder:
    return per_process(f"encoder {path}", lambda: _Encoder(path))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: its place in the document, its length and the checksum of its ids."""
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                edges = [0, *range(len(ids) % capacity or min(capacity, len(ids)), len(ids) + 1, capacity)]
                out += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(cut_up, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, and how often each, with the largest sum up to ``room``; of equal sums the one with longer pieces."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left:
            step = min(step, left)
            more = (reach << (step * length)) & mask
            if more | reach != reach:
                steps.append((length, step, reach))
                reach |= more
            left -= step
            step *= 2
        if reach >> room:
            break
    total, used = reach.bit_length() - 1, {}
    for length, step, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + step
            total -= step * length
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset) that place every piece."""
    left = {n: c for n, c in counts.items() if c}
    ranks = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        used = fullest({n: c for n, c in rest.items() if c}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // k for n, k in used.items())
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            rows.append((n, ranks[n], k, sequence, offset))
            offset += n * k
            ranks[n] += times * k
            left[n] -= times * k
            if not left[n]:
                del left[n]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` with the sequence and the offset there of each."""
    counts = cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("of_length"))
    by_length = {r["length"]: r["of_length"] for r in counts.collect()}  # at most ``capacity`` rows
    rows = plan(by_length, capacity)
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.ceil(F.col("of_length") / BUCKET))
    dealt = cut_pieces.join(counts, "length").withColumn("bucket", bucket)
    inside = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = inside.withColumn("first", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n"))
    order = Window.partitionBy("length", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("place", F.row_number().over(order) - 1).join(
        starts.drop("n"), ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("place"))

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(np.int64), frame.pop("rank").to_numpy(np.int64)
            at = np.searchsorted(rows[:, 0] << 48 | rows[:, 1], length << 48 | rank, "right") - 1
            _, first, per, sequence, offset = rows[at].T
            yield frame.assign(sequence_id=sequence + (rank - first) // per, offset=offset + (rank - first) % per * length)

    return ranked.select(*cut_pieces.columns, "rank").mapInPandas(put, f"{PIECES}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document with its sequence and its offset there."""
    return place(cut(pieces(docs, path, capacity, end_id, id_col, text_col), "pieces"), capacity)
