"""Exact dedup by chunk recipes, in DataFrame functions only.

A text is lower-cased in A-Z and cut at content-defined places: the first sentence end or line end beyond the
shortest chunk, or the longest chunk. Each chunk becomes a short identifier: its 64-bit hash, plus a number
that tells apart different chunks (different length or SHA-256) which share the hash. Texts are equal when
their ordered identifier lists are. Texts themselves never move; only identifiers are shuffled.

Defined cases: a null text is the empty one; a null id is the smallest; rows that repeat an id and a text are
members like any other and exactly one row of a group is kept; an empty table gives an empty result; columns
besides the two named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import ascii_lower, cut, decide

SHORTEST, LONGEST = 1024, 4096
LEAST_ID = -(2 ** 63)


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """One row per document: row number, id, digest of the whole text, and its chunks in order."""
    pattern = rf"(?s).{{{SHORTEST},{LONGEST}}}?(?<=[.!?\n])|.{{1,{LONGEST}}}"
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        ascii_lower(F.col(text_col)).alias("norm"))
    chunks = F.transform(
        F.regexp_extract_all("norm", F.lit(pattern), F.lit(0)),
        lambda c: F.struct(F.shiftrightunsigned(F.xxhash64(c), 64 - hash_bits).alias("h") if hash_bits < 64
                           else F.xxhash64(c).alias("h"),
                           F.octet_length(c).alias("n"), F.unhex(F.sha2(c, 256)).alias("digest")))
    return cut(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash",
                            F.unhex(F.sha2("norm", 256)).alias("digest"), chunks.alias("chunks")), "recipes")


def identifier_lists(recipes: DataFrame) -> DataFrame:
    """Recipes with ``ids``: the ordered, verified identifiers (hash, number among chunks of that hash)."""
    spread = recipes.select("row", F.posexplode("chunks").alias("pos", "c")).select("row", "pos", "c.h", "c.n", "c.digest")
    distinct = spread.select("h", "n", "digest").distinct()
    clashing = distinct.groupBy("h").count().filter("count > 1").select("h")
    numbered = distinct.join(clashing, "h").withColumn(
        "number", F.row_number().over(Window.partitionBy("h").orderBy("n", "digest")) - 1)
    # a hash that stands for one chunk, as nearly all do, needs no more than the number 0
    others = spread.join(numbered.filter("number > 0"), ["h", "n", "digest"])
    per_row = others.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("pos", "number"))).alias("numbers"))
    number = lambda i: F.coalesce(F.try_element_at("numbers", i), F.lit(0))
    return recipes.join(per_row, "row", "left").withColumn(
        "ids", F.transform("chunks", lambda c, i: F.struct(c["h"].alias("h"), number(i).alias("number"))))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """One row per document: which document of its group stays, the group's size, and the text's digest."""
    listed = identifier_lists(chunk_recipes(docs, id_col, text_col, hash_bits)).select(
        "row", "doc_id", "text_hash", "digest", F.size("chunks").alias("n_chunks"), F.xxhash64("ids").alias("key"), "ids")
    groups = listed.groupBy("key", "ids").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.max_by("row", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))).alias("keep_row"))
    return listed.join(groups, ["key", "ids"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "n_chunks", "text_hash")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    found = exact_dedup(docs, id_col, text_col).withColumnRenamed("doc_id", id_col)
    decided = decide(docs, found, "kept", id_col, text_col)
    return decided.filter(F.col(decided.columns[-1]) > 0).select(*docs.columns)
