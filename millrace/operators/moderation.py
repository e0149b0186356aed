"""Comment moderation against a block list.

P0: the last comma-separated token, as it is written, is a listed word; trailing empty tokens do not count, and
only a P0 row is a violation. P1: any listed word occurs in the text, both in lower case (all
matches, sorted, joined by ``', '``). Otherwise the comment is clean. Null and empty words are not
listed. There is one plan for any length of the list, on stored frames and on micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import last_token
from millrace.operators.automaton import with_words


def moderate(comments: DataFrame, words: DataFrame, text: str = "msg") -> DataFrame:
    """``comments`` with ``violation_grade``, ``violation_msg`` and ``is_violation``.

    The list's automaton finds all words of a comment in one pass over its text; comments are not shuffled for it.
    """
    listed = words.select("word").where(F.col("word") != "").distinct()
    low = listed.select(F.lower("word").alias("word"))
    out = comments.withColumn("_last", last_token(F.col(text))).withColumn("_body", F.lower(F.col(text)))
    out = with_words(out, "_body", low, out="_hits").join(listed.select(F.col("word").alias("_p0")), F.col("_last") == F.col("_p0"), "left")
    is_p0, is_p1 = F.col("_p0").isNotNull(), F.size("_hits") > 0
    return (out.withColumn("violation_grade", F.when(is_p0, "P0").when(is_p1, "P1").otherwise(""))
            .withColumn("violation_msg", F.when(is_p0, F.col("_last")).when(is_p1, F.array_join("_hits", ", ")).otherwise(""))
            .withColumn("is_violation", F.when(is_p0, 1).otherwise(0)).drop("_last", "_body", "_p0", "_hits"))
