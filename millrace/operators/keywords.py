"""Keyword split: text to one row per word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.automaton import with_parts

# Fixed value: a word is a run of letters, digits or Han characters.
WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased words of the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def explode_words(df: DataFrame, text: str, out: str = "keyword", dictionary: DataFrame | None = None) -> DataFrame:
    """One row per word; with a dictionary (column ``word``) only listed words stay."""
    rows = df.withColumn(out, F.explode(words(F.col(text))))
    if dictionary is None:
        return rows
    known = dictionary.select(F.lower("word").alias("_w")).distinct()
    return rows.join(known, F.col(out) == F.col("_w"), "left_semi")


def keyword_counts(df: DataFrame, text: str, *keys: Column) -> DataFrame:
    return explode_words(df, text).groupBy(*keys, "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))


def longest_matches(df: DataFrame, text: str, dictionary: DataFrame, out: str = "keyword") -> DataFrame:
    """One row per word by longest match against a dictionary (column ``word``), left to right.

    Each run of letters and digits is cut into the longest listed words; what lies between two of them stays one
    word. A run is read once by the dictionary's automaton, whatever its length.
    """
    listed = dictionary.select(F.lower("word").alias("_word"))
    rows = with_parts(df.withColumn("_run", F.explode(words(F.col(text)))), "_run", listed, "_word", "_parts")
    return rows.withColumn(out, F.explode("_parts")).select(*df.columns, out)
