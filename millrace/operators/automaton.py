"""Word lists as goto/fail automata: every listed word in a text, found in one pass over it.

The words are broadcast, and a worker builds the automaton. A list is dealt to automata of at most ``SHARD`` words, so neither the driver nor a task ever holds more than one of them. With a
single one, as for nearly all lists, matching is a column of Arrow batches and moves no row; further ones take a pass each over
the distinct texts, and what they find is put together by the texts' numbers: texts themselves are written once, not once a pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.shipping import by_value
from millrace.sinks.workspace import cut

SHARD = 200_000


def build(words: list[str]) -> ahocorasick.Automaton | None:
    """Automaton whose values are the words' lengths; none for an empty list."""
    machine = ahocorasick.Automaton()
    for word in words:
        machine.add_word(word, len(word))
    if not len(machine):
        return None
    machine.make_automaton()
    return machine


def words_in(machine: ahocorasick.Automaton | None, text: str | None) -> list[str]:
    """Listed words that occur in the text, each once."""
    if machine is None or not text:
        return []
    return list({text[end + 1 - n:end + 1] for end, n in machine.iter(text)})


def longest_at(machine: ahocorasick.Automaton | None, text: str | None) -> list[tuple[int, int]]:
    """(place, length) of the longest listed word at each place where one begins."""
    best: dict[int, int] = {}
    if machine is not None and text:
        for end, n in machine.iter(text):
            best[end + 1 - n] = max(n, best.get(end + 1 - n, 0))
    return sorted(best.items())


def parts(text: str, longest: list[tuple[int, int]]) -> list[str]:
    """The text cut into its listed words, left to right, and the stretches between them."""
    out, free = [], 0
    for at, n in longest:
        if at < free:  # inside the word before
            continue
        if at > free:
            out.append(text[free:at])
        out.append(text[at:at + n])
        free = at + n
    if free < len(text):
        out.append(text[free:])
    return out


def built(words: Broadcast) -> ahocorasick.Automaton | None:
    """The automaton of a broadcast list, built once in a worker and kept beside the list: it is some hundred times as large."""
    if not hasattr(words, "machine"):
        words.machine = build(words.value)
    return words.machine


def _shards(words: DataFrame, column: str) -> Iterator[tuple[int, Broadcast]]:
    """(number of shards, broadcast words of one) of the distinct non-empty words, one after the other."""
    listed = words.select(F.col(column).alias("w")).where("w <> ''").distinct()
    context = words.sparkSession.sparkContext
    first = [r["w"] for r in listed.limit(SHARD + 1).collect()]
    if len(first) <= SHARD:
        yield 1, context.broadcast(first)
        return
    listed = cut(listed, "words")
    n = -(-listed.count() // (SHARD // 2))  # by hash, so shards differ a little
    for k in range(n):
        yield n, context.broadcast([r["w"] for r in listed.where(F.pmod(F.xxhash64("w"), F.lit(n)) == k).collect()])


def _column(find: Callable, words: Broadcast, schema: str) -> Callable[[Column], Column]:
    @F.pandas_udf(schema)
    def run(texts: pd.Series) -> pd.Series:
        machine = built(words)
        return pd.Series([find(machine, t) for t in texts], dtype=object)

    return run


def _found(df: DataFrame, text: str, words: DataFrame, column: str, find: Callable, schema: str, out: str) -> DataFrame:
    """``df`` with ``out``: what ``find`` gives for its text, over all shards of the list."""
    collected = None
    for n, shard in _shards(words, column):
        run = _column(find, shard, schema)
        if n == 1:
            return df.withColumn(out, run(F.col(text)))
        if collected is None:
            distinct = cut(df.select(F.col(text).alias("_t")).where("_t is not null").distinct().withColumn(
                "_n", F.monotonically_increasing_id()), "texts")
        some = cut(distinct.select("_n", run(F.col("_t")).alias("_f")).where(F.size("_f") > 0), "found")
        shard.destroy()
        collected = some if collected is None else collected.unionByName(some)
    whole = collected.groupBy("_n").agg(F.flatten(F.collect_list("_f")).alias(out))
    joined = df.join(distinct.join(whole, "_n").drop("_n"), F.col(text) == F.col("_t"), "left").drop("_t")
    return joined.withColumn(out, F.coalesce(out, F.expr(f"cast(array() as {schema})")))


def with_words(df: DataFrame, text: str, words: DataFrame, column: str = "word", out: str = "found") -> DataFrame:
    """``df`` with the listed words that occur in ``text``, sorted; texts and words are compared as they are."""
    found = _found(df, text, words, column, words_in, "array<string>", out)
    return found.withColumn(out, F.array_sort(F.array_distinct(out)))


def with_parts(df: DataFrame, text: str, words: DataFrame, column: str = "word", out: str = "parts") -> DataFrame:
    """``df`` with ``text`` cut into the longest listed words from left to right, and what lies between them."""
    def find(machine, run):
        return [{"at": a, "n": n} for a, n in longest_at(machine, run)]

    @F.pandas_udf("array<string>")
    def walk(texts: pd.Series, places: pd.Series) -> pd.Series:
        rows = []
        for t, found in zip(texts, places):
            best: dict[int, int] = {}
            for p in found:
                best[p["at"]] = max(p["n"], best.get(p["at"], 0))
            rows.append([] if t is None else parts(t, sorted(best.items())))
        return pd.Series(rows, dtype=object)

    found = _found(df, text, words, column, find, "array<struct<at:int,n:int>>", "_places")
    return found.withColumn(out, walk(F.col(text), F.col("_places"))).drop("_places")


by_value(__name__)
