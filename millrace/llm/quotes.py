"""Conversations in reply order, linked by what their messages quote.

Lines that begin with ``>`` marks are quoted, the number of marks is the level; neighbouring lines of a level are a
passage, blank ones part it into paragraphs. Passages, their paragraphs and lines are normalised (lower case, single spaces), hashed and joined to the messages
that hold the same text unquoted, as whole body, paragraph or line: the latest earlier message of the conversation. The
source of the outermost level that accounts for most characters is the message replied to. Quotes and the
"... wrote:" lines above them go from the body; messages get their depth, their thread's root and their position, each
thread in the order of replies.

The search for the latest earlier holder runs in chunks of turns, so that a line which a hot conversation repeats
meets neither all its holders nor all its quoters; the position is a distributed sort with offsets.

Defined cases: a null text is empty; texts are read whole, in time that grows with their length; a null turn comes before all others; a null conversation is one of its own; rows that
repeat conversation, turn, role and text are one message; several messages of a turn share its thread; a message
without a found quotation begins a thread; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import cut, id_key
from millrace.operators.joins import null_safe
from millrace.operators.ordered import global_rank

CHUNK = 1024
NO_TURN = -(2 ** 63)
#: Ends of lines that announce a quotation.
ANNOUNCES = r"(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:"
#: What a body is trimmed of at its ends, by a set and not by a pattern: long blank stretches take no time.
BLANKS = " \t\n\x0b\f\r"
_MARKS = re.compile(r"^((?:[ \t]*>)+)[ \t]?")


def body(text: Column) -> Column:
    """A message without quoted lines and the lines that announce them."""
    unannounced = F.regexp_replace(text, rf"(?m)^[^>\n][^\n]*{ANNOUNCES}[ \t]*\n+(?=[ \t]*>)", "")
    return F.btrim(F.regexp_replace(unannounced, r"(?m)^[ \t]*>[^\n]*(?:\n|\z)", ""), F.lit(BLANKS))


def normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def passages(text: str) -> list[tuple[int, str]]:
    """(level, text) of each quoted passage, of each paragraph of those with several, and of each line of those with several."""
    out: list[tuple[int, str]] = []
    run: list[str] = []
    starts = {0}  # of paragraphs in the run
    last = 0
    for line in [*text.split("\n"), ""]:
        marks = _MARKS.match(line)
        level = marks.group(1).count(">") if marks else 0
        if level != last and run:
            out.append((last, " ".join(run)))
            if len(run) > 1:
                edges = [*sorted(starts - {len(run)}), len(run)]
                if len(edges) > 2:  # a paragraph of one line is among the lines
                    out += [(last, " ".join(run[a:b])) for a, b in zip(edges, edges[1:]) if b - a > 1]
                out += [(last, one) for one in run]
            run, starts = [], {0}
        if marks and line[marks.end():].strip():
            run.append(line[marks.end():])
        elif marks:
            starts.add(len(run))
        last = level
    return out


def _messages(conversations: DataFrame) -> DataFrame:
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN))
    return conversations.select(
        id_key("conv_id").alias("conv"), turn.alias("at"), F.xxhash64("role", "text").alias("mark"),
        "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))


def quotations(messages: DataFrame) -> DataFrame:
    """One row per quoted unit: message, level, hash and length of the normalised text."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, at, mark, texts = (c.to_pylist() for c in batch.columns)
            rows = [(c, a, m, level, part) for c, a, m, t in zip(conv, at, mark, texts) for level, part in passages(t)]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "at", "mark", "level", "part"])

    quoting = messages.filter(F.col("text").rlike(r"(?m)^[ \t]*>")).select("conv", "at", "mark", "text")
    units = quoting.mapInArrow(read, "conv string, at long, mark long, level int, part string")
    found = units.withColumn("norm", normal(F.col("part"))).filter("norm <> ''")
    return cut(found.select("conv", "at", "mark", "level", F.xxhash64("norm").alias("hash"), F.length("norm").alias("n")), "quotations")


def sources(messages: DataFrame, quoted: DataFrame) -> DataFrame:
    """(conv, at, hash, n, source): the latest turn before ``at`` whose message holds the quoted unit itself."""
    own = body(F.col("text"))
    parts = F.concat(F.array(own), F.split(own, r"\n\s*\n"), F.split(own, r"\n"))
    held = messages.select("conv", "at", F.explode(F.array_distinct(F.transform(parts, normal))).alias("norm")).filter("norm <> ''")
    wanted = quoted.select("conv", "hash", "n").distinct()
    holders = held.select("conv", "at", F.xxhash64("norm").alias("hash"), F.length("norm").alias("n")).join(
        wanted, ["conv", "hash", "n"], "left_semi")
    keys = ["conv", "hash", "n"]
    events = holders.select(*keys, "at", F.lit(1).alias("holds"), F.lit(0).alias("quotes")).unionByName(
        quoted.select(*keys, "at", F.lit(0).alias("holds"), F.lit(1).alias("quotes")))
    # one row per unit and turn; then the latest holder within a chunk of turns, else the last of the chunks before
    turns = cut(events.groupBy(*keys, "at").agg(F.max("holds").alias("holds"), F.max("quotes").alias("quotes")).withColumn(
        "chunk", F.floor(F.col("at") / CHUNK)), "turns")
    holder = F.when(F.col("holds") == 1, F.col("at"))
    inside = Window.partitionBy(*keys, "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    near = turns.withColumn("near", F.max(holder).over(inside)).filter("quotes = 1")
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = turns.groupBy(*keys, "chunk").agg(F.max(holder).alias("last")).withColumn("far", F.max("last").over(before)).drop("last")
    return near.join(chunks, [*keys, "chunk"]).select(
        *keys, "at", F.coalesce("near", "far").alias("source")).filter("source IS NOT NULL")


def replies(messages: DataFrame) -> DataFrame:
    """One row per message with quotations: how many passages and levels, and the turn it replies to."""
    quoted = quotations(messages)
    linked = quoted.join(sources(messages, quoted), ["conv", "hash", "n", "at"], "left")
    per_source = linked.groupBy("conv", "at", "mark", "level", "source").agg(F.sum("n").alias("chars"), F.count(F.lit(1)).alias("units"))
    best = F.max(F.when(F.col("source").isNotNull(), F.struct((-F.col("level")).alias("outer"), "chars", "source")))
    return cut(per_source.groupBy("conv", "at", "mark").agg(
        F.max("level").alias("levels"), F.sum("units").alias("units"),
        F.sum(F.when(F.col("source").isNotNull(), F.col("units")).otherwise(0)).alias("found"), best["source"].alias("parent")), "replies")


def _rounds(state: DataFrame, step: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """``state`` after as many steps as it takes until no ``jump`` is left; each doubles the way up that a jump goes."""
    state = cut(state, label)
    while state.filter("jump IS NOT NULL").limit(1).count():
        state = cut(step(state), label)
    return state


def _sized(state: DataFrame) -> DataFrame:
    """Subtrees of twice the depth: a turn's own and those of the turns that jump to it."""
    more = state.filter("jump IS NOT NULL").groupBy("conv", F.col("jump").alias("at")).agg(F.sum("size").alias("more"))
    grown = state.join(more, ["conv", "at"], "left").withColumn("size", F.col("size") + F.coalesce("more", F.lit(0))).drop("more")
    above = state.select("conv", F.col("at").alias("jump"), F.col("jump").alias("further"))
    going = grown.filter("jump IS NOT NULL").join(above, ["conv", "jump"], "left")
    return going.select("conv", "at", "up", F.col("further").alias("jump"), "size").unionByName(grown.filter("jump IS NULL"))


def _summed(state: DataFrame) -> DataFrame:
    """Root, depth and start over twice the way up."""
    above = state.select("conv", F.col("at").alias("jump"), F.col("jump").alias("further"), F.col("root").alias("top"),
                         F.col("depth").alias("higher"), F.col("start").alias("before"))
    going = state.filter("jump IS NOT NULL").join(above, ["conv", "jump"])
    return going.select("conv", "at", F.col("further").alias("jump"), F.col("top").alias("root"),
                        (F.col("depth") + F.col("higher")).alias("depth"), (F.col("start") + F.col("before")).alias("start")).unionByName(
        state.filter("jump IS NULL"))


def threads(turns: DataFrame) -> DataFrame:
    """(conv, at, root, depth, start) of turns (conv, at, up): ``start`` is the turn's place in the replies' order.

    A turn starts after the one it replies to and the whole subtrees of earlier replies to that one; rows hold numbers
    only, whatever the length of a chain. Sums over a turn's siblings run in chunks of a sorted order.
    """
    sized = _rounds(turns.select("conv", "at", "up", F.col("up").alias("jump"), F.lit(1).cast("long").alias("size")), _sized, "sizes")
    ranked = cut(global_rank(sized.select("conv", "at", "up", "size"), [F.col("conv"), F.col("up"), F.col("at")], "rank").withColumn(
        "chunk", F.floor(F.col("rank") / CHUNK)), "siblings")
    inside = Window.partitionBy("chunk").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    # sums over the chunks before, in two levels: the window without a partition has a row per CHUNK * CHUNK turns
    earlier = lambda *by: (Window.partitionBy(*by) if by else Window).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    block = F.floor(F.col("chunk") / CHUNK)
    chunks = ranked.groupBy("chunk").agg(F.sum("size").alias("sum")).withColumn("block", block)
    blocks = chunks.groupBy(F.col("block").alias("chunk")).agg(F.sum("sum").alias("sum")).select(
        F.col("chunk").alias("block"), F.coalesce(F.sum("sum").over(earlier()), F.lit(0)).alias("before"))
    chunks = chunks.withColumn("far", F.coalesce(F.sum("sum").over(earlier("block")), F.lit(0))).join(blocks, "block").select(
        "chunk", (F.col("far") + F.col("before")).alias("far"))
    sums = cut(ranked.withColumn("near", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(chunks, "chunk").select(
        "conv", "at", "up", (F.col("near") + F.col("far")).alias("upto")), "upto")
    firsts = sums.groupBy("conv", "up").agg(F.min("upto").alias("first"))
    own = null_safe(sums, firsts, ["conv", "up"])
    replies_too = F.col("up").isNotNull().cast("long")
    return _rounds(own.select("conv", "at", F.col("up").alias("jump"), F.coalesce("up", "at").alias("root"), replies_too.alias("depth"),
                              (F.col("upto") - F.col("first") + replies_too).alias("start")), _summed, "threads").drop("jump")


def reply_order(conversations: DataFrame, template: str = "<|{role}|>\n{body}\n") -> DataFrame:
    """One row per message: body, formatted body, what it replies to, depth, root and position in its conversation."""
    messages = _messages(conversations)
    links = replies(messages)
    found = cut(messages.select("conv", "at", "mark").distinct().join(links, ["conv", "at", "mark"], "left"), "found")
    placed = found.join(threads(found.groupBy("conv", "at").agg(F.max("parent").alias("up"))), ["conv", "at"])
    ranked = cut(global_rank(placed, [F.col("conv"), F.col("start"), F.col("mark")], "rank"), "ranked")
    first = ranked.groupBy("conv").agg(F.min("rank").alias("first"))
    known = ranked.join(first, "conv").withColumn("position", F.col("rank") - F.col("first")).drop("rank", "first")
    real = lambda c: F.when(c != NO_TURN, c)
    whole = messages.withColumn("body", body(F.col("text"))).drop("text").join(known, ["conv", "at", "mark"]).dropDuplicates(
        ["conv", "at", "mark"])
    before, rest = template.split("{role}", 1)
    middle, after = rest.split("{body}", 1)
    return whole.select(
        "conv_id", "turn", "role", "position", real(F.col("parent")).alias("reply_to"), real(F.col("root")).alias("root_turn"),
        F.col("depth").cast("int").alias("depth"), F.coalesce("levels", F.lit(0)).alias("quote_levels"),
        F.coalesce("units", F.lit(0)).cast("long").alias("quoted_units"), F.coalesce("found", F.lit(0)).cast("long").alias("linked_units"),
        "body", F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(middle), "body", F.lit(after)).alias("formatted"))
