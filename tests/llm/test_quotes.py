"""Quotation linking on small threads, and against a plain reading of them."""

import random

from pyspark.sql import functions as F, types as T

from millrace.llm import quotes
from millrace.llm.quotes import passages, reply_order

SCHEMA = "conv_id long, turn long, role string, text string"


def by_turn(df):
    return {(r["conv_id"], r["turn"]): r for r in df.collect()}


def test_nested_quotes_link_and_order(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\nIt is long."),
        (1, 1, "assistant", "Use sorted().\n\nOr sort in place."),
        (1, 2, "user", "Ann wrote:\n> How do I  SORT a list?\n> It is long.\nSame question here."),
        (1, 3, "user", "> Or sort in place.\nDoes that copy?"),
        (1, 4, "assistant", "Bob wrote:\n> Ann wrote:\n>> Or sort in place.\n> Does that copy?\nNo."),
        (1, 5, "user", "> never said by anyone\nHm."),
        (2, 0, "user", "> How do I sort a list?\nOther conversation."),
    ]
    out = by_turn(reply_order(spark.createDataFrame(rows, SCHEMA)))
    assert {k: out[k]["reply_to"] for k in out} == {(1, 0): None, (1, 1): None, (1, 2): 0, (1, 3): 1, (1, 4): 3, (1, 5): None, (2, 0): None}
    assert [t for _, t in sorted((out[(1, t)]["position"], t) for t in range(6))] == [0, 2, 1, 3, 4, 5]
    assert (out[(1, 4)]["depth"], out[(1, 4)]["root_turn"], out[(1, 4)]["quote_levels"]) == (2, 1, 2)
    assert out[(1, 2)]["body"] == "Same question here." and out[(1, 4)]["body"] == "No."
    assert out[(1, 4)]["formatted"] == "<|assistant|>\nNo.\n"
    assert out[(1, 5)]["quoted_units"] == 1 and out[(1, 5)]["linked_units"] == 0


def test_rewrapped_paragraphs_of_a_longer_message(spark):
    rows = [
        (1, 0, "user", "The first paragraph runs\nover two lines.\n\nThe second one is\nlong as well.\n\nThe third is left out."),
        (1, 1, "user", "Something else."),
        (1, 2, "user", "> The first paragraph\n> runs over two\n> lines.\n>\n> The second one\n> is long as well.\nAgreed."),
    ]
    out = by_turn(reply_order(spark.createDataFrame(rows, SCHEMA)))
    assert (out[(1, 2)]["reply_to"], out[(1, 2)]["depth"], out[(1, 2)]["linked_units"]) == (0, 1, 2)
    assert passages("> a\n>\n> \n> b\n> c\n>") == [(1, "a b c"), (1, "b c"), (1, "a"), (1, "b"), (1, "c")]


def test_long_chain_keeps_no_paths(spark, monkeypatch):
    written, cut = [], quotes.cut
    monkeypatch.setattr(quotes, "cut", lambda df, *label: written.append(df.schema) or cut(df, *label))
    rows = [(1, t, "user", f"> line {t - 1}\nline {t}" if t else "line 0") for t in range(40)]
    out = by_turn(reply_order(spark.createDataFrame(rows, SCHEMA)))
    assert all((r["reply_to"], r["root_turn"], r["depth"], r["position"]) == (t - 1 if t else None, 0, t, t) for (_, t), r in out.items())
    assert written and not any(isinstance(f.dataType, T.ArrayType) for schema in written for f in schema)


def test_threads_in_order_of_replies(spark, monkeypatch):
    monkeypatch.setattr(quotes, "CHUNK", 7)
    pick, turns, path = random.Random(4), [], {}
    for conv in ("a", "b"):
        for at in [quotes.NO_TURN, *sorted(pick.sample(range(-500, 500), 59))]:
            earlier = [t for c, t, _ in turns if c == conv]
            up = pick.choice(earlier[-9:]) if earlier and pick.random() < 0.9 else None
            path[conv, at] = [*(path[conv, up] if up is not None else []), at]
            turns.append((conv, at, up))
    pick.shuffle(turns)
    out = quotes.threads(spark.createDataFrame(turns, "conv string, at long, up long")).orderBy("conv", "start").collect()
    assert [(r["conv"], r["at"]) for r in out] == sorted(path, key=lambda k: (k[0], path[k]))
    assert all((r["root"], r["depth"]) == (path[r["conv"], r["at"]][0], len(path[r["conv"], r["at"]]) - 1) for r in out)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", "hello there"), (1, 3, "user", "> hello there\nyes"), (1, 3, "user", "> hello there\nyes"),
            (1, 3, "user", ""), (1, 5000, "user", "> hello there\n> yes\n" + "x" * 100000)]
    out = reply_order(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS body", "3 AS rank", "4 AS path")).collect()
    assert len(out) == 5
    late = next(r for r in out if r["turn"] == 5000)
    assert late["body"] == "x" * 100000 and late["reply_to"] is None and late["linked_units"] == 2
    assert reply_order(spark.createDataFrame([], SCHEMA)).count() == 0


def test_against_plain_reading(spark):
    lines = ["alpha beta", "gamma", "delta epsilon zeta", "eta", "alpha  BETA"]
    rows, state = [], 7
    for conv in range(4):
        for turn in range(40):
            picks = []
            for k in range(3):
                state = state * 1103515245 + 12345 & 0x7FFFFFFF
                picks.append(("> " if state >> 16 & 1 else "") + lines[(state >> 8) % len(lines)])
            rows.append((conv, turn * 400, "user", "\n".join(picks)))
    out = by_turn(reply_order(spark.createDataFrame(rows, SCHEMA)))
    norm = lambda s: " ".join(s.lower().split())

    def units(message):
        own = [line for line in message.split("\n") if line[0] != ">"]
        return {norm("\n".join(own)), *map(norm, own)}

    for conv, turn, _, text in rows:
        scores: dict[int, int] = {}
        for _, part in passages(text):
            held = [t for c, t, _, other in rows if c == conv and t < turn and norm(part) in units(other)]
            if held:
                scores[max(held)] = scores.get(max(held), 0) + len(norm(part))
        expected = max(scores, key=lambda t: (scores[t], t)) if scores else None
        assert out[(conv, turn)]["reply_to"] == expected
        assert out[(conv, turn)]["depth"] == (0 if expected is None else out[(conv, expected)]["depth"] + 1)


def test_blank_messages_of_any_length(spark):
    """Trimming goes by a set of characters: the time does not square with a blank stretch."""
    import time

    blanks = {n: "a" + " " * n + "b\n" + "\n \t" * (n // 3) + "> q\n" + " " * n for n in (10, 1_000_000)}
    for n in (10, 1_000_000):
        df = spark.createDataFrame([(1, 0, "user", blanks[n])], SCHEMA).cache()
        df.count()
        start = time.perf_counter()
        assert df.select(quotes.body(F.col("text")).alias("b")).first()["b"] == "a" + " " * n + "b"
        assert time.perf_counter() - start < 5
    out = by_turn(reply_order(spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "user", blanks[1_000_000])], SCHEMA)))
    assert out[(1, 1)]["reply_to"] == 0
