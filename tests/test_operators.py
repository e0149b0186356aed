import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from conftest import at, day
from millrace.operators import automaton, dedup, joins, keywords, moderation, ordered, rolling, scd, sequence as sq, topk, tracks, validity


def brute_neighbours(df):
    w = Window.partitionBy("k").orderBy("ts", "id")
    return df.select("k", "ts", "id", F.row_number().over(w).alias("row_no"), F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("n"))


def skewed(spark, n=3000, hot=0.4, seed=1):
    """One key holds a large share of the rows, spread over hours and with equal times."""
    r = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    data = [("hot" if r.random() < hot else f"k{r.randrange(40)}", base + dt.timedelta(minutes=r.randrange(3000)), i, r.randrange(500)) for i in range(n)]
    return spark.createDataFrame(data, "k string, ts timestamp, id long, v long")


def test_neighbours_equal_plain_window(spark, rows):
    df = skewed(spark)
    got = ordered.with_neighbours(df, ["k"], "ts", ["id"], ["id"]).select(
        "k", "ts", "id", "row_no", F.col("prev")["id"].alias("p"), F.col("next")["id"].alias("n"))
    assert rows(got) == rows(brute_neighbours(df))


def test_neighbours_null_key(spark, rows):
    df = spark.createDataFrame([(None, at("2024-01-01 00:10:00"), 1), (None, at("2024-01-01 05:10:00"), 2)], "k string, ts timestamp, id long")
    got = ordered.with_neighbours(df, ["k"], "ts", ["id"], ["id"]).select("id", "row_no", F.col("next")["id"])
    assert rows(got) == [(1, 1, 2), (2, 2, None)]


def test_newest_wins_equals_plain_window(spark, rows):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("m", F.max("v").over(w)).where("m is null or v > m").drop("m")
    assert rows(sq.newest_wins(df, ["k"], "ts", ["id"], "v")) == rows(want)


def test_global_rank_equals_plain_rank(spark, rows):
    df = skewed(spark).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("k"), F.asc("v")]
    got = ordered.global_rank(df, order, "pos")
    assert rows(got) == rows(df.withColumn("pos", F.row_number().over(Window.orderBy(*order)).cast("long")))


def test_latest_and_first_per_key(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (None, 1, "e")], "k int, t int, x string")
    assert rows(dedup.latest_per_key(df, ["k"], ["t"])) == [(None, 1, "e"), (1, 7, "c"), (2, None, "d")]
    assert rows(dedup.first_per_key(df.where("t is not null"), ["k"], ["t"])) == [(None, 1, "e"), (1, 5, "a")]
    assert dedup.latest_per_key(df.where("false"), ["k"], ["t"]).count() == 0


def test_rolling_windows_are_bounded(spark, rows):
    df = spark.createDataFrame([("a", day("2024-01-30"), 1), ("a", day("2024-01-24"), 2), ("a", day("2024-01-23"), 4), ("a", day("2024-01-01"), 8),
                                ("a", day("2023-12-31"), 16), ("a", day("2024-01-31"), 32), ("b", day("2024-01-02"), 1)], "k string, dt date, n long")
    assert rows(rolling.recent_days(df, ["k"], ["n"], "20240130", (1, 7, 30))) == [("a", 1, 1), ("a", 30, 15), ("a", 7, 3), ("b", 30, 1)]
    assert rows(rolling.wide_days(df, ["k"], {"n": "n"}, "2024-01-30")) == [("a", 3, 15), ("b", 0, 1)]
    assert rolling.recent_days(df.where("false"), ["k"], ["n"], "20240130").count() == 0


def test_full_outer_matches_on_coalesced_keys(spark, rows):
    a = spark.createDataFrame([(1, 10), (2, 20), (None, 5)], "k int, a int")
    b = spark.createDataFrame([(2, 200), (3, 300), (None, 7)], "k int, b int")
    c = spark.createDataFrame([(3, 3000), (4, 4000)], "k int, c int")
    assert rows(joins.full_outer([a, b, c], ["k"])) == [(None, 5, 7, None), (1, 10, None, None), (2, 20, 200, None), (3, None, 300, 3000), (4, None, None, 4000)]


def test_level_region(spark, rows):
    region = spark.createDataFrame([(1, 0, "prov"), (10, 1, "city"), (100, 10, "district")], "id int, parent_id int, name string")
    org = spark.createDataFrame([("a", 1, 10), ("b", 2, 100)], "org string, lvl int, region_id int")
    got = joins.level_region(org, region, "region_id", "lvl").select("org", "city_id", "city_name", "province_id", "province_name")
    assert rows(got) == [("a", 10, "city", 1, "prov"), ("b", 10, "city", 1, "prov")]


def test_key_flag_does_not_multiply(spark, rows):
    users = spark.createDataFrame([(1,), (2,)], "u int")
    events = spark.createDataFrame([(1,), (1,), (1,)], "u int")
    assert rows(joins.key_flag(users, events, ["u"], "f")) == [(1, 1), (2, 0)]


def test_zipper_step(spark, rows):
    start = scd.open_zipper(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "2024-01-01")
    step = scd.advance_zipper(start, spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string"), "id", "2024-01-05")
    again = scd.advance_zipper(step, spark.createDataFrame([(2, "BB")], "id int, v string"), "id", "2024-01-09")
    end = dt.date(9999, 12, 31)
    assert rows(again.where("id = 2")) == [(2, "B", day("2024-01-05"), day("2024-01-08")), (2, "BB", day("2024-01-09"), end), (2, "b", day("2024-01-01"), day("2024-01-04"))]
    open_rows = again.where(F.col("end_date") == F.lit(end)).groupBy("id").count()
    assert rows(open_rows) == [(1, 1), (2, 1), (3, 1)]


def test_top_per_group_keeps_ties(spark, rows):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate([9, 8, 7, 7, 6])], "g string, i int, v int")
    assert [r[1] for r in rows(topk.top_per_group(df, ["g"], [F.desc("v")], 3))] == [0, 1, 2, 3]


def test_retractions_net_to_newest_row(spark, rows):
    data = [("a", at("2024-01-01 00:00:00"), 5), ("a", at("2024-01-01 00:01:00"), 6), ("a", at("2024-01-01 00:01:00"), 6), ("b", at("2024-01-01 00:00:00"), 1)]
    df = spark.createDataFrame(data, "id string, ts timestamp, amount int")
    log = sq.retractions(df, ["id"], ["ts"])
    net = log.groupBy("id").agg(F.sum(F.col("sign") * F.col("copies") * F.col("amount")))
    assert rows(net) == [("a", 6), ("b", 1)]
    image = df.where("amount = 5")
    more = sq.retractions(df.where("amount = 6"), ["id"], ["ts"], image)
    assert rows(more.groupBy("id").agg(F.sum(F.col("sign") * F.col("copies") * F.col("amount")))) == [("a", 1)]
    late = sq.retractions(image, ["id"], ["ts"], df.where("amount = 6").dropDuplicates())
    assert rows(late.groupBy("id").agg(F.sum(F.col("sign") * F.col("copies") * F.col("amount")))) == [("a", 0)]


def test_login_flags(spark, rows):
    df = spark.createDataFrame([("u", at("2024-01-01 01:00:00")), ("u", at("2024-01-01 05:00:00")), ("u", at("2024-01-08 01:00:00")), ("u", at("2024-01-16 01:00:00"))], "u string, ts timestamp")
    assert [r[4] for r in rows(sq.login_flags(df, "u", "ts"))] == [0, 0, 1]


def test_payment_rule_three_valued(spark, rows):
    t = at("2024-01-10 00:00:00")
    data = [("ok", "normal", None, "success"), ("presale_null", "presale", None, "success"), ("early", "presale", at("2024-01-04 00:00:00"), "success"),
            ("exact", "presale", at("2024-01-03 00:00:00"), "success"), ("excluded", "official_bidding", None, "success"), ("failed", "normal", None, "failed")]
    df = spark.createDataFrame([(i, o, d, s, t, "u", "g", "s", 1.0, 2.0, 3.0) for i, o, d, s in data],
                               "order_id string, order_type string, deposit_pay_time timestamp, payment_status string, payment_time timestamp, user_id string, goods_id string, shop_id string, payment_amount double, refund_amount double, freight_amount double")
    assert rows(validity.valid_payments(df), "order_id", "total_payment_amount") == [("exact", 6.0), ("ok", 6.0)]


def plain_grades(words, texts):
    low = {w.lower() for w in words if w}
    for i, t in texts:
        tokens = (t or "").rstrip(",").split(",")
        hits = sorted(w for w in low if t is not None and w in t.lower())
        yield (i, "P0", tokens[-1], 1) if t and tokens[-1] in words and tokens[-1] else (i, *(("P1", ", ".join(hits)) if hits else ("", "")), 0)


def test_moderation_equals_brute_force(spark):
    r = random.Random(3)
    words = ["bad", "ab", "x", "long word", "é1", "zzz", "BAD", "Up", "", None]
    texts = ["clean", "so BAD thing", "last, bad", "last,bad", "so,bad,,", "so,Bad", "x,BAD,", "AB in the middle", "", ",,", None, "ends with,x",
             "so,up", "so,Up", "a long word here", "a long word here"] + [
        " ".join(r.choice(["foo", "zzz", "ab", "bar", "é1", "qux"]) for _ in range(6)) for _ in range(30)]
    comments = spark.createDataFrame([(i % 40, t) for i, t in enumerate(texts)], "id int, msg string")
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    out = moderation.moderate(comments, listed).select("id", "violation_grade", "violation_msg", "is_violation").collect()
    assert sorted(map(tuple, out)) == sorted(plain_grades(words, [(i % 40, t) for i, t in enumerate(texts)]))


def test_moderation_is_the_same_for_short_and_long_lists(spark):
    """Ten words, and the same ten among ten thousand that no text holds."""
    words = ["bad", "AB", "x", "", "é1", "zz", "foo bar", "q", "Long", "1"]
    more = words + [f"unseen{i:05d}" for i in range(10000)]
    comments = spark.createDataFrame([(0, "so BAD"), (1, "ok,AB"), (2, "ok,ab"), (3, "nothing here"), (4, "a foo bar, é1"), (5, "")], "id int, msg string")
    graded = [sorted(map(tuple, moderation.moderate(comments, spark.createDataFrame([(w,) for w in ws], "word string")).collect())) for ws in (words, more)]
    assert graded[0] == graded[1]


def test_no_rule_drops_rows_with_nulls(spark, rows):
    """Null keys, null times and ties stay in neighbours, running maxima, newest-wins, retractions and flag repair."""
    r = random.Random(11)
    data = [(i, r.choice([None, "a", "b"]), r.choice([None, *[at(f"2024-01-01 00:0{m}:0{x}") for m in range(3) for x in range(3)]]), r.randint(0, 6),
             r.choice(["0", "1"])) for i in range(80)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, v int, flag string")
    order = sorted(data, key=lambda x: (x[2] is not None, x[2] or 0, x[0]) if x[2] else (False, 0, x[0]))
    by_key = {k: [x for x in order if x[1] == k] for k in (None, "a", "b")}
    near = ordered.with_neighbours(df, ["k"], "ts", ["id"], ["id"]).select("id", "row_no", F.col("prev")["id"].alias("p"), F.col("next")["id"].alias("n"))
    want = [(x[0], i + 1, xs[i - 1][0] if i else None, xs[i + 1][0] if i + 1 < len(xs) else None) for xs in by_key.values() for i, x in enumerate(xs)]
    assert rows(near) == sorted(want, key=lambda t: tuple((v is not None, str(v)) for v in t))
    wins = [x for xs in by_key.values() for i, x in enumerate(xs) if all(y[3] < x[3] for y in xs[:i])]
    assert sorted(r_.id for r_ in sq.newest_wins(df, ["k"], "ts", ["id"], "v").collect()) == sorted(x[0] for x in wins)
    log = sq.retractions(df.select("k", "ts", "v"), ["k"], ["ts"])
    net = log.groupBy("k").agg(F.sum(F.col("sign") * F.col("copies")).alias("n"), F.sum(F.when(F.col("sign") == 1, F.col("copies"))).alias("plus"))
    assert rows(net) == sorted([(k, 1, len(xs)) for k, xs in by_key.items()], key=lambda t: tuple((v is not None, str(v)) for v in t))
    fixed = sq.repair_new_flag(df, "k", "flag", "ts", sq.first_seen(df, "k", "flag", "ts", ["id"]))
    assert fixed.count() == len(data)


def test_geodesic_known_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (5.0, 5.0, 5.0, 5.0), (0.0, 0.0, 180.0, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(tracks.geodesic("a", "b", "c", "d")).collect()]
    assert got[0] == 111319.49 and got[1] == 110574.39 and got[2] == 0.0
    assert got[3] is None or got[3] != got[3]


def test_track_length_sums_segments(spark, rows):
    fixes = spark.createDataFrame([("v", at("2024-01-01 00:00:00"), 1, 0.0, 0.0), ("v", at("2024-01-01 03:00:00"), 2, 1.0, 0.0), ("v", at("2024-01-01 03:00:00"), 3, 1.0, 0.0)],
                                  "vehicle string, ts timestamp, event_id long, lon double, lat double")
    assert rows(tracks.track_length(fixes, exact=True)) == [("v", day("2024-01-01"), 3, 111319.49)]


def test_composite_rank_scores(spark, rows):
    df = spark.createDataFrame([("d", 1, Decimal("0.5"), 10), ("d", 2, Decimal("0.4"), None)], "g string, id int, a decimal(4,2), b int")
    out = topk.composite_rank(df, ["g"], {"ra": (F.col("a"), 60), "rb": (F.col("b"), 40)}, "id", "s")
    assert [(r.id, r.ra, r.rb, float(r.s)) for r in out.orderBy("id").collect()] == [(1, 1, 1, 50.0), (2, 2, 2, 0.0)]


def test_longest_matches(spark):
    listed = spark.createDataFrame([(w,) for w in ("数据", "数据仓库", "仓库", "red", "redder", "", None)], "word string")
    df = spark.createDataFrame([(1, "数据仓库很大"), (2, "大数据 redderred"), (3, "xxREDyy"), (4, "unlisted"), (5, ""), (6, None)], "id int, t string")
    got = {}
    for r in keywords.longest_matches(df, "t", listed).collect():
        got.setdefault(r.id, []).append(r.keyword)
    want = {1: ["数据仓库", "很大"], 2: ["大", "数据", "redder", "red"], 3: ["xx", "red", "yy"], 4: ["unlisted"]}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    none = keywords.longest_matches(df, "t", listed.limit(0)).where("id = 1").collect()
    assert [r.keyword for r in none] == ["数据仓库很大"]


@pytest.mark.parametrize("pieces", [2, 5, 32])
def test_positions_in_large_groups(spark, pieces):
    """Ranges give the positions that a window by group alone would, with ties, nulls and a value that most rows share."""
    r = random.Random(pieces)
    data = [(r.choice(["big", "big", "big", "small", None]), r.choice([None, 0, 0, 0, 0, r.randrange(50)]), r.choice([None, r.random()]), i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, a int, b double, id long")
    got = topk.group_positions(df, ["g"], {"ra": F.col("a"), "rb": -F.col("b")}, "id", pieces).collect()
    for row in got:
        mine = [d for d in data if d[0] == row["g"]]
        key = lambda v, i: (v is None, 0 if v is None else -v, i)
        assert row["_n"] == len(mine)
        assert row["ra"] == 1 + sum(key(d[1], d[3]) < key(row["a"], row["id"]) for d in mine)
        assert row["rb"] == 1 + sum(key(None if d[2] is None else -d[2], d[3]) < key(None if row["b"] is None else -row["b"], row["id"]) for d in mine)


WORDS = st.lists(st.text("abcé", min_size=1, max_size=4), max_size=8)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.text("abcéd", max_size=30))
def test_automaton_equals_plain_search(words, text):
    machine = automaton.build(words)
    assert sorted(automaton.words_in(machine, text)) == sorted({w for w in words if w in text})
    out, at, free = [], 0, ""
    while at < len(text):
        n = max((len(w) for w in words if text.startswith(w, at)), default=0)
        if n:
            out += [free] * bool(free) + [text[at:at + n]]
            at, free = at + n, ""
        else:
            free += text[at]
            at += 1
    assert automaton.parts(text, automaton.longest_at(machine, text)) == out + [free] * bool(free)


@pytest.mark.parametrize("shard", [automaton.SHARD, 3])
def test_long_word_lists_are_dealt_to_automata(spark, monkeypatch, shard):
    monkeypatch.setattr(automaton, "SHARD", shard)
    words = spark.createDataFrame([(w,) for w in ["ab", "abc", "b", "cd", "", None, "ab", "éa", "zz", "bcda"]], "word string")
    df = spark.createDataFrame([(1, "xabcdéa"), (2, ""), (3, None), (4, "qq"), (5, "abcda"), (6, "abcda")], "id int, t string")
    got = {r["id"]: r["found"] for r in automaton.with_words(df, "t", words).collect()}
    assert got == {1: ["ab", "abc", "b", "cd", "éa"], 2: [], 3: [], 4: [], 5: ["ab", "abc", "b", "bcda", "cd"], 6: ["ab", "abc", "b", "bcda", "cd"]}
    cut = {r["id"]: r["parts"] for r in automaton.with_parts(df, "t", words).collect()}
    assert cut == {1: ["x", "abc", "d", "éa"], 2: [], 3: [], 4: ["qq"], 5: ["abc", "da"], 6: ["abc", "da"]}


def test_automaton_reads_long_texts_once():
    import time

    machine = automaton.build(["ab" * k for k in range(1, 30)] + ["x"])
    start = time.perf_counter()
    assert len(automaton.parts("ab" * 100_000, automaton.longest_at(machine, "ab" * 100_000))) == -(-200_000 // 58)
    assert time.perf_counter() - start < 10


def test_texts_are_written_once_for_a_long_list(spark, monkeypatch):
    """Each pass of a list with several automata stores the words it found beside the text's number, not the text again."""
    written = []

    def cut(df, label):
        written.append((label, df.columns))
        return workspace_cut(df, label)

    workspace_cut = automaton.cut
    monkeypatch.setattr(automaton, "cut", cut)
    monkeypatch.setattr(automaton, "SHARD", 2)
    words = spark.createDataFrame([(w,) for w in ("ab", "bc", "cd", "de", "x")], "word string")
    texts = spark.createDataFrame([(1, "abcd"), (2, "abcd"), (3, None), (4, "none"), (5, "xde")], "id int, t string")
    got = automaton.with_words(texts, "t", words)
    assert sorted((r["id"], r["found"]) for r in got.collect()) == [(1, ["ab", "bc", "cd"]), (2, ["ab", "bc", "cd"]), (3, []), (4, []), (5, ["de", "x"])]
    assert sum(label == "found" for label, _ in written) > 1 and not any("_t" in columns for label, columns in written if label == "found")
