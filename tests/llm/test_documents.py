"""Operators over documents: odd rows, empty tables, brute force."""

import hashlib
import re
import zlib
from collections import Counter
from functools import reduce

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import exact, jaccard, langid, mixing, packing, pii, shingles as sh, suffix, toxicity
from millrace.llm.common import table
from millrace.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in table(spark, SMALL, "documents").orderBy("doc_id").collect()]


def same_rows(df, sql):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    expected = con.execute(sql).df()
    found = df.toPandas()
    columns = sorted(expected.columns)
    assert columns == sorted(found.columns)
    order = lambda d: d[columns].astype(str).sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(found), order(expected))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    same_rows(QUERIES[name](spark, SMALL), SQL[name])


# exact dedup

def plain_groups(rows):
    table_ = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(table_), []).append(i)
    return groups


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup_odd_rows(odd_docs, bits):
    """With three hash bits nearly all chunks clash, and their numbers must tell them apart."""
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    groups = plain_groups(rows)
    out = exact.exact_dedup(odd_docs, hash_bits=bits).collect()
    assert len(out) == len(rows)
    digests = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in out:
        ids = digests[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert Counter(r["text_sha256"] for r in out if r["kept"]) == Counter(dict.fromkeys(digests, 1))


def test_drop_copies(odd_docs, no_docs):
    out = exact.drop_copies(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(plain_groups([(r["doc_id"], r["text"]) for r in out.collect()])) == sorted(
        plain_groups([(r["doc_id"], r["text"]) for r in odd_docs.collect()]))
    assert out.count() == len(plain_groups([(r["doc_id"], r["text"]) for r in odd_docs.collect()]))
    assert exact.drop_copies(no_docs).count() == 0 and exact.exact_dedup(no_docs).count() == 0


def test_exact_dedup_stays_in_the_jvm(spark):
    plan = QUERIES["op1_exact_dedup"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# toxicity

def test_grammar_weighs_clauses():
    score = lambda t: toxicity.built_in().measure(t)[0]
    plain, aimed, negated = score("such an idiot."), score("you are an idiot."), score("you are not an idiot.")
    told, far = score('he said "you are an idiot".'), score("not so. you are an idiot.")
    assert aimed > plain and negated < aimed and told < aimed and far == aimed
    assert score("i will kill you") > score("to kill time") and score(None) == score("") == score("a calm day")


SYMBOLS = st.lists(st.integers(0, toxicity.WORD), max_size=9)


@settings(max_examples=150, deadline=None)
@given(SYMBOLS)
def test_composed_grammar_equals_its_parts_in_turn(symbols):
    """What a machine writes is read by the next; the composition gives every output the same weight."""
    outputs = {tuple(symbols): 1.0}
    for part in toxicity.grammar_parts():
        then = {}
        for written, weight in outputs.items():
            for further, w in part.paths(list(written)).items():
                then[further] = then.get(further, 0.0) + weight * w
        outputs = then
    whole = COMPOSED.paths(symbols)
    assert whole.keys() == outputs.keys() and all(abs(whole[k] - outputs[k]) < 1e-12 for k in whole)
    # one output for each insult or threat: that one marked
    marked = {next(i for i, y in enumerate(k) if y in toxicity.HITS): w for k, w in whole.items()}
    hits = [i for i, x in enumerate(symbols) if x <= toxicity.THREAT]
    assert sorted(marked) == hits
    assert GRAMMAR.factors(tuple(symbols)) == pytest.approx([marked[i] for i in hits])


COMPOSED = reduce(toxicity.compose, toxicity.grammar_parts())
GRAMMAR = toxicity.Grammar()


def plain_factor(symbols, i):
    """The grammar's rules read one by one, for the insult or threat at place ``i``."""
    at = lambda kind: [j for j, x in enumerate(symbols) if x == kind]
    aimed = any(abs(j - i) <= 4 for j in at(toxicity.TARGET))
    out = 1.25 if aimed else 0.2 if symbols[i] == toxicity.THREAT else 1.0
    out *= 0.4 if any(0 < i - j <= 3 for j in at(toxicity.NEGATION)) else 1
    told = any(j < i for j in at(toxicity.REPORT)) or sum(j < i for j in at(toxicity.QUOTE)) % 2
    return out * (0.6 if told else 1)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, toxicity.WORD), max_size=30))
def test_grammar_equals_plain_rules(symbols):
    found = GRAMMAR.factors(tuple(symbols))
    assert found == pytest.approx([plain_factor(symbols, i) for i, x in enumerate(symbols) if x <= toxicity.THREAT])


def test_long_clauses_take_linear_time():
    import time

    text = "you idiot not kill said \" " * 20000
    start = time.perf_counter()
    assert toxicity.built_in().measure(text)[0] > 0 and time.perf_counter() - start < 10


def test_toxicity_learns_words_and_stems(spark):
    rng = np.random.default_rng(5)
    syllables = "la be ti on re sa mu ko".split()
    rows, labels = [], []
    for i in range(1200):
        words = ["".join(rng.choice(syllables, 3)) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            for at in rng.choice(30, 3, replace=False):
                words[at] = ("grubnak", "zorf" + "".join(rng.choice(syllables, 2)))[i % 2]
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic), 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    out = toxicity.score_documents(docs, marks).collect()
    assert {(r["doc_id"] % 5 == 0) == (r["predicted"] == 1) for r in out} == {True}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in out)
    assert toxicity.drop_toxic(docs, marks).count() == 960


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (5, None), (9, 0)], "doc_id long, toxic int")
    out = toxicity.score_documents(odd_docs, marks).collect()
    assert len(out) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score_documents(no_docs, marks.limit(0)).count() == 0
    assert toxicity.drop_toxic(odd_docs, marks.limit(0)).columns == odd_docs.columns


# repeated strings

def plain_repeats(rows):
    first = {}
    big = 2 ** 63 - 1
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k:k + 50]
            first[w] = min(first.get(w, big), big if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < (big if i is None else i):
                gone[k:k + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(b) else 0
        out.append((str(i), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found_repeats(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.repeated_strings(df).collect())


def test_repeats_equal_brute_force(spark, small):
    assert found_repeats(table(spark, SMALL, "documents")) == plain_repeats([(i, t) for i, t, _ in small])


def test_repeats_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found_repeats(odd_docs) == plain_repeats(rows)
    assert found_repeats(no_docs) == []


def test_repeats_over_small_shards(spark, monkeypatch):
    """Shards and parts far smaller than an anchor's stretches: merging by binary search gives the same."""
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcd \0"), 90))
    rows = [(int(i), "".join(rng.choice(list("xyz"), int(rng.integers(0, 40)))) + passage[int(rng.integers(0, 9)):] + "q" * int(rng.integers(0, 80)))
            for i in rng.permutation(60)]
    monkeypatch.setattr(suffix, "SHARD", 150)
    monkeypatch.setattr(suffix, "PART", 700)
    assert found_repeats(spark.createDataFrame(rows, "doc_id long, text string")) == plain_repeats(rows)


def passes(rows, n_batches, n_buckets, seen):
    """The passes of ``repeated_strings`` one after the other; ``seen`` gets the bytes of text behind each bucket of pass 2."""
    def grouped(tables, name):
        whole = pa.concat_tables(tables)
        return {k: whole.filter(pc.equal(whole.column(name), k)) for k in sorted(set(whole.column(name).to_pylist()))}

    batches = {b: pa.table({"batch": pa.array([b] * len(part), pa.int32()), "doc_id": pa.array([i for i, _ in part], pa.int64()),
                            "text": pa.array([t for _, t in part])}) for b in range(n_batches) if (part := rows[b::n_batches])}
    shared = grouped([suffix._repeated_anchors(t) for t in grouped(
        [suffix._distinct_anchors(t, 3) for t in batches.values()], "target").values()], "batch")
    none = suffix._rows([])
    strings = grouped([suffix._cut_out(t, shared.get(b, none), 3, n_buckets) for b, t in batches.items()], "target")
    seen += [sum(map(len, t.column("a").to_pylist())) for target, t in strings.items() if target >= 0]
    answers = grouped([suffix._search(t) for t in strings.values()], "batch")
    out = pa.concat_tables([suffix._cut_away(t, answers.get(b, none)) for b, t in batches.items()]).to_pylist()
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)


@pytest.mark.parametrize("template", ['<td class="price right">', "All rights reserved; this page was made on "])
def test_repeats_of_template_with_differing_surroundings(monkeypatch, template):
    """No bucket gets all surroundings of a template that every document holds, whatever its length; equal windows still meet."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    around = [(word(40), word(40)) for _ in range(400)]
    picks = [(around[int(a)][0], around[int(b)][1]) for a, b in rng.integers(0, 400, (200, 2))] + around
    rows = [(int(i), a + template + b) for i, (a, b) in zip(rng.permutation(len(picks)), picks)] + [(None, picks[0][0] + template)]
    monkeypatch.setattr(suffix, "SHARD", 2000)
    monkeypatch.setattr(suffix, "STRETCHES", 20000)
    seen = []
    assert passes(rows, 4, 5, seen) == plain_repeats(rows)
    assert max(seen) < 2 * 20000 and sum(seen) > 8 * 20000


def test_hot_template_at_normal_settings(monkeypatch):
    """More surroundings of one template than a shard holds: the batches' suffix arrays are merged by binary search."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnop"))
    words = ["".join(w) for w in letters[rng.integers(0, 16, (9000, 26))]]
    template = '<td class="price right"> '
    rows = [(i, words[int(a)] + template + words[int(b)]) for i, (a, b) in enumerate(rng.integers(0, 9000, (30000, 2)))]
    merged, real = [], suffix._merged
    monkeypatch.setattr(suffix, "_merged", lambda shards: merged.append(len(shards)) or real(shards))
    assert passes(rows, 3, 2, []) == plain_repeats(rows)
    assert max(merged) == 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 40), st.integers(0, 9), max_size=12), min_size=1, max_size=6))
def test_merged_shards_know_the_smallest(shards):
    arrays = [(np.array(sorted(s), np.int64).astype("S50"), np.array([s[k] for k in sorted(s)], np.int64)) for s in shards]
    arrays = [(v[np.argsort(v)], low[np.argsort(v)]) for v, low in arrays]
    least = {}
    for s in shards:
        for k, v in s.items():
            least[str(k).encode()] = min(v, least.get(str(k).encode(), v))
    for (values, _), found in zip(arrays, suffix._merged(arrays)):
        assert found.tolist() == [least[v] for v in values.tolist()]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=120).map(lambda b: bytes(x % 3 for x in b)))
def test_suffix_array_and_prefixes(text):
    data = np.frombuffer(text, np.uint8)
    order = suffix.suffix_array(data)
    assert list(order) == sorted(range(len(text)), key=lambda i: text[i:])
    shared = suffix.common_prefixes(data, order, np.array([0]), np.array([len(text)]))
    for a, b in zip(order, order[1:]):
        n = next((k for k, (x, y) in enumerate(zip(text[a:], text[b:])) if x != y), min(len(text) - a, len(text) - b))
        assert shared[b] == min(n, 50)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é,", max_size=30), max_size=8), st.sampled_from([1, 20, 1 << 20]))
def test_shingles_do_not_depend_on_parts(texts, part):
    """A text's shingles are the same alone, in any part, and as many as its distinct runs of words."""
    before, sh.PART = sh.PART, part
    try:
        sets = list(sh.shingle_sets(texts))
        assert len(sets) == len(texts)
        for text, found in zip(texts, sets):
            assert found.tolist() == next(iter(sh.shingle_sets([text]))).tolist()
            words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower())
            runs = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
            assert len(found) == len(runs)
    finally:
        sh.PART = before


# mixing

def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    whole, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = whole - sum(2 * sizes[s] for s in full)
        over = {s for s in names if s not in full and free * weight[s] / sum(weight[x] for x in names if x not in full) > 2 * sizes[s] - 1e-9}
        if not over:
            open_w = sum(weight[x] for x in names if x not in full)
            return {s: 2 * sizes[s] if s in full else free * weight[s] / open_w for s in names}
        full |= over


@pytest.mark.parametrize("case", ["small", "odd"])
def test_mix_meets_targets(spark, odd_docs, case):
    docs = odd_docs if case == "odd" else table(spark, SMALL, "documents")
    out = mixing.mix(docs).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    targets = plain_targets(dict(sizes))
    taken, longest = Counter(), Counter()
    for r in out:
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - targets[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert len(out) == docs.count()
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= longest[s]
    key = lambda rows: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rows)
    assert key(out) == key(mixing.mix(docs).collect())


def test_mix_buckets_and_resample(spark, monkeypatch, no_docs):
    """Many documents of one size, in buckets of three."""
    monkeypatch.setattr(mixing, "BUCKET", 3)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.lit(1).alias("_copies"),
                                  F.when(F.col("id") < 40, "a").otherwise("b").alias("source"))
    out = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("goal"), F.max("copies").alias("m")).collect()
    assert all(abs(r["t"] - r["goal"]) <= 2 and r["m"] <= 2 for r in out)
    again = mixing.resample(docs)
    assert again.columns == docs.columns and again.count() * 2 == sum(r["t"] for r in out)
    assert mixing.mix(no_docs).count() == 0 and mixing.resample(no_docs).count() == 0


# personal data

BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_base(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and max(map(int, m.group().split("."))) > 255 or kind == 3 and not 8 <= len(digits) <= 15:
                continue
            if kind == 2:
                twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(x // 10 + x % 10 for x in twice) % 10:
                    continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789..@@aZ-+ ()b%é\n4411", max_size=90))
def test_base_spans_equal_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


def test_field_finds_labelled_kinds():
    field = pii.train()
    found = lambda t: [(pii.KINDS[k], t[a:b]) for k, a, b in pii.find([t], field)[0][1]]
    assert found("call me (555) 123-4567 today") == [("phone", "(555) 123-4567")]
    assert found("write to ann@example.org.") == [("email", "ann@example.org")]
    for calm in ("version 3.0.2 of 2021", "on 2021-05-06 at 10:30", "Licensed under CC BY-NC 4.0.", "pages 100-120"):
        assert found(calm) == []


def test_personal_data_odd_rows(odd_docs, no_docs, spark, small):
    for docs in (odd_docs, table(spark, SMALL, "documents")):
        texts = Counter((r["doc_id"], ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_base(r["text"] or ""))) for r in docs.collect())
        out = pii.personal_data(docs).collect()
        assert Counter((r["doc_id"], r["base"]) for r in out) == texts
        assert all(r["base_sha256"] == hashlib.sha256(r["base"].encode()).hexdigest() for r in out)
        assert all(not r["base"] or set(r["base"].split(",")) <= set(r["spans"].split(",")) for r in out)
    assert pii.personal_data(no_docs).count() == 0


# language

def test_language_on_held_out(spark):
    docs = table(spark, SMALL, "documents")
    out = langid.identify(docs, langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out) and all(0 <= r["score"] <= 1 for r in out)


def test_language_models_are_distributions():
    grams, starts, _ = langid._codes(["abab abba", "baab"])
    codes, n = np.unique(grams, return_counts=True)
    models = langid._smoothed({"x": (codes, n)})
    contexts = models.contexts[-1]
    letters = np.unique(codes & 0xFFF)
    every = np.array([[c << langid.BITS | w for w in letters] for c in contexts])
    sums = np.exp(models.characters(every.ravel())).reshape(every.shape).sum(axis=1)
    assert (sums > 0.8).all() and (sums <= 1 + 1e-6).all()


def test_language_letters_of_all_planes():
    texts = ["\U00010330\U00010331 \U00010332", "\U0001E900\U0001E922", "\U00020000", "\U0001F600 \U0001F601", "\uffff"]  # Gothic, Adlam, Han, none
    assert list(langid._codes(texts)[2]) == [True, True, True, False, False]
    counts = {x: np.unique(langid._codes([t] * 5)[0], return_counts=True) for x, t in (("got", texts[0]), ("zh", texts[2]))}
    h, has = langid._smoothed(counts).entropies([texts[0], texts[2]])
    assert has.all() and list(h.argmin(axis=1)) == [0, 1]


def test_language_odd_rows(odd_docs, no_docs):
    models = langid.train(odd_docs)
    out = langid.identify(odd_docs, models).collect()
    texts = [(r["text"] or "") for r in odd_docs.collect()]
    assert sum(r["lang_pred"] == "und" for r in out) == sum(not any(c.isalpha() for c in t) for t in texts)
    assert langid.identify(no_docs, models).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd_docs, langid.train(no_docs)).collect()} == {"und"}


def test_bands_follow_the_threshold():
    assert jaccard.bands_and_rows() == (24, 4)
    for threshold in (0.1, 0.3, 0.5, 0.62, 0.8, 0.95, 1.0):
        bands, rows = jaccard.bands_and_rows(threshold)
        assert bands * rows <= jaccard.HASHES and (1 - threshold ** rows) ** bands <= jaccard.MISS
    with pytest.raises(ValueError):
        jaccard.bands_and_rows(0.01)


def test_pairs_at_a_lower_threshold(spark):
    """Pairs that share 27 of 45 shingles link at 0.5 and not at 0.8."""
    rows = []
    for k in range(40):
        common, left, right = ([f"{x}{k}w{i}" for i in range(n)] for x, n in (("c", 31), ("l", 9), ("r", 9)))
        rows += [(2 * k, " ".join(common + left)), (2 * k + 1, " ".join(common + right))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["n_links"] for r in jaccard.near_duplicates(docs, threshold=0.5).collect()} == {1}
    assert {r["n_links"] for r in jaccard.near_duplicates(docs).collect()} == {0}


# packing

def test_fullest_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 30, 6), rng.integers(1, 4, 6))}
        room = int(rng.integers(1, 60))
        reach = {0}
        for n, c in counts.items():
            reach = {r + k * n for r in reach for k in range(c + 1) if r + k * n <= room}
        used = packing.fullest(counts, room)
        assert sum(n * k for n, k in used.items()) == max(reach) and all(k <= counts[n] for n, k in used.items())


@pytest.mark.parametrize("case", ["small", "odd"])
def test_packing_round_trip(spark, odd_docs, no_docs, case):
    from tokenizers import Tokenizer

    docs = odd_docs if case == "odd" else table(spark, SMALL, "documents")
    out = packing.pack(docs, BPE).toPandas()
    tokens = Tokenizer.from_file(BPE)
    expected = Counter()
    for r in docs.collect():
        ids = np.array([*tokens.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        rest = len(ids) % 1024 or min(1024, len(ids))
        for k, a in enumerate([0, *range(rest, len(ids), 1024)]):
            b = rest if k == 0 else a + 1024
            expected[(r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    out["doc_id"] = out["doc_id"].astype(object).where(out["doc_id"].notna(), None)
    assert Counter(out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == expected
    ordered = out.sort_values(["sequence_id", "offset"])
    starts = ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"]
    assert (starts == ordered["offset"]).all() and (ordered["offset"] + ordered["length"] <= 1024).all()
    whole = -(-int(out["length"].sum()) // 1024)
    assert out["sequence_id"].nunique() <= max(whole * 1.02, whole + 1)
    assert packing.pack(no_docs, BPE).count() == 0


# near duplicates

def shingles(text):
    w = re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def check_near(df, rows):
    sets = [shingles(t) for _, t in rows]
    links, roots = [0] * len(rows), list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                old, new = roots[b], roots[a]
                roots = [new if r == old else r for r in roots]
    smallest = {}
    for (i, _), r in zip(rows, roots):
        smallest[r] = min(smallest.get(r, (i is not None, i or 0)), (i is not None, i or 0))
    expected = Counter((i, n, smallest[r][1] if smallest[r][0] else None) for (i, _), n, r in zip(rows, links, roots))
    out = jaccard.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["n_links"], r["component_id"]) for r in out) == expected
    assert sum(r["kept"] for r in out) == len(smallest)


def test_near_duplicates_equal_brute_force(spark, small):
    check_near(table(spark, SMALL, "documents"), [(i, t) for i, t, _ in small])


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    check_near(odd_docs, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert jaccard.near_duplicates(no_docs).count() == 0
    kept = jaccard.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["kept"] for r in jaccard.near_duplicates(odd_docs).collect())


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    """A group of near copies over many blocks, chained so that not all of its pairs link."""
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(40):
        words = list(base)
        for k in range(i // 4 + int(rng.integers(0, 3))):
            words[k * 9 % 120] = f"x{i // 8}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "BUCKET_BLOCK", 5)
    monkeypatch.setattr(jaccard, "VERIFY_BLOCK", 4)
    check_near(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_texts_move_to_few_buckets(spark):
    """A group of near copies names each class a few times, not once a band and not once a pair."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(150):
        words = [f"w{k}" for k in range(200)]
        words[int(rng.integers(0, 200))] = f"x{i}"
        rows.append((i, " ".join(words)))
    sketched = jaccard.sketches(spark.createDataFrame(rows, "doc_id long, text string"))
    found = jaccard.candidates(sketched.select("row", "sig")).collect()
    assert len({r["row"] for r in found}) == 150 and len(found) < 6 * 150
