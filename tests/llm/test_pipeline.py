"""The pipeline's stages, each against a plain reading of its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from millrace.llm.common import cut, table
from test_documents import SMALL, plain_groups, plain_targets, shingles


def near_groups(rows):
    """Smallest id of each document's group."""
    sets = {i: shingles(t) for i, t in rows}
    roots = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9 and roots[a] != roots[b]:
                old, new = max(roots[a], roots[b]), min(roots[a], roots[b])
                roots = {i: new if r == old else r for i, r in roots.items()}
    return set(roots.values())


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_stages_on_documents(spark):
    docs = table(spark, SMALL, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
        columns = docs.columns
        docs = cut(stage(spark, docs, SMALL), name)
        kept[name] = before, docs
        if name != "packing":
            assert docs.columns == columns
    ids = lambda name: Counter(r["doc_id"] for r in kept[name][1].collect())

    before, _ = kept["toxicity"]
    marks = {r["doc_id"]: r["toxic"] for r in table(spark, SMALL, "labels").collect()}
    clean = [i for i, _, _ in before if marks.get(i) == 0]
    assert sum(i in ids("toxicity") for i in clean) >= 0.98 * len(clean)

    before, _ = kept["exact_dedup"]
    assert ids("exact_dedup") == Counter(max(g) for g in plain_groups([(i, t) for i, t, _ in before]).values())

    before, _ = kept["ngram_jaccard"]
    assert ids("ngram_jaccard") == Counter(near_groups([(i, t) for i, t, _ in before]))

    before, _ = kept["mixing"]
    sizes, taken, longest = Counter(), Counter(), Counter()
    for i, t, s in before:
        sizes[s] += words(t)
        taken[s] += words(t) * ids("mixing")[i]
        longest[s] = max(longest[s], words(t))
    goals = plain_targets(dict(sizes))
    assert max(ids("mixing").values()) <= 2 and all(abs(taken[s] - goals[s]) <= longest[s] for s in sizes)

    before, packed = kept["packing"]
    firsts = Counter(r["doc_id"] for r in packed.filter("piece = 0").collect())
    assert firsts == Counter(i for i, _, _ in before)


@pytest.mark.parametrize("case", ["odd", "none"])
def test_stages_on_odd_rows(spark, odd_docs, no_docs, case):  # noqa: F811
    docs = odd_docs if case == "odd" else no_docs
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = cut(stage(spark, docs, SMALL), name)
        assert name == "packing" or docs.columns == columns
    assert (docs.count() == 0) == (case == "none")
