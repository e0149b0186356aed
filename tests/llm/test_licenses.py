"""Licence scan: base places against plain search, expressions against their truth tables."""

import itertools
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import licenses as li
from millrace.llm.common import table
from millrace.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MACHINE = li.automaton()


def look(text):
    return li.scan(text.encode("utf-8", "surrogatepass"), MACHINE)


def plain_base(text):
    """(number of words, places as (word, label))."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), sorted((i, label) for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
                              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())


def check(rows, out):
    for (doc_id, text), r in zip(rows, out):
        n, base = plain_base(text)
        starts = [i for i, _ in base]
        assert (r["doc_id"], r["n_words"], r["n_base"]) == (doc_id, n, len(base))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({k for _, k in base}))
        labels = r["labels"].split(",") if r["labels"] else []
        assert labels == sorted(set(labels)) and set(labels) >= {k for _, k in base}
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)


def test_whole_table(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect())
    out = sorted(QUERIES["op12_license_scan"](spark, SMALL).collect())
    check(rows, out)
    assert sum(r["n_base"] for r in out) > 0


def test_odd_rows(odd_docs, no_docs):
    key = lambda r: (str(r[0]), str(r[1]))
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    out = li.license_scan(odd_docs).collect()
    assert len(out) == len(rows)
    check(rows, out)
    assert sorted(rows, key=key)[0] and li.license_scan(no_docs).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["cc", "by", "CC-BY", "All", "rights", "reserved", "General", "public", "license", ":", " ", ".", "é", "K", "0", "\x7f"])))
def test_base_places(parts):
    for sep in (" ", "", "-"):
        found = look(sep.join(parts))
        assert (found.n_words, sorted(found.base)) == plain_base(sep.join(parts))


@pytest.mark.parametrize("text, labels, score, expressions", [
    ("SPDX-License-Identifier: MIT", ["mit"], 0.2, ["mit"]),
    ("License: MIT/Apache-2.0.", ["apache-2.0", "mit"], 0.2, ["mit or apache-2.0"]),
    ("licensed under MIT or GPL-3.0-only and Apache-2.0", ["apache-2.0", "gpl-3.0-only", "mit"], 0.2, None),
    ("licensed under (MIT or GPL-3.0-only) and AGPL-3.0+", ["agpl-3.0-or-later", "gpl-3.0-only", "mit"], 0.8, None),
    ("Licensed under GPL-2.0 WITH Classpath-exception-2.0", ["gpl-2.0-with-classpath-exception-2.0"], 0.5, None),
    ("released under the MIT License.", ["mit"], 0.2, ["mit"]),
    ("licensed under MIT and", ["mit"], 0.2, ["mit"]),
    ("licensed under ((MIT or ISC", ["isc", "mit"], 0.2, None),
    ("our license mit", [], 0.0, []),
    ("licensed under our own terms", [], 0.0, []),
    ("dual cc by-nc 4.0, all rights reserved", ["cc-by", "cc-by-nc", "reserved"], 1.0, []),
    ("GNU Affero General Public License", ["agpl", "gpl"], 0.8, []),
])
def test_labels(text, labels, score, expressions):
    found = look(text)
    assert found.labels == labels and found.score == pytest.approx(score)
    assert expressions is None or found.expressions == expressions


NAMES = {"mit": 0.2, "apache-2.0": 0.2, "gpl-3.0": 0.7, "agpl-3.0": 0.8, "mpl-2.0": 0.5, "cc0": 0.1}
EXPRESSION = st.recursive(st.sampled_from(sorted(NAMES)), lambda e: st.tuples(e, st.sampled_from(["and", "or"]), e), max_leaves=12)


def shown(e, top=True):
    if isinstance(e, str):
        return e
    inner = f"{shown(e[0], False)} {e[1]} {shown(e[2], False)}"
    return inner if top else f"({inner})"


def value(e):
    return NAMES[e] if isinstance(e, str) else (max if e[1] == "and" else min)(value(e[0]), value(e[2]))


@settings(max_examples=200, deadline=None)
@given(EXPRESSION)
def test_expressions_with_parentheses(e):
    found = look("licensed under " + shown(e))
    assert found.binds == value(e) and " ".join(found.expressions).replace("( ", "(").replace(" )", ")") == shown(e)


def test_and_binds_closer_than_or():
    for a, b, c in itertools.product(sorted(NAMES), repeat=3):
        assert look(f"licensed under {a} or {b} and {c}").binds == min(NAMES[a], max(NAMES[b], NAMES[c]))
        assert look(f"licensed under {a} and {b} or {c}").binds == min(max(NAMES[a], NAMES[b]), NAMES[c])


@pytest.mark.parametrize("text", ["licensed under " + "mit or " * 100000, "licensed under mit. " * 60000, "licensed under " + "(" * 200000,
                                  "licensed under " * 60000 + "mit", "cc by " * 100000, "all " * 200000])
def test_long_texts_take_linear_time(text):
    start = time.perf_counter()
    look(text)
    assert time.perf_counter() - start < 5
