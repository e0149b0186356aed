"""Trained models against plain ones: Kneser-Ney probabilities, dual tilts of the mix."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, mixing

TEXTS = {
    "en": ["the cat sat on the mat, and the dog sat too.", "A cat? The dog!", "the then that them", ""],
    "de": ["der Hund und die Katze", "die Straße ist naß; Über allem", "und der und die"],
    "xx": ["Ωμέγα the omega"],
}


def symbols(text):
    """Lower-case letters, one separator after each word, one for the end, and a run of them before the text."""
    out, before = [""] * (langid.ORDER - 1), ""
    for c in text:
        if c.isalpha():
            out.append(c.lower()[0])
        elif before.isalpha():
            out.append("")
        before = c
    return [*out, ""]


def grams(texts):
    n = langid.ORDER
    return Counter(tuple(s[i:i + n]) for s in map(symbols, texts) for i in range(len(s) - n + 1))


class Plain:
    """Interpolated Kneser-Ney by its definition, one dictionary per order."""

    def __init__(self, texts):
        self.counts = {langid.ORDER: grams(texts)}
        for k in range(langid.ORDER - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.total, self.kinds, self.discount = defaultdict(int), defaultdict(int), {}
        for k, counts in self.counts.items():
            values = Counter(counts.values())
            self.discount[k] = min(max(values[1] / max(values[1] + 2 * values[2], 1), 0.1), 0.95)
            for g, n in counts.items():
                self.total[k, g[:-1]] += n
                self.kinds[k, g[:-1]] += 1

    def chance(self, gram):
        k = len(gram)
        if not k:
            return 1 / langid.SYMBOLS
        total = self.total.get((k, gram[:-1]), 0)
        if not total:
            return self.chance(gram[1:])
        d = self.discount[k]
        return max(self.counts[k][gram] - d, 0) / total * (gram in self.counts[k]) + d * self.kinds[k, gram[:-1]] / total * self.chance(gram[1:])

    def entropy(self, text):
        s, n = symbols(text), langid.ORDER
        logs = [math.log(self.chance(tuple(s[i:i + n]))) for i in range(len(s) - n + 1)]
        return -sum(logs) / len(logs)


def code(gram):
    out = 0
    for c in gram:
        out = out << langid.BITS | (ord(c) % ((1 << langid.BITS) - 1) + 1 if c else 0)
    return out


def test_language_models_equal_plain_kneser_ney():
    counts = {}
    for lang, texts in TEXTS.items():
        found = sorted((code(g), n) for g, n in grams(texts).items())
        counts[lang] = (np.array([g for g, _ in found]), np.array([n for _, n in found]))
    models = langid._smoothed(counts)
    asked = [t for texts in TEXTS.values() for t in texts] + ["a new cat", "Katzen", "12 the 34", "xyzzy", "ÜBER", "x"]
    entropies, has = models.entropies(asked)
    for j, lang in enumerate(models.langs):
        plain = Plain(TEXTS[lang])
        assert entropies[:, j] == pytest.approx([plain.entropy(t) for t in asked], rel=1e-4)
    assert has.tolist() == [any(c.isalpha() for c in t) for t in asked]


def test_counts_of_a_trained_model_are_those_of_its_texts(spark):
    """Trained through Spark on rows that are neither held out nor set aside: the same probabilities."""
    import zlib

    free = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 > 1]
    pairs = [(lang, t) for lang, texts in TEXTS.items() for t in texts]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in zip(free, pairs)], "doc_id long, text string, lang string").repartition(3)
    models = langid.train(docs)
    asked = ["the dog and Katze", "Ωμέγα"]
    for j, lang in enumerate(models.langs):
        plain = Plain(TEXTS[lang])
        assert models.entropies(asked)[0][:, j] == pytest.approx([plain.entropy(t) for t in asked], rel=1e-4)


def test_tilts_solve_the_dual(spark):
    """Each source's multiplier is the one that plain bisection finds for its target."""
    rng = np.random.default_rng(6)
    rows = [(s, int(size)) for s, low, high, n in (("a", 1, 60, 300), ("b", 5, 200, 120), ("c", 1, 50, 400), (None, 10, 20, 50))
            for size in rng.integers(low, high, n)]
    docs = spark.createDataFrame([(i, "w " * size, s) for i, (s, size) in enumerate(rows)], "doc_id long, text string, source string")
    sized = mixing.sizes(docs)
    cells = sized.filter("size > 0").groupBy("skey", "size").count()
    solved = mixing.balance(cells, mixing.targets(sized)).collect()
    open_ = [r for r in solved if not r["full"]]
    assert len(open_) >= 2
    for r in open_:
        sizes = np.array([size for s, size in rows if ("=" + s if s else "") == r["skey"]], float)

        def taken(tilt, sizes=sizes):
            return float((sizes * mixing.MOST / (1 + np.exp(-tilt * sizes / sizes.mean()))).sum())

        low, high = -50.0, 50.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if taken(middle) < r["target"] else (low, middle)
        assert taken(r["tilt"]) == pytest.approx(r["target"], rel=2e-6) and r["tilt"] == pytest.approx(low, rel=1e-3, abs=1e-4)
        # the solution is the rate closest to the design rate in the balance's distance: odds tilt exponentially in the size
        rates = mixing.MOST / (1 + np.exp(-r["tilt"] * sizes / sizes.mean()))
        odds = np.log(rates / (mixing.MOST - rates))
        assert np.allclose(odds * sizes.mean(), r["tilt"] * sizes)
