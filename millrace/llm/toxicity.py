"""Toxicity scores by a weighted finite-state grammar over clauses.

Words are mapped to symbols: insult, threat, target, negation, reporting verb, quotation mark, any other word. Five
transducers read a clause's symbols: that of insults and that of threats choose one insult or threat of the clause and
mark it, those of targets, negations and reported speech give the marked one a weight: a target near it strengthens it, a
negation just before it and reported or quoted speech weaken it. They are composed to one machine, whose paths through
a clause are its matches. A clause scores by its best path and by the sum over its paths; a text by its strongest match
and the sum over clauses, through a logistic function.

The lexicon's insults are learned: words, and stems of words, that labelled toxic texts hold far more often than
others. Fitting reads at most about ``LABELLED`` labelled documents, chosen by a hash of the id; every text is
scored whole, and neither label, language, source nor id takes part in a score.

Defined cases: a null id is not learned from, and is scored like any other; a null or empty text holds no clause and gets the score of one; without labels of both kinds the
built-in words and weights stand; several labels of a document count as toxic if one does; repeated rows are
scored each; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import cut, held_out

LABELLED = 12000
STEM = range(3, 8)
#: A learned entry is in so many toxic texts at least, is so many times likelier there (as a logarithm), and is no chance find.
LEAST_TEXTS, LEAST_ODDS, LEAST_G2, ENTRIES = 4, 2.0, 25.0, 4096

# Words of the built-in grammar in English, German, French and Spanish.
INSULTS = """idiot idiots moron stupid scum loser worthless pathetic disgusting trash clown
    idiotisch dummkopf abschaum versager wertlos erbärmlich imbécile crétin ordure minable débile
    imbécil estúpido basura inútil patético idiota""".split()
THREATS = """kill killed hurt destroy beat burn punish töten töte umbringen verletzen sterben schlagen
    tuer tuerai mourir frapper détruire matar mataré morir golpear destruir""".split()
TARGETS = """you your yours he she they them du dich dir ihr euch sie tu toi te vous ils elles
    tú ti vosotros usted ustedes ellos ellas""".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie ne pas jamais non nunca jamás".split()
REPORTS = """said says called wrote reported according claims sagte sagt nannte schrieb laut
    dit disait appelé écrit selon dijo dice llamó escribió según""".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, WORD = range(7)
#: The marked insult or threat of a path.
HIT_INSULT, HIT_THREAT = 7, 8
HITS = (HIT_INSULT, HIT_THREAT)
ALPHABET = (INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, WORD, *HITS)
#: Patterns whose factors a task keeps.
PATTERNS = 1 << 14
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_TOKEN = re.compile(r"([^\W_]+(?:'[^\W_]+)?)|([\"“”«»„])|([.!?;:\n])")

Symbol = tuple[int, float, int]  # kind, weight, place in the clause


@dataclass
class Transducer:
    """Weighted finite-state machine that reads and writes a symbol per arc: arcs[state, read] = [(written, weight, next state)]."""
    start: object
    finals: set
    arcs: dict[tuple[object, int], list[tuple[int, float, object]]]

    def paths(self, symbols: list[int]) -> dict[tuple[int, ...], float]:
        """What the machine writes for a clause, with the sum of its paths' weights."""
        live: dict[tuple[object, tuple[int, ...]], float] = {(self.start, ()): 1.0}
        for x in symbols:
            then: dict[tuple[object, tuple[int, ...]], float] = {}
            for (state, written), weight in live.items():
                for y, w, to in self.arcs.get((state, x), ()):
                    then[to, (*written, y)] = then.get((to, (*written, y)), 0.0) + weight * w
            live = then
        out: dict[tuple[int, ...], float] = {}
        for (state, written), weight in live.items():
            if state in self.finals:
                out[written] = out.get(written, 0.0) + weight
        return out


def transducer(start: object, arcs: Callable, final: Callable[[object], bool], alphabet: tuple[int, ...] = ALPHABET) -> Transducer:
    """The machine of the states that ``arcs(state, symbol)`` (a list of (written, weight, next)) reaches from ``start``."""
    out, todo = Transducer(start, set(), {}), [start]
    seen = {start}
    while todo:
        state = todo.pop()
        if final(state):
            out.finals.add(state)
        for x in alphabet:
            found = arcs(state, x)
            if found:
                out.arcs[state, x] = found
            for _, _, to in found:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
    return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that reads like ``first`` and writes what ``second`` makes of what that writes; weights multiply."""
    def arcs(state, x):
        a, b = state
        return [(z, w * v, (a2, b2)) for y, w, a2 in first.arcs.get((a, x), ()) for z, v, b2 in second.arcs.get((b, y), ())]

    return transducer((first.start, second.start), arcs, lambda s: s[0] in first.finals and s[1] in second.finals)


def marks(kind: int, hit: int, last: bool) -> Transducer:
    """Marks at most one symbol of a kind, none if another machine has marked one; the ``last`` such machine wants a mark."""
    def arcs(done, x):
        if x in HITS:
            return [] if done else [(x, 1.0, True)]
        return [(x, 1.0, done)] + ([(hit, 1.0, True)] if x == kind and not done else [])

    return transducer(False, arcs, lambda done: done or not last)


def near(kind: int, reach: int, factor: float, after: bool = False, otherwise: dict[int, float] | None = None) -> Transducer:
    """``factor`` for a mark that has a symbol of ``kind`` within ``reach`` symbols before it, or behind it too; else ``otherwise``.

    What stands behind is guessed at the mark: one branch needs such a symbol in time, the other must not meet one.
    """
    alone = otherwise or {}

    def arcs(state, x):
        phase, n = state  # n: how far the next symbol is from the last one of the kind, or from the mark
        further = min(n + 1, reach + 1)
        if phase == "before":
            if x in HITS and n <= reach:
                return [(x, factor, ("done", 0))]
            if x in HITS:
                no = (x, alone.get(x, 1.0), ("without", 1) if after else ("done", 0))
                return [no, (x, factor, ("needs", 1))] if after else [no]
            return [(x, 1.0, ("before", 1 if x == kind else further))]
        if phase == "done" or n > reach:
            return [(x, 1.0, ("done", 0))]
        if x == kind:
            return [(x, 1.0, ("done", 0))] if phase == "needs" else []
        if further > reach:
            return [] if phase == "needs" else [(x, 1.0, ("done", 0))]
        return [(x, 1.0, (phase, further))]

    return transducer(("before", reach + 1), arcs, lambda s: s[0] != "needs")


def reported(factor: float) -> Transducer:
    """``factor`` for a mark after a reporting verb or between quotation marks of the clause."""
    def arcs(state, x):
        told, quoted = state
        if x in HITS:
            return [(x, factor if told or quoted else 1.0, state)]
        return [(x, 1.0, (told or x == REPORT, quoted ^ (x == QUOTE)))]

    return transducer((False, False), arcs, lambda s: True)


def grammar_parts() -> list[Transducer]:
    """The grammar's machines in the order of their composition."""
    return [marks(INSULT, HIT_INSULT, last=False), marks(THREAT, HIT_THREAT, last=True),
            near(TARGET, 4, 1.25, after=True, otherwise={HIT_THREAT: 0.2}), near(NEGATION, 3, 0.4), reported(0.6)]


#: Other words in a row after which a further one changes nothing: one more than the farthest reach.
SETTLED = 5


class Grammar:
    """The composed machine with numbered states, and the factors of the patterns it has met."""

    def __init__(self):
        machine = reduce(compose, grammar_parts())
        numbers = {machine.start: 0}
        for (state, _), found in machine.arcs.items():
            for s in (state, *[to for _, _, to in found]):
                numbers.setdefault(s, len(numbers))
        self.arcs = [[[] for _ in range(WORD + 1)] for _ in numbers]
        for (state, x), found in machine.arcs.items():
            if x <= WORD:
                self.arcs[numbers[state]][x] = [(y in HITS, w, numbers[to]) for y, w, to in found]
        self.finals = {numbers[s] for s in machine.finals}
        # states from which every way on has the weight 1 and ends well: a marked path that reaches one is done
        self.certain = set(self.finals)
        while True:
            left = {s for s in self.certain if all(len(found) and all(not hit and w == 1 and to in self.certain for hit, w, to in found)
                                                   for found in self.arcs[s])}
            if left == self.certain:
                break
            self.certain = left
        self.known: dict[tuple[int, ...], tuple[float, ...]] = {}

    def factors(self, symbols: tuple[int, ...]) -> tuple[float, ...]:
        """For each insult or threat of a clause, in order: the weight of the paths that mark it."""
        found = self.known.get(symbols)
        if found is None:
            found = self._weights(symbols)
            if len(symbols) <= 64 and len(self.known) < PATTERNS:
                self.known[symbols] = found
        return found

    def _weights(self, symbols: tuple[int, ...]) -> tuple[float, ...]:
        """All marks in one pass: paths without a mark yet, and marked ones that are not certain, which are few at any time."""
        out: list[float] = []
        bare, marked = {0: 1.0}, []
        for x in symbols:
            going = [(k, to, weight * w) for k, state, weight in marked for _, w, to in self.arcs[state][x]]
            then: dict[int, float] = {}
            if x <= THREAT:
                out.append(0.0)
            for state, weight in bare.items():
                for hit, w, to in self.arcs[state][x]:
                    if hit:
                        going.append((len(out) - 1, to, weight * w))
                    else:
                        then[to] = then.get(to, 0.0) + weight * w
            bare, marked = then, []
            for k, state, weight in going:
                if state in self.certain:
                    out[k] += weight
                else:
                    marked.append((k, state, weight))
        for k, state, weight in marked:
            if state in self.finals:
                out[k] += weight
        return tuple(out)


def pattern(clause: list[Symbol]) -> tuple[int, ...]:
    """Symbols of a clause with the other words between them, of a long row of which ``SETTLED`` stand for all."""
    out: list[int] = []
    last = clause[0][2] - 1 if clause else 0
    for kind, _, place in clause:
        out += [WORD] * min(place - last - 1, SETTLED)
        out.append(kind)
        last = place
    return tuple(out)


@dataclass
class Lexicon:
    words: dict[str, tuple[int, float]]
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (-3.0, 1.0, 0.5, 0.5)

    def __post_init__(self):
        self._lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self._grammar = Grammar()

    def symbol(self, word: str) -> tuple[int, float] | None:
        found = self.words.get(word)
        if found is None:
            for n in self._lengths:  # the longest stem counts
                weight = self.stems.get(word[:n])
                if weight is not None:
                    return INSULT, weight
        return found

    def clauses(self, text: str) -> Iterator[list[Symbol]]:
        """Symbols of each clause that holds an insult or a threat."""
        text = text.lower()
        if not any(s and s[0] <= THREAT for s in map(self.symbol, set(_WORD.findall(text)))):
            return
        clause: list[Symbol] = []
        place = 0
        for word, mark, _ in _TOKEN.findall(text):
            place += 1
            if word:
                symbol = self.symbol(word)
                if symbol:
                    clause.append((*symbol, place))
            elif mark:
                clause.append((QUOTE, 0.0, place))
            else:
                if any(s[0] <= THREAT for s in clause):
                    yield clause
                clause = []
        if any(s[0] <= THREAT for s in clause):
            yield clause

    def measure(self, text: str | None) -> tuple[float, float, float]:
        """Weight of the best path of any clause; logarithms of one plus the sum over clauses, and of one plus that per hundred words."""
        best = total = 0.0
        for clause in self.clauses(text or ""):
            scores = [s[1] * f for s, f in zip([s for s in clause if s[0] <= THREAT], self._grammar.factors(pattern(clause)))]
            best, total = max(best, *scores), total + max(sum(scores), 0.0)
        if not total:
            return 0.0, 0.0, 0.0
        return best, math.log1p(total), math.log1p(100 * total / (50 + text.count(" ")))

    def score(self, text: str | None) -> float:
        odds = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.measure(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def built_in() -> Lexicon:
    kinds = ((REPORTS, REPORT, 0.0), (NEGATIONS, NEGATION, 0.0), (TARGETS, TARGET, 0.0), (THREATS, THREAT, 2.0), (INSULTS, INSULT, 3.0))
    return Lexicon({w: (kind, weight) for words, kind, weight in kinds for w in words})


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", most: int = LABELLED) -> DataFrame:
    """Texts and labels to learn from: none that is held out, about ``most`` at most."""
    known = labels.filter(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.max(label_col).alias("toxic"))
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1 << 20)) < int(most / n * (1 << 20)))
    # at most about ``most`` rows of two numbers
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return cut(texts.join(F.broadcast(known), "_id").select("text", "toxic"), "labelled")


def _features(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {f"={w}" for w in words if len(w) <= 40} | {w[:n] for w in words for n in STEM if n < len(w)}


def learn(sample: DataFrame) -> Lexicon:
    """The built-in lexicon with what the labelled texts add, and its logistic weights."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with_it, without = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (with_it if toxic else without).update(_features(text or ""))
            found = list(with_it.keys() | without.keys())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([with_it[f] for f in found], pa.int64()),
                                              pa.array([without[f] for f in found], pa.int64())], ["entry", "pos", "neg"])

    size = sample.agg(F.sum((F.col("toxic") > 0).cast("int")), F.count(F.lit(1))).first()
    n_pos, n_neg = size[0] or 0, (size[1] or 0) - (size[0] or 0)
    lexicon = built_in()
    if not n_pos or not n_neg:
        return lexicon
    counted = sample.select("text", (F.col("toxic") > 0).alias("toxic")).mapInArrow(count, "entry string, pos long, neg long")
    sums = counted.groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    share = n_pos / (n_pos + n_neg)
    both = F.col("pos") + F.col("neg")
    part = lambda c, p: F.when(c > 0, c * F.log(c / (both * p))).otherwise(0.0)
    g2 = 2 * (part(F.col("pos"), share) + part(F.col("neg"), 1 - share))
    rows = sums.filter(F.col("pos") >= LEAST_TEXTS).withColumns({"odds": odds, "g2": g2}).filter(
        (F.col("odds") >= LEAST_ODDS) & (F.col("g2") >= LEAST_G2)).orderBy(F.desc("g2"), "entry").limit(ENTRIES).collect()
    words = {r["entry"][1:]: r for r in rows if r["entry"][0] == "="}
    stems = {r["entry"]: r for r in rows if r["entry"][0] != "="}
    # a stem that one word explains is left to that word; of stems with the same texts the longest stays
    kept = {s: r["odds"] for s, r in stems.items() if not any(w.startswith(s) and words[w]["pos"] >= 0.9 * r["pos"] for w in words)
            and not any(t != s and t.startswith(s) and stems[t]["pos"] >= 0.9 * r["pos"] for t in stems)}
    learned = Lexicon(lexicon.words, kept)
    for word, row in words.items():
        near = learned.symbol(word)
        if near is None or near[0] == INSULT and row["odds"] > near[1]:
            lexicon.words[word] = (INSULT, row["odds"])
    return _fit(learned, sample)


def _fit(lexicon: Lexicon, sample: DataFrame) -> Lexicon:
    """Logistic weights by Newton steps on the sample's measures."""
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            values = np.array([lexicon.measure(t) for t in frame["text"]]).reshape(-1, 3)
            yield pd.DataFrame({"best": values[:, 0], "total": values[:, 1], "rate": values[:, 2], "toxic": frame["toxic"]})

    rows = sample.select("text", (F.col("toxic") > 0).alias("toxic")).mapInPandas(
        measure, "best double, total double, rate double, toxic boolean").toPandas()  # as many rows as the sample
    x = np.column_stack([np.ones(len(rows)), rows[["best", "total", "rate"]]])
    y = rows["toxic"].to_numpy(float)
    prior = np.array(lexicon.weights)

    def loss(v: np.ndarray) -> float:
        odds = x @ v
        return float(np.logaddexp(0, odds).sum() - odds @ y + 0.05 * ((v - prior) ** 2).sum())

    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * (w - prior)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.1 * np.eye(len(w)), slope)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Lexicon(lexicon.words, lexicon.stems, tuple(map(float, w)))


def scorer(lexicon: Lexicon) -> Callable:
    """Column function from a text to its score."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(t) for t in texts], dtype="float64")

    return score


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """One row per document: whether it is held out, its score and the prediction."""
    score = scorer(learn(labelled_texts(docs, labels, id_col, text_col, label_col)))
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), score(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic") -> DataFrame:
    """``docs`` without those predicted to be toxic."""
    score = scorer(learn(labelled_texts(docs, labels, id_col, text_col, label_col)))
    return docs.filter(score(F.col(text_col)) < 0.5)
