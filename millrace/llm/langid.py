"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Texts become lower-case letters with one separator between words. Each language's model is estimated from a sample
of labelled documents; n-grams of all languages are kept together in sorted arrays of their codes (12 hash
bits a character), with one log probability per language, so one binary search scores a character in all languages.
The language with the lowest cross-entropy per character wins; the score is a soft maximum whose temperature, like
the cross-entropy above which ``accepted`` is false, is set on labelled documents left out of the counts.

``PER_LANG`` documents of each language are expected in the sample: the bound of what training reads, chosen by
a hash of the id. Nothing else is sampled; every text is scored whole.

Defined cases: a null text, one without a letter, or a lack of any model gives ``und`` with score 0; of equal scores the
language first in code-point order wins; rows without a language are not learned from; repeated rows are scored each;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import held_out, id_key, per_process

ORDER, BITS, PER_LANG = 5, 12, 1500
SYMBOLS = 64.0
#: Characters that are coded at a time.
PART = 1 << 19
DRAWS = 1 << 20
UNKNOWN = "und"


def _fold() -> np.ndarray:
    """Code of each character of all planes: 0 for what is not a letter."""
    codes = np.zeros(0x110000, np.int64)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            codes[cp] = ord(chr(cp).lower()[0]) % ((1 << BITS) - 1) + 1
    return codes


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the n-grams that end at each character, the first place of each text, and whether it has letters."""
    pad = "\0" * (ORDER - 1)
    points = np.frombuffer(("\1".join(pad + t for t in texts) + "\1").encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = per_process("fold", _fold)[points]
    ends = points == 1
    letters = chars > 0
    stay = letters | ends | (points == 0)
    stay[1:] |= letters[:-1]
    chars, ends = chars[stay], ends[stay]
    grams = np.zeros(max(0, len(chars) - ORDER + 1), np.int64)
    for k in range(ORDER):
        grams = grams << BITS | chars[k:len(chars) - ORDER + 1 + k]
    last = np.flatnonzero(ends)
    starts = np.concatenate(([0], last[:-1] + 1)) + ORDER - 1
    has = np.add.reduceat(chars > 0, np.concatenate(([0], last[:-1] + 1))) > 0 if len(last) else np.zeros(0, bool)
    return grams, starts - (ORDER - 1), has


def _texts(column: pa.Array) -> list[str]:
    return [(t or "").replace("\0", " ").replace("\1", " ") for t in column.to_pylist()]


@dataclass
class LanguageModels:
    langs: list[str]
    grams: list[np.ndarray] = field(default_factory=list)      # by order: sorted codes
    logs: list[np.ndarray] = field(default_factory=list)       # by order: log probability per language
    contexts: list[np.ndarray] = field(default_factory=list)   # by order: sorted codes of contexts
    backoff: list[np.ndarray] = field(default_factory=list)    # by order: log weight of the shorter context
    temperature: float = 0.05
    worst: float = float("inf")

    def characters(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each n-gram's last character in every language."""
        if order == 0:
            return np.full((len(codes), len(self.langs)), -np.log(SYMBOLS), np.float32)
        keys = self.grams[order - 1]
        at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        out = self.logs[order - 1][at]
        missing = np.flatnonzero(keys[at] != codes)
        if len(missing):
            rest = codes[missing]
            known = self.contexts[order - 1]
            near = np.minimum(np.searchsorted(known, rest >> BITS), len(known) - 1)
            weight = np.where((known[near] == rest >> BITS)[:, None], self.backoff[order - 1][near], np.float32(0))
            out[missing] = weight + self.characters(rest & ((1 << BITS * (order - 1)) - 1), order - 1)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in every language, and whether it has a letter."""
        sums, lengths, has = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
        for rows, parts in _parts(texts):
            grams, starts, letters = _codes(parts)
            ends = np.append(starts[1:] - (ORDER - 1), len(grams))
            running = np.concatenate((np.zeros((1, len(self.langs))), np.cumsum(self.characters(grams), axis=0, dtype=np.float64)))
            np.add.at(sums, rows, running[ends] - running[starts])
            np.add.at(lengths, rows, ends - starts)
            has[rows[letters]] = True
        return -sums / np.maximum(lengths, 1)[:, None], has


def _parts(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Rows and texts of about PART characters together; a longer text is read in several parts."""
    rows: list[int] = []
    parts: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        for at in range(0, max(len(text), 1), PART):
            rows.append(row)
            parts.append(text[at:at + PART])
            size += len(parts[-1])
            if size >= PART:
                yield np.array(rows), parts
                rows, parts, size = [], [], 0
    if rows:
        yield np.array(rows), parts


def _smoothed(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> LanguageModels:
    """Models from each language's sorted top-order codes and counts."""
    langs = sorted(counts)
    by_order: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {ORDER: [counts[x] for x in langs]}
    for k in range(ORDER - 1, 0, -1):  # a shorter n-gram counts once for each character seen before it
        by_order[k] = [np.unique(g & ((1 << BITS * k) - 1), return_counts=True) for g, _ in by_order[k + 1]]
    models = LanguageModels(langs)
    shorter = None
    for k in range(1, ORDER + 1):
        union = np.unique(np.concatenate([g for g, _ in by_order[k]]))
        contexts = np.unique(union >> BITS)
        below = np.full((len(union), len(langs)), 1 / SYMBOLS)
        if shorter is not None:
            below = shorter[np.searchsorted(models.grams[-1], union & ((1 << BITS * (k - 1)) - 1))]
        own, weight = np.zeros((len(union), len(langs))), np.ones((len(contexts), len(langs)))
        for j, (grams, n) in enumerate(by_order[k]):
            if not len(grams):
                continue
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
            mine, starts, distinct = np.unique(grams >> BITS, return_index=True, return_counts=True)
            total = np.add.reduceat(n, starts)
            at = np.searchsorted(contexts, mine)
            weight[at, j] = discount * distinct / total
            own[np.searchsorted(union, grams), j] = np.maximum(n - discount, 0) / np.repeat(total, distinct)
        shorter = own + weight[np.searchsorted(contexts, union >> BITS)] * below
        models.grams.append(union)
        models.logs.append(np.log(shorter).astype(np.float32))
        models.contexts.append(contexts)
        models.backoff.append(np.log(weight).astype(np.float32))
    return models


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = PER_LANG) -> LanguageModels:
    """Models of all languages among the documents that may be learned from."""
    known = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(id_key(id_col)), F.lit(DRAWS)) / DRAWS).alias("draw"),
        (F.crc32(id_key(id_col)) % 5 == 1).alias("aside"))
    per = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    if not per:
        return LanguageModels([])
    take = F.create_map(*[F.lit(x) for lang, n in per.items() for x in (lang, min(1.0, per_lang / n))])
    sample = known.filter(F.col("draw") < take[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), _texts(batch.column(1))
            for lang, (_, parts) in ((x, p) for x in sorted(set(langs)) for p in _parts([t for t, y in zip(texts, langs) if y == x])):
                grams, starts, _ = _codes(parts)
                inside = np.ones(len(grams), bool)
                for k in range(1, ORDER):  # n-grams that reach over the end of a text
                    inside[np.maximum(starts[1:] - k, 0)] = False
                codes, n = np.unique(grams[inside], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(n.astype(np.int64))],
                                                 ["lang", "code", "n"])

    spread = sample.filter(~F.col("aside")).select("lang", "text").mapInArrow(count, "lang string, code long, n long")
    table = spread.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas().sort_values(["lang", "code"])
    counts = {lang: (part["code"].to_numpy(), part["n"].to_numpy()) for lang, part in table.groupby("lang")}
    if not counts:
        return LanguageModels([])
    models = _smoothed(counts)
    calibrate(models, sample.filter("aside"))
    return models


def calibrate(models: LanguageModels, aside: DataFrame) -> None:
    """Temperature and rejection limit from labelled documents that the counts have not seen."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, has = models.entropies(_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(has)), pa.array(list(values[has]), pa.list_(pa.float64()))], ["lang", "h"])

    rows = aside.select("lang", "text").mapInArrow(measure, "lang string, h array<double>").collect()  # bounded as the sample is
    rows = [r for r in rows if r["lang"] in models.langs]
    if not rows:
        return
    h = np.array([r["h"] for r in rows])
    truth = np.array([models.langs.index(r["lang"]) for r in rows])
    grid = np.geomspace(0.005, 1.0, 40)
    models.temperature = float(min(grid, key=lambda t: -np.log(_soft(h, t)[np.arange(len(h)), truth] + 1e-12).mean()))
    best = h.min(axis=1)
    models.worst = float(np.quantile(best, 0.995) + 3 * best.std())


def _soft(h: np.ndarray, temperature: float) -> np.ndarray:
    odds = np.exp((h.min(axis=1, keepdims=True) - h) / temperature)
    return odds / odds.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: language, score, cross-entropy, and whether the text is as likely as known ones."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = models  # bounded by the training sample
        for batch in batches:
            ids, held, texts = batch.column(0), batch.column(1), _texts(batch.column(2))
            lang, chance, entropy = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.full(len(texts), np.nan)
            if own.langs and texts:
                h, has = own.entropies(texts)
                lang[has] = np.array(own.langs, object)[h.argmin(axis=1)][has]
                chance[has] = _soft(h, own.temperature).max(axis=1)[has]
                entropy[has] = h.min(axis=1)[has]
            yield pa.RecordBatch.from_arrays(
                [ids, held, pa.array(lang, pa.string()), pa.array(chance), pa.array(entropy), pa.array(entropy <= own.worst)],
                ["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "accepted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text")).mapInArrow(
        score, "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, accepted boolean")
