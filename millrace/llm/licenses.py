"""Licence scan: an Aho-Corasick automaton finds notices and identifier tags, a shunting-yard parser reads expressions.

A text's words (runs of ASCII letters and digits and of other characters, A-Z lower-cased) are joined by single blanks;
one automaton over such strings finds all notice phrases and all tags in one pass. Behind a tag the text itself is
read as a licence expression (identifiers, ``and``, ``or``, ``with``, ``/`` for or, parentheses; ``with`` binds
closest, then ``and``). It is turned to postfix order and evaluated: a choice takes the freest side, a conjunction the
strictest, an exception frees its licence by a step. A document's score is the strictest of its findings, from 0
(nothing found) to 1 (all rights reserved).

Defined cases: a null text is empty; an empty one has no words, no labels and the score 0; texts are read whole
whatever their length; an expression ends before the first token that cannot continue it, missing parentheses are
closed, an operator without a right side is left out, and one without a known identifier is no finding; repeated
rows are scanned each; null ids are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import per_process

# Phrases whose places count, and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Further notice phrases and their labels.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "apache 2 0 license": "apache-2.0",
    "bsd license": "bsd",
    "2 clause bsd": "bsd-2-clause",
    "3 clause bsd": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl-1.0",
    "artistic license": "artistic",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "gnu gpl": "gpl",
    "gnu lgpl": "lgpl",
    "gnu agpl": "agpl",
    "gnu free documentation license": "gfdl",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc0": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "public domain": "public-domain",
    "unlicense": "unlicense",
    "proprietary and confidential": "proprietary",
}

# What an expression may follow. The last two only with a colon or an equals sign.
TAGS = ("spdx license identifier", "licensed under", "released under", "available under", "distributed under", "license", "licence")
SIGNED = ("license", "licence")

# Families of labels and identifiers, and how far they bind; the first that matches counts.
FAMILIES = [
    (r"cc0|public-domain|unlicense|wtfpl|0bsd|mit-0", 0.1),
    (r"cc-by-nc|cc-by-nd", 0.9),
    (r"cc-by-sa|gfdl", 0.7),
    (r"cc-by", 0.3),
    (r"agpl", 0.8),
    (r"lgpl|mpl|epl|cddl|eupl", 0.5),
    (r"gpl", 0.7),
    (r"mit|isc|bsd|apache|zlib|bsl|artistic", 0.2),
    (r"reserved|proprietary|licenseref", 1.0),
]
EXCEPTION = 0.2

_IDENTIFIER = re.compile(
    r"(?:cc0(?:-1\.0)?|unlicense|wtfpl|0bsd|mit(?:-0)?|isc|zlib|bsd-[0-9]-clause|bsl-1\.0|artistic-[12]\.0|apache-[12]\.[01]"
    r"|mpl-[12]\.[01]|epl-[12]\.0|cddl-1\.[01]|eupl-1\.[012]|(?:a|l)?gpl-[123]\.[01](?:-only|-or-later)?|gfdl-1\.[123](?:-only|-or-later)?"
    r"|cc-by(?:-nc)?(?:-sa|-nd)?(?:-[1234]\.[05])?|proprietary|licenseref-[a-z0-9.-]+)\+?")
_EXCEPTION_NAME = re.compile(r"[a-z0-9][a-z0-9.-]*-exception(?:-[0-9.]+)?|classpath|linking-exception")
_TOKEN = re.compile(r"\s*([()/]|[a-z0-9][a-z0-9.+-]*)", re.ASCII)
_LEAD = re.compile(r"[ \t]*(?:[:=][ \t]*)?[\"'`]?[ \t]*(?:(?:the|either|both)\s+)?", re.ASCII)
_SIGN = re.compile(r"[ \t\"'`]*[:=]")
_GAPS = re.compile(rb"[^0-9a-z\x80-\xff]+")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_PRIORITY = {"or": 1, "and": 2, "with": 3}


def restriction(label: str) -> float:
    for pattern, value in FAMILIES:
        if re.match(pattern, label):
            return value
    return 1.0


def _tokens(text: str, at: int) -> list[str]:
    """The longest run of tokens from ``at`` on that begins an expression; each operator has its right side.

    ``with`` stands between an identifier and the name of an exception only.
    """
    out: list[str] = []
    good = depth = 0
    expects = "licence"
    while m := _TOKEN.match(text, at):
        token, at = m.group(1), m.end()
        whole = token.rstrip(".")
        if expects == "licence":
            if token == "(":
                depth += 1
            elif _IDENTIFIER.fullmatch(whole):
                expects = "with"
            else:
                break
        elif expects == "exception":
            if not _EXCEPTION_NAME.fullmatch(whole):
                break
            expects = "operator"
        elif token == "with" and expects == "with":
            expects = "exception"
        elif token == ")" and depth:
            depth -= 1
            expects = "operator"
        elif token in ("and", "or", "/"):
            expects = "licence"
        else:
            break
        out.append("or" if token == "/" else whole)
        if expects in ("with", "operator"):
            good = len(out)
        if token != whole:  # the end of a sentence
            break
    return out[:good]


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands and operators in postfix order; open parentheses are closed at the end."""
    out, held = [], []
    for token in tokens:
        if token == "(":
            held.append(token)
        elif token == ")":
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif token in _PRIORITY:
            while held and held[-1] != "(" and _PRIORITY[held[-1]] >= _PRIORITY[token]:
                out.append(held.pop())
            held.append(token)
        else:
            out.append(token)
    return out + [t for t in reversed(held) if t != "("]


def evaluate(order: list[str]) -> tuple[float, list[str]]:
    """How far a postfix expression binds, and the licences it names, with their exceptions."""
    stack: list[tuple[float, str]] = []
    labels: list[str] = []
    for token in order:
        if token not in _PRIORITY:
            name = token[:-1] + "-or-later" if token.endswith("+") else token
            stack.append((restriction(name), name))
            labels.append(name)
            continue
        (right, exception), (left, licence) = stack.pop(), stack.pop()
        if token == "with":
            labels[-2:] = [f"{licence}-with-{exception}"]
            stack.append((max(0.05, left - EXCEPTION), labels[-1]))
        else:
            stack.append(((min if token == "or" else max)(left, right), ""))
    return stack[0][0], labels


@dataclass
class Found:
    """What a text holds: base places as (word, label), labels of phrases and of expressions, and these with their values."""
    n_words: int = 0
    base: list[tuple[int, str]] = field(default_factory=list)
    noticed: set[str] = field(default_factory=set)
    named: set[str] = field(default_factory=set)
    expressions: list[str] = field(default_factory=list)
    binds: float = 0.0

    @property
    def labels(self) -> list[str]:
        return sorted(self.noticed | self.named)

    @property
    def score(self) -> float:
        return max([self.binds, *map(restriction, self.noticed)])


def automaton() -> ahocorasick.Automaton:
    """Finds every phrase and tag; its values are the phrase and what it is: (kind, label) pairs."""
    out = ahocorasick.Automaton()
    phrases: dict[str, list[tuple[str, str]]] = {}
    for kind, table in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in table.items():
            phrases.setdefault(phrase, []).append((kind, label))
    for phrase, uses in phrases.items():
        out.add_word(f" {phrase} ", (phrase, uses))
    out.make_automaton()
    return out


def scan(raw: bytes, machine: ahocorasick.Automaton) -> Found:
    """All findings of one text, given in UTF-8."""
    low = raw.lower()  # bytes: A-Z only
    joined = _GAPS.sub(b" ", low).strip(b" ")
    out = Found(n_words=joined.count(b" ") + 1 if joined else 0)
    spaced = b" " + joined + b" "
    tags: dict[int, list[str]] = {}
    at = word = 0
    for start, phrase, uses in sorted((end - len(phrase) - 1, phrase, uses) for end, (phrase, uses) in machine.iter(spaced.decode("latin-1"))):
        word += spaced.count(b" ", at, start)
        at = start
        for kind, label in uses:
            if kind == "tag":
                tags.setdefault(word + phrase.count(" "), []).append(phrase)
                continue
            if kind == "base":
                out.base.append((word, label))
            out.noticed.add(label)
    if tags:
        _read(low, tags, out)
    return out


def _read(low: bytes, tags: dict[int, list[str]], out: Found) -> None:
    """Expressions behind the tags, which are given by the numbers of their last words."""
    text, last, done = low.decode("latin-1"), max(tags), 0
    for k, m in enumerate(_WORD.finditer(low)):
        if k in tags and m.start() >= done and (any(p not in SIGNED for p in tags[k]) or _SIGN.match(text, m.end())):
            tokens = _tokens(text, _LEAD.match(text, m.end()).end())
            if tokens:
                binds, labels = evaluate(postfix(tokens))
                out.expressions.append(" ".join(tokens))
                out.named.update(labels)
                out.binds = max(out.binds, binds)
                done = m.end() + len(out.expressions[-1])
        if k == last:
            break


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, base places with their first and last, labels, score, and the expressions found."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = per_process("licenses", automaton)
        for batch in batches:
            found = [scan(t or b"", machine) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            starts = [[w for w, _ in f.base] for f in found]
            columns = [
                batch.column(0), pa.array([f.n_words for f in found], pa.int64()), pa.array([len(s) for s in starts], pa.int64()),
                pa.array([min(s, default=None) for s in starts], pa.int64()), pa.array([max(s, default=None) for s in starts], pa.int64()),
                pa.array([",".join(sorted({k for _, k in f.base})) for f in found], pa.string()),
                pa.array([",".join(f.labels) for f in found], pa.string()), pa.array([f.score for f in found], pa.float64()),
                pa.array(["; ".join(f.expressions) for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                                                       "score", "expressions"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        search, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
                "score double, expressions string")
