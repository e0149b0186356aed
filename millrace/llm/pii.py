"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The base patterns find e-mail addresses, IPv4 addresses, card numbers and phone numbers, leftmost and without
overlap per kind. The field reads the surroundings of digits, ``@`` and spelt-out signs (``(at)``, ``dot``), with some words
on either side: pieces are runs of letters, runs of digits or single signs; features are their shapes and those of their
neighbours, and the words around. It is trained on the labelled rows below and decoded by Viterbi in padded numpy
batches. It is meant for what the patterns can't see: spelt-out addresses, phone numbers without a plus, cards of 13 to
15 digits. A span it finds is added if it passes the kind's plausibility test and meets no other span.

Defined cases: a null text is empty; an empty one has no spans; offsets count code points, ends excluded; texts
are read whole, in time that grows with their length: long stretches are decoded in windows that overlap; repeated
rows are searched each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
#: Outside, then beginning and inside of each kind.
N_LABELS = 1 + 2 * len(KINDS)
DIMENSIONS = 1 << 14
#: Feature names whose numbers a task keeps.
NAMES = 1 << 17
#: Cells (windows times pieces) of one Viterbi batch.
CELLS = 1 << 16
#: Characters whose stretches are decoded together, words that are read on either side of a sign, and characters a word counts by.
PART, AROUND, REACH = 1 << 20, 3, 64
#: Pieces of a window, from how many on the next one begins, and pieces of context that are left to the window before.
WINDOW, STRIDE, LEAD = 128, 96, 8

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_SIGN = re.compile(r"[0-9@]|[(\[]\s?(?:at|dot)\s?[)\]]|(?<=\s)dot(?=\s)", re.IGNORECASE)
_PIECE = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
_WORDS = re.compile(r"\S+")
_AT, _DOT = r"(?:\s?@\s?|\s?[(\[]\s?at\s?[)\]]\s?|\sat\s)", r"(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?|\sdot\s)"
_ADDRESS = re.compile(rf"[\w+-]+(?:{_DOT}[\w+-]+)*{_AT}[\w-]+(?:{_DOT}[\w-]+)+", re.IGNORECASE)

# The labelled table, all values invented or public test numbers. Spans stand between <kind> and </>.
LABELLED = """
Write to <email>jane.doe@mail.example.com</> for details.
Contact: <email>info@example.org</>, <email>sales-team@shop.example.net</>
De <email>m.dupont+news@poste.example.fr</> le 12 mai
Schreiben Sie an <email>kontakt99@firma.example.de</>.
correo <email>ana_lopez@correo.example.es</> o tel.
write to <email>jane.doe (at) example (dot) com</> for details
mail <email>info [at] example.org</> today
my address is <email>bob at example dot net</>, please answer
reach <email>team.red [at] shop [dot] example [dot] org</> any time
email: <email>peter (at) firma.example.de</>
contact <email>maria dot lopez at correo dot es</> or call
adresse <email>claire(at)poste(dot)fr</> merci
an <email>h.meier at example dot de</> schreiben
her mail <email>lucy99 at example dot com</> works
meet me at the station dot
we met at noon in a town
the dot at the end of a line
look at version 3 dot 2 of it
at home (at last) they slept
follow @someone on the site
user @ home 12 of 30
Call <phone>+1 (202) 555-0143</> now.
Tel. <phone>+49 30 5550 1234</> oder Fax
phone <phone>(202) 555-0143</> after six
phone: <phone>202-555-0143</>, ext 4
call <phone>202.555.0143</> please
he said (<phone>202 555 0178</>) again
her number is <phone>(303) 555-0112</> at home
and <phone>404-555-0199</> at work
fax <phone>(415) 555-0164</>.
ring <phone>312.555.0107</> today
dial <phone>617 555 0121</> for help
number <phone>(718) 555-0190</> is new
téléphone <phone>01 55 50 12 34</> le soir
appelez le <phone>06 12 55 50 98</> merci
teléfono <phone>915 550 123</> hoy
móvil <phone>655 501 234</>.
Telefon <phone>030 5550-1234</> ab acht
mobile <phone>0171 5550123</>.
Fax <phone>0711/5550-987</> Stuttgart
rufen Sie <phone>089 5550 4321</> an
appelez <phone>+33 1 55 50 12 34</>%%% demain
reach me at <phone>(206) 555-0135</> or by mail
the host <ip>192.0.2.17</> was down
server at <ip>10.0.0.7</>, port 80
von <ip>192.168.1.20</>: Zugriff
adresse <ip>198.51.100.182</>!! de
ip <ip>203.0.113.71</>*** next
card <card>4111 1111 1111 1111</> expired
Karte <card>5500-0000-0000-0004</> gesperrt
pay with <card>4012888888881881</> soon
tarjeta <card>5105105105105100</>&&& no
card number <card>3400 000000 00009</> amex
amex <card>378282246310005</> on file
my card is <card>3714 496353 98431</>, thanks
carte <card>30569309025904</> du client
diners <card>3852 000002 3237</> paid
old card <card>4222222222222</> closed
Licensed under CC BY-NC 4.0.
Apache License, Version 2.0. See the text
General Public License, version 3.
token = "0123456789abcdef0123456789abcdef01234567" of
key fedcba9876543210fedcba9876543210fedcba98 and
On 2021-05-06 at 10:30 we met 12 people
born 12.05.1987 in a town of 30000
price 1,299.00 for 3 items (100 %)
section 1.2.3 and table 4.5
chapter 12, pages 100-120, 1999
order 12345678 of 10000000 pieces
order 2023-000123-45 was sent
version 2.10.3-beta4 released
room 555 on floor 3, building 12
in 1914-1918 and 1939-1945 there
score 3:2 after 90 minutes
ISBN 978-3-16-148410-0 hardback
ISBN 0-306-40615-2 paper
the year 2020 and the 21st century
7 1/2 inches, 20 x 30 cm
from 08:00 to 17:30 on 24.12.2022
12 300 000 people in 1990
1 000 000 of 2 500 000 items
serial 8841 2201 9930 of 2019
invoice 100 200 300 dated 2001-02-03
latitude 48.8566 and 2.3522 east
won 21-14 21-18 in 2015
lot 4829 1034 5521 is sold
""".strip().splitlines()


def _luhn(digits: str) -> bool:
    turned = [int(d) for d in reversed(digits)]
    return (sum(turned[::2]) + sum(sum(divmod(2 * d, 10)) for d in turned[1::2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the base patterns, in the order of kinds and starts."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        before = text[free:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            out.append((0, at - local, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group()) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.sub("", m.group())) <= 15]
    return out


def plausible(kind: int, found: str) -> bool:
    """Whether a span of the field can be of its kind."""
    digits = _DIGITS.sub("", found)
    if kind == 0:
        return len(found) <= 128 and bool(_ADDRESS.fullmatch(found))
    if kind == 1:
        parts = found.split(".")
        return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and _luhn(digits) and not re.search(r"[^0-9 -]", found)
    return 8 <= len(digits) <= 15 and len(found) <= 24 and not re.search(r"[^0-9 ().+/-]", found) and bool(re.search(r"[ ().-]", found))


def _shape(piece: str) -> str:
    if piece[0].isdigit():
        return f"d{min(len(piece), 9)}"
    if piece[0].isalpha():
        return ("A" if piece[0].isupper() else "a") + str(min(len(piece), 4))
    return piece


def _features(text: str, pieces: list[tuple[int, int]], numbers: dict[str, int] | None = None) -> list[list[int]]:
    """Numbers of each piece's features; ``numbers`` keeps those of names seen before."""
    known = {} if numbers is None else numbers
    words = [text[a:b] for a, b in pieces]
    shapes = ["^", "^", *map(_shape, words), "$", "$"]
    low = ["^", "^", *(w.lower()[:24] for w in words), "$"]
    out = []
    for i, (a, _) in enumerate(pieces):
        gap = "01"[i > 0 and pieces[i - 1][1] < a]
        p, q, s, n, m = shapes[i:i + 5]
        row = []
        for x in (f"s{s}", f"ps{p}|{q}|{s}", f"qs{q}|{s}{gap}", f"sn{s}|{n}", f"snm{s}|{n}|{m}", f"qsn{q}|{s}|{n}",
                  f"w{low[i + 2]}" if s[0] in "aA" else f"g{gap}{s}", f"v{low[i + 1]}|{s}", f"u{low[i]}|{q}|{s}", f"n{low[i + 3]}|{s}"):
            k = known.get(x)
            if k is None:
                k = zlib.crc32(x.encode()) % DIMENSIONS
                if len(known) < NAMES:
                    known[x] = k
            row.append(k)
        out.append(row)
    return out


@dataclass
class Field:
    """Weights of features and of label pairs."""
    emit: np.ndarray
    move: np.ndarray

    def decode(self, windows: list[list[list[int]]]) -> list[np.ndarray]:
        """Best labels of each window; windows of like length are decoded together."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(windows)
        order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to - at + 1) * len(windows[order[to]]) <= CELLS:
                to += 1
            some = order[at:to]
            for i, labels in zip(some, self._batch([windows[i] for i in some])):
                out[i] = labels
            at = to
        return out

    def _batch(self, windows: list[list[list[int]]]) -> list[np.ndarray]:
        lengths = np.array([len(w) for w in windows])
        scores = _padded(self.emit, windows)
        n, steps, _ = scores.shape
        best, back = scores[:, 0] + _first(), np.zeros((n, steps, N_LABELS), np.int8)
        finals = best.copy()
        for t in range(1, steps):
            paths = best[:, :, None] + self.move[None] + _allowed()[None]
            back[:, t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + scores[:, t]
            finals = np.where((lengths > t)[:, None], best, finals)
        labels = np.zeros((n, steps), np.int64)
        rows, last = np.arange(n), finals.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            here = lengths > t
            last = np.where(here & (lengths - 1 > t), back[rows, min(t + 1, steps - 1), last], last)
            labels[:, t] = last
        return [row[:k] for row, k in zip(labels, lengths)]


def _padded(emit: np.ndarray, windows: list[list[list[int]]]) -> np.ndarray:
    scores = np.zeros((len(windows), max(map(len, windows)), N_LABELS))
    for i, w in enumerate(windows):
        scores[i, :len(w)] = emit[np.array(w)].sum(axis=1)
    return scores


def _allowed() -> np.ndarray:
    """Zero where one label may follow another: the inside of a kind only follows its beginning or inside."""
    out = np.zeros((N_LABELS, N_LABELS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = -1e9
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return out


def _first() -> np.ndarray:
    return np.array([0.0] + [0.0, -1e9] * len(KINDS))


def _read(row: str) -> tuple[str, list[tuple[int, int, int]]]:
    """A labelled row as plain text and its spans."""
    text, spans, start = "", [], None
    for part in re.split(r"(<\w+>|</>)", row):
        if part == "</>":
            spans.append((*start, len(text)))
        elif re.fullmatch(r"<\w+>", part):
            start = (KINDS.index(part[1:-1]), len(text))
        else:
            text += part
    return text, spans


def learned_rows(rows: list[str]) -> tuple[list[list[list[int]]], list[np.ndarray]]:
    """Features and gold labels of labelled rows."""
    windows, golds = [], []
    for row in rows:
        text, spans = _read(row)
        pieces = [m.span() for m in _PIECE.finditer(text)]
        gold = np.zeros(len(pieces), np.int64)
        for kind, start, end in spans:
            inside = [i for i, (a, b) in enumerate(pieces) if a >= start and b <= end]
            gold[inside] = 2 + 2 * kind
            gold[inside[0]] = 1 + 2 * kind
        windows.append(_features(text, pieces))
        golds.append(gold)
    return windows, golds


def slopes(field: Field, windows: list[list[list[int]]], golds: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood of the gold labels and its slopes by the field's weights, by sums forward and backward."""
    lengths = np.array([len(w) for w in windows])
    n, top = len(windows), int(lengths.max())
    rows_at, piece_at = np.nonzero(np.arange(top)[None] < lengths[:, None])
    flat, labels = np.array([f for w in windows for f in w]), np.concatenate(golds)
    scores, move = _padded(field.emit, windows), field.move + _allowed()
    ahead, behind = np.zeros((n, top, N_LABELS)), np.zeros((n, top, N_LABELS))
    ahead[:, 0] = scores[:, 0] + _first()
    for t in range(1, top):
        ahead[:, t] = scores[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + move[None], axis=1)
    for t in range(top - 2, -1, -1):
        further = np.logaddexp.reduce(move[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where((lengths - 1 > t)[:, None], further, 0.0)
    whole = np.logaddexp.reduce(ahead[np.arange(n), lengths - 1], axis=1)
    loss = whole.sum() - scores[rows_at, piece_at, labels].sum()
    chance = np.exp(ahead + behind - whole[:, None, None])[rows_at, piece_at]
    chance[np.arange(len(labels)), labels] -= 1
    emit = np.zeros_like(field.emit)
    np.add.at(emit, flat.ravel(), np.repeat(chance, flat.shape[1], axis=0))
    pairs = np.zeros_like(field.move)
    for t in range(1, top):
        live = lengths > t
        joint = ahead[live, t - 1, :, None] + move[None] + (scores[live, t] + behind[live, t])[:, None, :]
        pairs += np.exp(joint - whole[live, None, None]).sum(axis=0)
    for gold in golds:
        np.add.at(pairs, (gold[:-1], gold[1:]), -1)
        loss -= field.move[gold[:-1], gold[1:]].sum()
    return float(loss), emit, pairs


def train(rows: list[str] | None = None, steps: int = 150, rate: float = 0.5, decay: float = 0.01) -> Field:
    """Field that maximises the rows' penalised likelihood, by adaptive gradient steps on all rows at once."""
    windows, golds = learned_rows(rows or LABELLED)
    field = Field(np.zeros((DIMENSIONS, N_LABELS)), np.zeros((N_LABELS, N_LABELS)))
    sums = [np.full(field.emit.shape, 1e-6), np.full(field.move.shape, 1e-6)]
    for _ in range(steps):
        _, emit, pairs = slopes(field, windows, golds)
        for weights, change, total in ((field.emit, emit, sums[0]), (field.move, pairs, sums[1])):
            change += decay * weights
            total += change ** 2
            weights -= rate * change / np.sqrt(total)
    return field


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Where signs and the words around them stand; stretches that touch are one."""
    start = end = -1
    for m in _SIGN.finditer(text):
        if m.end() <= end - REACH:  # well inside the last one
            continue
        lo = max(0, m.start() - REACH)
        left = [w.start() for w in _WORDS.finditer(text, lo, m.start())][-AROUND:]
        right = [w.end() for w in _WORDS.finditer(text, m.end(), m.end() + REACH)][:AROUND + 1]
        first, last = lo + (left[0] - lo if left else m.start() - lo), right[-1] if right else m.end()
        if first > end:
            if end > start:
                yield start, end
            start = first
        end = max(end, last)
    if end > start:
        yield start, end


def _windows(text: str) -> Iterator[tuple[list[tuple[int, int]], int, int]]:
    """Pieces of a window, and from which to before which one the spans that begin there are this window's."""
    for start, end in _stretches(text):
        pieces = [p.span() for p in _PIECE.finditer(text, start, end)]
        for at in range(0, max(1, len(pieces) - (WINDOW - STRIDE)), STRIDE):
            last = at + WINDOW >= len(pieces)
            yield pieces[at:at + WINDOW], LEAD if at else 0, WINDOW if last else STRIDE + LEAD


def find(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """Base spans and all spans of each text."""
    bases = [base_spans(t) for t in texts]
    windows, places, numbers = [], [], {}
    for i, text in enumerate(texts):
        for pieces, lo, hi in _windows(text):
            if len(pieces) > 1:
                windows.append(_features(text, pieces, numbers))
                places.append((i, pieces, lo, hi))
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    taken: dict[int, bytearray] = {}
    for (i, pieces, lo, hi), labels in zip(places, field.decode(windows)):
        for a in np.flatnonzero(labels % 2 == 1).tolist():
            if not lo <= a < hi:
                continue
            b = a + 1
            while b < len(labels) and labels[b] == labels[a] + 1:
                b += 1
            kind, start, end = int(labels[a] - 1) // 2, pieces[a][0], pieces[b - 1][1]
            if i not in taken:
                taken[i] = bytearray(len(texts[i]))
                for _, s, e in bases[i]:
                    taken[i][s:e] = b"\1" * (e - s)
            if taken[i].find(1, start, end) < 0 and plausible(kind, texts[i][start:end]):
                added[i].append((kind, start, end))
                taken[i][start:end] = b"\1" * (end - start)
    return [(base, sorted(base + more)) for base, more in zip(bases, added)]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts and spans, and all spans with the field's."""
    model = field or train()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
            found = [x for a, b in slices(ends, PART) for x in find(texts[a:b], model)]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([_listed(base) for base, _ in found], pa.string()),
                 pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([_listed(spans) for _, spans in found], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        search, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, spans string")
