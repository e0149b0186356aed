"""Repeated byte strings across documents, by suffix arrays over the places that can repeat.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller id. The work has three
passes over batches of documents, which are shuffled once:

1. Each ``LENGTH``-byte window is stood for by its anchor, the ``GRAM``-byte string in it with the smallest hash. Equal
   windows have equal anchors, so a window can repeat only if its anchor does. Batches send their distinct
   anchors, as 32-bit remainders, to buckets, which answer with those seen in more than one document, and with the number
   of parts of those whose distinct stretches are more than a shard. (Remainders that collide only cost work.)
2. Batches cut out the stretches of windows with such an anchor, each distinct one once with its smallest and
   largest document, and send them to buckets by anchor: the shards. A shard sorts the suffixes of its stretches
   by Larsson-Sadakane refinement, finds common prefixes with neighbours by Kasai's rule, and so the smallest
   document of each window. Where an anchor's stretches are more than a shard holds, each batch is a shard of its own: its
   suffix array puts its distinct windows in order, and each part, which a hash of the window names, merges the sorted
   windows of all batches by binary search; so equal ones meet, and no task has all surroundings of a template.
   Batches get back the smallest document for runs of windows.
3. Batches apply the answers to their documents and cut out what goes.

A shard's input has one row per batch and distinct stretch or window, so a passage that a third of all documents hold
weighs as much as there are batches.

Defined cases: a null text is empty; null ids are larger than any other and not smaller than one another, like
rows that repeat an id; texts shorter than a window stay whole; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import per_process, text_bytes
from millrace.llm.shingles import BASE, STEP, inverse, mixed, powers

LENGTH, GRAM = 50, 20
#: Windows with one anchor at one place, and the bytes of their stretch, at most.
RUN, WIDEST = LENGTH - GRAM + 1, 2 * LENGTH - GRAM
#: Bytes of text in a batch, behind an anchor bucket, and behind a shard's bucket; bytes of stretches in a suffix array;
#: bytes of text below which neither batch nor bucket is made smaller.
BATCH, ANCHORS, STRETCHES, SHARD, LEAST = 8 << 20, 64 << 20, 8 << 20, 2 << 20, 1 << 20
#: Bytes of a batch that are hashed at a time; positions in such a part fit PLACE bits.
PART, PLACE = 2 << 20, 24
LAST = np.iinfo(np.int64).max
#: Numbers that parts of anchors are dealt to, above the shards' buckets.
SPACE = 1 << 30
MESSAGE = "target int, batch int, kind int, a binary, b binary, c binary, d binary, e binary, f binary"
NAMES = ["target", "batch", "kind", *"abcdef"]
SHARED, STRINGS, PLACES, ANSWERS, WINDOWS, WINDOW_PLACES, WINDOW_ANSWERS = range(7)


def _message(target: int, batch: int, kind: int, *arrays: np.ndarray) -> tuple:
    """Arrays go as planes of their first, second, ... bytes: numbers far below their type's range shuffle as few bytes."""
    blobs = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays]
    return (target, batch, kind, *blobs, *[b""] * (6 - len(blobs)))


def _arrays(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    width = np.dtype(kind).itemsize
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(kind).ravel() for x in table.column(name).to_pylist()]


def _array(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate(_arrays(table, name, kind))


def _rows(messages: list[tuple]) -> pa.Table:
    columns = list(zip(*messages)) if messages else [[]] * len(NAMES)
    kinds = [pa.int32()] * 3 + [pa.binary()] * 6
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=NAMES)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _parts(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first document, document after the last, start, end) of parts; long documents in parts that overlap by a window less one."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PART, "right")) - 1)
        lo, hi = int(offsets[at]), int(offsets[to])
        for start in range(lo, max(hi - LENGTH + 1, lo + 1), PART):
            yield at, to, start, min(start + PART + LENGTH - 1, hi)
        at = to


class Stretches:
    """Runs of windows with one anchor in a batch of documents: document, first window, number of windows, anchor."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, checked: bool = True):
        """``checked`` stretches have a second hash beside their mark, which tells them apart with it."""
        self.checked = checked
        found = [self._part(data[lo:hi], offsets, at, to, lo) for at, to, lo, hi in _parts(offsets) if hi - lo >= LENGTH]
        joined = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64)]
        self.doc, self.start, self.count, self.anchor, self.mark, self.check = joined

    def _part(self, data: np.ndarray, offsets: np.ndarray, at: int, to: int, lo: int) -> tuple[np.ndarray, ...]:
        n = len(data)
        sums, back = _prefix(data, BASE)
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * back[:n - GRAM + 1])
        places = np.arange(len(grams), dtype=np.uint64)
        low = np.uint64((1 << PLACE) - 1)
        least = _least(grams & ~low | places, LENGTH - GRAM + 1)
        where = (least & low).astype(np.int64)
        ends = offsets[at + 1:to + 1] - lo
        inside = np.ones(n - LENGTH + 1, bool)
        for end in ends[ends < n]:  # windows over the end of a document
            inside[max(end - LENGTH + 1, 0):end] = False
        new = inside.copy()
        new[1:] &= (where[1:] != where[:-1]) | ~inside[:-1]
        last = inside.copy()
        last[:-1] &= (where[1:] != where[:-1]) | ~inside[1:]
        first, final = np.flatnonzero(new), np.flatnonzero(last)
        stops = final + LENGTH
        length = (stops - first).astype(np.uint64)
        mark = mixed((sums[stops] - sums[first]) * back[first] + length)
        check = mark
        if self.checked:
            others, back = _prefix(data, STEP)
            check = mixed((others[stops] - others[first]) * back[first] + length)
        return at + np.searchsorted(ends, first, "right"), first + lo, final - first + 1, grams[where[first]], mark, check


def _prefix(data: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a text's rolling hash, and the powers that shift a difference of them; powers for a part are kept in a worker."""
    n, most = len(data), PART + LENGTH
    if n < most:
        there, back = per_process(f"powers {int(base)} {most}", lambda: (powers(most, base), powers(most, inverse(base))))
    else:
        there, back = powers(n, base), powers(n + 1, inverse(base))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * there[:n], out=sums[1:])
    return sums, back[:n + 1]


def _batch(table: pa.Table) -> tuple[pa.ChunkedArray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids as given, ids as numbers, bytes and offsets of a batch's documents, always in the same order."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
    ids = table.column("doc_id")
    data, offsets = text_bytes(table.column("text").chunk(0) if len(table) else pa.array([], pa.string()))
    return ids, pc.fill_null(ids, LAST).to_numpy().astype(np.int64), data, offsets


def _distinct_anchors(table: pa.Table, n_buckets: int) -> pa.Table:
    """Pass 1, a batch: its anchors by bucket, which of them are in several of its documents, and their distinct stretches."""
    batch = table.column("batch")[0].as_py()
    _, ids, data, offsets = _batch(table)
    runs = Stretches(data, offsets, checked=False)
    order = np.argsort(runs.anchor)
    anchors, docs = runs.anchor[order], ids[runs.doc[order]]
    if not len(anchors):
        return _rows([])
    starts = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    several = np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)
    distinct = _distinct(runs.mark[order], starts)
    anchors = anchors[starts]
    bucket, rest = _screened(anchors, n_buckets)
    order = np.lexsort((rest, bucket))
    bucket, rest, several, distinct = bucket[order], rest[order], several[order], distinct[order]
    edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
    return _rows([_message(b, batch, SHARED, rest[lo:hi], several[lo:hi], distinct[lo:hi])
                  for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo])


def _distinct(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Different marks in each of the runs that begin at ``starts``."""
    counts = np.diff(np.append(starts, len(marks)))
    many = np.flatnonzero(counts > 1)
    out = np.ones(len(starts), np.uint32)
    run, values = np.repeat(many, counts[many]), marks[_ranges(starts[many], counts[many])]
    order = np.lexsort((values, run))
    values = values[order]  # runs stay where they are
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (values[1:] != values[:-1])
    out[many] = np.bincount(run[new], minlength=len(starts))[many]
    return out


def _screened(anchors: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return (anchors >> np.uint64(32)) % np.uint64(n_buckets), anchors.astype(np.uint32)


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """Pass 1, a bucket: for each batch those of its anchors that several documents hold, and their parts, 0 if a shard holds them."""
    bucket, batches = table.column("target")[0].as_py(), table.column("batch").to_pylist()
    values = _arrays(table, "a", np.uint32)
    several, distinct = _array(table, "b", bool), _array(table, "c", np.uint32)
    joined = np.concatenate(values)
    order = np.argsort(joined, kind="stable")
    ordered = joined[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    shared = np.empty(len(joined), bool)
    shared[order] = np.repeat((counts > 1) | np.logical_or.reduceat(several[order], starts), counts)
    stretches = np.add.reduceat(distinct[order].astype(np.int64), starts)
    parts = np.empty(len(joined), np.uint32)
    parts[order] = np.repeat(np.where(stretches * WIDEST > SHARD, -(-stretches * RUN * LENGTH // STRETCHES), 0), counts)
    edges = np.cumsum([0, *map(len, values)])
    return _rows([_message(bucket, b, SHARED, v[shared[lo:hi]], parts[lo:hi][shared[lo:hi]])
                  for b, v, lo, hi in zip(batches, values, edges, edges[1:]) if shared[lo:hi].any()])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and count, one after the other."""
    total = int(counts.sum())
    skip = np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + np.arange(total) - skip


def _cut_out(docs: pa.Table, shared: pa.Table, n_screens: int, n_buckets: int) -> pa.Table:
    """Pass 2, a batch: its distinct stretches that may repeat, by bucket, and where they are; windows of anchors in parts."""
    if not len(docs) or not len(shared):
        return _rows([])
    batch = docs.column("batch")[0].as_py()
    _, ids, data, offsets = _batch(docs)
    runs = Stretches(data, offsets)
    bucket, rest = _screened(runs.anchor, n_screens)
    wanted = np.concatenate([x.astype(np.uint64) | np.uint64(b << 32) for b, x in zip(
        shared.column("target").to_pylist(), _arrays(shared, "a", np.uint32))])
    order = np.argsort(wanted)
    wanted, parts = wanted[order], _array(shared, "b", np.uint32)[order]
    key = bucket << np.uint64(32) | rest.astype(np.uint64)
    at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
    some = np.flatnonzero(wanted[at] == key)
    order = some[np.lexsort((ids[runs.doc[some]], runs.check[some], runs.mark[some], runs.anchor[some]))]
    new = np.ones(len(order), bool)
    for column in (runs.anchor, runs.mark, runs.check):
        values = column[order]
        new[1:] &= values[1:] == values[:-1]
    new[1:] = ~new[1:]
    firsts = np.flatnonzero(new)
    name = np.cumsum(new) - 1
    one = order[firsts]
    low, high = ids[runs.doc[one]], ids[runs.doc[order[np.append(firsts[1:], len(order)) - 1]]]
    lengths = runs.count[one] + LENGTH - 1
    target = (mixed(runs.anchor[one]) % np.uint64(n_buckets)).astype(np.int64)
    parts = parts[at[one]]
    whole, cut = np.flatnonzero(parts == 0), np.flatnonzero(parts)
    by_target = whole[np.argsort(target[whole], kind="stable")]
    edges = np.searchsorted(target[by_target], np.arange(n_buckets + 1))
    out = _cut_up(data, batch, n_buckets, cut, runs.start[one[cut]], runs.count[one[cut]], runs.anchor[one[cut]], parts[cut],
                  low[cut], high[cut]) if len(cut) else []
    for b, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if hi > lo:
            x = by_target[lo:hi]
            out.append(_message(b, batch, STRINGS, data[_ranges(runs.start[one[x]], lengths[x])], lengths[x].astype(np.uint16),
                                x.astype(np.uint32), (runs.anchor[one[x]] >> np.uint64(32)).astype(np.uint32), low[x], high[x] - low[x]))
    out.append(_message(-1 - batch, batch, PLACES, name.astype(np.uint32), runs.doc[order].astype(np.uint32),
                        runs.start[order] - offsets[runs.doc[order]]))
    return _rows(out)


def _cut_up(data: np.ndarray, batch: int, n_buckets: int, names: np.ndarray, first: np.ndarray, count: np.ndarray,
            anchors: np.ndarray, parts: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple]:
    """Messages of stretches whose anchors are in parts: this batch's shard of them, its distinct windows in order by part,
    and the stretches they are in. Shards are of bounded size; a batch with more such text has several."""
    size = count + LENGTH - 1
    shard = (np.cumsum(size) - 1) // SHARD
    out, done = [], 0
    places: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for s in range(int(shard[-1]) + 1):
        some = np.flatnonzero(shard == s)
        if not len(some):
            continue
        n = size[some]
        text = data[_ranges(first[some], n)]
        starts = np.cumsum(n) - n
        order = suffix_array(text)
        shared = common_prefixes(text, order, starts, n)
        string = np.repeat(np.arange(len(some)), n)
        place = np.arange(len(text)) - starts[string]
        whole = place <= n[string] - LENGTH
        # windows in the order of the array; a run of equal ones is one window
        new = np.ones(len(text), bool)
        new[1:] = shared[order[1:]] < LENGTH
        run = np.cumsum(new) - 1
        keep = whole[order]
        at, run = order[keep], run[keep]
        firsts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.empty(0, np.int64)
        of = some[string[at]]
        least, most = np.minimum.reduceat(low[of], firsts), np.maximum.reduceat(high[of], firsts)
        head = at[firsts]
        sums, back = _prefix(text, BASE)
        mark = mixed((sums[head + LENGTH] - sums[head]) * back[head])
        target = (mixed(anchors[of[firsts]] + mark % parts[of[firsts]].astype(np.uint64)) % np.uint64(SPACE)).astype(np.int64) + n_buckets
        by_target = np.argsort(target, kind="stable")  # the order within a part stays that of the array
        edges = np.flatnonzero(np.concatenate(([True], np.diff(target[by_target]) != 0, [True])))
        for lo, hi in zip(edges, edges[1:]):
            x = by_target[lo:hi]
            out.append(_message(int(target[x[0]]), batch, WINDOWS, text[_ranges(head[x], np.full(len(x), LENGTH))],
                                (done + x).astype(np.uint32), least[x], most[x] - least[x]))
        window = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(at))))
        places.append((done + window, names[of], place[at]))
        done += len(firsts)
    number, name, place = (np.concatenate(c) for c in zip(*places))
    return [*out, _message(-1 - batch, batch, WINDOW_PLACES, number.astype(np.uint32), name.astype(np.uint32), place.astype(np.uint16))]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in their order; one that ends comes before those that go on."""
    n = len(text)
    key = _eights(np.concatenate((text, np.zeros(7, np.uint8))))
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    # the text's last suffixes, filled up with zeros above, are told apart by their length below
    ahead = 8
    while True:  # groups that are not yet single are ordered by what follows, twice as far each time
        single = new.copy()
        single[:-1] &= new[1:]
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            return order
        at = order[open_at]
        follows = np.where(at + ahead < n, n + 1 + rank[np.minimum(at + ahead, n - 1)], n - at)
        pair = rank[at] << 32 | follows
        by_pair = np.argsort(pair, kind="stable")
        order[open_at], pair = at[by_pair], pair[by_pair]
        new[open_at[1:]] |= pair[1:] != pair[:-1]
        rank[order[open_at]] = np.maximum.accumulate(np.where(new[open_at], open_at, 0))
        ahead *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Bytes, up to ``most``, that each suffix shares with the one before it in ``order``.

    By Kasai's rule a suffix shares at most one byte less than the suffix one place before it in the text; the rule runs
    along all strings at once, a place at a time.
    """
    n = len(text)
    before = np.empty(n, np.int32)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    out = np.zeros(n, np.int16)
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    eights = _eights(np.concatenate((text, np.zeros(most + 8, np.uint8))))
    shared = np.zeros(len(starts), np.int64)
    for k in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -k, "left"))
        at = starts[:live] + k
        other = before[at]
        shared = np.maximum(shared[:live] - 1, 0)
        shared[other < 0] = 0
        grow = np.flatnonzero((other >= 0) & (shared < most))
        while len(grow):  # eight bytes at a time
            done = shared[grow]
            a, b = at[grow] + done, other[grow] + done
            differ = eights[a] ^ eights[b]
            whole = differ == 0
            equal = np.where(whole, 8, _equal_bytes(differ))
            shared[grow] = done = np.minimum(done + np.minimum(equal, n - np.maximum(a, b)), most)
            grow = grow[whole & (done < most) & (np.maximum(a, b) + 8 < n)]
        out[at] = shared
    return out


def _eights(padded: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, the first one highest."""
    n = len(padded) - 7
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k:n + k]
    return key


def _equal_bytes(differ: np.ndarray) -> np.ndarray:
    """Zero bytes at the front of each number that is not zero."""
    out = np.zeros(len(differ), np.int64)
    for bits in (56, 48, 40, 32, 24, 16, 8):
        out += differ < np.uint64(1 << bits)
    return out


def smallest_documents(text: np.ndarray, lengths: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of the strings in ``text``: its start, and the smallest document of an equal one; and the windows' order."""
    starts = np.cumsum(lengths) - lengths
    order = suffix_array(text)
    shared = common_prefixes(text, order, starts, lengths)
    string = np.repeat(np.arange(len(lengths)), lengths)
    whole = np.arange(len(text)) - starts[string] <= lengths[string] - LENGTH
    docs = np.where(whole, low[string], LAST)[order]
    firsts = np.flatnonzero(np.concatenate(([True], shared[order[1:]] < LENGTH)))
    least = np.empty(len(text), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(docs, firsts), np.diff(np.append(firsts, len(order))))
    windows = np.flatnonzero(whole)
    return windows, least[windows], order[whole[order]]


def _merged(shards: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For the sorted, distinct windows of shards with their smallest documents: the smallest of all shards.

    Two shards at a time become one: the windows of the smaller are found in the larger by binary search.
    """
    held = [(values, least) for values, least in shards if len(values)]
    while len(held) > 1:
        held.sort(key=lambda h: len(h[0]))
        paired = []
        for i in range(0, len(held) - 1, 2):
            (few, theirs), (many, least) = held[i], held[i + 1]
            at = np.searchsorted(many, few)
            there = many[np.minimum(at, len(many) - 1)] == few
            least = least.copy()
            least[at[there]] = np.minimum(least[at[there]], theirs[there])
            paired.append((np.insert(many, at[~there], few[~there]), np.insert(least, at[~there], theirs[~there])))
        held = paired + held[len(held) - len(held) % 2:]
    return [held[0][1][np.searchsorted(held[0][0], values)] if len(values) else least for values, least in shards]


def _search(table: pa.Table) -> pa.Table:
    """Pass 2, a bucket: suffix arrays of its shards; runs of windows with their smallest document, for each batch."""
    if table.column("target")[0].as_py() < 0:  # places
        return table.select(NAMES)
    if table.column("kind")[0].as_py() == WINDOWS:
        return _merge_windows(table)
    batches = np.repeat(table.column("batch").to_numpy(), [len(x) // 2 for x in table.column("b").to_pylist()])
    text, lengths, names, anchors, low, high = (_array(table, c, t) for c, t in zip(
        "abcdef", (np.uint8, np.uint16, np.uint32, np.uint32, np.int64, np.int64)))
    lengths, high = lengths.astype(np.int64), low + high
    starts = np.cumsum(lengths) - lengths
    # equal stretches of several batches are one string of the shard
    whole = text.tobytes()
    numbers: dict[bytes, int] = {}
    string = np.array([numbers.setdefault(whole[a:a + n], len(numbers)) for a, n in zip(starts.tolist(), lengths.tolist())])
    first = np.full(len(numbers), len(string))
    np.minimum.at(first, string, np.arange(len(string)))
    least_low, most_high = np.full(len(numbers), LAST), np.full(len(numbers), -LAST)
    np.minimum.at(least_low, string, low)
    np.maximum.at(most_high, string, high)
    by_anchor = np.argsort(anchors[first], kind="stable")
    size = np.cumsum(lengths[first[by_anchor]])
    runs = []
    for group in _shards(size, anchors[first[by_anchor]]):
        done, windows_of = [], []
        for lo, hi in group:
            strings = by_anchor[lo:hi]
            part = text[_ranges(starts[first[strings]], lengths[first[strings]])]
            windows, least, in_order = smallest_documents(part, lengths[first[strings]], least_low[strings])
            done.append((part, windows, least, in_order))
        if len(done) > 1:  # names of anchors that collide
            sorted_windows = []
            for part, windows, least, in_order in done:
                values = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(part, LENGTH)[in_order]).view(f"S{LENGTH}").ravel()
                head = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
                sorted_windows.append((values[head], least[np.searchsorted(windows, in_order[head])]))
                windows_of.append((in_order, np.repeat(np.arange(len(head)), np.diff(np.append(head, len(values))))))
            merged = []
            for (_, windows, least, _), (in_order, window), found in zip(done, windows_of, _merged(sorted_windows)):
                whole_least = np.empty_like(least)
                whole_least[np.searchsorted(windows, in_order)] = found[window]
                merged.append(whole_least)
        else:
            merged = [done[0][2]]
        for (lo, hi), (_, windows, _, _), least in zip(group, done, merged):
            strings = by_anchor[lo:hi]
            n = lengths[first[strings]]
            own = np.repeat(np.arange(len(strings)), n - LENGTH + 1)
            place = windows - (np.cumsum(n) - n)[own]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (least[1:] != least[:-1])
            at = np.flatnonzero(new)
            to = np.append(at[1:], len(own)) - 1
            keep = least[at] < most_high[strings[own[at]]]
            runs.append((strings[own[at]][keep], place[at][keep], place[to][keep], least[at][keep]))
    of, start, stop, least = (np.concatenate(c) for c in zip(*runs))
    order = np.argsort(of, kind="stable")
    of, start, stop, least = of[order], start[order], stop[order], least[order]
    count = np.searchsorted(of, np.arange(len(numbers)), "right") - np.searchsorted(of, np.arange(len(numbers)))
    begin = np.cumsum(count) - count
    at = _ranges(begin[string], count[string])
    entry = np.repeat(np.arange(len(string)), count[string])
    keep = least[at] < high[entry]
    at, entry = at[keep], entry[keep]
    by_batch = np.argsort(batches[entry], kind="stable")
    at, entry = at[by_batch], entry[by_batch]
    ids, edges = np.unique(batches[entry], return_index=True)
    edges = np.append(edges, len(entry))
    return _rows([_message(-1 - int(b), int(b), ANSWERS, names[entry[lo:hi]], start[at[lo:hi]].astype(np.uint16),
                           stop[at[lo:hi]].astype(np.uint16), least[at[lo:hi]]) for b, lo, hi in zip(ids, edges, edges[1:])])


def _merge_windows(table: pa.Table) -> pa.Table:
    """Pass 2, a part of an anchor: the sorted windows of the batches' shards merged; the smallest document of each window, for
    each batch that has it in a larger one."""
    shards = []
    for text, low in zip(_arrays(table, "a", np.uint8), _arrays(table, "c", np.int64)):
        shards.append((text.view(f"S{LENGTH}"), low))
    names, high = _arrays(table, "b", np.uint32), _arrays(table, "d", np.int64)
    out = []
    for b, name, (_, low), up, least in zip(table.column("batch").to_pylist(), names, shards, high, _merged(shards)):
        keep = least < low + up
        if keep.any():
            out.append(_message(-1 - b, b, WINDOW_ANSWERS, name[keep], least[keep]))
    return _rows(out)


def _shards(size: np.ndarray, anchors: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    """Ranges of strings of about SHARD bytes, whole anchors each; an anchor beyond that is a list of ranges."""
    n, lo = len(size), 0
    edges = np.append(np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1]))), n)
    while lo < n:
        done = size[lo - 1] if lo else 0
        fits = int(np.searchsorted(size, done + SHARD, "right"))
        hi = int(edges[np.searchsorted(edges, max(fits, lo), "right") - 1])
        if hi > lo:
            yield [(lo, hi)]
        else:
            hi = int(edges[np.searchsorted(edges, lo, "right")])
            group, at = [], lo
            while at < hi:
                done = size[at - 1] if at else 0
                to = min(hi, max(at + 1, int(np.searchsorted(size, done + SHARD, "right"))))
                group.append((at, to))
                at = to
            yield group
        lo = hi


def _answered(messages: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """(stretch, first window, last window, smallest document) of a batch's answers."""
    kinds = messages.column("kind").to_numpy()
    answers, found, places = (messages.filter(pa.array(kinds == k)) for k in (ANSWERS, WINDOW_ANSWERS, WINDOW_PLACES))
    if len(answers):
        yield tuple(_array(answers, c, t).astype(np.int64) for c, t in zip("abcd", (np.uint32, np.uint16, np.uint16, np.int64)))
    if len(found):
        window, least = _array(found, "a", np.uint32), _array(found, "b", np.int64)
        number, of, place = (_array(places, c, t) for c, t in zip("abc", (np.uint32, np.uint32, np.uint16)))
        begin = np.searchsorted(number, window)  # places are sorted by the windows' numbers
        count = np.searchsorted(number, window, "right") - begin
        where, least = _ranges(begin, count), np.repeat(least, count)
        of, place = of[where].astype(np.int64), place[where].astype(np.int64)
        order = np.lexsort((place, of))
        of, place, least = of[order], place[order], least[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1) | (least[1:] != least[:-1])
        first = np.flatnonzero(new)
        yield of[first], place[first], place[np.append(first[1:], len(of)) - 1], least[first]


def _cut_away(docs: pa.Table, messages: pa.Table) -> pa.Table:
    """Pass 3, a batch: what goes of each document."""
    given, ids, data, offsets = _batch(docs)
    n = len(ids)
    change = np.zeros(len(data) + 1, np.int32)
    answers = list(_answered(messages))
    places = messages.filter(pc.equal(messages.column("kind"), PLACES))
    if answers and len(places):
        name, doc, at = (_array(places, c, t) for c, t in zip("abc", (np.uint32, np.uint32, np.int64)))
        of, start, stop, least = (np.concatenate(c) for c in zip(*answers))
        begin = np.searchsorted(name, of)  # places are sorted by name
        count = np.searchsorted(name, of, "right") - begin
        where, answer = _ranges(begin, count), np.repeat(np.arange(len(of)), count)
        goes = ids[doc[where]] > least[answer]
        where, answer = where[goes], answer[goes]
        base = offsets[doc[where]] + at[where]
        np.add.at(change, base + start[answer], 1)
        np.add.at(change, base + stop[answer] + LENGTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    new = gone.copy()
    new[1:] &= ~gone[:-1]
    new[offsets[:-1][offsets[:-1] < len(data)]] = gone[offsets[:-1][offsets[:-1] < len(data)]]
    upto, spans_upto = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(new)))
    removed, spans = np.diff(upto[offsets]), np.diff(spans_upto[offsets])
    digests, listed = [], []
    for i in range(n):
        lo, hi = offsets[i], offsets[i + 1]
        kept = data[lo:hi] if not removed[i] else data[lo:hi][~gone[lo:hi]]
        digests.append(hashlib.sha256(kept.tobytes()).hexdigest())
        turns = np.flatnonzero(np.diff(np.concatenate(([0], gone[lo:hi].view(np.int8), [0])))) if removed[i] else np.empty(0, np.int64)
        listed.append(turns.astype(np.int64))
    return pa.Table.from_arrays(
        [given.cast(pa.int64()), pa.array(np.diff(offsets)), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64)),
         pa.array(digests, pa.string()), pa.array(listed, pa.list_(pa.int64()))],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_edges"])


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: bytes, bytes that go, spans they form, digest of what stays, starts and ends of the spans."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    # as many batches and buckets as keep all tasks busy, but none for less than LEAST bytes: messages are a row per both
    busy = max(1, min(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes // LEAST))
    n_batches, n_screens, n_buckets = (max(-(-n_bytes // most), busy) for most in (BATCH, ANCHORS, STRETCHES))
    read = docs.select(F.pmod(F.xxhash64(F.col(id_col), F.lit("batch")), F.lit(n_batches)).cast("int").alias("batch"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    by_batch = read.groupBy("batch")
    anchors = by_batch.applyInArrow(lambda t: _distinct_anchors(t, n_screens), MESSAGE)
    shared = anchors.groupBy("target").applyInArrow(_repeated_anchors, MESSAGE)
    strings = by_batch.cogroup(shared.groupBy("batch")).applyInArrow(lambda d, s: _cut_out(d, s, n_screens, n_buckets), MESSAGE)
    answers = strings.groupBy("target").applyInArrow(_search, MESSAGE)
    return by_batch.cogroup(answers.groupBy("batch")).applyInArrow(
        _cut_away, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_edges array<long>")
