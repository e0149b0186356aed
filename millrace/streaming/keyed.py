"""Keyed state and timers (``transformWithState``) for rules whose state is a few values per key.

Rules work on event times in milliseconds and on rows packed as JSON, so one processor serves rows of any columns. They do not
depend on the order in which rows arrive, within the watermark where a rule has timers: replays, several
micro-batches and files in any order give the same rows. Rules that many rows of one key meet in are run on keys that
are reduced first (``login_log``), or keep only what is still open (``newest_after_hold``).

A call of a processor and each of its accesses to state cost far more than a row, so all rules but the running profile are
keyed by one of ``BUCKETS`` buckets of the keys' hash: a call takes the rows of all keys of a bucket, whose state is one packed
value. A bucket is held in a task as a whole, and written whole by the micro-batches that touch it.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.shipping import by_value

#: Times keep their microseconds through JSON.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
#: Buckets of keys; part of a job's checkpoint.
BUCKETS = 2048


def _bucket(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")


def _key(keys: list[str]) -> Column:
    """Values of the keys as one string that is never null."""
    return F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), _JSON).alias("key")


class _Packed:
    """A Python value as the state of a bucket."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getValueState(name, "packed binary")

    def get(self, default):
        return pickle.loads(self.state.get()[0]) if self.state.exists() else default

    def put(self, value) -> None:
        self.state.update((pickle.dumps(value, 5),))


class _Alarm:
    """The one timer of a bucket, at the earliest time that any of its keys waits for."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle, self.state = handle, handle.getValueState("due", "t long")

    def no_later_than(self, t: int) -> None:
        known = self.state.get()[0] if self.state.exists() else None
        if known is None or t < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(t)
            self.state.update((t,))

    def rang(self) -> None:
        self.state.clear()


class NewestAfterHold(StatefulProcessor):
    """Holds a key's rows for ``hold_ms`` from the first one on, then emits the newest of them; for the keys of a bucket.

    State is the rows that are not yet emitted; a timer stands where the earliest of them is due. When the
    watermark passes it, the rows up to there have all come, so holds are cut in the order of event times.
    """

    def __init__(self, hold_ms: int):
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", "packed binary")
        self.alarm = _Alarm(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            self.open.appendValue((pickle.dumps([frame[c].tolist() for c in ("key", "t", "body")], 5),))
            self.alarm.no_later_than(int(frame["t"].min()) + self.hold_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.rang()
        due = timerValues.getCurrentWatermarkInMs() - self.hold_ms
        rows = sorted(r for (packed,) in self.open.get() for r in zip(*pickle.loads(packed)))
        times = [t for _, t, _ in rows]
        first = [i for i, r in enumerate(rows) if not i or r[0] != rows[i - 1][0]]
        newest, left = [], []
        for at, end in zip(first, [*first[1:], len(rows)]):
            while at < end and times[at] <= due:
                at = bisect_left(times, times[at] + self.hold_ms, at, end)
                newest.append(rows[at - 1][2])
            left += rows[at:end]
        if left:
            self.open.put([(pickle.dumps([list(c) for c in zip(*left)], 5),)])
            self.alarm.no_later_than(min(t for _, t, _ in left) + self.hold_ms)
        else:
            self.open.clear()
        if newest:
            yield pd.DataFrame({"body": newest})

    def close(self) -> None:
        pass


def newest_after_hold(df: DataFrame, keys: list[str], time: str, hold_ms: int = 5000, delay: str = "0 seconds") -> DataFrame:
    """Delay-then-emit dedup: of a key's rows within ``hold_ms`` of the first, the newest once the watermark has passed.

    Rows of one time are ordered by their columns. Rows later than the watermark (``delay``) are dropped.
    """
    packed = df.select(_bucket(*keys), _key(keys), F.col(time).alias("et"), F.unix_millis(time).alias("t"),
                       F.to_json(F.struct(*df.columns), _JSON).alias("body"))
    out = packed.withWatermark("et", delay).groupBy("bucket").transformWithStateInPandas(
        NewestAfterHold(hold_ms), "body string", "Append", "EventTime")
    return out.select(F.from_json("body", df.schema, _JSON).alias("r")).select("r.*")


class NewestWins(StatefulProcessor):
    """Emits a row if its version is above the one stored for the key, or if that was stored ``ttl_ms`` or longer before.

    State is the last emitted version and its time of each key of a bucket; a timer forgets those that the watermark is that
    far ahead of.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = _Packed(handle, "last")
        self.alarm = _Alarm(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, changed, out = self.last.get({}), [], []
        columns = ("t", "version", "body", "key")
        for t, version, body, k in sorted(r for frame in rows for r in zip(*(frame[c].tolist() for c in columns))):
            known = last.get(k)
            if known is None or version > known[0] or t - known[1] >= self.ttl_ms:
                last[k] = (version, t)
                changed.append(t)
                out.append(body)
        if out:
            self.last.put(last)
            self.alarm.no_later_than(min(changed) + self.ttl_ms)
            yield pd.DataFrame({"body": out})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.rang()
        ended = timerValues.getCurrentWatermarkInMs() - self.ttl_ms
        last = {k: (version, t) for k, (version, t) in self.last.get({}).items() if t > ended}
        self.last.put(last)
        if last:
            self.alarm.no_later_than(min(t for _, t in last.values()) + self.ttl_ms)
        return iter(())

    def close(self) -> None:
        pass


def newest_wins_until(df: DataFrame, keys: list[str], time: str, version: str, ttl_ms: int, delay: str = "0 seconds") -> DataFrame:
    """Newest-wins dedup whose memory of a key ends ``ttl_ms`` after the row that was let through last.

    ``version`` is a whole number. Rows of one micro-batch are taken in the order of their times; rows later than the
    watermark (``delay``) are dropped. A key's rows of one micro-batch are in one task.
    """
    packed = df.select(_bucket(*keys), _key(keys), F.col(time).alias("et"), F.unix_millis(time).alias("t"),
                       F.col(version).cast("bigint").alias("version"), F.to_json(F.struct(*df.columns), _JSON).alias("body"))
    packed = packed.where("t is not null and version is not null")
    out = packed.withWatermark("et", delay).groupBy("bucket").transformWithStateInPandas(
        NewestWins(ttl_ms), "body string", "Append", "EventTime")
    return out.select(F.from_json("body", df.schema, _JSON).alias("r")).select("r.*")


class RunningProfile(StatefulProcessor):
    """For each row of a key in the order of times: how many there were so far, and the distinct values of its fields so far.

    A key that is silent for ``ttl_ms`` starts anew; a timer forgets it when the watermark is that far ahead.
    """

    def __init__(self, fields: list[str], ttl_ms: int):
        self.fields, self.ttl_ms = fields, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "n long, t long, " + ", ".join(f"s{k} array<string>" for k in range(len(self.fields))))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, last, *held = self.known.get() if self.known.exists() else (0, None, *[[] for _ in self.fields])
        sets = [set(h) for h in held]
        shown = [",".join(sorted(s)) for s in sets]
        columns = ["t", "body", *[f"f{k}" for k in range(len(self.fields))]]
        out = []
        for t, body, *values in sorted((r for frame in rows for r in zip(*(frame[c].tolist() for c in columns))), key=lambda r: r[:2]):
            if last is not None and t - last >= self.ttl_ms:
                n, sets, shown = 0, [set() for _ in self.fields], [""] * len(self.fields)
            n, last = n + 1, t
            for k, v in enumerate(values):
                if v is not None and v not in sets[k]:
                    sets[k].add(v)
                    shown[k] = ",".join(sorted(sets[k]))
            out.append((body, n, *shown))
        self.known.update((n, last, *[sorted(s) for s in sets]))
        self.handle.registerTimer(last + self.ttl_ms)
        yield pd.DataFrame(out, columns=["body", "n", *[f"f{k}" for k in range(len(self.fields))]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.known.exists() and self.known.get()[1] + self.ttl_ms <= timerValues.getCurrentWatermarkInMs():
            self.known.clear()
        return iter(())

    def close(self) -> None:
        pass


def running_profile(df: DataFrame, key: str, time: str, fields: list[str], ttl_ms: int, out: str = "pv", delay: str = "0 seconds") -> DataFrame:
    """Each row with the number of its key's rows so far and, in place of each field, its distinct values so far, sorted and joined.

    Rows of one time are ordered by their columns; rows later than the watermark (``delay``) and without a time are dropped. A
    key's rows of one micro-batch are in one task.
    """
    rest = [c for c in df.columns if c not in fields]
    packed = df.where(F.col(time).isNotNull()).select(
        F.col(key).alias("k0"), F.col(time).alias("et"), F.unix_millis(time).alias("t"), F.to_json(F.struct(*rest), _JSON).alias("body"),
        *[F.col(f).cast("string").alias(f"f{k}") for k, f in enumerate(fields)])
    schema = ", ".join(["body string", "n long", *[f"f{k} string" for k in range(len(fields))]])
    rows = packed.withWatermark("et", delay).groupBy("k0").transformWithStateInPandas(RunningProfile(fields, ttl_ms), schema, "Append", "EventTime")
    return rows.withColumn("r", F.from_json("body", df.select(*rest).schema, _JSON)).select(
        "r.*", F.col("n").alias(out), *[F.col(f"f{k}").alias(f) for k, f in enumerate(fields)])


class FirstOfDay(StatefulProcessor):
    """Keeps the first time per user and day of a bucket; an earlier one that comes later takes it back (sign -1) and stands in
    for it (+1)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = _Packed(handle, "first")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, out = self.first.get({}), []
        fresh = pd.concat(list(rows)).groupby(["user", "day"], sort=False)["t"].min()
        for k, t in zip(fresh.index.tolist(), fresh.tolist()):
            known = first.get(k)
            if known is None or t < known:
                first[k] = t
                out += [(*k, t, 1)] if known is None else [(*k, t, 1), (*k, known, -1)]
        if out:
            self.first.put(first)
            yield pd.DataFrame(out, columns=["user", "day", "t", "sign"])

    def close(self) -> None:
        pass


class LoginFlags(StatefulProcessor):
    """Flags of users' login days: each day counts once (``uu``), and is a win-back (``back``) after ``gap`` days of absence.

    State is the days of a bucket's users with their first times. A day that is added late, or whose first time changes, changes
    its own row and the flag of the day that follows it: rows that no longer hold are taken back with sign -1.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = _Packed(handle, "days")

    def _flags(self, days: dict[int, int]) -> set[tuple[int, int, int]]:
        ordered = sorted(days)
        return {(d, days[d], int(k > 0 and d - ordered[k - 1] >= self.gap)) for k, d in enumerate(ordered)}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.days.get({})
        net: dict[str, dict[tuple[int, int], int]] = {}
        for frame in rows:
            for user, d, t, sign in zip(*(frame[c].tolist() for c in ("user", "day", "t", "sign"))):
                if user not in net:
                    net[user] = {day: 1 for day in held.get(user, {}).items()}
                net[user][d, t] = net[user].get((d, t), 0) + sign
        out = []
        for user, days in net.items():
            now = {d: t for (d, t), n in days.items() if n > 0}
            before, after = self._flags(held.get(user, {})), self._flags(now)
            held[user] = now
            out += [(user, *r, 1) for r in sorted(after - before)] + [(user, *r, -1) for r in sorted(before - after)]
        self.days.put(held)
        if out:
            yield pd.DataFrame(out, columns=["user", "day", "t", "back", "sign"])

    def close(self) -> None:
        pass


def login_log(df: DataFrame, user: str, time: str, gap: int = 8) -> DataFrame:
    """Change log of flagged login days: (user, login_date, time, uu, back, sign), for rows in any order of arrival.

    Two keyed states in one plan: the first is dealt by user and day, so that the second has a row per day and user
    however often a user logs in; a user without a name is left out.
    """
    rows = df.where(F.col(user).isNotNull() & F.col(time).isNotNull()).select(
        F.col(user).cast("string").alias("user"), F.unix_date(F.to_date(time)).alias("day"), F.unix_micros(time).alias("t"))
    firsts = rows.withColumn("bucket", _bucket("user", "day")).groupBy("bucket").transformWithStateInPandas(
        FirstOfDay(), "user string, day int, t long, sign int", "Append", "None")
    flags = firsts.withColumn("bucket", _bucket("user")).groupBy("bucket").transformWithStateInPandas(
        LoginFlags(gap), "user string, day int, t long, back int, sign int", "Append", "None")
    return flags.select(F.col("user").cast(df.schema[user].dataType).alias(user), F.date_from_unix_date("day").alias("login_date"),
                        F.timestamp_micros("t").alias(time), F.lit(1).alias("uu"), "back", "sign")


by_value(__name__)
