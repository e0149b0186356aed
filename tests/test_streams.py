"""Streams over several input files must equal the batch meaning."""

import datetime as dt
import os
import random
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import at
from millrace.operators import sequence as sq
from millrace.sinks import batch as sink
from millrace.sinks.merge import KeyedTable, earliest_image, latest_image, partial_image
from millrace.sinks.workspace import scratch, shared_dir
from millrace.sources import cdc
from millrace.sources.tables import stream_table
from millrace.streaming import images, keyed, runner, trade, traffic
from millrace.streaming.runner import appended_as_stream, run_append, run_batches, run_sums, run_upsert, split_late


@pytest.fixture(scope="module")
def feed(spark):
    """Rows of a few keys with repeats, spread over four files in time order."""
    r = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = sorted((base + dt.timedelta(minutes=i * 11), f"k{0 if r.random() < 0.4 else r.randrange(12)}", i, r.randrange(300), r.choice("01")) for i in range(400))
    df = spark.createDataFrame(data, "ts timestamp, k string, id long, v long, flag string")
    path = scratch(spark, "feed")
    for part in range(4):
        df.where((F.col("id") >= part * 100) & (F.col("id") < part * 100 + 100)).coalesce(1).write.mode("append").parquet(path)
    return path, df


def stream(spark, path):
    return stream_table(spark, path, files_per_trigger=1)


def test_retractions_over_batches(spark, feed, rows):
    path, df = feed
    got = images.retractions(stream(spark, path), ["k"], ["ts"])
    assert got.count() == 400 + 400 - df.select("k").distinct().count()
    assert rows(got) == rows(sq.retractions(df, ["k"], ["ts"]))


def test_newest_wins_over_batches(spark, feed, rows):
    path, df = feed
    assert rows(images.newest_wins(stream(spark, path), ["k"], "ts", ["id"], "v")) == rows(sq.newest_wins(df, ["k"], "ts", ["id"], "v"))


def test_new_flag_over_batches(spark, feed, rows):
    path, df = feed
    want = sq.repair_new_flag(df, "k", "flag", "ts", sq.first_seen(df, "k", "flag", "ts", ["id"]))
    assert rows(images.repair_new_flag(stream(spark, path), "k", "flag", "ts", ["id"])) == rows(want)


def in_files(spark, df, parts, label, n=4):
    """A folder with a file per number in ``parts`` order."""
    path = scratch(spark, label)
    for part in parts:
        df.where(F.pmod("id", F.lit(n)) == part).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("parts", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_login_log_over_files_in_any_order(spark, rows, parts):
    """The summed log holds each login day once with its flag, whatever order days and first times come in."""
    r = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    data = [(r.choice(["a", "b", "c", None]), base + dt.timedelta(days=r.randrange(90), seconds=r.randrange(86400), microseconds=i), i) for i in range(240)]
    df = spark.createDataFrame(data, "u string, ts timestamp, id long")
    log = appended_as_stream(keyed.login_log(stream(spark, in_files(spark, df, parts, "t-login")), "u", "ts"), "t-login", keyed=True)
    stored = run_batches(log, "t-log", lambda batch: batch, log.schema)
    net = stored.groupBy("u", "login_date", "ts", "back").agg(F.sum("sign").alias("n")).where("n <> 0")
    want = sq.login_flags(df.where("u is not null"), "u", "ts").withColumn("n", F.lit(1))
    assert rows(net) == rows(want, "u", "login_date", "first_time", "back", "n")
    assert stored.where("sign < 0").count() > 0


def held(data, hold, mark):
    """The newest of each hold that is over at ``mark``."""
    out = []
    for k in {d[1] for d in data}:
        mine, i = sorted(d for d in data if d[1] == k), 0
        while i < len(mine):
            j = max(n for n in range(i, len(mine)) if mine[n][0] < mine[i][0] + hold)
            if mine[i][0] + hold <= mark:
                out.append(mine[j])
            i = j + 1
    return sorted(out, key=str)


def test_newest_after_hold_over_shuffled_files(spark):
    """Within the watermark's delay files may come in any order; holds that no row follows are the latest rows per key."""
    r = random.Random(2)
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(milliseconds=r.randrange(90000)), r.choice(["a", "b", "c"]), i) for i in range(160)]
    data += [(base + dt.timedelta(minutes=5 + i), "end", 1000 + i) for i in range(4)]
    df = spark.createDataFrame(data, "ts timestamp, k string, id long")
    got = run_append(keyed.newest_after_hold(stream(spark, in_files(spark, df, (2, 0, 3, 1), "t-held")), ["k"], "ts", 5000, "10 minutes"), "t-held", keyed=True)
    assert got.count() == 0  # nothing is due yet
    late = spark.createDataFrame([(base + dt.timedelta(hours=1), "end", 9)], "ts timestamp, k string, id long")
    path = in_files(spark, df, (1, 3, 0, 2), "t-held")
    late.coalesce(1).write.mode("append").parquet(path)
    got = run_append(keyed.newest_after_hold(stream(spark, path), ["k"], "ts", 5000, "10 minutes"), "t-held", keyed=True)
    mark = base + dt.timedelta(minutes=50)
    assert sorted(map(tuple, got.select("ts", "k", "id").collect()), key=str) == held(data, dt.timedelta(seconds=5), mark)
    long_hold = run_append(keyed.newest_after_hold(stream(spark, path), ["k"], "ts", 120_000, "10 minutes"), "t-held", keyed=True)
    newest = df.where("k <> 'end'").groupBy("k").agg(F.max(F.struct("ts", "id"))["id"].alias("id"))
    assert sorted(map(tuple, long_hold.where("k <> 'end'").select("k", "id").collect())) == sorted(map(tuple, newest.collect()))


@pytest.mark.parametrize("ttl", [10, 3600, 86400])
def test_memory_of_a_key_ends(spark, rows, ttl):
    """A key that comes back after its time to live starts anew, in the same micro-batch or a later one."""
    base = dt.datetime(2024, 1, 1)
    steps = [0, ttl // 2, ttl + ttl // 2 - 1, 4 * ttl, 4 * ttl + 1, 9 * ttl]
    data = [(k, base + dt.timedelta(seconds=s), 100 - 10 * i if k == "falls" else i, i) for i, s in enumerate(steps) for k in ("falls", "grows", None)]
    df = spark.createDataFrame(data, "k string, ts timestamp, v long, n long")
    for cuts in ((6,), (1, 2, 3, 4, 5, 6)) if ttl == 10 else ((3, 4, 6),):
        path, lo = scratch(spark, "t-ttl"), 0
        for hi in cuts:
            df.where((F.col("n") >= lo) & (F.col("n") < hi)).coalesce(1).write.mode("append").parquet(path)
            lo = hi
        log = images.retractions(stream(spark, path), ["k"], ["ts"], ttl=ttl)
        assert rows(log) == rows(sq.retractions_within(df, ["k"], ["ts"], ttl))
        assert rows(log.where("sign < 0 and k = 'falls'"), "n") == [(0,), (1,), (3,)]
        kept = run_append(keyed.newest_wins_until(stream(spark, path), ["k"], "ts", "v", ttl * 1000), "t-until", keyed=True)
        assert rows(kept.where("k = 'falls'"), "n") == [(0,), (2,), (3,), (5,)]
        assert kept.where("k = 'grows'").count() == kept.where("k is null").count() == 6


def test_running_profile_over_batches(spark, rows):
    """The profile as of each row, however the rows are cut into batches; a silent key starts anew."""
    r = random.Random(6)
    base, clock, data = dt.datetime(2024, 1, 1), 0, []
    for i in range(120):
        clock += r.choice([1, 5, 30, 400])
        data.append((i, r.choice(["a", "b", None]), base + dt.timedelta(seconds=clock), r.choice(["x", "y", "z"]), r.choice([None, "p", "q"])))
    df = spark.createDataFrame(data, "id long, k string, ts timestamp, c string, d string")
    want = []
    for k in ("a", "b", None):
        n, last, c, d = 0, None, set(), set()
        for i, _, ts, x, y in (row for row in data if row[1] == k):
            if last is not None and ts - last >= dt.timedelta(seconds=600):
                n, c, d = 0, set(), set()
            n, last, c, d = n + 1, ts, c | {x}, d | ({y} if y else set())
            want.append((i, k, ts, n, ",".join(sorted(c)), ",".join(sorted(d))))
    for cuts in ((120,), (7, 50, 51, 120)):
        path, lo = scratch(spark, "t-profile"), 0
        for hi in cuts:
            df.where((F.col("id") >= lo) & (F.col("id") < hi)).coalesce(1).write.mode("append").parquet(path)
            lo = hi
        got = run_append(keyed.running_profile(stream(spark, path), "k", "ts", ["c", "d"], 600_000), "t-profile", keyed=True)
        assert sorted(map(tuple, got.select("id", "k", "ts", "pv", "c", "d").collect())) == sorted(want)


def test_expired_stretches_are_dropped_and_emptied(spark, rows, monkeypatch):
    monkeypatch.setattr(KeyedTable, "EVERY", 2)
    monkeypatch.setattr(KeyedTable, "AGE", 1)
    schema = spark.createDataFrame([], "k string, ts timestamp, v long").schema
    table = KeyedTable(scratch(spark, "t-expire"), ["k"], "ts", schema=schema, expire=("ts", 10))
    base = dt.datetime(2024, 1, 1)
    batches = [spark.createDataFrame([(f"k{i}", base + dt.timedelta(seconds=8 * i), i), ("hot", base + dt.timedelta(seconds=8 * i), i)], schema) for i in range(8)]
    for i, batch in enumerate(batches):
        if i:
            seen = rows(table.read(spark, before=i, batch=batch), "k")
            assert ("hot",) in seen and (f"k{i - 1}",) in seen  # eight seconds before
            assert (f"k{i - 3}",) not in seen
        table.upsert(batch, i)
    index = spark.read.json(f"{table.path}-index/batch=7")
    assert index.agg(F.min("bucket")).first()[0] >= int(base.replace(tzinfo=dt.timezone.utc).timestamp() + 56) // 10 - 1
    assert spark.read.parquet(f"{table.path}/batch=0").count() == 0


def test_late_rows_of_a_watermark_without_delay(spark, rows):
    """Rows of one batch don't make each other late; later batches do, and the late ones are listed."""
    path, job = scratch(spark, "t-mono"), f"t-{uuid.uuid4().hex}"
    base = dt.datetime(2024, 1, 1)
    slices = [[(0, 1), (1, 25), (2, 3)], [(3, 12), (4, 24), (5, 31), (6, None)], [(7, 9), (8, 29), (9, 30), (10, 55)]]
    for part in slices:
        spark.createDataFrame([(i, None if s is None else base + dt.timedelta(seconds=s), 1.0, "p") for i, s in part],
                              "id long, ts timestamp, amount double, p string").coalesce(1).write.mode("append").parquet(path)
        tagged = split_late(stream_table(spark, path), "ts", 10, "t-mono", job)
        out = run_append(traffic.closed_windows(tagged.stream().where("not late"), "p"), "t-closed", job=f"{job}-w")
    assert rows(tagged.read().where("late"), "id") == sorted([(3,), (6,), (7,), (8,)], key=str)
    got = sorted((r["w"].start.second, r["line_count"]) for r in out.collect())
    assert got == [(0, 2), (20, 2), (30, 2)]  # the window of the last row is still open


def test_chain_of_jobs_survives_a_death_between_write_and_commit(spark, rows):
    """The first job dies after it has written a batch; the second one must not see that batch before it is committed."""
    path, job = scratch(spark, "t-chain"), f"t-{uuid.uuid4().hex}"
    die = []

    def more(lo, hi, chain=True):
        spark.range(lo, hi).selectExpr("id", "id % 3 AS k", "timestamp_seconds(id) AS ts").coalesce(1).write.mode("append").parquet(path)
        log = images.retraction_log(stream_table(spark, path), ["k"], ["ts"], job=job)
        return log, run_sums(log, "t-sums", lambda batch: batch.groupBy("k").agg(F.sum(F.col("sign") * F.col("copies")).alias("n"), F.count(
            F.lit(1)).alias("entries")), ["k"], job=f"{job}-sums")

    log, sums = more(0, 10)
    write = KeyedTable.upsert

    def fail(self, batch, batch_id):
        die.append(batch_id)
        raise RuntimeError("killed")

    KeyedTable.upsert = fail  # rows of the batch are stored, its image and its commit are not
    try:
        with pytest.raises(Exception):
            more(10, 20)
    finally:
        KeyedTable.upsert = write
    assert die == [1]
    listed = lambda: rows(spark.read.json(f"{log.path}/committed/*"), "n")
    assert listed() == [(0,)]
    left = run_sums(log, "t-sums", lambda batch: batch.groupBy("k").agg(F.sum(F.col("sign") * F.col("copies")).alias("n"), F.count(
        F.lit(1)).alias("entries")), ["k"], job=f"{job}-sums")
    assert rows(left) == rows(sums)  # the uncommitted batch is not seen
    log, sums = more(20, 30)
    assert listed() == [(0,), (1,), (2,)]
    whole = sq.retractions(spark.range(30).selectExpr("id", "id % 3 AS k", "timestamp_seconds(id) AS ts"), ["k"], ["ts"])
    assert rows(log.read()) == rows(whole)
    assert rows(sums) == rows(whole.groupBy("k").agg(F.sum(F.col("sign") * F.col("copies")).alias("n"), F.count(F.lit(1)).alias("entries")))


def test_partial_update_is_reduced(spark, rows, monkeypatch):
    """Versions beside the columns let deltas and base be reduced: the same image over many batches, in few rows and files."""
    monkeypatch.setattr(KeyedTable, "EVERY", 3)
    r = random.Random(8)
    schema = spark.createDataFrame([], "k string, a int, b string, op string, ts int").schema
    table = KeyedTable(scratch(spark, "t-versions"), ["k"], "ts", merge=partial_image, schema=schema, op="op")
    seen = []
    for batch_id in range(10):
        data = [(r.choice("xyz"), r.choice([None, r.randrange(9)]), r.choice([None, "p", "q"]), r.choice("cud"), 1000 * r.randrange(50) + 100 * batch_id + i)
                for i in range(12)]
        seen += data
        table.upsert(spark.createDataFrame(data, schema), batch_id)
        assert rows(table.read(spark)) == rows(partial_image(spark.createDataFrame(seen, schema), ["k"], "ts", op="op"))
    assert spark.read.parquet(f"{table.path}/batch=9").count() <= 3
    assert len(table.read(spark).inputFiles()) <= 3 * 8 + 3 * 4


def test_batches_read_the_buckets_they_touch(spark, rows, monkeypatch):
    monkeypatch.setattr(KeyedTable, "EVERY", 2)
    monkeypatch.setattr(KeyedTable, "AGE", 1)
    schema = spark.createDataFrame([], "k long, v long").schema
    table = KeyedTable(scratch(spark, "t-buckets"), ["k"], "v", schema=schema)
    for batch_id in range(8):
        keys = range(200) if batch_id < 2 else [batch_id]
        table.upsert(spark.createDataFrame([(k, batch_id) for k in keys], schema), batch_id)
    few = table.read(spark, before=8, batch=spark.createDataFrame([(5, 9)], schema))
    base = lambda df: {f.split("/bucket=")[1].split("/")[0] for f in df.inputFiles() if "/bucket=" in f}
    assert len(base(few)) == 1 and len(base(table.read(spark))) == KeyedTable.BUCKETS
    assert rows(few.where("k = 5")) == [(5, 5)]
    assert rows(table.read(spark)) == rows(spark.createDataFrame([(k, max(1, k if 2 <= k < 8 else 1)) for k in range(200)], schema))
    # what no base of the last AGE names is gone, and only the buckets of a batch were written anew
    assert spark.read.parquet(f"{table.path}/batch=0").count() == spark.read.parquet(f"{table.path}/batch=3").count() == 0
    assert spark.read.parquet(f"{table.path}-base/batch=5").count() < 40
    again = KeyedTable(table.path, ["k"], "v", schema=schema)
    assert rows(again.read(spark)) == rows(table.read(spark))


def test_update_windows_over_batches(spark, feed, rows):
    path, df = feed
    agg = stream(spark, path).withWatermark("ts", "30 days").groupBy(F.window("ts", "1 day").alias("w"), "k").agg(F.count(F.lit(1)).alias("n"))
    got = traffic.edges(run_upsert(agg, ["w", "k"], "t-win")).select("stt", "k", "n")
    assert rows(got) == rows(df.groupBy(F.date_trunc("day", "ts"), "k").count())


def test_interval_join_equals_batch(spark, feed, rows):
    path, df = feed
    left = stream(spark, path).select("k", "id", F.col("ts").alias("et"))
    joined = trade.within(left, stream(spark, path).select("k", "id", F.col("ts").alias("et")), {"k": "k"}, "0 SECONDS", "2 HOURS", delay="60 days")
    got = run_append(joined.select("id", "r_id"), "t-join")
    a, b = df.alias("a"), df.alias("b")
    want = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("b.ts") >= F.col("a.ts")) & (F.col("b.ts") <= F.expr("a.ts + INTERVAL 2 HOURS"))).select("a.id", "b.id")
    assert rows(got) == rows(want)


def test_replayed_batch_changes_nothing(spark, rows):
    t = KeyedTable(scratch(spark, "t-keyed"), ["k"], "v")
    t.upsert(spark.createDataFrame([("a", 1, "x"), ("a", 3, "z")], "k string, v int, p string"), 0)
    second = spark.createDataFrame([("a", 2, "y"), ("b", 1, "q")], "k string, v int, p string")
    t.upsert(second, 1)
    t.upsert(second, 1)
    assert rows(t.read(spark)) == [("a", 3, "z"), ("b", 1, "q")]
    assert rows(t.read(spark, before=1)) == [("a", 3, "z")]


def test_partial_update_keeps_newest_value_per_column(spark, rows):
    t = KeyedTable(scratch(spark, "t-part"), ["k"], "ts", merge=partial_image, op="op")
    schema = "k string, a int, b int, op string, ts int"
    t.upsert(spark.createDataFrame([("x", 1, None, "c", 5), ("x", None, 7, "u", 10)], schema), 0)
    t.upsert(spark.createDataFrame([("x", 2, None, "u", 7), ("x", 9, 9, "d", 99)], schema), 1)
    assert rows(t.read(spark), "k", "a", "b") == [("x", 2, 7)]


def test_cdc_rules(spark, rows):
    def change(op, before, after):
        return (op, before, after, {"db": "d", "table": "cart_info"}, 1000)

    data = [change("r", None, {"id": "1", "n": "3"}), change("u", {"id": "2", "n": "1"}, {"id": "2", "n": "4"}), change("u", {"id": "3", "n": "4"}, {"id": "3", "n": "1"}),
            change("d", {"id": "4", "n": "4"}, None), change("c", None, {"id": "5", "n": "2"}), change("u", {"id": "6", "n": "9"}, {"id": "6", "n": "10"})]
    df = spark.createDataFrame(data, cdc.ENVELOPE).withColumn("et", F.timestamp_millis("ts_ms"))
    assert rows(cdc.positive_delta(df, "n").select(F.col("after")["id"], "delta")) == [("1", 3), ("2", 3), ("6", 1)]
    assert rows(cdc.image(df, ["id"]).select("id")) == [(str(i),) for i in range(1, 7)]
    a = {r.id_ts: (r.before, r.after) for r in cdc.audit(df).collect()}
    assert a["4_1000"][1] is None and a["4_1000"][0] and a["2_1000"][0] is None
    assert cdc.snapshot_rows(df).count() == 1
    assert df.where(cdc.became("n", "1", "4")).count() == 1
    bad = spark.createDataFrame([("junk",), ('{"op":"c","ts_ms":5}',)], "value string")
    assert cdc.decode(bad).count() == 1


def test_vehicle_messages(spark, rows):
    text = ['{"vehicleNo":"a","upexgmsgreallocation":{"lon":"1","lat":"2","dateTime":"20250809085000"}}', '{"vehicleNo":"b","upexgmsgreallocation":{"lon":"1","dateTime":"2025"}}',
            '{"vehicleNo":"c","upexgmsgregister":{"deviceId":"d"}}']
    got = trade.vehicle_messages(spark.createDataFrame([(t,) for t in text], "value string"))
    want = int(dt.datetime(2025, 8, 9, 0, 50, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert rows(got, "vehicleNo", "ds", "ts", "lat") == [("a", "20250809", want, "2"), ("b", "", 0, ""), ("c", "99991231", None, "")]


def test_dim_router_follows_config(spark, rows):
    config = spark.createDataFrame([("t", "c", "old", "id", "id,x", 1), ("t", "u", "new", "id", "x", 2), ("gone", "c", "g", "id", "id", 1), ("gone", "d", "g", "id", "id", 2)],
                                   "source_table string, op string, sink_table string, sink_row_key string, sink_columns string, ts_ms long")
    data = [("c", None, {"id": "1", "x": "v", "y": "w"}, {"table": "t"}, 1), ("d", {"id": "1"}, None, {"table": "t"}, 2), ("c", None, {"id": "1"}, {"table": "gone"}, 1)]
    got = trade.route_dimensions(spark.createDataFrame(data, cdc.ENVELOPE), config).collect()
    assert [(r.sink_table, r.cells) for r in got] == [("new", {"x": "v"})]


def test_report_append_replaces_only_its_dates(spark, rows):
    path = scratch(spark, "t-report")
    day_1, day_2 = (spark.createDataFrame([(v, d), (v, d)], "x string, d int") for v, d in (("a", 1), ("b", 2)))
    for new in (day_1, day_2, day_2):
        sink.append_report(new, path, "d")
    assert rows(spark.read.parquet(path), "d", "x") == [(1, "a"), (2, "b")]


def test_day_bucket(spark):
    df = spark.createDataFrame([("1752710400",), ("1752710400000",), ("17527",), ("x",), (None,)], "t string")
    assert [r.day for r in sink.day_bucketed(df, "t").collect()] == ["20250717", "20250717", "error_bucket", "error_bucket", "error_bucket"]


def test_empty_stream_gives_empty_result(spark, feed):
    path, _ = feed
    none = stream(spark, path).where("false")
    assert images.retractions(none, ["k"], ["ts"]).count() == 0
    assert run_upsert(none.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"], "t-empty").count() == 0


def test_late_rows_are_dropped_after_the_watermark(spark, rows):
    path = scratch(spark, "late")
    # a batch filters late rows by the watermark of the batch before, so the late row comes third
    for i, stamps in enumerate((["2024-01-01 00:00:01", "2024-01-01 01:00:00"], ["2024-01-01 01:00:05"], ["2024-01-01 00:00:02"])):
        spark.createDataFrame([(at(s),) for s in stamps], "ts timestamp").coalesce(1).write.parquet(f"{path}/f{i}")
    src = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    agg = src.withWatermark("ts", "3 seconds").groupBy(F.window("ts", "10 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    got = traffic.edges(run_append(agg, "t-late"))
    assert rows(got, "n") == [(1,)]  # the late row is gone, the last window is still open


def test_named_job_goes_on_where_it_ended(spark, rows):
    """A second run reads only new files; a batch whose commit was lost is done again without doubling rows."""
    path, job = scratch(spark, "t-job-in"), f"t-{uuid.uuid4().hex}"
    seen = []

    def step(batch):
        seen.append(batch.count())
        return batch

    def more(lo, hi):
        spark.range(lo, hi).selectExpr("id", "id % 3 AS k").coalesce(1).write.mode("append").parquet(path)
        frame = stream_table(spark, path)
        return run_batches(frame, "t", step, frame.schema, job=job), run_append(frame, "t", job=f"{job}-append"), run_upsert(
            frame, ["k"], "t", version="id", job=f"{job}-keyed")

    more(0, 10)
    done, appended, keyed = more(10, 25)
    assert seen == [10, 15]
    assert rows(done, "id") == rows(appended, "id") == rows(spark.range(25), "id")
    assert rows(keyed, "k", "id") == [(0, 24), (1, 22), (2, 23)]
    commits = f"{shared_dir(spark)}/millrace/jobs/{job}/checkpoint/commits"
    os.remove(f"{commits}/1")
    if os.path.exists(f"{commits}/.1.crc"):
        os.remove(f"{commits}/.1.crc")
    done, _, _ = more(25, 30)
    assert seen[2:] == [15, 5] and rows(done, "id") == rows(spark.range(30), "id")


SHUFFLED = ["stream_cart_unique_users", "stream_home_detail_visitors", "stream_traffic_windows", "stream_login_windows"]


@pytest.mark.parametrize("name", SHUFFLED)
def test_daily_unique_streams_over_shuffled_files(spark, monkeypatch, name):
    """Events in five files that are not in time order, one file a batch: the same as the SQL over the whole table."""
    import duckdb

    from conftest import SMALL
    from millrace.registry import feeds, load
    from millrace.sources.model import TABLES

    def shuffled(m, table):
        path = scratch(spark, f"shuffled-{table}")
        for part in range(5):
            m[table].where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == part).coalesce(1).write.mode("append").parquet(path)
        return stream_table(spark, path, files_per_trigger=1)

    monkeypatch.setattr(feeds, "table", shuffled)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    q = load()[name]
    got = sorted(map(tuple, q.run(spark, SMALL).collect()), key=str)
    assert got == sorted(con.execute(q.sql()).fetchall(), key=str)


def test_first_of_day_takes_rows_back(spark, rows):
    path = scratch(spark, "t-first")
    for k, when in enumerate(("10:00:09", "10:00:01", "10:00:05")):
        spark.createDataFrame([("u", at(f"2024-01-01 {when}"), k), (None, at(f"2024-01-01 {when}"), k)], "u string, ts timestamp, n int").coalesce(
            1).write.mode("append").parquet(path)
    log = images.first_of_day(stream(spark, path), ["u"], "ts")
    net = log.groupBy("u", "ts").agg(F.sum("sign").alias("n")).where("n <> 0")
    assert rows(net) == [(None, at("2024-01-01 10:00:01"), 1), ("u", at("2024-01-01 10:00:01"), 1)]


@pytest.mark.parametrize("merge", [latest_image, earliest_image])
def test_keyed_table_reads_a_base_and_few_deltas(spark, rows, monkeypatch, merge):
    """Over many batches, one of them replayed, the image is that of all rows and its plan reads at most EVERY deltas."""
    monkeypatch.setattr(KeyedTable, "EVERY", 3)
    r = random.Random(5)
    schema = "k string, v int, x int"
    table = KeyedTable(scratch(spark, "t-keyed"), ["k"], "v", merge=merge, schema=spark.createDataFrame([], schema).schema)
    seen = []
    for batch_id in [0, 1, 2, 3, 3, 4, 5, 6, 7]:
        data = [(r.choice(["a", "b", None]), r.randrange(100), i) for i in range(3)] if batch_id != 3 or len(seen) == 9 else seen[-3:]
        if batch_id != 3 or len(seen) == 9:
            seen += data
        table.upsert(spark.createDataFrame(data, schema), batch_id)
        assert rows(table.read(spark)) == rows(merge(spark.createDataFrame(seen, schema), ["k"], "v"))
    deltas = {f.split("/batch=")[1].split("/")[0] for f in table.read(spark).inputFiles() if "-base/" not in f}
    assert deltas == {"6", "7"}  # of the deltas only those after the base of batch 5
    again = KeyedTable(table.path, ["k"], "v", merge=merge, schema=table.schema)
    assert rows(again.read(spark)) == rows(table.read(spark)) and rows(again.read(spark, before=4)) == rows(
        merge(spark.createDataFrame(seen[:12], schema), ["k"], "v"))


def test_state_settings_follow_where_tasks_run():
    """Only tasks in the driver get few state partitions; a cluster on one machine has executors like any other."""
    assert runner.in_one_process("local") and runner.in_one_process("local[4]")
    assert not runner.in_one_process("local-cluster[3,4,10240]") and not runner.in_one_process("spark://host:7077")


def test_routing_shuffles_no_change(spark):
    """All changes of a table meet one config row, so they must not be dealt by the table's name."""
    changes = spark.createDataFrame([("u", {"table": "t"}, {"id": "1", "x": "2"}, 5)], "op string, source map<string,string>, after map<string,string>, ts_ms long")
    config = spark.createDataFrame([("t", "c", "dim_t", "id", "x", 1)], "source_table string, op string, sink_table string, sink_row_key string, sink_columns string, ts_ms long")
    routed = trade.route_dimensions(changes, config)
    assert [r["cells"] for r in routed.collect()] == [{"x": "2"}]
    assert "SortMergeJoin" not in routed._jdf.queryExecution().sparkPlan().toString()


class _State:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _Handle:
    """State of one grouping key, and its timers."""

    def __init__(self):
        self.timers = set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getValueState(self, *_):
        return _State()


def test_one_call_takes_all_keys_of_a_bucket():
    """Keys of a bucket share a call, a state and a timer, and are told apart in it."""
    rule, handle = keyed.NewestWins(10), _Handle()
    rule.init(handle)
    frame = pd.DataFrame({"t": [1, 2, 3, 3], "version": [5, 4, 9, 4], "body": ["a5", "a4", "a9", "b4"], "key": ["a", "a", "a", "b"]})
    assert [b for out in rule.handleInputRows((0,), iter([frame]), None) for b in out["body"]] == ["a5", "b4", "a9"]
    assert handle.timers == {11}
    first = keyed.FirstOfDay()
    first.init(_Handle())
    days = pd.DataFrame({"user": ["u", "v", "u"], "day": [1, 1, 1], "t": [7, 8, 6]})
    assert [r for out in first.handleInputRows((0,), iter([days]), None) for r in out.itertuples(index=False, name=None)] == [("u", 1, 6, 1), ("v", 1, 8, 1)]


def test_first_batch_meets_no_image(spark):
    """Nothing is joined with an image that cannot hold anything yet."""
    seen = []

    def step(batch, image):
        seen.append(image)
        return batch, batch

    df, path = spark.range(20).selectExpr("id", "id AS v"), scratch(spark, "t-none-feed")
    df.repartition(2).write.parquet(path)
    runner.image_log(stream(spark, path), "t-none", step, ["id"], "v", df.schema, df.schema)
    assert seen[0] is None and None not in seen[1:]


def test_null_keys_are_a_key_of_their_own_in_keyed_state(spark, rows):
    """Rows without a key are told from the others, and these keep their state when a batch has both."""
    df = spark.createDataFrame([(k, at("2024-01-01 00:00:00") + dt.timedelta(seconds=s), v) for k, s, v in
                                ((None, 0, 5), (None, 1, 4), (None, 2, 6), (1, 0, 3), (1, 1, 2), (1, 2, 9), (2, 0, 1))], "k long, ts timestamp, v long")
    path = scratch(spark, "t-null-keys")
    df.repartition(2, "v").write.parquet(path)
    kept = run_append(keyed.newest_wins_until(stream_table(spark, path), ["k"], "ts", "v", 86_400_000), "t-null-keys", keyed=True)
    assert rows(kept, "k", "v") == rows(df.where("v in (1, 3, 5, 6, 9)"), "k", "v")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_bounded_join_equals_sparks_own(spark, rows, how):
    """Over several files, with late rows, null keys and times and rows that stay open; only open rows are stored."""
    r = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    order = list(range(240))
    order[60:180] = r.sample(order[60:180], 120)  # some come late
    data = [(None if i % 31 == 0 else f"k{i % 7}", n, None if i % 37 == 0 else base + dt.timedelta(seconds=20 * i + i % 3, microseconds=i)) for n, i in enumerate(order)]
    df = spark.createDataFrame(data, "k string, id long, ts timestamp")
    paths, job = [scratch(spark, "t-side") for _ in range(2)], f"t-{uuid.uuid4().hex}"
    for parts in ((0, 1), (2, 3)):  # the second run goes on where the first one ended
        for path, shift in zip(paths, (0, 45)):
            for part in parts:
                side = df.where((F.col("id") >= part * 60) & (F.col("id") < part * 60 + 60) & (F.col("id") % 5 != shift // 15))
                side.withColumn("ts", F.expr(f"ts + INTERVAL {shift} SECONDS")).coalesce(1).write.mode("append").parquet(path)
        left, right = (stream(spark, p).select("k", "id", F.col("ts").alias("et")) for p in paths)
        own = run_append(trade.within(left, right, {"k": "k"}, "-30 SECONDS", "200 SECONDS", how, "5 minutes").select("k", "id", "r_id"), "t", job=f"{job}-own")
        pairs = runner.Meeting(left, right, {"k": "k"}, -30_000, 200_000, how, 300_000).pipe(lambda joined: joined.select("k", "id", "r_id"))
        log = runner.meeting_log(pairs, "t", job)
        assert rows(log.read()) == rows(own) and (how == "inner" or any(x[2] is None for x in rows(own)))
    last = max(int(name.split("=")[1]) for name in os.listdir(f"{log.path}/end") if "=" in name)
    assert spark.read.parquet(f"{log.path}/end/batch={last}").count() < 60 and spark.read.parquet(f"{log.path}/open/batch={last}").count() == 0


def test_one_batch_is_reduced_once(spark):
    """What a single batch stored has a row per key, so reading it shuffles nothing; rows of a second one are put together."""
    t = KeyedTable(scratch(spark, "t-once"), ["k"], "v", merge=partial_image, schema=spark.createDataFrame([], "k string, v int, p string, q string").schema)
    part = lambda *rows_: spark.createDataFrame(rows_, "k string, v int, p string, q string")
    t.upsert(part(("a", 1, "x", None), ("a", 2, None, "y"), ("a", 0, "w", "w")), 0)
    once = t.read(spark)
    assert "Exchange" not in once._jdf.queryExecution().sparkPlan().toString() and [tuple(r) for r in once.collect()] == [("a", 2, "x", "y")]
    t.upsert(part(("a", 3, "z", None)), 1)
    assert [tuple(r) for r in t.read(spark).collect()] == [("a", 3, "z", "y")]
    path = scratch(spark, "t-sums")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n long").coalesce(1).write.parquet(path)
    sums = run_sums(stream(spark, path), "t-sums", lambda batch: batch.groupBy("k").agg(F.sum("n").alias("n")), ["k"])
    assert "Aggregate" not in sums._jdf.queryExecution().sparkPlan().toString() and sorted(map(tuple, sums.collect())) == [("a", 3), ("b", 3)]
