"""Run streaming frames to completion over the data that is there now, and read the result back.

State, checkpoints and results live below the shared folder (see ``millrace.sinks.workspace``). With a
``job`` name they live in a folder of that name: a restarted driver, or a later run, goes on where the
checkpoint ends and reads only new files. Without one every call is a job of its own. A batch that is
replayed rewrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.sinks.merge import KeyedTable, latest_image
from millrace.sinks.workspace import scratch, shared_dir

LOCAL_STATE_PARTITIONS = "8"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A count of the rows in the store, for metrics only, costs a read for each write.
COUNT_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
#: On disk, a checkpoint takes what changed and not a copy of the store's files, and both are compressed further.
LEAN_STATE = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
              "spark.sql.streaming.stateStore.compression.codec": "zstd", "spark.sql.streaming.stateStore.rocksdb.compression": "zstd"}


def in_one_process(master: str) -> bool:
    """Whether a master runs its tasks in the driver; ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


@contextmanager
def stream_settings(spark: SparkSession, keyed: bool = False):
    """On a cluster keep state on disk, unless the session names another store, in the session's shuffle partitions; where
    all tasks are threads of the driver use few state partitions, and the store on disk only for ``keyed`` state with
    timers, which needs it. A query captures the settings when it starts."""
    wanted = {}
    local = in_one_process(spark.sparkContext.master)
    if local:
        wanted["spark.sql.shuffle.partitions"] = LOCAL_STATE_PARTITIONS
    if (keyed or not local) and "HDFSBacked" in spark.conf.get(STATE_STORE, "HDFSBacked"):
        wanted[STATE_STORE] = ROCKS_DB
        wanted[COUNT_ROWS] = "false"
        wanted |= LEAN_STATE
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass(frozen=True)
class Log:
    """Stored rows of a job, a folder per micro-batch, and the manifest of its committed batches.

    The manifest is how a job hands over to the next one: a batch is listed once its commit is certain, which is when the
    next batch begins or the run ends, and its rows do not change after that. A batch that was written but not committed
    when a driver died is not listed, so the next job never reads rows that are about to be written again.
    """
    spark: SparkSession
    path: str
    schema: T.StructType
    #: Number of the last batch, where the run that gave this log had any.
    last: int | None = None

    def read(self, batches: list[int] | None = None) -> DataFrame:
        """All stored rows, or those of some batches."""
        if batches is not None:
            paths = [f"{self.path}/data/batch={b}" for b in sorted(set(batches))]
            return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.IntegerType())])
        return self.spark.read.schema(stored).parquet(f"{self.path}/data").drop("batch")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self.publish(batch_id - 1)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/data/batch={batch_id}", compression="zstd")

    def publish(self, last: int | None) -> None:
        """List all batches up to ``last`` that are not listed yet; the first entry only opens the list."""
        self.spark.createDataFrame([], "n long").write.mode("ignore").json(f"{self.path}/committed/opened")
        if last is None or last < 0:
            return
        listed = self.spark.read.schema("n long").json(f"{self.path}/committed/*").agg(F.max("n")).first()[0]
        first = -1 if listed is None else listed
        if last > first:
            rows = [(n,) for n in range(first + 1, last + 1)]
            self.spark.createDataFrame(rows, "n long").coalesce(1).write.mode("append").json(f"{self.path}/committed/listed")

    def commits(self) -> DataFrame:
        """The manifest as a stream."""
        return self.spark.readStream.schema("n long").json(f"{self.path}/committed/*")

    def stream(self) -> DataFrame:
        """The rows themselves as a stream, for plans with Spark's own stateful operators; for a job that has ended its run."""
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.IntegerType())])
        return self.spark.readStream.schema(stored).parquet(f"{self.path}/data").drop("batch")


def job_dir(spark: SparkSession, label: str, job: str | None) -> str:
    """Stable folder of a named job, or a fresh one."""
    return f"{shared_dir(spark)}/millrace/jobs/{job}" if job else scratch(spark, label)


def run_append(df: DataFrame, label: str, partition: str | None = None, job: str | None = None, keyed: bool = False) -> DataFrame:
    """Append mode into a file table (exactly once through the sink log)."""
    spark, path = df.sparkSession, job_dir(df.sparkSession, label, job)
    writer = (df.writeStream.format("parquet").option("compression", "zstd").outputMode("append").trigger(availableNow=True)
              .option("checkpointLocation", f"{path}/checkpoint"))
    if partition:
        writer = writer.partitionBy(partition)
    with stream_settings(spark, keyed):
        writer.start(f"{path}/data").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/data")


def appended_as_stream(df: DataFrame, label: str, job: str | None = None, keyed: bool = False) -> DataFrame:
    """Run a job in append mode; its output as the input of the next one. The sink's own log lists the committed files."""
    path = job_dir(df.sparkSession, label, job)
    with stream_settings(df.sparkSession, keyed):
        (df.writeStream.format("parquet").option("compression", "zstd").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", f"{path}/checkpoint").start(f"{path}/data").awaitTermination())
    return df.sparkSession.readStream.schema(df.schema).parquet(f"{path}/data")


def _each_batch(df: DataFrame, path: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> int | None:
    """Run a stream through ``write``; the number of its last batch, if this run had any."""
    last: list[int] = []

    def counted(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        last[:] = [batch_id]

    with stream_settings(df.sparkSession):
        (df.writeStream.foreachBatch(counted).outputMode(mode).trigger(availableNow=True)
         .option("checkpointLocation", f"{path}/checkpoint").start().awaitTermination())
    return last[0] if last else None


def run_upsert(df: DataFrame, keys: list[str], label: str, version: str | None = None, mode: str = "update",
               merge: Callable[..., DataFrame] = latest_image, job: str | None = None, **merge_args) -> DataFrame:
    """Keyed merge per micro-batch; without a version column the batch number decides."""
    spark, path = df.sparkSession, job_dir(df.sparkSession, label, job)
    by = version or "_batch"
    frame = df.schema if version else df.withColumn("_batch", F.lit(0).cast("bigint")).schema
    table = KeyedTable(f"{path}/data", keys, by, merge=merge, schema=frame, **merge_args)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if version else batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        table.upsert(rows, batch_id)

    _each_batch(df, path, write, mode)
    return table.read(spark).drop("_batch")


def image_log(df: DataFrame, label: str, step: Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]],
              keys: list[str], version: str, image: T.StructType, out: T.StructType, job: str | None = None,
              merge: Callable[..., DataFrame] = latest_image, expire: tuple[str, int] | None = None) -> Log:
    """Keyed state as a table: ``step(batch, image)`` gives the output rows and the image rows that
    changed; the image is the newest row per key by ``version``, or what ``merge`` makes of them. A job's first batch has
    no image, so that nothing is shuffled to meet an empty one.

    Joins and aggregates replace per-key calls, so a hot key is split like in any batch job. A
    replayed batch sees the same image (only earlier batches) and rewrites its own folders. With ``expire`` (time
    column, seconds) the image forgets rows, see ``KeyedTable``.
    """
    spark, path = df.sparkSession, job_dir(df.sparkSession, label, job)
    table = KeyedTable(f"{path}/image", keys, version, merge=merge, schema=image, expire=expire)
    log = Log(spark, path, out)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        rows, changed = step(batch, table.read(spark, before=batch_id, batch=batch) if batch_id else None)
        log.write(rows, batch_id)
        table.upsert(changed, batch_id)
        batch.unpersist()

    log.publish(_each_batch(df, path, write))
    return log


def run_with_image(*args, **kwargs) -> DataFrame:
    """The rows of ``image_log``."""
    return image_log(*args, **kwargs).read()


def batch_log(df: DataFrame | Log, label: str, transform: Callable[[DataFrame], DataFrame], out: T.StructType,
              job: str | None = None) -> Log:
    """Apply a batch function to every micro-batch of a stream, or to the batches another job has committed."""
    spark = df.spark if isinstance(df, Log) else df.sparkSession
    path = job_dir(spark, label, job)
    log = Log(spark, path, out)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = df.read([r["n"] for r in batch.collect()]) if isinstance(df, Log) else batch  # a number per batch
        log.write(transform(rows), batch_id)

    last = _each_batch(df.commits() if isinstance(df, Log) else df, path, write)
    log.publish(last)
    return replace(log, last=last)


def run_batches(df: DataFrame | Log, label: str, transform: Callable[[DataFrame], DataFrame], out: T.StructType,
                job: str | None = None) -> DataFrame:
    """The rows of ``batch_log``."""
    return batch_log(df, label, transform, out, job).read()


def run_sums(df: DataFrame | Log, label: str, aggregate: Callable[[DataFrame], DataFrame], keys: list[str], job: str | None = None) -> DataFrame:
    """Sums per key over all micro-batches: each batch stores its own sums, reading adds them up.

    There is no state to expire, no row is too late, and a replayed batch replaces its own sums. The sums of a single batch
    are the result as they are.
    """
    spark = df.spark if isinstance(df, Log) else df.sparkSession
    empty = aggregate(spark.createDataFrame([], df.schema))
    log = batch_log(df, label, aggregate, empty.schema, job)
    parts = log.read()
    if log.last == 0:
        return parts.select(*keys, *[c for c in empty.columns if c not in keys])
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in empty.columns if c not in keys])


@dataclass(frozen=True)
class Meeting:
    """Interval join of two streams that keeps only the rows a later one can still meet.

    Keys are equal, and ``right.et`` lies ``low`` to ``high`` milliseconds after ``left.et``; columns of the right side get ``r_``. The
    rules are those of Spark's own join: the watermark after a micro-batch is what both sides have reached, less ``delay``; a
    batch leaves out rows that the watermark before the last batch had passed, and forgets those that the one before itself has
    passed; with ``how`` = left, it gives the left rows without a partner that it forgets. A run ends with a step without
    new rows, which goes by the last watermark. Spark's join puts every row into a state of its own, and copies of that
    into the checkpoint; here a batch is joined as a whole and stores the columns of rows that later ones can meet.
    """
    left: DataFrame
    right: DataFrame
    on: dict[str, str]
    low: int
    high: int
    how: str = "inner"
    delay: int = 5000
    then: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def pipe(self, step: Callable[[DataFrame], DataFrame]) -> Meeting:
        """With another step for the joined rows of a micro-batch."""
        return replace(self, then=(*self.then, step))

    def finish(self, rows: DataFrame) -> DataFrame:
        for step in self.then:
            rows = step(rows)
        return rows

    def feed(self) -> DataFrame:
        """Both sides as one stream. Rows whose keys are null meet none; a left one without them only counts with ``how`` = left."""
        left, right = (F.struct(*side.columns) for side in (self.left, self.right))
        empty = lambda side: F.lit(None).cast(T.StructType(side.schema.fields))
        a, b = self.left, self.right.where(" and ".join(f"`{r}` is not null" for r in self.on.values()))
        if self.how == "inner":
            a = a.where(" and ".join(f"`{l}` is not null" for l in self.on))
        return a.select(left.alias("l"), empty(self.right).alias("r")).unionByName(b.select(empty(self.left).alias("l"), right.alias("r")))

    def joined(self, rows: DataFrame, late: int, passed: int) -> DataFrame:
        """Pairs with a new row, and left rows that no partner can follow any more, of rows in the form of ``feed`` that may be ``old``."""
        sides = rows.where(F.col("old") | (_micros(F.coalesce("l.et", "r.et")) > late * 1000))
        a = sides.where("l is not null").select("l.*", F.col("old").alias("_old"))
        b = sides.where("r is not null").select(*[F.col("r")[c].alias(f"r_{c}") for c in self.right.columns], F.col("old").alias("_r_old"))
        cond = (_micros("r_et") >= _micros("et", self.low)) & (_micros("r_et") <= _micros("et", self.high))
        for l, r in self.on.items():
            cond = cond & (F.col(l) == F.col(f"r_{r}"))
        both = a.join(b, cond, self.how)
        fresh = ~(F.col("_old") & F.col("_r_old"))
        if self.how == "left":
            fresh = F.when(F.col("_r_old").isNull(), _micros("et", self.high) <= (passed - 1) * 1000).otherwise(fresh)
        return both.where(fresh).drop("_old", "_r_old")

    def kept(self, rows: DataFrame, late: int, passed: int) -> DataFrame:
        """Rows that later ones can meet; with ``how`` = left also partners of left rows that are still open."""
        until = (self.high if self.how == "left" else 0) - self.low
        new = F.col("old") | (_micros(F.coalesce("l.et", "r.et")) > late * 1000)
        met = F.coalesce(_micros("l.et", self.high), _micros("r.et", until)) > (passed - 1) * 1000
        return rows.where(new & met).drop("old")


def _micros(time: Column | str, later: int = 0) -> Column:
    """Microseconds of a time so many milliseconds later."""
    return F.unix_micros(time) + later * 1000


def meeting_log(pairs: Meeting, label: str, job: str | None = None) -> Log:
    """Run an interval join; a micro-batch stores its result, the rows that later ones can meet, and the latest times of both sides."""
    feed = pairs.feed()
    spark, path = feed.sparkSession, job_dir(feed.sparkSession, label, job)
    marks = T.StructType([T.StructField(c, T.LongType()) for c in ("l", "r")] + [T.StructField("batch", T.IntegerType())])
    out = pairs.finish(pairs.joined(spark.createDataFrame([], feed.schema).withColumn("old", F.lit(False)), 0, 0)).schema
    log = Log(spark, path, out)

    def mark(n: int) -> int:
        """The watermark after a batch."""
        if n < 0:
            return 0
        tops = spark.read.schema(marks).parquet(f"{path}/marks").where(F.col("batch") <= n).agg(F.max("l"), F.max("r")).first()
        return max(0, min(x - pairs.delay if x is not None else 0 for x in tops))

    def overwrite(df: DataFrame, to: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{to}", compression="zstd")

    def held(n: int, end: bool) -> DataFrame:
        return spark.read.schema(feed.schema).parquet(f"{path}/{'end' if end else 'open'}/batch={n}").withColumn("old", F.lit(True))

    def ended(n: int) -> bool:
        """Whether a run ended with the batch."""
        return n >= 0 and spark.read.schema("n long").json(f"{path}/ended/*").where(F.col("n") == n).count() > 0

    def write(batch: DataFrame, batch_id: int) -> None:
        before, rows = batch_id - 1, batch.withColumn("old", F.lit(False))
        spark.createDataFrame([], "n long").write.mode("ignore").json(f"{path}/ended/opened")
        end = ended(before)
        if batch_id:
            rows = rows.unionByName(held(before, end))
        if batch_id and not end and pairs.how == "left":  # a run that died before its end was certain
            overwrite(spark.createDataFrame([], out), f"data/batch={-batch_id}")
        late, passed = mark(before if end else before - 1), mark(before)
        log.write(pairs.finish(pairs.joined(rows, late, passed)), batch_id)
        overwrite(pairs.kept(rows, late, passed), f"open/batch={batch_id}")
        overwrite(batch.agg(F.max(F.unix_millis("l.et")).alias("l"), F.max(F.unix_millis("r.et")).alias("r")), f"marks/batch={batch_id}")
        if batch_id > 1:  # a replayed batch takes what the one before it left open
            overwrite(spark.createDataFrame([], feed.schema), f"open/batch={batch_id - 2}")

    last = _each_batch(feed, path, write)
    log.publish(last)
    if last is not None:
        rows, late, passed = held(last, False), mark(last - 1), mark(last)
        if pairs.how == "left":  # beside the batches, whose numbers go on
            overwrite(pairs.finish(pairs.joined(rows, late, passed)), f"data/batch={-1 - last}")
        overwrite(pairs.kept(rows, late, passed), f"end/batch={last}")
        spark.createDataFrame([(last,)], "n long").coalesce(1).write.mode("append").json(f"{path}/ended/listed")
        overwrite(spark.createDataFrame([], feed.schema), f"open/batch={last}")
    return log


def run_meeting(*args, **kwargs) -> DataFrame:
    """The rows of ``meeting_log``."""
    return meeting_log(*args, **kwargs).read()


def split_late(df: DataFrame, time: str, seconds: int, label: str, job: str | None = None) -> Log:
    """Every row with ``late``: whether its window of so many seconds had ended when it came, by a watermark without any delay.

    The watermark of a micro-batch is the latest time of the batches before it, so it never goes back; rows of one batch
    do not make each other late. A row without a time is late.
    """
    spark, path = df.sparkSession, job_dir(df.sparkSession, label, job)
    log = Log(spark, path, T.StructType([*df.schema.fields, T.StructField("late", T.BooleanType())]))
    marks = T.StructType([T.StructField("mark", T.TimestampType()), T.StructField("batch", T.IntegerType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = None
        if batch_id:
            mark = spark.read.schema(marks).parquet(f"{path}/marks").where(F.col("batch") < batch_id).agg(F.max("mark")).first()[0]
        batch.persist()
        ends = F.timestamp_seconds((F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds) + 1) * seconds)
        over = F.lit(False) if mark is None else ends <= F.lit(mark)
        log.write(batch.withColumn("late", F.col(time).isNull() | over), batch_id)
        batch.agg(F.max(F.col(time)).cast("timestamp").alias("mark")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{path}/marks/batch={batch_id}")
        batch.unpersist()

    log.publish(_each_batch(df, path, write))
    return log
