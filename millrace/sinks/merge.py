"""Keyed merges: last write wins, and partial update."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.operators.dedup import first_per_key


def latest_image(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Newest row per key by ``version`` (last write wins)."""
    rest = [c for c in rows.columns if c not in keys]
    ties = [F.col(c) for c in rest if not isinstance(rows.schema[c].dataType, T.MapType)]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(version).alias("_v"), *ties))
    top = rows.groupBy(*keys).agg(newest.alias("b"))
    return top.select(*keys, *[F.col("b")[c].alias(c) for c in rest]).select(*rows.columns)


def earliest_image(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """First row per key by ``version``, then by the other columns."""
    return first_per_key(rows, keys, [version])


def partial_image(rows: DataFrame, keys: list[str], version: str, op: str | None = None) -> DataFrame:
    """Per key and column the newest non-null value; deletes are ignored."""
    if op is not None:
        rows = rows.where(F.coalesce(F.col(op), F.lit("")) != "d")
    rest = [c for c in rows.columns if c not in keys]
    cols = [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(version).alias("_v"), F.col(c).alias("x"))))["x"].alias(c)
            for c in rest if c != version]
    return rows.groupBy(*keys).agg(*cols, F.max(version).alias(version)).select(*rows.columns)


class KeyedTable:
    """A keyed target stored as one delta folder per micro-batch and a base, merged on read.

    Each delta is reduced by key before it is written; a replayed batch rewrites its own folder, so the image does not
    change. A partial update is stored with a version beside every column, so that it can be reduced too. Every
    ``EVERY`` batches the deltas go into the base, which is laid out in ``BUCKETS`` buckets of the keys' hash: only
    buckets that the deltas touch are written anew, an index says which batch wrote each bucket last. So a read takes one
    base and less than ``EVERY`` deltas, and a read for a batch only the buckets that batch touches. What no index of the
    last ``AGE`` bases names is emptied.

    With ``expire`` (a time column and a number of seconds) the buckets are stretches of that time instead: a
    row counts until that long after its time, a read for a batch takes the stretches its rows can still see, and the base
    leaves whole stretches out once the newest row is that far ahead of them.
    """

    EVERY, BUCKETS, AGE = 16, 32, 2

    def __init__(self, path: str, keys: list[str], version: str, merge: Callable[..., DataFrame] = latest_image,
                 schema: T.StructType | None = None, expire: tuple[str, int] | None = None, **merge_args):
        self.path, self.keys, self.version, self.schema, self.expire = path, keys, version, schema, expire
        self.merge, self.merge_args = merge, merge_args
        self.last: int | None = None

    # what is stored: rows as they are, or with a version beside every column

    def _stored(self, batch: DataFrame) -> DataFrame:
        if self.merge is not partial_image:
            return self.merge(batch, self.keys, self.version, **self.merge_args)
        op = self.merge_args.get("op")
        rows = batch if op is None else batch.where(F.coalesce(F.col(op), F.lit("")) != "d")
        cols = [F.when(F.col(c).isNotNull(), F.struct(F.col(self.version).alias("v"), F.col(c).alias("x"))).alias(c)
                for c in rows.columns if c not in self.keys and c != self.version]
        return self._reduced(rows.select(*self.keys, *cols, self.version))

    def _reduced(self, rows: DataFrame) -> DataFrame:
        if self.merge is not partial_image:
            return self.merge(rows, self.keys, self.version, **self.merge_args)
        rest = [F.max(c).alias(c) for c in rows.columns if c not in self.keys]
        return rows.groupBy(*self.keys).agg(*rest).select(*rows.columns)

    def _shown(self, image: DataFrame) -> DataFrame:
        if self.merge is not partial_image:
            return image
        plain = (*self.keys, self.version)
        shown = image.select(*[F.col(c) if c in plain else F.col(c)["x"].alias(c) for c in image.columns])
        return shown if self.schema is None else shown.select(*self.schema.names)

    def _stored_schema(self, spark: SparkSession) -> T.StructType:
        if self.schema is not None:
            return self._stored(spark.createDataFrame([], self.schema)).schema
        return spark.read.parquet(self.path).drop("batch").schema

    # buckets

    def _bucket(self) -> Column:
        if self.expire is None:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.BUCKETS)).cast("bigint")
        return F.floor(F.unix_seconds(F.col(self.expire[0]).cast("timestamp")) / self.expire[1]).cast("bigint")

    def _touched(self, batch: DataFrame) -> Callable[[int], bool]:
        """Whether rows of a batch can meet rows of a bucket."""
        if self.expire is None:
            some = {r[0] for r in batch.select(self._bucket()).distinct().collect()}  # BUCKETS at most
            return lambda b: b in some
        first = batch.agg(F.min(self._bucket())).first()[0]
        return lambda b: b is None or first is None or b >= first - 1

    def _index(self, spark: SparkSession, base: int) -> dict[int | None, int]:
        """The batch that wrote each bucket of a base last."""
        if base < 0:
            return {}
        rows = spark.read.schema("bucket long, wrote long").json(f"{self.path}-index/batch={base}").collect()  # a row per bucket
        return {r["bucket"]: r["wrote"] for r in rows}

    def _folder(self, wrote: int, bucket: int | None) -> str:
        return f"{self.path}-base/batch={wrote}/bucket={'__HIVE_DEFAULT_PARTITION__' if bucket is None else bucket}"

    # writing

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body."""
        spark = batch.sparkSession
        self._write(self._stored(batch), f"{self.path}/batch={batch_id}")
        self.last = batch_id
        if (batch_id + 1) % self.EVERY == 0:
            self._compact(spark, batch_id)

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        schema = self._stored_schema(spark)
        deltas = self._deltas(spark, schema, batch_id - self.EVERY, batch_id + 1).withColumn("bucket", self._bucket())
        index = self._index(spark, batch_id - self.EVERY)
        fresh = deltas.select("bucket").distinct().toPandas()["bucket"]
        fresh = [None if b != b or b is None else int(b) for b in fresh]
        held = [self._folder(index[b], b) for b in fresh if b in index]
        rows = deltas.drop("bucket")
        if held:
            rows = rows.unionByName(spark.read.schema(schema).parquet(*held))
        if self.expire is not None:
            newest = max((b for b in (*fresh, *index) if b is not None), default=None)
            gone = {b for b in (*fresh, *index) if b is not None and b < newest - 1}
            fresh, index = [b for b in fresh if b not in gone], {b: w for b, w in index.items() if b not in gone}
            rows = rows.where(self._bucket().isNull() | (self._bucket() >= (newest or 0) - 1))
        # a bucket is written by as many tasks as its share of the shuffle's partitions
        split = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // self.BUCKETS)
        image = self._reduced(rows).withColumn("bucket", self._bucket())
        image = image.repartition("bucket", F.pmod(F.xxhash64(F.lit(0), *self.keys), F.lit(split)))
        image.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(
            f"{self.path}-base/batch={batch_id}", compression="zstd")
        index.update(dict.fromkeys(fresh, batch_id))
        spark.createDataFrame(sorted(index.items(), key=str), "bucket long, wrote long").coalesce(1).write.mode("overwrite").json(
            f"{self.path}-index/batch={batch_id}")
        self._clean(spark, batch_id, schema)

    def _clean(self, spark: SparkSession, batch_id: int, schema: T.StructType) -> None:
        """Empty the deltas and buckets that went into a base ``AGE`` bases ago."""
        then = batch_id - self.AGE * self.EVERY
        if then < 0:
            return
        before, after = self._index(spark, then - self.EVERY), self._index(spark, then)
        old = [self._folder(w, b) for b, w in before.items() if after.get(b) != w]
        nothing = spark.createDataFrame([], schema).coalesce(1)
        for path in (*[f"{self.path}/batch={k}" for k in range(then - self.EVERY + 1, then + 1)], *old):
            self._write(nothing, path)

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path, compression="zstd")

    # reading

    def read(self, spark: SparkSession, before: int | None = None, batch: DataFrame | None = None) -> DataFrame:
        """Current image, or the image before a batch, for all keys or those that may be in ``batch``: one shuffle by key, none of a single delta."""
        if before == 0:
            return spark.createDataFrame([], self.schema)
        end = before if before is not None or self.last is None else self.last + 1
        if end is None:
            end = spark.read.parquet(self.path).agg(F.max("batch")).first()[0]
            end = 0 if end is None else end + 1
        base = end // self.EVERY * self.EVERY - 1
        schema = self._stored_schema(spark)
        touched = self._touched(batch) if batch is not None and (base >= 0 or self.expire) else lambda b: True
        rows = self._deltas(spark, schema, base, end)
        if self.expire is not None and batch is not None:
            first = batch.agg(F.min(F.col(self.expire[0]).cast("timestamp"))).first()[0]
            if first is not None:
                at = F.col(self.expire[0])
                rows = rows.where(at.isNull() | (at > F.lit(first) - F.make_interval(secs=F.lit(self.expire[1]))))
        held = [self._folder(w, b) for b, w in self._index(spark, base).items() if touched(b)]
        if held:
            rows = rows.unionByName(spark.read.schema(schema).parquet(*held))
        alone = (end - base - 1) + bool(held) <= 1  # a delta, or a base, has a row per key as it is
        return self._shown(rows if alone else self._reduced(rows))

    def _deltas(self, spark: SparkSession, schema: T.StructType, base: int, end: int) -> DataFrame:
        paths = [f"{self.path}/batch={k}" for k in range(base + 1, end)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
