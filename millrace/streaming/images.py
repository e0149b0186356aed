"""Order-dependent stream rules with their state kept as a keyed image table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.operators import sequence as sq
from millrace.operators.dedup import first_per_key
from millrace.operators.joins import null_safe
from millrace.sinks.merge import earliest_image
from millrace.streaming.runner import Log, image_log


def _schema(df: DataFrame, **extra: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in extra.items()]])


def retraction_log(df: DataFrame, keys: list[str], order: list[str], label: str = "retract", job: str | None = None,
                   ttl: int | None = None) -> Log:
    """Change log with retractions; the image is the newest row per key.

    With ``ttl`` (seconds, of the first order column) a row is only taken back by one that follows it sooner than that;
    then the image forgets whole stretches of time that no later row can reach.
    """
    def step(batch: DataFrame, image: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        log = sq.retractions(batch, keys, order, image) if ttl is None else sq.retractions_within(batch, keys, order, ttl, image)
        if image is None or len(order) == 1:  # the table itself finds the newest by one column
            return log, sq.newest_rows(batch, keys, order)
        held = null_safe(image, batch.select(*keys).distinct(), keys, "left_semi")
        return log, sq.newest_rows(batch.unionByName(held), keys, order)

    return image_log(df, label, step, keys, order[0], df.schema, _schema(df, sign=T.IntegerType(), copies=T.LongType()), job,
                     expire=None if ttl is None else (order[0], ttl))


def retractions(*args, **kwargs) -> DataFrame:
    """The rows of ``retraction_log``."""
    return retraction_log(*args, **kwargs).read()


def newest_wins(df: DataFrame, keys: list[str], arrival: str, ties: list[str], version: str, label: str = "newest",
                job: str | None = None) -> DataFrame:
    """Rows newer than all before; the image is the highest version per key."""
    def step(batch: DataFrame, image: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        top = batch.groupBy(*keys).agg(F.max(version).alias(version))
        return sq.newest_wins(batch, keys, arrival, ties, version, image=image), top

    kept = T.StructType([f for f in df.schema.fields if f.name in keys or f.name == version])
    return image_log(df, label, step, keys, version, kept, df.schema, job).read()


def repair_new_flag(df: DataFrame, device: str, flag: str, time: str, ties: list[str], label: str = "new-flag",
                    job: str | None = None) -> DataFrame:
    """New-visitor repair; the image is the date kept per device (the first one stays)."""
    def step(batch: DataFrame, image: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        known = fresh = sq.first_seen(batch, device, flag, time, ties)
        if image is not None:
            before = image.select(device, "first_date")
            fresh = null_safe(fresh, before, [device], "left_anti")
            known = before.unionByName(fresh)
        rows = sq.repair_new_flag(batch, device, flag, time, known)
        return rows, fresh.withColumn("v", F.lit(0))

    kept = T.StructType([df.schema[device], T.StructField("first_date", T.DateType()), T.StructField("v", T.IntegerType())])
    return image_log(df, label, step, [device], "v", kept, _schema(df, is_new_fixed=T.StringType()), job).read()


def first_of_day_log(df: DataFrame, keys: list[str], time: str, label: str = "first-of-day", job: str | None = None) -> Log:
    """Change log of the first row per key and date by event time, whatever the order of arrival.

    A micro-batch is reduced to its earliest row per key and date before anything is joined. A row that comes
    before the kept one takes it back (sign -1) and stands in for it (+1); rows of the same time are ordered
    by their columns. The image holds one row per key and date.
    """
    day = "cur_day"

    def step(batch: DataFrame, image: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        cols = [c for c in batch.columns if c not in keys]
        firsts = first_per_key(batch.withColumn(day, F.to_date(time)), [*keys, day], [time])
        if image is None:
            return firsts.select(*batch.columns, F.lit(1).alias("sign")), firsts.select(*batch.columns, day)
        kept = image.select(*keys, day, F.struct(*cols).alias("_kept"))
        both = null_safe(firsts, kept, [*keys, day], "left")
        order = lambda get: F.struct(get(time).alias("_o"), *[get(c).alias(c) for c in cols])
        earlier = both.where(F.col("_kept").isNull() | (order(F.col) < order(lambda c: F.col("_kept")[c])))
        plus = earlier.select(*batch.columns, F.lit(1).alias("sign"))
        minus = earlier.where(F.col("_kept").isNotNull()).select(
            *[F.col("_kept")[c].alias(c) if c in cols else F.col(c) for c in batch.columns], F.lit(-1).alias("sign"))
        return plus.unionByName(minus), earlier.drop("_kept").select(*batch.columns, day)

    return image_log(df, label, step, [*keys, day], time, _schema(df, cur_day=T.DateType()), _schema(df, sign=T.IntegerType()), job,
                     merge=earliest_image)


def first_of_day(*args, **kwargs) -> DataFrame:
    """The rows of ``first_of_day_log``."""
    return first_of_day_log(*args, **kwargs).read()
