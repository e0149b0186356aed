"""Change-data envelopes: decode, demultiplex, image pick, audit rows, delta rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ENVELOPE = ("op string, before map<string,string>, after map<string,string>, "
            "source map<string,string>, ts_ms bigint")


def decode(df: DataFrame, column: str = "value") -> DataFrame:
    """Envelope rows with the event time ``et``; unparsable rows are dropped."""
    # the one-element explode keeps later filters above the parser: one parse per text
    doc = df.select(F.explode(F.array(F.from_json(F.col(column), ENVELOPE))).alias("e")).where(F.col("e.op").isNotNull())
    return doc.select("e.*").withColumn("et", F.timestamp_millis("ts_ms"))


def of_table(changes: DataFrame, table: str) -> DataFrame:
    """One stream per source table."""
    return changes.where(F.col("source")["table"] == table)


def image(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Flatten the current image: ``after`` where present, else ``before``."""
    row = F.coalesce("after", "before")
    return changes.select(*[row[c].alias(c) for c in columns],
                          F.col("source")["table"].alias("table"), "op", "ts_ms", "et")


def audit(changes: DataFrame, key: str = "id") -> DataFrame:
    """Audit rows: deletes keep the old image, all others the new one."""
    deleted = F.col("op") == "d"
    row = F.coalesce("after", "before")
    return changes.select(
        F.concat_ws("_", row[key], F.col("ts_ms").cast("string")).alias("id_ts"), "op",
        F.col("source")["db"].alias("db"), F.col("source")["table"].alias("table"),
        F.when(deleted, F.to_json("before")).alias("before"),
        F.when(~deleted, F.to_json("after")).alias("after"), "ts_ms")


def snapshot_rows(changes: DataFrame) -> DataFrame:
    """Rows of the initial snapshot, unwrapped to the new image."""
    first = (F.col("op") == "r") | (F.coalesce(F.col("source")["snapshot"], F.lit("")) == "true")
    return changes.where(first & F.col("after").isNotNull()).select("after", "ts_ms", "et")


def became(column: str, old: str, new: str) -> Column:
    """An update moved ``column`` from ``old`` to ``new``."""
    return ((F.col("op") == "u") & (F.col("before")[column] == old) & (F.col("after")[column] == new))


def positive_delta(changes: DataFrame, column: str) -> DataFrame:
    """Snapshot rows give the quantity, growing updates the growth; the rest is dropped."""
    now = F.col("after")[column].cast("bigint")
    was = F.col("before")[column].cast("bigint")
    delta = F.when(F.col("op") == "r", now).when((F.col("op") == "u") & (now > was), now - was)
    return changes.withColumn("delta", delta).where(F.col("delta").isNotNull())
