"""Raw feeds for the stream jobs, derived from the given tables as streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, functions as F

from millrace.sinks.workspace import scratch
from millrace.sources import cdc, logs
from millrace.sources.model import Model
from millrace.sources.tables import stream_table


def table(m: Model, name: str) -> DataFrame:
    return stream_table(m.spark, m.path(name))


Result = TypeVar("Result")


def in_turn(m: Model, rows: DataFrame, arrival: Column, slices: int, run: Callable[[DataFrame, str], Result]) -> Result:
    """Deliver rows in slices; after each one ``run(stream, job)`` goes on with the new files at the job's checkpoint."""
    path, job, out = scratch(m.spark, "arrivals"), f"registry-{uuid.uuid4().hex}", None
    for k in range(slices):
        rows.where(arrival == k).write.mode("append").parquet(path)
        out = run(stream_table(m.spark, path, schema=rows.schema), job)
    return out


#: Ends of the slices that orders are delivered in, as days since 1970: four of about the same length.
SLICES = (8766, 9496, 10227)


def slice_of(ms: Column) -> Column:
    """Number of the slice a time in milliseconds falls into."""
    return sum((ms >= day * 86_400_000).cast("int") for day in SLICES)


SLICE_SQL = " + ".join(f"CAST({{0}} >= {day * 86_400_000} AS INT)" for day in SLICES)


def repeated_orders(m: Model, offsets: tuple[int, ...]) -> DataFrame:
    """Orders delivered up to three times, ``offsets`` milliseconds after each other's first; the amount grows by one each time."""
    df = orders(m, stream=False).withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("id") % 3).cast("int"))))
    later = F.element_at(F.array(*[F.lit(o) for o in offsets]), F.col("copy") + 1)
    return df.select("id", "user_id", "copy", (F.col("total_amount") + F.col("copy")).alias("amount"),
                     F.timestamp_millis(F.col("ts_ms") + later).alias("ts"))


def repeated_sql(offsets: tuple[int, ...]) -> str:
    """The same rows, with their time in milliseconds, as SQL."""
    return (f"SELECT o.id, o.user_id, c.copy, o.total_amount + c.copy AS amount, o.ts_ms + c.later AS ms FROM f_orders o, "
            f"(VALUES {', '.join(f'({k}, {v})' for k, v in enumerate(offsets))}) c(copy, later) WHERE c.copy <= o.id % 3")


def pages(m: Model) -> DataFrame:
    return m.over("page_log", events=table(m, "events"))


def log_text(m: Model) -> DataFrame:
    """JSON documents; every fiftieth is cut off and cannot be parsed."""
    flat = pages(m).withColumn("broken", F.col("event_id") % 50 == 0)
    text = logs.to_documents(flat.drop("broken"), errors=True)
    return text.withColumn("log", F.when(F.get_json_object("log", "$.ts").cast("bigint") % 50 == 0, F.substring("log", 1, 30)).otherwise(F.col("log")))


def _map(**cols: Column) -> Column:
    parts: list[Column] = []
    for k, v in cols.items():
        parts += [F.lit(k), v.cast("string")]
    return F.create_map(*parts)


def envelopes(df: DataFrame, name: str, op: Column, before: Column, after: Column, ts_ms: Column) -> DataFrame:
    """Change rows as JSON text, the shape a change-data topic carries."""
    gone = op == "d"
    fresh = op.isin("r", "c")
    src = _map(db=F.lit("trade"), table=F.lit(name), snapshot=F.when(op == "r", "true").otherwise("false"))
    text = F.to_json(F.struct(op.alias("op"), F.when(~fresh, before).alias("before"), F.when(~gone, after).alias("after"),
                              src.alias("source"), ts_ms.alias("ts_ms")))
    return df.select(F.explode(F.array(text)).alias("value"))


ORDERS = """SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS s, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
  EPOCH_MS(CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND * (o_orderkey * 7919 % 86400)) AS ts_ms FROM {orders}"""
ORDERS_SQL = ORDERS.replace("EPOCH_MS(", "epoch_ms(").format(orders="orders")


def orders(m: Model, stream: bool = True) -> DataFrame:
    source = {"orders": table(m, "orders")} if stream else {}
    return m.apply(ORDERS.replace("EPOCH_MS(", "unix_millis("), **source)


def order_info_text(m: Model) -> DataFrame:
    df, k, s = orders(m), F.col("id"), F.col("s")
    op = F.when((s == "P") & (k % 2 == 0), "r").when(s == "P", "c").when((s == "O") & (k % 5 == 0), "d").otherwise("u")
    was = F.when(s == "F", "1001").otherwise("1004")
    now = F.when(s == "P", "1001").when(s == "F", F.when(k % 3 == 0, "1003").otherwise("1002")).otherwise("1006")
    common = dict(id=k, user_id=F.col("user_id"), province_id=F.col("user_id") % 25)
    return envelopes(df, "order_info", op, _map(**common, order_status=was),
                     _map(**common, order_status=now, operate_time=F.col("ts_ms")), F.col("ts_ms"))


def payment_text(m: Model) -> DataFrame:
    df, k = orders(m), F.col("id")
    ts = F.col("ts_ms") + (k % 17 - 4) * 1000
    base = dict(order_id=k, user_id=F.col("user_id"), payment_type=F.concat(F.lit("110"), (k % 4).cast("string")), callback_time=ts)
    return envelopes(df, "payment_info", F.when(F.col("s") == "P", "c").otherwise("u"), _map(**base, payment_status=F.lit("1601")),
                     _map(**base, payment_status=F.when(F.col("s") == "F", "1602").otherwise("1601")), ts)


def refund_texts(m: Model) -> DataFrame:
    """Refund payment, return request and order change of the orders, as one feed."""
    k = F.col("id")
    base = dict(id=k, order_id=k, sku_id=k % 100, payment_type=F.concat(F.lit("110"), (k % 4).cast("string")), callback_time=F.col("ts_ms"), total_amount=F.col("total_amount"))
    pay = envelopes(orders(m), "refund_payment", F.lit("u"), _map(**base, refund_status=F.lit("1601")),
                    _map(**base, refund_status=F.when(k % 2 == 0, "1602").otherwise("1601")), F.col("ts_ms") + (k % 5) * 1000)
    ret = dict(order_id=k, sku_id=k % 100, refund_num=1 + k % 3, refund_type=F.lit("1101"), refund_reason_type=F.when(k % 2 == 0, "0701").otherwise("0702"))
    back = envelopes(orders(m), "order_refund_info", F.lit("u"), _map(**ret, refund_status=F.lit("0701")),
                     _map(**ret, refund_status=F.when(k % 3 == 0, "0705").otherwise("0702")), F.col("ts_ms") + (k % 7) * 1000)
    return pay.unionByName(back).unionByName(order_info_text(m))


def comment_texts(m: Model) -> DataFrame:
    k = F.col("id")
    ts = F.col("ts_ms") + (k * 37 % 180 - 90) * 1000
    row = _map(id=k, user_id=F.col("user_id"), order_id=k, appraise=F.concat(F.lit("120"), (1 + k % 4).cast("string")), comment_txt=F.concat(F.lit("comment "), k.cast("string")))
    said = envelopes(orders(m), "comment_info", F.lit("c"), row, row, ts)
    return said.unionByName(order_info_text(m))


CARTS = """SELECT event_id AS id, user_id, CAST(split_part(split_part(props, ': ', 2), '}}', 1) AS BIGINT) AS sku_id, event_id % 5 + 1 AS n,
  EPOCH_MS(date_trunc('millisecond', CAST(ts AS TIMESTAMP))) AS ts_ms FROM {events} WHERE event_type = 'click'"""
CARTS_SQL = CARTS.replace("EPOCH_MS(", "epoch_ms(").format(events="events")


def cart_text(m: Model) -> DataFrame:
    df = m.apply(CARTS.replace("EPOCH_MS(", "unix_millis("), events=table(m, "events"))
    k, n = F.col("id"), F.col("n")
    op = F.when(k % 10 == 9, "d").when(k % 3 == 0, "r").otherwise("u")
    base = dict(id=k, user_id=F.col("user_id"), sku_id=F.col("sku_id"))
    after = F.when(k % 3 == 1, n + 2).when(k % 3 == 2, n - 1).otherwise(n)
    return envelopes(df, "cart_info", op, _map(**base, sku_num=n), _map(**base, sku_num=after), F.col("ts_ms"))


LINES = """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING) AS id, CAST(l_orderkey AS STRING) AS order_id,
  CAST(l_partkey AS STRING) AS sku_id, CAST(o_custkey AS STRING) AS user_id, CAST(o_custkey % 25 AS STRING) AS province_id, CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount, l_discount, l_returnflag, l_suppkey,
  EPOCH_MS(CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND * (o_orderkey * 7919 % 86400 - 7 + CAST(l_linenumber AS BIGINT))) AS ts_ms FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey"""
LINES_SQL = LINES.replace("EPOCH_MS(", "epoch_ms(").format(lineitem="lineitem", orders="orders")


def lines(m: Model) -> DataFrame:
    """Order lines as a stream, stamped close to their order (orders are the static side)."""
    return m.apply(LINES.replace("EPOCH_MS(", "unix_millis("), lineitem=table(m, "lineitem")).withColumn("et", F.timestamp_millis("ts_ms"))


def promotions(m: Model) -> DataFrame:
    """Lines, and one and two seconds later their activity and coupon ids, as one feed with a ``kind``."""
    kinds = [F.struct(F.lit("detail").alias("kind"), F.lit(0).alias("later")),
             F.when(F.expr("l_discount >= 0.05"), F.struct(F.lit("activity").alias("kind"), F.lit(1000).alias("later"))),
             F.when(F.expr("l_returnflag = 'R'"), F.struct(F.lit("coupon").alias("kind"), F.lit(2000).alias("later")))]
    rows = lines(m).withColumn("c", F.explode(F.array_compact(F.array(*kinds))))
    return rows.select("id", "order_id", "user_id", "sku_id", "province_id", "split_total_amount", (F.col("l_suppkey") % 25).alias("activity_id"),
                       F.col("l_suppkey").alias("coupon_id"), "c.kind", (F.col("ts_ms") + F.col("c.later")).alias("ts_ms"))


def changes(text: DataFrame) -> DataFrame:
    return cdc.decode(text)
