"""Scans, write semantics and small scalar helpers over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import dates, text
from millrace.operators.joins import side_by_side
from millrace.registry.base import query, share
from millrace.sinks import batch as sink
from millrace.sinks.workspace import scratch
from millrace.sources import tables as src

DAY = dt.date(2024, 1, 30)
D = f"DATE '{DAY}'"


def _events(m):
    return m.apply("SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(16,2)) AS value, CAST(ts AS DATE) AS dt FROM {events}")


share("e_days", "SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(16,2)) AS value, CAST(ts AS DATE) AS dt FROM events")
_EC = "event_id:i user_id:i event_type:s value:d dt:s"


@query("scan_orc_one_day", _EC, f"SELECT * FROM e_days WHERE dt = {D}")
def _(m):
    """Dynamic-partition ORC write, then a scan pruned to one day."""
    path = scratch(m.spark, "orc")
    sink.write_partitions(_events(m), path, fmt="orc")
    return src.read_day(m.spark, path, DAY, fmt="orc")


@query("scan_partition_range", "dt:s n:i total:d", f"SELECT dt, count(*) AS n, sum(value) AS total FROM e_days WHERE dt > {D} - 7 AND dt <= {D} GROUP BY 1")
def _(m):
    path = scratch(m.spark, "range")
    sink.write_partitions(_events(m), path)
    return src.read_days(m.spark, path, DAY, days=7).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("scan_open_and_day", "order_id:i dt:s", """
SELECT order_id, coalesce(CAST(finish_time AS DATE), DATE '9999-12-31') AS dt FROM x_flow WHERE finish_time IS NULL OR CAST(finish_time AS DATE) <= DATE '2000-01-01'""")
def _(m):
    """Accumulating snapshot: closed days up to a date plus the open partition."""
    from millrace.plans import retail_dwd as dwd

    path = scratch(m.spark, "flow")
    flow = dwd.trade_flow(m["order_info"], m["payment_info"], m["order_status_log"]).select("order_id", "dt")
    closed_month = flow.withColumn("m", F.when(F.col("dt") == F.lit(dates.OPEN_DATE), "open").otherwise(dates.month_key(F.col("dt"))))
    sink.write_partitions(closed_month, path, partition="m")
    return src.read_days(m.spark, path, "2000-01-01", with_open=True)


@query("scan_tab_separated", "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:d", "SELECT * FROM orders")
def _(m):
    path = scratch(m.spark, "tsv")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    m["orders"].select(*cols).write.option("sep", "\t").csv(path)
    return src.read_tsv(m.spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


@query("sink_replace_partitions", _EC, f"""
SELECT event_id, user_id, event_type, CASE WHEN dt = {D} THEN value + 1 ELSE value END AS value, dt FROM e_days""")
def _(m):
    """A second write replaces only the partition it holds; running it twice changes nothing."""
    path = scratch(m.spark, "replace")
    sink.write_partitions(_events(m), path)
    fixed = _events(m).where(F.col("dt") == F.lit(DAY)).withColumn("value", (F.col("value") + 1).cast("decimal(16,2)")).drop("dt")
    sink.write_day(fixed, path, DAY)
    sink.write_day(fixed, path, DAY)
    return src.read_table(m.spark, path)


@query("sink_append_report", "dt:s user_id:i n:i", f"SELECT dt, user_id, count(*) AS n FROM e_days WHERE dt >= {D} - 1 GROUP BY 1, 2")
def _(m):
    """Accumulating report: two days appended, one of them twice."""
    path = scratch(m.spark, "report")
    per_day = _events(m).groupBy("dt", "user_id").agg(F.count(F.lit(1)).alias("n"))
    for back in (1, 0, 0):
        sink.append_report(per_day.where(F.col("dt") == F.lit(dates.back(DAY, back))), path)
    return src.read_table(m.spark, path)


@query("sink_day_bucket", "day:s n:i", """
SELECT CASE WHEN event_id % 10 = 0 THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day, count(*) AS n FROM events GROUP BY 1""")
def _(m):
    """Seconds and millis in one column; anything else lands in the error bucket."""
    path = scratch(m.spark, "buckets")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    raw = m["events"].select("event_id", F.when(F.col("event_id") % 10 == 0, "bad").when(
        F.col("event_id") % 2 == 0, F.floor(ms / 1000).cast("string")).otherwise(ms.cast("string")).alias("stamp"))
    sink.write_partitions(sink.day_bucketed(raw, "stamp"), path, partition="day")
    return src.read_table(m.spark, path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("sink_json_rows", "value:s", """
SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def _(m):
    """JSON rows with snake_case keys, written as text and read back."""
    path = scratch(m.spark, "json")
    beans = m["events"].select(F.col("event_id").alias("eventId"), F.col("user_id").alias("userId"), F.col("event_type").alias("eventType"))
    sink.json_rows(beans).write.text(path)
    return m.spark.read.text(path)


@query("sink_typed_export", "id:i price:d name:s tags:s", """
SELECT p_partkey AS id, p_retailprice AS price, p_name AS name, '["' || p_brand || '","' || p_type || '"]' AS tags FROM part""")
def _(m):
    """Typed full-table export; the repeated column is dropped, nested values become JSON text."""
    path = scratch(m.spark, "export")
    rows = m["part"].select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"), F.col("p_name").alias("name"),
                            F.array("p_brand", "p_type").alias("tags"), F.lit("x").alias("NAME"))
    sink.export_table(rows, path, overrides={"price": "decimal(16,2)"})
    return src.read_table(m.spark, path)


@query("sink_row_audit", "rows_written:i", "SELECT count(*) AS rows_written FROM lineitem")
def _(m):
    """Row count observed while the rows are written."""
    rows, seen = sink.audited(m["order_detail"].select("id", "dt"), "order_detail_audit")
    sink.recreate(rows, scratch(m.spark, "audit"))
    return m.spark.createDataFrame([(seen.get["row_count"],)], "rows_written long")


@query("hash_bucket_users", "bucket:s n:i", """
SELECT CASE WHEN user_id = 7 THEN '9001' ELSE lpad(CAST(CAST('0x' || right(md5(CAST(user_id AS VARCHAR)), 3) AS INT) % 128 AS VARCHAR), 4, '0') END AS bucket, count(*) AS n FROM events GROUP BY 1""")
def _(m):
    """Hash buckets with a hot key pinned to its own bucket."""
    return m["events"].groupBy(text.hash_bucket(F.col("user_id").cast("string"), pinned={"7": 0}).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("day_partitions_of_events", "dt:s day_no:i n:i", """
SELECT d.dt, CAST(strftime(d.dt, '%Y%m%d') AS INT) AS day_no, coalesce(e.n, 0) AS n FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-25', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS dt) d
LEFT JOIN (SELECT dt, count(*) AS n FROM e_days GROUP BY 1) e USING (dt)""")
def _(m):
    counts = _events(m).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
    return dates.day_partitions(m.spark, "2024-01-25", "2024-02-02").join(counts, "dt", "left").fillna(0, ["n"])


@query("scalar_metrics_side_by_side", "orders:i customers:i lines:i", """
SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM lineitem) AS lines""")
def _(m):
    one = F.count(F.lit(1))
    return side_by_side({"orders": m["orders"].agg(one), "customers": m["customer"].agg(one), "lines": m["lineitem"].agg(one)})


@query("union_missing_columns", "kind:s user_id:i amount:d hour:i", """
SELECT 'cart' AS kind, user_id, NULL AS amount, hour(create_time) AS hour FROM cart_info UNION ALL SELECT 'order', user_id, order_amount, NULL FROM product_order""")
def _(m):
    carts = m["cart_info"].select(F.lit("cart").alias("kind"), "user_id", F.hour("create_time").alias("hour"))
    orders = m["product_order"].select(F.lit("order").alias("kind"), "user_id", F.col("order_amount").alias("amount"))
    return carts.unionByName(orders, allowMissingColumns=True)
