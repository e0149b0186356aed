"""Stream jobs run over the given tables to completion, checked against their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import moderation, sequence as sq, validity as va
from millrace.operators.joins import lookup
from millrace.plans import labels
from millrace.registry import feeds
from millrace.registry.base import query, share
from millrace.registry.events import AS_OF, CART_COLS, DUPLICATES, MOD_SQL, PAY_COLS, VISIT_COLS, in_list
from millrace.registry.retail import Layer
from millrace.sinks.merge import partial_image
from millrace.sources import cdc
from millrace.streaming import images, keyed, trade, traffic
from millrace.streaming.runner import Meeting, appended_as_stream, run_append, run_batches, run_meeting, run_sums, run_upsert, split_late

share("f_orders", feeds.ORDERS_SQL)
share("f_carts", feeds.CARTS_SQL)
share("f_lines", feeds.LINES_SQL)
share("f_change", """
SELECT id, user_id, user_id % 25 AS province_id, ts_ms, CASE WHEN s = 'P' AND id % 2 = 0 THEN 'r' WHEN s = 'P' THEN 'c' WHEN s = 'O' AND id % 5 = 0 THEN 'd' ELSE 'u' END AS op,
  CASE WHEN s = 'F' THEN '1001' ELSE '1004' END AS was, CASE WHEN s = 'P' THEN '1001' WHEN s = 'F' THEN CASE WHEN id % 3 = 0 THEN '1003' ELSE '1002' END ELSE '1006' END AS now FROM f_orders""")

# ---- log and traffic ----------------------------------------------------------------------


@query("stream_log_split", "channel:s mid:s n:i", """
WITH ok AS (SELECT * FROM page_log WHERE ts_ms % 50 <> 0)
SELECT 'dirty' AS channel, NULL AS mid, count(*) AS n FROM page_log WHERE ts_ms % 50 = 0
UNION ALL SELECT 'page', mid, count(*) FROM ok GROUP BY mid UNION ALL SELECT 'err', mid, count(*) FROM ok WHERE is_error = 1 GROUP BY mid
UNION ALL SELECT 'display', mid, sum(shows) FROM ok WHERE shows > 0 GROUP BY mid UNION ALL SELECT 'action', mid, sum(acts) FROM ok WHERE acts > 0 GROUP BY mid""")
def _(m):
    """Decode, route and write one folder per channel in a single pass."""
    out = run_append(traffic.split_log(feeds.log_text(m)), "log-split", partition="channel")
    return out.groupBy("channel", "mid").agg(F.count(F.lit(1)).alias("n"))


@query("stream_new_visitor_repair", "event_id:i mid:s is_new:s is_new_fixed:s", "SELECT * FROM fix_new")
def _(m):
    rows = feeds.pages(m).select("event_id", "mid", "is_new", "ts")
    return images.repair_new_flag(rows, "mid", "is_new", "ts", ["event_id"])


@query("stream_cart_unique_users", "stt:t edt:t cur_date:s cart_add_uu_ct:i", """
SELECT time_bucket(INTERVAL 5 SECOND, t) AS stt, stt + INTERVAL 5 SECOND AS edt, strftime(stt, '%Y%m%d') AS cur_date, count(*) AS cart_add_uu_ct FROM (
 SELECT user_id, CAST(create_time AS DATE) AS d, min(create_time) AS t FROM cart_info GROUP BY 1, 2) GROUP BY 1""")
def _(m):
    carts = m.over("cart_info", events=feeds.table(m, "events")).withColumnRenamed("create_time", "ts")
    firsts = images.first_of_day_log(carts.select("user_id", "ts"), ["user_id"], "ts", "cart-first")
    return traffic.edges(run_sums(firsts, "cart-uu", traffic.unique_cart_users, ["w"])).where("cart_add_uu_ct <> 0")


@query("stream_home_detail_visitors", "stt:t edt:t home_uv_ct:i detail_uv_ct:i", """
SELECT time_bucket(INTERVAL 5 SECOND, t) AS stt, stt + INTERVAL 5 SECOND AS edt, count(*) FILTER (WHERE home) AS home_uv_ct, count(*) FILTER (WHERE NOT home) AS detail_uv_ct FROM (
 SELECT mid, dt, page_id = 'home' AS home, min(ts) AS t FROM page_log GROUP BY 1, 2, 3) GROUP BY 1""")
def _(m):
    pages = traffic.tag_home(feeds.pages(m)).select("mid", "is_home", "ts")
    firsts = images.first_of_day_log(pages, ["mid", "is_home"], "ts", "home-first")
    return traffic.edges(run_sums(firsts, "home-detail", traffic.home_detail_visitors, ["w"])).where("home_uv_ct <> 0 or detail_uv_ct <> 0")


@query("stream_traffic_windows", "stt:t edt:t vc:s ch:s ar:s is_new:s uv_ct:i sv_ct:i pv_ct:i dur_sum:i", """
SELECT time_bucket(INTERVAL 10 SECOND, ts) AS stt, stt + INTERVAL 10 SECOND AS edt, vc, ch, ar, is_new, count(*) FILTER (WHERE rn = 1) AS uv_ct, count(*) FILTER (WHERE coalesce(last_page_id, '') = '') AS sv_ct,
  count(*) AS pv_ct, sum(during_time) AS dur_sum FROM (SELECT *, row_number() OVER (PARTITION BY mid, dt ORDER BY ts) AS rn FROM page_log) GROUP BY ALL""")
def _(m):
    visits = feeds.pages(m).select("mid", "ts", "vc", "ch", "ar", "is_new")
    firsts = images.first_of_day_log(visits, ["mid"], "ts", "visit-first")
    keys = ["w", *traffic.TRAFFIC_DIMS]
    views = run_sums(traffic.view_rows(feeds.pages(m)), "traffic-views", traffic.traffic, keys)
    visitors = run_sums(firsts, "traffic-visitors", lambda rows: traffic.traffic(traffic.visitor_rows(rows)), keys)
    sums = [F.sum(c).alias(c) for c in views.columns if c not in keys]
    return traffic.edges(views.unionByName(visitors).groupBy(*keys).agg(*sums))


@query("stream_login_windows", "stt:t edt:t uu_ct:i back_ct:i", """
SELECT time_bucket(INTERVAL 1 SECOND, t) AS stt, stt + INTERVAL 1 SECOND AS edt, count(*) AS uu_ct, sum(b) AS back_ct FROM (
 SELECT t, CASE WHEN d - lag(d) OVER (PARTITION BY uid ORDER BY d) >= 8 THEN 1 ELSE 0 END AS b FROM (SELECT uid, dt AS d, min(ts) AS t FROM page_log WHERE uid IS NOT NULL AND page_id = 'payment' GROUP BY 1, 2)) GROUP BY 1""")
def _(m):
    """Two streams: keyed state turns logins in any order into a log of flagged days, whose windows add up per batch."""
    rows = feeds.pages(m).where("uid is not null and page_id = 'payment'").select("uid", "ts")
    log = appended_as_stream(keyed.login_log(rows, "uid", "ts"), "login-days", keyed=True)
    return traffic.edges(run_sums(log, "login-windows", traffic.login_windows, ["w"])).where("uu_ct <> 0 or back_ct <> 0")


@query("stream_keyword_windows", "stt:t edt:t cur_date:s keyword:s keyword_count:i", r"""
SELECT time_bucket(INTERVAL 10 SECOND, ts) AS stt, stt + INTERVAL 10 SECOND AS edt, strftime(stt, '%Y%m%d') AS cur_date, keyword, count(*) AS keyword_count FROM (
 SELECT ts, unnest(regexp_extract_all(lower(item), '[\p{L}\p{N}]+')) AS keyword FROM page_log WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL) GROUP BY 1, 4""")
def _(m):
    return traffic.edges(run_upsert(traffic.keyword_counts(feeds.pages(m)), ["w", "keyword"], "keywords"))


@query("stream_keyword_windows_closed", "stt:t keyword:s keyword_count:i", r"""
SELECT * FROM (SELECT time_bucket(INTERVAL 10 SECOND, ts) AS stt, keyword, count(*) AS keyword_count FROM (
 SELECT ts, unnest(regexp_extract_all(lower(item), '[\p{L}\p{N}]+')) AS keyword FROM page_log WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL) GROUP BY 1, 2)
WHERE stt + INTERVAL 10 SECOND <= (SELECT max(date_trunc('millisecond', ts)) FROM page_log WHERE last_page_id = 'search' AND item_type = 'keyword') - INTERVAL 5 SECOND""")
def _(m):
    """Append mode: only windows the watermark has passed."""
    return traffic.edges(run_append(traffic.keyword_counts(feeds.pages(m)), "keywords-closed"))


def _retracted(m):
    rows = m.apply(DUPLICATES, lineitem=feeds.table(m, "lineitem"))
    return images.retraction_log(rows, ["id"], ["ts"])


@query("stream_retract_on_duplicate", "id:s order_id:i sku_id:i supp_id:i ts:t amount:d sign:i", "SELECT * FROM dup_log")
def _(m):
    return _retracted(m).read()


@query("stream_province_orders", "province_id:i stt:t edt:t order_amount:d order_count:i", """
SELECT province_id, time_bucket(INTERVAL 10 SECOND, ts) AS stt, stt + INTERVAL 10 SECOND AS edt, sum(sign * amount) AS order_amount, count(DISTINCT order_id) AS order_count FROM dup_log GROUP BY 1, 2""")
def _(m):
    return traffic.edges(_order_windows(m, "province_id"))


def _order_windows(m, key):
    """Two streams: the change log, and from it net sums per window, key and order that add up over batches."""
    return traffic.order_windows(run_sums(_retracted(m), f"orders-{key}", lambda rows: traffic.order_cells(rows, key), ["w", key, "order_id"]), key)


@query("stream_sku_orders", "sku_id:i sku_name:s tm_name:s category3_name:s stt:t order_amount:d order_count:i", """
SELECT l.sku_id, k.sku_name, k.tm_name, k.category3_name, time_bucket(INTERVAL 10 SECOND, ts) AS stt, sum(sign * amount) AS order_amount, count(DISTINCT order_id) AS order_count
FROM dup_log l LEFT JOIN x_sku k ON k.id = l.sku_id GROUP BY ALL""")
def _(m):
    out = traffic.edges(_order_windows(m, "sku_id"))
    return lookup(out, Layer(m).sku, {"sku_id": "id"}, sku_name="sku_name", tm_name="tm_name", category3_name="category3_name")


@query("stream_newest_wins", "event_id:i user_id:i during_time:i", """
SELECT event_id, user_id, during_time FROM (SELECT e.event_id, e.user_id, p.during_time, max(p.during_time) OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
 FROM events e JOIN page_log p USING (event_id)) WHERE seen IS NULL OR during_time > seen""")
def _(m):
    rows = m.apply("SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, CAST(ROUND(value * 100) AS BIGINT) * 10 AS during_time FROM {events}", events=feeds.table(m, "events"))
    return images.newest_wins(rows, ["user_id"], "ts", ["event_id"], "during_time")


# ---- order rules with a memory that ends ---------------------------------------------------
share("f_held", feeds.repeated_sql((0, 3000, 7000)))
share("f_spaced", feeds.repeated_sql((0, 6000, 20000)))


@query("stream_newest_after_delay", "id:i user_id:i copy:i amount:d ts:t", """
WITH holds AS (SELECT *, CASE WHEN copy < 2 THEN 0 ELSE 1 END AS hold FROM f_held),
ends AS (SELECT max(ms) - 60000 AS mark FROM f_held)
SELECT id, user_id, copy, amount, make_timestamp(ms * 1000) AS ts FROM (
 SELECT *, row_number() OVER (PARTITION BY id, hold ORDER BY copy DESC) AS rn, min(ms) OVER (PARTITION BY id, hold) AS start FROM holds), ends
WHERE rn = 1 AND start + 5000 <= mark""")
def _(m):
    """Five-second holds by timers; orders arrive up to 40 seconds late, in four slices."""
    rows = feeds.repeated_orders(m, (0, 3000, 7000))
    arrival = feeds.slice_of(F.unix_millis("ts") + F.col("id") % 5 * 10_000)
    return feeds.in_turn(m, rows, arrival, 4, lambda stream, job: run_append(
        keyed.newest_after_hold(stream, ["id"], "ts", 5000, "60 seconds"), "held", job=job, keyed=True))


@query("stream_retract_expiring", "id:i copy:i amount:d ts:t sign:i", """
WITH spaced AS (SELECT *, lead(ms) OVER (PARTITION BY id ORDER BY ms) - ms AS gap FROM f_spaced)
SELECT id, copy, amount, make_timestamp(ms * 1000) AS ts, 1 AS sign FROM spaced
UNION ALL SELECT id, copy, amount, make_timestamp(ms * 1000), -1 FROM spaced WHERE gap < 10000""")
def _(m):
    """A delivery is taken back by one that follows it within ten seconds; each round of deliveries comes in a slice of its own."""
    rows = feeds.repeated_orders(m, (0, 6000, 20000)).select("id", "copy", "amount", "ts")
    return feeds.in_turn(m, rows, F.col("copy"), 3, lambda stream, job: images.retractions(stream, ["id"], ["ts"], job=job, ttl=10))


@query("stream_newest_wins_expiring", "id:i user_id:i cents:i ts:t", """
WITH RECURSIVE numbered AS (SELECT id, user_id, CAST(total_amount * 100 AS BIGINT) AS cents, ts_ms,
  row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, CAST(total_amount * 100 AS BIGINT), id) AS n FROM f_orders),
walk AS (
  SELECT id, user_id, cents, ts_ms, n, cents AS top, ts_ms AS since, true AS shown FROM numbered WHERE n = 1
  UNION ALL SELECT x.id, x.user_id, x.cents, x.ts_ms, x.n, CASE WHEN x.cents > w.top OR x.ts_ms - w.since >= 15552000000 THEN x.cents ELSE w.top END,
    CASE WHEN x.cents > w.top OR x.ts_ms - w.since >= 15552000000 THEN x.ts_ms ELSE w.since END, x.cents > w.top OR x.ts_ms - w.since >= 15552000000
  FROM walk w JOIN numbered x ON x.user_id = w.user_id AND x.n = w.n + 1)
SELECT id, user_id, cents, make_timestamp(ts_ms * 1000) AS ts FROM walk WHERE shown""")
def _(m):
    """Orders larger than the last one let through, which is remembered for half a year."""
    rows = feeds.orders(m, stream=False).select("id", "user_id", (F.col("total_amount") * 100).cast("bigint").alias("cents"),
                                                F.timestamp_millis("ts_ms").alias("ts"))
    return feeds.in_turn(m, rows, feeds.slice_of(F.unix_millis("ts")), 4, lambda stream, job: run_append(
        keyed.newest_wins_until(stream, ["user_id"], "ts", "cents", 180 * 86_400_000), "newest-until", job=job, keyed=True))


share("f_late", f"""
SELECT r.*, coalesce((ms // 10000 + 1) * 10000 <= mark, false) AS late FROM (
 SELECT id, user_id % 25 AS province_id, total_amount AS amount, ts_ms AS ms,
  {feeds.SLICE_SQL.format("(ts_ms + CASE WHEN id % 7 = 0 THEN 34560000000 ELSE 0 END)")} AS slice FROM f_orders) r
LEFT JOIN (SELECT slice, max(top) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM (
 SELECT {feeds.SLICE_SQL.format("(ts_ms + CASE WHEN id % 7 = 0 THEN 34560000000 ELSE 0 END)")} AS slice, max(ts_ms) AS top FROM f_orders GROUP BY 1)) USING (slice)""")


def _by_arrival(m, run):
    """Orders in four slices; every seventh arrives 400 days after its time."""
    rows = feeds.orders(m, stream=False).select("id", (F.col("user_id") % 25).alias("province_id"), F.col("total_amount").alias("amount"),
                                                F.timestamp_millis("ts_ms").alias("ts"))
    arrival = feeds.slice_of(F.unix_millis("ts") + F.when(F.col("id") % 7 == 0, 34_560_000_000).otherwise(0))
    return feeds.in_turn(m, rows, arrival, 4, run)


@query("stream_monotonous_windows", "province_id:i stt:t edt:t order_amount:d line_count:i", """
WITH ends AS (SELECT max(ms) AS mark FROM f_late WHERE NOT late)
SELECT province_id, make_timestamp(ms // 10000 * 10000000) AS stt, stt + INTERVAL 10 SECOND AS edt, sum(amount) AS order_amount, count(*) AS line_count
FROM f_late, ends WHERE NOT late AND (ms // 10000 + 1) * 10000 <= mark GROUP BY 1, 2""")
def _(m):
    """Ten-second windows in append mode by a watermark without delay; rows whose window is over are no part of them."""
    def run(stream, job):
        tagged = split_late(stream, "ts", 10, "monotonous", job)
        return run_append(traffic.closed_windows(tagged.stream().where("not late"), "province_id"), "closed", job=f"{job}-windows")

    return traffic.edges(_by_arrival(m, run))


@query("stream_monotonous_late", "id:i province_id:i amount:d ts:t n_late:i", """
SELECT id, province_id, amount, make_timestamp(ms * 1000) AS ts, count(*) OVER () AS n_late FROM f_late WHERE late""")
def _(m):
    """The side output: rows that came after their window was over, each with their number."""
    late = _by_arrival(m, lambda stream, job: split_late(stream, "ts", 10, "monotonous", job)).read().where("late")
    return late.withColumn("n_late", F.lit(late.count()))


# ---- change streams -----------------------------------------------------------------------


def _order_changes(m):
    return feeds.changes(feeds.order_info_text(m))


@query("stream_cdc_audit", "id_ts:s op:s db:s table:s has_before:i has_after:i ts_ms:i", """
SELECT id || '_' || ts_ms AS id_ts, op, 'trade' AS db, 'order_info' AS "table", CASE WHEN op = 'd' THEN 1 ELSE 0 END AS has_before, CASE WHEN op = 'd' THEN 0 ELSE 1 END AS has_after, ts_ms FROM f_change""")
def _(m):
    out = run_append(cdc.audit(_order_changes(m)), "audit")
    return out.withColumn("has_before", F.when(F.col("before").isNotNull(), 1).otherwise(0)).withColumn(
        "has_after", F.when(F.col("after").isNotNull(), 1).otherwise(0))


@query("stream_cdc_snapshot", "id:i user_id:i order_status:s ts_ms:i", "SELECT id, user_id, now AS order_status, ts_ms FROM f_change WHERE op = 'r'")
def _(m):
    rows = cdc.snapshot_rows(_order_changes(m))
    return run_append(rows.select(*[F.col("after")[c].alias(c) for c in ("id", "user_id", "order_status")], "ts_ms"), "snapshot")


@query("stream_cdc_latest_orders", "user_id:i id:i order_status:s op:s ts_ms:i", """
SELECT * FROM (SELECT user_id, id, CASE WHEN op = 'd' THEN was ELSE now END AS order_status, op, ts_ms, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, CAST(id AS VARCHAR) DESC) AS rn FROM f_change) WHERE rn = 1""")
def _(m):
    """Newest order image per user in a keyed target (last write wins)."""
    rows = cdc.image(cdc.of_table(_order_changes(m), "order_info"), ["user_id", "id", "order_status"])
    return run_upsert(rows.drop("et", "table"), ["user_id"], "latest", version="ts_ms", mode="append")


@query("stream_cart_partial_update", "user_id:i last_cart:i up_num:i ts_ms:i", """
SELECT user_id, arg_max(id, ts_ms) AS last_cart, arg_max(CASE WHEN id % 3 = 1 THEN n + 2 END, ts_ms) FILTER (WHERE id % 3 = 1) AS up_num, max(ts_ms) AS ts_ms FROM f_carts WHERE id % 10 <> 9 GROUP BY 1""")
def _(m):
    """Partial update: null columns do not overwrite, deletes are ignored."""
    rows = cdc.image(feeds.changes(feeds.cart_text(m)), ["user_id", "id", "sku_num"])
    part = rows.select("user_id", F.col("id").alias("last_cart"), F.when(F.col("id").cast("long") % 3 == 1, F.col("sku_num")).alias("up_num"), "op", "ts_ms")
    return run_upsert(part, ["user_id"], "partial", version="ts_ms", mode="append", merge=partial_image, op="op")


@query("stream_dwd_cart_add", "id:i user_id:i sku_id:i sku_num:i ts_ms:i", """
SELECT id, user_id, sku_id, CASE WHEN id % 3 = 0 THEN n ELSE 2 END AS sku_num, ts_ms FROM f_carts WHERE id % 10 <> 9 AND id % 3 <> 2""")
def _(m):
    return run_append(trade.cart_add(feeds.changes(feeds.cart_text(m))), "cart-add")


@query("stream_dwd_order_detail", "id:s order_id:i user_id:i sku_id:i province_id:i split_total_amount:d ts_ms:i", "SELECT * FROM f_lines")
def _(m):
    orders = feeds.orders(m).select(F.col("id").cast("string").alias("id"), "user_id", (F.col("user_id") % 25).alias("province_id"),
                                    F.timestamp_millis("ts_ms").alias("et"))
    return run_meeting(trade.order_detail(feeds.lines(m), orders), "order-detail")


@query("stream_dwd_order_promotions", "id:s order_id:i sku_id:i split_total_amount:d activity_id:i coupon_id:i", """
SELECT *, CASE WHEN l_discount >= 0.05 THEN l_suppkey % 25 END AS activity_id, CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS coupon_id FROM f_lines""")
def _(m):
    """Lines, activity ids and coupon ids arrive apart and meet in one partial-update target."""
    return run_upsert(trade.promotion_parts(feeds.promotions(m)), ["id"], "promotions", version="ts_ms", mode="append", merge=partial_image)


@query("stream_left_join_coupon", "id:s coupon_id:i", """
WITH lim AS (SELECT least(max(ts_ms), max(ts_ms) FILTER (WHERE l_returnflag = 'R') + 2000) - 5000 AS wm FROM f_lines)
SELECT id, CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS coupon_id FROM f_lines, lim WHERE l_returnflag = 'R' OR ts_ms + 10000 < wm""")
def _(m):
    """Left outer interval join in append mode: unmatched lines follow once the watermark has passed
    their bound, so the newest unmatched ones are still open at the end."""
    cou = feeds.lines(m).where("l_returnflag = 'R'").select(F.col("id").alias("order_detail_id"), F.col("l_suppkey").alias("coupon_id"),
                                                            F.expr("et + INTERVAL 2 SECONDS").alias("et"))
    pairs = Meeting(feeds.lines(m).select("id", "et"), cou, {"id": "order_detail_id"}, 0, 10_000, how="left")
    return run_meeting(pairs.pipe(lambda joined: joined.select("id", F.col("r_coupon_id").alias("coupon_id"))), "left-coupon")


@query("stream_dwd_order_cancel", "id:s order_id:i user_id:i sku_id:i province_id:i order_cancel_date_id:s split_total_amount:d ts_ms:i", """
SELECT l.id, l.order_id, l.user_id, l.sku_id, l.province_id, strftime(make_timestamp(c.ts_ms * 1000), '%Y-%m-%d') AS order_cancel_date_id, l.split_total_amount, c.ts_ms
FROM f_lines l JOIN f_change c ON CAST(c.id AS VARCHAR) = l.order_id WHERE c.op = 'u' AND c.was = '1001' AND c.now = '1003' AND c.ts_ms >= l.ts_ms AND c.ts_ms <= l.ts_ms + 1800000""")
def _(m):
    return run_append(trade.cancelled_orders(_order_changes(m), feeds.lines(m)), "cancel")


@query("stream_dwd_payment", "order_detail_id:s order_id:i user_id:i sku_id:i payment_type_code:s payment_type_name:s split_payment_amount:d ts_ms:i", """
SELECT l.id AS order_detail_id, l.order_id, l.user_id, l.sku_id, md5('110' || o.id % 4) AS payment_type_code, b.dic_name AS payment_type_name, l.split_total_amount AS split_payment_amount, o.ts_ms + (o.id % 17 - 4) * 1000 AS ts_ms
FROM f_lines l JOIN f_orders o ON CAST(o.id AS VARCHAR) = l.order_id JOIN base_dic b ON b.dic_code = '110' || o.id % 4 WHERE o.s = 'F' AND abs(o.ts_ms + (o.id % 17 - 4) * 1000 - l.ts_ms) <= 5000""")
def _(m):
    text = feeds.payment_text(m)
    return run_append(trade.payments(feeds.changes(text), feeds.lines(m), m["base_dic"]), "payment")


@query("stream_dwd_refund_paid", "id:i user_id:i order_id:i sku_id:i province_id:i payment_type:s payment_type_name:s date_id:s refund_num:i total_amount:d ts_ms:i", """
SELECT o.id, o.user_id, o.id AS order_id, o.id % 100 AS sku_id, o.user_id % 25 AS province_id, md5(b.dic_code) AS payment_type, b.dic_name AS payment_type_name, strftime(make_timestamp(o.ts_ms * 1000), '%Y-%m-%d') AS date_id,
  1 + o.id % 3 AS refund_num, o.total_amount, o.ts_ms + (o.id % 5) * 1000 AS ts_ms
FROM f_orders o JOIN f_change c ON c.id = o.id AND c.op = 'u' AND c.now = '1006' JOIN base_dic b ON b.dic_code = '110' || o.id % 4 WHERE o.id % 2 = 0 AND o.id % 3 = 0""")
def _(m):
    return run_append(trade.refunds_paid(feeds.changes(feeds.refund_texts(m)), m["base_dic"]), "refund")


@query("stream_dwd_return_order", "order_id:i user_id:i sku_id:i province_id:i refund_type_name:s refund_reason_name:s refund_num:i ts_ms:i", """
SELECT o.id AS order_id, o.user_id, o.id % 100 AS sku_id, o.user_id % 25 AS province_id, 'alipay' AS refund_type_name, CASE WHEN o.id % 2 = 0 THEN 'quality' ELSE 'size' END AS refund_reason_name, 1 + o.id % 3 AS refund_num,
  o.ts_ms + (o.id % 7) * 1000 AS ts_ms FROM f_orders o JOIN f_change c ON c.id = o.id AND c.op = 'u' AND c.now = '1006' WHERE o.id % 3 = 0""")
def _(m):
    return run_append(trade.return_orders(feeds.changes(feeds.refund_texts(m)), m["base_dic"]), "returns")


@query("stream_comment_enriched", "id:i order_id:i user_id:i appraise:s dic_name:s commentTxt:s ts_ms:i ds:s info_op:s info_user_id:i info_province_id:i info_order_status:s", """
SELECT o.id, o.id AS order_id, o.user_id, '120' || (1 + o.id % 4) AS appraise, coalesce(b.dic_name, 'N/A') AS dic_name, 'comment ' || o.id AS "commentTxt", o.ts_ms + (o.id * 37 % 180 - 90) * 1000 AS ts_ms,
  strftime(make_timestamp((o.ts_ms + (o.id * 37 % 180 - 90) * 1000) * 1000), '%Y%m%d') AS ds, c.op AS info_op, c.user_id AS info_user_id, c.province_id AS info_province_id, CASE WHEN c.op = 'd' THEN c.was ELSE c.now END AS info_order_status
FROM f_orders o JOIN f_change c ON c.id = o.id LEFT JOIN base_dic b ON b.dic_code = '120' || (1 + o.id % 4) WHERE abs((o.id * 37 % 180 - 90)) <= 60""")
def _(m):
    return run_append(trade.comments_enriched(feeds.changes(feeds.comment_texts(m)), m["base_dic"]), "comments")


@query("stream_comment_moderation", "id:i order_id:i user_id:i consignee:s msg:s is_violation:i violation_grade:s violation_msg:s", MOD_SQL)
def _(m):
    """Every comment is delivered twice; repeats are removed exactly."""
    once = m.over("comments", conversations=feeds.table(m, "conversations")).withColumn("et", F.timestamp_seconds(F.col("id") + 86400))
    twice = once.unionByName(m.over("comments", conversations=feeds.table(m, "conversations")).withColumn("et", F.timestamp_seconds(F.col("id") + 86400)))
    once = trade.delivered_once(twice)
    out = moderation.moderate(twice.sparkSession.createDataFrame([], twice.schema), m["words"])
    return run_batches(once, "moderation", lambda batch: moderation.moderate(batch, m["words"]), out.schema)


@query("stream_dim_router", "sink_table:s row_key:s user_id:i order_status:s ts_ms:i", """
SELECT 'dim_order' AS sink_table, md5(CAST(id AS VARCHAR)) AS row_key, user_id, now AS order_status, ts_ms FROM f_change WHERE op <> 'd'""")
def _(m):
    """Config-driven routing; the table's first config entry was later replaced, another was removed."""
    config = m.spark.createDataFrame(
        [("order_info", "c", "dim_old", "user_id", "id", 1), ("order_info", "u", "dim_order", "id", "user_id,order_status", 2),
         ("comment_info", "c", "dim_comment", "id", "id", 1), ("comment_info", "d", "dim_comment", "id", "id", 3)],
        "source_table string, op string, sink_table string, sink_row_key string, sink_columns string, ts_ms long")
    rows = run_upsert(trade.route_dimensions(feeds.changes(feeds.comment_texts(m)), config), ["sink_table", "row_key"], "router",
                      version="ts_ms", mode="append")
    return rows.select("sink_table", "row_key", F.col("cells")["user_id"].alias("user_id"), F.col("cells")["order_status"].alias("order_status"), "ts_ms")


# ---- boards, labels, vehicles -------------------------------------------------------------
query("stream_board_payment", PAY_COLS, "SELECT * FROM b_pay")(lambda m: run_append(va.valid_payments(m.over("board_payment", events=feeds.table(m, "events"))), "board-pay"))
query("stream_board_cart", CART_COLS, "SELECT * FROM b_cart")(lambda m: run_append(va.valid_carts(m.over("board_cart", events=feeds.table(m, "events"))), "board-cart"))
query("stream_board_visit", VISIT_COLS, "SELECT * FROM b_visit")(lambda m: run_append(va.valid_visits(m.over("board_visit", events=feeds.table(m, "events"))), "board-visit"))


@query("stream_user_profile", "uid:s pv:i ts_ms:i os:s ch:s md:s ba:s", """
SELECT uid, count(*) AS pv, max(ts_ms) AS ts_ms, string_agg(DISTINCT split_part(os, ' ', 1), ',' ORDER BY split_part(os, ' ', 1)) AS os, string_agg(DISTINCT ch, ',' ORDER BY ch) AS ch, string_agg(DISTINCT md, ',' ORDER BY md) AS md,
  string_agg(DISTINCT ba, ',' ORDER BY ba) AS ba FROM page_log WHERE uid IS NOT NULL GROUP BY 1""")
def _(m):
    """Repeat deliveries removed over all columns, then the running profile in update mode."""
    twice = feeds.pages(m).unionByName(feeds.pages(m))
    once = traffic.distinct_events(twice.select("uid", "ts", "ts_ms", "ch", "ba", "md", "os", "item_type", "item"),
                                   ["uid", "ts", "ch", "ba", "md", "os", "item_type", "item"])
    return run_upsert(traffic.profiles(labels.page_events(once)), ["uid"], "profiles")


@query("stream_profile_per_event", "event_id:i uid:s pv:i ch:s page_id:s item:s", """
WITH runs AS (SELECT *, sum(CASE WHEN gap >= 172800000 THEN 1 ELSE 0 END) OVER (PARTITION BY uid ORDER BY ts_ms, event_id) AS run FROM (
  SELECT event_id, uid, ts_ms, ch, page_id, CASE WHEN item_type = 'keyword' THEN item END AS item, ts_ms - lag(ts_ms) OVER (PARTITION BY uid ORDER BY ts_ms, event_id) AS gap
  FROM page_log WHERE uid IS NOT NULL)),
sofar AS (SELECT event_id, uid, row_number() OVER w AS pv, list(ch) OVER w AS ch, list(page_id) OVER w AS page_id, list(item) FILTER (WHERE item IS NOT NULL) OVER w AS item
 FROM runs WINDOW w AS (PARTITION BY uid, run ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, uid, pv, array_to_string(list_sort(list_distinct(ch)), ',') AS ch, array_to_string(list_sort(list_distinct(page_id)), ',') AS page_id,
  coalesce(array_to_string(list_sort(list_distinct(item)), ','), '') AS item FROM sofar""")
def _(m):
    """The profile as of each page event; two silent days end it. Events arrive in three slices of ten days."""
    rows = m["page_log"].where("uid is not null").select(
        "event_id", "uid", F.timestamp_millis("ts_ms").alias("ts"), "ch", "page_id", F.when(F.col("item_type") == "keyword", F.col("item")).alias("item"))
    arrival = F.least(F.lit(2), F.floor((F.unix_millis("ts") - 1_704_067_200_000) / 864_000_000)).cast("int")
    return feeds.in_turn(m, rows, arrival, 3, lambda stream, job: run_append(
        keyed.running_profile(stream, "uid", "ts", ["ch", "page_id", "item"], 172_800_000), "profile", job=job, keyed=True))


@query("stream_order_scores", "user_id:i band:s score:d", f"""
WITH f AS (SELECT o.user_id, l.id AS line_id, o.total_amount, make_timestamp(o.ts_ms * 1000) AS et, s.tname, c.b1name FROM f_orders o JOIN f_lines l ON l.order_id = CAST(o.id AS VARCHAR) AND abs(l.ts_ms - o.ts_ms) <= 120000
  LEFT JOIN lb_sku s ON s.skuid = CAST(l.sku_id AS BIGINT) LEFT JOIN lb_category c ON c.id = s.c3id),
k AS (SELECT user_id, line_id, 'pay_time' AS model, CASE WHEN hour(et) < 6 THEN '凌晨' WHEN hour(et) < 9 THEN '早晨' WHEN hour(et) < 12 THEN '上午' WHEN hour(et) < 14 THEN '中午' WHEN hour(et) < 18 THEN '下午' WHEN hour(et) < 22 THEN '晚上' ELSE '夜间' END AS k FROM f
  UNION ALL SELECT user_id, line_id, 'amount', CASE WHEN total_amount < 1000 THEN 'low' WHEN total_amount <= 4000 THEN 'mid' ELSE 'high' END FROM f
  UNION ALL SELECT user_id, line_id, 'brand', CASE WHEN tname IN ({in_list('brand')}) THEN tname ELSE 'default' END FROM f
  UNION ALL SELECT user_id, line_id, 'category', CASE WHEN b1name IN ({in_list('category')}) THEN b1name ELSE 'default' END FROM f)
SELECT k.user_id, w.band, sum(w.score) AS score FROM k JOIN lab_w w ON w.model = k.model AND w.k = k.k GROUP BY 1, 2""")
def _(m):
    orders = feeds.orders(m).withColumn("et", F.timestamp_millis("ts_ms")).select("id", "user_id", "total_amount", "et")
    orders = orders.withColumn("id", F.col("id").cast("string"))
    pairs = trade.order_scores(orders, feeds.lines(m).select("id", "order_id", "sku_id", "et"), m["lb_sku"], m["lb_category"])
    return trade.band_sums(run_meeting(pairs, "order-scores"))


share("ch_base6", """
SELECT u.uid, u.uname, u.age, u.zodiac_sign, u.height, u.weight, 864000 + CAST(u.uid AS BIGINT) * 60 AS et FROM lab_profile u
WHERE u.height IS NOT NULL AND CAST(u.uid AS BIGINT) % 7 <= 5""")
share("ch_base4", """
SELECT CAST(o.user_id AS VARCHAR) AS uid, l.id AS line_id, s.tname, c.b1name AS b1_name, 864000 + o.user_id * 60 + o.id % 16 * 3600 AS et,
  CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午' WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END AS slot,
  CASE WHEN o.total_amount < 1000 THEN 'low' WHEN o.total_amount <= 4000 THEN 'mid' ELSE 'high' END AS spending_pow
FROM (SELECT *, hour(make_timestamp(ts_ms * 1000)) AS h FROM f_orders) o JOIN f_lines l ON l.order_id = CAST(o.id AS VARCHAR) AND l.l_suppkey % 4 <= 2
LEFT JOIN lb_sku s ON s.skuid = CAST(l.sku_id AS BIGINT) LEFT JOIN lb_category c ON c.id = s.c3id""")
share("ch_pages", "SELECT *, 864000 + CAST(uid AS BIGINT) * 60 + event_id % 7 * 3600 + event_id % 100 AS et FROM page_log WHERE uid IS NOT NULL")
share("ch_base2", """
SELECT p.*, x.search_category FROM (SELECT uid, et // 120 * 120 AS stt, count(*) AS pv, min(split_part(os, ' ', 1)) AS judge_os,
  arg_max(item, ts_ms) FILTER (WHERE item_type = 'keyword' AND item IS NOT NULL) AS search_item FROM ch_pages GROUP BY 1, 2) p
LEFT JOIN lb_word c ON c.b3name = p.search_item LEFT JOIN lb_compare x ON x.category_name = c.b1name""")
share("ch_ends", """
SELECT least((SELECT max(et) FROM ch_pages), (SELECT 864000 + max(user_id * 60 + id % 16 * 3600) FROM f_orders),
  (SELECT 864000 + max(CAST(l.user_id AS BIGINT) * 60 + CAST(l.order_id AS BIGINT) % 16 * 3600 + l_suppkey % 4 * 60) FROM f_lines l),
  (SELECT 864000 + max(CAST(uid AS BIGINT)) * 60 FROM lb_user), (SELECT max(864000 + CAST(uid AS BIGINT) * 60 + CAST(uid AS BIGINT) % 7 * 60) FROM lb_body)) - 3 AS mark""")
_BANDED = ", ".join(f"max(score) FILTER (WHERE band_no = {i}) AS s{i}" for i in range(6))


@query("stream_label_final", "uid:s line_id:s stt:t uname:s age:i zodiac_sign:s height:i weight:i pv:i judge_os:s spending_pow:s tname:s b1_name:s "
       + " ".join(f"s{i}:d" for i in range(6)) + " calculate_age:s max_score:d", f"""
WITH pairs AS (
 SELECT a.uid, b.line_id, a.stt, p.uname, p.age, p.zodiac_sign, p.height, p.weight, a.pv, a.judge_os, b.spending_pow, b.tname, b.b1_name, b.slot, a.search_category
 FROM ch_base2 a JOIN ch_base4 b ON b.uid = a.uid AND b.et BETWEEN a.stt + 120 - 21600 AND a.stt + 119 + 21600
 JOIN ch_base6 p ON p.uid = a.uid AND p.et BETWEEN a.stt + 120 - 21600 AND a.stt + 119 + 21600, ch_ends WHERE a.stt + 120 <= mark),
device AS (SELECT DISTINCT judge_os, search_category, spending_pow, tname, b1_name, slot FROM pairs),
keyed AS (
 SELECT d.*, w.band, w.band_no, sum(w.score) AS score FROM device d JOIN lab_w w ON (w.model = 'device' AND w.k = judge_os)
  OR (w.model = 'search' AND w.k = CASE WHEN search_category IN ({in_list('search')}) THEN search_category ELSE 'default' END)
  OR (w.model = 'pay_time' AND w.k = slot) OR (w.model = 'amount' AND w.k = spending_pow)
  OR (w.model = 'brand' AND w.k = CASE WHEN tname IN ({in_list('brand')}) THEN tname ELSE 'default' END)
  OR (w.model = 'category' AND w.k = CASE WHEN b1_name IN ({in_list('category')}) THEN b1_name ELSE 'default' END) GROUP BY ALL),
sums AS (SELECT judge_os, search_category, spending_pow, tname, b1_name, slot, {_BANDED}, arg_max(band, score * 100000 - band_no) AS calculate_age, max(score) AS max_score FROM keyed GROUP BY ALL)
SELECT p.* EXCLUDE (stt), make_timestamp(p.stt * 1000000) AS stt, s.* EXCLUDE (judge_os, search_category, spending_pow, tname, b1_name, slot) FROM pairs p JOIN sums s
ON p.judge_os IS NOT DISTINCT FROM s.judge_os AND p.search_category IS NOT DISTINCT FROM s.search_category AND p.spending_pow IS NOT DISTINCT FROM s.spending_pow
 AND p.tname IS NOT DISTINCT FROM s.tname AND p.b1_name IS NOT DISTINCT FROM s.b1_name AND p.slot IS NOT DISTINCT FROM s.slot""")
def _(m):
    """Profile, orders, pages and their joins in one plan; windows that the watermark has not passed are still open."""
    at = lambda uid, more=0: F.timestamp_seconds(864_000 + uid.cast("long") * 60 + more)
    uid = F.col("uid")
    users = m.over("lb_user", customer=feeds.table(m, "customer")).select("uid", "uname", F.date_add(
        F.lit("1970-01-01").cast("date"), F.col("birthday").cast("int")).alias("birthday"), at(uid).alias("et"))
    body = m.over("lb_body", customer=feeds.table(m, "customer")).withColumn("et", at(uid, uid.cast("long") % 7 * 60))
    orders = feeds.orders(m).select(F.col("id").cast("string").alias("id"), F.col("user_id").cast("string").alias("uid"), "total_amount",
                                    F.timestamp_millis("ts_ms").alias("pay_time"), at(F.col("user_id"), F.col("id") % 16 * 3600).alias("et"))
    lines = feeds.lines(m).select("id", "order_id", "sku_id", at(F.col("user_id"), F.col("order_id").cast("long") % 16 * 3600 + F.col("l_suppkey") % 4 * 60).alias("et"))
    pages = feeds.pages(m).where("uid is not null").select("uid", "ts_ms", F.split("os", " ")[0].alias("os"), F.when(
        F.col("item_type") == "keyword", F.col("item")).alias("search_item"), at(uid, F.col("event_id") % 7 * 3600 + F.col("event_id") % 100).alias("et"))
    return run_append(trade.label_chain(users, body, orders, lines, pages, m["lb_sku"], m["lb_category"], m["lb_word"], m["lb_compare"], AS_OF), "labels")


@query("stream_profile_body", "uid:s height:i weight:i birthday:s", """
SELECT uid, height, weight, DATE '1970-01-01' + CAST(birthday AS INT) AS birthday FROM lb_user JOIN lb_body USING (uid) WHERE CAST(uid AS BIGINT) % 7 <= 5""")
def _(m):
    """Profile and body data within five minutes of each other."""
    cust = "SELECT CAST(c_custkey AS STRING) AS uid, c_custkey, c_custkey * 17 % 20000 AS birthday FROM {customer}"
    users = m.apply(cust, customer=feeds.table(m, "customer")).withColumn("et", F.timestamp_seconds(F.col("c_custkey") + 86400))
    body = m.over("lb_body", customer=feeds.table(m, "customer"))
    body = body.withColumn("et", F.timestamp_seconds(86400 + F.col("uid").cast("long") + (F.col("uid").cast("long") % 7) * 60))
    joined = trade.within(users, body, {"uid": "uid"}, "-5 MINUTES", "5 MINUTES")
    return run_append(joined.select("uid", F.col("r_height").alias("height"), F.col("r_weight").alias("weight"),
                                    F.date_add(F.lit("1970-01-01").cast("date"), F.col("birthday").cast("int")).alias("birthday")), "profile-body")


@query("stream_vehicle_messages", "vehicleNo:s lon:s lat:s dateTime:s ds:s ts:i device_id:s", """
SELECT 'car' || user_id % 40 AS "vehicleNo", CASE WHEN reg THEN '' ELSE CAST(event_id % 97 AS VARCHAR) END AS lon, CASE WHEN reg THEN '' ELSE CAST(event_id % 50 AS VARCHAR) END AS lat, CASE WHEN reg THEN '' ELSE tm END AS "dateTime",
  CASE WHEN reg THEN '99991231' ELSE substr(tm, 1, 8) END AS ds, CASE WHEN reg THEN NULL WHEN length(tm) = 14 THEN epoch_ms(date_trunc('second', ts) - INTERVAL 8 HOUR) ELSE 0 END AS ts, CASE WHEN reg THEN 'dev' || event_id END AS device_id
FROM (SELECT *, event_id % 20 = 0 AS reg, CASE WHEN event_id % 9 = 0 THEN strftime(ts, '%Y%m%d%H') ELSE strftime(ts, '%Y%m%d%H%M%S') END AS tm FROM events)""")
def _(m):
    e = feeds.table(m, "events")
    at = F.when(F.col("event_id") % 9 == 0, F.date_format("ts", "yyyyMMddHH")).otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    reg = F.col("event_id") % 20 == 0
    pos = F.struct((F.col("event_id") % 97).cast("string").alias("lon"), (F.col("event_id") % 50).cast("string").alias("lat"), at.alias("dateTime"))
    text = e.select(F.to_json(F.struct(
        F.concat(F.lit("car"), F.col("user_id") % 40).alias("vehicleNo"), F.when(~reg, pos).alias("upexgmsgreallocation"),
        F.when(reg, F.struct(F.concat(F.lit("dev"), F.col("event_id")).alias("deviceId"))).alias("upexgmsgregister"))).alias("value"))
    return run_append(trade.vehicle_messages(text), "vehicles")


