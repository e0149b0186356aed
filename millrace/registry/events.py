"""Boards, order-dependent rules, moderation, keywords, tracks, labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.weights import BANDS, keys, weight_rows
from millrace.operators import keywords as kw, moderation, sequence as sq, tracks, validity as va
from millrace.plans import boards, labels
from millrace.registry.base import query, share

AS_OF = dt.date(2024, 1, 30)

# ---- ranking boards -----------------------------------------------------------------------
share("b_pay", """
SELECT *, payment_amount + refund_amount + freight_amount AS total_payment_amount, strftime(payment_time, '%H') AS payment_hour FROM board_payment
WHERE payment_status = 'success' AND order_type NOT IN ('subsidy_managed', 'official_bidding') AND NOT (order_type = 'presale' AND payment_time < deposit_pay_time + INTERVAL 7 DAY)
  AND user_id IS NOT NULL AND goods_id IS NOT NULL AND shop_id IS NOT NULL""")
share("b_cart", """
SELECT * REPLACE (CASE WHEN cart_quantity < 0 THEN 0 ELSE cart_quantity END AS cart_quantity), strftime(cart_time, '%H') AS cart_hour FROM board_cart
WHERE cart_status = 'normal' AND user_id IS NOT NULL AND goods_id IS NOT NULL AND shop_id IS NOT NULL""")
share("b_visit", """
SELECT * FROM board_visit WHERE user_id IS NOT NULL AND user_id <> '' AND shop_id IS NOT NULL AND shop_id <> '' AND visit_time IS NOT NULL AND dt IS NOT NULL AND dt <> ''
  AND visit_behavior IN ('直播间观看', '短视频观看', '图文浏览', '微详情浏览', '详情页访问') AND data_source IN ('日志采集', '接口同步')""")
PAY_COLS = "order_id:s user_id:s payment_time:t goods_id:s shop_id:s total_payment_amount:d order_type:s payment_status:s data_source:s payment_hour:s"
CART_COLS = "user_id:s cart_time:t goods_id:s cart_quantity:i shop_id:s cart_status:s data_source:s dt:s cart_hour:s"
VISIT_COLS = "user_id:s visit_time:t visit_behavior:s goods_id:s shop_id:s visit_platform:s data_source:s dt:s"
query("board_clean_payment", PAY_COLS, "SELECT * FROM b_pay")(lambda m: va.valid_payments(m["board_payment"]))
query("board_clean_cart", CART_COLS, "SELECT * FROM b_cart")(lambda m: va.valid_carts(m["board_cart"]))
query("board_clean_visit", VISIT_COLS, "SELECT * FROM b_visit")(lambda m: va.valid_visits(m["board_visit"]))


def _board(src: str, measure: str, expr: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shop_id ORDER BY {measure} DESC, goods_id) AS rk FROM (
 SELECT shop_id, goods_id, {expr} AS {measure} FROM {src} GROUP BY 1, 2)) WHERE rk <= 50"""


query("board_top50_cart", "shop_id:s goods_id:s cart_quantity:i rk:i", _board("b_cart", "cart_quantity", "sum(cart_quantity)"))(lambda m: boards.cart_board(va.valid_carts(m["board_cart"])))
query("board_top50_visitors", "shop_id:s goods_id:s visitors:i rk:i", _board("b_visit", "visitors", "count(DISTINCT user_id)"))(lambda m: boards.visitor_board(va.valid_visits(m["board_visit"])))
query("board_top50_payment", "shop_id:s goods_id:s paid_amount:d rk:i", _board("b_pay", "paid_amount", "sum(total_payment_amount)"))(lambda m: boards.payment_board(va.valid_payments(m["board_payment"])))

# ---- order-dependent rules ----------------------------------------------------------------


@query("newest_wins_rows", "event_id:i user_id:i during_time:i", """
SELECT event_id, user_id, during_time FROM (SELECT e.event_id, e.user_id, p.during_time, max(p.during_time) OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
 FROM events e JOIN page_log p USING (event_id)) WHERE seen IS NULL OR during_time > seen""")
def _(m):
    rows = m.apply("SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, CAST(ROUND(value * 100) AS BIGINT) * 10 AS during_time FROM {events}")
    return sq.newest_wins(rows, ["user_id"], "ts", ["event_id"], "during_time")


# duplicate deliveries: the short line key repeats with changed amounts
DUPLICATES = """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id, l_orderkey AS order_id, l_orderkey % 25 AS province_id, l_partkey AS sku_id, l_suppkey AS supp_id,
  CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' SECOND * (l_orderkey * 31 % 86400) AS ts, CAST(l_extendedprice AS DECIMAL(16,2)) AS amount FROM {lineitem}"""
share("dup_lines", DUPLICATES.format(lineitem="lineitem"))
share("dup_log", """
SELECT *, 1 AS sign FROM dup_lines UNION ALL
SELECT * EXCLUDE (rn), -1 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, order_id DESC, province_id DESC, sku_id DESC, supp_id DESC, amount DESC) AS rn FROM dup_lines) WHERE rn > 1""")


def duplicate_log(m):
    return sq.retractions(m.apply(DUPLICATES), ["id"], ["ts"])


query("retract_on_duplicate", "id:s order_id:i sku_id:i supp_id:i ts:t amount:d sign:i", "SELECT * FROM dup_log")(duplicate_log)


@query("province_order_windows", "province_id:i stt:t edt:t order_amount:d order_count:i", """
SELECT province_id, time_bucket(INTERVAL 10 SECOND, ts) AS stt, stt + INTERVAL 10 SECOND AS edt, sum(sign * amount) AS order_amount, count(DISTINCT order_id) AS order_count FROM dup_log GROUP BY 1, 2""")
def _(m):
    """Ten-second windows per province over the change log; replaced rows net to zero."""
    w = F.window("ts", "10 seconds")
    per_order = duplicate_log(m).groupBy("province_id", w.alias("w"), "order_id").agg(
        F.sum(F.col("sign") * F.col("copies") * F.col("amount")).alias("a"))
    return per_order.groupBy("province_id", "w").agg(F.sum("a").alias("order_amount"), F.count("order_id").alias("order_count")).select(
        "province_id", F.col("w.start").alias("stt"), F.col("w.end").alias("edt"), "order_amount", "order_count")


@query("sku_order_windows", "sku_id:i sku_name:s tm_name:s category3_name:s stt:t order_amount:d order_count:i", """
SELECT l.sku_id, k.sku_name, k.tm_name, k.category3_name, time_bucket(INTERVAL 10 SECOND, ts) AS stt, sum(sign * amount) AS order_amount, count(DISTINCT order_id) AS order_count
FROM dup_log l LEFT JOIN x_sku k ON k.id = l.sku_id GROUP BY ALL""")
def _(m):
    from millrace.operators.joins import lookup
    from millrace.registry.retail import Layer

    per_order = duplicate_log(m).groupBy("sku_id", F.window("ts", "10 seconds").alias("w"), "order_id").agg(
        F.sum(F.col("sign") * F.col("copies") * F.col("amount")).alias("a"))
    agg = per_order.groupBy("sku_id", "w").agg(F.sum("a").alias("order_amount"), F.count("order_id").alias("order_count"))
    out = agg.withColumn("stt", F.col("w.start")).drop("w")
    return lookup(out, Layer(m).sku, {"sku_id": "id"}, sku_name="sku_name", tm_name="tm_name", category3_name="category3_name")


@query("daily_unique_cart_users", "user_id:i cur_date:s create_time:t", """
SELECT user_id, CAST(create_time AS DATE) AS cur_date, min(create_time) AS create_time FROM cart_info GROUP BY 1, 2""")
def _(m):
    return sq.first_of_day(m["cart_info"].select("user_id", "create_time", "id"), ["user_id"], "create_time", ["id"])


@query("login_unique_back", "uid:s login_date:s uu:i back:i", """
SELECT uid, d AS login_date, 1 AS uu, CASE WHEN d - lag(d) OVER (PARTITION BY uid ORDER BY d) >= 8 THEN 1 ELSE 0 END AS back FROM (SELECT DISTINCT uid, dt AS d FROM page_log WHERE uid IS NOT NULL AND page_id = 'payment')""")
def _(m):
    return sq.login_flags(m["page_log"].where("uid is not null and page_id = 'payment'"), "uid", "ts")


share("fix_new", """
SELECT p.event_id, p.mid, p.is_new, p.dt, CASE WHEN p.is_new = '1' AND p.dt <> f.d THEN '0' ELSE p.is_new END AS is_new_fixed FROM page_log p JOIN (
 SELECT mid, CASE WHEN is_new = '1' THEN dt ELSE dt - 1 END AS d FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts_ms, event_id) AS rn FROM page_log) WHERE rn = 1) f USING (mid)""")


@query("new_visitor_flag_repair", "event_id:i mid:s is_new:s is_new_fixed:s", "SELECT * FROM fix_new")
def _(m):
    rows = m["page_log"].select("event_id", "mid", "is_new", "ts")
    return sq.repair_new_flag(rows, "mid", "is_new", "ts", sq.first_seen(rows, "mid", "is_new", "ts", ["event_id"]))


@query("running_user_profile", "uid:s pv:i ts_ms:i os:s ch:s md:s ba:s search_item:s judge_os:s", """
SELECT uid, count(*) AS pv, max(ts_ms) AS ts_ms, string_agg(DISTINCT split_part(os, ' ', 1), ',' ORDER BY split_part(os, ' ', 1)) AS os, string_agg(DISTINCT ch, ',' ORDER BY ch) AS ch, string_agg(DISTINCT md, ',' ORDER BY md) AS md,
  string_agg(DISTINCT ba, ',' ORDER BY ba) AS ba, arg_max(CASE WHEN item_type = 'keyword' THEN item END, ts_ms) FILTER (WHERE item_type = 'keyword') AS search_item,
  split_part(string_agg(DISTINCT split_part(os, ' ', 1), ',' ORDER BY split_part(os, ' ', 1)), ',', 1) AS judge_os FROM page_log WHERE uid IS NOT NULL GROUP BY 1""")
def _(m):
    return labels.device_profile(labels.page_events(m["page_log"]))


# ---- moderation, keywords -----------------------------------------------------------------
share("md_last", "SELECT *, regexp_extract(regexp_replace(msg, ',+$', ''), '[^,]*$') AS last_token FROM comments")
share("md_hits", """
SELECT c.id, string_agg(w.word, ', ' ORDER BY w.word) AS hits FROM comments c
JOIN (SELECT DISTINCT lower(word) AS word FROM words WHERE word <> '') w ON contains(lower(c.msg), w.word) GROUP BY 1""")
_MOD = "id:i order_id:i user_id:i consignee:s msg:s is_violation:i violation_grade:s violation_msg:s"
MOD_SQL = """
SELECT l.*, CASE WHEN w.word IS NOT NULL THEN 1 ELSE 0 END AS is_violation, CASE WHEN w.word IS NOT NULL THEN 'P0' WHEN h.hits IS NOT NULL THEN 'P1' ELSE '' END AS violation_grade,
  CASE WHEN w.word IS NOT NULL THEN l.last_token WHEN h.hits IS NOT NULL THEN h.hits ELSE '' END AS violation_msg
FROM md_last l LEFT JOIN (SELECT DISTINCT word FROM words WHERE word <> '') w ON l.last_token = w.word LEFT JOIN md_hits h USING (id)"""
query("comment_moderation", _MOD, MOD_SQL)(lambda m: moderation.moderate(m["comments"], m["words"]))
share("md_long_hits", """
SELECT c.id, string_agg(w.word, ', ' ORDER BY w.word) AS hits FROM comments c
JOIN (SELECT DISTINCT lower(word) AS word FROM long_words WHERE word <> '') w ON contains(lower(c.msg), w.word) GROUP BY 1""")
query("comment_moderation_long_list", _MOD, MOD_SQL.replace("FROM words", "FROM long_words").replace("md_hits", "md_long_hits"))(
    lambda m: moderation.moderate(m["comments"], m["long_words"]))
_WORDS = r"unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))"
query("keyword_counts_documents", "lang:s keyword:s keyword_count:i", f"""
SELECT lang, keyword, count(*) AS keyword_count FROM (SELECT lang, {_WORDS} AS keyword FROM documents) GROUP BY 1, 2""")(
    lambda m: kw.keyword_counts(m["documents"], "text", F.col("lang")))


share("kd_words", "SELECT DISTINCT lower(word) AS word FROM part_words WHERE length(word) % 4 <> 1")
share("kd_walk", """
WITH RECURSIVE walk AS (SELECT DISTINCT run, 1 AS pos, CAST(NULL AS BIGINT) AS begins, CAST(NULL AS BIGINT) AS n FROM part_runs
 UNION ALL SELECT run, CAST(pos + coalesce(m, 1) AS INTEGER), pos, m FROM (SELECT w.run, w.pos, (SELECT max(length(d.word)) FROM kd_words d WHERE starts_with(substr(w.run, w.pos), d.word)) AS m
  FROM walk w WHERE w.pos <= length(w.run)))
SELECT run, pos, begins, sum(CASE WHEN n IS NOT NULL OR n_before IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY begins) AS piece
FROM (SELECT *, lag(n) OVER (PARTITION BY run ORDER BY begins) AS n_before FROM walk WHERE begins IS NOT NULL)""")


@query("keyword_dictionary_parts", "keyword:s keyword_count:i", """
SELECT keyword, count(*) AS keyword_count FROM part_runs JOIN (SELECT run, string_agg(substr(run, begins, pos - begins), '' ORDER BY begins) AS keyword FROM kd_walk GROUP BY run, piece) USING (run) GROUP BY 1""")
def _(m):
    """Names written without spaces, cut by a dictionary that lacks some of their words."""
    listed = m["part_words"].where("length(word) % 4 <> 1")
    return kw.longest_matches(m["part_runs"], "run", listed).groupBy("keyword").agg(F.count(F.lit(1)).alias("keyword_count"))


@query("search_keyword_windows", "stt:t edt:t cur_date:s keyword:s keyword_count:i", r"""
SELECT time_bucket(INTERVAL 10 SECOND, ts) AS stt, stt + INTERVAL 10 SECOND AS edt, strftime(stt, '%Y%m%d') AS cur_date, keyword, count(*) AS keyword_count FROM (
 SELECT ts, unnest(regexp_extract_all(lower(item), '[\p{L}\p{N}]+')) AS keyword FROM page_log WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL) GROUP BY 1, 4""")
def _(m):
    searched = m["page_log"].where("last_page_id = 'search' and item_type = 'keyword' and item is not null")
    out = kw.keyword_counts(searched, "item", F.window("ts", "10 seconds").alias("w"))
    return out.select(F.col("w.start").alias("stt"), F.col("w.end").alias("edt"), F.date_format("w.start", "yyyyMMdd").alias("cur_date"), "keyword", "keyword_count")


# ---- tracks -------------------------------------------------------------------------------
_R = tracks.MEAN_RADIUS


@query("vehicle_track_length", "vehicle:s dt:s fixes:i km:d", f"""
SELECT vehicle, dt, count(*) AS fixes, round(sum(coalesce(mtr, 0)) / 1000, 3) AS km FROM (
 SELECT *, CASE WHEN plat IS NOT NULL THEN 2 * {_R} * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2)))) END AS mtr FROM (
  SELECT *, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM fixes WINDOW w AS (PARTITION BY vehicle ORDER BY ts, event_id))) GROUP BY 1, 2""")
def _(m):
    return tracks.track_length(m["fixes"]).withColumn("km", F.round(F.col("metres") / 1000, 3))


_F, _A = tracks.FLATTENING, tracks.HALF_AXIS
_P = _A * (1 - _F)
share("geo_pairs", f"""
SELECT event_id, vehicle, dt, x2 - x1 AS dx, sin(r1) AS s1, cos(r1) AS c1, sin(r2) AS s2, cos(r2) AS c2 FROM (
 SELECT event_id, vehicle, dt, radians(plon) AS x1, radians(lon) AS x2, atan((1 - {_F!r}) * tan(radians(plat))) AS r1, atan((1 - {_F!r}) * tan(radians(lat))) AS r2 FROM (
  SELECT *, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM fixes WINDOW w AS (PARTITION BY vehicle ORDER BY ts, event_id)) WHERE plat IS NOT NULL)""")
# the inverse formula as an iteration: the difference of longitudes on the auxiliary sphere until it stands still
share("geo_walk", f"""
WITH RECURSIVE walk AS (
 SELECT event_id, dx, s1, c1, s2, c2, dx AS lam, 0 AS step, true AS moving FROM geo_pairs
 UNION ALL SELECT event_id, dx, s1, c1, s2, c2, new AS lam, step + 1, abs(new - lam) > 1e-12 FROM (
  SELECT *, dx + (1 - k) * {_F!r} * sa * (sig + k * ss * (mid + k * cs * (2 * mid * mid - 1))) AS new FROM (
   SELECT *, {_F!r} / 16 * (1 - sa * sa) * (4 + {_F!r} * (4 - 3 * (1 - sa * sa))) AS k, CASE WHEN 1 - sa * sa = 0 THEN 0.0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS mid FROM (
    SELECT *, atan2(ss, cs) AS sig, CASE WHEN ss = 0 THEN 0.0 ELSE c1 * c2 * sin(lam) / ss END AS sa FROM (
     SELECT *, sqrt(pow(c2 * sin(lam), 2) + pow(c1 * s2 - s1 * c2 * cos(lam), 2)) AS ss, s1 * s2 + c1 * c2 * cos(lam) AS cs FROM walk WHERE moving AND step < 100))))),
ends AS (SELECT event_id, arg_max(lam, step) AS lam, arg_max(moving, step) AS moving, any_value(s1) AS s1, any_value(c1) AS c1, any_value(s2) AS s2, any_value(c2) AS c2 FROM walk GROUP BY 1),
arcs AS (SELECT *, sqrt(pow(c2 * sin(lam), 2) + pow(c1 * s2 - s1 * c2 * cos(lam), 2)) AS ss, s1 * s2 + c1 * c2 * cos(lam) AS cs FROM ends),
bends AS (SELECT *, atan2(ss, cs) AS sig, CASE WHEN ss = 0 THEN 0.0 ELSE c1 * c2 * sin(lam) / ss END AS sa FROM arcs),
squares AS (SELECT *, CASE WHEN 1 - sa * sa = 0 THEN 0.0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS mid, (1 - sa * sa) * {(_A ** 2 - _P ** 2) / _P ** 2!r} AS u2 FROM bends),
series AS (SELECT *, 1 + u2 / 16384 * (4096 + u2 * (u2 * (320 - 175 * u2) - 768)) AS big, u2 / 1024 * (256 + u2 * (u2 * (74 - 47 * u2) - 128)) AS small FROM squares)
SELECT event_id, CASE WHEN moving THEN 'NaN'::DOUBLE WHEN ss = 0 THEN 0.0 ELSE {_P!r} * big * (sig - small * ss * (mid + small / 4 * (cs * (2 * mid * mid - 1) - small / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3)))) END AS metres FROM series""")
query("vehicle_track_length_geodesic", "vehicle:s dt:s fixes:i metres:f", """
SELECT vehicle, dt, count(*) AS fixes, sum(coalesce(round(metres * scale) / scale, 0)) AS metres FROM (
 SELECT f.vehicle, f.dt, g.metres, pow(10.0, 7 - floor(log10(CASE WHEN g.metres > 0 THEN g.metres ELSE 1 END))) AS scale FROM fixes f LEFT JOIN geo_walk g USING (event_id)) GROUP BY 1, 2""")(
    lambda m: tracks.track_length(m["fixes"], exact=True))

# ---- labels -------------------------------------------------------------------------------
_VALUES = ", ".join(f"('{m}', '{k}', '{b}', {i}, CAST(round({w} * {c}, 3) AS DECIMAL(6,3)))" for m, k, b, i, w, c in weight_rows())
share("lab_w", f"SELECT * FROM (VALUES {_VALUES}) AS t(model, k, band, band_no, score)")
share("lab_dev", """
SELECT p.*, c.b1name AS b1_category, x.search_category FROM (
 SELECT uid, count(*) AS pv, max(ts_ms) AS ts_ms, split_part(min(split_part(os, ' ', 1)), ',', 1) AS judge_os, arg_max(item, ts_ms) FILTER (WHERE item_type = 'keyword') AS search_item FROM page_log WHERE uid IS NOT NULL GROUP BY 1) p
LEFT JOIN lb_word c ON c.b3name = p.search_item LEFT JOIN lb_compare x ON x.category_name = c.b1name""")
share("lab_ord", """
SELECT CAST(user_id AS VARCHAR) AS uid, total_amount, o.sku_id, s.tname, c.b1name AS b1_name,
  CASE WHEN hour(pay_time) < 6 THEN '凌晨' WHEN hour(pay_time) < 9 THEN '早晨' WHEN hour(pay_time) < 12 THEN '上午' WHEN hour(pay_time) < 14 THEN '中午' WHEN hour(pay_time) < 18 THEN '下午' WHEN hour(pay_time) < 22 THEN '晚上' ELSE '夜间' END AS pay_time_slot,
  CASE WHEN total_amount < 1000 THEN 'low' WHEN total_amount <= 4000 THEN 'mid' ELSE 'high' END AS spending_pow
FROM (SELECT o.user_id, o.pay_time, o.total_amount, d.sku_id, row_number() OVER (PARTITION BY o.user_id ORDER BY o.pay_time DESC, d.line_id DESC, o.total_amount DESC, d.sku_id DESC) AS rn FROM lb_order o JOIN lb_detail d ON d.order_id = o.id) o
LEFT JOIN lb_sku s ON s.skuid = o.sku_id LEFT JOIN lb_category c ON c.id = s.c3id WHERE rn = 1""")


def in_list(model: str) -> str:
    return ", ".join(f"'{k}'" for k in keys(model))


share("lab_scores", f"""
SELECT f.uid, w.band, w.band_no, sum(w.score) AS score FROM (
 SELECT uid, 'device' AS model, judge_os AS k FROM lab_dev UNION ALL SELECT uid, 'search', CASE WHEN search_category IN ({in_list('search')}) THEN search_category ELSE 'default' END FROM lab_dev
 UNION ALL SELECT uid, 'pay_time', pay_time_slot FROM lab_ord UNION ALL SELECT uid, 'amount', spending_pow FROM lab_ord
 UNION ALL SELECT uid, 'brand', CASE WHEN tname IN ({in_list('brand')}) THEN tname ELSE 'default' END FROM lab_ord
 UNION ALL SELECT uid, 'category', CASE WHEN b1_name IN ({in_list('category')}) THEN b1_name ELSE 'default' END FROM lab_ord) f
JOIN lab_w w ON w.model = f.model AND w.k = f.k SEMI JOIN lab_dev ON lab_dev.uid = f.uid SEMI JOIN lab_ord ON lab_ord.uid = f.uid GROUP BY 1, 2, 3""")
share("lab_base", f"""
SELECT u.uid, u.uname, coalesce(u.gender, 'home') AS gender, u.user_level, DATE '1970-01-01' + CAST(u.birthday AS INT) AS birthday, b.height, b.weight FROM lb_user u LEFT JOIN lb_body b USING (uid)""")
_ZOD = "CASE " + " ".join(f"WHEN month(birthday) * 100 + day(birthday) <= {n} THEN '{z}'" for n, z in [
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"), (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"),
    (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"), (1231, "摩羯座")]) + " END"
share("lab_profile", f"SELECT *, date_sub('year', birthday, DATE '{AS_OF}') AS age, (year(birthday) // 10) * 10 AS decade, {_ZOD} AS zodiac_sign FROM lab_base")


class Parts:
    def __init__(self, m):
        self.base = labels.base_profile(m["lb_user"], m["lb_body"], AS_OF)
        self.devices = labels.with_interest(labels.device_profile(labels.page_events(m["page_log"])), m["lb_word"], m["lb_compare"])
        self.orders = labels.order_features(m["lb_order"], m["lb_detail"], m["lb_sku"], m["lb_category"])

    @property
    def scores(self):
        return labels.band_scores(self.devices.join(self.orders, "uid"))


query("label_base_profile", "uid:s uname:s gender:s user_level:s birthday:s age:i decade:i zodiac_sign:s height:i weight:i", "SELECT * FROM lab_profile")(lambda m: Parts(m).base)
query("label_device_search", "uid:s pv:i ts_ms:i judge_os:s search_item:s b1_category:s search_category:s", "SELECT * FROM lab_dev")(lambda m: Parts(m).devices)
query("label_order_features", "uid:s total_amount:d sku_id:i tname:s b1_name:s pay_time_slot:s spending_pow:s", "SELECT * FROM lab_ord")(lambda m: Parts(m).orders)
query("label_band_scores", "uid:s band:s score:d", "SELECT * FROM lab_scores")(lambda m: Parts(m).scores)
_SUMS = {b: f"sum_{b.replace('-', '_').replace('+', '')}" for b in BANDS}


@query("label_final", "uid:s uname:s age:i zodiac_sign:s judge_os:s spending_pow:s tname:s b1_name:s pv:i ds:s " + " ".join(f"{c}:d" for c in _SUMS.values()) + " calculate_age:s max_score:d", f"""
SELECT b.uid, b.uname, b.age, b.zodiac_sign, d.judge_os, o.spending_pow, o.tname, o.b1_name, d.pv, strftime(make_timestamp(d.ts_ms * 1000), '%Y%m%d') AS ds, w.* EXCLUDE (uid) FROM lab_profile b JOIN lab_dev d USING (uid) JOIN lab_ord o USING (uid) JOIN (
 SELECT uid, {', '.join(f"max(score) FILTER (WHERE band = '{b}') AS {c}" for b, c in _SUMS.items())}, arg_max(band, score * 100000 - band_no) AS calculate_age, max(score) AS max_score FROM lab_scores GROUP BY 1) w USING (uid)""")
def _(m):
    p = Parts(m)
    return labels.final_label(p.base, p.devices, p.orders)


