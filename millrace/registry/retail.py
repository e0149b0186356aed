"""Retail warehouse queries."""

from __future__ import annotations

import datetime as dt

from millrace.plans import retail_ads as ads, retail_dim as dim, retail_dwd as dwd, retail_dws as dws
from millrace.registry.base import query, ratio, share
from millrace.sources import logs

TRADE_DAY = dt.date(2001, 8, 1)
EVENT_DAY = dt.date(2024, 1, 30)
EARLY_DAY = dt.date(1995, 2, 10)
T, E = f"DATE '{TRADE_DAY}'", f"DATE '{EVENT_DAY}'"


class Layer:
    """The retail layers of one model, built lazily."""

    def __init__(self, m):
        self.m = m

    @property
    def sku(self):
        m = self.m
        return dim.sku_names(m["sku_info"], m["spu_info"], m["base_category3"], m["base_category2"],
                             m["base_category1"], m["base_trademark"])

    @property
    def province(self):
        return dim.dim_province(self.m["base_province"], self.m["base_region"])

    @property
    def coupon(self):
        return dim.dim_coupon(self.m["coupon_info"], self.m["base_dic"])

    @property
    def detail(self):
        m = self.m
        return dwd.order_detail(m["order_detail"], m["order_info"], m["order_detail_activity"], m["order_detail_coupon"])

    @property
    def paid(self):
        m = self.m
        return dwd.pay_detail_suc(m["order_detail"], m["order_info"], m["order_detail_activity"],
                                  m["order_detail_coupon"], m["payment_info"], m["base_dic"])

    @property
    def lines(self):
        return dwd.order_lines(self.m["order_detail"], self.m["order_info"])

    @property
    def paid_lines(self):
        return dwd.paid_lines(self.m["order_detail"], self.m["payment_info"])

    @property
    def docs(self):
        return logs.decode_clean(logs.to_documents(self.m["page_log"]))

    @property
    def pages(self):
        return dwd.page_view(self.docs)

    @property
    def logins(self):
        return dwd.user_login(self.docs)

    @property
    def login_td(self):
        return dws.user_login_td(self.m["user_info"], self.logins)


# ---- shared SQL blocks --------------------------------------------------------------------
share("x_sku", """
SELECT s.id, s.sku_name, s.price, s.is_sale, s.spu_id, p.spu_name, c3.id AS category3_id, c3.name AS category3_name, c2.id AS category2_id, c2.name AS category2_name,
  c1.id AS category1_id, c1.name AS category1_name, s.tm_id, t.tm_name
FROM sku_info s LEFT JOIN spu_info p ON s.spu_id = p.id LEFT JOIN base_category3 c3 ON p.category3_id = c3.id LEFT JOIN base_category2 c2 ON c3.category2_id = c2.id
LEFT JOIN base_category1 c1 ON c2.category1_id = c1.id LEFT JOIN base_trademark t ON t.id = s.tm_id""")
share("x_detail", """
SELECT od.id, od.order_id, oi.user_id, od.sku_id, oi.province_id, a.activity_id, a.activity_rule_id, c.coupon_id, CAST(od.create_time AS DATE) AS date_id, od.create_time, od.sku_num,
  CAST(od.sku_num * od.order_price AS DECIMAL(16,2)) AS split_original_amount, coalesce(od.split_activity_amount, 0) AS split_activity_amount, coalesce(od.split_coupon_amount, 0) AS split_coupon_amount,
  od.split_total_amount, od.dt
FROM order_detail od LEFT JOIN order_info oi ON od.order_id = oi.id LEFT JOIN order_detail_activity a ON od.id = a.order_detail_id LEFT JOIN order_detail_coupon c ON od.id = c.order_detail_id""")
share("x_paid", """
SELECT d.id, d.order_id, p.user_id, d.sku_id, d.province_id, d.activity_id, d.coupon_id, p.payment_type, b.dic_name AS payment_type_name, CAST(p.callback_time AS DATE) AS date_id, d.sku_num,
  d.split_activity_amount + d.split_coupon_amount + d.split_total_amount AS split_original_amount, d.split_total_amount AS split_payment_amount, p.dt
FROM x_detail d JOIN payment_info p ON p.order_id = d.order_id AND p.payment_status = '1602' LEFT JOIN base_dic b ON b.dic_code = p.payment_type AND b.parent_code = '11'""")
share("x_user_sku", """
SELECT d.dt, d.user_id, d.sku_id, k.sku_name, k.category1_id, k.category1_name, k.category2_id, k.category2_name, k.category3_id, k.category3_name, k.tm_id, k.tm_name, count(d.id) AS order_count_1d,
  sum(sku_num) AS order_num_1d, sum(split_original_amount) AS order_original_amount_1d, sum(split_activity_amount) AS activity_reduce_amount_1d, sum(split_coupon_amount) AS coupon_reduce_amount_1d,
  sum(split_total_amount) AS order_total_amount_1d
FROM x_detail d LEFT JOIN x_sku k ON d.sku_id = k.id GROUP BY ALL""")
share("x_user_order", """
SELECT dt, user_id, count(order_id) AS order_count_1d, sum(sku_num) AS order_num_1d, sum(split_original_amount) AS order_original_amount_1d, sum(split_activity_amount) AS activity_reduce_amount_1d,
  sum(split_coupon_amount) AS coupon_reduce_amount_1d, sum(split_total_amount) AS order_total_amount_1d FROM x_detail GROUP BY dt, user_id""")
share("x_province", """
SELECT d.dt, d.province_id, p.name AS province_name, p.area_code, p.iso_code, p.iso_3166_2, count(DISTINCT order_id) AS order_count_1d, sum(split_original_amount) AS order_original_amount_1d,
  sum(split_activity_amount) AS activity_reduce_amount_1d, sum(split_coupon_amount) AS coupon_reduce_amount_1d, sum(split_total_amount) AS order_total_amount_1d
FROM x_detail d LEFT JOIN base_province p ON d.province_id = p.id GROUP BY ALL""")
share("x_flow", """
SELECT o.id AS order_id, o.user_id, o.province_id, o.create_time AS order_time, p.callback_time AS payment_time, l.create_time AS finish_time,
  o.total_amount + o.activity_reduce_amount + o.coupon_reduce_amount AS order_original_amount, o.total_amount AS order_total_amount
FROM order_info o LEFT JOIN payment_info p ON p.order_id = o.id AND p.payment_status = '1602' LEFT JOIN order_status_log l ON l.order_id = o.id AND l.order_status = '1004'""")
share("x_session", """
SELECT dt, sid AS session_id, mid AS mid_id, ba AS brand, md AS model, os AS operate_system, vc AS version_code, ch AS channel, sum(during_time) AS during_time_1d, count(*) AS page_count_1d
FROM page_log GROUP BY ALL""")
share("x_page_visitor", """
SELECT dt, mid AS mid_id, ba AS brand, md AS model, os AS operate_system, page_id, sum(during_time) AS during_time_1d, count(*) AS view_count_1d FROM page_log GROUP BY ALL""")
share("x_login", """
SELECT * EXCLUDE (rn) FROM (SELECT sid AS session_id, uid AS user_id, ch AS channel, ar AS province_id, vc AS version_code, mid AS mid_id, ba AS brand, md AS model, os AS operate_system, ts_ms,
  CAST(make_timestamp(ts_ms * 1000) + INTERVAL 8 HOUR AS DATE) AS date_id, strftime(make_timestamp(ts_ms * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS login_time,
  row_number() OVER (PARTITION BY sid ORDER BY ts_ms) AS rn FROM page_log WHERE uid IS NOT NULL) WHERE rn = 1""")
share("x_login_td", """
SELECT CAST(u.id AS VARCHAR) AS user_id, coalesce(l.last, CAST(u.create_time AS DATE)) AS login_date_last, CAST(u.create_time AS DATE) AS login_date_first, coalesce(l.n, 1) AS login_count_td
FROM user_info u LEFT JOIN (SELECT user_id, max(date_id) AS last, count(*) AS n FROM x_login GROUP BY 1) l ON CAST(u.id AS VARCHAR) = l.user_id""")
share("x_days", "SELECT unnest([1, 7, 30]) AS n")

SKU_COLS = "sku_name:s category1_id:i category1_name:s category2_id:i category2_name:s category3_id:i category3_name:s tm_id:i tm_name:s"
SUM_COLS = "order_num_1d:i order_original_amount_1d:d activity_reduce_amount_1d:d coupon_reduce_amount_1d:d order_total_amount_1d:d"

# ---- dimensions ---------------------------------------------------------------------------


@query("retail_dim_sku", f"id:i price:d is_sale:i spu_id:i spu_name:s {SKU_COLS} attrs:s sale_attrs:s", """
SELECT k.*, a.attrs, s.sale_attrs FROM x_sku k
LEFT JOIN (SELECT sku_id, string_agg(attr_name || '=' || value_name, ',' ORDER BY attr_id) AS attrs FROM sku_attr_value GROUP BY 1) a ON a.sku_id = k.id
LEFT JOIN (SELECT sku_id, string_agg(sale_attr_name || '=' || sale_attr_value_name, ',' ORDER BY id) AS sale_attrs FROM sku_sale_attr_value GROUP BY 1) s ON s.sku_id = k.id""")
def _(m):
    from pyspark.sql import functions as F

    def text(col, name, value):
        return F.array_join(F.transform(col, lambda x: F.concat(x[name], F.lit("="), x[value])), ",")

    full = dim.dim_sku(Layer(m).sku, m["sku_attr_value"], m["sku_sale_attr_value"])
    return (full.withColumn("attrs", text("sku_attr_values", "attr_name", "value_name"))
            .withColumn("sale_attrs", text("sku_sale_attr_values", "sale_attr_name", "sale_attr_value_name")))


@query("retail_dim_coupon", "id:i coupon_name:s coupon_type:s coupon_type_name:s range_type_name:s benefit_rule:s", """
SELECT c.*, a.dic_name AS coupon_type_name, b.dic_name AS range_type_name,
  CASE coupon_type WHEN '3201' THEN '满' || condition_amount || '元减' || benefit_amount || '元' WHEN '3202' THEN '满' || condition_num || '件打' || benefit_discount || ' 折'
  WHEN '3203' THEN '减' || benefit_amount || '元' END AS benefit_rule
FROM coupon_info c LEFT JOIN base_dic a ON a.dic_code = coupon_type AND a.parent_code = '32' LEFT JOIN base_dic b ON b.dic_code = range_type AND b.parent_code = '33'""")
def _(m):
    return Layer(m).coupon


@query("retail_dim_activity", "activity_rule_id:i activity_id:i activity_name:s activity_type:s activity_type_name:s benefit_rule:s benefit_level:i", """
SELECT r.id AS activity_rule_id, r.activity_id, i.activity_name, r.activity_type, d.dic_name AS activity_type_name, r.benefit_level,
  CASE activity_type WHEN '3101' THEN '满' || condition_amount || '元减' || benefit_amount || '元' WHEN '3102' THEN '满' || condition_num || '件打' || benefit_discount || ' 折'
  WHEN '3103' THEN '打' || benefit_discount || '折' END AS benefit_rule
FROM activity_rule r LEFT JOIN activity_info i ON r.activity_id = i.id LEFT JOIN base_dic d ON d.dic_code = r.activity_type AND d.parent_code = '31'""")
def _(m):
    return dim.dim_activity(m["activity_rule"], m["activity_info"], m["base_dic"])


@query("retail_dim_province", "id:i province_name:s area_code:s iso_code:s iso_3166_2:s region_id:i region_name:s", """
SELECT p.*, p.name AS province_name, r.region_name FROM base_province p LEFT JOIN base_region r ON p.region_id = r.id""")
def _(m):
    return Layer(m).province


@query("retail_dim_promotion_pos", "id:i pos_location:s pos_type:s promotion_type:s", "SELECT * FROM promotion_pos")
def _(m):
    return dim.dim_promotion_pos(m["promotion_pos"])


@query("retail_dim_promotion_refer", "id:i refer_name:s", "SELECT * FROM promotion_refer")
def _(m):
    return dim.dim_promotion_refer(m["promotion_refer"])


@query("retail_dim_date", "date_id:s week_start:s week_id:i week_day:i day:i month:i quarter:i year:i is_workday:i", """
SELECT CAST(d AS DATE) AS date_id, CAST(date_trunc('week', d) AS DATE) AS week_start, weekofyear(d) AS week_id, isodow(d) AS week_day, day(d) AS "day", month(d) AS "month", quarter(d) AS quarter,
  year(d) AS "year", CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END AS is_workday
FROM (SELECT unnest(generate_series(min(dt)::TIMESTAMP, max(dt)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM order_info)""")
def _(m):
    from millrace.sources.calendar import dim_date

    return dim_date(m["order_info"])


@query("retail_dim_user_zip", "id:i name:s phone_num:s email:s user_level:s birthday:s gender:s start_date:s end_date:s", f"""
SELECT id, name, phone_num, email, CASE WHEN id % 4 = 0 THEN '9' ELSE user_level END AS user_level, DATE '1970-01-01' + CAST(birthday AS INT) AS birthday, gender,
  CASE WHEN id % 4 = 0 THEN DATE '2024-01-30' ELSE DATE '2024-01-29' END AS start_date, DATE '9999-12-31' AS end_date FROM user_info
UNION ALL SELECT id, name, phone_num, email, user_level, DATE '1970-01-01' + CAST(birthday AS INT), gender, DATE '2024-01-29', DATE '2024-01-29' FROM user_info WHERE id % 4 = 0""")
def _(m):
    """First load on one day, then a daily step with changed levels."""
    from pyspark.sql import functions as F

    from millrace.functions.dates import epoch_day_to_date
    from millrace.operators.scd import advance_zipper, open_zipper

    users = m["user_info"].select("id", "name", "phone_num", "email", "user_level",
                                  epoch_day_to_date(F.col("birthday")).alias("birthday"), "gender")
    changed = users.where(F.col("id") % 4 == 0).withColumn("user_level", F.lit("9"))
    return advance_zipper(open_zipper(users, "2024-01-29"), changed, "id", EVENT_DAY)


# ---- detail facts -------------------------------------------------------------------------


@query("retail_dwd_trade_cart_add", "id:i user_id:i sku_id:i date_id:s create_time:t sku_num:i", """
SELECT *, CAST(create_time AS DATE) AS date_id FROM cart_info""")
def _(m):
    return dwd.cart_add(m["cart_info"])


@query("retail_dwd_trade_order_detail", "id:s order_id:i user_id:i sku_id:i province_id:i activity_id:i activity_rule_id:i coupon_id:i date_id:s create_time:t sku_num:i "
       "split_original_amount:d split_activity_amount:d split_coupon_amount:d split_total_amount:d", "SELECT * FROM x_detail")
def _(m):
    return Layer(m).detail


@query("retail_dwd_trade_pay_detail_suc", "id:s order_id:i user_id:i sku_id:i province_id:i activity_id:i coupon_id:i payment_type:s payment_type_name:s date_id:s sku_num:i "
       "split_original_amount:d split_payment_amount:d", "SELECT * FROM x_paid")
def _(m):
    return Layer(m).paid


@query("retail_dwd_trade_cart_full", "id:i user_id:i sku_id:i sku_num:i", "SELECT * FROM cart_info WHERE is_ordered = 0")
def _(m):
    return dwd.cart_full(m["cart_info"])


@query("retail_dwd_trade_trade_flow_acc", "order_id:i user_id:i province_id:i order_time:t payment_time:t finish_time:t order_original_amount:d order_total_amount:d dt:s", """
SELECT *, coalesce(CAST(finish_time AS DATE), DATE '9999-12-31') AS dt FROM x_flow""")
def _(m):
    return dwd.trade_flow(m["order_info"], m["payment_info"], m["order_status_log"])


@query("retail_dwd_tool_coupon_used", "id:i coupon_id:i user_id:i order_id:i date_id:s used_time:t", """
SELECT *, CAST(used_time AS DATE) AS date_id FROM coupon_use WHERE used_time IS NOT NULL""")
def _(m):
    return dwd.coupon_used(m["coupon_use"])


@query("retail_dwd_interaction_favor_add", "id:i user_id:i sku_id:i date_id:s create_time:t", """
SELECT *, CAST(create_time AS DATE) AS date_id FROM favor_info WHERE is_cancel = '0'""")
def _(m):
    return dwd.favor_add(m["favor_info"])


@query("retail_dwd_traffic_page_view", "province_id:s brand:s channel:s is_new:s model:s mid_id:s operate_system:s user_id:s version_code:s page_item:s page_item_type:s last_page_id:s page_id:s "
       "date_id:s view_time:s session_id:s during_time:i", """
SELECT ar AS province_id, ba AS brand, ch AS channel, is_new, md AS model, mid AS mid_id, os AS operate_system, uid AS user_id, vc AS version_code, item AS page_item, item_type AS page_item_type,
  last_page_id, page_id, dt AS date_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS view_time, sid AS session_id, during_time FROM page_log""")
def _(m):
    return Layer(m).pages


@query("retail_dwd_user_register", "user_id:i date_id:s create_time:t channel:s province_id:s version_code:s mid_id:s brand:s model:s operate_system:s", """
SELECT u.id AS user_id, CAST(u.create_time AS DATE) AS date_id, u.create_time, l.channel, l.province_id, l.version_code, l.mid_id, l.brand, l.model, l.operate_system
FROM user_info u LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms) AS rn FROM x_login) l ON CAST(u.id AS VARCHAR) = l.user_id AND l.rn = 1""")
def _(m):
    return dwd.user_register(m["user_info"], Layer(m).docs)


@query("retail_dwd_user_login", "user_id:s date_id:s login_time:s channel:s province_id:s version_code:s mid_id:s brand:s model:s operate_system:s", "SELECT * FROM x_login")
def _(m):
    return Layer(m).logins


# ---- summaries ----------------------------------------------------------------------------


@query("retail_dws_trade_user_sku_order_1d", f"dt:s user_id:i sku_id:i {SKU_COLS} order_count_1d:i {SUM_COLS}", "SELECT * FROM x_user_sku")
def _(m):
    return dws.user_sku_order_1d(Layer(m).lines, Layer(m).sku)


@query("retail_dws_trade_user_order_1d", f"dt:s user_id:i order_count_1d:i {SUM_COLS}", "SELECT * FROM x_user_order")
def _(m):
    return dws.user_order_1d(Layer(m).lines)


@query("retail_dws_trade_user_cart_add_1d", "dt:s user_id:i cart_add_count_1d:i cart_add_num_1d:i", """
SELECT dt, user_id, count(*) AS cart_add_count_1d, sum(sku_num) AS cart_add_num_1d FROM cart_info GROUP BY 1, 2""")
def _(m):
    return dws.user_cart_add_1d(dwd.cart_add(m["cart_info"]))


@query("retail_dws_trade_user_payment_1d", "dt:s user_id:i payment_count_1d:i payment_num_1d:i payment_amount_1d:d", """
SELECT dt, user_id, count(DISTINCT order_id) AS payment_count_1d, sum(sku_num) AS payment_num_1d, sum(split_payment_amount) AS payment_amount_1d FROM x_paid GROUP BY 1, 2""")
def _(m):
    return dws.user_payment_1d(Layer(m).paid_lines)


@query("retail_dws_trade_province_order_1d", "dt:s province_id:i province_name:s area_code:s iso_code:s iso_3166_2:s order_count_1d:i order_original_amount_1d:d activity_reduce_amount_1d:d "
       "coupon_reduce_amount_1d:d order_total_amount_1d:d", "SELECT * FROM x_province")
def _(m):
    return dws.province_order_1d(Layer(m).lines, Layer(m).province)


@query("retail_dws_tool_user_coupon_used_1d", "dt:s user_id:i coupon_id:i coupon_name:s coupon_type_code:s used_count_1d:i", """
SELECT u.dt, u.user_id, u.coupon_id, c.coupon_name, c.coupon_type AS coupon_type_code, count(*) AS used_count_1d
FROM coupon_use u LEFT JOIN coupon_info c ON u.coupon_id = c.id WHERE used_time IS NOT NULL GROUP BY ALL""")
def _(m):
    return dws.user_coupon_used_1d(dwd.coupon_used(m["coupon_use"]), Layer(m).coupon)


@query("retail_dws_interaction_sku_favor_add_1d", f"dt:s sku_id:i {SKU_COLS} favor_add_count_1d:i", """
SELECT f.dt, f.sku_id, k.* EXCLUDE (id), f.n AS favor_add_count_1d FROM (SELECT dt, sku_id, count(*) AS n FROM favor_info WHERE is_cancel = '0' GROUP BY 1, 2) f LEFT JOIN x_sku k ON f.sku_id = k.id""")
def _(m):
    return dws.sku_favor_add_1d(dwd.favor_add(m["favor_info"]), Layer(m).sku)


@query("retail_dws_traffic_session_page_view_1d", "dt:s session_id:s mid_id:s brand:s model:s operate_system:s version_code:s channel:s during_time_1d:i page_count_1d:i", "SELECT * FROM x_session")
def _(m):
    return dws.session_page_view_1d(Layer(m).pages)


@query("retail_dws_traffic_page_visitor_page_view_1d", "dt:s mid_id:s brand:s model:s operate_system:s page_id:s during_time_1d:i view_count_1d:i", "SELECT * FROM x_page_visitor")
def _(m):
    return dws.page_visitor_1d(Layer(m).pages)


def _nd(names: list[str]) -> str:
    return ", ".join(f"coalesce(sum({n}_1d) FILTER (WHERE dt >= {T} - {k - 1}), 0) AS {n}_{k}d" for k in (7, 30) for n in names)


_ALL = ["order_count", "order_num", "order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount"]
_PROV = [n for n in _ALL if n != "order_num"]


def _types(names: list[str]) -> str:
    return " ".join(f"{n}_{k}d:{'i' if n in ('order_count', 'order_num') else 'd'}" for k in (7, 30) for n in names)


@query("retail_dws_trade_user_sku_order_nd", f"user_id:i sku_id:i {SKU_COLS} {_types(_ALL)}", f"""
SELECT user_id, sku_id, sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name, {_nd(_ALL)}
FROM x_user_sku WHERE dt > {T} - 30 AND dt <= {T} GROUP BY ALL""")
def _(m):
    return dws.user_sku_order_nd(dws.user_sku_order_1d(Layer(m).lines, Layer(m).sku), TRADE_DAY)


@query("retail_dws_trade_province_order_nd", f"province_id:i province_name:s area_code:s iso_code:s iso_3166_2:s {_types(_PROV)}", f"""
SELECT province_id, province_name, area_code, iso_code, iso_3166_2, {_nd(_PROV)} FROM x_province WHERE dt > {T} - 30 AND dt <= {T} GROUP BY ALL""")
def _(m):
    return dws.province_order_nd(dws.province_order_1d(Layer(m).lines, Layer(m).province), TRADE_DAY)


@query("retail_dws_trade_user_order_td", "user_id:i order_date_first:s order_date_last:s order_count_td:i order_num_td:i order_original_amount_td:d order_total_amount_td:d", """
SELECT user_id, min(dt) AS order_date_first, max(dt) AS order_date_last, sum(order_count_1d) AS order_count_td, sum(order_num_1d) AS order_num_td,
  sum(order_original_amount_1d) AS order_original_amount_td, sum(order_total_amount_1d) AS order_total_amount_td FROM x_user_order GROUP BY 1""")
def _(m):
    return dws.user_order_td(dws.user_order_1d(Layer(m).lines))


@query("retail_dws_user_user_login_td", "user_id:s login_date_last:s login_date_first:s login_count_td:i", "SELECT * FROM x_login_td")
def _(m):
    return Layer(m).login_td


# ---- reports ------------------------------------------------------------------------------


@query("retail_ads_traffic_stats_by_channel", "dt:s recent_days:i channel:s uv_count:i avg_duration_sec:i avg_page_count:i sv_count:i bounce_rate:d", f"""
SELECT {E} AS dt, n AS recent_days, channel, count(DISTINCT mid_id) AS uv_count, floor(sum(during_time_1d) / count(*) / 1000) AS avg_duration_sec, floor(sum(page_count_1d) / count(*)) AS avg_page_count,
  count(*) AS sv_count, {ratio("count(*) FILTER (WHERE page_count_1d = 1)", "count(*)", 2)} AS bounce_rate
FROM x_session JOIN x_days ON dt > {E} - n WHERE dt <= {E} GROUP BY n, channel""")
def _(m):
    return ads.traffic_by_channel(dws.session_page_view_1d(Layer(m).pages), EVENT_DAY)


@query("retail_ads_page_path", "source:s target:s path_count:i", """
SELECT source, coalesce(target, 'null') AS target, count(*) AS path_count FROM (
  SELECT 'step-' || rn || ':' || page_id AS source, 'step-' || (rn + 1) || ':' || nxt AS target FROM (
    SELECT page_id, lead(page_id) OVER w AS nxt, row_number() OVER w AS rn FROM page_log WINDOW w AS (PARTITION BY sid ORDER BY ts_ms, page_id))) GROUP BY 1, 2""")
def _(m):
    return ads.page_path(Layer(m).pages, None)


@query("retail_ads_user_change", "dt:s user_churn_count:i user_back_count:i", f"""
WITH today AS (SELECT * FROM x_login_td), prev AS (
  SELECT CAST(u.id AS VARCHAR) AS user_id, coalesce(l.last, CAST(u.create_time AS DATE)) AS login_date_last FROM user_info u
  LEFT JOIN (SELECT user_id, max(date_id) AS last FROM x_login WHERE date_id < {E} GROUP BY 1) l ON CAST(u.id AS VARCHAR) = l.user_id)
SELECT {E} AS dt, (SELECT count(*) FROM today WHERE login_date_last = {E} - 7) AS user_churn_count,
  (SELECT count(*) FROM today t JOIN prev p USING (user_id) WHERE t.login_date_last = {E} AND t.login_date_last - p.login_date_last >= 8) AS user_back_count""")
def _(m):
    from pyspark.sql import functions as F

    layer = Layer(m)
    earlier = layer.logins.where(F.col("date_id") < F.lit(EVENT_DAY))
    return ads.user_change(layer.login_td, dws.user_login_td(m["user_info"], earlier), EVENT_DAY)


@query("retail_ads_user_retention", "dt:s create_date:s retention_day:i retention_count:i new_user_count:i retention_rate:d", f"""
SELECT {E} AS dt, login_date_first AS create_date, {E} - login_date_first AS retention_day, count(*) FILTER (WHERE login_date_last = {E}) AS retention_count, count(*) AS new_user_count,
  {ratio(f"100 * count(*) FILTER (WHERE login_date_last = {E})", "count(*)", 2)} AS retention_rate
FROM x_login_td WHERE login_date_first >= {E} - 7 AND login_date_first < {E} GROUP BY 2, 3""")
def _(m):
    return ads.user_retention(Layer(m).login_td, EVENT_DAY)


@query("retail_ads_user_stats", "dt:s recent_days:i new_user_count:i active_user_count:i", f"""
SELECT {E} AS dt, n AS recent_days, count(*) FILTER (WHERE login_date_first > {E} - n) AS new_user_count, count(*) AS active_user_count
FROM x_login_td JOIN x_days ON login_date_last > {E} - n GROUP BY n""")
def _(m):
    return ads.user_stats(Layer(m).login_td, EVENT_DAY)


share("x_purchase_user", "SELECT CAST(ts AS DATE) AS dt, user_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2")


@query("retail_ads_user_action", "dt:s home_count:i good_detail_count:i cart_count:i order_count:i payment_count:i", f"""
SELECT {E} AS dt, (SELECT count(*) FROM x_page_visitor WHERE dt = {E} AND page_id = 'home') AS home_count, (SELECT count(*) FROM x_page_visitor WHERE dt = {E} AND page_id = 'good_detail') AS good_detail_count,
  (SELECT count(DISTINCT user_id) FROM cart_info WHERE dt = {E}) AS cart_count, (SELECT count(*) FROM x_purchase_user WHERE dt = {E}) AS order_count,
  (SELECT count(DISTINCT user_id) FROM product_payment WHERE CAST(pay_time AS DATE) = {E}) AS payment_count""")
def _(m):
    from pyspark.sql import functions as F

    pays = m["product_payment"].withColumn("dt", F.to_date("pay_time"))
    return ads.user_action(dws.page_visitor_1d(Layer(m).pages), dws.user_cart_add_1d(dwd.cart_add(m["cart_info"])),
                           m["product_order"].select("dt", "user_id").distinct(),
                           pays.select("dt", "user_id").distinct(), EVENT_DAY)


@query("retail_ads_new_order_user_stats", "dt:s recent_days:i new_order_user_count:i", f"""
SELECT DATE '{EARLY_DAY}' AS dt, n AS recent_days, count(*) AS new_order_user_count
FROM (SELECT user_id, min(dt) AS f FROM x_user_order WHERE dt <= DATE '{EARLY_DAY}' GROUP BY 1) JOIN x_days ON f > DATE '{EARLY_DAY}' - n GROUP BY n""")
def _(m):
    from pyspark.sql import functions as F

    known = Layer(m).lines.where(F.col("dt") <= F.lit(EARLY_DAY))
    return ads.new_order_users(dws.user_order_td(dws.user_order_1d(known)), EARLY_DAY)


@query("retail_ads_order_continuously_user_count", "dt:s recent_days:i order_continuously_user_count:i", f"""
SELECT {E} AS dt, 7 AS recent_days, count(DISTINCT user_id) AS order_continuously_user_count FROM (
  SELECT user_id, lead(dt, 2) OVER (PARTITION BY user_id ORDER BY dt) - dt AS gap FROM x_purchase_user WHERE dt > {E} - 7 AND dt <= {E}) WHERE gap = 2""")
def _(m):
    return ads.streak_buyers(m["product_order"], EVENT_DAY)


@query("retail_ads_repeat_purchase_by_tm", "dt:s recent_days:i tm_id:i tm_name:s order_repeat_rate:d", f"""
SELECT {T} AS dt, 30 AS recent_days, tm_id, tm_name, {ratio("count(*) FILTER (WHERE n >= 2)", "count(*) FILTER (WHERE n >= 1)", 2)} AS order_repeat_rate
FROM (SELECT tm_id, tm_name, user_id, sum(order_count_1d) AS n FROM x_user_sku WHERE dt > {T} - 30 AND dt <= {T} GROUP BY 1, 2, 3) GROUP BY tm_id, tm_name""")
def _(m):
    return ads.repeat_purchase(dws.user_sku_order_1d(Layer(m).lines, Layer(m).sku), TRADE_DAY)


@query("retail_ads_order_stats_by_tm", "dt:s recent_days:i tm_id:i tm_name:s order_count:i order_user_count:i", f"""
SELECT {T} AS dt, n AS recent_days, tm_id, tm_name, sum(order_count_1d) AS order_count, count(DISTINCT user_id) AS order_user_count FROM x_user_sku JOIN x_days ON dt > {T} - n WHERE dt <= {T} GROUP BY n, tm_id, tm_name""")
def brand_orders(m):
    return ads.order_stats_by_brand(dws.user_sku_count_1d(Layer(m).lines, m["sku_info"], "tm_id"), m["base_trademark"], TRADE_DAY)


@query("retail_ads_order_stats_by_cate", "dt:s recent_days:i category1_id:i category1_name:s category2_id:i category2_name:s category3_id:i category3_name:s order_count:i order_user_count:i", f"""
SELECT {T} AS dt, n AS recent_days, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, sum(order_count_1d) AS order_count, count(DISTINCT user_id) AS order_user_count
FROM x_user_sku JOIN x_days ON dt > {T} - n WHERE dt <= {T} GROUP BY ALL""")
def _(m):
    daily = dws.user_sku_count_1d(Layer(m).lines, dim.sku_category(m["sku_info"], m["spu_info"]), "category3_id")
    return ads.order_stats_by_category(daily, m["base_category3"], m["base_category2"], m["base_category1"], TRADE_DAY)


@query("retail_ads_sku_cart_num_top3_by_cate", "dt:s category1_id:i category2_id:i category3_id:i category3_name:s sku_id:i sku_name:s cart_num:i rk:i", f"""
SELECT * FROM (SELECT {E} AS dt, k.* EXCLUDE (id), c.sku_id, c.cart_num, rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) AS rk
FROM (SELECT sku_id, sum(sku_num) AS cart_num FROM cart_info WHERE is_ordered = 0 GROUP BY 1) c LEFT JOIN x_sku k ON c.sku_id = k.id) WHERE rk <= 3""")
def _(m):
    return ads.cart_top3_by_category(dwd.cart_full(m["cart_info"]), Layer(m).sku, EVENT_DAY)


@query("retail_ads_sku_favor_count_top3_by_tm", "dt:s tm_id:i tm_name:s sku_id:i sku_name:s favor_count:i rk:i", f"""
SELECT * FROM (SELECT f.dt, k.tm_id, k.tm_name, f.sku_id, k.sku_name, f.n AS favor_count, rank() OVER (PARTITION BY k.tm_id ORDER BY f.n DESC) AS rk
FROM (SELECT dt, sku_id, count(*) AS n FROM favor_info WHERE is_cancel = '0' AND dt = {E} GROUP BY 1, 2) f LEFT JOIN x_sku k ON f.sku_id = k.id) WHERE rk <= 3""")
def _(m):
    return ads.favor_top3_by_brand(dws.sku_favor_add_1d(dwd.favor_add(m["favor_info"]), Layer(m).sku), EVENT_DAY)


@query("retail_ads_order_to_pay_interval_avg", "dt:s order_to_pay_interval_avg:i", f"""
SELECT {T} AS dt, floor(avg(date_diff('second', order_time, payment_time))) AS order_to_pay_interval_avg FROM x_flow WHERE CAST(payment_time AS DATE) = {T}""")
def _(m):
    return ads.order_to_pay_interval(dwd.trade_flow(m["order_info"], m["payment_info"], m["order_status_log"]), TRADE_DAY)


@query("retail_ads_order_by_province", "dt:s recent_days:i province_id:i province_name:s area_code:s iso_code:s iso_3166_2:s order_count:i order_total_amount:d", f"""
SELECT {T} AS dt, n AS recent_days, province_id, province_name, area_code, iso_code, iso_3166_2, sum(order_count_1d) AS order_count, sum(order_total_amount_1d) AS order_total_amount
FROM x_province JOIN x_days ON dt > {T} - n WHERE dt <= {T} GROUP BY ALL""")
def _(m):
    return ads.order_by_province(dws.province_order_1d(Layer(m).lines, Layer(m).province), TRADE_DAY)


@query("retail_ads_coupon_stats", "dt:s coupon_id:i coupon_name:s used_count:i used_user_count:i", f"""
SELECT u.dt, u.coupon_id, c.coupon_name, count(*) AS used_count, count(DISTINCT user_id) AS used_user_count FROM coupon_use u LEFT JOIN coupon_info c ON u.coupon_id = c.id
WHERE used_time IS NOT NULL AND u.dt = {E} GROUP BY 1, 2, 3""")
def _(m):
    return ads.coupon_stats(dws.user_coupon_used_1d(dwd.coupon_used(m["coupon_use"]), Layer(m).coupon), EVENT_DAY)
