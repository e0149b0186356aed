"""Product, pricing, marketing, related-product and new-product analyses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.plans import (marketing as mk, new_products as npd, pricing as pr, product360 as p360,
                            product_events as pe, related as rl)
from millrace.registry.base import query, ratio, share, signed_ratio

DAY = dt.date(2024, 1, 30)
PREV = dt.date(2024, 1, 29)
D, P = f"DATE '{DAY}'", f"DATE '{PREV}'"

# ---- product events -----------------------------------------------------------------------


class Events:
    def __init__(self, m):
        p = m["product_info"]
        self.product = p
        self.visits = pe.visit_detail(m["product_visit"], p, DAY)
        self.favs = pe.events_detail(m["product_favorite"], p, "fav_time", DAY)
        self.carts = pe.events_detail(m["product_cart"], p, "cart_time", DAY)
        self.orders = pe.events_detail(m["product_order"], p, "order_time", DAY)
        self.pays = pe.payment_detail(m["product_payment"], m["product_order"], p, DAY)
        self.refunds = pe.events_detail(m["product_refund"], p, "refund_time", DAY)

    @property
    def tables(self):
        return self.visits, self.favs, self.carts, self.orders, self.pays, self.refunds


_PN = "p.product_name, p.category_id, p.category_name"
_NC = "product_name:s category_id:i category_name:s"
_R30 = f">= {D} - 30"
share("z_visit", f"SELECT v.*, {_PN} FROM product_visit v JOIN product_info p USING (product_id) WHERE stay_seconds > 0 AND CAST(visit_time AS DATE) {_R30}")
share("z_fav", f"SELECT v.*, {_PN} FROM product_favorite v JOIN product_info p USING (product_id) WHERE CAST(fav_time AS DATE) {_R30}")
share("z_cart", f"SELECT v.*, {_PN} FROM product_cart v JOIN product_info p USING (product_id) WHERE CAST(cart_time AS DATE) {_R30}")
share("z_order", f"SELECT v.*, {_PN} FROM product_order v JOIN product_info p USING (product_id) WHERE CAST(order_time AS DATE) {_R30}")
share("z_pay", f"""SELECT v.*, {_PN} FROM product_payment v JOIN product_info p USING (product_id) JOIN (SELECT order_id, order_time FROM product_order) o USING (order_id)
WHERE pay_amount > 0 AND pay_time >= order_time AND CAST(pay_time AS DATE) {_R30}""")
share("z_refund", f"SELECT v.*, {_PN} FROM product_refund v JOIN product_info p USING (product_id) WHERE CAST(refund_time AS DATE) {_R30}")

query("product_events_dwd_info", f"product_id:i {_NC} price:d", "SELECT * FROM product_info")(lambda m: m["product_info"])
query("product_events_dwd_visit", f"product_id:i {_NC} user_id:i visit_time:t stay_seconds:i terminal_type:s is_micro_detail:i", "SELECT * FROM z_visit")(lambda m: Events(m).visits)
query("product_events_dwd_favorite", f"product_id:i {_NC} user_id:i fav_time:t", "SELECT * FROM z_fav")(lambda m: Events(m).favs)
query("product_events_dwd_cart", f"product_id:i {_NC} user_id:i quantity:i cart_time:t", "SELECT * FROM z_cart")(lambda m: Events(m).carts)
query("product_events_dwd_order", f"order_id:i product_id:i {_NC} user_id:i quantity:i order_amount:d order_time:t activity_type:s", "SELECT * FROM z_order")(lambda m: Events(m).orders)
query("product_events_dwd_payment", f"order_id:i product_id:i {_NC} user_id:i pay_amount:d pay_time:t activity_type:s", "SELECT * FROM z_pay")(lambda m: Events(m).pays)
query("product_events_dwd_refund", f"order_id:i product_id:i {_NC} user_id:i refund_amount:d refund_time:t", "SELECT * FROM z_refund")(lambda m: Events(m).refunds)

share("z_udp", """
SELECT v.*, f.n AS fav, c.n AS cart, c.q AS cart_qty, o.n AS ord, o.q AS order_qty, o.a AS order_amount, y.n AS pays, y.a AS pay_amount, y.j AS juhua, r.a AS refund_amount FROM
 (SELECT CAST(visit_time AS DATE) AS d, user_id, product_id, count(*) AS pv, sum(stay_seconds) AS stay, count(*) FILTER (WHERE stay_seconds <= 3) AS bounce, max(CASE WHEN is_micro_detail = 1 THEN 1 END) AS micro FROM z_visit GROUP BY 1, 2, 3) v
 LEFT JOIN (SELECT CAST(fav_time AS DATE) AS d, user_id, product_id, count(*) AS n FROM z_fav GROUP BY 1, 2, 3) f USING (d, user_id, product_id)
 LEFT JOIN (SELECT CAST(cart_time AS DATE) AS d, user_id, product_id, count(*) AS n, sum(quantity) AS q FROM z_cart GROUP BY 1, 2, 3) c USING (d, user_id, product_id)
 LEFT JOIN (SELECT CAST(order_time AS DATE) AS d, user_id, product_id, count(*) AS n, sum(quantity) AS q, sum(order_amount) AS a FROM z_order GROUP BY 1, 2, 3) o USING (d, user_id, product_id)
 LEFT JOIN (SELECT CAST(pay_time AS DATE) AS d, user_id, product_id, count(*) AS n, sum(pay_amount) AS a, sum(pay_amount) FILTER (WHERE activity_type = 'JUHUASUAN') AS j FROM z_pay GROUP BY 1, 2, 3) y USING (d, user_id, product_id)
 LEFT JOIN (SELECT CAST(refund_time AS DATE) AS d, user_id, product_id, sum(refund_amount) AS a FROM z_refund GROUP BY 1, 2, 3) r USING (d, user_id, product_id)""")
share("z_product_day", f"""
SELECT x.d AS summary_date, x.product_id, {_PN}, count(*) AS uv, sum(pv) AS pv, {ratio('sum(stay)', 'sum(pv)', 2)} AS avg_stay_seconds, {ratio('sum(bounce)', 'sum(pv)', 4)} AS bounce_rate, count(micro) AS micro_detail_uv,
  count(fav) AS fav_users, count(cart) AS cart_users, sum(cart_qty) AS cart_qty, count(ord) AS order_users, sum(order_qty) AS order_qty, sum(order_amount) AS order_amount, count(pays) AS pay_users, coalesce(sum(pays), 0) AS pay_qty,
  sum(pay_amount) AS pay_amount, coalesce(sum(juhua), 0) AS juhuasuan_pay_amount, CASE WHEN sum(pay_amount) > 0 THEN 1 ELSE 0 END AS active_products, {ratio('sum(pay_amount) * 100', 'sum(order_qty) * 100', 2)} AS item_unit_price,
  sum(refund_amount) AS refund_amount
FROM z_udp x JOIN product_info p USING (product_id) GROUP BY ALL""")


@query("product_events_dws_product_day", f"summary_date:s product_id:i {_NC} uv:i pv:i avg_stay_seconds:d bounce_rate:d micro_detail_uv:i fav_users:i cart_users:i cart_qty:i order_users:i order_qty:i order_amount:d pay_users:i "
       "pay_qty:i pay_amount:d juhuasuan_pay_amount:d active_products:i item_unit_price:d refund_amount:d", "SELECT * FROM z_product_day")
def _(m):
    e = Events(m)
    return pe.product_day(*e.tables, e.product)


@query("product_events_dws_user_day", "summary_date:s user_id:i visit_products:i pv:i fav_count:i cart_count:i order_count:i pay_count:i total_pay_amount:d total_refund_amount:d", """
SELECT d AS summary_date, user_id, count(*) AS visit_products, sum(pv) AS pv, count(fav) AS fav_count, count(cart) AS cart_count, count(ord) AS order_count, count(pays) AS pay_count,
  coalesce(sum(pay_amount), 0) AS total_pay_amount, coalesce(sum(refund_amount), 0) AS total_refund_amount FROM z_udp GROUP BY 1, 2""")
def _(m):
    return pe.user_day(*Events(m).tables)


share("z_order_money", """
SELECT o.*, CAST(order_time AS DATE) AS summary_date, y.a AS pay_amount, y.u AS pay_user_id, r.a AS refund_amount FROM z_order o
LEFT JOIN (SELECT order_id, sum(pay_amount) AS a, max(user_id) AS u FROM z_pay GROUP BY 1) y USING (order_id) LEFT JOIN (SELECT order_id, sum(refund_amount) AS a FROM z_refund GROUP BY 1) r USING (order_id)""")
share("z_trade_day", """
SELECT summary_date, count(DISTINCT user_id) AS uv, count(DISTINCT order_id) AS order_count, sum(order_amount) AS total_order_amount, count(DISTINCT pay_user_id) AS pay_user_count, sum(pay_amount) AS total_pay_amount,
  sum(refund_amount) AS total_refund_amount FROM z_order_money GROUP BY 1""")
_TRADE = "uv:i order_count:i total_order_amount:d pay_user_count:i total_pay_amount:d total_refund_amount:d"


@query("product_events_dws_activity_day", "summary_date:s activity_type:s uv:i total_order_amount:d total_pay_amount:d total_refund_amount:d", """
SELECT summary_date, activity_type, count(DISTINCT user_id) AS uv, sum(order_amount) AS total_order_amount, coalesce(sum(pay_amount), 0) AS total_pay_amount, coalesce(sum(refund_amount), 0) AS total_refund_amount
FROM z_order_money GROUP BY 1, 2""")
def _(m):
    e = Events(m)
    return pe.activity_day(e.orders, e.pays, e.refunds)


@query("product_events_dws_trade_day", f"summary_date:s {_TRADE}", "SELECT * FROM z_trade_day")
def _(m):
    e = Events(m)
    return pe.trade_day(e.orders, e.pays, e.refunds)


_PSUM = ", ".join(f"sum({c}) AS {c}" for c in pe.PRODUCT_SUMS)
_PCOL = "uv:i pv:i fav_users:i cart_users:i order_users:i pay_users:i pay_amount:d refund_amount:d avg_stay_seconds:d bounce_rate:d uv_distinct:i"
_TSUM = ", ".join(f"sum({c}) AS {c}" for c in pe.TRADE_SUMS)
_PERIOD = {"week": ("CAST(date_trunc('week', {0}) AS DATE)", "week_start", "min(summary_date)"), "month": ("strftime({0}, '%Y-%m')", "month_key", "any_value(per)")}
for _p, (_expr, _key, _val) in _PERIOD.items():
    query(f"product_events_ads_product_{_p}", f"{_key}:s product_id:i {_NC} {_PCOL}", f"""
SELECT a.*, b.uv_distinct FROM (
 SELECT per, {_val} AS {_key}, product_id, product_name, category_id, category_name, {_PSUM}, {ratio('sum(CAST(round(avg_stay_seconds * 100) AS BIGINT))', 'count(*) * 100', 2)} AS avg_stay_seconds,
   {ratio('sum(CAST(round(bounce_rate * 10000) AS BIGINT))', 'count(*) * 10000', 4)} AS bounce_rate FROM (SELECT *, {_expr.format('summary_date')} AS per FROM z_product_day) GROUP BY per, product_id, product_name, category_id, category_name) a
JOIN (SELECT {_expr.format('visit_time')} AS per, product_id, count(DISTINCT user_id) AS uv_distinct FROM z_visit GROUP BY 1, 2) b USING (per, product_id)""")(
        lambda m, p=_p: (lambda e: pe.product_report(pe.product_day(*e.tables, e.product), e.visits, p))(Events(m)))
    query(f"product_events_ads_trade_{_p}", f"{_key}:s {_TRADE} uv_distinct:i", f"""
SELECT a.*, b.uv_distinct FROM (SELECT per, {_val} AS {_key}, {_TSUM} FROM (SELECT *, {_expr.format('summary_date')} AS per FROM z_trade_day) GROUP BY per) a
JOIN (SELECT {_expr.format('order_time')} AS per, count(DISTINCT user_id) AS uv_distinct FROM z_order GROUP BY 1) b USING (per)""")(
        lambda m, p=_p: (lambda e: pe.trade_report(pe.trade_day(e.orders, e.pays, e.refunds), e.orders, p))(Events(m)))

query("product_events_ads_product_day", f"summary_date:s product_id:i {_NC} uv:i pv:i avg_stay_seconds:d bounce_rate:d fav_users:i cart_users:i order_users:i pay_users:i pay_amount:d refund_amount:d", "SELECT * FROM z_product_day")(
    lambda m: (lambda e: pe.product_day(*e.tables, e.product))(Events(m)))
query("product_events_ads_trade_day", f"summary_date:s {_TRADE}", "SELECT * FROM z_trade_day")(
    lambda m: (lambda e: pe.trade_day(e.orders, e.pays, e.refunds))(Events(m)))

# ---- pricing ------------------------------------------------------------------------------
share("w_product", "SELECT * REPLACE (CASE WHEN price_strength_star BETWEEN 1 AND 5 THEN price_strength_star ELSE 3 END AS price_strength_star) FROM product_info")
share("w_order", "SELECT * REPLACE (CAST(pay_time AS DATE) AS dt) FROM trade WHERE pay_time IS NOT NULL")
share("w_traffic", "SELECT * FROM traffic WHERE visitor_count > 0")
share("w_sales", f"""SELECT product_id, p.category_id, sum(pay_amount) AS total_sales, sum(pay_quantity) AS total_quantity, sum(buyer_count) AS total_buyer_count, '7d' AS stat_period
FROM w_order o JOIN w_product p USING (product_id) WHERE dt > {D} - 7 AND dt <= {D} GROUP BY 1, 2""")
_RATE = "printf('%.2f', {0})"
share("w_conv", f"""
SELECT product_id, source, search_word, total_visitor, b AS buyers, {ratio('b * 100', 'total_visitor', 2)} AS rate FROM (
 SELECT product_id, source, coalesce(search_word, '') AS search_word, sum(visitor_count) AS total_visitor FROM w_traffic WHERE dt = {D} GROUP BY 1, 2, 3)
LEFT JOIN (SELECT product_id, sum(buyer_count) AS b FROM w_order WHERE dt = {D} GROUP BY 1) USING (product_id)""")
share("w_strength", """
SELECT p.product_id, max(p.price_strength_star) AS price_strength_star, CASE WHEN max(p.price_strength_star) <= 2 THEN 1 ELSE 0 END AS is_price_warn, CASE WHEN max(c.rate) < 5 THEN 1 ELSE 0 END AS is_product_warn
FROM w_product p LEFT JOIN w_conv c USING (product_id) GROUP BY 1""")


def _conv(m):
    return pr.traffic_conversion(pr.traffic_detail(m["traffic"]), pr.order_detail(m["trade"]), DAY)


def _sales(m):
    return pr.sales_7d(pr.order_detail(m["trade"]), pr.product_detail(m["product_info"]), DAY)


def _strength(m):
    return pr.price_strength(pr.product_detail(m["product_info"]), _conv(m), DAY)


query("pricing_dwd_product", "product_id:i category_id:i product_name:s price_strength_star:i", "SELECT * FROM w_product")(lambda m: pr.product_detail(m["product_info"]))
query("pricing_dwd_order_detail", "order_id:i product_id:i sku_id:i user_id:i pay_amount:d pay_time:t buyer_count:i pay_quantity:i dt:s", "SELECT * FROM w_order")(lambda m: pr.order_detail(m["trade"]))
query("pricing_dwd_traffic_detail", "traffic_id:i product_id:i visitor_count:i source:s search_word:s visit_time:t dt:s", "SELECT * FROM w_traffic")(lambda m: pr.traffic_detail(m["traffic"]))
query("pricing_dwd_inventory_detail", "inventory_id:i sku_id:i current_stock:i saleable_days:i update_time:t dt:s", f"SELECT *, {D} AS dt FROM inventory WHERE CAST(update_time AS DATE) = {D}")(
    lambda m: pr.inventory_detail(m["inventory"], DAY))
query("pricing_dws_product_sale_agg", "product_id:i category_id:i total_sales:d total_quantity:i total_buyer_count:i stat_period:s dt:s", f"SELECT *, {D} AS dt FROM w_sales")(_sales)
query("pricing_dws_product_traffic_agg", "product_id:i source:s search_word:s total_visitor:i pay_conversion_rate:s", f"SELECT *, {_RATE.format('rate')} || '%' AS pay_conversion_rate FROM w_conv")(_conv)
query("pricing_dws_price_strength_agg", "product_id:i price_strength_star:i is_price_warn:i is_product_warn:i", "SELECT * FROM w_strength")(_strength)
query("pricing_ads_product_ranking", "product_id:i product_name:s category_id:i sales_rank:i quantity_rank:i stat_period:s", """
SELECT s.product_id, p.product_name, s.category_id, s.stat_period, row_number() OVER (ORDER BY total_sales DESC, total_quantity DESC, s.product_id) AS sales_rank, sales_rank AS quantity_rank FROM w_sales s JOIN w_product p USING (product_id)""")(
    lambda m: pr.product_ranking(_sales(m), pr.product_detail(m["product_info"])))
query("pricing_ads_traffic_source_top10", "source:s total_visitor:i pay_conversion_rate:s rank_num:i", f"""
SELECT source, total_visitor, {_RATE.format('r')} || '%' AS pay_conversion_rate, row_number() OVER (ORDER BY total_visitor DESC, source) AS rank_num FROM (
 SELECT source, sum(total_visitor) AS total_visitor, {ratio('sum(CAST(round(rate * 100) AS BIGINT))', 'count(rate) * 100', 2)} AS r FROM w_conv GROUP BY 1 ORDER BY total_visitor DESC, source LIMIT 10)""")(
    lambda m: pr.source_top10(_conv(m)))
query("pricing_ads_price_strength_warn", "product_id:i warn_type:s price_strength_star:i", """
SELECT product_id, '价格力预警' AS warn_type, price_strength_star FROM w_strength WHERE is_price_warn = 1 UNION ALL SELECT product_id, '商品力预警', price_strength_star FROM w_strength WHERE is_product_warn = 1""")(
    lambda m: pr.warnings(_strength(m)))

# ---- product 360 --------------------------------------------------------------------------
share("v_line_order", """
SELECT o.*, p.product_name, p.category_id, p.category_name, p.brand_id, p.brand_name FROM (
 SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_time DESC, product_id DESC, sku_id DESC, user_id DESC, shop_id DESC, quantity DESC, order_amount DESC, line_no DESC) AS rn FROM fact_order WHERE order_status = 'completed') o
LEFT JOIN product_info p USING (product_id) WHERE rn = 1""")
share("v_order", "SELECT o.*, p.product_name, p.category_id, p.category_name FROM event_order o LEFT JOIN product_info p USING (product_id) WHERE order_status = 'completed'")
share("v_traffic", "SELECT o.*, p.product_name, p.category_id, p.category_name FROM traffic_log o LEFT JOIN product_info p USING (product_id)")
share("v_price", """
SELECT o.*, p.product_name, p.category_id, p.category_name FROM (SELECT *, row_number() OVER (PARTITION BY product_id, change_time ORDER BY new_price DESC) AS rn FROM price_history WHERE old_price > 0 AND new_price > 0) o
LEFT JOIN product_info p USING (product_id) WHERE rn = 1""")
share("v_review", "SELECT o.*, p.product_name FROM review o LEFT JOIN product_info p USING (product_id) WHERE rating BETWEEN 1 AND 5")
share("v_day", f"""
SELECT s.*, coalesce(t.uv, 0) AS uv, coalesce(t.pv, 0) AS pv, coalesce({ratio('buyers', 't.uv', 4)}, 0) AS conversion_rate FROM (
 SELECT dt, product_id, product_name, category_id, category_name, sum(quantity) AS sales_qty, sum(order_amount) AS gmv, count(DISTINCT user_id) AS buyers FROM v_order GROUP BY ALL) s
LEFT JOIN (SELECT dt, product_id, count(DISTINCT user_id) AS uv, count(*) AS pv FROM v_traffic GROUP BY 1, 2) t USING (dt, product_id)""")
share("v_price_day", f"SELECT dt, product_id, product_name, category_id, category_name, {ratio('sum(new_price) * 100', 'count(*) * 100', 2)} AS avg_price, min(new_price) AS min_price, max(new_price) AS max_price FROM v_price GROUP BY ALL")
share("v_channel_day", f"""
SELECT t.dt, t.product_id, t.product_name, t.category_id, t.category_name, t.channel, count(DISTINCT t.user_id) AS uv, count(*) AS pv, {ratio('count(DISTINCT CASE WHEN o.user_id IS NOT NULL THEN t.user_id END)', 'count(DISTINCT t.user_id)', 4)} AS channel_conv_rate
FROM v_traffic t LEFT JOIN (SELECT DISTINCT dt, product_id, user_id FROM v_order) o ON t.dt = o.dt AND t.product_id = o.product_id AND t.user_id = o.user_id GROUP BY ALL""")
share("v_review_day", f"""
SELECT dt, product_id, product_name, count(*) AS total_reviews, count(*) FILTER (WHERE rating >= 4) AS positive_reviews, count(*) FILTER (WHERE rating <= 2) AS negative_reviews, {ratio('sum(rating)', 'count(*)', 2)} AS avg_rating,
  {ratio('count(*) FILTER (WHERE rating >= 4)', 'count(*)', 4)} AS positive_rate FROM v_review GROUP BY ALL""")
share("v_sku_day", "SELECT dt, product_id, sku_id, sum(quantity) AS sales_qty, sum(order_amount) AS gmv FROM v_line_order GROUP BY 1, 2, 3")
share("v_user", "SELECT * FROM user_profile WHERE age BETWEEN 18 AND 100")
_AGE = "CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' ELSE '55+' END"


class View:
    def __init__(self, m):
        p = m["product_info"]
        self.line_order = p360.fact_order(m["fact_order"], p)
        self.order = p360.fact_order(m["event_order"], p)
        self.traffic = p360.fact_traffic(m["traffic_log"], p)
        self.price = p360.fact_price(m["price_history"], p)
        self.prices = p360.valid_prices(m["price_history"])
        self.review = p360.fact_review(m["review"], p)
        self.user = p360.dim_user(m["user_profile"])


_OC = "order_id:i product_id:i product_name:s category_id:i category_name:s brand_id:i brand_name:s sku_id:i user_id:i order_time:t quantity:i order_amount:d dt:s"
query("product360_dwd_fact_order", _OC, "SELECT * FROM v_line_order")(lambda m: View(m).line_order)
query("product360_dwd_fact_traffic", f"log_id:i user_id:i product_id:i {_NC} channel:s visit_time:t dt:s", "SELECT * FROM v_traffic")(lambda m: View(m).traffic)
query("product360_dwd_fact_price", f"product_id:i {_NC} change_time:t old_price:d new_price:d dt:s", "SELECT * FROM v_price")(lambda m: View(m).price)
query("product360_dwd_fact_review", "review_id:i product_id:i product_name:s sku_id:i user_id:i rating:i review_time:t dt:s", "SELECT * FROM v_review")(lambda m: View(m).review)
query("product360_dwd_dim_user", "user_id:i gender:s age:i location:s member_level:s", "SELECT * FROM v_user")(lambda m: View(m).user)
query("product360_dwd_dim_product", "product_id:i product_name:s category_id:i category_name:s brand_id:i brand_name:s", "SELECT * FROM product_info")(lambda m: p360.dim_product(m["product_info"]))
_DC = f"dt:s product_id:i {_NC} sales_qty:i gmv:d uv:i pv:i conversion_rate:d"
query("product360_dws_product_day", _DC, "SELECT * FROM v_day")(lambda m: p360.product_day(View(m).order, View(m).traffic))
query("product360_dws_sku_attr", "dt:s product_id:i sku_id:i sales_qty:i gmv:d", "SELECT * FROM v_sku_day")(lambda m: p360.sku_day(View(m).line_order))
query("product360_dws_price", f"dt:s product_id:i {_NC} avg_price:d min_price:d max_price:d", "SELECT * FROM v_price_day")(lambda m: p360.named_price_day(View(m).prices, m["product_info"]))
query("product360_dws_channel", f"dt:s product_id:i {_NC} channel:s uv:i pv:i channel_conv_rate:d", "SELECT * FROM v_channel_day")(lambda m: p360.channel_day(View(m).traffic, View(m).order))
_RC = "total_reviews:i positive_reviews:i negative_reviews:i avg_rating:d positive_rate:d"
query("product360_dws_review", f"dt:s product_id:i product_name:s {_RC}", "SELECT * FROM v_review_day")(lambda m: p360.review_day(View(m).review))
query("product360_dws_audience", "dt:s product_id:i product_name:s gender:s age_group:s location:s uv:i", f"""
SELECT dt, product_id, product_name, gender, {_AGE} AS age_group, location, count(DISTINCT o.user_id) AS uv FROM v_order o LEFT JOIN v_user u USING (user_id) GROUP BY ALL""")(lambda m: p360.audience_day(View(m).order, View(m).user))
query("product360_ads_channel_analysis", "dt:s product_id:i channel:s uv:i pv:i channel_conv_rate:d", "SELECT dt, product_id, channel, uv, pv, channel_conv_rate FROM v_channel_day")(
    lambda m: p360.channel_report(p360.channel_day(View(m).traffic, View(m).order)))
query("product360_ads_review_analysis", f"dt:s product_id:i {_RC}", "SELECT dt, product_id, total_reviews, positive_reviews, negative_reviews, avg_rating, positive_rate FROM v_review_day")(
    lambda m: p360.review_report(p360.review_day(View(m).review)))
query("product360_ads_audience_profile", "dt:s product_id:i gender:s age_group:s location:s uv:i", f"""
SELECT dt, product_id, gender, age_group, location, uv FROM (SELECT dt, product_id, product_name, gender, {_AGE} AS age_group, location, count(DISTINCT o.user_id) AS uv
 FROM v_order o LEFT JOIN v_user u USING (user_id) GROUP BY ALL)""")(lambda m: p360.audience_report(p360.audience_day(View(m).order, View(m).user)))
query("product360_ads_sku_rank", "dt:s product_id:i sku_id:i sales_qty:i gmv:d rank:i", "SELECT *, rank() OVER (PARTITION BY dt, product_id ORDER BY sales_qty DESC) AS rank FROM v_sku_day")(
    lambda m: p360.sku_rank(p360.sku_day(View(m).line_order)))
query("product360_ads_price_trend", "dt:s product_id:i avg_price:d min_price:d max_price:d yoy_change:d mom_change:d", f"""
SELECT a.dt, a.product_id, a.avg_price, a.min_price, a.max_price, {signed_ratio('CAST(round(a.avg_price * 100) AS BIGINT) - CAST(round(b.avg_price * 100) AS BIGINT)', 'CAST(round(b.avg_price * 100) AS BIGINT)', 4)} AS yoy_change,
  {signed_ratio('CAST(round(a.avg_price * 100) AS BIGINT) - CAST(round(c.avg_price * 100) AS BIGINT)', 'CAST(round(c.avg_price * 100) AS BIGINT)', 4)} AS mom_change
FROM v_price_day a LEFT JOIN v_price_day b ON a.product_id = b.product_id AND a.dt - 365 = b.dt LEFT JOIN v_price_day c ON a.product_id = c.product_id AND a.dt - 1 = c.dt""")(
    lambda m: p360.price_trend(p360.price_day(View(m).prices)))
_W = ", ".join(f"coalesce(c.{n}_uv, 0) AS {n}_uv, coalesce(c.{n}_conv_rate, 0) AS {n}_conv_rate" for n in p360.CHANNELS)
_WP = ", ".join(f"max(CASE WHEN channel = '{v}' THEN uv ELSE 0 END) AS {k}_uv, max(CASE WHEN channel = '{v}' THEN channel_conv_rate ELSE 0 END) AS {k}_conv_rate" for k, v in p360.CHANNELS.items())


@query("product360_ads_product_360", _DC + " avg_price:d min_price:d max_price:d " + " ".join(f"{n}_uv:i {n}_conv_rate:d" for n in p360.CHANNELS) + f" {_RC}", f"""
SELECT d.*, p.avg_price, p.min_price, p.max_price, {_W}, r.total_reviews, r.positive_reviews, r.negative_reviews, r.avg_rating, r.positive_rate FROM v_day d LEFT JOIN v_price_day p USING (dt, product_id)
LEFT JOIN (SELECT dt, product_id, {_WP} FROM v_channel_day GROUP BY 1, 2) c USING (dt, product_id) LEFT JOIN v_review_day r USING (dt, product_id)""")
def _(m):
    v = View(m)
    return p360.wide_360(p360.product_day(v.order, v.traffic), p360.price_day(v.prices),
                         p360.channel_day(v.traffic, v.order), p360.review_day(v.review))


# ---- marketing ----------------------------------------------------------------------------
_CITY = "CASE WHEN city IN ('北京', '上海', '广州', '深圳') THEN 1 WHEN city IN ('杭州', '成都', '武汉', '南京') THEN 2 ELSE 3 END"
share("k_user", f"""
SELECT u.*, {_AGE} AS age_group, {_CITY} AS city_level, CAST(register_time AS DATE) AS register_date,
  CASE WHEN EXISTS (SELECT 1 FROM mk_behavior b WHERE b.user_id = u.user_id AND b.behavior_date >= {D} - 30) THEN 1 ELSE 0 END AS is_active FROM mk_user u""")
share("k_activity", f"""
SELECT activity_id, activity_name, activity_type, start_time, end_time, CASE WHEN status NOT IN (0, 1, 2) THEN CASE WHEN end_time < {D} THEN 2 WHEN start_time > {D} THEN 0 ELSE 1 END ELSE status END AS status, channel,
  CASE WHEN budget < 0 THEN 0 ELSE budget END AS budget, date_diff('day', CAST(start_time AS DATE), CAST(end_time AS DATE)) AS duration_days,
  CASE WHEN isodow(start_time) >= 6 OR isodow(end_time) >= 6 OR date_diff('day', CAST(start_time AS DATE), CAST(end_time AS DATE)) >= 7 THEN 1 ELSE 0 END AS is_weekend_included FROM mk_activity""")
share("k_behavior", """
SELECT b.behavior_id, b.user_id, b.activity_id, CASE WHEN behavior_type IN ('click', 'view', 'share', 'participate') THEN behavior_type ELSE 'other' END AS behavior_type, behavior_time, behavior_date, hour(behavior_time) AS behavior_hour,
  CASE WHEN isodow(behavior_time) >= 6 THEN 1 ELSE 0 END AS is_weekend, device, CASE WHEN device IN ('android', 'ios') THEN 'mobile' WHEN device IN ('pc', 'mac') THEN 'pc' ELSE 'other' END AS device_type,
  CASE WHEN city IN ('北京', '上海', '天津', '重庆') THEN city WHEN city IN ('广州', '深圳', '珠海') THEN '广东' WHEN city IN ('杭州', '宁波', '温州') THEN '浙江' WHEN city IN ('成都', '绵阳') THEN '四川' WHEN city IN ('武汉', '宜昌') THEN '湖北' ELSE '其他' END AS province
FROM mk_behavior b LEFT JOIN mk_user u ON b.user_id = u.user_id""")
share("k_effect", """
SELECT e.effect_id, e.activity_id, e.user_id, conversion_time, CAST(conversion_time AS DATE) AS conversion_date, conversion_type, CASE WHEN amount < 0 THEN 0 ELSE amount END AS amount,
  CASE WHEN date_diff('day', CAST(register_time AS DATE), CAST(conversion_time AS DATE)) <= 30 THEN 1 ELSE 0 END AS is_new_user,
  CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age >= 55 THEN '55+' END AS user_age_group
FROM mk_effect e LEFT JOIN mk_user u ON e.user_id = u.user_id""")


class Market:
    def __init__(self, m):
        self.m = m
        self.users = mk.user_detail(m["mk_user"], m["mk_behavior"], DAY)
        self.activity = mk.activity_detail(m["mk_activity"], DAY)
        self.behavior = mk.behaviour_detail(m["mk_behavior"], m["mk_user"])
        self.effect = mk.effect_detail(m["mk_effect"], m["mk_user"])

    @property
    def activity_effect(self):
        return mk.activity_effect(self.m["mk_activity"], self.m["mk_behavior"], self.m["mk_effect"])

    @property
    def channels(self):
        return mk.channel_effect(self.activity, self.behavior, self.effect)


query("marketing_dwd_user_detail", "user_id:i user_name:s gender:s age:i age_group:s city:s city_level:i register_time:t register_date:s channel:s is_active:i", "SELECT * FROM k_user")(lambda m: Market(m).users)
query("marketing_dwd_activity_detail", "activity_id:i activity_name:s activity_type:s start_time:t end_time:t status:i channel:s budget:d duration_days:i is_weekend_included:i", "SELECT * FROM k_activity")(lambda m: Market(m).activity)
query("marketing_dwd_behavior_detail", "behavior_id:i user_id:i activity_id:i behavior_type:s behavior_time:t behavior_date:s behavior_hour:i is_weekend:i device:s device_type:s province:s", "SELECT * FROM k_behavior")(lambda m: Market(m).behavior)
query("marketing_dwd_effect_detail", "effect_id:i activity_id:i user_id:i conversion_time:t conversion_date:s conversion_type:s amount:d is_new_user:i user_age_group:s", "SELECT * FROM k_effect")(lambda m: Market(m).effect)
share("k_act_day", f"""
SELECT a.activity_id, a.activity_name, b.behavior_date AS stat_date, coalesce(b.pv, 0) AS pv, coalesce(b.uv, 0) AS uv, coalesce(b.c, 0) AS click_count, coalesce(b.s, 0) AS share_count, coalesce(b.p, 0) AS participate_count,
  coalesce(e.n, 0) AS conversion_count, coalesce({ratio('e.n', 'b.n', 4)}, 0) AS conversion_rate, e.a AS total_amount, coalesce({signed_ratio('e.a * 100', 'e.n * 100', 2)}, 0) AS avg_amount
FROM mk_activity a LEFT JOIN (SELECT activity_id, behavior_date, count(*) AS n, count(*) FILTER (WHERE behavior_type = 'view') AS pv, count(DISTINCT CASE WHEN behavior_type = 'view' THEN user_id END) AS uv,
  count(*) FILTER (WHERE behavior_type = 'click') AS c, count(*) FILTER (WHERE behavior_type = 'share') AS s, count(*) FILTER (WHERE behavior_type = 'participate') AS p FROM mk_behavior GROUP BY 1, 2) b USING (activity_id)
LEFT JOIN (SELECT activity_id, CAST(conversion_time AS DATE) AS d, count(*) AS n, sum(amount) AS a FROM mk_effect GROUP BY 1, 2) e ON e.activity_id = a.activity_id AND e.d = b.behavior_date""")
query("marketing_dws_activity_effect", "activity_id:i stat_date:s activity_name:s pv:i uv:i click_count:i share_count:i participate_count:i conversion_count:i conversion_rate:d total_amount:d avg_amount:d", "SELECT * FROM k_act_day")(
    lambda m: Market(m).activity_effect)
query("marketing_dws_segment_activity", "age_group:s city_level:i stat_date:s total_uv:i participate_rate:d conversion_rate:d avg_amount:d", f"""
SELECT u.age_group, u.city_level, b.behavior_date AS stat_date, count(*) AS total_uv, {ratio('sum(j)', 'count(*)', 4)} AS participate_rate, coalesce({ratio('count(e.n)', 'sum(j)', 4)}, 0) AS conversion_rate,
  coalesce({ratio('sum(e.a) * 100', 'sum(e.n) * 100', 2)}, 0) AS avg_amount
FROM (SELECT user_id, behavior_date, max(CASE WHEN behavior_type = 'participate' THEN 1 ELSE 0 END) AS j FROM k_behavior GROUP BY 1, 2) b JOIN k_user u USING (user_id)
LEFT JOIN (SELECT user_id, conversion_date, count(*) AS n, sum(amount) AS a FROM k_effect GROUP BY 1, 2) e ON e.user_id = b.user_id AND e.conversion_date = b.behavior_date WHERE u.age_group IS NOT NULL GROUP BY 1, 2, 3""")(
    lambda m: (lambda k: mk.segment_activity(k.users, k.behavior, k.effect))(Market(m)))
share("k_channel", f"""
WITH inside AS (SELECT a.channel, a.activity_type, a.duration_days, b.behavior_date AS stat_date, a.activity_id, a.budget, b.user_id, b.behavior_type FROM k_behavior b JOIN k_activity a
  ON a.activity_id = b.activity_id AND b.behavior_date BETWEEN CAST(a.start_time AS DATE) AND CAST(a.end_time AS DATE)),
days AS (SELECT channel, activity_type, duration_days, stat_date, activity_id, budget, count(*) FILTER (WHERE behavior_type = 'view') AS v FROM inside GROUP BY ALL),
g AS (SELECT d.channel, d.activity_type, d.duration_days, d.stat_date, sum(v) AS pv, sum(budget) AS b, coalesce(sum(e.n), 0) AS conversion_count, sum(e.a) AS total_amount FROM days d
  LEFT JOIN (SELECT activity_id, conversion_date, count(*) AS n, sum(amount) AS a FROM k_effect GROUP BY 1, 2) e ON e.activity_id = d.activity_id AND e.conversion_date = d.stat_date GROUP BY ALL),
u AS (SELECT channel, activity_type, duration_days, stat_date, count(DISTINCT user_id) AS uv FROM inside GROUP BY ALL),
c AS (SELECT g.*, u.uv, {ratio('b * 100', 'duration_days * 100', 2)} AS cost FROM g JOIN u USING (channel, activity_type, duration_days, stat_date))
SELECT *, CASE WHEN cost = 0 THEN 0 ELSE {signed_ratio('CAST(total_amount * 100 AS BIGINT) - CAST(round(cost * 100) AS BIGINT)', 'CAST(round(cost * 100) AS BIGINT)', 4)} END AS roi FROM c""")
query("marketing_dws_channel_effect", "channel:s activity_type:s duration_days:i stat_date:s pv:i uv:i cost:d conversion_count:i total_amount:d roi:d", "SELECT * FROM k_channel")(lambda m: Market(m).channels)
query("marketing_ads_analysis", "stat_date:s channel:s activity_type:s total_pv:i total_uv:i total_conversion_count:i total_conversion_rate:d total_amount:d avg_conversion_amount:d roi:d", f"""
SELECT stat_date, channel, activity_type, sum(pv) AS total_pv, sum(uv) AS total_uv, sum(conversion_count) AS total_conversion_count, coalesce({ratio('sum(conversion_count)', 'sum(pv)', 4)}, 0) AS total_conversion_rate,
  sum(total_amount) AS total_amount, CASE WHEN sum(conversion_count) = 0 THEN 0 ELSE {ratio('sum(total_amount) * 100', 'sum(conversion_count) * 100', 2)} END AS avg_conversion_amount,
  {signed_ratio('sum(CAST(round(roi * 10000) AS BIGINT))', 'count(roi) * 10000', 4)} AS roi FROM k_channel GROUP BY 1, 2, 3""")(lambda m: mk.marketing_analysis(Market(m).channels))
query("marketing_ads_activity_ranking", "stat_date:s activity_id:i activity_name:s conversion_rate_rank:i roi_rank:i total_amount_rank:i comprehensive_score:d", f"""
SELECT *, {ratio('40 * (n - conversion_rate_rank) + 30 * (n - roi_rank) + 30 * (n - total_amount_rank)', 'n', 2)} AS comprehensive_score FROM (
 SELECT s.stat_date, s.activity_id, s.activity_name, row_number() OVER (PARTITION BY s.stat_date ORDER BY s.conversion_rate DESC, s.activity_id) AS conversion_rate_rank,
  row_number() OVER (PARTITION BY s.stat_date ORDER BY c.roi DESC NULLS LAST, s.activity_id) AS roi_rank, row_number() OVER (PARTITION BY s.stat_date ORDER BY s.total_amount DESC NULLS LAST, s.activity_id) AS total_amount_rank,
  count(*) OVER (PARTITION BY s.stat_date) AS n
 FROM k_act_day s LEFT JOIN k_activity a USING (activity_id) LEFT JOIN (SELECT activity_type, channel, stat_date, {signed_ratio('sum(CAST(round(roi * 10000) AS BIGINT))', 'count(roi) * 10000', 6)} AS roi FROM k_channel GROUP BY 1, 2, 3) c
 ON a.activity_type = c.activity_type AND a.channel = c.channel AND s.stat_date = c.stat_date WHERE s.stat_date IS NOT NULL)""")(
    lambda m: (lambda k: mk.activity_ranking(k.activity_effect, k.activity, k.channels))(Market(m)))
query("marketing_ads_segment_value", "age_group:s city_level:i user_count:i avg_purchase_count:d avg_purchase_amount:d total_purchase_amount:d last_30d_active_rate:d user_value_score:f user_value_score_asc:f", f"""
SELECT *, 100 * s AS user_value_score, 100 * (1 - s) AS user_value_score_asc FROM (
 SELECT *, 0.4::DOUBLE * percent_rank() OVER (ORDER BY total_purchase_amount DESC NULLS LAST) + 0.3::DOUBLE * percent_rank() OVER (ORDER BY n DESC) + 0.3::DOUBLE * percent_rank() OVER (ORDER BY mean_amount DESC NULLS LAST) AS s FROM (
  SELECT age_group, city_level, count(*) AS user_count, coalesce(sum(e.n), 0) AS n, sum(e.a) AS total_purchase_amount, {ratio('coalesce(sum(e.n), 0)', 'count(*)', 2)} AS avg_purchase_count,
   {ratio('sum(e.a) * 100', 'count(*) * 100', 2)} AS avg_purchase_amount, {ratio('sum(is_active)', 'count(*)', 4)} AS last_30d_active_rate, {ratio('sum(e.a) * 100', 'sum(e.n) * 100', 6)} AS mean_amount
  FROM k_user u LEFT JOIN (SELECT user_id, count(*) AS n, sum(amount) AS a FROM k_effect GROUP BY 1) e USING (user_id) WHERE age_group IS NOT NULL GROUP BY 1, 2))""")(
    lambda m: (lambda k: mk.segment_value(k.users, k.behavior, k.effect, DAY))(Market(m)))

# ---- related products ---------------------------------------------------------------------
share("r_stats", f"""
SELECT main_product_id, related_product_id, dt AS stat_date, count(*) FILTER (WHERE behavior_type = 1) AS same_visit_count, count(*) FILTER (WHERE behavior_type = 2) AS same_favor_count, count(*) FILTER (WHERE behavior_type = 3) AS same_cart_count,
  count(*) FILTER (WHERE behavior_type = 4) AS same_pay_count, count(*) FILTER (WHERE behavior_type = 1 AND is_guide_from_detail = 1) AS guide_visit_count,
  sum(CASE behavior_type WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 5 ELSE 0 END) AS total_relation_score
FROM related_behavior WHERE related_product_id IS NOT NULL AND dt = {P} GROUP BY 1, 2, 3""")
share("r_both", f"""
SELECT main_product_id AS m, related_product_id AS r, user_id, behavior_type, behavior_time, 1 AS is_main FROM related_behavior WHERE related_product_id IS NOT NULL AND dt = {P}
UNION ALL SELECT related_product_id, main_product_id, user_id, behavior_type, behavior_time, 0 FROM related_behavior WHERE related_product_id IS NOT NULL AND dt = {P}""")


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE {ratio(f'{a} * 100', b, 2)} END"


share("r_seq", f"""
SELECT t.m AS main_product_id, {P} AS stat_date, {_pct('a.v', 't.v')} AS visit_to_visit_rate, {_pct('a.f', 't.v')} AS visit_to_favor_rate, {_pct('a.c', 't.v')} AS visit_to_cart_rate, {_pct('a.p', 't.c')} AS cart_to_pay_rate,
  {signed_ratio('a.g', 'a.gn', 4)} AS avg_behavior_interval
FROM (SELECT main_product_id AS m, count(*) FILTER (WHERE behavior_type = 1) AS v, count(*) FILTER (WHERE behavior_type = 3) AS c FROM related_behavior WHERE dt = {P} GROUP BY 1) t
LEFT JOIN (SELECT m, sum(v) AS v, sum(f) AS f, sum(c) AS c, sum(p) AS p, sum(gap) AS g, count(gap) AS gn FROM (
  SELECT m, r, user_id, count(*) FILTER (WHERE behavior_type = 1) AS v, count(*) FILTER (WHERE behavior_type = 2) AS f, count(*) FILTER (WHERE behavior_type = 3) AS c, count(*) FILTER (WHERE behavior_type = 4) AS p,
   date_sub('minute', max(behavior_time) FILTER (WHERE is_main = 1), max(behavior_time) FILTER (WHERE is_main = 0)) AS gap FROM r_both GROUP BY 1, 2, 3) GROUP BY 1) a USING (m)""")
share("r_top", "SELECT main_product_id, sum(guide_visit_count) AS total_guide FROM r_stats GROUP BY 1 ORDER BY total_guide DESC, main_product_id LIMIT 10")


def _stats(m):
    return rl.relation_stats(m["related_behavior"], PREV)


query("related_dwd_behavior_detail", "user_id:i main_product_id:i main_product_name:s related_product_id:i related_product_name:s behavior_type:i behavior_time:t is_guide_from_detail:i dt:s", f"""
SELECT b.*, p.product_name AS main_product_name, q.product_name AS related_product_name FROM related_behavior b LEFT JOIN product_info p ON b.main_product_id = p.product_id LEFT JOIN product_info q ON b.related_product_id = q.product_id
WHERE dt >= {D} - 7 AND main_product_id IS NOT NULL""")(lambda m: rl.behaviour_detail(m["related_behavior"], m["product_info"], DAY))
query("related_dws_relation_stats", "main_product_id:i related_product_id:i same_visit_count:i same_favor_count:i same_cart_count:i same_pay_count:i guide_visit_count:i total_relation_score:i stat_date:s", "SELECT * FROM r_stats")(_stats)
query("related_dws_behavior_sequence", "main_product_id:i stat_date:s visit_to_visit_rate:d visit_to_favor_rate:d visit_to_cart_rate:d cart_to_pay_rate:d avg_behavior_interval:d", "SELECT * FROM r_seq")(
    lambda m: rl.sequence_stats(m["related_behavior"], PREV))
query("related_ads_top_guide_product", "rank:i main_product_id:i main_product_name:s related_product_id:i related_product_name:s guide_visit_count:i conversion_rate:d stat_date:s", f"""
SELECT s.*, p.product_name AS main_product_name, q.product_name AS related_product_name, {_pct('same_pay_count', 'same_visit_count')} AS conversion_rate,
  row_number() OVER (ORDER BY total_guide DESC, guide_visit_count DESC, main_product_id, related_product_id) AS rank
FROM r_top t JOIN r_stats s USING (main_product_id) LEFT JOIN product_info p ON main_product_id = p.product_id LEFT JOIN product_info q ON related_product_id = q.product_id""")(lambda m: rl.top_guides(_stats(m), m["product_info"]))
query("related_ads_monitor_relation", "monitor_product_id:i monitor_product_name:s related_product_id:i related_product_name:s guide_visit_count:i conversion_count:i stat_date:s", """
SELECT main_product_id AS monitor_product_id, p.product_name AS monitor_product_name, related_product_id, q.product_name AS related_product_name, guide_visit_count, same_pay_count AS conversion_count, stat_date
FROM r_top t JOIN r_stats s USING (main_product_id) LEFT JOIN product_info p ON main_product_id = p.product_id LEFT JOIN product_info q ON related_product_id = q.product_id WHERE p.is_valid = 1""")(
    lambda m: rl.monitored(_stats(m), m["product_info"]))
query("related_ads_sequence_analysis", "rank:i main_product_id:i main_product_name:s visit_to_cart_rate:d cart_to_pay_rate:d avg_behavior_interval:d stat_date:s", """
SELECT s.*, p.product_name AS main_product_name, row_number() OVER (ORDER BY visit_to_cart_rate DESC, main_product_id) AS rank FROM r_top t JOIN r_seq s USING (main_product_id) LEFT JOIN product_info p ON main_product_id = p.product_id""")(
    lambda m: rl.sequence_ranking(rl.sequence_stats(m["related_behavior"], PREV), _stats(m), m["product_info"]))

# ---- new products -------------------------------------------------------------------------
share("n_sales", "SELECT product_id, sales_date, sum(sales_amount) AS total_sales, sum(sales_count) AS total_sales_count, count(DISTINCT order_id) AS total_orders, max(update_time) AS last_update_time FROM product_sales GROUP BY 1, 2")
share("n_sum", "SELECT product_id, sum(total_sales) AS total_sales, sum(total_sales_count) AS total_sales_count, sum(total_orders) AS total_orders, max(last_update_time) AS last_update_time, min(sales_date) AS first_sale_date, max(sales_date) AS last_sale_date FROM n_sales GROUP BY 1")
share("n_info", """
SELECT p.*, CASE WHEN total_sales > 1000 THEN 'High' WHEN total_sales BETWEEN 500 AND 1000 THEN 'Medium' ELSE 'Low' END AS sales_category, coalesce(s.total_sales, 0) AS total_sales, coalesce(s.total_sales_count, 0) AS total_sales_count,
  coalesce(s.first_sale_date, release_date) AS first_sale_date, coalesce(s.last_sale_date, release_date) AS last_sale_date FROM product_info p LEFT JOIN n_sum s USING (product_id)""")
share("n_stock", "SELECT product_id, sum(stock_count) AS total_stock, CASE WHEN sum(stock_count) > 0 THEN 'available' ELSE 'out_of_stock' END AS stock_status, max(update_time) AS last_update_time FROM product_stock GROUP BY 1")
_NI = "product_id:i product_name:s product_image:s product_sku:s category_name:s release_date:s"


def _nsum(m):
    return npd.sales_summary(npd.sales_detail(m["product_sales"]))


def _ninfo(m):
    return npd.info_summary(npd.info_detail(m["product_info"]), _nsum(m))


def _nbehavior(m):
    return npd.behaviour_detail(m["mk_behavior"].select("user_id", F.col("activity_id").alias("product_id"), "behavior_type", F.col("behavior_time").alias("action_time")))


query("new_products_dwd_info", _NI, "SELECT DISTINCT product_id, product_name, product_image, product_sku, category_name, release_date FROM product_info")(lambda m: npd.info_detail(m["product_info"]))
query("new_products_dwd_sales", "product_id:i sales_date:s total_sales:d total_sales_count:i total_orders:i last_update_time:t", "SELECT * FROM n_sales")(lambda m: npd.sales_detail(m["product_sales"]))
query("new_products_dws_monitoring", "product_id:i product_name:s total_sales:d total_sales_count:i first_sale_date:s last_sale_date:s last_update_time:t", """
SELECT s.*, p.product_name FROM n_sum s LEFT JOIN product_info p USING (product_id)""")(lambda m: npd.monitoring_detail(m["product_sales"], m["product_info"]))
query("new_products_dws_behavior", "user_id:i product_id:i behavior_type:s total_behavior_count:i first_action_time:t last_action_time:t", """
SELECT user_id, activity_id AS product_id, behavior_type, count(*) AS total_behavior_count, min(behavior_time) AS first_action_time, max(behavior_time) AS last_action_time FROM mk_behavior GROUP BY 1, 2, 3""")(_nbehavior)
query("new_products_dws_inventory", "product_id:i total_stock:i stock_status:s last_update_time:t", "SELECT * FROM n_stock")(lambda m: npd.stock_detail(m["product_stock"]))
query("new_products_dws_sales", "product_id:i total_sales:d total_sales_count:i total_orders:i last_update_time:t", "SELECT * FROM n_sum")(_nsum)
query("new_products_dws_info", f"{_NI} sales_category:s total_sales:d total_sales_count:i first_sale_date:s last_sale_date:s", "SELECT * FROM n_info")(_ninfo)
query("new_products_ads_info", f"{_NI} sales_category:s total_sales:d total_sales_count:i first_sale_date:s last_sale_date:s stock_status:s", "SELECT n.*, k.stock_status FROM n_info n LEFT JOIN n_stock k USING (product_id)")(
    lambda m: npd.info_report(_ninfo(m), npd.stock_detail(m["product_stock"])))
query("new_products_ads_sales", "product_id:i total_sales:d total_sales_count:i total_orders:i sales_trend:s", "SELECT *, 'Stable' AS sales_trend FROM n_sum")(lambda m: npd.sales_report(_nsum(m)))
query("new_products_ads_user_behavior", "user_id:i product_id:i total_behavior_count:i first_action_time:t last_action_time:t behavior_type:s", """
SELECT user_id, activity_id AS product_id, count(*) AS total_behavior_count, min(behavior_time) AS first_action_time, max(behavior_time) AS last_action_time, behavior_type FROM mk_behavior GROUP BY 1, 2, behavior_type""")(
    lambda m: npd.behaviour_report(_nbehavior(m)))
query("new_products_ads_inventory", "product_id:i total_stock:i stock_status:s", "SELECT product_id, total_stock, stock_status FROM n_stock")(
    lambda m: npd.stock_report(npd.stock_detail(m["product_stock"])))
