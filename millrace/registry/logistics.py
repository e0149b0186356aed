"""Logistics warehouse queries."""

from __future__ import annotations

import datetime as dt

from millrace.plans import logistics_ads as ads, logistics_dim as dim, logistics_dwd as dwd, logistics_dws as dws
from millrace.registry.base import query, ratio, share

DAY = dt.date(2001, 7, 31)
D = f"DATE '{DAY}'"


class Layer:
    def __init__(self, m):
        self.m = m

    @property
    def shift(self):
        return dim.dim_shift(self.m["line_base_shift"], self.m["line_base_info"], self.m["lg_dic"])

    @property
    def truck(self):
        m = self.m
        return dim.dim_truck(m["truck_info"], m["truck_team"], m["truck_model"], m["base_organ"], m["lg_dic"])

    def stage(self, name):
        return dwd.waybill_stage(self.m["order_cargo"], self.m["lg_order_info"], self.m["lg_dic"], name)

    def rows(self, name):
        return dwd.stage_rows(self.m["order_cargo"], self.m["lg_order_info"], name)

    @property
    def finished(self):
        return dwd.trans_finish(self.m["transport_task"], self.shift)

    @property
    def cargo_1d(self):
        return dws.org_cargo_type_order_1d(self.rows("order"), self.m["base_organ"], self.m["base_region_info"], self.m["lg_dic"])

    @property
    def receive_1d(self):
        return dws.org_receive_1d(self.rows("receive"), self.m["base_organ"], self.m["base_region_info"])

    @property
    def dispatch_1d(self):
        return dws.dispatch_1d(self.rows("dispatch"))

    @property
    def truck_1d(self):
        return dws.org_truck_type_1d(self.finished, self.truck)

    @property
    def deliver_1d(self):
        return dws.org_deliver_1d(self.rows("deliver_suc"), self.m["base_organ"], self.m["base_region_info"])

    @property
    def sort_1d(self):
        return dws.org_sort_1d(dwd.bound_events(self.m["order_org_bound"], "sort"), self.m["base_organ"], self.m["base_region_info"])

    @property
    def cargo_nd(self):
        return dws.org_cargo_type_order_nd(self.cargo_1d, DAY)

    @property
    def receive_nd(self):
        return dws.org_receive_nd(self.receive_1d, DAY)

    @property
    def dispatch_nd(self):
        return dws.dispatch_nd(self.dispatch_1d, DAY)

    @property
    def deliver_nd(self):
        return dws.org_deliver_nd(self.deliver_1d, DAY)

    @property
    def sort_nd(self):
        return dws.org_sort_nd(self.sort_1d, DAY)

    @property
    def shift_nd(self):
        return dws.shift_finish_nd(self.finished, self.m["base_organ"], self.m["base_region_info"], self.shift, self.truck, DAY)


# ---- dimensions ---------------------------------------------------------------------------
share("y_shift", """
SELECT s.*, l.name AS line_name, l.line_no, l.line_level, l.org_id, l.transport_line_type_id, d.name AS transport_line_type_name, l.start_org_id, l.end_org_id, l.distance, l.estimated_time
FROM line_base_shift s JOIN line_base_info l ON s.line_id = l.id JOIN lg_dic d ON l.transport_line_type_id = d.id""")
share("y_truck", """
SELECT t.id, t.team_id, tt.name AS team_name, tt.team_no, tt.org_id, o.org_name, md5(t.truck_no) AS truck_no, m.model_name AS truck_model_name, m.model_type AS truck_model_type, a.name AS truck_model_type_name,
  m.brand AS truck_brand, b.name AS truck_brand_name, m.load_weight
FROM truck_info t JOIN truck_team tt ON t.team_id = tt.id JOIN truck_model m ON t.truck_model_id = m.id JOIN base_organ o ON tt.org_id = o.id JOIN lg_dic a ON m.model_type = a.id JOIN lg_dic b ON m.brand = b.id""")


@query("logistics_dim_complex", "id:i complex_name:s courier_emp_ids:s province_id:i province_name:s city_id:i city_name:s district_id:i district_name:s", """
SELECT c.*, p.name AS province_name, t.name AS city_name, e.courier_emp_ids FROM base_complex c JOIN base_region_info p ON c.province_id = p.id JOIN base_region_info t ON c.city_id = t.id
LEFT JOIN (SELECT complex_id, string_agg(DISTINCT CAST(courier_emp_id AS VARCHAR), ',' ORDER BY CAST(courier_emp_id AS VARCHAR)) AS courier_emp_ids FROM express_courier_complex GROUP BY 1) e ON e.complex_id = c.id""")
def _(m):
    from pyspark.sql import functions as F

    out = dim.dim_complex(m["base_complex"], m["base_region_info"], m["express_courier_complex"])
    return out.withColumn("courier_emp_ids", F.array_join("courier_emp_ids", ","))


@query("logistics_dim_organ", "id:i org_name:s org_level:i region_id:i region_name:s region_code:s org_parent_id:i org_parent_name:s", """
SELECT o.*, r.name AS region_name, r.dict_code AS region_code, p.org_name AS org_parent_name FROM base_organ o LEFT JOIN base_region_info r ON o.region_id = r.id LEFT JOIN base_organ p ON o.org_parent_id = p.id""")
def _(m):
    return dim.dim_organ(m["base_organ"], m["base_region_info"])


@query("logistics_dim_region", "id:i parent_id:i name:s dict_code:s short_name:s", "SELECT * FROM base_region_info")
def _(m):
    return dim.dim_region(m["base_region_info"])


@query("logistics_dim_express_courier", "id:i emp_id:i org_id:i org_name:s working_phone:s express_type:s express_type_name:s", """
SELECT c.id, c.emp_id, c.org_id, o.org_name, md5(c.working_phone) AS working_phone, c.express_type, d.name AS express_type_name FROM express_courier c JOIN base_organ o ON c.org_id = o.id JOIN lg_dic d ON c.express_type = d.id""")
def _(m):
    return dim.dim_express_courier(m["express_courier"], m["base_organ"], m["lg_dic"])


@query("logistics_dim_shift", "id:i line_id:i line_name:s line_no:s line_level:i org_id:i transport_line_type_id:s transport_line_type_name:s start_org_id:i end_org_id:i distance:d estimated_time:i start_time:s", "SELECT * FROM y_shift")
def _(m):
    return Layer(m).shift


@query("logistics_dim_truck_driver", "id:i emp_id:i org_id:i org_name:s team_id:i team_name:s license_type:s is_enabled:i", """
SELECT d.*, o.org_name, t.name AS team_name FROM truck_driver d JOIN base_organ o ON d.org_id = o.id JOIN truck_team t ON d.team_id = t.id""")
def _(m):
    return dim.dim_truck_driver(m["truck_driver"], m["base_organ"], m["truck_team"])


@query("logistics_dim_truck", "id:i team_id:i team_name:s team_no:s org_id:i org_name:s truck_no:s truck_model_name:s truck_model_type:s truck_model_type_name:s truck_brand:s truck_brand_name:s load_weight:i", "SELECT * FROM y_truck")
def _(m):
    return Layer(m).truck


_PHONE = r"'^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$'"
_MAIL = r"'^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$'"


@query("logistics_dim_user_zip", "id:i login_name:s passwd:s real_name:s phone_num:s email:s user_level:s birthday:s gender:s start_date:s end_date:s", f"""
SELECT id, login_name, md5(passwd) AS passwd, md5(name) AS real_name, CASE WHEN regexp_matches(phone_num, {_PHONE}) THEN md5(phone_num) END AS phone_num,
  CASE WHEN regexp_matches(email, {_MAIL}) THEN md5(email) END AS email, user_level, DATE '1970-01-01' + CAST(birthday AS INT) AS birthday, gender, CAST(create_time AS DATE) AS start_date, DATE '9999-12-31' AS end_date FROM user_info""")
def _(m):
    return dim.dim_user_zip(m["user_info"])


@query("logistics_dim_user_address_zip", "id:i user_id:i phone:s province_id:i city_id:i is_default:i start_date:s end_date:s", f"""
SELECT id, user_id, CASE WHEN regexp_matches(phone, {_PHONE}) THEN md5(phone) END AS phone, province_id, city_id, is_default, substr(create_time, 1, 10) || ' ' || substr(create_time, 12, 8) AS start_date, DATE '9999-12-31' AS end_date FROM user_address""")
def _(m):
    return dim.dim_user_address_zip(m["user_address"])


# ---- detail facts -------------------------------------------------------------------------
share("y_cargo", """
SELECT c.id, c.order_id, c.cargo_type, d.name AS cargo_type_name, c.volume_length, c.volume_width, c.volume_height, c.weight, substr(c.create_time, 1, 10) || ' ' || substr(c.create_time, 12, 8) AS order_time,
  o.order_no, o.status, s.name AS status_name, o.collect_type, t.name AS collect_type_name, o.payment_type, p.name AS payment_type_name, o.user_id, o.receiver_city_id, o.receiver_district_id,
  substr(o.receiver_name, 1, 1) || '*' AS receiver_name, o.sender_city_id, o.sender_district_id, substr(o.sender_name, 1, 1) || '*' AS sender_name, o.cargo_num, o.amount,
  strftime(make_timestamp(o.estimate_arrive_time * 1000), '%Y-%m-%d %H:%M:%S') AS estimate_arrive_time, o.distance, o.update_date, CAST(substr(c.create_time, 1, 10) AS DATE) AS dt
FROM order_cargo c LEFT JOIN lg_order_info o ON c.order_id = o.id LEFT JOIN lg_dic d ON c.cargo_type = d.id LEFT JOIN lg_dic s ON o.status = s.id LEFT JOIN lg_dic t ON o.collect_type = t.id
LEFT JOIN lg_dic p ON o.payment_type = p.id WHERE c.is_deleted = '0'""")
_FACT = ("id:s order_id:i cargo_type:s cargo_type_name:s volume_length:i weight:d order_time:s order_no:s status:s status_name:s collect_type:s collect_type_name:s user_id:i receiver_city_id:i "
         "receiver_district_id:i receiver_name:s sender_city_id:i sender_district_id:i sender_name:s cargo_num:i amount:d estimate_arrive_time:s distance:d dt:s")
_COND = {
    "order": "true", "pay_suc": "status NOT IN ('60010', '60999')", "cancel": "status = '60999'",
    "receive": "status NOT IN ('60010', '60020', '60999')",
    "dispatch": "status NOT IN ('60010', '60020', '60030', '60040', '60999')",
    "bound_finish": "status IN ('60060', '60070', '60080')", "deliver_suc": "status IN ('60070', '60080')", "sign": "status = '60080'",
}
_NAMES = {"order": "trade_order_detail", "pay_suc": "trade_pay_suc_detail", "cancel": "trade_order_cancel_detail", "receive": "trans_receive_detail",
          "dispatch": "trans_dispatch_detail", "bound_finish": "trans_bound_finish_detail", "deliver_suc": "trans_deliver_suc_detail", "sign": "trans_sign_detail"}
for _stage, _cond in _COND.items():
    query(f"logistics_dwd_{_NAMES[_stage]}", _FACT, f"SELECT * FROM y_cargo WHERE {_cond}")(lambda m, s=_stage: Layer(m).stage(s))


@query("logistics_dwd_trade_order_process", "id:s order_id:i status:s status_name:s payment_type_name:s amount:d start_date:s end_date:s dt:s", """
SELECT * EXCLUDE (dt), dt AS start_date, CASE WHEN status IN ('60080', '60999') THEN update_date ELSE DATE '9999-12-31' END AS end_date, end_date AS dt FROM y_cargo""")
def _(m):
    return dwd.order_process(m["order_cargo"], m["lg_order_info"], m["lg_dic"])


share("y_finish", """
SELECT t.id, t.shift_id, t.line_id, t.start_org_id, t.start_org_name, t.end_org_id, t.end_org_name, t.order_num, t.driver1_emp_id, substr(driver1_name, 1, 1) || '*' AS driver1_name, t.driver2_emp_id,
  substr(driver2_name, 1, 1) || '*' AS driver2_name, t.truck_id, md5(t.truck_no) AS truck_no, strftime(make_timestamp(actual_start_time * 1000), '%Y-%m-%d %H:%M:%S') AS actual_start_time,
  strftime(make_timestamp(actual_end_time * 1000), '%Y-%m-%d %H:%M:%S') AS actual_end_time, strftime(make_timestamp((t.actual_start_time + s.estimated_time * 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS estimate_end_time,
  actual_distance, (t.actual_end_time - t.actual_start_time) // 1000 AS finish_dur_sec, CASE WHEN t.actual_end_time > t.actual_start_time + s.estimated_time * 1000 THEN 1 ELSE 0 END AS is_late,
  CAST(make_timestamp(t.actual_end_time * 1000) AS DATE) AS dt
FROM transport_task t LEFT JOIN y_shift s ON t.shift_id = s.id WHERE t.is_deleted = '0' AND t.actual_end_time IS NOT NULL""")


@query("logistics_dwd_trans_trans_finish", "id:i shift_id:i line_id:i start_org_id:i start_org_name:s end_org_id:i order_num:i driver1_emp_id:i driver1_name:s driver2_emp_id:i driver2_name:s truck_id:i truck_no:s "
       "actual_start_time:s actual_end_time:s estimate_end_time:s actual_distance:d finish_dur_sec:i is_late:i dt:s", "SELECT * FROM y_finish")
def _(m):
    return Layer(m).finished


for _kind, _emp in (("inbound", "inbound_emp_id"), ("sort", "sorter_emp_id"), ("outbound", "outbound_emp_id")):
    query(f"logistics_dwd_bound_{_kind}", f"id:s order_id:i org_id:i {_kind}_time:s {_emp}:i dt:s", f"""
SELECT id, order_id, org_id, strftime(make_timestamp({_kind}_time * 1000), '%Y-%m-%d %H:%M:%S') AS {_kind}_time, {_emp}, CAST(make_timestamp(order_org_bound.{_kind}_time * 1000) AS DATE) AS dt
FROM order_org_bound WHERE order_org_bound.{_kind}_time IS NOT NULL""")(lambda m, k=_kind: dwd.bound_events(m["order_org_bound"], k))

# ---- summaries ----------------------------------------------------------------------------
share("y_cargo_1d", """
SELECT org.id AS org_id, org.org_name, d.sender_city_id AS city_id, r.name AS city_name, d.cargo_type, d.cargo_type_name, count(order_id) AS order_count, sum(amount) AS order_amount, d.dt
FROM (SELECT order_id, cargo_type, cargo_type_name, sender_district_id, sender_city_id, max(amount) AS amount, dt FROM y_cargo GROUP BY ALL) d
LEFT JOIN base_organ org ON d.sender_district_id = org.region_id LEFT JOIN base_region_info r ON r.id = d.sender_city_id GROUP BY ALL""")
share("y_receive_1d", """
SELECT org_id, org_name, city_id, city_name, province_id, province_name, count(order_id) AS order_count, sum(amount) AS order_amount, dt FROM (
  SELECT order_id, g.id AS org_id, g.org_name, c.id AS city_id, c.name AS city_name, p.id AS province_id, p.name AS province_name, max(amount) AS amount, y.dt
  FROM y_cargo y LEFT JOIN base_organ g ON y.sender_district_id = g.region_id LEFT JOIN base_region_info d ON g.region_id = d.id LEFT JOIN base_region_info c ON d.parent_id = c.id
  LEFT JOIN base_region_info p ON c.parent_id = p.id WHERE y.status NOT IN ('60010', '60020', '60999') GROUP BY ALL) GROUP BY ALL""")
share("y_dispatch_1d", """
SELECT dt, count(order_id) AS order_count, sum(amount) AS order_amount FROM (SELECT order_id, dt, max(amount) AS amount FROM y_cargo
WHERE status NOT IN ('60010', '60020', '60030', '60040', '60999') GROUP BY 1, 2) GROUP BY dt""")
share("y_truck_1d", """
SELECT f.start_org_id AS org_id, f.start_org_name AS org_name, t.truck_model_type, t.truck_model_type_name, count(f.id) AS trans_finish_count, sum(actual_distance) AS trans_finish_distance,
  sum(finish_dur_sec) AS trans_finish_dur_sec, f.dt FROM y_finish f LEFT JOIN y_truck t ON f.truck_id = t.id GROUP BY ALL""")
share("y_deliver_1d", """
SELECT g.id AS org_id, g.org_name, c.id AS city_id, c.name AS city_name, p.id AS province_id, p.name AS province_name, count(order_id) AS order_count, y.dt
FROM (SELECT DISTINCT order_id, receiver_district_id, dt FROM y_cargo WHERE status IN ('60070', '60080')) y LEFT JOIN base_organ g ON y.receiver_district_id = g.region_id
LEFT JOIN base_region_info d ON g.region_id = d.id LEFT JOIN base_region_info c ON d.parent_id = c.id LEFT JOIN base_region_info p ON c.parent_id = p.id GROUP BY ALL""")
share("y_org_place", """
SELECT g.id AS org_id, g.org_name, CASE WHEN org_level = 1 THEN a.id ELSE b.id END AS city_id, CASE WHEN org_level = 1 THEN a.name ELSE b.name END AS city_name,
  CASE WHEN org_level = 1 THEN b.id ELSE c.id END AS province_id, CASE WHEN org_level = 1 THEN b.name ELSE c.name END AS province_name
FROM base_organ g LEFT JOIN base_region_info a ON g.region_id = a.id LEFT JOIN base_region_info b ON a.parent_id = b.id LEFT JOIN base_region_info c ON b.parent_id = c.id""")
share("y_sort_1d", """
SELECT s.org_id, o.org_name, o.city_id, o.city_name, o.province_id, o.province_name, s.sort_count, s.dt
FROM (SELECT org_id, CAST(make_timestamp(sort_time * 1000) AS DATE) AS dt, count(*) AS sort_count FROM order_org_bound WHERE sort_time IS NOT NULL GROUP BY ALL) s LEFT JOIN y_org_place o ON s.org_id = o.org_id""")
share("y_nd", "SELECT unnest([7, 30]) AS recent_days")


def _nd(src: str, keys: str, sums: list[str]) -> str:
    cols = ", ".join(f"sum({c}) AS {c}" for c in sums)
    lead = f"{keys}, " if keys else ""
    return f"SELECT {lead}recent_days, {cols} FROM {src} JOIN y_nd ON dt > {D} - recent_days WHERE dt <= {D} GROUP BY ALL"


_CARGO_KEYS = "org_id, org_name, city_id, city_name, cargo_type, cargo_type_name"
_PLACE_KEYS = "org_id, org_name, city_id, city_name, province_id, province_name"
share("y_cargo_nd", _nd("y_cargo_1d", _CARGO_KEYS, ["order_count", "order_amount"]))
share("y_receive_nd", _nd("y_receive_1d", _PLACE_KEYS, ["order_count", "order_amount"]))
share("y_dispatch_nd", _nd("y_dispatch_1d", "", ["order_count", "order_amount"]))
share("y_deliver_nd", _nd("y_deliver_1d", _PLACE_KEYS, ["order_count"]))
share("y_sort_nd", _nd("y_sort_1d", _PLACE_KEYS, ["sort_count"]))
share("y_shift_nd", f"""
SELECT a.*, o.city_id, o.city_name, s.line_name, t.truck_model_type, t.truck_model_type_name FROM (
  SELECT recent_days, shift_id, line_id, truck_id, start_org_id AS org_id, start_org_name AS org_name, driver1_emp_id, driver1_name, driver2_emp_id, driver2_name, count(id) AS trans_finish_count,
    sum(actual_distance) AS trans_finish_distance, sum(finish_dur_sec) AS trans_finish_dur_sec, sum(order_num) AS trans_finish_order_count, sum(is_late) AS trans_finish_delay_count
  FROM y_finish JOIN y_nd ON dt > {D} - recent_days WHERE dt <= {D} GROUP BY ALL) a
LEFT JOIN y_org_place o ON a.org_id = o.org_id LEFT JOIN y_shift s ON a.shift_id = s.id LEFT JOIN y_truck t ON a.truck_id = t.id""")

_PLACE = "org_id:i org_name:s city_id:i city_name:s province_id:i province_name:s"
_CARGO = "org_id:i org_name:s city_id:i city_name:s cargo_type:s cargo_type_name:s"
_TRANS = "trans_finish_count:i trans_finish_distance:d trans_finish_dur_sec:i"
_SUMMARIES = {
    "trade_org_cargo_type_order_1d": ("cargo_1d", f"{_CARGO} order_count:i order_amount:d dt:s"),
    "trans_org_receive_1d": ("receive_1d", f"{_PLACE} order_count:i order_amount:d dt:s"),
    "trans_dispatch_1d": ("dispatch_1d", "order_count:i order_amount:d dt:s"),
    "trans_org_truck_model_type_trans_finish_1d": ("truck_1d", f"org_id:i org_name:s truck_model_type:s truck_model_type_name:s {_TRANS} dt:s"),
    "trans_org_deliver_suc_1d": ("deliver_1d", f"{_PLACE} order_count:i dt:s"),
    "trans_org_sort_1d": ("sort_1d", f"{_PLACE} sort_count:i dt:s"),
    "trade_org_cargo_type_order_nd": ("cargo_nd", f"{_CARGO} recent_days:i order_count:i order_amount:d"),
    "trans_org_receive_nd": ("receive_nd", f"{_PLACE} recent_days:i order_count:i order_amount:d"),
    "trans_dispatch_nd": ("dispatch_nd", "recent_days:i order_count:i order_amount:d"),
    "trans_shift_trans_finish_nd": ("shift_nd", f"recent_days:i shift_id:i city_id:i city_name:s org_id:i org_name:s line_id:i line_name:s driver1_emp_id:i driver1_name:s driver2_emp_id:i driver2_name:s "
                                    f"truck_model_type:s truck_model_type_name:s {_TRANS} trans_finish_order_count:i trans_finish_delay_count:i"),
    "trans_org_deliver_suc_nd": ("deliver_nd", f"{_PLACE} recent_days:i order_count:i"),
    "trans_org_sort_nd": ("sort_nd", f"{_PLACE} recent_days:i sort_count:i"),
}
for _name, (_prop, _cols) in _SUMMARIES.items():
    query(f"logistics_dws_{_name}", _cols, f"SELECT * FROM y_{_prop}")(lambda m, p=_prop: getattr(Layer(m), p))

share("y_finish_td", "SELECT count(*) AS order_count, sum(a) AS order_amount FROM (SELECT order_id, max(amount) AS a FROM y_cargo WHERE status IN ('60060', '60070', '60080') GROUP BY 1)")


@query("logistics_dws_trans_dispatch_td", "order_count:i order_amount:d", "SELECT sum(order_count) AS order_count, sum(order_amount) AS order_amount FROM y_dispatch_1d")
def _(m):
    return dws.dispatch_td(Layer(m).dispatch_1d)


@query("logistics_dws_trans_bound_finish_td", "order_count:i order_amount:d", "SELECT * FROM y_finish_td")
def _(m):
    return dws.bound_finish_td(Layer(m).rows("bound_finish"))


# ---- reports ------------------------------------------------------------------------------
def _both(one: str, nd: str, keys: str, sums: list[str]) -> str:
    cols = ", ".join(f"sum({c}) AS {c}" for c in sums)
    k = f", {keys}" if keys else ""
    g = f" GROUP BY {keys}" if keys else ""
    return (f"SELECT 1 AS recent_days{k}, {cols} FROM {one} WHERE dt = {D}{g} "
            f"UNION ALL SELECT recent_days{k}, {cols} FROM {nd} GROUP BY recent_days{k}")


_O, _T3 = ["order_count", "order_amount"], ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]
_AVG = (f"{ratio('trans_finish_distance * 100', 'trans_finish_count * 100', 2)} AS avg_trans_finish_distance, "
        f"{ratio('trans_finish_dur_sec', 'trans_finish_count', 2)} AS avg_trans_finish_dur_sec")
_AVG_COLS = "avg_trans_finish_distance:d avg_trans_finish_dur_sec:d"


@query("logistics_ads_trans_order_stats", "dt:s recent_days:i receive_order_count:i receive_order_amount:d dispatch_order_count:i dispatch_order_amount:d", f"""
SELECT {D} AS dt, coalesce(r.recent_days, s.recent_days) AS recent_days, r.order_count AS receive_order_count, r.order_amount AS receive_order_amount, s.order_count AS dispatch_order_count, s.order_amount AS dispatch_order_amount
FROM ({_both('y_receive_1d', 'y_receive_nd', '', _O)}) r FULL JOIN ({_both('y_dispatch_1d', 'y_dispatch_nd', '', _O)}) s ON r.recent_days = s.recent_days""")
def _(m):
    x = Layer(m)
    return ads.trans_order_stats(x.receive_1d, x.dispatch_1d, DAY)


@query("logistics_ads_trans_stats", f"dt:s recent_days:i {_TRANS}", f"SELECT {D} AS dt, * FROM ({_both('y_truck_1d', 'y_shift_nd', '', _T3)})")
def _(m):
    return ads.trans_stats(Layer(m).truck_1d, DAY)


@query("logistics_ads_trans_order_stats_td", "dt:s bounding_order_count:i bounding_order_amount:d", f"""
SELECT {D} AS dt, (SELECT sum(order_count) FROM y_dispatch_1d) - order_count AS bounding_order_count, (SELECT sum(order_amount) FROM y_dispatch_1d) - order_amount AS bounding_order_amount FROM y_finish_td""")
def _(m):
    return ads.trans_order_stats_td(dws.dispatch_td(Layer(m).dispatch_1d), dws.bound_finish_td(Layer(m).rows("bound_finish")), DAY)


@query("logistics_ads_order_stats", "dt:s recent_days:i order_count:i order_amount:d", f"SELECT {D} AS dt, * FROM ({_both('y_cargo_1d', 'y_cargo_nd', '', _O)})")
def _(m):
    return ads.order_stats(Layer(m).cargo_1d, DAY)


@query("logistics_ads_order_cargo_type_stats", "dt:s recent_days:i cargo_type:s cargo_type_name:s order_count:i order_amount:d", f"""
SELECT {D} AS dt, * FROM ({_both('y_cargo_1d', 'y_cargo_nd', 'cargo_type, cargo_type_name', _O)})""")
def _(m):
    return ads.order_cargo_type_stats(Layer(m).cargo_1d, DAY)


share("y_truck_city_1d", "SELECT t.*, o.city_id, o.city_name FROM y_truck_1d t LEFT JOIN y_org_place o ON t.org_id = o.org_id")


@query("logistics_ads_city_stats", f"dt:s recent_days:i city_id:i city_name:s order_count:i order_amount:d {_TRANS} {_AVG_COLS}", f"""
SELECT {D} AS dt, coalesce(a.recent_days, b.recent_days) AS recent_days, coalesce(a.city_id, b.city_id) AS city_id, coalesce(a.city_name, b.city_name) AS city_name, order_count, order_amount,
  trans_finish_count, trans_finish_distance, trans_finish_dur_sec, {_AVG}
FROM ({_both('y_cargo_1d', 'y_cargo_nd', 'city_id, city_name', _O)}) a FULL JOIN ({_both('y_truck_city_1d', 'y_shift_nd', 'city_id, city_name', _T3)}) b
ON a.recent_days = b.recent_days AND a.city_id IS NOT DISTINCT FROM b.city_id""")
def _(m):
    x = Layer(m)
    return ads.city_stats(x.cargo_1d, x.truck_1d, m["base_organ"], m["base_region_info"], DAY)


@query("logistics_ads_org_stats", f"dt:s recent_days:i org_id:i org_name:s order_count:i order_amount:d {_TRANS} {_AVG_COLS}", f"""
SELECT {D} AS dt, x.*, o.org_name FROM (
  SELECT coalesce(a.recent_days, b.recent_days) AS recent_days, coalesce(a.org_id, b.org_id) AS org_id, order_count, order_amount, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, {_AVG}
  FROM ({_both('y_cargo_1d', 'y_cargo_nd', 'org_id', _O)}) a FULL JOIN ({_both('y_truck_1d', 'y_shift_nd', 'org_id', _T3)}) b
  ON a.recent_days = b.recent_days AND a.org_id IS NOT DISTINCT FROM b.org_id) x LEFT JOIN base_organ o ON x.org_id = o.id""")
def _(m):
    x = Layer(m)
    return ads.org_stats(x.cargo_1d, x.truck_1d, m["base_organ"], DAY)


_T4 = "sum(trans_finish_count) AS trans_finish_count, sum(trans_finish_distance) AS trans_finish_distance, sum(trans_finish_dur_sec) AS trans_finish_dur_sec"


@query("logistics_ads_shift_stats", f"dt:s recent_days:i shift_id:i {_TRANS} trans_finish_order_count:i", f"""
SELECT {D} AS dt, recent_days, shift_id, {_T4}, sum(trans_finish_order_count) AS trans_finish_order_count FROM y_shift_nd GROUP BY 2, 3""")
def _(m):
    return ads.shift_stats(Layer(m).shift_nd, DAY)


@query("logistics_ads_line_stats", f"dt:s recent_days:i line_id:i line_name:s {_TRANS} trans_finish_order_count:i", f"""
SELECT {D} AS dt, recent_days, line_id, line_name, {_T4}, sum(trans_finish_order_count) AS trans_finish_order_count FROM y_shift_nd GROUP BY 2, 3, 4""")
def _(m):
    return ads.line_stats(Layer(m).shift_nd, DAY)


@query("logistics_ads_driver_stats", "dt:s recent_days:i driver_emp_id:i driver_name:s trans_finish_count:i trans_finish_distance:d trans_finish_dur_sec:d avg_trans_finish_distance:d avg_trans_finish_dur_sec:d "
       "trans_finish_late_count:i", f"""
SELECT {D} AS dt, *, {ratio('trans_finish_distance * 1000', 'trans_finish_count * 1000', 2)} AS avg_trans_finish_distance, {ratio('trans_finish_dur_sec * 10', 'trans_finish_count * 10', 2)} AS avg_trans_finish_dur_sec FROM (
  SELECT recent_days, driver_emp_id, driver_name, sum(trans_finish_count) AS trans_finish_count, sum(d) AS trans_finish_distance, sum(s) AS trans_finish_dur_sec, sum(trans_finish_delay_count) AS trans_finish_late_count FROM (
    SELECT recent_days, driver1_emp_id AS driver_emp_id, driver1_name AS driver_name, trans_finish_count, CAST(CASE WHEN driver2_emp_id IS NULL THEN 2 ELSE 1 END * CAST(trans_finish_distance AS DECIMAL(16,3)) * 0.5 AS DECIMAL(20,3)) AS d,
      CAST(CASE WHEN driver2_emp_id IS NULL THEN 2 ELSE 1 END * CAST(trans_finish_dur_sec AS DECIMAL(16,1)) * 0.5 AS DECIMAL(20,1)) AS s, trans_finish_delay_count FROM y_shift_nd
    UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, CAST(CAST(trans_finish_distance AS DECIMAL(16,3)) * 0.5 AS DECIMAL(20,3)), CAST(CAST(trans_finish_dur_sec AS DECIMAL(16,1)) * 0.5 AS DECIMAL(20,1)), trans_finish_delay_count FROM y_shift_nd WHERE driver2_emp_id IS NOT NULL)
  GROUP BY 1, 2, 3)""")
def _(m):
    return ads.driver_stats(Layer(m).shift_nd, DAY)


@query("logistics_ads_truck_stats", f"dt:s recent_days:i truck_model_type:s truck_model_type_name:s {_TRANS} {_AVG_COLS}", f"""
SELECT {D} AS dt, *, {_AVG} FROM (SELECT recent_days, truck_model_type, truck_model_type_name, {_T4} FROM y_shift_nd GROUP BY 1, 2, 3)""")
def _(m):
    return ads.truck_stats(Layer(m).shift_nd, DAY)


@query("logistics_ads_express_stats", "dt:s recent_days:i deliver_suc_count:i sort_count:i", f"""
SELECT {D} AS dt, coalesce(a.recent_days, b.recent_days) AS recent_days, a.order_count AS deliver_suc_count, b.sort_count
FROM ({_both('y_deliver_1d', 'y_deliver_nd', '', ['order_count'])}) a FULL JOIN ({_both('y_sort_1d', 'y_sort_nd', '', ['sort_count'])}) b ON a.recent_days = b.recent_days""")
def _(m):
    x = Layer(m)
    return ads.express_stats([], x.deliver_1d, x.sort_1d, DAY)


for _place in ("province", "city", "org"):
    _keys = [f"{_place}_id", f"{_place}_name"]
    _k = ", ".join(_keys)

    def _on(a: str, b: str, p: str = _place) -> str:
        return f"{a}.recent_days = {b}.recent_days AND {a}.{p}_id IS NOT DISTINCT FROM {b}.{p}_id"

    query(f"logistics_ads_express_{_place}_stats", f"dt:s recent_days:i {_place}_id:i {_place}_name:s receive_order_count:i receive_order_amount:d deliver_suc_count:i sort_count:i", f"""
SELECT {D} AS dt, recent_days, {_k}, max(ro) AS receive_order_count, max(ra) AS receive_order_amount, max(dc) AS deliver_suc_count, max(sc) AS sort_count FROM (
  SELECT recent_days, {_k}, order_count AS dc, NULL AS sc, NULL AS ro, NULL AS ra FROM ({_both('y_deliver_1d', 'y_deliver_nd', _k, ['order_count'])})
  UNION ALL SELECT recent_days, {_k}, NULL, sort_count, NULL, NULL FROM ({_both('y_sort_1d', 'y_sort_nd', _k, ['sort_count'])})
  UNION ALL SELECT recent_days, {_k}, NULL, NULL, order_count, order_amount FROM ({_both('y_receive_1d', 'y_receive_nd', _k, _O)})) GROUP BY ALL""")(
        lambda m, k=_keys: ads.express_stats(k, Layer(m).deliver_1d, Layer(m).sort_1d, DAY, Layer(m).receive_1d))
