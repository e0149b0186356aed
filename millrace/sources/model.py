"""Raw layer of the warehouses, derived from the given tables.

Each entry is one projection (or a small union) written in the SQL subset Spark and a SQL
check engine share; ``{name}`` stands for another table. Filters on ``dt`` reach the scans
because ``dt`` is a plain cast of a stored timestamp.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_LINE_ID = ("CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
            "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING)")
_PRICE = "CAST(l_extendedprice AS DECIMAL(16,2))"
_K = "CAST(split_part(split_part(props, ': ', 2), '}}', 1) AS BIGINT)"
_MONEY = "CAST(value AS DECIMAL(16,2))"

RAW: dict[str, str] = {}

# ---- retail -----------------------------------------------------------------------------
RAW["order_info"] = """
SELECT o_orderkey AS id, o_custkey AS user_id, o_custkey % 25 AS province_id,
  CASE o_orderstatus WHEN 'F' THEN '1004' WHEN 'O' THEN '1002' ELSE '1001' END AS order_status,
  CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND * (o_orderkey * 7919 % 86400) AS create_time,
  CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
  CAST(o_orderkey % 50 AS DECIMAL(16,2)) AS activity_reduce_amount,
  CAST(o_orderkey % 20 AS DECIMAL(16,2)) AS coupon_reduce_amount,
  CAST(o_orderdate AS DATE) AS dt
FROM {orders}"""
RAW["order_detail"] = f"""
SELECT {_LINE_ID} AS id, l_orderkey AS order_id, l_partkey AS sku_id,
  CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' SECOND * (l_orderkey * 31 % 86400) AS create_time,
  CAST(l_quantity AS BIGINT) AS sku_num, {_PRICE} AS order_price,
  CASE WHEN l_discount > 0 THEN CAST({_PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) END AS split_activity_amount,
  CASE WHEN l_returnflag = 'R' THEN CAST({_PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2)) END AS split_coupon_amount,
  {_PRICE} AS split_total_amount, CAST(l_shipdate AS DATE) AS dt
FROM {{lineitem}}"""
RAW["order_detail_activity"] = f"""
SELECT {_LINE_ID} AS order_detail_id, l_suppkey % 25 AS activity_id, l_suppkey AS activity_rule_id,
  CAST(l_shipdate AS DATE) AS dt FROM {{lineitem}} WHERE l_discount >= 0.05"""
RAW["order_detail_coupon"] = f"""
SELECT {_LINE_ID} AS order_detail_id, l_suppkey AS coupon_id, CAST(l_shipdate AS DATE) AS dt
FROM {{lineitem}} WHERE l_returnflag = 'R'"""
RAW["payment_info"] = """
SELECT id AS order_id, user_id,
  CASE id % 3 WHEN 0 THEN '1101' WHEN 1 THEN '1102' ELSE '1103' END AS payment_type,
  CASE WHEN order_status = '1001' THEN '1601' ELSE '1602' END AS payment_status,
  create_time + INTERVAL '1' SECOND * (id * 13 % 7200) AS callback_time,
  CAST(create_time + INTERVAL '1' SECOND * (id * 13 % 7200) AS DATE) AS dt
FROM {order_info}"""
RAW["order_status_log"] = """
SELECT id AS order_id, order_status, create_time + INTERVAL '1' DAY * (1 + id % 5) AS create_time
FROM {order_info}"""
RAW["base_dic"] = """
SELECT * FROM (VALUES ('1101','alipay','11'), ('1102','wechat','11'), ('1103','unionpay','11'),
 ('3101','full reduction','31'), ('3102','full discount','31'), ('3103','discount','31'),
 ('3201','cash coupon','32'), ('3202','discount coupon','32'), ('3203','full cut coupon','32'),
 ('3301','category','33'), ('3302','brand','33'), ('3303','sku','33'),
 ('0701','quality','07'), ('0702','size','07'), ('1201','good','12'), ('1202','fair','12'), ('1203','bad','12')
) AS t(dic_code, dic_name, parent_code)"""
RAW["sku_info"] = """
SELECT p_partkey AS id, p_partkey % 500 AS spu_id, CAST(p_retailprice AS DECIMAL(16,2)) AS price,
  p_name || ' ' || CAST(p_partkey AS STRING) AS sku_name, 'about ' || p_name AS sku_desc,
  CAST(p_size AS DECIMAL(16,2)) AS weight, CAST(p_size % 2 AS INT) AS is_sale,
  CAST(substr(p_brand, 7) AS BIGINT) AS tm_id, 5 * (p_size % 10) + p_partkey % 5 AS category3_id
FROM {part}"""
RAW["spu_info"] = """
SELECT spu_id AS id, 'spu ' || CAST(spu_id AS STRING) AS spu_name, min(category3_id) AS category3_id
FROM {sku_info} GROUP BY spu_id"""
RAW["base_category3"] = """
SELECT DISTINCT category3_id AS id, 'c3-' || CAST(category3_id AS STRING) AS name, category3_id % 10 AS category2_id FROM {sku_info}"""
RAW["base_category2"] = """
SELECT DISTINCT category2_id AS id, 'c2-' || CAST(category2_id AS STRING) AS name, category2_id % 3 AS category1_id FROM {base_category3}"""
RAW["base_category1"] = """
SELECT DISTINCT category1_id AS id, 'c1-' || CAST(category1_id AS STRING) AS name FROM {base_category2}"""
RAW["base_trademark"] = """
SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS id, p_brand AS tm_name FROM {part}"""
RAW["sku_attr_value"] = """
SELECT p_partkey * 2 + n AS id, p_partkey AS sku_id, n AS attr_id, 'attr' || CAST(n AS STRING) AS attr_name,
  p_partkey % 7 + n AS value_id, 'v' || CAST(p_partkey % 7 + n AS STRING) AS value_name
FROM {part} JOIN (VALUES (0), (1)) AS t(n) ON p_size >= n"""
RAW["sku_sale_attr_value"] = """
SELECT p_partkey AS id, p_partkey AS sku_id, p_partkey % 4 AS sale_attr_value_id, 'type' AS sale_attr_name,
  p_type AS sale_attr_value_name FROM {part} WHERE p_type <> 'SMALL'"""
RAW["base_province"] = """
SELECT n_nationkey AS id, n_name AS name, '0' || CAST(n_nationkey AS STRING) AS area_code, 'CN-' || CAST(n_nationkey AS STRING) AS iso_code,
  'CN-' || substr(n_name, 1, 3) || CAST(n_nationkey AS STRING) AS iso_3166_2, n_regionkey AS region_id FROM {nation}"""
RAW["base_region"] = "SELECT r_regionkey AS id, r_name AS region_name FROM {region}"
RAW["coupon_info"] = """
SELECT s_suppkey AS id, 'coupon ' || CAST(s_suppkey AS STRING) AS coupon_name,
  CASE s_suppkey % 4 WHEN 0 THEN '3201' WHEN 1 THEN '3202' WHEN 2 THEN '3203' ELSE '3299' END AS coupon_type,
  CAST(100 + s_suppkey AS DECIMAL(16,2)) AS condition_amount, 2 + s_suppkey % 3 AS condition_num, s_suppkey % 25 AS activity_id,
  CAST(10 + s_suppkey % 10 AS DECIMAL(16,2)) AS benefit_amount, CAST(0.90 AS DECIMAL(16,2)) AS benefit_discount,
  CASE s_suppkey % 3 WHEN 0 THEN '3301' WHEN 1 THEN '3302' ELSE '3303' END AS range_type, s_suppkey % 9 AS limit_num
FROM {supplier}"""
RAW["activity_info"] = """
SELECT n_nationkey AS id, 'activity ' || CAST(n_nationkey AS STRING) AS activity_name, n_name AS activity_desc FROM {nation}"""
RAW["activity_rule"] = """
SELECT s_suppkey AS id, s_suppkey % 25 AS activity_id,
  CASE s_suppkey % 3 WHEN 0 THEN '3101' WHEN 1 THEN '3102' ELSE '3103' END AS activity_type,
  CASE WHEN s_suppkey % 3 = 0 THEN CAST(100 + s_suppkey AS DECIMAL(16,2)) END AS condition_amount, 2 + s_suppkey % 3 AS condition_num,
  CAST(10 AS DECIMAL(16,2)) AS benefit_amount, CAST(0.80 AS DECIMAL(16,2)) AS benefit_discount, 1 + s_suppkey % 3 AS benefit_level
FROM {supplier}"""
RAW["promotion_pos"] = """
SELECT s_suppkey AS id, 'slot ' || CAST(s_suppkey % 7 AS STRING) AS pos_location, CASE WHEN s_suppkey % 2 = 0 THEN 'banner' ELSE 'list' END AS pos_type,
  'activity' AS promotion_type FROM {supplier}"""
RAW["promotion_refer"] = "SELECT n_nationkey AS id, 'refer ' || n_name AS refer_name FROM {nation}"
RAW["user_info"] = """
SELECT c_custkey AS id, 'login' || CAST(c_custkey AS STRING) AS login_name, c_name AS name, 'pw' || CAST(c_custkey AS STRING) AS passwd,
  CASE WHEN c_custkey % 5 = 0 THEN '12' ELSE '138' END || lpad(CAST(c_custkey AS STRING), 8, '0') AS phone_num,
  CASE WHEN c_custkey % 7 = 0 THEN 'bad mail' ELSE 'u' || CAST(c_custkey AS STRING) || '@mail.example' END AS email,
  CAST(1 + c_custkey % 3 AS STRING) AS user_level, c_custkey * 17 % 20000 AS birthday,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
  CAST(18 + c_custkey * 7 % 60 AS INT) AS age,
  CAST(DATE '2023-12-20' AS TIMESTAMP) + INTERVAL '1' HOUR * (c_custkey * 5 % 960) AS create_time, c_nationkey AS province_id, c_mktsegment AS segment
FROM {customer}"""
RAW["page_log"] = f"""
SELECT event_id, 'mid_' || CAST(user_id AS STRING) AS mid, CAST(user_id % 25 AS STRING) AS ar, 'brand' || CAST(user_id % 6 AS STRING) AS ba,
  'ch' || CAST(user_id % 5 AS STRING) AS ch, CASE WHEN event_id % 3 = 0 THEN '1' ELSE '0' END AS is_new,
  'model' || CAST(user_id % 9 AS STRING) AS md, CASE WHEN user_id % 3 = 0 THEN 'iOS 13.2' ELSE 'Android 11' END AS os,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS uid, 'v' || CAST(user_id % 4 AS STRING) AS vc,
  CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS sid,
  CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'home' ELSE 'search_result' END AS page_id,
  CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN 'search' ELSE 'home' END AS last_page_id,
  CASE WHEN event_type = 'error' THEN 'word ' || CAST({_K} % 20 AS STRING) ELSE CAST({_K} AS STRING) END AS item,
  CASE WHEN event_type = 'error' THEN 'keyword' ELSE 'sku_id' END AS item_type,
  CAST(ROUND(value * 100) AS BIGINT) * 10 AS during_time, EPOCH_MS(date_trunc('millisecond', CAST(ts AS TIMESTAMP))) AS ts_ms,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error, {_K} % 3 AS shows, {_K} % 2 AS acts,
  CAST(ts AS TIMESTAMP) AS ts, CAST(ts AS DATE) AS dt
FROM {{events}}"""
RAW["cart_info"] = f"""
SELECT event_id AS id, user_id, {_K} AS sku_id, CAST(ts AS TIMESTAMP) AS create_time, 1 + event_id % 5 AS sku_num,
  CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS is_ordered, CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type = 'click'"""
RAW["favor_info"] = f"""
SELECT event_id AS id, user_id, {_K} AS sku_id, CAST(ts AS TIMESTAMP) AS create_time, CASE WHEN event_id % 6 = 0 THEN '1' ELSE '0' END AS is_cancel,
  CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type = 'signup'"""
RAW["coupon_use"] = f"""
SELECT event_id AS id, {_K} AS coupon_id, user_id, event_id AS order_id, CASE WHEN event_type = 'purchase' THEN CAST(ts AS TIMESTAMP) END AS used_time,
  CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type IN ('purchase', 'click')"""

# ---- logistics --------------------------------------------------------------------------
RAW["lg_dic"] = """
SELECT * FROM (VALUES ('60010','unpaid'), ('60020','paid'), ('60030','collected'), ('60040','at station'), ('60050','dispatched'),
 ('60060','in transit'), ('60070','delivered'), ('60080','signed'), ('60999','cancelled'),
 ('70001','post'), ('70002','food'), ('70003','electronics'), ('70004','cloth'), ('70005','books'),
 ('71001','door'), ('71002','station'), ('72001','cash'), ('72002','online'),
 ('73001','trunk'), ('73002','branch'), ('74001','collect'), ('74002','deliver'),
 ('75001','small truck'), ('75002','large truck'), ('76001','brand A'), ('76002','brand B')) AS t(id, name)"""
RAW["base_region_info"] = """
SELECT CAST(100 + r_regionkey AS BIGINT) AS id, CAST(0 AS BIGINT) AS parent_id, r_name AS name, 'P' || CAST(r_regionkey AS STRING) AS dict_code, substr(r_name, 1, 3) AS short_name FROM {region}
UNION ALL
SELECT CAST(1000 + n_nationkey AS BIGINT), CAST(100 + n_regionkey AS BIGINT), n_name, 'C' || CAST(n_nationkey AS STRING), 'N' || CAST(n_nationkey AS STRING) FROM {nation}
UNION ALL
SELECT CAST(10000 + n_nationkey * 10 + d AS BIGINT), CAST(1000 + n_nationkey AS BIGINT), n_name || ' D' || CAST(d AS STRING), 'D' || CAST(n_nationkey * 10 + d AS STRING), 'D' || CAST(d AS STRING)
FROM {nation} JOIN (VALUES (0), (1)) AS t(d) ON n_nationkey >= 0"""
RAW["base_organ"] = """
SELECT s_suppkey AS id, s_name AS org_name, CASE WHEN s_suppkey < 50 THEN 2 ELSE 1 END AS org_level,
  CASE WHEN s_suppkey < 50 THEN CAST(10000 + CAST(FLOOR(s_suppkey / 2) AS BIGINT) * 10 + s_suppkey % 2 AS BIGINT) ELSE CAST(1000 + s_nationkey AS BIGINT) END AS region_id,
  CASE WHEN s_suppkey < 50 THEN 50 + s_suppkey % 50 END AS org_parent_id
FROM {supplier}"""
RAW["order_cargo"] = f"""
SELECT {_LINE_ID} AS id, l_orderkey AS order_id, CAST(70001 + l_partkey % 5 AS STRING) AS cargo_type,
  10 + l_partkey % 50 AS volume_length, 10 + l_partkey % 40 AS volume_width, 10 + l_partkey % 30 AS volume_height, CAST(l_quantity AS DECIMAL(16,2)) AS weight,
  CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T' || lpad(CAST(l_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(l_linenumber AS STRING), 2, '0') || ':00Z' AS create_time,
  CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' AND l_linenumber = 7 THEN '1' ELSE '0' END AS is_deleted, CAST(l_shipdate AS DATE) AS dt
FROM {{lineitem}}"""
RAW["lg_order_info"] = """
SELECT o_orderkey AS id, 'NO' || CAST(o_orderkey AS STRING) AS order_no,
  CASE WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 4 WHEN 0 THEN '60010' WHEN 1 THEN '60020' WHEN 2 THEN '60999' ELSE '60030' END
       WHEN o_orderstatus = 'O' THEN CASE o_orderkey % 3 WHEN 0 THEN '60040' WHEN 1 THEN '60050' ELSE '60060' END
       ELSE CASE WHEN o_orderkey % 2 = 0 THEN '60070' ELSE '60080' END END AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN '71001' ELSE '71002' END AS collect_type, CASE WHEN o_orderkey % 3 = 0 THEN '72001' ELSE '72002' END AS payment_type,
  o_custkey AS user_id, o_custkey % 97 AS receiver_complex_id,
  100 + o_custkey % 25 % 5 AS receiver_province_id, 1000 + o_custkey % 25 AS receiver_city_id, 10000 + o_custkey % 25 * 10 + o_custkey % 2 AS receiver_district_id,
  'Receiver ' || CAST(o_custkey AS STRING) AS receiver_name, o_orderkey % 89 AS sender_complex_id,
  100 + o_orderkey % 25 % 5 AS sender_province_id, 1000 + o_orderkey % 25 AS sender_city_id, 10000 + o_orderkey % 25 * 10 + o_orderkey % 2 AS sender_district_id,
  'Sender ' || CAST(o_orderkey AS STRING) AS sender_name, 1 + o_orderkey % 5 AS cargo_num, CAST(o_totalprice AS DECIMAL(16,2)) AS amount,
  EPOCH_MS(CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' HOUR * (24 + o_orderkey % 200)) AS estimate_arrive_time, CAST(o_orderkey % 1000 AS DECIMAL(16,2)) AS distance,
  CAST(o_orderdate AS DATE) AS update_date, '0' AS is_deleted
FROM {orders}"""
RAW["transport_task"] = """
SELECT o_orderkey AS id, o_custkey % 40 AS shift_id, o_custkey % 20 AS line_id, o_orderkey % 100 AS start_org_id, 'Org ' || CAST(o_orderkey % 100 AS STRING) AS start_org_name,
  (o_orderkey + 37) % 100 AS end_org_id, 'Org ' || CAST((o_orderkey + 37) % 100 AS STRING) AS end_org_name, 1 + o_orderkey % 30 AS order_num,
  o_custkey % 40 AS driver1_emp_id, 'Driver ' || CAST(o_custkey % 40 AS STRING) AS driver1_name,
  CASE WHEN o_custkey % 3 = 0 THEN 100 + o_custkey % 40 END AS driver2_emp_id, CASE WHEN o_custkey % 3 = 0 THEN 'Mate ' || CAST(o_custkey % 40 AS STRING) END AS driver2_name,
  o_custkey % 30 AS truck_id, 'T' || CAST(o_custkey % 30 AS STRING) AS truck_no,
  EPOCH_MS(CAST(o_orderdate AS TIMESTAMP)) AS actual_start_time,
  CASE WHEN o_orderstatus <> 'P' THEN EPOCH_MS(CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' SECOND * (3600 + o_orderkey * 977 % 80000)) END AS actual_end_time,
  CAST(o_totalprice / 1000 AS DECIMAL(16,2)) AS actual_distance, '0' AS is_deleted, CAST(o_orderdate AS DATE) AS dt
FROM {orders}"""
RAW["order_org_bound"] = f"""
SELECT {_LINE_ID} AS id, l_orderkey AS order_id, l_suppkey AS org_id,
  EPOCH_MS(CAST(l_shipdate AS TIMESTAMP)) AS inbound_time, l_partkey % 50 AS inbound_emp_id,
  CASE WHEN l_linestatus = 'F' THEN EPOCH_MS(CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' HOUR * CAST(l_linenumber AS BIGINT)) END AS sort_time, l_partkey % 40 AS sorter_emp_id,
  CASE WHEN l_returnflag <> 'N' THEN EPOCH_MS(CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' HOUR * (8 + CAST(l_linenumber AS BIGINT))) END AS outbound_time, l_partkey % 30 AS outbound_emp_id,
  CAST(l_shipdate AS DATE) AS dt
FROM {{lineitem}}"""
RAW["line_base_info"] = """
SELECT s_suppkey AS id, 'line ' || CAST(s_suppkey AS STRING) AS name, 'L' || CAST(s_suppkey AS STRING) AS line_no, s_suppkey % 3 AS line_level, s_suppkey AS org_id,
  CASE WHEN s_suppkey % 2 = 0 THEN '73001' ELSE '73002' END AS transport_line_type_id, s_suppkey AS start_org_id, (s_suppkey + 37) % 100 AS end_org_id,
  CAST(s_acctbal AS DECIMAL(16,2)) AS distance, 10000 + s_suppkey * 797 % 40000 AS estimated_time FROM {supplier}"""
RAW["line_base_shift"] = """
SELECT c_custkey AS id, c_custkey % 20 AS line_id, lpad(CAST(c_custkey % 24 AS STRING), 2, '0') || ':00' AS start_time,
  c_custkey % 40 AS driver1_emp_id, c_custkey % 30 AS truck_id FROM {customer}"""
RAW["truck_driver"] = """
SELECT c_custkey AS id, c_custkey AS emp_id, c_custkey % 120 AS org_id, c_custkey % 25 AS team_id, 'A' || CAST(c_custkey % 3 AS STRING) AS license_type,
  CAST(c_custkey % 2 AS INT) AS is_enabled FROM {customer}"""
RAW["truck_team"] = "SELECT n_nationkey AS id, 'team ' || n_name AS name, 'TN' || CAST(n_nationkey AS STRING) AS team_no, CAST(n_nationkey AS BIGINT) AS org_id FROM {nation}"
RAW["truck_info"] = """
SELECT s_suppkey AS id, s_suppkey % 25 AS team_id, 'T' || CAST(s_suppkey AS STRING) AS truck_no, s_suppkey % 5 AS truck_model_id FROM {supplier}"""
RAW["truck_model"] = """
SELECT r_regionkey AS id, 'model ' || r_name AS model_name, CASE WHEN r_regionkey % 2 = 0 THEN '75001' ELSE '75002' END AS model_type,
  CASE WHEN r_regionkey % 2 = 0 THEN '76001' ELSE '76002' END AS brand, 2000 + r_regionkey AS load_weight FROM {region}"""
RAW["base_complex"] = """
SELECT c_custkey AS id, 'complex ' || CAST(c_custkey AS STRING) AS complex_name, CAST(100 + c_nationkey % 7 AS BIGINT) AS province_id, CAST(1000 + c_nationkey AS BIGINT) AS city_id,
  CAST(10000 + c_nationkey * 10 AS BIGINT) AS district_id, 'D0' AS district_name FROM {customer}"""
RAW["express_courier_complex"] = """
SELECT o_orderkey % 300 AS courier_emp_id, o_custkey AS complex_id FROM {orders}"""
RAW["express_courier"] = """
SELECT c_custkey AS id, c_custkey AS emp_id, c_custkey % 120 AS org_id, '138' || lpad(CAST(c_custkey AS STRING), 8, '0') AS working_phone,
  CASE WHEN c_custkey % 3 = 0 THEN '74001' WHEN c_custkey % 3 = 1 THEN '74002' ELSE '74009' END AS express_type FROM {customer}"""
RAW["user_address"] = """
SELECT c_custkey AS id, c_custkey AS user_id, '139' || lpad(CAST(c_custkey * 3 AS STRING), 8, '0') AS phone, CAST(100 + c_nationkey % 5 AS BIGINT) AS province_id,
  CAST(1000 + c_nationkey AS BIGINT) AS city_id, CAST(c_nationkey % 2 AS INT) AS is_default, '2023-12-2' || CAST(c_custkey % 10 AS STRING) || 'T08:00:00Z' AS create_time FROM {customer}"""

# ---- product events, pricing, marketing -------------------------------------------------
RAW["product_info"] = """
SELECT p_partkey AS product_id, p_name AS product_name, p_size % 10 AS category_id, p_type AS category_name, CAST(substr(p_brand, 7) AS BIGINT) AS brand_id, p_brand AS brand_name,
  CAST(p_retailprice AS DECIMAL(16,2)) AS price, CASE WHEN p_partkey % 8 = 7 THEN NULL ELSE p_partkey % 8 END AS price_strength_star,
  CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END AS is_valid, 'img' || CAST(p_partkey AS STRING) AS product_image, 'SKU' || CAST(p_partkey AS STRING) AS product_sku,
  DATE '2023-12-01' AS release_date FROM {part}"""
_EV = f"event_id, {_K} AS product_id, user_id, CAST(ts AS TIMESTAMP)"
RAW["product_visit"] = f"""
SELECT event_id AS visit_id, {_K} AS product_id, user_id, CAST(ts AS TIMESTAMP) AS visit_time, CAST(FLOOR(value / 8) AS BIGINT) AS stay_seconds,
  CASE WHEN event_id % 2 = 0 THEN 'PC' ELSE 'MOBILE' END AS terminal_type, CAST(event_id % 3 AS INT) AS is_micro_detail, CAST(ts AS DATE) AS dt
FROM {{events}} WHERE event_type IN ('view', 'click')"""
RAW["product_favorite"] = f"SELECT event_id AS fav_id, {_K} AS product_id, user_id, CAST(ts AS TIMESTAMP) AS fav_time, CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type = 'signup'"
RAW["product_cart"] = f"SELECT event_id AS cart_id, {_K} AS product_id, user_id, 1 + event_id % 3 AS quantity, CAST(ts AS TIMESTAMP) AS cart_time, CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type = 'click'"
RAW["product_order"] = f"""
SELECT event_id AS order_id, {_K} AS product_id, user_id, 1 + event_id % 4 AS quantity, {_MONEY} AS order_amount, CAST(ts AS TIMESTAMP) AS order_time,
  CASE WHEN event_id % 3 = 0 THEN 'JUHUASUAN' ELSE 'NONE' END AS activity_type, CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type = 'purchase'"""
RAW["product_payment"] = f"""
SELECT event_id AS payment_id, event_id AS order_id, {_K} AS product_id, user_id, {_MONEY} AS pay_amount,
  CAST(ts AS TIMESTAMP) + INTERVAL '1' MINUTE * (event_id % 40 - 5) AS pay_time, CASE WHEN event_id % 3 = 0 THEN 'JUHUASUAN' ELSE 'NONE' END AS activity_type
FROM {{events}} WHERE event_type = 'purchase' AND value > 5"""
RAW["product_refund"] = f"""
SELECT event_id AS refund_id, event_id AS order_id, {_K} AS product_id, user_id, CAST({_MONEY} * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(16,2)) AS refund_amount,
  CAST(ts AS TIMESTAMP) + INTERVAL '1' HOUR * 2 AS refund_time FROM {{events}} WHERE event_type = 'purchase' AND value > 100"""
RAW["traffic"] = f"""
SELECT event_id AS traffic_id, {_K} AS product_id, event_id % 4 AS visitor_count, 'source' || CAST(user_id % 14 AS STRING) AS source,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'word' || CAST({_K} % 3 AS STRING) END AS search_word, CAST(ts AS TIMESTAMP) AS visit_time, CAST(ts AS DATE) AS dt
FROM {{events}}"""
RAW["trade"] = f"""
SELECT event_id AS order_id, {_K} AS product_id, {_K} * 10 + event_id % 2 AS sku_id, user_id, {_MONEY} AS pay_amount, CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS pay_time,
  1 + event_id % 2 AS buyer_count, 1 + event_id % 5 AS pay_quantity, CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type IN ('purchase', 'click')"""
RAW["inventory"] = """
SELECT p_partkey * 10 AS inventory_id, p_partkey * 10 AS sku_id, p_size * 3 AS current_stock, p_size AS saleable_days, CAST(DATE '2024-01-01' AS TIMESTAMP) + INTERVAL '1' DAY * (p_partkey % 30) AS update_time FROM {part}"""
RAW["fact_order"] = """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_partkey * 10 + l_suppkey % 3 AS sku_id, l_orderkey % 1500 AS user_id,
  CAST(l_shipdate AS TIMESTAMP) + INTERVAL '1' MINUTE * CAST(l_linenumber AS BIGINT) AS order_time, l_suppkey AS shop_id,
  CASE WHEN l_returnflag = 'R' THEN 'cancelled' ELSE 'completed' END AS order_status, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(16,2)) AS order_amount, l_linenumber AS line_no,
  CAST(l_shipdate AS DATE) AS dt FROM {lineitem}"""
RAW["traffic_log"] = f"""
SELECT event_id AS log_id, user_id, {_K} AS product_id, CASE user_id % 5 WHEN 0 THEN '搜索' WHEN 1 THEN '推荐' WHEN 2 THEN '直通车' WHEN 3 THEN '活动' ELSE '其他' END AS channel,
  CAST(ts AS TIMESTAMP) AS visit_time, CAST(ts AS DATE) AS dt FROM {{events}} WHERE event_type IN ('view', 'click')"""
RAW["event_order"] = f"""
SELECT event_id AS order_id, {_K} AS product_id, {_K} * 10 + user_id % 3 AS sku_id, user_id, CAST(ts AS TIMESTAMP) AS order_time,
  CASE WHEN event_id % 10 = 0 THEN 'cancelled' ELSE 'completed' END AS order_status, 1 + event_id % 4 AS quantity, {_MONEY} AS order_amount, CAST(ts AS DATE) AS dt
FROM {{events}} WHERE event_type = 'purchase'"""
RAW["price_history"] = """
SELECT l_partkey AS product_id, CAST(l_shipdate AS TIMESTAMP) AS change_time, CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(16,2)) ELSE CAST(l_extendedprice AS DECIMAL(16,2)) END AS old_price,
  CAST(l_extendedprice AS DECIMAL(16,2)) AS new_price, CAST(l_shipdate AS DATE) AS dt FROM {lineitem}"""
RAW["review"] = f"""
SELECT event_id AS review_id, {_K} AS product_id, {_K} * 10 AS sku_id, user_id, CAST(event_id % 7 AS INT) AS rating, CAST(ts AS TIMESTAMP) AS review_time, CAST(ts AS DATE) AS dt FROM {{events}}
WHERE event_type IN ('purchase', 'error')"""
RAW["user_profile"] = """
SELECT id AS user_id, gender, CAST(12 + id * 7 % 95 AS INT) AS age, 'loc' || CAST(province_id % 4 AS STRING) AS location, user_level AS member_level FROM {user_info}"""
RAW["mk_user"] = """
SELECT id AS user_id, name AS user_name, gender, CASE WHEN id % 50 = 0 THEN NULL ELSE age END AS age,
  CASE province_id % 8 WHEN 0 THEN '北京' WHEN 1 THEN '上海' WHEN 2 THEN '杭州' WHEN 3 THEN '武汉' WHEN 4 THEN '宁波' WHEN 5 THEN '绵阳' WHEN 6 THEN '珠海' ELSE '西安' END AS city,
  create_time AS register_time, segment AS channel FROM {user_info}"""
RAW["mk_activity"] = """
SELECT s_suppkey AS activity_id, 'activity ' || CAST(s_suppkey AS STRING) AS activity_name, CASE s_suppkey % 3 WHEN 0 THEN 'coupon' WHEN 1 THEN 'share' ELSE 'gift' END AS activity_type,
  CAST(DATE '2024-01-01' AS TIMESTAMP) + INTERVAL '1' DAY * (s_suppkey % 25) AS start_time, CAST(DATE '2024-01-01' AS TIMESTAMP) + INTERVAL '1' DAY * (s_suppkey % 25 + s_suppkey % 12) AS end_time,
  CAST(CASE WHEN s_suppkey % 6 = 5 THEN 9 ELSE s_suppkey % 3 END AS INT) AS status, 'channel' || CAST(s_suppkey % 4 AS STRING) AS channel, CAST(s_acctbal AS DECIMAL(15,2)) AS budget FROM {supplier}"""
RAW["mk_behavior"] = f"""
SELECT event_id AS behavior_id, user_id, {_K} AS activity_id, CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'participate' WHEN 'error' THEN 'share' ELSE 'buy' END AS behavior_type,
  CAST(ts AS TIMESTAMP) AS behavior_time, CASE user_id % 5 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' WHEN 2 THEN 'pc' WHEN 3 THEN 'mac' ELSE 'tv' END AS device, CAST(ts AS DATE) AS behavior_date
FROM {{events}}"""
RAW["mk_effect"] = f"""
SELECT event_id AS effect_id, {_K} AS activity_id, user_id, CAST(ts AS TIMESTAMP) AS conversion_time, 'order' AS conversion_type,
  CASE WHEN event_id % 20 = 0 THEN CAST(-1 AS DECIMAL(16,2)) ELSE {_MONEY} END AS amount FROM {{events}} WHERE event_type = 'purchase'"""
RAW["related_behavior"] = f"""
SELECT event_id AS id, user_id, {_K} AS main_product_id, CASE WHEN event_id % 10 < 7 THEN NULL ELSE ({_K} * 7 + 3) % 100 END AS related_product_id,
  CASE event_type WHEN 'view' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 1 END AS behavior_type, CAST(ts AS TIMESTAMP) AS behavior_time,
  CAST(event_id % 2 AS INT) AS is_guide_from_detail, CAST(ts AS DATE) AS dt FROM {{events}}"""
RAW["product_sales"] = f"""
SELECT {_K} AS product_id, {_MONEY} AS sales_amount, 1 + event_id % 3 AS sales_count, CAST(ts AS DATE) AS sales_date, event_id % 500 AS order_id, CAST(ts AS TIMESTAMP) AS update_time FROM {{events}} WHERE event_type = 'purchase'"""
RAW["product_stock"] = """
SELECT p_partkey AS product_id, CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size END AS stock_count, CAST(DATE '2024-01-01' AS TIMESTAMP) + INTERVAL '1' DAY * (p_partkey % 30) AS update_time FROM {part}"""

# ---- boards, labels, comments, vehicles -------------------------------------------------
RAW["board_cart"] = f"""
SELECT CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id, CAST(ts AS TIMESTAMP) AS cart_time, CAST({_K} AS STRING) AS goods_id, event_id % 7 - 1 AS cart_quantity,
  'shop' || CAST(user_id % 6 AS STRING) AS shop_id, CASE WHEN event_id % 8 = 0 THEN 'cancel' ELSE 'normal' END AS cart_status, 'app' AS data_source, CAST(CAST(ts AS DATE) AS STRING) AS dt
FROM {{events}} WHERE event_type IN ('click', 'signup')"""
RAW["board_payment"] = f"""
SELECT CAST(event_id AS STRING) AS order_id, CAST(user_id AS STRING) AS user_id, CAST(ts AS TIMESTAMP) AS payment_time,
  CASE WHEN event_id % 4 = 0 AND event_id % 8 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) - INTERVAL '1' DAY * (event_id % 10) END AS deposit_pay_time, CAST({_K} AS STRING) AS goods_id,
  'shop' || CAST(user_id % 6 AS STRING) AS shop_id, {_MONEY} AS payment_amount, CAST(event_id % 3 AS DECIMAL(16,2)) AS refund_amount, CAST(5 AS DECIMAL(16,2)) AS freight_amount,
  CASE event_id % 4 WHEN 0 THEN 'presale' WHEN 1 THEN 'normal' WHEN 2 THEN 'subsidy_managed' ELSE 'flash' END AS order_type, CASE WHEN event_id % 11 = 0 THEN 'failed' ELSE 'success' END AS payment_status, 'app' AS data_source
FROM {{events}} WHERE event_type IN ('purchase', 'click')"""
RAW["board_visit"] = f"""
SELECT CASE WHEN event_id % 29 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS user_id, CAST(ts AS TIMESTAMP) AS visit_time,
  CASE event_type WHEN 'view' THEN '详情页访问' WHEN 'click' THEN '图文浏览' WHEN 'purchase' THEN '直播间观看' WHEN 'signup' THEN '微详情浏览' ELSE '首页' END AS visit_behavior, CAST({_K} AS STRING) AS goods_id,
  'shop' || CAST(user_id % 6 AS STRING) AS shop_id, 'app' AS visit_platform, CASE event_id % 3 WHEN 0 THEN '日志采集' WHEN 1 THEN '接口同步' ELSE '人工' END AS data_source, CAST(CAST(ts AS DATE) AS STRING) AS dt
FROM {{events}}"""
RAW["comments"] = """
SELECT conv_id AS order_id, turn AS ts_ms, conv_id * 100 + turn AS id, conv_id % 150 AS user_id, role AS consignee, text AS msg FROM {conversations}"""
RAW["words"] = """
SELECT EACH_TOKEN(text, ' ')) AS word FROM {benchmark} UNION ALL SELECT '' AS word"""
RAW["long_words"] = """
SELECT word FROM {words} UNION ALL SELECT EACH_TOKEN(p_name, ' ')) AS word FROM {part} UNION ALL SELECT EACH_TOKEN(c_name, ' ')) AS word FROM {customer}"""
RAW["part_words"] = """
SELECT DISTINCT EACH_TOKEN(p_name, ' ')) AS word FROM {part}"""
RAW["part_runs"] = """
SELECT p_partkey AS part_id, lower(replace(p_name, ' ', '')) || CAST(p_partkey % 40 AS STRING) AS run FROM {part}"""
RAW["fixes"] = f"""
SELECT 'car' || CAST(user_id % 40 AS STRING) AS vehicle, CAST(ts AS TIMESTAMP) AS ts, event_id,
  CAST(116.0 + (event_id % 97) * 0.01 AS DOUBLE) AS lon, CAST(39.5 + ({_K} % 50) * 0.01 AS DOUBLE) AS lat, CAST(ts AS DATE) AS dt FROM {{events}}"""
RAW["lb_category"] = """
SELECT c3.id AS id, 'word ' || CAST(c3.id % 20 AS STRING) AS b3name,
  CASE c3.id % 4 WHEN 0 THEN '数码' WHEN 1 THEN '母婴' WHEN 2 THEN '服饰内衣' ELSE '宠物' END AS b1name FROM {base_category3} c3"""
RAW["lb_word"] = "SELECT b3name, min(b1name) AS b1name FROM {lb_category} GROUP BY b3name"
RAW["lb_compare"] = """
SELECT * FROM (VALUES ('数码', '科技与数码'), ('母婴', '家庭与育儿'), ('服饰内衣', '时尚与潮流')) AS t(category_name, search_category)"""
RAW["lb_sku"] = """
SELECT id AS skuid, category3_id AS c3id, CASE tm_id % 6 WHEN 0 THEN 'TCL' WHEN 1 THEN '苹果' WHEN 2 THEN '欧莱雅' WHEN 3 THEN '香奈儿' WHEN 4 THEN '小米' ELSE 'other' END AS tname FROM {sku_info}"""
RAW["lb_user"] = "SELECT CAST(id AS STRING) AS uid, name AS uname, gender, user_level, birthday FROM {user_info}"
RAW["lb_body"] = "SELECT CAST(c_custkey AS STRING) AS uid, 150 + c_custkey % 45 AS height, 45 + c_custkey % 50 AS weight FROM {customer} WHERE c_custkey % 5 < 4"
RAW["lb_order"] = """
SELECT id, user_id, create_time + INTERVAL '1' SECOND * (id * 13 % 7200) AS pay_time, CAST(total_amount * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(16,2)) AS total_amount FROM {order_info}"""
RAW["lb_detail"] = "SELECT order_id, sku_id, id AS line_id FROM {order_detail}"


def _spark(text: str) -> str:
    """Raw-layer text in Spark's names of the two functions that have no common name."""
    return text.replace("EPOCH_MS(", "unix_millis(").replace("EACH_TOKEN(", "explode(split(")


def references(text: str) -> list[str]:
    return [name for _, name, _, _ in string.Formatter().parse(text) if name]


class Model:
    """Lazy access to the given tables and the raw layer: ``m["order_info"]``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                self._frames[name] = self.spark.read.parquet(self.path(name))
            else:
                self._frames[name] = self.apply(_spark(RAW[name]))
        return self._frames[name]

    def apply(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run a projection text over model tables (or over the given frames, e.g. streams)."""
        args = {n: frames.get(n) if n in frames else self[n] for n in dict.fromkeys(references(text))}
        return self.spark.sql(text, **args)

    def over(self, name: str, **frames: DataFrame) -> DataFrame:
        """A raw-layer table computed from other inputs than the stored tables."""
        return self.apply(_spark(RAW[name]), **frames)
