import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import at, day
from millrace.plans import logistics_ads, logistics_dwd, marketing, pricing, product_events as pe, retail_ads, retail_dwd, retail_dws
from millrace.sources import logs
from millrace.sources.calendar import dim_date

SKU = "sku_name string, category1_id int, category1_name string, category2_id int, category2_name string, category3_id int, category3_name string, tm_id int, tm_name string"


def user_sku(spark, data):
    full = [(d, u, s, f"s{s}", 1, "a", 2, "b", 3, "c", tm, f"tm{tm}", n) for d, u, s, tm, n in data]
    return spark.createDataFrame(full, f"dt date, user_id int, sku_id int, {SKU}, order_count_1d long")


def test_repeat_rate_counts_per_user(spark):
    df = user_sku(spark, [(day("2024-01-30"), 1, 1, 9, 1), (day("2024-01-29"), 1, 2, 9, 1), (day("2024-01-20"), 2, 1, 9, 1), (day("2023-12-01"), 2, 1, 9, 5)])
    assert retail_ads.repeat_purchase(df, "2024-01-30").first().order_repeat_rate == Decimal("0.50")


def test_brand_orders_distinct_users_per_window(spark):
    df = user_sku(spark, [(day("2024-01-30"), 1, 1, 9, 2), (day("2024-01-30"), 1, 2, 9, 1), (day("2024-01-25"), 2, 1, 9, 1), (day("2024-01-02"), 3, 1, 9, 1)])
    names = spark.createDataFrame([(9, "tm9")], "id int, tm_name string")
    got = {r.recent_days: (r.order_count, r.order_user_count) for r in retail_ads.order_stats_by_brand(df, names, "2024-01-30").collect()}
    assert got == {1: (3, 1), 7: (4, 2), 30: (5, 3)}


def test_streak_buyers(spark):
    df = spark.createDataFrame([(1, day("2024-01-28")), (1, day("2024-01-29")), (1, day("2024-01-30")), (2, day("2024-01-28")), (2, day("2024-01-30")),
                                (3, day("2024-01-22")), (3, day("2024-01-23")), (3, day("2024-01-24"))], "user_id int, dt date")
    assert retail_ads.streak_buyers(df, "2024-01-30").first().order_continuously_user_count == 1


def test_user_change(spark):
    schema = "user_id string, login_date_last date, login_date_first date, login_count_td int"
    today = spark.createDataFrame([("gone", day("2024-01-23"), day("2024-01-01"), 1), ("back", day("2024-01-30"), day("2024-01-01"), 2), ("steady", day("2024-01-30"), day("2024-01-01"), 9)], schema)
    before = spark.createDataFrame([("gone", day("2024-01-23"), day("2024-01-01"), 1), ("back", day("2024-01-22"), day("2024-01-01"), 1), ("steady", day("2024-01-29"), day("2024-01-01"), 8)], schema)
    r = retail_ads.user_change(today, before, "20240130").first()
    assert (r.user_churn_count, r.user_back_count) == (1, 1)


def test_page_path_of_one_big_session(spark):
    base = dt.datetime(2024, 1, 1)
    docs = [("s", f"p{i % 3}", int((base + dt.timedelta(minutes=7 * i)).timestamp() * 1000)) for i in range(500)]
    pages = spark.createDataFrame(docs, "session_id string, page_id string, ts long")
    got = retail_ads.page_path(pages, None)
    assert got.count() == 500 and got.where("target = 'null'").count() == 1
    assert got.where("source = 'step-10:p0' and target = 'step-11:p1'").count() == 1


def test_log_decoding_and_routing(spark, rows):
    common = '"common":{"mid":"m1","uid":"u1","is_new":"1","sid":"s"}'
    text = [f'{{{common},"page":{{"page_id":"home"}},"displays":[{{"item":"1"}},{{"item":"2"}}],"actions":[{{"action_id":"a"}}],"ts":1}}',
            f'{{{common},"start":{{"entry":"icon"}},"ts":2}}', f'{{{common},"page":{{"page_id":"p"}},"err":{{"error_code":"1"}},"ts":3}}', "not json", "  ", None]
    df = spark.createDataFrame([(t,) for t in text], "log string")
    good, bad = logs.split_dirty(df)
    assert good.count() == 3 and bad.where("dirty_text = 'not json'").count() == 1
    assert logs.decode_clean(df).count() == 3
    assert rows(logs.route(good).groupBy("channel").count()) == [("action", 1), ("display", 2), ("err", 1), ("page", 2), ("start", 1)]
    assert logs.page_fields(good).count() == 2


def test_order_detail_defaults_and_unmatched(spark):
    d = day("2024-01-01")
    detail = spark.createDataFrame([("l1", 1, 7, at("2024-01-01 10:00:00"), 2, Decimal("3.50"), None, None, Decimal("7.00"), d)],
                                   "id string, order_id int, sku_id int, create_time timestamp, sku_num long, order_price decimal(16,2), split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2), split_total_amount decimal(16,2), dt date")
    orders = spark.createDataFrame([(2, 5, 6)], "id int, user_id int, province_id int")
    act = spark.createDataFrame([], "order_detail_id string, activity_id int, activity_rule_id int, dt date")
    cou = spark.createDataFrame([], "order_detail_id string, coupon_id int, dt date")
    r = retail_dwd.order_detail(detail, orders, act, cou).first()
    assert r.user_id is None and r.split_activity_amount == 0 and r.split_original_amount == Decimal("7.00")


def test_waybill_amount_counts_once_per_order(spark):
    from millrace.plans import logistics_dws

    detail = spark.createDataFrame([(1, Decimal("10.00"), day("2024-01-01")), (1, Decimal("10.00"), day("2024-01-01")), (2, Decimal("5.00"), day("2024-01-01"))], "order_id int, amount decimal(16,2), dt date")
    r = logistics_dws.dispatch_1d(detail).first()
    assert (r.order_count, r.order_amount) == (2, Decimal("15.00"))


def test_waybill_stages(spark):
    statuses = ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080", "60999"]
    cargo = spark.createDataFrame([(str(i), i, "70001", "2024-01-01T00:00:00Z", "0", day("2024-01-01")) for i in range(9)], "id string, order_id int, cargo_type string, create_time string, is_deleted string, dt date")
    cols = [c for c in logistics_dwd.ORDER_COLUMNS if c not in ("status", "estimate_arrive_time")]
    orders = spark.createDataFrame([(i, s, "0") for i, s in enumerate(statuses)], "id int, status string, is_deleted string").select(
        "*", *[F.lit("x").alias(c) for c in cols], F.lit(0).cast("bigint").alias("estimate_arrive_time"))
    count = {s: logistics_dwd.stage_rows(cargo, orders, s).count() for s in logistics_dwd.STAGES}
    assert count == {"order": 9, "pay_suc": 7, "cancel": 1, "receive": 6, "dispatch": 4, "bound_finish": 3, "deliver_suc": 2, "sign": 1}


def test_driver_split_halves_measures(spark):
    df = spark.createDataFrame([(7, 1, "A*", 2, "B*", 4, Decimal("10.01"), 5, 1), (7, 1, "A*", None, None, 1, Decimal("1.00"), 2, 0)],
                               "recent_days int, driver1_emp_id int, driver1_name string, driver2_emp_id int, driver2_name string, trans_finish_count long, trans_finish_distance decimal(16,2), trans_finish_dur_sec long, trans_finish_delay_count long")
    got = {r.driver_emp_id: (r.trans_finish_count, float(r.trans_finish_distance), float(r.trans_finish_dur_sec)) for r in logistics_ads.driver_stats(df, "2024-01-01").collect()}
    assert got == {1: (5, 6.005, 4.5), 2: (4, 5.005, 2.5)}


def test_product_day_does_not_fan_out(spark):
    """Three visits and two carts of one user on one day: measures must not multiply."""
    t = at("2024-01-10 10:00:00")
    names = "product_name string, category_id int, category_name string"
    n = ("p", 1, "c")
    visits = spark.createDataFrame([(1, 5, t, s, 0, *n) for s in (2, 4, 6)], f"product_id int, user_id int, visit_time timestamp, stay_seconds int, is_micro_detail int, {names}")
    favs = spark.createDataFrame([], f"product_id int, user_id int, fav_time timestamp, {names}")
    carts = spark.createDataFrame([(1, 5, 1, t, *n), (1, 5, 2, t, *n), (1, 6, 9, t, *n)], f"product_id int, user_id int, quantity int, cart_time timestamp, {names}")
    orders = spark.createDataFrame([(1, 5, 2, Decimal("20.00"), t, *n)], f"product_id int, user_id int, quantity int, order_amount decimal(16,2), order_time timestamp, {names}")
    pays = spark.createDataFrame([(1, 5, Decimal("20.00"), t, "NONE", *n)], f"product_id int, user_id int, pay_amount decimal(16,2), pay_time timestamp, activity_type string, {names}")
    refunds = spark.createDataFrame([], f"product_id int, user_id int, refund_amount decimal(16,2), refund_time timestamp, {names}")
    product = spark.createDataFrame([(1, "p", 1, "c")], f"product_id int, {names}")
    r = pe.product_day(visits, favs, carts, orders, pays, refunds, product).first()
    assert (r.uv, r.pv, r.cart_qty, r.order_qty, r.pay_amount, r.fav_users) == (1, 3, 3, 2, Decimal("20.00"), 0)
    assert (r.avg_stay_seconds, r.bounce_rate, r.item_unit_price, r.refund_amount) == (Decimal("4.00"), Decimal("0.3333"), Decimal("10.00"), None)
    u = pe.user_day(visits, favs, carts, orders, pays, refunds).first()
    assert (u.visit_products, u.pv, u.cart_count, u.total_pay_amount) == (1, 3, 1, Decimal("20.00"))


def test_star_repair_and_warning(spark):
    p = spark.createDataFrame([(1, 0), (2, 6), (3, None), (4, 2)], "product_id int, price_strength_star int")
    fixed = pricing.product_detail(p)
    assert [r.price_strength_star for r in fixed.orderBy("product_id").collect()] == [3, 3, 3, 2]
    conv = spark.createDataFrame([(1, "4.99%"), (1, "10.00%"), (2, "4.99%")], "product_id int, pay_conversion_rate string")
    out = {r.product_id: (r.is_price_warn, r.is_product_warn) for r in pricing.price_strength(fixed, conv, "2024-01-01").collect()}
    assert out == {1: (0, 0), 2: (0, 1), 3: (0, 0), 4: (1, 0)}


def test_activity_status_and_budget(spark):
    a = spark.createDataFrame([(1, at("2024-01-01 00:00:00"), at("2024-01-05 00:00:00"), 9, Decimal("-5.00")), (2, at("2024-02-10 00:00:00"), at("2024-02-10 00:00:00"), 9, Decimal("7.00")),
                               (3, at("2024-01-20 00:00:00"), at("2024-02-20 00:00:00"), None, None)],
                              "activity_id int, start_time timestamp, end_time timestamp, status int, budget decimal(15,2)").select("*", *[F.lit("x").alias(c) for c in ("activity_name", "activity_type", "channel")])
    got = {r.activity_id: (r.status, r.budget, r.duration_days, r.is_weekend_included) for r in marketing.activity_detail(a, "2024-01-30").collect()}
    assert got == {1: (2, Decimal("0.00"), 4, 0), 2: (0, Decimal("7.00"), 0, 1), 3: (None, None, 31, 1)}


def test_nd_summary_keeps_windows_apart(spark):
    rows = [(1, 1, "s", 1, "a", 2, "b", 3, "c", 4, "t", d, 1, 1, Decimal("1.00"), Decimal("0"), Decimal("0"), Decimal("1.00")) for d in (day("2024-01-30"), day("2024-01-10"))]
    daily = spark.createDataFrame(rows, f"user_id int, sku_id int, {SKU}, dt date, order_count_1d long, order_num_1d long, order_original_amount_1d decimal(16,2), activity_reduce_amount_1d decimal(16,2), coupon_reduce_amount_1d decimal(16,2), order_total_amount_1d decimal(16,2)")
    r = retail_dws.user_sku_order_nd(daily, "2024-01-30").first()
    assert (r.order_count_7d, r.order_count_30d, r.order_total_amount_7d) == (1, 2, Decimal("1.00"))


def test_calendar_holidays(spark):
    days = spark.createDataFrame([(day("2023-12-30"),), (day("2024-01-02"),)], "dt date")
    off = spark.createDataFrame([(day("2024-01-01"), "new year")], "date_id date, holiday_id string")
    got = {str(r.date_id): r.is_workday for r in dim_date(days, holidays=off).collect()}
    assert got == {"2023-12-30": 0, "2023-12-31": 0, "2024-01-01": 0, "2024-01-02": 1}
    assert dim_date(days.where("false")).count() == 0


def test_cuts_of_a_scope_are_emptied(spark):
    from millrace.sinks.workspace import cut, passing

    with passing(spark) as keep:
        inner = cut(spark.range(10).withColumnRenamed("id", "n"), "t-inner")
        result = keep(cut(inner.selectExpr("sum(n) AS s"), "t-result"))
        assert inner.count() == 10
    after = cut(spark.range(3), "t-after")
    assert result.first()["s"] == 45 and after.count() == 3
    assert spark.read.schema("n long").parquet(inner.cut_path).count() == 0


def test_orders_are_not_merged_into_few_tasks(spark, rows):
    """Each shuffle partition has its own task, and copies and null keys are one row per group."""
    from millrace.plans import logistics_dws
    some = [(k % 50, "a" if k % 3 else None, float(k % 7), day("2024-01-01")) for k in range(300)] + [
        (None, "b", None, None), (None, "b", 2.0, None), (1, "a", 9.0, None)]
    detail = spark.createDataFrame(some, "order_id long, cargo_type string, amount double, dt date")
    expected = {}
    for order, kind, amount, dt in some:
        best = expected.get((order, kind, dt))
        expected[order, kind, dt] = amount if best is None else max(best, amount)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        out = logistics_dws._orders(detail, "cargo_type")
        assert out.rdd.getNumPartitions() == 13
        assert {(r["order_id"], r["cargo_type"], r["dt"]): r["amount"] for r in out.collect()} == expected
        assert out.count() == len(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_price_trend_moves_each_day_once(spark):
    """No row is repeated for the days it is compared with; null days and products have no other day."""
    from decimal import Decimal
    from millrace.plans import product360
    some = [(1, "2023-01-01", "10.00"), (1, "2023-12-31", "20.00"), (1, "2024-01-01", "25.00"), (1, "2024-01-03", "5.00"),
            (2, "2024-01-01", "8.00"), (None, "2024-01-01", "1.00"), (None, "2024-01-02", "2.00"), (3, None, "4.00")]
    prices = spark.createDataFrame([(p, d and day(d), *[Decimal(x)] * 3) for p, d, x in some],
                                   "product_id long, dt date, avg_price decimal(20,2), min_price decimal(16,2), max_price decimal(16,2)")
    out = product360.price_trend(prices)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    got = {(r["product_id"], r["dt"] and str(r["dt"])): (r["yoy_change"], r["mom_change"]) for r in out.collect()}
    assert len(got) == len(some)
    assert got.pop((1, "2024-01-01")) == (Decimal("1.5000"), Decimal("0.2500"))
    assert set(got.values()) == {(None, None)}
