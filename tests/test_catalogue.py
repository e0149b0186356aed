"""Registered queries against their SQL checks."""

import os

import pytest

from conftest import SMALL
from millrace.registry import load
from millrace.sources.model import TABLES

ALL = os.environ.get("MILLRACE_ALL") == "1"
SAMPLE = [
    "retail_dim_sku", "retail_dim_user_zip", "retail_dwd_trade_order_detail", "retail_dwd_user_login", "retail_dws_trade_user_sku_order_nd",
    "retail_ads_page_path", "retail_ads_order_stats_by_tm", "retail_ads_user_retention", "logistics_dim_complex", "logistics_dwd_trade_order_process",
    "logistics_dws_trans_org_receive_1d", "logistics_ads_city_stats", "logistics_ads_driver_stats", "logistics_ads_express_org_stats",
    "product_events_dws_product_day", "product_events_ads_product_week", "pricing_ads_product_ranking", "product360_ads_price_trend",
    "product360_ads_product_360", "marketing_ads_activity_ranking", "marketing_ads_segment_value", "related_ads_top_guide_product", "new_products_ads_info",
    "board_top50_visitors", "province_order_windows", "comment_moderation_long_list", "keyword_counts_documents", "vehicle_track_length", "label_final",
    "stream_log_split", "stream_dwd_payment", "stream_province_orders", "sink_append_report", "scan_tab_separated",
    "vehicle_track_length_geodesic", "keyword_dictionary_parts", "stream_monotonous_windows", "stream_label_final",
]


@pytest.fixture(scope="session")
def con():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(n for n, q in load().items() if q.check) if ALL else SAMPLE)
def test_query_matches_sql(spark, con, name):
    q = load()[name]
    out = q.run(spark, SMALL)
    result = con.execute(q.sql())
    assert [d[0] for d in result.description] == out.columns
    assert ordered(out.collect()) == ordered(result.fetchall())


def test_contract():
    import __spark_entry__ as entry

    queries, checks = entry.queries(), entry.oracle_sql()
    assert set(checks) <= set(queries) and len(queries) > 200
    assert set(load()) <= set(checks)


def test_date_filter_reaches_the_scan(spark):
    """The flagship report reads only the last thirty days of lines and only the columns it needs."""
    plan = load()["retail_ads_order_stats_by_tm"].run(spark, SMALL)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate,2001-07-03" in plan
    assert "l_extendedprice" not in plan.split("== Physical Plan ==")[1]


def test_brand_report_reads_part_for_brands_and_names_only(spark):
    plan = load()["retail_ads_order_stats_by_tm"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4 and plan.count("p_brand") > 0 and "p_size" not in plan  # lines, orders, brands, names


def test_price_trend_summarises_once(spark):
    plan = load()["product360_ads_price_trend"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan parquet") == 1


def test_top_n_cuts_before_the_shuffle(spark):
    plan = load()["board_top50_cart"].run(spark, SMALL)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
