"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose data and cores.
Names given as arguments replace the headline list. Every query runs to completion into a
no-op sink, so all its rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "retail_dwd_trade_order_detail",
    "retail_dws_trade_user_sku_order_1d",
    "retail_dws_trade_user_order_td",
    "retail_ads_order_stats_by_tm",
    "retail_ads_page_path",
    "retail_ads_traffic_stats_by_channel",
    "retail_ads_user_retention",
    "logistics_dwd_trade_order_process",
    "logistics_dws_trans_org_receive_1d",
    "logistics_ads_city_stats",
    "logistics_ads_express_org_stats",
    "product_events_dws_product_day",
    "product360_ads_price_trend",
    "marketing_ads_activity_ranking",
    "related_dws_behavior_sequence",
    "retract_on_duplicate",
    "province_order_windows",
    "comment_moderation",
    "keyword_counts_documents",
    "vehicle_track_length",
    "label_final",
    "stream_traffic_windows",
    "stream_dwd_order_detail",
    "stream_province_orders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from millrace.registry import load
    from millrace.session import local_session

    spark = local_session(cpus, "millrace-bench")
    queries = load()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
