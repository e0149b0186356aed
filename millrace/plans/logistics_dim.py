"""Logistics dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import OPEN_DATE, epoch_day_to_date, repair_iso_text
from millrace.functions.text import masked_email, masked_phone
from millrace.operators.joins import lookup, parent_of, role_names


def dim_complex(complexes: DataFrame, region: DataFrame, couriers: DataFrame) -> DataFrame:
    """Complex with province and city (both must exist) and its couriers as a sorted id array."""
    out = lookup(complexes, region, {"province_id": "id"}, "inner", province_name="name")
    out = lookup(out, region, {"city_id": "id"}, "inner", city_name="name")
    staff = (couriers.select("complex_id", F.col("courier_emp_id").cast("string").alias("emp")).distinct()
             .groupBy("complex_id").agg(F.array_sort(F.collect_list("emp")).alias("emps")))
    return lookup(out, staff, {"id": "complex_id"}, courier_emp_ids="emps")


def dim_organ(organ: DataFrame, region: DataFrame) -> DataFrame:
    out = lookup(organ, region, {"region_id": "id"}, region_name="name", region_code="dict_code")
    return lookup(out, organ, {"org_parent_id": "id"}, org_parent_name="org_name")


def dim_region(region: DataFrame) -> DataFrame:
    return region.select("id", "parent_id", "name", "dict_code", "short_name")


def dim_express_courier(courier: DataFrame, organ: DataFrame, dic: DataFrame) -> DataFrame:
    out = lookup(courier, organ, {"org_id": "id"}, "inner", org_name="org_name")
    out = lookup(out, dic, {"express_type": "id"}, "inner", express_type_name="name")
    return out.withColumn("working_phone", F.md5("working_phone"))


def dim_shift(shift: DataFrame, line: DataFrame, dic: DataFrame) -> DataFrame:
    out = lookup(shift, line, {"line_id": "id"}, "inner", line_name="name", line_no="line_no", line_level="line_level",
                 org_id="org_id", transport_line_type_id="transport_line_type_id", start_org_id="start_org_id",
                 end_org_id="end_org_id", distance="distance", estimated_time="estimated_time")
    return lookup(out, dic, {"transport_line_type_id": "id"}, "inner", transport_line_type_name="name")


def dim_truck_driver(driver: DataFrame, organ: DataFrame, team: DataFrame) -> DataFrame:
    out = lookup(driver, organ, {"org_id": "id"}, "inner", org_name="org_name")
    return lookup(out, team, {"team_id": "id"}, "inner", team_name="name")


def dim_truck(truck: DataFrame, team: DataFrame, model: DataFrame, organ: DataFrame, dic: DataFrame) -> DataFrame:
    out = lookup(truck, team, {"team_id": "id"}, "inner", team_name="name", team_no="team_no", org_id="org_id")
    out = lookup(out, model, {"truck_model_id": "id"}, "inner", truck_model_name="model_name",
                 truck_model_type="model_type", truck_brand="brand", load_weight="load_weight")
    out = lookup(out, organ, {"org_id": "id"}, "inner", org_name="org_name")
    out = role_names(out, dic, {"truck_model_type": "truck_model_type_name", "truck_brand": "truck_brand_name"}, how="inner")
    return out.withColumn("truck_no", F.md5("truck_no"))


def dim_user_zip(users: DataFrame) -> DataFrame:
    return users.select(
        "id", "login_name", F.md5("passwd").alias("passwd"), F.md5("name").alias("real_name"),
        masked_phone(F.col("phone_num")).alias("phone_num"), masked_email(F.col("email")).alias("email"),
        "user_level", epoch_day_to_date(F.col("birthday")).alias("birthday"), "gender",
        F.to_date("create_time").alias("start_date"), F.lit(OPEN_DATE).alias("end_date"))


def dim_user_address_zip(address: DataFrame) -> DataFrame:
    return address.select(
        "id", "user_id", masked_phone(F.col("phone")).alias("phone"), "province_id", "city_id", "is_default",
        repair_iso_text(F.col("create_time")).alias("start_date"), F.lit(OPEN_DATE).alias("end_date"))
