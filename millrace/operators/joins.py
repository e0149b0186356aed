"""Lookup, role, hierarchy and full outer joins.

No broadcast hints on tables that can grow: the planner broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution re-checks the real size and
splits hot keys; larger sides are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str], how: str = "left",
           **columns: str) -> DataFrame:
    """Join ``dim`` on ``{fact column: dim column}`` and add ``new_name=dim_column``."""
    keyed = dim.select(*[F.col(d).alias(f"_k_{i}") for i, d in enumerate(on.values())],
                       *[F.col(src).alias(f"_v_{name}") for name, src in columns.items()])
    cond = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"_k_{i}") for i, f in enumerate(on)])
    joined = fact.join(keyed, cond, how)
    kept = [c for c in fact.columns if c not in columns]
    return joined.select(*kept, *[F.col(f"_v_{n}").alias(n) for n in columns])


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on same-named keys where null meets null; the keys stay as on the left."""
    named = right.select(*[F.col(k).alias(f"_j_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    joined = left.join(named, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_j_{k}" for k in keys])


def role_names(fact: DataFrame, dic: DataFrame, roles: dict[str, str], code: str = "id",
               name: str = "name", how: str = "left") -> DataFrame:
    """One dictionary in several roles: ``{code column: name column}``."""
    out = fact
    for col, new in roles.items():
        out = lookup(out, dic, {col: code}, how, **{new: name})
    return out


def parent_of(child: DataFrame, parent_key: str, key: str, **columns: str) -> DataFrame:
    """Left self join to the parent row."""
    return lookup(child, child, {parent_key: key}, "left", **columns)


def region_path(df: DataFrame, region: DataFrame, district: str) -> DataFrame:
    """Roll a district up to city and province (ids and names)."""
    out = lookup(df, region, {district: "id"}, "left", city_id="parent_id")
    out = lookup(out, region, {"city_id": "id"}, "left", city_name="name", province_id="parent_id")
    return lookup(out, region, {"province_id": "id"}, "left", province_name="name")


def level_region(df: DataFrame, region: DataFrame, region_id: str, level: str) -> DataFrame:
    """City and province of a station: level-1 stations sit in a city, others in a district."""
    out = lookup(df, region, {region_id: "id"}, "left", _n1="name", _p1="parent_id")
    out = lookup(out, region, {"_p1": "id"}, "left", _n2="name", _p2="parent_id")
    out = lookup(out, region, {"_p2": "id"}, "left", _n3="name")
    top = F.col(level) == 1
    out = (out.withColumn("city_id", F.when(top, F.col(region_id)).otherwise(F.col("_p1")))
           .withColumn("city_name", F.when(top, F.col("_n1")).otherwise(F.col("_n2")))
           .withColumn("province_id", F.when(top, F.col("_p1")).otherwise(F.col("_p2")))
           .withColumn("province_name", F.when(top, F.col("_n2")).otherwise(F.col("_n3"))))
    return out.drop("_n1", "_p1", "_n2", "_p2", "_n3")


def full_outer(sides: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of aggregated sides on coalesced keys; null keys match each other.

    Union of the sides and one aggregate per key: each side holds at most one row per key,
    so this equals the chained join and needs one shuffle.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    values = [c for c in union.columns if c not in keys]
    return union.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def side_by_side(metrics: dict[str, DataFrame]) -> DataFrame:
    """Scalar metrics next to each other; each frame has one row and one column."""
    rows = [df.select(F.lit(name).alias("metric"), F.col(df.columns[0]).cast("bigint").alias("value"))
            for name, df in metrics.items()]
    union = reduce(DataFrame.unionByName, rows)
    return union.agg(*[F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name)
                       for name in metrics])


def key_flag(df: DataFrame, events: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """1 if a matching event exists, else 0; events are reduced to distinct keys first."""
    hits = events.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return (df.join(hits, keys, "left")
            .withColumn(flag, F.coalesce("_hit", F.lit(0))).drop("_hit"))



def coalesced(*cols: str) -> Column:
    return F.coalesce(*[F.col(c) for c in cols])
