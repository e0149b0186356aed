"""Shared working folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
#: Cuts that the open scopes have made.
_SCOPES: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``; a scratch one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    for scope in _SCOPES:
        scope.append(path)
    return out


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Cuts made inside are emptied at the end, but for those that are passed to the function this gives.

    For steps whose result is written before the scope ends; frames that read emptied cuts give no rows.
    """
    made: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.cut_path)
        return df

    _SCOPES.append(made)
    try:
        yield keep
    finally:
        _SCOPES.remove(made)
        for path in made:
            if path not in kept:
                spark.range(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
