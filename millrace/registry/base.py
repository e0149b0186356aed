"""Query registration: name, column contract, Spark callable, SQL check."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import configure
from millrace.sources.model import RAW, TABLES, Model

# One letter per output type: string (dates as yyyy-MM-dd), seconds timestamp text, bigint, double.
_SPARK: dict[str, Callable[[str], Column]] = {
    "s": lambda c: F.col(c).cast("string"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    "i": lambda c: F.col(c).cast("bigint"),
    "d": lambda c: F.col(c).cast("double"),
    "f": lambda c: F.round(F.col(c).cast("double"), 6),
}
_SQL = {
    "s": 'CAST("{0}" AS VARCHAR)',
    "t": "strftime(\"{0}\", '%Y-%m-%d %H:%M:%S')",
    "i": 'CAST("{0}" AS BIGINT)',
    "d": 'CAST("{0}" AS DOUBLE)',
    "f": 'round(CAST("{0}" AS DOUBLE), 6)',
}


@dataclass
class Query:
    name: str
    columns: dict[str, str]
    build: Callable[[Model], DataFrame]
    check: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        model = Model(configure(spark), sf_dir)
        out = self.build(model)
        return out.select(*[_SPARK[k](c).alias(c) for c, k in self.columns.items()])

    def sql(self) -> str | None:
        if self.check is None:
            return None
        cols = ", ".join(f'{_SQL[k].format(c)} AS "{c}"' for c, k in self.columns.items())
        return f"WITH {shared(self.check)}result_rows AS (\n{self.check.strip()}\n)\nSELECT {cols} FROM result_rows"


QUERIES: dict[str, Query] = {}
SHARED: dict[str, str] = {}


def query(name: str, columns: str, check: str | None = None):
    """Decorator: ``columns`` is ``"name:type ..."``; the function takes the model."""
    spec = dict(part.split(":") for part in columns.split())

    def keep(fn: Callable[[Model], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, spec, fn, check)
        return fn

    return keep


def share(name: str, text: str) -> None:
    """Named building block for SQL checks."""
    SHARED[name] = text


def _plain(name: str) -> str:
    """SQL of a raw-layer table or a shared block, with plain table names."""
    if name in RAW:
        text = RAW[name].replace("EPOCH_MS(", "epoch_ms(").replace("EACH_TOKEN(", "unnest(string_split(")
        return text.format(**{t: t for t in (*TABLES, *RAW)})
    return SHARED[name]


def shared(text: str) -> str:
    """``name AS (...), `` list of every block the text uses, dependencies first."""
    order: list[str] = []

    def visit(body: str) -> None:
        for word in dict.fromkeys(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", body)):
            if (word in RAW or word in SHARED) and word not in order and word not in open_names:
                open_names.add(word)
                visit(_plain(word))
                order.append(word)

    open_names: set[str] = set()
    visit(text)
    return "".join(f"{n} AS (\n{_plain(n).strip()}\n), " for n in order)


def ratio(a: str, b: str, scale: int = 4) -> str:
    """Exact half-up quotient of two non-negative integer expressions."""
    p = 10 ** scale
    return (f"(CAST((2 * {p} * CAST({a} AS HUGEINT) + CAST({b} AS HUGEINT)) // "
            f"nullif(2 * CAST({b} AS HUGEINT), 0) AS DOUBLE) / {p})")


def money_ratio(a: str, b: str, scale: int = 2) -> str:
    """Exact quotient where the numerator is non-negative money with two decimals and b an integer."""
    return ratio(f"(({a}) * 100)", f"(({b}) * 100)", scale)


def signed_ratio(a: str, b: str, scale: int = 4) -> str:
    """Exact half-up (away from zero) quotient; the numerator may be negative."""
    return f"(CASE WHEN ({a}) < 0 THEN -{ratio(f'abs({a})', b, scale)} ELSE {ratio(a, b, scale)} END)"
