"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB equivalent (None -> rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def finish(df: DataFrame, digits: int | None = None, keep: tuple = ()) -> DataFrame:
    """Decimals -> double; doubles rounded to ``digits`` (engines differ in the last bits
    of floating sums, so compared outputs are rounded the same way on both sides)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            out.append(c)
            continue
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
            if digits is not None:
                c = F.round(c, digits)
        elif isinstance(f.dataType, DoubleType) and digits is not None:
            c = F.round(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)
