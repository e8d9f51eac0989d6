"""Registry of the check queries and small helpers for both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def joined(c: str, sep: str = "|") -> Column:
    return F.array_join(F.col(c), sep).alias(c.split(".")[-1])


WS = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_html_sql(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '{WS}+', ' ', 'g'))"


def slug_sql(c: str) -> str:
    return f"left(trim(regexp_replace(lower({c}), '[^a-z0-9]+', '_', 'g'), '_'), 30)"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"
