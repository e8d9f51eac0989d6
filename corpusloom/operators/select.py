"""Row selection: required fields, allow-list, keep-first, first-N, last write per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .skew import lookup_join

INLINE_IDS = 1_000


def present(*columns: str) -> Column:
    keep = F.lit(True)
    for name in columns:
        keep = keep & (F.coalesce(F.col(name).cast("string"), F.lit("")) != "")
    return keep


def required_fields(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(present(*columns))


def allow_list(df: DataFrame, ids: Sequence[str] | DataFrame | None, column: str = "entity_id") -> DataFrame:
    """Keep the listed ids (exact text match); None keeps everything."""
    if ids is None:
        return df
    if not isinstance(ids, DataFrame):
        if len(ids) <= INLINE_IDS:
            return df.where(F.col(column).isin(list(ids)))
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], f"{column} string")
    wanted = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
    # one row per id on the right, so the inner join keeps rows as they are; ids may repeat on the left
    spread = ["ordinal"] if "ordinal" in df.columns else df.columns
    return lookup_join(df, wanted, [column], spread, how="inner").select(*df.columns)


def keep_first(df: DataFrame, key: Column | str, order: str = "ordinal") -> DataFrame:
    """First row per key in arrival order. The ``= 1`` filter is applied before the shuffle too,
    so one key with very many copies sends one row per input task."""
    key = F.col(key) if isinstance(key, str) else key
    ranked = df.withColumn("_key", key)
    ranked = ranked.withColumn("_n", F.row_number().over(W.partitionBy("_key").orderBy(order)))
    return ranked.where(F.col("_n") == 1).drop("_n", "_key")


def first_n(df: DataFrame, n: int | None, order: str = "ordinal") -> DataFrame:
    return df if n is None else df.orderBy(order).limit(n)


def last_write(df: DataFrame, key: str = "entity_id", order: str = "ordinal") -> DataFrame:
    """One row per id: the values of the last write, at the arrival position of the first."""
    values = [c for c in df.columns if c not in (key, order)]
    merged = df.groupBy(key).agg(
        F.min(order).alias(order),
        F.max_by(F.struct(*values), F.col(order)).alias("_last"),
    )
    return merged.select(key, order, *[F.col("_last")[c].alias(c) for c in values])
