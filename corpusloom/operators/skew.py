"""Joins and rankings that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..settings import written

# A key counts as hot above 1/HOT_SHARE of the rows looked at, so there are never more than
# HOT_SHARE hot keys: the list of hot keys has a proven bound and may be broadcast.
HOT_SHARE = 10_000
HOT_FLOOR = 500_000
HOT_LOOK = 64


def hot_keys(
    facts: DataFrame,
    keys: list[str],
    spread: list[str],
    floor: int = HOT_FLOOR,
    look: int = HOT_LOOK,
    keep: bool = False,
) -> DataFrame | None:
    """Keys that hold a large share of ``facts``, each with the number of slices it is cut into;
    None when there are none.

    Sizes are estimated on the rows whose ``spread`` hash falls in one of ``look`` classes, from the
    key columns alone. The estimate only decides how rows are balanced, never which rows are in
    the result. The list is fixed before the join is planned, so both sides see the same one. With
    ``keep`` the counts stay on disk until the list is made, for ``facts`` that are costly to evaluate a second time.
    """
    seen = facts.where(F.pmod(F.xxhash64(*spread), F.lit(look)) == 0).select(*keys)
    counts = seen.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if keep:
        counts = counts.persist(StorageLevel.DISK_ONLY)
    # most frequent first; any key beyond the first HOT_SHARE has a smaller share than 1/HOT_SHARE
    large = counts.where(F.col("_n") * look >= floor).orderBy(F.desc("_n")).limit(HOT_SHARE).collect()
    total = counts.agg(F.sum("_n")).first()[0] if large else 0
    if keep:
        counts.unpersist()
    hot = [(*row[:-1], -(-row["_n"] * HOT_SHARE // total)) for row in large if row["_n"] * HOT_SHARE > total]
    if not hot:
        return None
    fields = ", ".join(f"`{k}` {counts.schema[k].dataType.simpleString()}" for k in keys)
    return facts.sparkSession.createDataFrame(hot, f"{fields}, _slices int")


def lookup_join(
    facts: DataFrame,
    keyed: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "left",
    floor: int = HOT_FLOOR,
    look: int = HOT_LOOK,
) -> DataFrame:
    """Join ``facts`` to a side that has one row per key, with hot keys cut into slices.

    Without hot keys this is a plain join. Otherwise rows of a hot key get a slice number from the
    hash of ``spread``, and its one row on the keyed side is repeated once per slice; all other
    keys have the single slice 0. At most 2 * HOT_SHARE rows are added on the keyed side.
    """
    hot = hot_keys(facts, keys, spread, floor, look)
    if hot is None:
        return facts.join(keyed, keys, how)
    hot = F.broadcast(hot)
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left = (
        facts.join(hot, keys, "left")
        .withColumn("_slice", F.pmod(F.xxhash64(*spread), slices).cast("int"))
        .drop("_slices")
    )
    right = (
        keyed.join(hot, keys, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return left.join(right, [*keys, "_slice"], how).drop("_slice")


def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Exact 1-based position of every row in its group and the group size, without giving any
    task a whole group.

    Rows are range-partitioned on (group, order), so a big group is spread over many tasks. The
    laid-out rows are written once; the number of rows before a slice is a running sum over one
    small row per (group, slice). ``order`` must be unique within a group.
    """
    laid = written(
        df.repartitionByRange(*[F.col(c) for c in [*group, *order]])
        .sortWithinPartitions(*group, *order)
        .withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_row", 33))
    lengths = laid.groupBy(*group, "_slice").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_len")
    )
    whole = W.partitionBy(*group)
    before = whole.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = lengths.select(
        *group,
        "_slice",
        "_first",
        F.coalesce(F.sum("_len").over(before), F.lit(0)).alias("_before"),
        F.sum("_len").over(whole).alias("members"),
    )
    return laid.join(starts, [*group, "_slice"]).select(
        *df.columns,
        "members",
        (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias("position"),
    )
