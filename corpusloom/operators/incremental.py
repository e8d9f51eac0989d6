"""Change detection by content hash, replay of kept pairs, and the cache upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.structured import content_hash, short_hash
from .skew import lookup_join

KEY = ["domain", "entity_id"]


def with_hash(entities: DataFrame, column: str = "entity") -> DataFrame:
    """Adds ``full_hash`` (compared) and ``source_hash`` (short form, kept with the pairs)."""
    full = content_hash(F.col(column), entities.schema[column].dataType)
    return entities.withColumn("full_hash", full).withColumn(
        "source_hash", short_hash(F.col("full_hash"))
    )


def plan(entities: DataFrame, cache: DataFrame, unique: bool = False) -> DataFrame:
    """Current entities with ``hit`` (hash equal) and ``reuse`` (hit and pairs are there).

    ``cache`` has one row per (domain, entity_id); an entity id that repeats very often in the
    current data is looked up in slices. ``unique`` says that ids cannot repeat.
    """
    known = cache.select(*KEY, F.col("full_hash").alias("_known"), F.col("pairs").alias("cached_pairs"))
    if unique:
        joined = entities.join(known, KEY, "left")
    else:
        joined = lookup_join(entities, known, KEY, ["ordinal"])
    hit = F.coalesce(F.col("full_hash") == F.col("_known"), F.lit(False))
    reuse = hit & (F.coalesce(F.size("cached_pairs"), F.lit(0)) > 0)
    return joined.withColumn("hit", hit).withColumn("reuse", reuse).drop("_known")


def replay(planned: DataFrame) -> DataFrame:
    """Kept pairs of the unchanged entities, in their kept order."""
    return (
        planned.where("reuse")
        .select(*KEY, "ordinal", F.posexplode("cached_pairs").alias("_at", "pair"))
        .select(F.col("ordinal"), F.col("_at").alias("sub"), "pair.*")
    )


def to_generate(planned: DataFrame) -> DataFrame:
    return planned.where(~F.col("reuse")).drop("cached_pairs", "hit", "reuse")


def upsert(cache: DataFrame, written: DataFrame) -> DataFrame:
    """New snapshot: keys written in this run replace their old entry, the others stay.

    ``written`` has ``ordinal``, distinct within a key; of several writes to one key the last wins. Only
    the written keys are aggregated (a hash aggregate of the ordinal); kept entries pass through an
    anti join untouched.
    """
    fields = ["hash", "full_hash", "pairs"]
    new = written.select(*KEY, *fields, F.coalesce(F.col("ordinal").cast("bigint"), F.lit(0)).alias("_at"))
    last = new.groupBy(*KEY).agg(F.max("_at").alias("_at"))
    kept = cache.join(last, KEY, "left_anti").select(*KEY, *fields)
    return kept.unionByName(new.join(last, [*KEY, "_at"]).select(*KEY, *fields))


def cache_stats(planned: DataFrame) -> DataFrame:
    """Hits and misses; an equal hash is a hit also when no pairs were kept."""
    return planned.agg(
        F.count_if(F.col("hit")).alias("hits"), F.count_if(~F.col("hit")).alias("misses")
    )
