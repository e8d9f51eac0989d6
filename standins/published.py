"""Live records, archive and cache after one committed run, read back through the version in force."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.functions.structured import short_hash
from corpusloom.operators import incremental
from corpusloom.plans import publish
from corpusloom.settings import checkpoint_dir

from .base import ORACLE, query
from .corpus import incoming_pairs, live_records
from .texts import kept_pairs, old_cache, planned


def new_store(spark):
    return publish.open_store(spark, f"{checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}", buckets=8)


def pushed(spark, sf):
    """The live records of the tables, then a push under one name, called twice: it must count once."""
    store = new_store(spark)
    store.load("before", live=live_records(spark, sf))
    incoming = incoming_pairs(spark, sf)
    publish.publish_run(store, "push", incoming)
    publish.publish_run(store, "push", incoming)
    return store


@query("published_live", ORACLE["review_replace"])
def published_live(spark, sf):
    return pushed(spark, sf).read("live").select("id", "source_ref", "question", "answer")


@query("published_archive", ORACLE["review_archive"])
def published_archive(spark, sf):
    return pushed(spark, sf).read("archive").select(
        "source_ref", "question", "answer", "annotation_depth", "replaced_reason", F.size("responses").cast("bigint").alias("responses")
    )


@query("published_cache", ORACLE["cache_upsert"])
def published_cache(spark, sf):
    store = new_store(spark)
    store.load("before", cache=old_cache(spark, sf))
    entries = incremental.to_generate(planned(spark, sf)).select(
        "domain",
        "entity_id",
        "ordinal",
        short_hash(F.col("full_hash")).alias("hash"),
        "full_hash",
        F.slice(kept_pairs(F.col("entity_id")), 1, 1).alias("pairs"),
    )
    publish.publish_run(store, "run", entries=entries)
    return store.read("cache").select("entity_id", "hash", F.size("pairs").cast("bigint").alias("pairs"))
