"""From raw documents to shuffled training shards, one stage per operator.

Every stage gets the documents that the one before kept, written as Parquet and read again, and all but
the last return the columns of ``documents``. An empty table passes through all stages; NULL and empty
texts are clean, distinct from each other, and carry no tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, jaccard, mixing, sharding, toxicity
from corpusloom.settings import ship, written

SHARDS = 24
SEED = 20240607
#: Weights of the mixture's tree: languages by demand, everything else alike.
WEIGHTS = {("*", "en"): 6, ("*", "de"): 2, ("*", "fr"): 2, ("*", "es"): 2}
EPOCHS = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below one half."""
    ship(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8 or more)."""
    ship(spark)
    return jaccard.without_near_copies(docs, size=5, num=4, den=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as came in, shared out by the weights; scarce leaves repeat up to EPOCHS times."""
    ship(spark)
    leaves = mixing.plan(docs, WEIGHTS, (1, 1), EPOCHS, SEED)
    return mixing.mixed(docs, leaves, SEED).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    ship(spark)
    return sharding.shuffled(docs, [F.col("doc_id"), F.xxhash64("text")], SHARDS, SEED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard_rows),
]

#: SQL cannot express the trained toxicity model. The operators have tests against brute force; of the chain the
#: tests compare counts and repeated runs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
