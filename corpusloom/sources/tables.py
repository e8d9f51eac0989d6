"""Readers and writers of the kept records: pair files (JSON lines) and snapshot tables."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CACHE, PAIR, PAIR_FIELDS, assert_valid

PAIR_FILE = "qa_pairs.jsonl"
COMBINED_FILE = "combined_qa_pairs.jsonl"


def pair_line(pairs: DataFrame) -> Column:
    """One JSON line per pair: NULL fields written, ``source_data`` as an object."""
    meta = F.col("metadata").withField("source_data", F.try_parse_json("metadata.source_data"))
    fields = [F.col(c) for c in PAIR_FIELDS if c != "metadata"] + [meta.alias("metadata")]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def write_pairs(pairs: DataFrame, path: str) -> str:
    pairs.select(pair_line(pairs).alias("value")).write.mode("overwrite").text(path)
    return path


def write_by_source(pairs: DataFrame, directory: str, source_key: str = "source_key") -> str:
    """One folder of JSON lines per source in a single pass; sources without pairs get none."""
    lines = pairs.select(pair_line(pairs).alias("value"), F.col(source_key).alias("source_key"))
    lines.write.mode("overwrite").partitionBy("source_key").text(directory)
    return directory


def write_all(by_source: dict[str, DataFrame], directory: str) -> str:
    return write_by_source(union_sources(by_source), directory)


def write_combined(by_source: dict[str, DataFrame], directory: str, name: str = COMBINED_FILE) -> str:
    return write_pairs(union_sources(by_source), f"{directory.rstrip('/')}/{name}")


def union_sources(by_source: dict[str, DataFrame]) -> DataFrame:
    """All sources below each other, tagged with ``source_key``."""
    frames = [df.withColumn("source_key", F.lit(key)) for key, df in by_source.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def load_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pair files, one or many; blank lines are skipped, a bad line or value fails the job."""
    rows = spark.read.schema(PAIR).option("mode", "FAILFAST").json(path)
    return assert_valid(rows)


def empty_cache(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CACHE)


def load_cache(spark: SparkSession, path: str | None, on_corrupt: str = "raise") -> DataFrame:
    """Cache snapshot, or an empty one when the path is absent. Other errors, such as a storage or
    permission error, are raised: taking them for an empty cache would drop every kept entry. With
    ``on_corrupt='empty'`` a path that is there but not readable as a snapshot is empty, too."""
    if path is None:
        return empty_cache(spark)
    columns = ["domain", "entity_id", "hash", "full_hash", "pairs"]
    try:
        return spark.read.parquet(path).select(*columns)
    except AnalysisException as error:
        absent = error.getCondition() == "PATH_NOT_FOUND"
        if absent or on_corrupt == "empty":
            return empty_cache(spark)
        raise
    except (PySparkException, Py4JJavaError):
        if on_corrupt == "empty":
            return empty_cache(spark)
        raise


def write_snapshot(df: DataFrame, root: str) -> str:
    """A new immutable snapshot folder; readers switch to it when the job has finished."""
    path = f"{root.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path
