"""Re-extraction when new catalog pages land: the batch run, called per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import domains, incremental, infer
from ..plans.extract import extract_domain
from ..settings import ExtractionConfig
from ..sources import landed, tables


def read_pages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed pages as a stream of ``path, value``; numbers are given within each micro-batch (``watch``) or
    go on from batch to batch (``follow``)."""
    rows = spark.readStream.format("text").option("wholetext", "true")
    if files_per_batch is not None:
        rows = rows.option("maxFilesPerTrigger", files_per_batch)
    rows = rows.load(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), "value")


def watch(
    spark: SparkSession,
    name: str,
    path: str,
    out: str,
    backend: infer.Factory,
    config: ExtractionConfig | None = None,
    judge: infer.Factory | None = None,
) -> StreamingQuery:
    """Extract every page that has not been seen, once, then stop.

    Pairs and the next cache snapshot go to folders named by the batch number, so a batch that is
    repeated after a failure writes the same folders again and starts from the same older cache.
    """
    spec = domains.REGISTRY[name]

    def one_batch(pages: DataFrame, batch: int) -> None:
        cache = tables.load_cache(spark, f"{out}/cache/{batch - 1}" if batch else None)
        items = landed.explode_items(landed.numbered(pages), spec.item_type, spec.list_keys)
        result = extract_domain(spec, items, backend, config, judge=judge, cache=cache)
        result.pairs.write.mode("overwrite").parquet(f"{out}/pairs/{batch}")
        merged = incremental.upsert(cache, result.written)
        merged.write.mode("overwrite").parquet(f"{out}/cache/{batch}")

    return (
        read_pages(spark, path)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .start()
    )
