"""Run settings and the Spark session the jobs expect."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ExtractionConfig:
    """Knobs of one extraction run. ``program`` is the catalog owner named in prompts and comparison texts."""

    max_entities: int | None = None
    max_tokens: int = 2048
    max_detail_items: int = 5
    no_judge: bool = False
    entity_ids: tuple[str, ...] | None = None
    program: str = "catalog"
    #: comparisons count an entity once per group
    distinct: bool = False

    @classmethod
    def from_env(cls, **overrides) -> ExtractionConfig:
        cap = os.getenv("EXTRACT_MAX_ENTITIES")
        values = {"max_entities": int(cap) if cap else None}
        values.update({k: v for k, v in overrides.items() if v is not None})
        return cls(**values)


def build_session(app: str = "corpusloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # prompts are long rows: keep Arrow batches for the inference stage small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.ui.enabled": "false",
    }
    defaults.update(conf)
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the Python workers (for sessions not started with ``--py-files``)."""
    context = spark.sparkContext
    if not any("corpusloom" in f for f in context.listFiles):
        package = os.path.dirname(os.path.abspath(__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="ship-"), "corpusloom")
        context.addPyFile(
            shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
        )
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the session's setting, or a test folder in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-checkpoint-"))
    return context.getCheckpointDir()


def stable(df: DataFrame) -> DataFrame:
    """Keep ``df`` reliably with its partitions, so that a lost executor never repeats model calls
    and later calls stay spread over as many tasks."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Keep ``df`` as a columnar table in the shared folder: for frames with several readers that
    need different columns of it. It is read by ``spark``, where that is another session than the frame's
    (micro-batches have one of their own)."""
    spark = spark or df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
