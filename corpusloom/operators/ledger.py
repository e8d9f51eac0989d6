"""A ledger of model answers, so that no answered prompt is ever asked again.

Answers are kept under the hash of their prompt. A run asks only what the ledger lacks (an anti join) and
writes through a Python data source whose tasks append every answer to a file of their own at once. A
task that is started again after its executor was lost first reads what its earlier attempts left and goes
on behind it; a job that fails as a whole leaves its answers to the next run. So a loss costs the call that
was open, nothing else. Failed calls are kept too, as errors, and are tried again by the next run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..settings import written
from .skew import lookup_join

LINE = "key string, text string, error string"
#: Answers in one file. On file systems that show a file only when it is closed (object stores), so many
#: calls at most are repeated.
SEGMENT = 64

Factory = Callable[[], Callable[[str, str, int], str]]


@dataclass
class Asked(WriterCommitMessage):
    """What one task did: partition, calls made, answers found from an earlier attempt, failed calls."""

    part: int
    calls: int
    found: int
    failed: int


def opened(uri: str):
    """File system and path of a folder that all executors share: local mount, HDFS or object store."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def kept_keys(files, folder: str) -> set[str]:
    """Keys answered in the files of ``folder``; a last line that was cut is not an answer."""
    from pyarrow import fs

    keys = set()
    for info in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if not info.path.endswith(".jsonl"):
            continue
        with files.open_input_stream(info.path) as lines:
            for line in lines.read().split(b"\n"):
                try:
                    answer = json.loads(line)
                except ValueError:
                    continue
                if answer["error"] is None:
                    keys.add(answer["key"])
    return keys


def answer_rows(rows: Iterator, folder: str, part: int, factory: Factory, max_tokens: int, segment: int = SEGMENT) -> Asked:
    """The work of one task: ask every row (key, system, user) that no earlier attempt of the same part has
    answered, and append the answer before the next call."""
    files, base = opened(folder)
    own = f"{base}/part={part:06d}"
    done = kept_keys(files, own)
    files.create_dir(own, recursive=True)
    told = Asked(part, 0, 0, 0)
    call = out = None
    try:
        for row in rows:
            key, system, user = row
            if key in done:
                told.found += 1
                continue
            call = call or factory()
            text = error = None
            try:
                text = call(system, user, max_tokens)
            except Exception as problem:  # noqa: BLE001 - any backend failure is per row
                error = f"{type(problem).__name__}: {problem}"
                told.failed += 1
            if out is None:
                out = files.open_output_stream(f"{own}/{uuid.uuid4().hex}.jsonl", buffer_size=None)
            out.write(json.dumps({"key": key, "text": text, "error": error}).encode() + b"\n")
            out.flush()
            told.calls += 1
            if told.calls % segment == 0:
                out.close()
                out = None
    finally:
        if out is not None:
            out.close()
    return told


def source(name: str, folder: str, factory: Factory, max_tokens: int, segment: int) -> type[DataSource]:
    """A write-only data source that answers the rows written to it."""

    class Answers(DataSourceWriter):
        def write(self, iterator: Iterator) -> WriterCommitMessage:
            return answer_rows(iterator, folder, TaskContext.get().partitionId(), factory, max_tokens, segment)

        def _note(self, state: str, messages: list) -> None:
            files, base = opened(folder)
            told = [vars(m) for m in messages if m is not None]
            files.create_dir(base, recursive=True)
            with files.open_output_stream(f"{base}/{state}.json") as out:
                out.write(json.dumps({k: sum(m[k] for m in told) for k in ("calls", "found", "failed")}).encode())

        def commit(self, messages: list) -> None:
            self._note("committed", messages)

        def abort(self, messages: list) -> None:
            """Answers stay: they were paid for, and the next run finds them."""
            self._note("aborted", messages)

    class Responses(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return Answers()

    return Responses


@dataclass
class Ledger:
    """Answers below ``folder``, which all executors share. ``tag`` names what else an answer depends on, such
    as the model."""

    spark: SparkSession
    folder: str
    tag: str = ""
    segment: int = SEGMENT

    def key(self, max_tokens: int) -> Column:
        asked = F.struct(F.lit(self.tag).alias("tag"), F.col("system"), F.col("user"), F.lit(max_tokens).alias("max_tokens"))
        return F.sha2(F.to_json(asked), 256)

    def answers(self) -> DataFrame:
        """``key, text, error``, one row per key; an answer goes before an error."""
        try:
            lines = self.spark.read.schema(LINE).json(f"{self.folder.rstrip('/')}/job-*/part=*/*.jsonl")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LINE)
        rows = lines.where(F.col("key").isNotNull()).select("key", "text", "error")
        # a lost task may have left the same answer twice
        good = rows.where(F.col("error").isNull()).dropDuplicates(["key"])
        bad = rows.where(F.col("error").isNotNull()).dropDuplicates(["key"]).join(good.select("key"), "key", "left_anti")
        return good.unionAll(bad)

    def todo(self, prompts: DataFrame) -> DataFrame:
        """The distinct ``prompts`` (key, system, user) that have no answer yet.

        ``_at`` numbers the rows; prompts without it are written first. What is asked is decided on keys and
        numbers alone: prompts are long, and hash aggregates and a hashed list of numbers sort none of them.
        """
        if "_at" not in prompts.columns:
            prompts = written(prompts.withColumn("_at", F.monotonically_increasing_id()))
        known = self.answers().where(F.col("error").isNull()).select("key")
        first = prompts.groupBy("key").agg(F.min("_at").alias("_at")).join(known, "key", "left_anti")
        return prompts.join(first.select("_at").hint("shuffle_hash"), "_at", "left_semi").select("key", "system", "user")

    def ask(self, prompts: DataFrame, factory: Factory, max_tokens: int, tasks: int | None = None) -> str:
        """Ask the distinct ``prompts`` (key, system, user) that have no answer yet; returns the job's folder."""
        todo = self.todo(prompts)
        tasks = tasks or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"responses-{uuid.uuid4().hex}"
        folder = f"{self.folder.rstrip('/')}/job-{uuid.uuid4().hex}"
        self.spark.dataSource.register(source(name, folder, factory, max_tokens, self.segment))
        # the number of tasks is fixed, so that few slow calls are not merged into one task
        todo.repartition(tasks, "key").write.format(name).mode("append").save()
        return folder

    def answered(self, rows: DataFrame, factory: Factory, max_tokens: int, tasks: int | None = None) -> DataFrame:
        """``rows`` with ``text`` and ``error`` in place of ``system, user``. Only prompts travel through
        Python, equal ones once; rows whose ``system`` is NULL are not asked."""
        own = F.concat(F.lit("none:"), F.monotonically_increasing_id().cast("string"))
        keyed = rows.withColumn("_key", F.when(F.col("system").isNotNull(), self.key(max_tokens)).otherwise(own))
        keyed = written(keyed.withColumn("_at", F.monotonically_increasing_id()))
        prompts = keyed.where(F.col("system").isNotNull()).select(F.col("_key").alias("key"), "_at", "system", "user")
        self.ask(prompts, factory, max_tokens, tasks)
        facts = keyed.drop("system", "user")
        found = self.answers().withColumnRenamed("key", "_key")
        return lookup_join(facts, found, ["_key"], ["_at"]).drop("_key", "_at")
