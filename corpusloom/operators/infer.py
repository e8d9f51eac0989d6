"""Batch inference: prompt rows through an injected backend, two passes, judge, embeddings."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.structured import indent_json
from ..settings import stable
from . import judge as judging
from . import pairs as pairing
from . import prompts
from .domains import DomainSpec
from .ledger import Ledger

# ``generate(system, user, max_tokens) -> text``
Generate = Callable[[str, str, int], str]
# builds the backend (client, model handle) inside a Python worker
Factory = Callable[[], Generate]
Encode = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def generate(prompt_rows: DataFrame, factory: Factory, key: list[str], max_tokens: int = 2048) -> DataFrame:
    """``key..., text, error`` for rows with ``system, user``. A failing call costs only its own row;
    a row whose ``system`` is NULL is passed on without a call."""
    key_fields = ", ".join(f"`{k}` {prompt_rows.schema[k].dataType.simpleString()}" for k in key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = factory()
        for batch in batches:
            texts, errors = [], []
            for system, user in zip(batch["system"], batch["user"]):
                text = error = None
                if system is not None:
                    try:
                        text = call(system, user, max_tokens)
                    except Exception as problem:  # noqa: BLE001 - any backend failure is per row
                        error = f"{type(problem).__name__}: {problem}"
                texts.append(text)
                errors.append(error)
            out = batch[key].copy()
            out["text"] = pd.Series(texts, index=out.index, dtype=object)
            out["error"] = pd.Series(errors, index=out.index, dtype=object)
            yield out

    rows = prompt_rows.select(*key, "system", "user")
    return rows.mapInPandas(run, f"{key_fields}, text string, error string")


def _answered(
    rows: DataFrame, factory: Factory, prefix: str, max_tokens: int, ledger: Ledger | None = None, tasks: int | None = None
) -> DataFrame:
    """``rows`` (with ``system, user``) plus ``<prefix>_text`` and ``<prefix>_error``.

    With a ledger only prompts without an answer are asked, and each answer is kept at once. Without one
    all columns are scalars and travel through the Python stage, which costs Arrow copies but no
    join. The result is written once: nothing downstream can trigger a second round of calls.
    """
    if ledger is not None:
        found = ledger.answered(rows, factory, max_tokens, tasks)
        return found.withColumnRenamed("text", f"{prefix}_text").withColumnRenamed("error", f"{prefix}_error")
    columns = [c for c in rows.columns if c not in ("system", "user")]
    answers = generate(rows, factory, columns, max_tokens)
    return stable(
        answers.withColumnRenamed("text", f"{prefix}_text").withColumnRenamed("error", f"{prefix}_error")
    )


def spread(entities: DataFrame, tasks: int | None = None) -> DataFrame:
    """Entities in even tasks. Calls are so slow that an uneven or short list of tasks costs far
    more than this shuffle; the number of tasks is fixed so that it is not merged away."""
    tasks = tasks or int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entities.repartition(tasks, "entity_id", "ordinal")


def two_pass(
    entities: DataFrame,
    spec: DomainSpec,
    factory: Factory,
    max_tokens: int = 2048,
    keep_battery: bool = False,
    tasks: int | None = None,
    ledger: Ledger | None = None,
    program: str = "",
) -> DataFrame:
    """Entities (``domain, entity_id, entity_name, ordinal, entity_json, source_data, source_hash``)
    to the same rows with ``pairs``. Rows without items from the first pass get no second prompt,
    so they stay in the same plan without a second call. ``errors`` has the stage and message of every
    failed call."""
    domain = F.lit(spec.name)
    user = prompts.user_prompt(domain, F.col("entity_id"), F.col("user_json"), F.col("entity_name"))
    base = entities.columns
    rows = (entities if ledger is not None else spread(entities, tasks)).withColumn("user_json", indent_json("entity_json"))
    rows = rows.withColumn("system", F.lit(prompts.battery_system(spec.name, program))).withColumn("user", user)
    rows = _answered(rows, factory, "first", max_tokens, ledger, tasks)

    before, after = prompts.discovery_parts(spec.name, program)
    existing = F.concat(F.lit(before), prompts.existing_block(F.col("battery_items")), F.lit(after))
    rows = pairing.parse_battery(rows, "first_text")
    rows = rows.withColumn("system", F.when(F.size("battery_items") > 0, existing))
    rows = rows.withColumn("user", F.when(F.col("system").isNotNull(), user))
    rows = rows.drop("battery_items", "battery_state")
    rows = _answered(rows, factory, "second", max_tokens, ledger, tasks).drop("user_json")

    rows = pairing.parse_battery(rows, "first_text")
    rows = pairing.parse_discovery(rows, "second_text")
    items = pairing.merge_passes(F.col("second_error").isNotNull(), keep_battery)
    made = pairing.pair_array(
        F.col("items"),
        domain,
        F.col("entity_id"),
        spec.source_ref(F.col("entity_id")),
        spec.keywords,
        F.col("source_data"),
        F.col("source_hash"),
    )
    failed = F.array(_failure("battery", "first_error"), _failure("discovery", "second_error"))
    return rows.withColumn("items", items).select(*base, made.alias("pairs"), F.array_compact(failed).alias("errors"))


def _failure(stage: str, column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.struct(F.lit(stage).alias("stage"), F.col(column).alias("message")))


def failures(rows: DataFrame) -> DataFrame:
    """One row per failed model call: domain, entity_id, stage, message."""
    return rows.select("domain", "entity_id", F.explode("errors").alias("e")).select("domain", "entity_id", "e.stage", "e.message")


def judge(
    entities: DataFrame, factory: Factory | None, max_tokens: int = 2048, ledger: Ledger | None = None, tasks: int | None = None
) -> DataFrame:
    """Scores on the pair lists of the rows; one call per entity with pairs, none without a judge."""
    if factory is None:
        return entities
    asked = entities.withColumn(
        "system", F.when(F.size("pairs") > 0, F.lit(prompts.JUDGE_SYSTEM))
    )
    message = prompts.judge_user(indent_json("source_data"), prompts.judge_block(F.col("pairs")))
    asked = asked.withColumn("user", F.when(F.size("pairs") > 0, message))
    packed = asked.withColumn("_pairs", F.to_json("pairs")).drop("pairs")
    if "errors" in entities.columns:
        packed = packed.withColumn("_errors", F.to_json("errors")).drop("errors")
    answered = _answered(packed, factory, "judge", max_tokens, ledger, tasks)
    answered = answered.withColumn("pairs", F.from_json("_pairs", entities.schema["pairs"].dataType))
    if "errors" in entities.columns:
        earlier = F.from_json("_errors", entities.schema["errors"].dataType)
        answered = answered.withColumn("errors", F.concat(earlier, F.array_compact(F.array(_failure("judge", "judge_error")))))
    return judging.apply_to_list(answered, "judge_text").select(*entities.columns)


def embed(
    rows: DataFrame, encoder: Callable[[], Encode], key: str = "id", text: str = "question"
) -> DataFrame:
    """``key, vector`` from an injected batch encoder, built once per task."""
    key_type = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for batch in batches:
            vectors = [list(map(float, v)) for v in encode(batch[text].tolist())]
            yield pd.DataFrame({key: batch[key].to_numpy(), "vector": vectors})

    return rows.select(key, text).mapInPandas(run, f"`{key}` {key_type}, vector array<float>")


def join_vectors(rows: DataFrame, vectors: DataFrame, key: str, vector_key: str) -> DataFrame:
    """Precomputed vectors by id; rows without one keep NULL."""
    right = vectors.select(F.col(vector_key).alias(key), F.col("embedding").alias("vector"))
    return rows.join(right, key, "left")


# ---- deterministic stand-in backends for tests and dry runs -------------------------------------------


def echo_backend() -> Generate:
    """Answers from the prompt alone: one pair on the first pass, none on the second, full scores."""

    def call(system: str, user: str, max_tokens: int) -> str:
        if system == prompts.JUDGE_SYSTEM:
            ids = [line[4:] for line in user.split("\n") if line.startswith("### ")]
            scores = [
                {"pair_id": i, "faithfulness": 1.0, "relevance": 0.9, "completeness": 0.8, "issues": []}
                for i in ids
            ]
            return json.dumps(scores)
        if "Pairs so far:" in system:
            return "[]"
        head = dict(line.split(": ", 1) for line in user.split("\n")[:3])
        pair = {
            "question": f"What is {head['Entity name']}?",
            "answer": f"It is {head['Entity name']}.\n\n{head['Citation marker']}",
        }
        return "Here you are:\n" + json.dumps([pair])

    return call
