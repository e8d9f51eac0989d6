"""Model answers to Q&A pairs, and the building of a pair."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.structured import QA_ITEM, parse_qa
from ..schema import EXTRACTION_SOURCE


def created_now() -> Column:
    """ISO text of the time of this call in UTC. It is fixed when the plan is built, so that a pair and
    its copy in the cache carry the same one, whenever they are written."""
    return F.lit(datetime.now(UTC).isoformat(timespec="microseconds"))


def build_pair(
    pair_id: Column,
    question: Column,
    answer: Column,
    source_ref: Column,
    domain: Column,
    complexity: Column | None = None,
    granularity: Column | None = None,
    source_data: Column | None = None,
    source_hash: Column | None = None,
) -> Column:
    """A pair struct with the judge fields still NULL."""
    null = F.lit(None)

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    metadata = F.struct(
        (F.lit("simple") if complexity is None else complexity).alias("complexity"),
        (F.lit("comprehensive") if granularity is None else granularity).alias("granularity"),
        tx.has_citation(answer).alias("has_citation"),
        created_now().alias("created_at"),
        (null if source_hash is None else source_hash).cast("string").alias("source_hash"),
        null.cast("string").alias("source_modified"),
        (null if source_data is None else source_data).cast("string").alias("source_data"),
        null.cast("double").alias("faithfulness_score"),
        null.cast("double").alias("relevance_score"),
        null.cast("double").alias("completeness_score"),
        null.cast("double").alias("confidence_score"),
        null.cast("array<string>").alias("eval_issues"),
        null.cast("string").alias("suggested_decision"),
    )
    return F.struct(
        pair_id.alias("id"),
        F.lit(EXTRACTION_SOURCE).alias("source"),
        source_ref.alias("source_ref"),
        domain.alias("domain"),
        F.array(message("user", question), message("assistant", answer)).alias("messages"),
        metadata.alias("metadata"),
    )


def question_of(messages: Column | str = "messages") -> Column:
    messages = F.col(messages) if isinstance(messages, str) else messages
    return F.coalesce(F.get(messages, F.lit(0))["content"], F.lit(""))


def answer_of(messages: Column | str = "messages") -> Column:
    messages = F.col(messages) if isinstance(messages, str) else messages
    return F.coalesce(F.get(messages, F.lit(1))["content"], F.lit(""))


def parse_battery(df: DataFrame, text: str, out: str = "battery") -> DataFrame:
    """First-pass answer. An item without question or answer spoils the whole answer."""
    return parse_qa(df, text, out, whole_items=True)


def parse_discovery(df: DataFrame, text: str, out: str = "discovery") -> DataFrame:
    """Second-pass answer. An item without question or answer is skipped later on."""
    return parse_qa(df, text, out)


def merge_passes(failed: Column | None = None, keep_battery: bool = False) -> Column:
    """Items of both passes (columns of the two parses). A malformed answer or failed call in
    either pass leaves the entity without pairs, unless ``keep_battery`` keeps the first pass when
    only the second is bad."""
    first, second = F.col("battery_items"), F.col("discovery_items")
    second_bad = F.coalesce(F.col("discovery_state") == "malformed", F.lit(False))
    if failed is not None:
        second_bad = second_bad | F.coalesce(failed, F.lit(False))
    none = F.array().cast(f"array<{QA_ITEM}>")
    return (
        F.when(F.col("battery_state") != "ok", none)
        .when(second_bad, first if keep_battery else none)
        .otherwise(F.concat(first, F.coalesce(second, none)))
    )


def pair_array(
    items: Column,
    domain: Column,
    entity_id: Column,
    source_ref: Column,
    keywords: list[str],
    source_data: Column | None = None,
    source_hash: Column | None = None,
) -> Column:
    """Items to pair structs. Numbers count every item; items without question or answer then drop."""
    numbered = F.transform(
        items,
        lambda x, i: F.struct(
            (i + 1).alias("seq"),
            F.coalesce(x["question"], F.lit("")).alias("question"),
            F.coalesce(x["answer"], F.lit("")).alias("answer"),
        ),
    )
    usable = F.filter(numbered, lambda x: (x["question"] != "") & (x["answer"] != ""))
    return F.transform(
        usable,
        lambda x: build_pair(
            F.concat_ws("_", domain, entity_id, x["seq"].cast("string")),
            x["question"],
            x["answer"],
            source_ref,
            domain,
            tx.complexity(x["question"], keywords),
            source_data=source_data,
            source_hash=source_hash,
        ),
    )


def explode_pairs(df: DataFrame, column: str = "pairs") -> DataFrame:
    """Entity rows with a pair list to pair rows in their order.

    The outer form is on purpose: for the plain one the optimizer adds a test of the list size
    below all the parsing, which would then run twice.
    """
    rows = df.select("ordinal", F.posexplode_outer(column).alias("sub", "pair"))
    return rows.where("sub IS NOT NULL").select("ordinal", "sub", "pair.*")
