"""Review table: record layout, replace by source_ref, archive of annotated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.structured import indent_json
from ..schema import RESPONSES, VECTOR_WIDTH
from .pairs import answer_of, created_now, question_of
from .skew import lookup_join

# ---- fixed values -----------------------------------------------------------
EDIT_FIELDS = ["edited_question", "edited_answer", "rejection_notes"]
SUBMITTED = "submitted"
REPLACED_REASON = "source_data_changed"
SOURCE_PREVIEW = 5000
FENCE_OPEN = "```json\n"
FENCE_CLOSE = "\n```"
# ------------------------------------------------------------------------------


def source_preview(source_data: Column) -> Column:
    """Fenced, indented JSON cut at the preview width; '' for no data or an empty object."""
    there = source_data.isNotNull() & ~source_data.isin("", "{}", "null")
    fenced = F.concat(
        F.lit(FENCE_OPEN),
        F.substring(indent_json(source_data), 1, SOURCE_PREVIEW),
        F.lit(FENCE_CLOSE),
    )
    return F.when(there, fenced).otherwise(F.lit(""))


def to_records(pairs: DataFrame, vectors: DataFrame | None = None, width: int = VECTOR_WIDTH) -> DataFrame:
    """Pairs to review records. ``vectors`` (id, vector) holds the question embeddings, all ``width`` wide."""
    meta = F.col("metadata")
    shown = F.when(meta["has_citation"], F.lit("True")).otherwise(F.lit("False"))
    issues = F.array_join(F.coalesce(meta["eval_issues"], F.array().cast("array<string>")), "; ")
    records = pairs.select(
        "id",
        "source_ref",
        question_of().alias("question"),
        answer_of().alias("answer"),
        source_preview(meta["source_data"]).alias("source_data"),
        issues.alias("eval_issues"),
        F.struct(
            F.col("domain"),
            F.col("source").alias("source_type"),
            meta["complexity"].alias("complexity"),
            meta["granularity"].alias("granularity"),
            shown.alias("has_citation"),
            F.col("source_ref"),
            meta["faithfulness_score"].alias("faithfulness_score"),
            meta["relevance_score"].alias("relevance_score"),
            meta["completeness_score"].alias("completeness_score"),
            meta["confidence_score"].alias("confidence_score"),
            meta["suggested_decision"].alias("suggested_decision"),
        ).alias("metadata"),
    )
    if vectors is None:
        records = records.withColumn("vector", F.lit(None).cast("array<float>"))
    else:
        wide = F.size("vector") == width
        checked = F.when(
            F.col("vector").isNull() | wide, F.col("vector")
        ).otherwise(F.raise_error(F.concat(F.lit(f"vector is not {width} wide: "), F.col("id"))).cast("array<float>"))
        records = records.join(vectors.select("id", checked.alias("vector")), "id", "left")
    return records.withColumn("responses", F.array().cast(RESPONSES))


def is_submitted(response: Column) -> Column:
    return F.coalesce(response["status"] == SUBMITTED, F.lit(False))


def annotated(responses: str = "responses") -> Column:
    return F.coalesce(F.exists(responses, is_submitted), F.lit(False))


def annotation_depth(responses: str = "responses") -> Column:
    def edit(r: Column) -> Column:
        has_value = F.coalesce(r["value"], F.lit("")) != ""
        return is_submitted(r) & r["question_name"].isin(EDIT_FIELDS) & has_value

    edited = F.coalesce(F.exists(responses, edit), F.lit(False))
    return F.when(edited, F.lit("has_edits")).otherwise(F.lit("approved_only"))


def mark_replaced(live: DataFrame, incoming: DataFrame) -> DataFrame:
    """Live records with ``replaced``: their source_ref is among the incoming pairs. One
    source_ref may hold a large share of the live records."""
    refs = incoming.select("source_ref").distinct().withColumn("_in", F.lit(True))
    marked = lookup_join(live, refs, ["source_ref"], ["id"])
    return marked.withColumn("replaced", F.coalesce("_in", F.lit(False))).drop("_in")


def replace(marked: DataFrame, records: DataFrame) -> DataFrame:
    """New live snapshot: records that were not replaced, then the incoming ones."""
    return marked.where(~F.col("replaced")).drop("replaced").unionByName(records)


def archive(marked: DataFrame) -> DataFrame:
    """Replaced records with a submitted response, as archive rows without their id. The responses
    are kept in a column of their own."""
    kept = marked.where(F.col("replaced") & annotated())
    return kept.select(
        "source_ref",
        "question",
        "answer",
        "source_data",
        "eval_issues",
        "metadata",
        "vector",
        created_now().alias("archived_at"),
        F.lit(REPLACED_REASON).alias("replaced_reason"),
        annotation_depth().alias("annotation_depth"),
        "responses",
    )


def counts(marked: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row: pushed, deleted, archived and the number of source_refs pushed."""
    old = marked.where("replaced").select(
        F.lit(0).alias("pushed"), F.lit(1).alias("deleted"), annotated().cast("int").alias("archived")
    )
    new = incoming.select(F.lit(1).alias("pushed"), F.lit(0).alias("deleted"), F.lit(0).alias("archived"))
    total = old.unionByName(new).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["pushed", "deleted", "archived"]]
    )
    refs = incoming.groupBy("source_ref").agg(F.count(F.lit(1)).alias("n"))
    return total.withColumn("refs", refs.agg(F.count(F.lit(1))).scalar())


def per_ref(incoming: DataFrame) -> DataFrame:
    return incoming.groupBy("source_ref").agg(F.count(F.lit(1)).alias("pairs"))
