"""Schemas of the records that are kept at rest, and the checks on their closed value sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values of the record contract -------------------------------------------------
ROLES = ["user", "assistant"]
SOURCES = ["mcp_extraction", "user_qa", "doc_generated"]
COMPLEXITIES = ["simple", "moderate", "complex"]
GRANULARITIES = ["comprehensive", "comparison"]
DECISIONS = ["approved", "needs_review"]
EXTRACTION_SOURCE = "mcp_extraction"
VECTOR_WIDTH = 384
# -------------------------------------------------------------------------------------------

MESSAGES = "array<struct<role:string,content:string>>"

METADATA = (
    "struct<complexity:string,granularity:string,has_citation:boolean,created_at:string,"
    "source_hash:string,source_modified:string,source_data:string,"
    "faithfulness_score:double,relevance_score:double,completeness_score:double,"
    "confidence_score:double,eval_issues:array<string>,suggested_decision:string>"
)

PAIR_FIELDS = ["id", "source", "source_ref", "domain", "messages", "metadata"]

PAIR = (
    f"id string, source string, source_ref string, domain string, "
    f"messages {MESSAGES}, metadata {METADATA}"
)

PAIR_STRUCT = (
    f"struct<id:string,source:string,source_ref:string,domain:string,"
    f"messages:{MESSAGES},metadata:{METADATA}>"
)

# hash = short content hash carried by the pairs, full_hash = the one that is compared
CACHE = f"domain string, entity_id string, hash string, full_hash string, pairs array<{PAIR_STRUCT}>"

RESPONSES = "array<struct<question_name:string,value:string,status:string>>"

REVIEW_METADATA = (
    "struct<domain:string,source_type:string,complexity:string,granularity:string,"
    "has_citation:string,source_ref:string,faithfulness_score:double,relevance_score:double,"
    "completeness_score:double,confidence_score:double,suggested_decision:string>"
)

REVIEW = (
    f"id string, source_ref string, question string, answer string, source_data string, "
    f"eval_issues string, metadata {REVIEW_METADATA}, vector array<float>, responses {RESPONSES}"
)

# a replaced record, without its id: when and why it was replaced
ARCHIVE = (
    f"source_ref string, question string, answer string, source_data string, eval_issues string, "
    f"metadata {REVIEW_METADATA}, vector array<float>, archived_at string, replaced_reason string, "
    f"annotation_depth string, responses {RESPONSES}"
)


def invalid_pair() -> Column:
    """True where a pair breaks the record contract (missing field or value outside a closed set)."""
    meta = F.col("metadata")
    required = ["id", "source", "source_ref", "domain", "messages"]
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    bad_message = F.exists(
        "messages",
        lambda m: m.isNull()
        | m["content"].isNull()
        | ~F.coalesce(m["role"].isin(ROLES), F.lit(False)),
    )
    return (
        missing
        | ~F.coalesce(F.col("source").isin(SOURCES), F.lit(False))
        | bad_message
        | ~F.coalesce(meta["complexity"].isin(COMPLEXITIES), F.lit(True))
        | ~F.coalesce(meta["granularity"].isin(GRANULARITIES), F.lit(True))
        | ~F.coalesce(meta["suggested_decision"].isin(DECISIONS), F.lit(True))
    )


def assert_valid(pairs: DataFrame) -> DataFrame:
    """Fail the job on the first pair that breaks the contract, as a validating reader must."""
    checked = F.when(
        F.coalesce(invalid_pair(), F.lit(True)),
        F.raise_error(F.concat(F.lit("invalid pair: "), F.coalesce("id", F.lit("<no id>")))).cast(
            "string"
        ),
    ).otherwise(F.col("id"))
    return pairs.withColumn("id", checked)
