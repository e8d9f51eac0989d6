"""Judge scores: parse, attach to the pairs, decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.structured import parse_scores

# ---- fixed values ----------------------------------------------------------
THRESHOLD = 0.8
APPROVED = "approved"
NEEDS_REVIEW = "needs_review"
# -----------------------------------------------------------------------------


def confidence(faithfulness: Column, relevance: Column, completeness: Column) -> Column:
    """Lowest score; NULL when one of them is (``least`` alone would skip it)."""
    known = faithfulness.isNotNull() & relevance.isNotNull() & completeness.isNotNull()
    return F.when(known, F.least(faithfulness, relevance, completeness))


def decision(score: Column) -> Column:
    return F.when(score >= THRESHOLD, F.lit(APPROVED)).when(score.isNotNull(), F.lit(NEEDS_REVIEW))


SCORES = ["faithfulness", "relevance", "completeness"]


def with_confidence(score: Column) -> Column:
    """Score entry plus its confidence."""
    return F.struct(
        *[score[f].alias(f) for f in SCORES],
        score["issues"].alias("issues"),
        confidence(*[score[f] for f in SCORES]).alias("confidence"),
    )


def scored(metadata: Column, score: Column) -> Column:
    """Metadata with the fields of one score entry (``with_confidence``); unchanged where there is
    none or one of its scores is unusable."""
    usable = score["confidence"].isNotNull()
    new = {
        "faithfulness_score": score["faithfulness"],
        "relevance_score": score["relevance"],
        "completeness_score": score["completeness"],
        "confidence_score": score["confidence"],
        "eval_issues": score["issues"],
        "suggested_decision": decision(score["confidence"]),
    }
    kept = ["complexity", "granularity", "has_citation", "created_at", "source_hash",
            "source_modified", "source_data"]
    return F.struct(
        *[metadata[f].alias(f) for f in kept],
        *[F.when(usable, c).otherwise(metadata[f]).alias(f) for f, c in new.items()],
    )


def apply_to_list(df: DataFrame, answer: str, pairs: str = "pairs") -> DataFrame:
    """Scores of one judge answer on the pair list of the same row: no shuffle. Of several entries
    for one pair the last counts; a bad answer leaves the pairs as they are."""

    def with_last(pair: Column) -> Column:
        mine = F.filter("_scores", lambda s: s["pair_id"] == pair["id"])
        last = F.try_element_at(mine, F.lit(-1))
        return F.struct(pair.alias("pair"), last.alias("score"))

    def one(x: Column) -> Column:
        pair = x["pair"]
        fields = ["id", "source", "source_ref", "domain", "messages"]
        return F.struct(
            *[pair[f].alias(f) for f in fields],
            scored(pair["metadata"], x["score"]).alias("metadata"),
        )

    def ready(x: Column) -> Column:
        return F.struct(x["pair"].alias("pair"), with_confidence(x["score"]).alias("score"))

    return (
        parse_scores(df, answer, "_scores")
        .withColumn("_scored", F.transform(pairs, with_last))
        .withColumn("_scored", F.transform("_scored", ready))
        .withColumn(
            pairs,
            F.when(F.col("_scores").isNull(), F.col(pairs)).otherwise(F.transform("_scored", one)),
        )
        .drop("_scores", "_scored")
    )


def score_rows(answers: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """Judge answers to one row per (key, pair_id); the last of several entries wins."""
    parsed = parse_scores(answers, text, "_scores")
    # the outer form keeps the optimizer from testing the list, that is, parsing, once more
    entries = parsed.select(*key, F.posexplode_outer("_scores").alias("_at", "s")).where("_at IS NOT NULL")
    fields = ["faithfulness", "relevance", "completeness", "issues"]
    last = entries.groupBy(*key, F.col("s.pair_id").alias("pair_id")).agg(
        F.max_by(F.struct(*[F.col("s")[f].alias(f) for f in fields]), F.col("_at")).alias("score")
    )
    return last.select(*key, "pair_id", "score")


def apply_to_rows(pairs: DataFrame, scores: DataFrame, key: list[str], no_judge: bool = False) -> DataFrame:
    """Pair rows (``id, metadata``) left joined with score rows; both sides are unique per pair."""
    if no_judge:
        return pairs
    right = scores.select(
        *key, F.col("pair_id").alias("id"), with_confidence(F.col("score")).alias("score")
    )
    joined = pairs.join(right, [*key, "id"], "left")
    return joined.withColumn("metadata", scored(F.col("metadata"), F.col("score"))).drop("score")
