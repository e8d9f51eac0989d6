"""Knobs of a run, registered catalogs, and the writers and readers that the other queries leave out."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.operators import domains, infer, judge, pairs
from corpusloom.plans.extract import run
from corpusloom.settings import ExtractionConfig, checkpoint_dir
from corpusloom.sources import tables

from .base import query, table, text
from .corpus import SCORES_SQL, UNION_SQL, judge_answers, sources
from .texts import CACHE_SQL, old_cache

CAP = 60


@query(
    "registered_catalog",
    f"""SELECT 'vendors_' || s_suppkey || '_1' AS id, 'What is ' || s_name || '?' AS question,
          'mcp://vendors/list/' || s_suppkey AS source_ref, NULL::double AS confidence
        FROM supplier WHERE s_acctbal > 0 AND s_suppkey % 7 <> 3 ORDER BY s_suppkey LIMIT {CAP}""",
)
def registered_catalog(spark, sf):
    """A catalog of one's own with a filter on its items; the run caps its entities, takes only listed ones
    and leaves the judge out."""
    spec = domains.DomainSpec(
        name="vendors",
        collection="list",
        item_type="struct<id:string,name:string,balance:double>",
        list_keys=("vendors",),
        entity_id=lambda: F.col("id"),
        entity_name=lambda: F.col("name"),
        clean=lambda df, config: F.struct("name"),
        record=lambda df: [F.col("name")],
        source_data=lambda: F.col("entity"),
        display="vendors",
        entity_type="vendor",
        pre_filter=lambda: F.col("balance") > 0,
    )
    s = table(spark, sf, "supplier")
    items = s.select(
        F.col("s_suppkey").alias("ordinal"), text("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    # the allow list is a setting, of the size of a command line
    listed = tuple(str(k) for k in range(10 * CAP) if k % 7 != 3)
    config = ExtractionConfig(max_entities=CAP, entity_ids=listed, no_judge=True)
    domains.register(spec)
    try:
        out = run(spark, {"vendors": items}, infer.echo_backend, config, judge=infer.echo_backend)
    finally:
        del domains.REGISTRY["vendors"]
    return out.pairs["vendors"].select(
        "id", pairs.question_of().alias("question"), "source_ref", F.col("metadata.confidence_score").alias("confidence")
    )


@query("no_judge", f"SELECT id, NULL::double AS confidence, NULL::varchar AS decision FROM ({SCORES_SQL})")
def no_judge(spark, sf):
    """Pairs pass a run without a judge untouched, although scores are there."""
    answers = judge_answers(spark, sf)
    built = pairs.build_pair(F.col("id"), F.lit("Q"), F.lit("A"), F.lit("r"), F.lit("d"))
    rows = answers.select("doc_id", built.alias("p")).select("doc_id", "p.*")
    kept = judge.apply_to_rows(rows, judge.score_rows(answers, ["doc_id"]), ["doc_id"], no_judge=True)
    return kept.select(
        "id", F.col("metadata.confidence_score").alias("confidence"), F.col("metadata.suggested_decision").alias("decision")
    )


@query(
    "cache_reload",
    f"SELECT domain, entity_id, left(full_hash, 16) AS hash, full_hash, len(pairs) AS pairs FROM ({CACHE_SQL})",
)
def cache_reload(spark, sf):
    """A written cache snapshot, read back, and one that is not there."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/cache-{uuid.uuid4().hex}"
    kept = tables.load_cache(spark, tables.write_snapshot(old_cache(spark, sf), root))
    absent = tables.load_cache(spark, f"{root}/snapshot-none")
    return kept.unionByName(absent).select("domain", "entity_id", "hash", "full_hash", F.size("pairs").cast("bigint").alias("pairs"))


@query("combined_roundtrip", f"SELECT id, source_ref, domain, question FROM ({UNION_SQL})")
def combined_roundtrip(spark, sf):
    """The combined pair file of all sources, written and read back."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/combined-{uuid.uuid4().hex}"
    path = tables.write_combined(sources(spark, sf), folder)
    return tables.load_pairs(spark, path).select("id", "source_ref", "domain", pairs.question_of().alias("question"))
