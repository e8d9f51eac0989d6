"""Aggregates over finished corpora and over fetched catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import written
from .select import present

SAMPLE_IDS = 5


def floor_percent(part: Column, whole: Column) -> Column:
    return F.floor(F.try_divide(part * 100, whole)).cast("bigint")


def by_domain(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("domain").agg(F.count(F.lit(1)).alias("pairs")).orderBy("domain")


def by_complexity(pairs: DataFrame) -> DataFrame:
    return (
        pairs.groupBy(F.col("metadata.complexity").alias("complexity"))
        .agg(F.count(F.lit(1)).alias("pairs"))
        .orderBy("complexity")
    )


def citation_share(pairs: DataFrame) -> DataFrame:
    """Total, pairs with a marker, floor percent (NULL for an empty file)."""
    return pairs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("metadata.has_citation")).alias("with_citation"),
    ).withColumn("percent", floor_percent(F.col("with_citation"), F.col("total")))


def run_summary(pairs: DataFrame) -> DataFrame:
    """Pairs and domains per source and the grand total. The domains of a run are the registered
    ones, a closed short list; they are counted per (source, domain) before they are listed."""
    counted = pairs.groupBy("source_key", "domain").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.rollup("source_key").agg(
        F.grouping("source_key").alias("_total"),
        F.sum("n").alias("pairs"),
        F.array_join(F.sort_array(F.collect_set("domain")), ", ").alias("domains"),
    )
    return rows.select(
        F.when(F.col("_total") == 1, F.lit("Total")).otherwise(F.col("source_key")).alias("source_key"),
        "pairs",
        F.when(F.col("_total") == 1, F.lit("")).otherwise(F.col("domains")).alias("domains"),
    )


def coverage(
    items: DataFrame,
    source: str,
    id_column: str = "entity_id",
    required: tuple[str, ...] = (),
    distinct: bool = False,
    skip: Column | None = None,
    order: str = "ordinal",
) -> DataFrame:
    """One report row per source: fetched, unique, and the first ids as a sample.

    ``distinct`` counts different ids, else usable rows. The sample is a top-k over ``order`` (or
    over the ids themselves when ``distinct``), so no list of all ids is built.
    """
    usable = items.where(present(id_column, *required))
    if skip is not None:
        usable = usable.where(~skip)
    fetched = items.agg(F.count(F.lit(1))).scalar()
    if distinct:
        ids = usable.select(F.col(id_column).cast("string").alias("_id")).distinct()
        unique = ids.agg(F.count(F.lit(1))).scalar()
        sample = ids.orderBy("_id").limit(SAMPLE_IDS).select(F.col("_id").alias("_at"), "_id")
    else:
        unique = usable.agg(F.count(F.lit(1))).scalar()
        sample = (
            usable.select(F.col(order).alias("_at"), F.col(id_column).cast("string").alias("_id"))
            .orderBy("_at")
            .limit(SAMPLE_IDS)
        )
    # the sample has at most SAMPLE_IDS rows, so one task collects it
    ids_text = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("_at", "_id"))), lambda s: s["_id"]), ", "
    )
    return sample.agg(ids_text.alias("sample_ids")).select(
        F.lit(source).alias("source"),
        F.lit("list-all").alias("strategy"),
        fetched.alias("fetched"),
        unique.alias("unique_entities"),
        "sample_ids",
    )


def counted(items: DataFrame, source: str, id_column: str = "entity_id") -> DataFrame:
    """``coverage`` by different ids, where reading the items is the cost: one pass reduces them to one row
    per id (combined before the shuffle), which is written; the counts and the sample read those."""
    key = F.when(present(id_column), F.col(id_column).cast("string"))
    ids = written(items.groupBy(key.alias("_id")).agg(F.count(F.lit(1)).alias("_n")))
    found = ids.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("fetched"), F.count("_id").alias("unique_entities"))
    least = ids.where("_id IS NOT NULL").orderBy("_id").limit(SAMPLE_IDS)
    sample = least.agg(F.array_join(F.sort_array(F.collect_list("_id")), ", ").alias("sample_ids"))
    return found.select(
        F.lit(source).alias("source"),
        F.lit("list-all").alias("strategy"),
        "fetched",
        "unique_entities",
        sample.scalar().alias("sample_ids"),
    )


def coming_soon(name: str = "name", description: str = "description") -> Column:
    """Announced resources without a description; the coverage report leaves them out."""
    return F.col(name).contains("COMING SOON") & (F.coalesce(F.col(description), F.lit("")) == "")


def page_estimate(first_page: DataFrame, pages: Column, source: str, id_column: str) -> DataFrame:
    """Coverage from one page: items on it times the number of pages. One page is bounded."""
    ordered = F.sort_array(
        F.collect_list(
            F.when(present(id_column), F.struct("ordinal", F.col(id_column).cast("string").alias("_id")))
        )
    )
    ids = F.array_join(F.transform(F.slice(ordered, 1, SAMPLE_IDS), lambda s: s["_id"]), ", ")
    found = first_page.agg(F.count(F.lit(1)).alias("n"), ids.alias("sample_ids"))
    estimate = F.col("n") * pages
    return found.select(
        F.lit(source).alias("source"),
        F.lit("list-all").alias("strategy"),
        estimate.cast("bigint").alias("fetched"),
        estimate.cast("bigint").alias("unique_entities"),
        "sample_ids",
    )
