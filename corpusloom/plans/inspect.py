"""Looking at catalogs and corpora without generating anything: coverage and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import domains, reports
from ..sources import landed


def coverage(pages: dict[str, DataFrame], exact: bool = False) -> DataFrame:
    """One report row per catalog, from its landed pages (``page, value``).

    Software and groups count different ids. Projects are estimated from their first page, as a
    full fetch is not needed for a report; where all pages have landed, ``exact`` counts them and their
    different ids.
    """
    rows = None
    for name, frame in pages.items():
        one = _coverage_of(domains.REGISTRY[name], frame, exact)
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _coverage_of(spec: domains.DomainSpec, pages: DataFrame, exact: bool = False) -> DataFrame:
    items = landed.explode_items(pages, spec.item_type, spec.list_keys)
    if spec.name == "allocations" and exact:
        return reports.counted(items.select(domains.text_or_empty(spec.entity_id()).alias("entity_id")), spec.name)
    if spec.name == "allocations":
        first = landed.page_total(pages)
        items = landed.explode_items(first, spec.item_type, spec.list_keys)
        total = F.coalesce(first.agg(F.max("pages")).scalar(), F.lit(1))
        return reports.page_estimate(items, total, spec.name, "projectId")
    if spec.name == "compute-resources":
        return reports.coverage(
            items.withColumnRenamed("id", "entity_id"), spec.name, required=("name",), skip=reports.coming_soon()
        )
    if spec.name == "nsf-awards":
        return reports.coverage(items, spec.name, "id")
    ids = items.withColumn("entity_id", domains.text_or_empty(spec.entity_id()))
    return reports.coverage(ids, spec.name, distinct=True)


def stats(pairs: DataFrame) -> dict[str, DataFrame]:
    """Pairs per domain and per complexity, and the share with a citation marker."""
    return {
        "domain": reports.by_domain(pairs),
        "complexity": reports.by_complexity(pairs),
        "citation": reports.citation_share(pairs),
    }
