"""Citation markers: known entities, validity per marker and per answer, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from .skew import lookup_join

# ---- fixed values: id fields of the five catalogs, first filled one counts ------------------
ID_FIELDS = {
    "compute-resources": ["id", "resource_id", "ResourceID"],
    "software-discovery": ["name", "Name"],
    "affinity-groups": ["id"],
    "allocations": ["projectId", "requestNumber"],
    "nsf-awards": ["awardNumber"],
}
# ----------------------------------------------------------------------------------------------

QUESTION_PREVIEW = 80
SHOWN = 10


def known_ids(df: DataFrame, domain: str, fields: list[str] | None = None) -> DataFrame:
    """Distinct non-empty ids of one catalog: of its id fields, or where the frame has none of them (a
    scan of this package, before its fields are normalised) of the catalog's own entity id."""
    names = [f for f in (fields or ID_FIELDS[domain]) if f in df.columns]
    if names:
        first = F.coalesce(*[F.nullif(F.col(n).cast("string"), F.lit("")) for n in names])
    else:
        from .domains import REGISTRY

        df = REGISTRY[domain].prepare(df)
        first = F.nullif(REGISTRY[domain].entity_id().cast("string"), F.lit(""))
    return (
        df.select(F.lit(domain).alias("domain"), first.alias("entity_id"))
        .where(F.col("entity_id").isNotNull())
        .distinct()
    )


def known_software(listed: DataFrame | None, per_resource: DataFrame | None = None) -> DataFrame | None:
    """Software names from the full list, or from the per-resource search when the list is empty."""
    domain = "software-discovery"
    if listed is not None:
        names = known_ids(listed, domain)
        if per_resource is None or not names.isEmpty():
            return names
    return None if per_resource is None else known_ids(per_resource, domain)


def load_known(
    catalogs: dict[str, DataFrame | None], on_missing: str = "empty", spark: SparkSession | None = None
) -> tuple[DataFrame, list[str]]:
    """Known entities of all catalogs (none at all: an empty frame) and the list of loaded domains.

    A catalog that could not be loaded (None) counts as loaded and empty, so its citations are
    invalid; with ``on_missing='skip'`` it counts as unknown and is not checked.
    """
    frames, loaded = [], []
    for domain, df in catalogs.items():
        if df is None and on_missing == "skip":
            continue
        loaded.append(domain)
        if df is not None:
            frames.append(known_ids(df, domain))
    known = None
    for frame in frames:
        known = frame if known is None else known.unionByName(frame)
    if known is None:
        spark = spark or SparkSession.active()
        known = spark.createDataFrame([], "domain string, entity_id string")
    return known, loaded


def add_entities(known: DataFrame, more: DataFrame) -> DataFrame:
    both = known.select("domain", "entity_id").unionByName(more.select("domain", "entity_id"))
    return both.distinct()


KEY = ("id",)


def extract(answers: DataFrame, key: Sequence[str] = KEY, answer: str = "answer") -> DataFrame:
    """One row per marker: key, its place in the answer, raw text, domain and entity id."""
    # outer form: the plain one would search every answer twice, see pairs.explode_pairs
    found = answers.select(*key, F.posexplode_outer(tx.citation_markers(F.col(answer))).alias("place", "raw"))
    marker = tx.split_citation(F.col("raw"))
    return found.where("place IS NOT NULL").select(
        *key,
        (F.col("place") + 1).alias("place"),
        "raw",
        marker["domain"].alias("domain"),
        marker["entity_id"].alias("entity_id"),
    )


def from_pairs(
    answers: DataFrame, known: DataFrame | None = None, key: Sequence[str] = KEY
) -> DataFrame:
    """Entities cited by the pairs themselves, joined to those already known."""
    cited = extract(answers, key).select("domain", "entity_id")
    return cited.distinct() if known is None else add_entities(known, cited)


def known_in(known: DataFrame, domain: str) -> DataFrame:
    return known.where(F.col("domain") == domain).select("entity_id")


def check(
    cites: DataFrame,
    known: DataFrame,
    loaded: list[str],
    key: Sequence[str] = KEY,
    case_insensitive: tuple[str, ...] = (),
) -> DataFrame:
    """Markers with ``valid`` and ``error``. Domains that were not loaded cannot be checked and pass.

    A marker that most answers carry is a hot key; the lookup cuts it into slices.
    """

    def folded(df: DataFrame) -> Column:
        entity = F.col("entity_id")
        if not case_insensitive:
            return entity
        return F.when(F.col("domain").isin(list(case_insensitive)), F.lower(entity)).otherwise(entity)

    wanted = cites.withColumn("_id", folded(cites))
    ids = known.select("domain", folded(known).alias("_id")).distinct().withColumn("_known", F.lit(True))
    joined = lookup_join(wanted, ids, ["domain", "_id"], [*key, "place"])
    checked = F.col("domain").isin(loaded) if loaded else F.lit(False)
    valid = ~checked | F.coalesce("_known", F.lit(False))
    error = F.concat(
        F.lit("Entity '"), F.col("entity_id"), F.lit("' not found in "), F.col("domain")
    )
    return joined.withColumn("valid", valid).withColumn(
        "error", F.when(~F.col("valid"), error)
    ).drop("_id", "_known")


def per_answer(answers: DataFrame, checked: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Every answer with its counts; ``all_valid`` needs at least one marker."""
    sums = checked.groupBy(*key).agg(
        F.count(F.lit(1)).alias("citations"), F.count_if(~F.col("valid")).alias("invalid")
    )
    joined = answers.join(sums, list(key), "left")
    n = F.coalesce("citations", F.lit(0))
    bad = F.coalesce("invalid", F.lit(0))
    return (
        joined.withColumn("citations", n)
        .withColumn("invalid", bad)
        .withColumn("has_citations", F.col("citations") > 0)
        .withColumn("all_valid", F.col("has_citations") & (F.col("invalid") == 0))
    )


def invalid_answers(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("has_citations") & ~F.col("all_valid"))


def summary(verdicts: DataFrame) -> DataFrame:
    """Counts and floor percents of valid, invalid and no markers; NULL percents without pairs."""
    sums = verdicts.agg(
        F.count_if(F.col("all_valid")).alias("valid"),
        F.count_if(F.col("has_citations") & ~F.col("all_valid")).alias("invalid"),
        F.count_if(~F.col("has_citations")).alias("none"),
        F.count(F.lit(1)).alias("total"),
    )

    def percent(name: str) -> Column:
        return F.floor(F.try_divide(F.col(name) * 100, F.col("total"))).cast("bigint")

    return sums.select(
        "*",
        percent("valid").alias("valid_percent"),
        percent("invalid").alias("invalid_percent"),
        percent("none").alias("none_percent"),
        (F.col("invalid") == 0).alias("ok"),
    )


def invalid_top(
    verdicts: DataFrame, order: str = "ordinal", n: int = SHOWN, question: str = "question"
) -> DataFrame:
    """The first ``n`` answers with a bad marker and a question preview."""
    preview = F.concat(F.substring(question, 1, QUESTION_PREVIEW), F.lit("..."))
    return (
        invalid_answers(verdicts).withColumn("preview", preview).orderBy(order).limit(n)
    )
