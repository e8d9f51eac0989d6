"""One extraction run: items -> entities -> reuse or generate -> judge -> cache -> comparisons."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compare, domains, incremental, infer
from ..operators import pairs as pairing
from ..operators.ledger import Ledger
from ..schema import PAIR_FIELDS
from ..settings import ExtractionConfig, written
from ..sources import landed, tables


@dataclass
class DomainRun:
    """Output of one catalog. ``written`` holds the cache entries of the regenerated entities."""

    pairs: DataFrame
    records: DataFrame
    written: DataFrame
    planned: DataFrame
    errors: DataFrame


@dataclass
class Run:
    """Output of a whole run; ``pairs`` has one frame per source, comparisons among them."""

    pairs: dict[str, DataFrame] = field(default_factory=dict)
    records: dict[str, DataFrame] = field(default_factory=dict)
    cache: DataFrame | None = None
    planned: dict[str, DataFrame] = field(default_factory=dict)
    #: failed model calls by catalog: domain, entity_id, stage (battery, discovery, judge), message
    errors: dict[str, DataFrame] = field(default_factory=dict)

    def error_counts(self) -> DataFrame | None:
        """Failed calls per catalog and stage; None without catalogs."""
        frames = list(self.errors.values())
        if not frames:
            return None
        every = frames[0]
        for frame in frames[1:]:
            every = every.unionByName(frame)
        return every.groupBy("domain", "stage").agg(F.count(F.lit(1)).alias("failed"))

    def all_pairs(self) -> DataFrame:
        return tables.union_sources(self.pairs)


def comparison_pairs(comparisons: DataFrame) -> DataFrame:
    """Comparison rows in the pair layout."""
    data = F.to_json(
        F.struct(
            F.lit(compare.COMPARISON_TYPE).alias("comparison_type"),
            F.col("resources"),
            F.col("software"),
        )
    )
    pair = pairing.build_pair(
        F.col("id"),
        F.col("question"),
        F.col("answer"),
        F.col("source_ref"),
        F.col("domain"),
        F.col("complexity"),
        F.col("granularity"),
        data,
    )
    pair = pair.withField("metadata.has_citation", F.col("has_citation"))
    return comparisons.select(pair.alias("p")).select("p.*")


def extract_domain(
    spec: domains.DomainSpec,
    items: DataFrame,
    backend: infer.Factory,
    config: ExtractionConfig | None = None,
    details: DataFrame | None = None,
    judge: infer.Factory | None = None,
    cache: DataFrame | None = None,
    tasks: int | None = None,
    ledger: Ledger | None = None,
) -> DomainRun:
    """One catalog. ``items`` has ``ordinal`` and the item's fields, ``details`` ``entity_id, detail``. With a
    ``ledger`` a run that is repeated after a failure asks only what has no answer yet."""
    config = config or ExtractionConfig()
    picked = domains.pick(spec, items, config)
    return extract_picked(spec, picked, backend, config, details, judge, cache, tasks, ledger)


def extract_picked(
    spec: domains.DomainSpec,
    picked: DataFrame,
    backend: infer.Factory,
    config: ExtractionConfig,
    details: DataFrame | None = None,
    judge: infer.Factory | None = None,
    cache: DataFrame | None = None,
    tasks: int | None = None,
    ledger: Ledger | None = None,
) -> DomainRun:
    """``extract_domain`` from the entities of the run on (see ``domains.pick``)."""
    picked = domains.attach_details(picked, details, spec)
    # read by the plan, the replay, the generation and the records: parse and clean only once
    rows = written(incremental.with_hash(domains.cleaned(spec, picked, config)))
    spark = picked.sparkSession
    planned = incremental.plan(
        rows, tables.empty_cache(spark) if cache is None else cache, spec.keep_first
    )

    todo = incremental.to_generate(planned).select(
        "domain",
        "entity_id",
        "entity_name",
        "ordinal",
        F.to_json("entity").alias("entity_json"),
        "source_data",
        "source_hash",
        "full_hash",
    )
    made = infer.two_pass(todo, spec, backend, config.max_tokens, tasks=tasks, ledger=ledger, program=config.program)
    made = infer.judge(made, None if config.no_judge else judge, config.max_tokens, ledger, tasks)
    kept = incremental.replay(planned)
    fresh = pairing.explode_pairs(made)
    both = kept.select("ordinal", "sub", *PAIR_FIELDS).unionByName(
        fresh.select("ordinal", "sub", *PAIR_FIELDS)
    )
    entries = made.select(
        "domain", "entity_id", "ordinal", F.col("source_hash").alias("hash"), "full_hash", "pairs"
    )
    # the comparisons read the records many times: keep them, not the scan and the cleaning
    return DomainRun(both, written(domains.records(rows)), entries, planned, infer.failures(made))


def run(
    spark: SparkSession,
    items: dict[str, DataFrame],
    backend: infer.Factory,
    config: ExtractionConfig | None = None,
    details: dict[str, DataFrame] | None = None,
    judge: infer.Factory | None = None,
    cache: DataFrame | None = None,
    tasks: int | None = None,
    ledger: Ledger | None = None,
) -> Run:
    """All given catalogs, then the comparisons over their records. No results are written here, so a
    dry run is this call alone. An unregistered catalog is skipped."""
    config = config or ExtractionConfig()
    out = Run(cache=cache if cache is not None else tables.empty_cache(spark))
    entries = None
    for name, frame in items.items():
        spec = domains.REGISTRY.get(name)
        if spec is None:
            continue
        one = extract_domain(
            spec, frame, backend, config, (details or {}).get(name), judge, cache, tasks, ledger
        )
        out.pairs[name] = one.pairs.select(*PAIR_FIELDS)
        out.records[name] = one.records
        out.planned[name] = one.planned
        out.errors[name] = one.errors
        entries = one.written if entries is None else entries.unionByName(one.written)
    if entries is not None:
        out.cache = incremental.upsert(out.cache, entries)
    comparisons = compare.generate(
        resources=out.records.get("compute-resources"),
        software=out.records.get("software-discovery"),
        projects=out.records.get("allocations"),
        awards=out.records.get("nsf-awards"),
        groups=out.records.get("affinity-groups"),
        program=config.program,
        distinct=config.distinct,
    )
    if comparisons is not None:
        out.pairs["comparisons"] = comparison_pairs(comparisons)
    return out


def scan_catalog(spark: SparkSession, name: str, path: str) -> DataFrame:
    spec = domains.REGISTRY[name]
    return landed.scan_items(spark, path, spec.item_type, spec.list_keys)


def scan_catalog_details(spark: SparkSession, name: str, path: str) -> DataFrame:
    return landed.scan_details(spark, path, domains.REGISTRY[name].detail_type)
