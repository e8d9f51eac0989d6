"""Landed pages followed as they come: many micro-batches that together are one run, kept in a store.

What a batch run knows by seeing all pages at once is kept in the store between batches: which pages there
were and their numbers, and which entities were taken. So arrival order goes on over the batches, a repeat of
an entity is dropped also when its first row came days before, and the cap counts over the whole landing.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import domains, incremental, infer, select
from ..operators.ledger import Ledger
from ..plans.extract import extract_picked
from ..schema import CACHE, PAIR, PAIR_FIELDS
from ..settings import ExtractionConfig, written
from ..sources import landed
from ..sources.store import Append, Change, Keyed, Log, Manifest, Replace, Store
from .watch import read_pages

PAGES = "landing string, path string, page bigint"
TAKEN = "landing string, domain string, entity_id string, ordinal bigint"


def open_landing(spark: SparkSession, root: str, buckets: int = 64) -> Store:
    """The kept tables of followed landings: ``pages`` with their numbers, the entities ``taken``, the ``pairs``
    of all batches, and the ``cache`` that landings share."""
    return Store(
        spark,
        root,
        {
            "pages": Keyed(PAGES, ("landing", "path"), 8),
            "taken": Keyed(TAKEN, ("landing", "domain", "entity_id"), buckets),
            "cache": Keyed(CACHE, tuple(incremental.KEY), buckets),
            "pairs": Log(f"landing string, ordinal bigint, sub int, {PAIR}"),
        },
    )


def _numbered(store: Store, base: Manifest, landing: str, pages: DataFrame) -> DataFrame:
    """``pages`` (path, value) with numbers behind those of the batches before."""
    known = store.read("pages", base).where(F.col("landing") == landing)
    last = known.agg(F.max("page")).first()[0] or 0
    return landed.numbered(pages).withColumn("page", F.col("page") + F.lit(last))


def _untaken(store: Store, base: Manifest, landing: str, spec: domains.DomainSpec, picked: DataFrame, cap: int | None) -> DataFrame:
    """``picked`` without entities that an earlier batch has, and within what is left of the cap."""
    if spec.keep_first:
        picked = written(picked)  # for the buckets to look into, and the rows
        keys = picked.select(F.lit(landing).alias("landing"), F.lit(spec.name).alias("domain"), "entity_id")
        before = store.read("taken", base, store.touched("taken", keys))
        before = before.where((F.col("landing") == landing) & (F.col("domain") == spec.name))
        picked = picked.join(before.select("entity_id"), "entity_id", "left_anti").select(*picked.columns)
    if cap is None:
        return picked
    # every row of a catalog that keeps repeats counts, as in a batch run
    mine = (F.col("landing") == landing) & (F.col("domain") == spec.name)
    return select.first_n(picked, max(0, cap - store.read("taken", base).where(mine).count()))


def _added(store: Store, base: Manifest, name: str, rows: DataFrame) -> Replace:
    touched = store.touched(name, rows)
    return Replace(store.read(name, base, touched).unionByName(rows), touched)


def one_batch(
    store: Store,
    run: str,
    landing: str,
    spec: domains.DomainSpec,
    pages: DataFrame,
    backend: infer.Factory,
    config: ExtractionConfig,
    details: DataFrame | None = None,
    judge: infer.Factory | None = None,
    ledger: Ledger | None = None,
) -> Manifest:
    """Extract ``pages`` (path, value) as the continuation of ``landing``; all tables switch together. A ``run``
    that is in the history is not extracted again."""
    made = store.done(run)
    if made is not None:
        return made
    base = store.head()
    # what a session registers, such as a ledger, is not there in the session of a micro-batch
    pages = _numbered(store, base, landing, written(pages, store.spark))
    items = landed.explode_items(pages.select("page", "value"), spec.item_type, spec.list_keys)
    picked = domains.pick(spec, items, replace(config, max_entities=None))
    # read by the extraction and by the list of entities taken
    picked = written(_untaken(store, base, landing, spec, picked, config.max_entities))
    result = extract_picked(
        spec, picked, backend, config, details, judge, store.read("cache", base), ledger=ledger
    )
    entries = written(result.written)
    pairs = result.pairs.select(F.lit(landing).alias("landing"), "ordinal", "sub", *PAIR_FIELDS)
    pairs = written(pairs)
    seen = pages.select(F.lit(landing).alias("landing"), "path", "page")
    taken = picked.select(F.lit(landing).alias("landing"), F.lit(spec.name).alias("domain"), "entity_id", "ordinal")

    def build(now: Manifest) -> dict[str, Change]:
        touched = store.touched("cache", entries)
        return {
            "pages": _added(store, now, "pages", seen),
            "taken": _added(store, now, "taken", taken),
            "cache": Replace(incremental.upsert(store.read("cache", now, touched), entries), touched),
            "pairs": Append(pairs),
        }

    return store.run(run, build)


def follow(
    store: Store,
    name: str,
    path: str,
    backend: infer.Factory,
    config: ExtractionConfig | None = None,
    judge: infer.Factory | None = None,
    landing: str | None = None,
    details: str | None = None,
    ledger: Ledger | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Extract every page below ``path`` that has not been seen, then stop.

    All batches of a ``landing`` (default: the catalog's name) give what one batch run over its pages gives, if
    later pages sort behind earlier ones. A new harvest of the catalog is a landing of its own, in a folder of
    its own; with the same store, entities whose content did not change are replayed from the cache. ``details``
    is the folder of landed detail responses. A landing has one query at a time; the store may be shared.
    A batch that fails at any step is extracted again and leaves its rows once; with a ``ledger`` its model calls
    are not repeated either.
    """
    spark, spec = store.spark, domains.REGISTRY[name]
    landing = landing or name
    config = config or ExtractionConfig()

    def batch_of(pages: DataFrame, batch: int) -> None:
        found = None if details is None else landed.scan_details(spark, details, spec.detail_type)
        one_batch(store, f"{landing}/{name}/{batch}", landing, spec, pages, backend, config, found, judge, ledger)

    return (
        read_pages(spark, path, files_per_batch)
        .writeStream.foreachBatch(batch_of)
        .option("checkpointLocation", f"{store.root}/progress/{landing}/{name}")
        .trigger(availableNow=True)
        .start()
    )
