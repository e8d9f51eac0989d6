"""After the run: check citations of a pair file, replace records in the review table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import citations, incremental, review
from ..operators.pairs import answer_of, question_of
from ..schema import ARCHIVE, CACHE, REVIEW
from ..settings import stable, written
from ..sources import tables
from ..sources.store import Append, Change, Keyed, Log, Manifest, Replace, Store


@dataclass
class Validation:
    checked: DataFrame
    verdicts: DataFrame
    summary: DataFrame

    def require_valid(self) -> None:
        """Raise when an answer cites an unknown entity (one summary row is fetched)."""
        row = self.summary.first()
        if not row["ok"]:
            raise ValueError(f"{row['invalid']} of {row['total']} answers cite unknown entities")


def validate(
    pairs: DataFrame,
    known: DataFrame,
    loaded: list[str],
    case_insensitive: tuple[str, ...] = (),
) -> Validation:
    """Markers, verdict per answer and summary.

    An id may occur more than once, also with equal texts, so the key is the id, a hash of the texts
    and a number that tells equal pairs apart. The texts are written once, since markers and verdicts
    both read them.
    """
    texts = pairs.select("id", question_of().alias("question"), answer_of().alias("answer"))
    texts = texts.withColumn("text_key", F.xxhash64("question", "answer"))
    texts = written(texts.withColumn("copy", F.monotonically_increasing_id()))
    key = ["id", "text_key", "copy"]
    found = written(citations.extract(texts, key))
    checked = citations.check(found, known, loaded, key, case_insensitive=case_insensitive)
    verdicts = citations.per_answer(texts, checked, key)
    return Validation(checked, verdicts, citations.summary(verdicts))


@dataclass
class Push:
    live: DataFrame
    archived: DataFrame
    counts: DataFrame


def push(live: DataFrame, pairs: DataFrame, vectors: DataFrame | None = None) -> Push:
    """Replace the live records of every incoming source_ref; annotated ones go to the archive."""
    marked = review.mark_replaced(live, pairs)
    records = review.to_records(pairs, vectors).select(*live.columns)
    return Push(
        review.replace(marked, records), review.archive(marked), review.counts(marked, pairs)
    )


def open_store(spark: SparkSession, root: str, buckets: int = 64) -> Store:
    """The kept tables of a corpus: ``live`` review records, their ``archive``, and the ``cache``."""
    keyed = {"live": Keyed(REVIEW, ("source_ref",), buckets), "cache": Keyed(CACHE, tuple(incremental.KEY), buckets)}
    return Store(spark, root, {**keyed, "archive": Log(ARCHIVE)})


def publish_run(
    store: Store,
    run: str,
    pairs: DataFrame | None = None,
    entries: DataFrame | None = None,
    vectors: DataFrame | None = None,
) -> Manifest:
    """Push ``pairs`` and upsert the cache ``entries`` of one extraction run; live records, archive and cache
    become visible together. Repeating a run, after a failure at any step or after success, archives
    every replaced record once. Only buckets with an incoming key are read and written."""
    pairs = None if pairs is None else stable(pairs)
    entries = None if entries is None else stable(entries)

    def build(base: Manifest) -> dict[str, Change]:
        changes: dict[str, Change] = {}
        if pairs is not None:
            touched = store.touched("live", pairs)
            # read by the live records, the archive and their counts
            marked = written(review.mark_replaced(store.read("live", base, touched), pairs))
            records = review.to_records(pairs, vectors)
            changes["live"] = Replace(review.replace(marked, records.select(*marked.drop("replaced").columns)), touched)
            changes["archive"] = Append(review.archive(marked))
        if entries is not None:
            touched = store.touched("cache", entries)
            changes["cache"] = Replace(incremental.upsert(store.read("cache", base, touched), entries), touched)
        return changes

    return store.run(run, build)


def push_snapshots(
    spark: SparkSession,
    live: DataFrame,
    pairs: DataFrame,
    live_root: str,
    archive_path: str,
    vectors: DataFrame | None = None,
) -> str:
    """Append the archive, then write a new live snapshot; returns its path. A crash in between
    leaves the old snapshot in force, so no record is lost, but a repeated call archives again: use
    ``publish_run`` where that matters."""
    result = push(live, stable(pairs), vectors)
    result.archived.write.mode("append").parquet(archive_path)
    return tables.write_snapshot(result.live, live_root)


def push_file(
    spark: SparkSession, live: DataFrame, path: str, live_root: str, archive_path: str
) -> str:
    pairs = tables.load_pairs(spark, path)
    return push_snapshots(spark, live, pairs, live_root, archive_path)
