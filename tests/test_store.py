"""One switch for live records, archive and cache: failures at every step, repeats, and two runs at once."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import incremental
from corpusloom.plans import publish
from corpusloom.schema import CACHE, REVIEW

from test_sources import live, make_pairs


def first_store(spark, tmp_path):
    store = publish.open_store(spark, str(tmp_path / "store"), buckets=8)
    rows = live(spark, [
        ("1", "r", [("edited_answer", "x", "submitted")]), ("2", "r", []), ("3", "other", [("review_decision", "a", "submitted")]),
        *[(f"k{n}", f"far{n}", []) for n in range(20)],
    ])
    cache = spark.createDataFrame([("d", f"e{n}", "h", "old", []) for n in range(20)], CACHE)
    store.load("first", live=rows, cache=cache)
    return store


def entries(spark, *ids):
    return spark.createDataFrame([("d", i, n, "h2", "new", []) for n, i in enumerate(ids)], CACHE.replace("hash string, full", "ordinal long, hash string, full", 1))


def state(store):
    ids = lambda name, column: sorted(r[0] for r in store.read(name).select(column).collect())
    new = store.read("cache").where("full_hash = 'new'")
    return ids("live", "id"), ids("archive", "source_ref"), sorted(r.entity_id for r in new.select("entity_id").collect()), store.read("cache").count()


AFTER = (sorted(["3", "p0", "p1", *[f"k{n}" for n in range(20)]]), ["r"], ["e3", "new"], 21)
BEFORE = (sorted(["1", "2", "3", *[f"k{n}" for n in range(20)]]), [], [], 20)


@pytest.mark.parametrize("step", ["live", "archive", "cache", "publish", "lost answer"])
def test_a_run_repeated_after_a_failure_counts_once(spark, tmp_path, monkeypatch, step):
    store = first_store(spark, tmp_path)
    write, switch = type(store)._write, type(store)._publish

    def broken_write(self, name, change, before):
        out = write(self, name, change, before)
        if name == step:
            raise RuntimeError("lost")
        return out

    def broken_switch(self, manifest):
        if step == "publish":
            raise RuntimeError("lost")
        out = switch(self, manifest)
        if step == "lost answer":
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(type(store), "_write", broken_write)
    monkeypatch.setattr(type(store), "_publish", broken_switch)
    with pytest.raises(RuntimeError):
        publish.publish_run(store, "day 1", make_pairs(spark, 2), entries(spark, "e3", "new"))
    assert state(store) == (AFTER if step == "lost answer" else BEFORE)
    monkeypatch.undo()
    publish.publish_run(store, "day 1", make_pairs(spark, 2), entries(spark, "e3", "new"))
    assert state(store) == AFTER
    publish.publish_run(store, "day 1", make_pairs(spark, 2), entries(spark, "e3", "new"))
    assert state(store) == AFTER and store.head().version == 2


def test_untouched_buckets_are_named_again_not_written(spark, tmp_path):
    store = first_store(spark, tmp_path)
    before = store.head()
    after = publish.publish_run(store, "day 1", make_pairs(spark, 2))
    touched = {str(b) for b in store.touched("live", make_pairs(spark, 2))}
    assert len(touched) == 1 and after.tables["cache"] == before.tables["cache"]
    for bucket, folders in before.tables["live"].items():
        assert (after.tables["live"].get(bucket) == folders) == (bucket not in touched)
    # older versions stay readable
    assert store.read("live", before).count() == 23 and store.read("live", after).count() == 23
    assert store.read("live", after, [int(b) for b in touched]).where("source_ref = 'r'").count() == 2


def test_two_runs_from_one_version_both_count(spark, tmp_path):
    store = first_store(spark, tmp_path)
    calls = []

    def slow(base):
        calls.append(base.version)
        if len(calls) == 1:  # another run is faster
            publish.publish_run(store, "other", make_pairs(spark, 1, ref="other"))
        one = entries(spark, "late")
        touched = store.touched("cache", one)
        return {"cache": publish.Replace(incremental.upsert(store.read("cache", base, touched), one), touched)}

    assert store.run("slow", slow).version == 3 and calls == [1, 2]
    assert store.read("cache").where("entity_id = 'late'").count() == 1
    assert store.read("live").where("id = 'p0'").count() == 1
    assert [r.source_ref for r in store.read("archive").collect()] == ["other"]


def test_empty_store_and_rows_outside(spark, tmp_path):
    store = publish.open_store(spark, str(tmp_path / "new"), buckets=4)
    assert store.head().version == 0 and store.read("live").count() == 0
    publish.publish_run(store, "a", make_pairs(spark, 3))
    assert store.read("live").count() == 3 and store.read("archive").count() == 0
    rows = store.read("live")
    other = [b for b in range(4) if b not in store.touched("live", rows)][:1]
    with pytest.raises(ValueError, match="outside"):
        store.run("b", lambda base: {"live": publish.Replace(rows, other)})
    assert store.head().version == 1
    # a bucket whose last row goes away has no folder
    store.run("c", lambda base: {"live": publish.Replace(rows.where(F.lit(False)), store.touched("live", rows))})
    assert store.read("live").count() == 0 and store.read("live").schema == spark.createDataFrame([], REVIEW).schema
