"""A landing followed in batches gives what one batch run over the same pages gives."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import domains, infer
from corpusloom.operators.ledger import Ledger
from corpusloom.plans.extract import extract_domain
from corpusloom.schema import PAIR_FIELDS
from corpusloom.settings import ExtractionConfig
from corpusloom.sources import landed
from corpusloom.streaming import follow as following
from corpusloom.streaming.follow import follow, open_landing


def land(folder, page, body):
    folder.mkdir(exist_ok=True)
    path = folder / f"page-{page}.json"
    path.write_text(json.dumps(body))
    # the stream takes files in the order of their times
    os.utime(path, (1_700_000_000 + page, 1_700_000_000 + page))


def awards(*ids, text="a"):
    return {"response": {"award": [{"id": i, "title": f"T{i}", "abstractText": text} for i in ids]}}


def rows_of(pairs):
    fields = [f for f in PAIR_FIELDS if f != "metadata"]
    timeless = F.col("metadata").dropFields("created_at").alias("metadata")
    return [tuple(map(str, r)) for r in pairs.select("ordinal", "sub", *fields, timeless).orderBy("ordinal", "sub").collect()]


def batch_rows(spark, name, folder, config, details=None):
    spec = domains.REGISTRY[name]
    items = landed.scan_items(spark, str(folder), spec.item_type, spec.list_keys)
    found = None if details is None else landed.scan_details(spark, str(details), spec.detail_type)
    return rows_of(extract_domain(spec, items, infer.echo_backend, config, found).pairs)


def test_batches_equal_one_run(spark, tmp_path):
    pages, config = tmp_path / "pages", ExtractionConfig(max_entities=4)
    store = open_landing(spark, str(tmp_path / "store"), 4)

    def step():
        follow(store, "nsf-awards", str(pages), infer.echo_backend, config).awaitTermination()

    land(pages, 1, awards("1", "2", "1"))
    step()
    # the first page again, a repeat with another text, an empty page, then more than the cap allows
    land(pages, 2, awards("2", "3", text="changed"))
    step()
    land(pages, 3, awards())  # no item
    land(pages, 10, awards("4", "5", "", "3"))
    step()
    step()  # nothing new
    got = rows_of(store.read("pairs"))
    assert got == batch_rows(spark, "nsf-awards", pages, config)
    assert len({g[0] for g in got}) == 4
    numbers = sorted((r.page, r.path.rsplit("/", 1)[1]) for r in store.read("pages").collect())
    assert numbers == [(1, "page-1.json"), (2, "page-2.json"), (3, "page-3.json"), (4, "page-10.json")]
    assert store.read("cache").count() == 4


def test_one_file_a_batch_equals_one_run(spark, tmp_path):
    pages, config = tmp_path / "pages", ExtractionConfig()
    for page in range(1, 4):
        land(pages, page, awards(*[str(page * 2 + i) for i in range(3)]))
    store = open_landing(spark, str(tmp_path / "store"), 4)
    follow(store, "nsf-awards", str(pages), infer.echo_backend, config, files_per_batch=1).awaitTermination()
    assert store.head().version == 3
    assert rows_of(store.read("pairs")) == batch_rows(spark, "nsf-awards", pages, config)


def test_details_reach_the_batches(spark, tmp_path):
    pages, more = tmp_path / "pages", tmp_path / "details"
    more.mkdir()
    store = open_landing(spark, str(tmp_path / "store"), 4)
    for n, name in enumerate(["a", "b"], 1):
        land(pages, n, {"resources": [{"id": f"{name}.x", "name": name.upper()}]})
        (more / f"{name}.x.json").write_text(json.dumps({"items": [{"name": f"{name} GPU", "type": "GPU"}]}))
        follow(store, "compute-resources", str(pages), infer.echo_backend, details=str(more)).awaitTermination()
    got = rows_of(store.read("pairs"))
    assert got and got == batch_rows(spark, "compute-resources", pages, ExtractionConfig(), more)


def test_failed_batch_leaves_its_rows_once(spark, tmp_path, monkeypatch):
    pages = tmp_path / "pages"
    store = open_landing(spark, str(tmp_path / "store"), 4)
    book = Ledger(spark, str(tmp_path / "answers"), tag="echo")
    land(pages, 1, awards("1", "2"))
    publish = store._publish
    monkeypatch.setattr(store, "_publish", lambda manifest: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        follow(store, "nsf-awards", str(pages), infer.echo_backend, ledger=book).awaitTermination()
    assert store.head().version == 0 and store.read("pairs").count() == 0
    monkeypatch.setattr(store, "_publish", publish)

    def silent():
        def call(system, user, max_tokens):
            raise AssertionError("every answer is in the ledger")

        return call

    follow(store, "nsf-awards", str(pages), silent, ledger=book).awaitTermination()
    assert rows_of(store.read("pairs")) == batch_rows(spark, "nsf-awards", pages, ExtractionConfig())
    # the same batch once more is not extracted again
    spec = domains.REGISTRY["nsf-awards"]
    again = spark.createDataFrame([("x", json.dumps(awards("9")))], "path string, value string")
    following.one_batch(store, "nsf-awards/nsf-awards/0", "nsf-awards", spec, again, silent, ExtractionConfig())
    assert store.head().version == 1


def test_new_harvest_replays_what_did_not_change(spark, tmp_path):
    store = open_landing(spark, str(tmp_path / "store"), 4)
    first, second = tmp_path / "may", tmp_path / "june"
    land(first, 1, awards("1", "2"))
    follow(store, "nsf-awards", str(first), infer.echo_backend, landing="may").awaitTermination()
    land(second, 1, awards("1", "2"))

    def silent():
        def call(system, user, max_tokens):
            raise AssertionError("nothing changed")

        return call

    follow(store, "nsf-awards", str(second), silent, landing="june").awaitTermination()
    may, june = (store.read("pairs").where(f"landing = '{n}'") for n in ("may", "june"))
    assert rows_of(may) == rows_of(june) and may.count() > 0
