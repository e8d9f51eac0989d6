"""Answers survive tasks and jobs: what was answered is not asked again."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import infer, ledger
from corpusloom.operators.domains import REGISTRY
from corpusloom.operators.ledger import Ledger


def logged(folder, breaks=(), fails=()):
    """A backend that writes down every call it begins; on the prompts of ``breaks`` the worker dies."""

    def factory():
        def call(system, user, max_tokens):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.write(user)
            if user in breaks:
                os._exit(1)
            if user in fails:
                raise ValueError("no answer")
            return f"{system}/{max_tokens}: {user}"

        return call

    return factory


def calls(folder):
    out = {}
    for name in os.listdir(folder):
        with open(f"{folder}/{name}") as text:
            user = text.read()
        out[user] = out.get(user, 0) + 1
    return out


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path / "calls"), str(tmp_path / "ledger")


def prompts(spark, n, repeat=1):
    rows = spark.range(n).select("id", F.lit("s").alias("system"), F.concat(F.lit("u"), "id").alias("user"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(repeat))))


def test_a_lost_task_repeats_no_answered_call(spark, folders):
    log, path = folders
    book = Ledger(spark, path)
    rows = prompts(spark, 40, repeat=2)
    with pytest.raises(Exception):  # noqa: B017 - the worker is gone, Spark reports it in several ways
        book.answered(rows, logged(log, breaks=("u17",)), 9, tasks=4).collect()
    kept = {r.text for r in book.answers().collect()}
    before = calls(log)
    assert before["u17"] == 1 and len(kept) >= 1 and not any(t.endswith("u17") for t in kept)
    got = book.answered(rows, logged(log), 9, tasks=4).collect()
    assert sorted((r.id, r.copy, r.text, r.error) for r in got) == sorted((i, c, f"s/9: u{i}", None) for i in range(40) for c in (1, 2))
    # other tasks may have had one open call when the job ended
    after = calls(log)
    assert all(n == 1 for u, n in after.items() if f"s/9: {u}" in kept)
    assert after["u17"] == 2 and sum(after.values()) <= 40 + 4
    again = book.answered(rows, logged(log), 9, tasks=4)
    assert again.where("text IS NULL").count() == 0 and calls(log) == after


def test_a_second_attempt_of_a_task_goes_on(folders):
    log, path = folders
    rows = [(f"k{i}", "s", f"u{i}") for i in range(5)]

    def lost():
        yield from rows[:3]
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        ledger.answer_rows(lost(), path, 2, logged(log), 5)
    name = os.listdir(f"{path}/part=000002")[0]
    with open(f"{path}/part=000002/{name}", "a") as out:
        out.write('{"key": "k4", "text": "cut')  # the line that was being written
    told = ledger.answer_rows(iter(rows), path, 2, logged(log), 5, segment=1)
    assert (told.calls, told.found, told.failed) == (2, 3, 0) and set(calls(log).values()) == {1}
    # another part does not look here
    assert ledger.answer_rows(iter(rows[:1]), path, 3, logged(log), 5).calls == 1


def test_errors_are_tried_again_and_answers_depend_on_all_inputs(spark, folders):
    log, path = folders
    book = Ledger(spark, path)
    rows = prompts(spark, 3).unionByName(
        spark.createDataFrame([(9, None, "skipped", 1)], "id long, system string, user string, copy int")
    )
    first = {r.id: (r.text, r.error) for r in book.answered(rows, logged(log, fails=("u1",)), 5, tasks=2).collect()}
    assert first == {0: ("s/5: u0", None), 1: (None, "ValueError: no answer"), 2: ("s/5: u2", None), 9: (None, None)}
    second = {r.id: r.text for r in book.answered(rows, logged(log), 5, tasks=2).collect()}
    assert second[1] == "s/5: u1" and calls(log) == {"u0": 1, "u1": 2, "u2": 1}
    book.answered(rows, logged(log), 6, tasks=2)
    Ledger(spark, path, tag="other").answered(rows, logged(log), 5, tasks=2)
    assert calls(log) == {"u0": 3, "u1": 4, "u2": 3}
    job = next(d for d in sorted(os.listdir(path)) if os.path.exists(f"{path}/{d}/committed.json"))
    with open(f"{path}/{job}/committed.json") as note:
        assert set(json.load(note)) == {"calls", "found", "failed"}


def test_two_passes_and_judge_give_the_same_with_a_ledger(spark, folders):
    _, path = folders
    rows = spark.range(12).select(
        F.lit("nsf-awards").alias("domain"), F.col("id").cast("string").alias("entity_id"), F.concat(F.lit("E"), "id").alias("entity_name"),
        F.col("id").alias("ordinal"), F.lit('{"a":1}').alias("entity_json"), F.lit('{"a":1}').alias("source_data"), F.lit("0").alias("source_hash"),
    )
    spec, book = REGISTRY["nsf-awards"], Ledger(spark, path)

    def made(kept):
        out = infer.judge(infer.two_pass(rows, spec, infer.echo_backend, tasks=2, ledger=kept), infer.echo_backend, ledger=kept, tasks=2)
        pairs = F.transform("pairs", lambda p: F.struct(p["id"], p["messages"], p["metadata"]["confidence_score"]))
        return sorted(map(str, out.select("entity_id", pairs, "errors").collect()))

    assert made(book) == made(None) == made(book)


def test_no_prompt_is_sorted_to_find_what_is_asked(spark, folders):
    """The shuffle join of equal prompts is on numbers: sorts of whole prompts grow with a task's input."""
    book = Ledger(spark, folders[1])
    rows = spark.range(40).selectExpr("'s' AS system", "CAST(id % 7 AS STRING) AS user")
    prompts = rows.withColumn("key", book.key(8))
    todo = book.todo(prompts)
    plan = todo._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortAggregate" not in plan
    assert not [line for line in plan.split("\n") if " Sort [" in line and "user" in line]
    assert sorted(r.user for r in todo.collect()) == list("0123456")
    book.ask(prompts.where("user < 3"), logged(folders[0]), 8)
    assert sorted(r.user for r in book.todo(prompts).collect()) == list("3456")
