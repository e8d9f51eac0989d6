import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import judge, pairs
from corpusloom.operators.domains import REGISTRY

SPEC = REGISTRY["nsf-awards"]
GOOD = json.dumps([{"question": "Q1?", "answer": "A1 <<SRC:d:1>>"}, {"question": "", "answer": "x"},
                   {"question": "How to?", "answer": "A3"}])


def parse(spark, text, battery=True):
    df = spark.createDataFrame([(text,)], "t string")
    fn = pairs.parse_battery if battery else pairs.parse_discovery
    row = fn(df, "t", "p").first()
    return row.p_state, [(i.question, i.answer) for i in row.p_items]


@pytest.mark.parametrize(
    "text, state, items",
    [
        (GOOD, "ok", 3),
        (f"Sure:\n{GOOD}\nDone", "ok", 3),
        ("no array", "none", 0),
        ("[]", "ok", 0),
        ("] [", "none", 0),
        ('[{"question": "a"', "none", 0),
        ('[{"question": "a", "answer": "b"} x]', "malformed", 0),
        ("[1] y [2]", "malformed", 0),
        ("[1, 2]", "malformed", 0),
        ('[{"question":"a","answer":"b"}] y [{"question":"c","answer":"d"}]', "malformed", 0),
        ('[{"question":"a","answer":"b"}]] x [1]', "malformed", 0),
        ('{"pairs": [{"question":"a","answer":"b"}], "notes": [1]}', "malformed", 0),
        ('[{"question": "a"}]', "malformed", 0),
        (None, "none", 0),
    ],
)
def test_parse_battery(spark, text, state, items):
    found = parse(spark, text)
    assert (found[0], len(found[1])) == (state, items)


def test_discovery_keeps_items_without_answer(spark):
    assert parse(spark, '[{"question": "a"}]', battery=False) == ("ok", [("a", None)])


def merged(spark, first, second, keep=False, failed=False):
    df = spark.createDataFrame([(first, second)], "a string, b string")
    df = pairs.parse_discovery(pairs.parse_battery(df, "a"), "b")
    df = df.withColumn("items", pairs.merge_passes(F.lit(failed), keep))
    made = pairs.pair_array(
        F.col("items"), F.lit(SPEC.name), F.lit("7"), SPEC.source_ref(F.lit("7")), SPEC.keywords
    )
    return df.select(F.explode(made).alias("p")).select("p.*").collect()


def test_pairs_are_numbered_over_both_passes(spark):
    rows = merged(spark, GOOD, '[{"question": "x"}, {"question": "Q5", "answer": "A5"}]')
    assert [r.id for r in rows] == ["nsf-awards_7_1", "nsf-awards_7_3", "nsf-awards_7_5"]
    assert [r.metadata.complexity for r in rows] == ["simple", "moderate", "simple"]
    assert [r.metadata.has_citation for r in rows] == [True, False, False]
    assert rows[0].source_ref == "mcp://nsf-awards/awards/7"
    assert rows[0].source == "mcp_extraction"
    assert [(m.role, m.content) for m in rows[0].messages] == [("user", "Q1?"), ("assistant", "A1 <<SRC:d:1>>")]


def test_bad_second_pass_costs_all_pairs(spark):
    assert merged(spark, GOOD, "[oops]") == []
    assert merged(spark, GOOD, None, failed=True) == []
    assert len(merged(spark, GOOD, "[oops]", keep=True)) == 2


# ---- judge --------------------------------------------------------------------------------


def score(pid, f, r, c, **more):
    return {"pair_id": pid, "faithfulness": f, "relevance": r, "completeness": c, **more}


def judged(spark, answer, ids=("p1", "p2", "p3"), by_list=False):
    answer = answer if isinstance(answer, str) or answer is None else json.dumps(answer)
    df = spark.createDataFrame([(1, answer, list(ids))], "k int, t string, ids array<string>")
    built = F.transform("ids", lambda i: pairs.build_pair(i, F.lit("Q"), F.lit("A"), F.lit("r"), F.lit("d")))
    if by_list:
        rows = judge.apply_to_list(df.withColumn("pairs", built), "t").select(F.explode("pairs").alias("p"))
        rows = rows.select("p.*")
    else:
        flat = df.select("k", F.explode(built).alias("p")).select("k", "p.*")
        rows = judge.apply_to_rows(flat, judge.score_rows(df, ["k"], "t"), ["k"])
    return {r.id: r.metadata for r in rows.collect()}


@pytest.mark.parametrize("by_list", [True, False])
def test_scores(spark, by_list):
    answer = [
        score("p1", 0.9, 0.7, 0.85, issues=["short"]),
        score("p2", 0.1, 0.1, 0.1),
        score("p2", 0.8, 0.9, "0.95"),
        {"other": 1},
        score("nobody", 1, 1, 1),
    ]
    m = judged(spark, answer, by_list=by_list)
    assert (m["p1"].confidence_score, m["p1"].suggested_decision) == (0.7, "needs_review")
    assert m["p1"].eval_issues == ["short"]
    assert (m["p2"].confidence_score, m["p2"].suggested_decision) == (0.8, "approved")
    assert m["p2"].completeness_score == 0.95 and m["p2"].eval_issues == []
    assert m["p3"].confidence_score is None and m["p3"].suggested_decision is None
    assert m["p3"].eval_issues is None


@pytest.mark.parametrize("by_list", [True, False])
@pytest.mark.parametrize("answer", ["garbage", "[not json]", None, "[1, 2]"])
def test_unusable_judge_answer(spark, answer, by_list):
    m = judged(spark, answer, by_list=by_list)
    assert len(m) == 3 and all(x.confidence_score is None for x in m.values())


@pytest.mark.parametrize("by_list", [True, False])
def test_missing_and_bad_scores(spark, by_list):
    answer = [
        {"pair_id": "p1", "relevance": 0.9, "completeness": 0.9},
        score("p2", "high", 0.9, 0.9),
        score("p3", None, 0.9, 0.9),
    ]
    m = judged(spark, answer, by_list=by_list)
    assert (m["p1"].faithfulness_score, m["p1"].confidence_score) == (0.0, 0.0)
    assert m["p2"].confidence_score is None and m["p2"].relevance_score is None
    assert m["p3"].confidence_score is None


def test_judge_can_be_switched_off(spark):
    df = spark.createDataFrame([(1, "p")], "k int, id string")
    assert judge.apply_to_rows(df, df, ["k"], no_judge=True) is df
