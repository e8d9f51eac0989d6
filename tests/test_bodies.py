"""Documents read in ranges: against plain JSON parsing, with ranges of a few bytes to many."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import bodies, landed

ITEM = "struct<id:string,name:string,items:array<struct<id:string>>,note:string>"
KEYS = ("projects", "items", "response.award")

NASTY = ['a}b', 'a"b', "back\\slash", "tail\\", '{"projects":[{"id":"no"}]}', '"projects":[', "[,]", "é😀\n\t", "", "\\\"}", "x" * 300]


def item(rng, n):
    one = {"id": str(n), "name": rng.choice(NASTY)}
    if rng.random() < 0.5:
        one["items"] = [{"id": rng.choice(NASTY)} for _ in range(rng.randint(0, 3))]
    if rng.random() < 0.3:
        one["note"] = rng.choice(NASTY)
        one["deep"] = {"a}": [[{"projects": [1, 2]}], {"items": []}]}
    return one


def pieces(text, rng, cuts):
    """Ranges as Spark's reader gives them: cut behind braces, at most ``cuts`` times."""
    records = [r + "}" for r in text.split("}")]
    if records[-1] == "}":
        records.pop()  # the text ended with a brace
    borders = sorted(rng.sample(range(1, len(records)), min(cuts, len(records) - 1))) if len(records) > 1 else []
    size, out, low = len(text.encode()), [], 0
    for n, high in enumerate([*borders, len(records)]):
        out += [(n * 1000, r, size) for r in records[low:high]]
        low = high
    return out


def ranged(spark, documents, cuts, seed=0, keys=KEYS):
    rng = random.Random(seed)
    rows = [(f"f{n}", *p) for n, text in enumerate(documents) for p in pieces(text, rng, cuts)]
    df = spark.createDataFrame(rows, "path string, block long, value string, size long").coalesce(1)
    got = {f"f{n}": [] for n in range(len(documents))}
    for r in bodies.listed(df, keys).orderBy("path", "position").collect():
        assert r.position == len(got[r.path])
        got[r.path].append(json.loads(r.text))
    return [got[f"f{n}"] for n in range(len(documents))]


def whole(text):
    """The rule, on a parsed document."""
    try:
        body = json.loads(text)
    except ValueError:
        return []
    if isinstance(body, dict) and isinstance(body.get("content"), list) and body["content"]:
        if body["content"][0].get("type") == "text":
            return whole(body["content"][0].get("text") or "")
    if isinstance(body, list):
        return body
    for key in KEYS:
        value = body
        for part in key.split("."):
            value = value.get(part) if isinstance(value, dict) else None
        if isinstance(value, list):
            return value
    return []


def documents():
    rng = random.Random(4)
    some = [item(rng, n) for n in range(40)]
    dump = lambda v: json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
    plain = [
        {"projects": some, "pages": 3},
        {"pages": 3, "meta": {"projects": [1], "x": [[1], [2]]}, "projects": some},
        {"items": some[:9], "projects": some[9:]},
        {"items": some, "projects": None},
        {"items": some, "projects": {"a": 1}},
        {"response": {"meta": {}, "award": some}},
        {"other": {"award": some}, "award": some},
        {"projects": [], "items": some},
        {"projects": [some[0]]},
        {"a}projects": some, 'a"projects': some, "items": some[:2]},
        some,
        [],
        {},
        {"none": 1},
    ]
    out = [dump(v) for v in plain]
    out += [out[0] + "\n", "\n " + out[5] + " \n\n"]
    out += [out[0][:-1], out[0][: len(out[0]) // 2], out[0][: out[0].rindex("]") + 1], "no json", ""]
    out += [dump({"content": [{"type": "text", "text": t}]}) for t in (out[0], out[5], out[10], "error: " + out[0], "")]
    out += [dump({"isError": False, "content": [{"text": out[0], "type": "text"}]}), dump({"content": [{"type": "image", "text": "{}"}], "items": some})]
    out += ['{"projects":[{"id":"1"}],"projects":[{"id":"2"},{"id":"3"}]}']
    return out


@pytest.mark.parametrize("cuts", [0, 3, 1000])
def test_ranges_equal_whole_documents(spark, cuts):
    texts = documents()
    expected = [whole(t) for t in texts]
    assert sum(map(bool, expected)) > 15
    for n, (got, want) in enumerate(zip(ranged(spark, texts, cuts, seed=cuts), expected, strict=True)):
        assert got == want, (n, texts[n][:200])


def test_outlines_compose_in_any_grouping():
    rng = random.Random(8)
    text = json.dumps([item(rng, n) for n in range(30)])
    records = [(r + "}").encode() for r in text.split("}")]
    wanted = bodies.wanted_lists(KEYS)
    at = [0]
    for r in records:
        at.append(at[-1] + len(r))
    both = [{i: bodies.outline(r, bodies.marks(r), i, (0, at[n]), wanted) for i in (False, True)} for n, r in enumerate(records)]

    def fold(parts, inside):
        out = bodies.Outline(inside)
        for p in parts:
            out = out.then(p[out.inside])
        return out

    everything = fold(both, False)
    for split in range(1, len(both), 7):
        left, right = {i: fold(both[:split], i) for i in (False, True)}, {i: fold(both[split:], i) for i in (False, True)}
        assert fold([left, right], False) == everything


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    some = [item(rng, n) for n in range(3000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "page-2.json").write_text(json.dumps({"projects": some, "pages": 2}))
    (tmp_path / "in" / "page-10.json").write_text(json.dumps({"content": [{"type": "text", "text": json.dumps({"items": some[:1500]})}]}))
    (tmp_path / "in" / "page-1.json").write_text(json.dumps({"items": some[:3]}))
    path = str(tmp_path / "in")
    expected = [tuple(r) for r in landed.scan_items(spark, path, ITEM, KEYS).orderBy("ordinal").collect()]
    assert len(expected) == 4503 and expected[3][0] == 2 * landed.PAGE_STRIDE
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "20000")
        ranges = bodies.large_rows(spark, path, 10_000).select("path", "block").distinct().groupBy("path").agg(F.count("*").alias("n"))
        assert ranges.agg(F.min("n")).first()[0] > 10
        got = landed.scan_items(spark, path, ITEM, KEYS, large=10_000)
        assert got.columns == landed.scan_items(spark, path, ITEM, KEYS).columns
        assert [tuple(r) for r in got.orderBy("ordinal").collect()] == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_start_rows_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(bodies, "BROADCAST_RANGES", 0)
    texts = documents()[:6]
    assert ranged(spark, texts, 5) == [whole(t) for t in texts]
