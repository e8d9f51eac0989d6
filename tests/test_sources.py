import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.structured import short_hash
from corpusloom.operators import citations, incremental, pairs, review
from corpusloom.plans import publish
from corpusloom.plans.extract import scan_catalog, scan_catalog_details
from corpusloom.sources import landed, tables


def envelope(text):
    return {"content": [{"type": "text", "text": text if isinstance(text, str) else json.dumps(text)}]}


def land(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(data if isinstance(data, str) else json.dumps(data))


def test_envelope_scan(spark, tmp_path):
    one = {"id": "a", "name": "A", "hasGpu": True, "accessAllocated": {"x": 1}}
    cases = [
        (envelope({"resources": [one], "items": []}), ["a"]),
        (envelope({"items": [one]}), ["a"]),
        ({"resources": [one]}, ["a"]),
        (envelope("no json"), []),
        ({"content": [], "items": [one]}, ["a"]),
        ({"content": [{"type": "image"}], "items": [one]}, ["a"]),
        ({"other": 1}, []),
        (envelope({"resources": [], "items": [one]}), []),
        ("not json at all", []),
    ]
    for n, (data, expected) in enumerate(cases):
        folder = tmp_path / f"c{n}"
        land(folder, "page-1.json", data)
        rows = scan_catalog(spark, "compute-resources", str(folder)).collect()
        assert [r.id for r in rows] == expected, data


def test_paged_scans_keep_arrival_order(spark, tmp_path):
    for page in (1, 2, 10):
        land(tmp_path / "p", f"page-{page}.json", {"projects": [{"projectId": page * 10 + i} for i in range(2)], "pages": 3})
        awards = [{"id": str(page * 10 + i), "title": "t"} for i in range(2)]
        land(tmp_path / "a", f"offset{page}.json", {"response": {"award": awards}})
    projects = scan_catalog(spark, "allocations", str(tmp_path / "p")).orderBy("ordinal").collect()
    assert [r.projectId for r in projects] == ["10", "11", "20", "21", "100", "101"]
    awards = scan_catalog(spark, "nsf-awards", str(tmp_path / "a")).orderBy("ordinal").collect()
    assert [r.id for r in awards] == ["10", "11", "20", "21", "100", "101"]


def test_details_are_read_by_file_name(spark, tmp_path):
    land(tmp_path / "d", "42.json", envelope({"events": {"total": 1, "items": [{"title": "E"}]}}))
    land(tmp_path / "d", "43.json", "broken")
    rows = {r.entity_id: r.detail for r in scan_catalog_details(spark, "affinity-groups", str(tmp_path / "d")).collect()}
    assert rows["42"].events.total == 1 and rows["43"].events is None


def make_pairs(spark, n=3, ref="r"):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    built = pairs.build_pair(
        F.concat(F.lit("p"), "k"), F.concat(F.lit("Q é "), "k"), F.lit("A\nline <<SRC:d:1>>"), F.lit(ref), F.lit("d"),
        source_data=F.lit('{"a":{"b":[1,"x"]}}'),
    )
    return df.select(built.alias("p")).select("p.*")


def test_pair_file_round_trip(spark, tmp_path):
    made = make_pairs(spark)
    path = tables.write_pairs(made, str(tmp_path / "x.jsonl"))
    back = tables.load_pairs(spark, path)
    assert sorted(map(str, back.collect()))[0].startswith("Row(id='p0'")
    first = back.orderBy("id").first()
    assert first.messages[0].content == "Q é 0" and json.loads(first.metadata.source_data) == {"a": {"b": [1, "x"]}}
    line = json.loads(spark.read.text(path).first().value)
    assert line["metadata"]["source_data"] == {"a": {"b": [1, "x"]}}
    assert "confidence_score" in line["metadata"] and line["metadata"]["confidence_score"] is None
    assert "part" not in line


def test_write_by_source_and_combined(spark, tmp_path):
    by_source = {"one": make_pairs(spark, 2), "two": make_pairs(spark, 1), "none": make_pairs(spark, 0)}
    folder = tables.write_all(by_source, str(tmp_path / "all"))
    assert sorted(p.name for p in (tmp_path / "all").iterdir() if p.is_dir()) == ["source_key=one", "source_key=two"]
    assert tables.load_pairs(spark, f"{folder}/source_key=one").count() == 2
    path = tables.write_combined(by_source, str(tmp_path))
    assert path.endswith("combined_qa_pairs.jsonl") and tables.load_pairs(spark, path).count() == 3


@pytest.mark.parametrize("change", ["role", "source", "missing", "json"])
def test_bad_pair_line_fails(spark, tmp_path, change):
    good = json.loads(make_pairs(spark, 1).select(tables.pair_line(make_pairs(spark, 1)).alias("v")).first().v)
    good["messages"][0]["role"] = "system" if change == "role" else "user"
    if change == "source":
        good["source"] = "elsewhere"
    if change == "missing":
        del good["source_ref"]
    text = json.dumps(good)[:-3] if change == "json" else json.dumps(good)
    (tmp_path / "x.jsonl").write_text(text + "\n\n")
    with pytest.raises(Exception):
        tables.load_pairs(spark, str(tmp_path / "x.jsonl")).collect()


def test_blank_lines_are_skipped(spark, tmp_path):
    made = make_pairs(spark, 1)
    line = made.select(tables.pair_line(made).alias("v")).first().v
    (tmp_path / "x.jsonl").write_text(f"\n{line}\n\n")
    assert tables.load_pairs(spark, str(tmp_path / "x.jsonl")).count() == 1


def test_only_an_absent_cache_is_empty(spark, tmp_path):
    assert tables.load_cache(spark, None).count() == 0
    assert tables.load_cache(spark, str(tmp_path / "nowhere")).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("{oops")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        tables.load_cache(spark, str(tmp_path / "bad"))
    assert tables.load_cache(spark, str(tmp_path / "bad"), on_corrupt="empty").count() == 0


def test_pages_never_tie_or_overflow(spark, tmp_path):
    names = ["a.json", "b.json", "page-1-of-2.json", "page-2-of-2.json", "page-10-of-2.json", f"awards-{'9' * 30}.json"]
    for i, name in enumerate(names):
        land(tmp_path, name, [{"id": str(i), "name": f"n{i}"}])
    pages = landed.read_pages(spark, str(tmp_path)).orderBy("page").collect()
    assert [r.page for r in pages] == list(range(1, 7))
    assert [r.key for r in pages] == [n[:-5] for n in ["a.json", names[5], "b.json", *names[2:5]]]
    # bare lists are bodies, too
    items = landed.scan_items(spark, str(tmp_path), "struct<id:string,name:string>", ("items",)).collect()
    assert sorted(r.id for r in items) == list("012345") and len({r.ordinal for r in items}) == 6


def test_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "x2.jsonl").write_text("\n".join(json.dumps({"id": i}) for i in range(5)) + "\n\n")
    (tmp_path / "x10.jsonl").write_text(json.dumps({"id": 9}))
    rows = landed.read_lines(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [json.loads(r.value)["id"] for r in rows] == [0, 1, 2, 3, 4, 9]


def test_known_entities_of_scans(spark, tmp_path):
    land(tmp_path, "p1.json", {"response": {"award": [{"id": "7", "title": "t"}, {"id": "8", "title": "u"}]}})
    known, loaded = citations.load_known({"nsf-awards": scan_catalog(spark, "nsf-awards", str(tmp_path))})
    assert {r.entity_id for r in known.collect()} == {"7", "8"} and loaded == ["nsf-awards"]
    nothing, _ = citations.load_known({"nsf-awards": None})
    assert nothing.count() == 0 and nothing.columns == ["domain", "entity_id"]


# ---- cache --------------------------------------------------------------------------------------


def entities(spark, rows):
    df = spark.createDataFrame([("d", i, n, v) for n, (i, v) in enumerate(rows)],
                               "domain string, entity_id string, ordinal bigint, v string")
    return incremental.with_hash(df.withColumn("entity", F.struct("v")))


def entries(spark, hashed, pair_count=1):
    listed = F.array(*[pairs.build_pair(F.lit(f"x{i}"), F.lit("Q"), F.lit("A"), F.lit("r"), F.lit("d"))
                       for i in range(max(pair_count, 1))])
    return hashed.select("domain", "entity_id", "ordinal", short_hash(F.col("full_hash")).alias("hash"), "full_hash",
                         F.slice(listed, 1, pair_count).alias("pairs"))


def test_plan_replay_and_stats(spark):
    cache = entries(spark, entities(spark, [("a", "1"), ("b", "1"), ("c", "1")]), 3).drop("ordinal")
    empty = cache.withColumn("pairs", F.when(F.col("entity_id") == "c", F.slice("pairs", 1, 0)).otherwise(F.col("pairs")))
    planned = incremental.plan(entities(spark, [("a", "1"), ("b", "2"), ("c", "1"), ("d", "1")]), empty)
    rows = {r.entity_id: (r.hit, r.reuse) for r in planned.collect()}
    assert rows == {"a": (True, True), "b": (False, False), "c": (True, False), "d": (False, False)}
    assert tuple(incremental.cache_stats(planned).first()) == (2, 2)
    assert [r.id for r in incremental.replay(planned).orderBy("sub").collect()] == ["x0", "x1", "x2"]
    assert {r.entity_id for r in incremental.to_generate(planned).collect()} == {"b", "c", "d"}


def test_upsert_keeps_unseen_keys_and_takes_the_last_write(spark):
    cache = entries(spark, entities(spark, [("a", "1"), ("b", "1")])).drop("ordinal")
    new = entries(spark, entities(spark, [("b", "2"), ("b", "3"), ("c", "1")]), 2)
    merged = {r.entity_id: (r.full_hash, len(r.pairs)) for r in incremental.upsert(cache, new).collect()}
    third = {r.ordinal: r.full_hash for r in new.collect()}[1]
    assert set(merged) == {"a", "b", "c"} and merged["b"] == (third, 2) and merged["a"][1] == 1
    assert incremental.upsert(tables.empty_cache(spark), new).count() == 2


# ---- citations -------------------------------------------------------------------------------------


def test_validate(spark):
    known = spark.createDataFrame([("res", "a"), ("res", "b"), ("sw", "Py")], "domain string, entity_id string")
    texts = ["<<SRC:res:a>> and <<SRC:res:zzz>>", "<<SRC:res:a>><<SRC:docs:any:thing>>", "none <<SRC:broken", "<<SRC:sw:py>>",
             "<<SRC:gone:x>>"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, a string")
    built = pairs.build_pair(F.col("n").cast("string"), F.lit("Q"), F.col("a"), F.lit("r"), F.lit("d"))
    made = df.select(built.alias("p")).select("p.*")
    result = publish.validate(made, known, ["res", "sw", "gone"])
    rows = {r.id: (r.citations, r.invalid, r.has_citations, r.all_valid) for r in result.verdicts.collect()}
    assert rows == {"0": (2, 1, True, False), "1": (2, 0, True, True), "2": (0, 0, False, False),
                    "3": (1, 1, True, False), "4": (1, 1, True, False)}
    errors = {r.raw: r.error for r in result.checked.collect()}
    assert errors["<<SRC:res:zzz>>"] == "Entity 'zzz' not found in res" and errors["<<SRC:res:a>>"] is None
    s = result.summary.first()
    assert (s.valid, s.invalid, s.none, s.total, s.valid_percent, s.ok) == (1, 3, 1, 5, 20, False)
    relaxed = publish.validate(made, known, ["res", "sw", "gone"], case_insensitive=("sw",))
    assert relaxed.summary.first().invalid == 2
    top = citations.invalid_top(result.verdicts, "id", 2).collect()
    assert [r.id for r in top] == ["0", "3"] and top[0].preview == "Q..."
    own = citations.from_pairs(df.select(F.col("n").alias("id"), F.col("a").alias("answer")))
    assert publish.validate(made, own, ["res", "sw", "gone", "docs"]).summary.first().invalid == 0
    none = publish.validate(made.limit(0), known, ["res"]).summary.first()
    assert (none.total, none.valid_percent, none.ok) == (0, None, True)


def test_validate_repeated_ids(spark):
    known = spark.createDataFrame([("d", "1")], "domain string, entity_id string")
    rows = [("twice", "<<SRC:d:9>>"), ("twice", "nothing"), ("same", "<<SRC:d:1>>"), ("same", "<<SRC:d:1>>")]
    df = spark.createDataFrame(rows, "n string, a string")
    built = pairs.build_pair(F.col("n"), F.lit("Q"), F.col("a"), F.lit("r"), F.lit("d"))
    result = publish.validate(df.select(built.alias("p")).select("p.*"), known, ["d"])
    rows = sorted((r.id, r.citations, r.has_citations, r.all_valid) for r in result.verdicts.collect())
    assert rows == [("same", 1, True, True), ("same", 1, True, True), ("twice", 0, False, False), ("twice", 1, True, False)]
    with pytest.raises(ValueError, match="1 of 4"):
        result.require_valid()


def test_created_at_is_utc(spark):
    from datetime import UTC, datetime, timedelta

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        made = datetime.fromisoformat(make_pairs(spark, 1).first().metadata.created_at)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert made.utcoffset() == timedelta(0) and abs(datetime.now(UTC) - made) < timedelta(minutes=5)


def test_known_entities_of_missing_catalogs(spark):
    df = spark.createDataFrame([("1", None), ("", "x"), (None, None), ("1", "y")], "id string, resource_id string")
    known, loaded = citations.load_known({"compute-resources": df, "nsf-awards": None})
    assert sorted(r.entity_id for r in known.collect()) == ["1", "x"]
    assert loaded == ["compute-resources", "nsf-awards"]
    assert citations.load_known({"compute-resources": df, "nsf-awards": None}, on_missing="skip")[1] == ["compute-resources"]
    assert citations.known_in(known, "compute-resources").count() == 2
    by_resource = spark.createDataFrame([("gcc",)], "Name string")
    empty = spark.createDataFrame([], "name string")
    assert citations.known_software(empty, by_resource).first().entity_id == "gcc"


# ---- review table ------------------------------------------------------------------------------------


def live(spark, rows):
    """rows: id, ref, list of (question, value, status)"""
    from corpusloom.schema import REVIEW

    data = [(i, ref, "q", "a", "", "", None, None, [tuple(x) for x in resp]) for i, ref, resp in rows]
    return spark.createDataFrame(data, REVIEW)


DEPTHS = [
    ([], "approved_only"),
    ([("review_decision", "approved", "submitted")], "approved_only"),
    ([("edited_question", "x", "submitted")], "has_edits"),
    ([("edited_answer", "x", "submitted")], "has_edits"),
    ([("rejection_notes", "x", "submitted")], "has_edits"),
    ([("edited_answer", "", "submitted")], "approved_only"),
    ([("edited_answer", "x", "draft")], "approved_only"),
    ([("edited_answer", None, "submitted"), ("edited_question", "y", None)], "approved_only"),
]


def test_annotation_depth(spark):
    table = live(spark, [(str(n), "r", resp) for n, (resp, _) in enumerate(DEPTHS)])
    rows = {r.id: r.d for r in table.select("id", review.annotation_depth().alias("d")).collect()}
    assert rows == {str(n): depth for n, (_, depth) in enumerate(DEPTHS)}


def test_push_replaces_and_archives(spark, tmp_path):
    table = live(spark, [
        ("1", "r", [("edited_answer", "x", "submitted")]), ("2", "r", []), ("3", "other", [("review_decision", "a", "submitted")]),
    ])
    wide = [1.0, 2.0] * 192
    vectors = spark.createDataFrame([("p0", wide)], "id string, vector array<float>")
    narrow = vectors.withColumn("vector", F.slice("vector", 1, 64))
    with pytest.raises(Exception, match="not 384 wide"):
        publish.push(table, make_pairs(spark, 2), narrow).live.collect()
    result = publish.push(table, make_pairs(spark, 2), vectors)
    assert tuple(result.counts.first()) == (2, 2, 1, 1)
    kept = {r.id: r for r in result.live.collect()}
    assert set(kept) == {"3", "p0", "p1"}
    assert kept["p0"].vector == wide and kept["p1"].vector is None
    assert kept["p0"].source_data == '```json\n{\n  "a": {\n    "b": [\n      1,\n      "x"\n    ]\n  }\n}\n```'
    assert kept["p0"].metadata.has_citation == "True" and kept["p0"].metadata.source_type == "mcp_extraction"
    old = result.archived.collect()
    assert len(old) == 1 and old[0].replaced_reason == "source_data_changed" and old[0].annotation_depth == "has_edits"
    assert old[0].archived_at and "id" not in result.archived.columns

    path = tables.write_pairs(make_pairs(spark, 2), str(tmp_path / "in.jsonl"))
    new = publish.push_file(spark, table, path, str(tmp_path / "live"), str(tmp_path / "archive"))
    assert spark.read.parquet(new).count() == 3 and spark.read.parquet(str(tmp_path / "archive")).count() == 1
    nothing = publish.push(table, make_pairs(spark, 0))
    assert tuple(nothing.counts.first()) == (0, 0, 0, 0) and nothing.live.count() == 3
