import json

from pyspark.sql import functions as F

from corpusloom.operators import domains, incremental, infer, prompts, reports
from corpusloom.plans.extract import extract_domain, run
from corpusloom.settings import ExtractionConfig
from corpusloom.sources import landed, tables
from corpusloom.streaming.watch import watch


def items(spark, name, data):
    spec = domains.REGISTRY[name]
    df = spark.createDataFrame([(1, json.dumps(data))], "page bigint, value string")
    return landed.explode_items(df, spec.item_type, spec.list_keys)


def details(spark, name, by_id):
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in by_id.items()], "key string, value string")
    return landed.explode_details(df, domains.REGISTRY[name].detail_type)


def cleaned(spark, name, data, by_id=None, config=ExtractionConfig()):
    spec = domains.REGISTRY[name]
    picked = domains.pick(spec, items(spark, name, data), config)
    if by_id is not None:
        picked = domains.attach_details(picked, details(spark, name, by_id), spec)
    else:
        picked = domains.attach_details(picked, None, spec)
    rows = domains.cleaned(spec, picked, config)
    return [
        (r.entity_id, json.loads(r.e), r.record)
        for r in rows.select("entity_id", F.to_json("entity").alias("e"), "record", "ordinal").orderBy("ordinal").collect()
    ]


AWARD = {"id": "2345678", "title": "Cyber", "piFirstName": "Pat", "piLastName": "Lee", "coPDPI": "Jane Smith; Bob Jones",
         "awardeeName": "MIT", "estimatedTotalAmt": "1500000", "fundProgramName": ["OAC", "CISE"], "abstractText": "<p>x</p>"}


def test_awards(spark):
    data = {"response": {"award": [AWARD, AWARD, {"id": "2", "title": ""}, {"id": "3", "title": "T", "coPDPI": [" A ", ""]}]}}
    rows = cleaned(spark, "nsf-awards", data)
    assert [r[0] for r in rows] == ["2345678", "3"]
    assert rows[0][1] == {
        "title": "Cyber", "principal_investigator": "Pat Lee", "institution": "MIT", "total_intended_award": "$1,500,000",
        "fund_program_name": "OAC; CISE", "primary_program_budget_code": "", "abstract": "x", "co_pis": ["Jane Smith", "Bob Jones"],
    }
    assert rows[1][1]["co_pis"] == ["A"] and rows[1][2].has_co_pis and rows[0][2].total_award == "$1,500,000"


def test_projects_are_not_deduplicated(spark):
    one = {"projectId": 7, "requestTitle": "T", "pi": "P", "piInstitution": "I", "fos": "CS", "abstract": "<p>Long <b>text</b></p>",
           "resources": [{"resourceName": "Delta GPU", "units": "h", "allocation": 1.5}, {"resourceName": "", "units": "x"},
                         {"resourceName": "Disk"}]}
    other = {"projectId": "", "requestNumber": "REQ1", "requestTitle": "U"}
    rows = cleaned(spark, "allocations", {"projects": [one, one, other, {"projectId": 9}]})
    assert [r[0] for r in rows] == ["7", "7", "REQ1"]
    entity, record = rows[0][1], rows[0][2]
    assert entity["abstract"] == "Long text" and entity["resources"] == [
        {"name": "Delta GPU", "units": "h", "allocation": 1.5}, {"name": "Disk", "units": "", "allocation": ""}]
    assert record.resource_count == 3 and record.resource_names == ["Delta GPU", "Disk"]
    assert "resources" not in rows[2][1] and "beginDate" not in rows[2][1]


def test_groups(spark):
    data = {"items": [{"id": 42, "name": "G", "description": "<b>d</b>", "category": "T", "support_url": "http://s"},
                      {"id": 42, "name": "G2"}, {"id": 43, "name": "H"}]}
    events = [{"title": t} for t in ["a", "", "c", "d", "e", "f"]]
    detail = {"42": {"events": {"total": 6, "items": events}, "knowledge_base": {"total": 1, "items": [{"title": "k"}]}}, "43": {}}
    rows = cleaned(spark, "affinity-groups", data, detail)
    assert [r[0] for r in rows] == ["42", "43"]
    entity = rows[0][1]
    assert [e["title"] for e in entity["upcoming_events"]] == ["a", "c", "d", "e"]
    assert entity["knowledge_base_topics"] == ["k"] and entity["support_url"] == "http://s" and "slack_link" not in entity
    assert rows[0][2].has_events and rows[0][2].has_knowledge_base and not rows[1][2].has_events
    assert "upcoming_events" not in rows[1][1]


def test_resources(spark):
    long = "x" * 20 + " NVIDIA A100 40GB and nvidia v100 and A100 " + "y" * 20
    data = {"resources": [
        {"id": "d", "name": "Delta - COMING SOON", "description": "<p>a</p>", "feature_names": ["Unknown 12", "F"],
         "organization_names": ["O"], "hasGpu": True, "accessAllocated": [1]},
        {"id": "e", "name": "E"}, {"id": "", "name": "x"}]}
    hw = {"hardware": {"gpus": [{"name": "A100", "details": "z" * 51}, {"name": "tiny", "details": "<i>" + "z" * 50 + "</i>"}],
                       "compute_nodes": [{"name": "n", "details": long}], "storage": []}}
    rows = cleaned(spark, "compute-resources", data, {"d": hw})
    entity, record = rows[0][1], rows[0][2]
    assert [r[0] for r in rows] == ["d", "e"]
    assert entity["name"] == "Delta (coming soon)" and record.name == "Delta" and entity["feature_names"] == ["F"]
    assert [g["name"] for g in entity["hardware"]["gpus"]] == ["A100"] and "storage" not in entity["hardware"]
    assert record.gpu_types == ["A100", "A100 40GB", "V100"] and entity["accessAllocated"] == [1]
    assert "hardware" not in rows[1][1] and rows[1][2].gpu_types == [] and rows[1][2].has_gpu is False


def test_software(spark):
    one = {"name": "pytorch", "description": "The PyTorch lib", "versions": [], "documentation": {"u": 1}, "website": "",
           "available_on_resources": [{"resource_id": "d"}, {"name": "n"}, "p", 7, {}, "", {"resource_id": None, "name": "gone"}],
           "ai_metadata": {"tags": ["t"], "research_area": "", "example_use": "e" * 1501, "core_features": "fast"}}
    data = {"items": [one, {"name": "PyTorch"}, {"name": ""}, {"name": "GCC", "available_on_resources": "all"}]}
    rows = cleaned(spark, "software-discovery", data)
    assert [r[0] for r in rows] == ["pytorch", "gcc"]
    entity, record = rows[0][1], rows[0][2]
    assert set(entity) == {"name", "description", "available_on_resources", "documentation", "tags", "core_features", "example_use"}
    assert entity["name"] == "PyTorch" and entity["example_use"] == "e" * 1500 + "..." and entity["documentation"] == {"u": 1}
    assert record.name == "pytorch" and record.resources == ["d", "n", "p", "7"]
    assert rows[1][2].resources == [] and rows[1][1] == {"name": "GCC", "available_on_resources": "all"}


def test_allow_list_then_cap(spark):
    data = {"response": {"award": [{"id": str(i), "title": "t"} for i in range(6)]}}
    rows = cleaned(spark, "nsf-awards", data, config=ExtractionConfig(entity_ids=("1", "3", "5"), max_entities=2))
    assert [r[0] for r in rows] == ["1", "3"]


def test_failed_call_costs_one_entity_and_second_run_generates_nothing(spark, tmp_path):
    def failing_backend():
        def call(system, user, max_tokens):
            if "Entity ID: 2" in user:
                raise RuntimeError("down")
            return infer.echo_backend()(system, user, max_tokens)

        return call

    data = {"response": {"award": [{"id": str(i), "title": f"T{i}", "fundProgramName": "P"} for i in range(1, 4)]}}
    frames = {"nsf-awards": items(spark, "nsf-awards", data), "unknown": items(spark, "nsf-awards", data)}
    first = run(spark, frames, failing_backend, judge=infer.echo_backend)
    made = first.pairs["nsf-awards"].collect()
    assert sorted(r.id for r in made) == ["nsf-awards_1_1", "nsf-awards_3_1"]
    failed = {(r.entity_id, r.stage) for r in first.errors["nsf-awards"].collect()}
    assert ("2", "battery") in failed and {e for e, _ in failed} == {"2"}
    assert all("down" in r.message for r in first.errors["nsf-awards"].collect())
    assert {(r.stage, r.failed) for r in first.error_counts().collect()} >= {("battery", 1)}
    assert all(r.metadata.confidence_score == 0.8 and r.metadata.suggested_decision == "approved" for r in made)
    assert first.records["nsf-awards"].count() == 3 and "unknown" not in first.pairs
    assert [r.id for r in first.pairs["comparisons"].collect()] == ["cmp_nsf_prog_p"]
    path = tables.write_snapshot(first.cache, str(tmp_path / "cache"))
    cache = tables.load_cache(spark, path)
    assert {r.entity_id: len(r.pairs) for r in cache.collect()} == {"1": 1, "2": 0, "3": 1}

    def never():
        def call(system, user, max_tokens):
            if "Entity ID: 2" not in user:
                raise AssertionError("called again")
            return "[]"

        return call

    second = run(spark, frames, never, cache=cache)
    assert sorted(map(str, second.pairs["nsf-awards"].collect())) == sorted(map(str, made))
    assert tuple(incremental.cache_stats(second.planned["nsf-awards"]).first()) == (3, 0)
    assert second.cache.count() == 3
    summary = {r.source_key: (r.pairs, r.domains) for r in reports.run_summary(second.all_pairs()).collect()}
    assert summary == {"nsf-awards": (2, "nsf-awards"), "comparisons": (1, "nsf-awards"), "Total": (3, "")}


def test_no_judge_and_bad_answers(spark):
    data = {"response": {"award": [{"id": str(i), "title": f"T{i}"} for i in range(1, 6)]}}

    def backend():
        good = '[{"question": "Q", "answer": "A"}, {"question": "", "answer": "x"}, {"question": "R", "answer": "B"}]'
        answers = {"1": good, "2": "nothing", "3": "[broken", "4": "[{]", "5": good}

        def call(system, user, max_tokens):
            key = user.split("\n")[0][-1]
            if "Pairs so far:" in system:
                assert "1. **Q:** Q\n   **A:** A" in system
                return "[{]" if key == "5" else '[{"question": "S", "answer": "C"}]'
            return answers[key]

        return call

    out = extract_domain(
        domains.REGISTRY["nsf-awards"], items(spark, "nsf-awards", data), backend,
        ExtractionConfig(no_judge=True), judge=infer.echo_backend,
    )
    rows = {r.id: r.metadata for r in out.pairs.collect()}
    assert set(rows) == {"nsf-awards_1_1", "nsf-awards_1_3", "nsf-awards_1_4"}
    assert all(m.confidence_score is None and len(m.source_hash) == 16 for m in rows.values())


def test_judge_prompt_holds_all_pairs(spark):
    rows = spark.createDataFrame(
        [("e", n, f"e_{n}", f"Q{n}", f"A{n}") for n in range(1, 6)], "k string, seq int, id string, question string, answer string"
    )
    one = prompts.judge_batches(rows, ["k"], "seq").collect()
    assert len(one) == 1 and one[0].pairs == 5
    assert one[0].pairs_block.startswith("### e_1\n**Q:** Q1\n**A:** A1\n\n### e_2\n")
    cut = prompts.judge_batches(rows, ["k"], "seq", batch=2).orderBy("block").collect()
    assert [r.pairs for r in cut] == [2, 2, 1]
    assert "\n".join(r.pairs_block for r in cut) == one[0].pairs_block


def test_prompts_of_every_domain(spark):
    assert prompts.guidance_table(spark).count() == 28
    for name, spec in domains.REGISTRY.items():
        text = prompts.battery_system(name)
        assert spec.entity_type in text and len(prompts.FIELD_GROUPS[name]) == prompts.guidance_block(name).count("Data fields")
        assert all(fields in text for fields, _, _ in prompts.FIELD_GROUPS[name])
        owned = [prompts.battery_system(name, "Demo"), prompts.discovery_parts(name, "Demo")[0]]
        assert all(f"about Demo {spec.display}." in t for t in owned) and f"about {spec.display}." in text
    df = spark.createDataFrame([("x", [])], "d string, i array<struct<question:string,answer:string>>")
    assert prompts.NO_PAIRS in df.select(prompts.existing_block(F.col("i"))).first()[0]
    row = spark.range(1).select(prompts.user_prompt(F.lit("d"), F.lit("7"), F.lit("{}"), F.lit(""))).first()
    assert row[0] == "Entity ID: 7\nEntity name: 7\nCitation marker: <<SRC:d:7>>\n\nData:\n{}"


def test_coverage(spark):
    df = spark.createDataFrame(
        [("a", 0, "A COMING SOON", ""), ("b", 1, "B COMING SOON", "d"), ("c", 2, "C", ""), ("", 3, "D", ""), ("c", 4, "C", "")],
        "entity_id string, ordinal int, name string, description string",
    )
    row = reports.coverage(df, "s", required=("name",), skip=reports.coming_soon()).first()
    assert (row.fetched, row.unique_entities, row.sample_ids) == (5, 3, "b, c, c")
    row = reports.coverage(df, "s", distinct=True).first()
    assert (row.fetched, row.unique_entities, row.sample_ids) == (5, 3, "a, b, c")
    row = reports.page_estimate(df, F.lit(4), "s", "entity_id").first()
    assert (row.fetched, row.unique_entities, row.sample_ids) == (20, 20, "a, b, c, c")


def test_stats_of_an_empty_file(spark):
    from corpusloom.schema import PAIR

    row = reports.citation_share(spark.createDataFrame([], PAIR)).first()
    assert (row.total, row.with_citation, row.percent) == (0, 0, None)


def test_embed(spark):
    rows = spark.createDataFrame([("a", "xy"), ("b", "xyz")], "id string, question string")

    def encoder():
        return lambda texts: [[float(len(t))] * 3 for t in texts]

    found = {r.id: r.vector for r in infer.embed(rows, encoder).collect()}
    assert found == {"a": [2.0] * 3, "b": [3.0] * 3}


def test_config_from_environment(monkeypatch):
    monkeypatch.setenv("EXTRACT_MAX_ENTITIES", "3")
    assert ExtractionConfig.from_env(max_tokens=9) == ExtractionConfig(max_entities=3, max_tokens=9)


def test_watch_extracts_new_pages_once(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    out = str(tmp_path / "out")

    def land(n, ids):
        data = {"response": {"award": [{"id": i, "title": f"T{i}"} for i in ids]}}
        (pages / f"page-{n}.json").write_text(json.dumps(data))

    land(1, ["1", "2"])
    watch(spark, "nsf-awards", str(pages), out, infer.echo_backend).awaitTermination()
    land(2, ["3"])
    watch(spark, "nsf-awards", str(pages), out, infer.echo_backend).awaitTermination()
    assert spark.read.parquet(f"{out}/pairs/0").count() == 2 and spark.read.parquet(f"{out}/pairs/1").count() == 1
    assert tables.load_cache(spark, f"{out}/cache/1").count() == 3


def test_coverage_of_all_catalogs(spark):
    from corpusloom import coverage

    def pages(*data):
        return spark.createDataFrame([(n, json.dumps(d)) for n, d in enumerate(data, 1)], "page bigint, value string")

    rows = coverage({
        "compute-resources": pages({"resources": [{"id": "a", "name": "A COMING SOON"}, {"id": "b", "name": "B"}]}),
        "software-discovery": pages({"items": [{"name": n} for n in ["GCC", "gcc", "", "abc"]]}),
        "allocations": pages({"projects": [{"projectId": 1}, {"requestNumber": "r"}], "pages": 3}, {"projects": [{"projectId": 9}]}),
        "nsf-awards": pages({"response": {"award": [{"id": "1"}, {"id": ""}]}}),
        "affinity-groups": pages({"groups": [{"id": 1}, {"id": 1}, {"id": 2}]}),
    }).collect()
    assert {r.source: (r.fetched, r.unique_entities, r.sample_ids) for r in rows} == {
        "compute-resources": (2, 1, "b"),
        "software-discovery": (4, 2, "abc, gcc"),
        "allocations": (6, 6, "1"),
        "nsf-awards": (2, 1, "1"),
        "affinity-groups": (3, 2, "1, 2"),
    }


def test_exact_coverage_of_projects(spark):
    from corpusloom import coverage

    data = [{"projects": [{"projectId": 1}, {"requestNumber": "r"}, {}], "pages": 9}, {"projects": [{"projectId": 1}, {"projectId": 3}]}]
    pages = spark.createDataFrame([(n, json.dumps(d)) for n, d in enumerate(data, 1)], "page bigint, value string")
    (row,) = coverage({"allocations": pages}, exact=True).collect()
    assert (row.fetched, row.unique_entities, row.sample_ids) == (5, 3, "1, 3, r")
    (row,) = coverage({"allocations": pages.where("page > 9")}, exact=True).collect()
    assert (row.fetched, row.unique_entities, row.sample_ids) == (0, 0, "")


def test_new_domain_with_pre_filter(spark):
    spec = domains.DomainSpec(
        name="datasets", collection="sets", item_type="struct<id:string,name:string,year:int>", list_keys=("sets",),
        entity_id=lambda: F.col("id"), entity_name=lambda: F.col("name"),
        clean=lambda df, config: F.struct("name", "year"), record=lambda df: [F.col("name")],
        source_data=lambda: F.col("entity"), display="data sets", entity_type="data set",
        pre_filter=lambda: F.col("year") > 2000,
    )
    domains.register(spec)
    try:
        data = {"sets": [{"id": "1", "name": "A", "year": 1999}, {"id": "2", "name": "B", "year": 2001}]}
        out = run(spark, {"datasets": items(spark, "datasets", data)}, infer.echo_backend)
        assert [r.id for r in out.pairs["datasets"].collect()] == ["datasets_2_1"] and "comparisons" not in out.pairs
    finally:
        del domains.REGISTRY["datasets"]
