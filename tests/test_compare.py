import pytest
from pyspark.sql import functions as F

from corpusloom.operators import compare
from corpusloom.plans.extract import comparison_pairs

RESOURCES = [
    ("delta.ncsa.site.org", 0, "Delta", True, ["NVIDIA A100"], ["GPU Acceleration", "Container Support"], ["NCSA"]),
    ("bridges2.psc.site.org", 1, "Bridges-2", True, ["NVIDIA V100"], ["GPU Acceleration"], ["PSC"]),
    ("expanse.sdsc.site.org", 2, "Expanse", True, ["V100 32GB"], ["GPU Acceleration", "Container Support"], ["SDSC", ""]),
]
SOFTWARE = [
    ("pytorch", 0, "PyTorch", ["delta", "bridges-2"]),
    ("tensorflow", 1, "TensorFlow", ["Delta", "expanse", "bridges2"]),
    ("gcc", 2, "GCC", ["delta"]),
]
PROJECTS = [
    ("P1", 0, "Zeta", "CS", "MIT", ["Delta GPU"]),
    ("P2", 1, "Alpha", "CS", "MIT", ["Delta GPU", ""]),
    ("P3", 2, "Mid", "CS", "MIT", ["Delta GPU"]),
    ("P4", 3, "Other", "Physics", "", []),
]
AWARDS = [
    ("1", 0, "A", "OAC", "MIT"), ("2", 1, "B", "OAC", "MIT"), ("3", 2, "C", "OAC", "NYU"), ("4", 3, "D", "X", "UCB"),
]
GROUPS = [("1", 0, "B group", "Technology"), ("2", 1, "A group", "Technology"), ("3", 2, "C group", "Technology"),
          ("4", 3, "D group", "Community")]


def resources(spark):
    return spark.createDataFrame(
        RESOURCES,
        "entity_id string, ordinal bigint, name string, has_gpu boolean, gpu_types array<string>, "
        "features array<string>, organizations array<string>",
    )


def software(spark):
    return spark.createDataFrame(SOFTWARE, "entity_id string, ordinal bigint, name string, resources array<string>")


def projects(spark, rows=PROJECTS):
    return spark.createDataFrame(
        rows, "entity_id string, ordinal bigint, name string, fos string, institution string, resource_names array<string>"
    )


def awards(spark, rows=AWARDS):
    return spark.createDataFrame(
        rows, "entity_id string, ordinal bigint, name string, fund_program_name string, institution string"
    )


def groups(spark):
    return spark.createDataFrame(GROUPS, "entity_id string, ordinal bigint, name string, category string")


@pytest.fixture(scope="module")
def pairs(spark):
    made = compare.generate(
        resources(spark), software(spark), projects(spark), awards(spark), groups(spark), program="Demo"
    )
    return {r.id: r for r in made.collect()}


def test_which_pairs_there_are(pairs):
    assert set(pairs) == {
        "cmp_gpu_nvidia_v100",
        "cmp_feat_gpu_acceleration",
        "cmp_feat_container_support",
        "cmp_sw_pytorch",
        "cmp_sw_tensorflow",
        "cmp_gpu_sw_pytorch",
        "cmp_gpu_sw_tensorflow",
        "cmp_alloc_fos_cs",
        "cmp_alloc_inst_mit",
        "cmp_alloc_res_delta_gpu",
        "cmp_nsf_prog_oac",
        "cmp_ag_cat_technology",
    }


def test_texts(pairs):
    gpu = pairs["cmp_gpu_nvidia_v100"]
    assert gpu.question == "Which Demo resources have NVIDIA V100 GPUs?"
    assert gpu.answer == (
        "NVIDIA V100 GPUs are available on Bridges-2 and Expanse.\n\n"
        "<<SRC:compute-resources:bridges2.psc.site.org>>\n\n<<SRC:compute-resources:expanse.sdsc.site.org>>"
    )
    assert pairs["cmp_feat_gpu_acceleration"].question == "Which Demo resources support gpu acceleration?"
    assert "Bridges-2, Delta, and Expanse." in pairs["cmp_feat_gpu_acceleration"].answer
    # texts are sorted by name, resources stay in arrival order
    assert pairs["cmp_feat_gpu_acceleration"].resources == [r[0] for r in RESOURCES]
    both = pairs["cmp_gpu_sw_pytorch"]
    assert both.domain == "comparison" and both.software == "pytorch"
    assert both.answer == (
        "PyTorch is available on GPU-enabled Demo resources including Bridges-2 and Delta. These systems "
        "provide GPU acceleration for PyTorch workloads.\n\n<<SRC:compute-resources:bridges2.psc.site.org>>\n\n"
        "<<SRC:compute-resources:delta.ncsa.site.org>>\n\n<<SRC:software-discovery:pytorch>>"
    )
    sw = pairs["cmp_sw_pytorch"]
    assert sw.domain == "software-discovery" and sw.answer.endswith("<<SRC:software-discovery:pytorch>>")
    fos = pairs["cmp_alloc_fos_cs"]
    assert fos.answer.startswith("There are 3 allocation projects in CS: Alpha, Mid, and Zeta.")
    assert fos.answer.count("<<SRC:allocations:") == 3
    assert fos.resources == ["P1", "P2", "P3"]
    category = pairs["cmp_ag_cat_technology"]
    assert category.answer.startswith("The Technology affinity groups include A group, B group, and C group.")
    assert category.resources == ["2", "1", "3"]
    for row in pairs.values():
        assert row.granularity == "comparison" and row.complexity == "moderate" and row.has_citation
        assert row.source_ref == f"mcp://comparison/{row.id}"


def test_large_groups_show_count_and_sample(spark):
    rows = [(f"P{i}", i, f"Name {9 - i}", "CS", "", []) for i in range(7)]
    made = compare.generate(projects=projects(spark, rows))
    row = made.first()
    assert "There are 7 allocation projects in CS, including Name 3, Name 4, Name 5, Name 6, and Name 7." in row.answer
    assert row.answer.count("<<SRC:") == 5 and len(row.resources) == 5 and row.members == 7
    assert row.resources == ["P0", "P1", "P2", "P3", "P4"]


def test_large_domains_need_three(spark):
    assert compare.generate(projects=projects(spark, PROJECTS[:2])).count() == 0
    rows = [*AWARDS, ("5", 4, "E", "Y", "MIT")]
    ids = {r.id for r in compare.generate(awards=awards(spark, rows)).collect()}
    assert ids == {"cmp_nsf_prog_oac", "cmp_nsf_inst_mit"}
    assert compare.generate() is None


def test_one_resource_with_two_equal_gpus_is_a_group_of_two(spark):
    row = (RESOURCES[0][0], 0, "Delta", True, ["NVIDIA A100", "A100"], [], [])
    df = spark.createDataFrame([row], resources(spark).schema)
    made = compare.listing(compare.gpu_members(df), compare.templates("x")["gpu"])
    assert made.first().members == 2


def test_pair_layout(spark):
    made = compare.listing(compare.by_field(groups(spark), "category"), compare.templates("x")["group_category"])
    row = comparison_pairs(made).first()
    assert row.metadata.source_data == '{"comparison_type":"availability","resources":["2","1","3"]}'
    assert row.messages[1].content.startswith("The Technology")
    assert row.metadata.granularity == "comparison"


@pytest.mark.parametrize("name", ["software", "group_category", "organization"])
@pytest.mark.parametrize("chunk", [1, 2, 7, 100])
def test_chunks_give_the_same_pairs(spark, name, chunk):
    """A hot group of a third of the rows among small ones, rendered whole and from chunks."""
    rows = spark.range(90).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 25)).alias("group"),
        F.concat(F.lit("n"), F.col("id") % 11).alias("name"),
        F.col("id").alias("ordinal"),
        F.lit(0).alias("sub"),
        F.concat(F.lit("e"), F.col("id")).alias("entity_id"),
    ).withColumn("label", F.col("group"))
    template = compare.templates("x")[name]
    whole = sorted(map(str, compare.listing(rows, template).collect()))
    assert whole and sorted(map(str, compare.listing(rows, template, chunk=chunk).collect())) == whole


def brute_resolve(short, records):
    keys = {}
    for rid, _, name, *_ in records:
        keys[name.lower()] = rid
        keys[rid.split(".")[0].lower()] = rid
        if "-" in name:
            keys[name.lower().replace("-", "")] = rid
    s = short.lower().strip()
    found = keys.get(s) or keys.get(s.replace("-", ""))
    if found is None:
        found = next((rid for rid, *_ in records if rid.lower().startswith(s)), None)
    names = {r[0]: r[2] for r in records}
    if found is None:
        return short, short.title().replace("-", " "), False
    return found, names[found], True


def test_resolve_names_equals_rule(spark):
    shorts = ["delta", " DELTA ", "bridges2", "Bridges-2", "bridges", "b-r-i", "exp", "expanse.sdsc", "stampede-3",
              "lab east", "delta.", "del-ta", "x.y-z"]
    df = spark.createDataFrame([(s,) for s in shorts], "short string")
    found = {r.short: (r.resource_id, r.resource_name, r.resolved)
             for r in compare.resolve_names(df, resources(spark)).collect()}
    assert found == {s: brute_resolve(s, RESOURCES) for s in shorts}


def test_later_resource_takes_over_an_equal_key(spark):
    rows = [("a.one", 0, "Same", True, [], [], []), ("b.two", 1, "Same", True, [], [], [])]
    df = spark.createDataFrame(rows, resources(spark).schema)
    shorts = spark.createDataFrame([("same",)], "short string")
    assert compare.resolve_names(shorts, df).first().resource_id == "b.two"


def test_duplicate_slugs_are_reported(spark):
    names = ["x" * 30 + "a", "x" * 30 + "b"]
    rows = [(f"{n}{i}", i, "n", n) for n in names for i in range(2)]
    df = spark.createDataFrame(rows, groups(spark).schema)
    made = compare.listing(compare.by_field(df, "category"), compare.templates("x")["group_category"])
    assert [(r.id, r.groups) for r in compare.duplicate_ids(made).collect()] == [("cmp_ag_cat_" + "x" * 30, 2)]


def test_sample_state_is_bounded_and_merges(spark, monkeypatch):
    """A large group, ties, many small groups, and states flushed early give the plain answer."""
    import random

    rng = random.Random(3)
    rows = [("big", f"n{rng.randint(0, 40):02d}", rng.randint(0, 500), rng.randint(0, 1), f"e{i}") for i in range(3000)]
    rows += [(f"g{i % 700}", f"n{rng.randint(0, 9)}", i, 0, None if i % 50 == 0 else f"e{i}") for i in range(2000)]
    df = spark.createDataFrame([(g, g, n, o, s, e) for g, n, o, s, e in rows], "group string, label string, name string, ordinal long, sub int, entity_id string")
    null_first = lambda e: (e is not None, e or "")
    template = compare.templates("Demo")["project_field"]
    expected = {}
    for group in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == group]
        by_arrival = sorted(own, key=lambda r: (r[2], r[3], null_first(r[4])))[:5]
        by_name = sorted(own, key=lambda r: (r[1], r[2], r[3], null_first(r[4])))[:5]
        if len(own) >= template.minimum:
            expected[group] = ([r[1] for r in by_name], [r[4] for r in by_arrival], len(own))
    for size in (64, 1 << 17):
        monkeypatch.setattr(compare, "COMBINE", size)
        state = compare._combined(df.repartition(3)).where("group = 'big'")
        assert state.agg({"members": "sum"}).first()[0] == 3000
        if size > 64:
            assert state.count() <= 30
        got = {r.source_group: r for r in compare.sampled(df.repartition(3), template).withColumn("source_group", F.col("id")).collect()}
        assert len(got) == len(expected)
        for row in got.values():
            names, ids, count = next(v for g, v in expected.items() if row.id.endswith(f"_{g}"))
            assert list(row.resources) == ids and str(count) in row.answer
            at = [row.answer.index(n) for n in dict.fromkeys(names)]
            assert at == sorted(at)


def test_distinct_counts_an_entity_once(spark):
    twice = [(*r[:4], ["A100", "NVIDIA A100 80GB", "V100"], r[5], r[6]) if r[1] == 0 else r for r in RESOURCES]
    found = spark.createDataFrame(twice, resources(spark).schema)
    listed = spark.createDataFrame([("gcc", 0, "GCC", ["delta", "Delta", "expanse"])], software(spark).schema)
    repeated = projects(spark, [("P1", 0, "Z", "CS", "MIT", ["Disk", "Disk", "Disk"])])

    def members(distinct):
        made = compare.generate(found, listed, repeated, distinct=distinct)
        return {r.id: list(r.resources) for r in made.select("id", "resources").collect()}

    bag, once = members(False), members(True)
    delta, bridges, expanse = (r[0] for r in RESOURCES)
    a100 = next(k for k in bag if k.startswith("cmp_gpu_") and "a100" in k)
    v100 = a100.replace("a100", "v100")
    assert bag[a100] == [delta, delta] and a100 not in once
    assert sorted(once[v100]) == sorted([delta, bridges, expanse])
    assert sorted(bag["cmp_sw_gcc"]) == [delta, delta, expanse] and sorted(once["cmp_sw_gcc"]) == [delta, expanse]
    assert [k for k in bag if k.startswith("cmp_alloc_res")] and not [k for k in once if k.startswith("cmp_alloc_res")]


def test_many_groups_are_reduced_before_anything_is_sorted(spark, monkeypatch):
    """Tasks that see little of each group pass their rows on; whole groups are reduced after the shuffle."""
    states, combined = [], compare._combined
    monkeypatch.setattr(compare, "_combined", lambda *a: states.append(combined(*a)) or states[-1])
    rows = spark.range(0, 6000, 1, 4).selectExpr(
        "concat('g', id % 150) AS group", "concat('g', id % 150) AS label", "concat('n', id) AS name",
        "id AS ordinal", "0 AS sub", "CAST(id AS STRING) AS entity_id",
    )
    template = compare.templates("x")["project_resource"]
    assert compare.sampled(rows, template).count() == 150
    assert states[-1].count() <= 150 * 2 * compare.SAMPLE
    assert states[-1].agg({"members": "sum"}).first()[0] == 6000
