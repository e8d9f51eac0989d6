import hashlib
import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import structured as js
from corpusloom.functions import text as tx


def test_strip_html(values):
    rows = [
        "<p>Hello <b>world</b></p>",
        "",
        None,
        "<p>Hello</p>  <p>World</p>",
        "a \u000b b\x1cc",
        "x<a\nhref='y'>z",
        "1 < 2 and 3 > 2",
    ]
    expected = ["Hello world", "", None, "Hello World", "a b c", "xz", "1 2"]
    assert values(tx.strip_html, rows) == expected


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_strip_html_equals_rule(values, rows):
    def rule(t):
        return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", t)).strip()

    rows = [t.encode("utf-8", "ignore").decode() for t in rows]
    assert values(tx.strip_html, rows) == [rule(t) for t in rows]


def test_format_currency(values):
    rows = ["1500000", "", None, "not-a-number", " 42 ", "-1234", "+7", "007", "1_000", "-0", "1.5", "9" * 45]
    expected = [
        "$1,500,000", "", "", "not-a-number", "$42", "$-1,234", "$7", "$7", "$1,000", "$0", "1.5",
        f"${int('9' * 45):,}",
    ]
    assert values(tx.format_currency, rows) == expected


def test_slugify(values):
    rows = ["GPU Acceleration", "--A/B  c--", "x" * 40, "AI/ML Optimized", "Ünï"]
    assert values(tx.slugify, rows) == ["gpu_acceleration", "a_b_c", "x" * 30, "ai_ml_optimized", "n"]


def test_title_case(values):
    rows = ["delta-gpu", "they're 2nd", "ABC.def"]
    assert values(tx.title_case, rows) == [r.title() for r in rows]


def test_normalize_gpu(values):
    rows = ["NVIDIA A100 80GB", " v100 ", "rtx  6000", "A10", "", "MI250", None]
    expected = ["NVIDIA A100", "NVIDIA V100", "NVIDIA RTX  6000", "NVIDIA A10", "", "", ""]
    assert values(tx.normalize_gpu, rows) == expected


def test_names_of_resources(values):
    rows = ["Delta - COMING SOON", "Delta COMING SOON", "Delta", "Old - retired in 2020", "B -Beta x"]
    assert values(tx.soften_label, rows)[:3] == ["Delta (coming soon)", "Delta (coming soon)", "Delta"]
    assert values(lambda c: tx.clean_name(tx.soften_label(c)), rows) == ["Delta", "Delta", "Delta", "Old", "B"]


def test_display_name(values):
    rows = [
        ("pytorch", "The PyTorch library; pytorch."),
        ("gcc", "no mention of egcc"),
        ("GCC", "gcc"),
        ("r", None),
        ("c++", "The C++ language"),
        ("42", "42 and 42"),
        ("a.b", "axb then A.B here"),
    ]
    result = values(tx.display_name, rows, "a string, b string")
    expected = []
    for name, description in rows:
        if not name.islower() or not description:
            expected.append(name)
            continue
        m = re.search(r"\b" + re.escape(name) + r"\b", description, re.IGNORECASE)
        expected.append(m.group() if m else name)
    assert result == expected


def test_truncate(values):
    rows = ["a" * 1500, "a" * 1501]
    assert values(lambda c: tx.truncate(c, 1500), rows) == ["a" * 1500, "a" * 1500 + "..."]


def test_name_list(values):
    rows = [(["A"],), (["A", "B"],), (["A", "B", "C"],)]
    assert values(tx.name_list, rows, "a array<string>") == ["A", "A and B", "A, B, and C"]


def test_complexity_is_a_substring_test(values):
    rows = ["Processing data?", "What is it?", "HOW TO run"]
    assert values(lambda c: tx.complexity(c, ["how to", "process"]), rows) == ["moderate", "simple", "moderate"]


def test_parse_citation(values):
    rows = ["<<SRC:a:b:c>> tail", "not a citation", "<<SRC:incomplete", "<<SRC:>>", " <<SRC:a:b>>"]
    result = values(tx.parse_citation, rows)
    assert (result[0].domain, result[0].entity_id, result[0].raw) == ("a", "b:c", "<<SRC:a:b:c>> tail")
    assert result[1:] == [None] * 4


def test_hash_ignores_field_order(spark):
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    one = df.select(F.struct("b", F.struct("b", "a").alias("c"), "a").alias("s"))
    two = df.select(F.struct("a", "b", F.struct("a", "b").alias("c")).alias("s"))
    hashes = [d.select(js.content_hash(F.col("s"), d.schema["s"].dataType)).first()[0] for d in (one, two)]
    assert hashes[0] == hashes[1]
    text = '{"a":1,"b":"x","c":{"a":1,"b":"x"}}'
    assert hashes[0] == hashlib.sha256(text.encode()).hexdigest()
    assert one.select(F.length(js.short_hash(F.lit(hashes[0])))).first()[0] == 16


def test_hash_of_map_ignores_order(spark):
    df = spark.sql("SELECT map('b', '1', 'a', '2') AS m UNION ALL SELECT map('a', '2', 'b', '1')")
    rows = df.select(js.content_hash(F.col("m"), df.schema["m"].dataType).alias("h")).distinct()
    assert rows.count() == 1


def test_indent_json(values):
    rows = ['{"b":[1,2],"a":{"x":"é"},"c":[]}', None, "", "plain text", "{broken"]
    assert values(js.indent_json, rows) == [json.dumps(json.loads(rows[0]), indent=2), *rows[1:]]
