import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing, sharding

from .helpers import empty_docs, odd_docs, of_texts


@pytest.mark.parametrize("n", [1, 2, 3, 24, 100, 997, 1000, 1025])
def test_permutation(spark, n):
    out = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 5)).collect()]
    assert sorted(out) == list(range(n))
    if n > 90:
        assert out != sorted(out)
        again = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 6)).collect()]
        assert out != again


def test_shards_are_even_gapless_and_reproducible(spark):
    docs = of_texts(spark, [f"text {i % 50}" for i in range(500)])
    rows = sharding.document_shards(docs, 24, 3).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert (r.size, r.text_crc32) == (len(f"text {r.doc_id % 50}") + 8, zlib.crc32(f"text {r.doc_id % 50}".encode()))
    assert set(map(len, by.values())) == {20, 21} and all(sorted(v) == list(range(len(v))) for v in by.values())
    other = sharding.document_shards(docs.repartition(7), 24, 3).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in other}


def test_shards_of_odd_rows(spark):
    rows = sharding.document_shards(odd_docs(spark), 4).collect()
    assert len(rows) == 11 and sorted(Counter(r.shard for r in rows).values()) == [2, 3, 3, 3]
    assert all((r.size, r.text_crc32) == (8, 0) for r in rows if r.size == 8)
    whole = sharding.shuffled(odd_docs(spark), [F.col("doc_id"), F.xxhash64("text")], 4)
    assert whole.count() == 11 and whole.where("_row = 6 and score = 0.5").count() == 11
    assert sharding.document_shards(empty_docs(spark), 4).count() == 0


def share_out(budget, children):
    """Water filling by brute force: one token at a time would be exact in the limit; here by levels."""
    open_ = {k: (cap, w) for k, (cap, w) in children.items() if cap}
    out = {k: 0 for k in children}
    left = budget
    while True:
        total = sum(w for _, w in open_.values())
        full = [k for k, (cap, w) in open_.items() if cap * total <= left * w]
        if not full:
            break
        # only those that fill up at the lowest level are certain to be full
        k = min(full, key=lambda k: open_[k][0] / open_[k][1])
        out[k] = open_[k][0]
        left -= open_[k][0]
        del open_[k]
        if not open_:
            return out
    total = sum(w for _, w in open_.values())
    for k, (_, w) in open_.items():
        out[k] = left * w / total
    return out


def mixture(spark):
    texts = ["word " * (1 + i % 7) for i in range(300)]
    rows = [(i, t.strip(), ["en", "de", None][i % 3], f"src{i % 11 if i % 2 else 0}", len(t)) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_budgets_equal_water_filling(spark):
    rows, docs = mixture(spark)
    weights = {("domain0",): 5, ("*", "de"): 3, ("*", "src0"): 2}
    leaves = {(r.domain, r.lang, r.source): r for r in mixing.plan(docs, weights, (3, 2), 2, 7).collect()}
    tokens = Counter()
    for _, text, lang, source, _ in rows:
        tokens[f"domain{int(source[3:]) // 5}", lang or "(none)", source] += len(text.split())
    assert {k: r.tokens for k, r in leaves.items()} == tokens
    weight = lambda *path: weights.get(path, weights.get(("*", path[-1]), 1) if len(path) > 1 else 1)
    total = sum(tokens.values())
    level = {(): min(total * 3 // 2, total * 2)}
    for depth in (1, 2, 3):
        below = {}
        for parent, budget in level.items():
            children = {k[:depth] for k in tokens if k[: depth - 1] == parent}
            caps = {c: (sum(2 * t for k, t in tokens.items() if k[:depth] == c), weight(*c)) for c in children}
            below.update(share_out(budget, caps))
        level = below
    assert sum(r.budget for r in leaves.values()) == total * 3 // 2
    for k, r in leaves.items():
        assert abs(r.budget - level[k]) <= 3 and r.epochs * r.tokens + r.rest == r.budget


def test_prefixes_are_the_longest_that_fit(spark):
    rows, docs = mixture(spark)
    plan = mixing.plan(docs, {}, (2, 3), 4, 7)
    got = Counter(r.doc.doc_id for r in mixing.mixed(docs, plan, 7).collect())
    expected = Counter()
    for leaf in plan.collect():
        own = [r for r in rows if (f"domain{int(r[3][3:]) // 5}", r[2] or "(none)", r[3]) == (leaf.domain, leaf.lang, leaf.source)]
        key = lambda r, e=leaf.epochs: hashlib.md5(f"7:{e}:{r[0]}".encode()).hexdigest()
        used = 0
        for r in own:
            expected[r[0]] += leaf.epochs
        for r in sorted(own, key=key):
            used += len(re.findall(r"[^ \t-\r]+", r[1]))
            if used > leaf.rest:
                break
            expected[r[0]] += 1
    assert got == +expected


def test_mixture_of_odd_rows(spark):
    docs = odd_docs(spark)
    plan = mixing.plan(docs, {("*", "en"): 2}, (1, 1), 2, 1)
    out = mixing.mixed(docs, plan, 1)
    assert set(out.select("doc.*").columns) == set(docs.columns)
    assert sum(r.budget for r in plan.collect()) <= sum(r.tokens for r in plan.collect())
    none = empty_docs(spark)
    assert mixing.mixed(none, mixing.plan(none, {}), 1).count() == 0
