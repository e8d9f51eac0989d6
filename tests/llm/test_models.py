import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import quality, toxicity, words

from .helpers import empty_docs, odd_docs, of_texts

FOLDER = "/root/testdata/sf0.01"


def test_words_hash_like_the_pattern():
    import re

    rng = random.Random(1)
    texts = ["".join(rng.choice("aB é\t\n ßZ") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", None]
    data, at = words.buffers(pa.array(texts))
    starts, ends, hashes = words.spans(data, at)
    fold = lambda w: re.sub("[A-Z]", lambda m: m[0].lower(), w)
    expected = [fold(w) for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    found = [fold(bytes(data[a:b]).decode()) for a, b in zip(starts, ends, strict=True)]
    assert found == expected and len(dict(zip(found, hashes, strict=True))) == len(set(hashes.tolist()))


def test_words_in_long_rows_are_not_cut(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500)) + " " + "y" * 300
    whole = words.spans(*words.buffers(pa.array([text])))
    monkeypatch.setattr(words, "SEGMENT", 64)
    parts = words.spans(*words.buffers(pa.array([text])))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_maximal_segments():
    rng = random.Random(2)

    def brute(s):
        """Ruzzo-Tompa by definition: the best segment, then the same left and right of it."""
        best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        i, j = best[3:]
        return brute(s[:i]) + [(i, j)] + [(a + j, b + j) for a, b in brute(s[j:])]

    for _ in range(300):
        s = [rng.choice([-3, -2, -1, 1, 2, 5]) + rng.random() / 100 for _ in range(rng.randrange(12))]
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(np.array(s))] == brute(s)


@pytest.fixture(scope="module")
def toxic(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    return docs, labels, toxicity.fit(docs, labels)


def test_held_out_toxicity(spark, toxic):
    docs, labels, model = toxic
    rows = (
        toxicity.passages(docs, model)
        .join(labels, "doc_id")
        .where(toxicity.held_out(F.col("doc_id")))
        .select("toxic", "score", "passages")
        .collect()
    )
    bad = [r.score for r in rows if r.toxic]
    good = [r.score for r in rows if not r.toxic]
    better = sum((a > b) + (a == b) / 2 for a in bad for b in good) / (len(bad) * len(good))
    assert better > 0.85 and sum(b < 0.5 for b in good) / len(good) > 0.97


def test_toxic_passage_is_located(spark, toxic):
    model = toxic[2]
    text = "quiet words before, " + "you stupid worthless idiot scum " + "and quiet words after"
    row = toxicity.passages(of_texts(spark, [text]), model).first()
    assert row.score > 0.5
    assert any("idiot" in text[p.start : p.end] for p in row.passages)


def test_odd_rows_for_toxicity(spark, toxic):
    model = toxic[2]
    rows = toxicity.passages(odd_docs(spark), model).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.without_toxic(odd_docs(spark), model)
    assert kept.columns == odd_docs(spark).columns and kept.count() == 11
    assert toxicity.without_toxic(empty_docs(spark), model).count() == 0
    nothing = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    flat = toxicity.fit(odd_docs(spark), nothing, bins=4096)
    assert {r.score for r in toxicity.passages(odd_docs(spark), flat).collect()} == {0.5}


def test_counts_of_a_large_vocabulary_are_exact(spark):
    """Bound far below the vocabulary: no feature gets the counts of another, and no score changes."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(3000):x}q{rng.randrange(9)}" for _ in range(40)) + (" vile" * (i % 3 == 0)) for i in range(300)]
    docs = of_texts(spark, [*texts, None, "", texts[0]])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    rows = toxicity.labelled(docs, labels)
    counts, rest = toxicity.counted(rows, 64)
    assert len(counts.features) <= 64 < rest.count()
    seen = {}
    for r in rows.collect():
        for h in np.unique(np.concatenate(toxicity._features(*words.buffers(pa.array([r.text])))[2])).view(np.int64).tolist():
            seen.setdefault(h, [0, 0])[r.toxic] += 1
    held = dict(zip(counts.features.view(np.int64).tolist(), counts.counts.tolist(), strict=True))
    assert held | {r.feature: [r.clean, r.toxic] for r in rest.collect()} == seen
    scores = []
    for bins in (64, toxicity.BINS):
        model = toxicity.fit(docs, labels, bins=bins)
        scores.append({r.doc_id: r.score for r in toxicity.passages(docs, model).collect()})
        assert len(scores[-1]) == 303 and toxicity.without_toxic(docs, model).count() == sum(v < 0.5 for v in scores[-1].values())
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)


def counts_of(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_counts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "B#", "é|", "c\nd", "x", "\n"]) for _ in range(rng.randrange(60))) for _ in range(120)]
    docs = of_texts(spark, [*texts, "", None, "one line\none line\n one line"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality.measured(docs).collect()}
    assert got == {r.doc_id: counts_of(r.text) for r in docs.collect()}


def test_covariance_and_quantiles():
    from statistics import NormalDist

    assert abs(quality.chi_square_quantile(2, 0.05) - 5.991) < 0.01
    assert abs(quality.chi_square_quantile(6, 0.01) - 16.812) < 0.01
    assert abs(quality.chi_square_quantile(1, 0.05) - NormalDist().inv_cdf(0.975) ** 2) < 0.01
    assert abs(quality.consistency(2, 0.5) - 0.5 / (1 - np.exp(-np.log(2)) * (1 + np.log(2)))) < 0.01


def brute_outliers(x):
    center, inverse = np.median(x, 0), None
    mad = 1.4826 * np.median(abs(x - center), 0)
    inverse = quality._solve(center, np.diag(mad**2))
    far = lambda: np.einsum("ni,ij,nj->n", x - center, inverse, x - center)
    for _ in range(quality.STEPS):
        d = far()
        near = x[d <= np.sort(d)[int(np.ceil(quality.SHARE * len(d))) - 1]]
        center = near.mean(0)
        inverse = quality._solve(center, np.cov(near.T, bias=True) * quality.consistency(quality.P, quality.SHARE))
    return far()


def test_outliers_equal_brute_force(spark):
    rng = random.Random(4)
    clean = [" ".join(rng.choice(["plain", "words", "of", "a", "clean", "little", "text"]) + rng.choice(["", "", "s"]) for _ in range(30)) for _ in range(101)]
    odd = [" ".join(w + "###" for w in t.split()) for t in clean[:10]]
    rows = quality.outliers(quality.measured(of_texts(spark, clean + odd))).collect()
    verdict = {r.doc_id: r.kept for r in rows if not r.base_failed}
    assert all(v == (k < 101) for k, v in verdict.items()) and sum(verdict.values()) > 90
    vectors = quality._vectors(quality._statistics(pa.array(clean + odd)))
    ids = sorted(verdict)
    expected = brute_outliers(vectors[ids])
    got = {r.doc_id: r.distance for r in rows if not r.base_failed}
    assert np.allclose([got[i] for i in ids], expected, rtol=0.02, atol=0.02)


def test_quality_of_odd_rows(spark):
    rows = quality.outliers(quality.measured(odd_docs(spark))).collect()
    assert len(rows) == 11 and not any(r.kept for r in rows if r.n_words < 20)
    assert quality.outliers(quality.measured(empty_docs(spark))).count() == 0
