"""Hard negatives, centroid clustering and the byte network against plain versions."""

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bytenet, negatives, vectors, zones

from .helpers import empty_docs, odd_docs, of_texts

SCHEMA = "vec_id long, embedding array<float>, label int, row long, i int, rank int, cluster int, key string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "k") for r in rows], SCHEMA)


def odd_vectors(seed=3, n=400, dim=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] * (i % 3 > 0) + rng.normal(0, 0.1, dim)
        rows.append((i * 5, v.astype(np.float32).tolist(), int(rng.integers(0, 10))))
    hot = [0.25] * dim
    rows += [(10_000 + i, hot, 1) for i in range(n // 3)]
    rows += [rows[3], rows[3], (None, hot, 2), (77, None, 1), (78, hot, None)]
    rows += [(79, [math.nan] + hot[1:], 1), (80, [None] + hot[1:], 1), (81, [math.inf] + hot[1:], 1), (83, [1e30] + hot[1:], 1)]
    return rows


def whole(rows, scale, dim=64):
    """Usable rows as (id, integer vector, label)."""
    out = []
    for i, v, label in rows:
        if v is None or any(x is None or not math.isfinite(x) or abs(x) > 1e20 for x in v):
            continue
        out.append((i, np.floor(np.array(v, np.float32).astype(float) * scale).astype(np.int64), label))
    return out


def brute_negatives(rows, dim=64):
    rows = [r for r in whole(rows, 256) if r[0] is not None and r[2] is not None]
    x = np.zeros((len(rows), dim), np.int64)
    for n, (_, v, _) in enumerate(rows):
        x[n, : len(v)] = v
    out = []
    for a, (aid, _, label) in enumerate(rows):
        if aid % 100:
            continue
        scores = x @ x[a]
        order = sorted((n for n in range(len(rows)) if n != a), key=lambda n: (-scores[n], rows[n][0]))
        near = [n for n in order if rows[n][2] == label][:5]
        for rank, p in enumerate(near, 1):
            s = scores[p]
            far = [n for n in order if rows[n][2] != label and 30 * s <= 100 * scores[n] <= 90 * s][:10]
            out += [(aid, rows[p][0], k, rows[n][0], int(s), int(scores[n]), rank) for k, n in enumerate(far, 1)]
    return sorted(out)


def mined(df):
    got = negatives.mined(vectors.quantised(df, ["vec_id", "label"], 256), F.col("vec_id") % 100 == 0)
    return sorted(tuple(r) for r in got.collect())


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 14)  # several blocks of anchors
    rows = odd_vectors(1)
    expected = brute_negatives(rows)
    assert len(expected) > 100 and mined(table(spark, rows)) == expected


def test_vectors_of_different_length_and_empty_table(spark):
    rng = np.random.default_rng(5)
    rows = [(i * 10, rng.normal(0.2, 0.3, 3 + i % 4).tolist(), i % 3) for i in range(60)] + [(1000, [], 1)]
    assert mined(table(spark, rows)) == brute_negatives(rows, 6)
    none = table(spark, []).where("vec_id = 1")
    assert mined(none) == []


def test_walk_gives_every_cell_once_by_falling_bound(monkeypatch):
    monkeypatch.setattr(negatives, "LOOK", 16)
    rng = np.random.default_rng(2)
    x = rng.integers(-200, 200, (500, 8)).astype(float)
    books = negatives.Codebooks(negatives._book(x[:, :4], 7), negatives._book(x[:, 4:], 7))
    i, j = books.cells(x)
    q = pa.array([v.astype("<i4").tobytes() for v in x], pa.binary())
    n = pa.array(np.arange(500))
    batch = pa.RecordBatch.from_arrays([n, n, pa.array(np.zeros(500, np.int32)), q, pa.array(i), pa.array(j)], ["row", "vec_id", "label", "q", "i", "j"])
    shard = negatives.Shard([batch], books, 8)
    anchors = x[:3]
    cells = list(shard.walk(anchors))
    assert sorted(r for _, a, e in cells for r in range(a, e)) == list(range(500))
    bounds = [b for b, _, _ in cells]
    assert bounds == sorted(bounds, reverse=True)
    for bound, a, e in cells:
        assert (shard.x[a:e] @ anchors.T).max() <= bound + 1e-6
    # the walk stops early when the rest is certified
    best = float((x @ anchors.T).max())
    assert shard.search(anchors, lambda rows, scores: best) < 500


def test_hilbert_neighbours_differ_by_one_step():
    for columns, bits in ((2, 4), (3, 3)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=columns)))
        keys = zones.hilbert(points, bits)
        assert sorted(keys) == list(range(len(points)))
        path = points[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_candidates_hold_the_nearest_of_every_point():
    rng = np.random.default_rng(4)
    dropped = 0
    for _ in range(60):
        x = rng.integers(-20, 20, (30, 3)) + rng.integers(-200, 200, 3)
        c = rng.integers(-200, 200, (6, 3))
        c[5] = c[2]  # a tie: the smaller number counts
        open_ = zones.candidates(x.min(0)[None], x.max(0)[None], c)[0]
        own = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        assert open_[own].all() and not open_[5]
        dropped += (~open_).sum()
    assert dropped > 100


def brute_clusters(rows, k=8, rounds=10):
    rows = [(i, v) for i, v, _ in whole(rows, 1024) if len(v) == 64]
    x = np.array([v for _, v in rows])
    digest = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, digest(rows[n][0])))
    c = [list(map(int, x[n])) for n in order[:k]]
    for step in range(rounds + 1):
        d = ((x[:, None] - np.array(c)) ** 2).sum(2)
        own = d.argmin(1)
        if step == rounds:
            break
        for m in range(k):
            if (own == m).any():
                c[m] = [int(s) // int((own == m).sum()) for s in x[own == m].sum(0)]
    least = d.min(1)
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(
        ((i, int(own[n]), int(least[n]), int(least[own == own[n]].sum()), int(least.sum()), sha[own[n]]) for n, (i, _) in enumerate(rows)),
        key=str,
    )


def clustered(df, k=8):
    rows = vectors.quantised(df, ["vec_id"], 1024, width=64)
    return sorted((tuple(r) for r in zones.report(zones.cluster(rows, zones.starts(rows, 64, k, "3"), 10)).collect()), key=str)


@pytest.mark.parametrize("spread", [1 << 16, 100])
def test_clusters_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(zones, "SPREAD", spread)
    monkeypatch.setattr(zones, "BLOCK", 16)
    rows = odd_vectors(9) + [(5, [0.5] * 63, 1), (6, [], 1)]
    assert clustered(table(spark, rows)) == brute_clusters(rows)


def test_clusters_of_few_and_no_vectors(spark):
    rows = [(i, [i / 8] * 64, 0) for i in range(3)]
    assert [r[2] for r in clustered(table(spark, rows))] == [0, 0, 0]
    assert clustered(table(spark, rows).where("vec_id > 5")) == []


def test_single_candidate_blocks_are_not_looked_into():
    """A block far from all but one centroid adds its stored sum, whatever its rows hold."""
    width = 64
    x = np.full((4, width), 7, "<i4")
    head = [4, None, None, None]
    cell = lambda v, kind: pa.array([np.full(width, v, kind).tobytes(), None, None, None], pa.binary())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3, 4]), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(head, pa.int32()), cell(7, "<i4"), cell(7, "<i4"), cell(999, "<i8")],
        ["vec_id", "q", "size", "lo", "hi", "total"],
    )
    counts, gains = zones._assigned(batch, width, np.array([[0] * width, [500] * width]), True)
    assert counts.tolist() == [4, 0] and (gains[0] == 999).all()


# ---- byte network --------------------------------------------------------------------------------------


def as_buffer(texts):
    return bytenet.buffers(pa.array(texts))


def plain_probability(text, net):
    """One document, position by position."""
    around = [bytenet.PAD] * (bytenet.WIDTH - 1)
    codes = around + list(text.encode()) + around
    n = len(codes) - len(around)
    answers = [np.concatenate([net.byte[c] for c in codes[t : t + bytenet.WIDTH]]) @ net.filter for t in range(n)]
    units = -(-n // bytenet.UNIT)
    top = np.zeros((units, bytenet.FILTERS))
    for t, a in enumerate(answers):
        top[t // bytenet.UNIT] = np.maximum(top[t // bytenet.UNIT], a)
    starts = range(0, max(1, units - (bytenet.CHUNK - bytenet.STEP)), bytenet.STEP)
    chunks = np.tanh(np.array([top[s : s + bytenet.CHUNK].max(0) for s in starts]) + net.bias)
    logit = np.concatenate([chunks.mean(0), chunks.max(0)]) @ net.out + net.base[0]
    return 1 / (1 + math.exp(-logit))


def test_probabilities_equal_the_plain_version():
    rng = np.random.default_rng(1)
    texts = ["", "a", "é" * 100] + ["".join(chr(rng.integers(32, 600)) for _ in range(n)) for n in (5, 122, 123, 124, 500, 1500)]
    net = bytenet.fresh(5)
    expected = [plain_probability(t, net) if t else None for t in texts]
    got = bytenet.probabilities(*as_buffer(texts), net)
    assert 0 < got[0] < 1
    assert np.allclose(got[1:], expected[1:], atol=1e-5)
    # neither the order of rows nor their company matters
    assert np.allclose(bytenet.probabilities(*as_buffer(texts[::-1]), net)[::-1], got, atol=1e-6)


def test_gradient_is_that_of_the_loss():
    data, at = as_buffer(["some text of ordinary words " * 30, "### x ### " * 9, "short", ""])
    truth = np.array([1, 0, 1, 0], np.float32)
    net = bytenet.fresh(3)
    grads, _ = bytenet.slopes(data, at, truth, net)
    rng = np.random.default_rng(0)
    for n, part in enumerate(net.parts()):
        flat, g = part.reshape(-1), grads[n].reshape(-1)
        for i in np.argsort(-np.abs(g))[:6].tolist() + rng.integers(0, len(flat), 3).tolist():
            if n == 0 and i >= bytenet.PAD * bytenet.DEEP:
                continue
            kept, losses = flat[i], []
            for step in (1e-2, -1e-2):
                flat[i] = kept + step
                losses.append(bytenet.slopes(data, at, truth, net)[1])
            flat[i] = kept
            assert abs((losses[0] - losses[1]) / 2e-2 - g[i]) < 2e-3 + 0.1 * abs(g[i])


def test_the_end_of_a_long_text_counts(spark):
    clean, junk = "plain words in a row here. ", "x### y%%% z&&& "
    rng = np.random.default_rng(6)
    texts = [("".join(rng.permutation(list(clean))) * 9) + (junk * 8 if i % 2 else clean * 5) for i in range(160)]
    docs = of_texts(spark, texts)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(160)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    held = F.col("doc_id") >= 120
    net = bytenet.fit(docs, labels, "quality", ~held)
    long = of_texts(spark, [clean * 9000, clean * 9000 + junk * 400, clean * 40], start=1000)
    rows = {r.doc_id: r.score for r in bytenet.scored(docs.unionAll(long), net, ["doc_id"]).collect()}
    assert sum((rows[i] >= 0.7) == (i % 2 == 0) for i in range(120, 160)) >= 38
    assert rows[1001] < rows[1000]


def test_odd_documents_get_a_score(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(2, 1), (4, 0), (99, 1)], "doc_id long, quality int")
    net = bytenet.fit(docs, labels, "quality", F.lit(True))
    rows = bytenet.scored(docs, net, ["doc_id", "score", "lang"], "p").collect()
    assert len(rows) == docs.count() and all(0 <= r.p <= 1 for r in rows) and {r.score for r in rows} == {0.5}
    assert bytenet.scored(empty_docs(spark), net, ["doc_id"]).collect() == []
    one = bytenet.fit(docs, labels.where("quality = 1"), "quality", F.lit(True))
    assert {round(r.score, 3) for r in bytenet.scored(docs, one, ["doc_id"]).collect()} == {1.0}
    none = bytenet.fit(empty_docs(spark), labels, "quality", F.lit(True))
    assert {r.score for r in bytenet.scored(docs, none, ["doc_id"]).collect()} == {0.5}
