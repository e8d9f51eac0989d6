"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

Training counts, for every word and for its first 5 and 7 bytes, the toxic and the clean labelled
documents that contain it. A word's log-odds come from Dirichlet smoothing along that chain: the share
of toxic documents among those with the word is pulled towards the share for its prefixes, and that
towards the base rate. Log-odds minus a constant drift are the scores of the words of a text (the k-th
occurrence of a word brings a k-th of its log-odds, as occurrences in one text are not independent); a
linear scan finds every maximal-scoring segment. Lambda is the Karlin-Altschul root for the word scores
of clean texts, K the maximum-likelihood rate of the extreme-value law P(S > s) = 1 - exp(-K n exp(-lambda s))
for the best segment of a clean text of n words. Several segments are put together by the sum statistic
of their normalised scores lambda S - ln(K n). A logistic function of the resulting -ln p, fitted on the
labels, is the score.

Counts are exact for every feature, over all labelled rows. Tasks hold those of the most frequent
features up to a fixed number (28 bytes each); when there are more, the counts of the others that a text
has are joined to it by a shuffle, so the bound changes the plan and never a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..settings import written
from . import words as W

#: Features whose counts every task holds, most frequent first; those of the rest are joined.
BINS = 1 << 21
PRIOR = 3.0
DRIFT = 1.5
PREFIXES = (5, 7)
#: Word scores are counted in steps for the Karlin-Altschul root.
STEP = 0.05
LOW, HIGH = -8.0, 16.0
#: More labelled rows than this are joined by a shuffle instead of a broadcast (16 bytes a row).
BROADCAST_LABELS = 1_000_000
#: A segment is reported when texts of its length hold one as good by chance less often than this.
SIGNIFICANT = 0.05

_GAPS = np.ones(256, bool)
_GAPS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_SALTS = [np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0)]


@dataclass(frozen=True)
class Counts:
    """Exact document counts by class of the features that tasks hold, with the number of documents of
    each class."""

    features: np.ndarray  # sorted uint64
    counts: np.ndarray  # [feature, class] int64
    first: np.ndarray  # by leading bits: the first feature with them
    clean: int
    toxic: int

    @classmethod
    def of(cls, features: np.ndarray, toxic: np.ndarray, clean: np.ndarray, documents: tuple[int, int] = (0, 0)) -> Counts:
        """From parallel columns; ``documents``: clean and toxic ones."""
        features = np.ascontiguousarray(features, np.int64).view(np.uint64)
        order = np.argsort(features)
        features = features[order]
        bits = max(1, len(features).bit_length())
        first = np.searchsorted(features >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        return cls(features, np.stack([clean, toxic], axis=1).astype(np.int64)[order], first, *documents)

    def seen(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of each feature, and which features are not among those held."""
        out, missing = np.zeros((len(h), 2), np.float64), np.ones(len(h), bool)
        place = (h >> np.uint64(64 - (len(self.first) - 1).bit_length() + 1)).astype(np.int64)
        at, end = self.first[place], self.first[place + 1]
        left = np.flatnonzero(at < end)
        while len(left):
            same = self.features[at[left]] == h[left]
            hit = left[same]
            out[hit] = self.counts[at[hit]]
            missing[hit] = False
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out, missing


@dataclass(frozen=True)
class Model:
    counts: Counts
    rate: float  # lambda
    k: float
    slope: float
    offset: float
    rest: DataFrame | None = None  # feature, toxic, clean of the features that tasks do not hold


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def _features(data: np.ndarray, at: np.ndarray):
    """Start and end of every word, and its chain of feature hashes from short prefix to whole word."""
    starts, ends, whole, *short = W.spans(data, at, gaps=_GAPS, prefixes=PREFIXES)
    return starts, ends, [W.mix(h + s) for h, s in zip((*short, whole), _SALTS, strict=True)]


def _count(batches):
    """Document counts of the features in each batch of (text, toxic)."""
    for batch in batches:
        data, at = W.buffers(batch.column(0))
        toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64)
        keys, flags = [], []
        for low, high in W.blocks(at):
            base = at[low]
            starts, _, chain = _features(data[base : at[high]], at[low : high + 1] - base)
            row = np.searchsorted(at[low : high + 1] - base, starts, "right") - 1 + low
            for h in chain:
                order = np.lexsort((row, h))
                a, b = h[order], row[order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                keys.append(a[new])
                flags.append(toxic[b[new]])
        if not keys:
            continue
        key, at_ = np.unique(np.concatenate(keys), return_inverse=True)
        flag = np.concatenate(flags)
        n = np.bincount(at_, minlength=len(key))
        t = np.bincount(at_, weights=flag, minlength=len(key)).astype(np.int64)
        yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(t), pa.array(n - t)], names=["feature", "toxic", "clean"])


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Text and class of the documents that may be learnt from.

    Labels without id or class are no labels; of several for one id the larger counts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    known = written(known)
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return docs.select("doc_id", "text").join(known, "doc_id").select("text", "toxic")


def counted(rows: DataFrame, most: int = BINS) -> tuple[Counts, DataFrame | None]:
    """Document counts of all features: for tasks to hold those of the most frequent ones, ``most`` at
    the most; the others as a table, or None when there are none."""
    size = F.col("toxic") + F.col("clean")
    table = written(
        rows.mapInArrow(_count, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("level", F.when(size <= 1024, size).otherwise(F.floor(F.log2(size)) + 1024))
    )
    levels = {r.level: r.n for r in table.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= 1087 rows
    total, cut = 0, 2048
    for level in sorted(levels, reverse=True):
        if total + levels[level] > most:
            break
        total, cut = total + levels[level], level
    by = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    documents = by.get(0, 0), sum(v for k, v in by.items() if k)
    held = table.where(F.col("level") >= cut).select("feature", "toxic", "clean").toArrow()  # <= most rows
    counts = Counts.of(*[held.column(c).to_numpy() for c in ("feature", "toxic", "clean")], documents)
    rest = table.where(F.col("level") < cut).drop("level") if total < sum(levels.values()) else None
    return counts, rest


RARE = "_rare"


def with_rare(texts: DataFrame, counts: Counts, rest: DataFrame | None) -> DataFrame:
    """``texts`` with one more column: the counts of the features of its text that are in ``rest``.

    Each distinct text asks once for each of its features; the answers come back by the text's digest.
    """
    if rest is None:
        return texts.withColumn(RARE, F.lit(None).cast("array<struct<feature:long,toxic:long,clean:long>>"))
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def ask(batches):
        for batch in batches:
            data, at = W.buffers(batch.column(1))
            for low, high in W.blocks(at):
                base = at[low]
                edges = at[low : high + 1] - base
                starts, _, chain = _features(data[base : at[high]], edges)
                row = np.searchsorted(edges, starts, "right") - 1 + low
                for h in chain:
                    _, missing = shared.value.seen(h)
                    asked = np.unique(np.stack([row[missing].astype(np.uint64), h[missing]]), axis=1)
                    if asked.shape[1]:
                        yield pa.record_batch(
                            [batch.column(0).take(pa.array(asked[0].astype(np.int64))), pa.array(asked[1].view(np.int64))],
                            names=["_place", "feature"],
                        )

    placed = texts.withColumn("_place", F.md5(F.coalesce("text", F.lit("")))).withColumn("_row", F.monotonically_increasing_id())
    asked = written(placed.select("_place", "text").mapInArrow(ask, "_place string, feature long").distinct())
    answers = lookup_join(asked, rest, ["feature"], ["_place"], "inner")
    packed = answers.groupBy("_place").agg(F.collect_list(F.struct("feature", "toxic", "clean")).alias(RARE))
    return lookup_join(placed, packed, ["_place"], ["_row"]).select(*texts.columns, RARE)


def _rare(column: pa.Array) -> Counts | None:
    """Counts out of a batch's ``with_rare`` column."""
    found = pc.list_flatten(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    if not len(found):
        return None
    feature, toxic, clean = (pc.struct_field(found, c).to_numpy(zero_copy_only=False) for c in ("feature", "toxic", "clean"))
    feature, first = np.unique(feature, return_index=True)
    return Counts.of(feature, toxic[first], clean[first])


def word_scores(chain: list[np.ndarray], model: Counts, own: np.ndarray | None = None, rare: Counts | None = None) -> np.ndarray:
    """Log-odds over the base rate, minus the drift. ``own``: the class of each word's own document
    when that document was counted, so that it does not speak for itself. ``rare``: counts of features
    that the model does not hold."""
    base = (model.toxic + 0.5) / (model.toxic + model.clean + 1.0)
    p = np.full(len(chain[0]), base)
    for h in chain:
        seen, missing = model.seen(h)
        if rare is not None:
            seen[missing] = rare.seen(h[missing])[0]
        if own is not None:
            seen[np.arange(len(own)), own] -= 1.0
            np.maximum(seen, 0.0, out=seen)
        p = (seen[:, 1] + PRIOR * p) / (seen[:, 0] + seen[:, 1] + PRIOR)
    p = np.clip(p, 1e-7, 1 - 1e-7)
    return np.log(p / (1 - p)) - math.log(base / (1 - base)) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """Every maximal-scoring segment (start, end, score) of one sequence, in linear time."""
    upto = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[list] = []  # start, end, sum before, sum after, nearest earlier with a smaller sum before
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, float(upto[i]), float(upto[i + 1])
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, end, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            j, cut = found[j][4], j
            del found[cut:]
    return [(s, e, r - l) for s, e, l, r, _ in found]


def surprise(segments: list[float], n: int, rate: float, k: float) -> float:
    """-ln of the chance that a clean text of n words has segments so good, 0 to 50.

    One segment: the extreme-value law. The r best together, T the sum of their normalised scores:
    exp(-T) T^(r-1) / (r! (r-1)!), times 2^r for having tried every r.
    """
    if not n:
        return 0.0
    level = math.log(k * n)
    scores = sorted((rate * s - level for s in segments), reverse=True)
    x = scores[0] if scores else -level
    chance = math.exp(min(-x, 700.0))
    best = x if chance < 1e-9 else -math.log(-math.expm1(-chance)) if chance < 40 else 0.0
    total = 0.0
    for r, value in enumerate(scores, 1):
        if value <= 0:
            break
        total += value
        if r > 1:
            sums = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2)
            best = max(best, sums)
    return min(max(best, 0.0), 50.0)


def _scan(data: np.ndarray, at: np.ndarray, model: Counts, own: np.ndarray | None = None, rare: Counts | None = None):
    """For each row: starts and ends of its words, their scores and segments."""
    for low, high in W.blocks(at):
        base = at[low]
        edges = at[low : high + 1] - base
        starts, ends, chain = _features(data[base : at[high]], edges)
        first = np.searchsorted(starts, edges)
        each = None
        if own is not None:
            each = np.repeat(own[low:high], np.diff(first))
        scores = word_scores(chain, model, each, rare)
        up = np.flatnonzero(scores > 0)
        if len(up):
            row = np.searchsorted(first, up, "right")
            word = chain[-1][up]
            order = np.lexsort((up, word, row))
            new = np.ones(len(up), bool)
            new[1:] = (row[order][1:] != row[order][:-1]) | (word[order][1:] != word[order][:-1])
            place = np.arange(len(up))
            nth = place - np.maximum.accumulate(np.where(new, place, 0)) + 1
            scores[up[order]] = (scores[up[order]] + DRIFT) / nth - DRIFT
        for k in range(high - low):
            a, b = first[k], first[k + 1]
            yield low + k, starts[a:b] - edges[k], ends[a:b] - edges[k], scores[a:b]


def fit(docs: DataFrame, labels: DataFrame, bins: int = BINS) -> Model:
    """Counts, extreme-value law and logistic calibration from all labelled rows that are not held
    out. Without any toxic or any clean label every score is the share of toxic labels. ``bins``: how
    many features' counts tasks may hold."""
    rows = labelled(docs, labels)
    counts, rest = counted(rows, bins)
    total = counts.toxic + counts.clean
    base = (counts.toxic + 0.5) / (total + 1.0)
    flat = Model(counts, 1.0, 1.0, 0.0, math.log(base / (1 - base)), rest)
    if not counts.toxic or not counts.clean:
        return flat
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    steps = int((HIGH - LOW) / STEP)

    def look(batches):
        """Per labelled text its class, length and segment scores; per batch the clean word scores."""
        for batch in batches:
            data, at = W.buffers(batch.column(0))
            own = (np.asarray(batch.column(1).to_numpy(zero_copy_only=False)) > 0).astype(np.int64)
            seen = np.zeros(steps, np.int64)
            toxic, n, segments = [], [], []
            for row, starts, _, scores in _scan(data, at, shared.value, own, _rare(batch.column(2))):
                if not own[row]:
                    bin_ = np.clip(((scores - LOW) / STEP).astype(np.int64), 0, steps - 1)
                    seen += np.bincount(bin_, minlength=steps)
                toxic.append(int(own[row]))
                n.append(len(starts))
                segments.append([s for _, _, s in maximal_segments(scores)])
            used = np.flatnonzero(seen)
            m = len(toxic)
            yield pa.record_batch(
                [
                    pa.array(toxic + [None] * len(used), pa.int32()),
                    pa.array(n + seen[used].tolist(), pa.int64()),
                    pa.array(segments + [[] for _ in used], pa.list_(pa.float64())),
                    pa.array([None] * m + used.tolist(), pa.int32()),
                ],
                names=["toxic", "n", "segments", "step"],
            )

    looked = written(with_rare(rows, counts, rest).mapInArrow(look, "toxic int, n long, segments array<double>, step int"))
    histogram = looked.where("step is not null").groupBy("step").agg(F.sum("n").alias("n")).collect()  # <= 480 rows
    rate = karlin_root({LOW + (r.step + 0.5) * STEP: r.n for r in histogram})

    seen = looked.where("toxic is not null and n > 0")
    top = F.coalesce(F.array_max("segments"), F.lit(0.0))
    k = seen.where("toxic = 0").agg((F.count(F.lit(1)) / F.sum(F.col("n") * F.exp(-rate * top))).alias("k")).first().k
    k = float(k) if k else 1.0

    def weigh(batches):
        for batch in batches:
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            yield pa.record_batch(
                [batch.column(0), pa.array([round(surprise(s, n, rate, k), 1) for n, s in rows], pa.float64())],
                names=["toxic", "z"],
            )

    weighed = seen.select("toxic", "n", "segments").mapInArrow(weigh, "toxic int, z double")
    points = weighed.groupBy("z", "toxic").agg(F.count(F.lit(1)).alias("n"))  # <= 501 values of z
    pairs = [(r.z, r.toxic, r.n) for r in points.collect()]
    slope, offset = logistic(pairs)
    return Model(counts, rate, k, slope, offset, rest)


def karlin_root(histogram: dict[float, int]) -> float:
    """The positive root of sum p(s) exp(rate s) = 1; 1 when no score is positive."""
    total = sum(histogram.values())
    if not total or max(histogram) <= 0:
        return 1.0
    value = lambda r: sum(n * math.exp(r * s) for s, n in histogram.items()) / total - 1.0
    low, high = 1e-3, 1e-3
    if value(low) > 0:  # positive drift: no root
        return low
    while value(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def logistic(points: list[tuple[float, int, int]], ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the class given z, from (z, class, count), by Newton's method."""
    z = np.array([p[0] for p in points])
    y = np.array([p[1] for p in points], float)
    n = np.array([p[2] for p in points], float)
    design = np.stack([z, np.ones_like(z)])
    w = np.zeros(2)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(w @ design, -40, 40)))
        gradient = design @ (n * (y - q)) - ridge * w
        hessian = (design * (n * q * (1 - q))) @ design.T + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.0)), float(w[1])


PASSAGES = "array<struct<start:int,end:int,score:double>>"


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, toxicity ``score`` (0 to 1) and the significant toxic ``passages`` (code point
    spans with their segment scores) of every document. NULL and empty texts have no words: the score
    of a text without any evidence, and no passages."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, rest=None))

    def score(batches):
        for batch in batches:
            data, at = W.buffers(batch.column(1))
            scores, found = judge(data, at, shared.value, _rare(batch.column(2)))
            yield pa.record_batch(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(found, _PASSAGE_TYPE)],
                names=["doc_id", "score", "passages"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = with_rare(docs.select("doc_id", "text"), model.counts, model.rest)
    return texts.mapInArrow(score, f"doc_id {kind}, score double, passages {PASSAGES}")


_PASSAGE_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def judge(data: np.ndarray, at: np.ndarray, model: Model, rare: Counts | None = None) -> tuple[list[float], list[list[dict]]]:
    """Scores and significant passages of the rows of a buffer."""
    scores, found = [], []
    for row, starts, ends, each in _scan(data, at, model.counts, rare=rare):
        segments = maximal_segments(each)
        n = len(starts)
        z = surprise([value for _, _, value in segments], n, model.rate, model.k)
        q = model.slope * z + model.offset
        scores.append(1 / (1 + math.exp(-q)) if q > -700 else 0.0)
        kept = []
        for s, e, value in segments:
            if model.k * n * math.exp(-min(model.rate * value, 700)) < SIGNIFICANT:
                text = data[at[row] : at[row + 1]]
                before = int(np.count_nonzero((text[: starts[s]] & 0xC0) != 0x80))
                inside = int(np.count_nonzero((text[starts[s] : ends[e - 1]] & 0xC0) != 0x80))
                kept.append({"start": before, "end": before + inside, "score": value})
        found.append(kept)
    return scores, found


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with their columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, rest=None))
    at_text = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            data, at = W.buffers(batch.column(at_text))
            scores, _ = judge(data, at, shared.value, _rare(batch.column(batch.num_columns - 1)))
            kept = batch.select(list(range(batch.num_columns - 1)))
            yield kept.filter(pa.array(np.asarray(scores) < threshold, pa.bool_()))

    return with_rare(docs, model.counts, model.rest).mapInArrow(keep, docs.schema)
