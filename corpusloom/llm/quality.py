"""Quality rules with robust multivariate outliers.

Every document gets counts (words, symbols, repeated lines and words, capitals, line lengths) and from
them a vector of transformed statistics. For each language and source the minimum covariance
determinant of the vectors is found by concentration steps: from a start of medians and absolute
deviations, the mean and covariance of the h closest documents are re-estimated until they settle. A
document is rejected when its squared Mahalanobis distance is beyond a chi-square quantile.

All groups are estimated together, each step being one aggregation of sums with map-side combine, so
a group may hold any share of the rows; what stays per group is a vector and a matrix. The h-th
smallest distance comes from a quantile sketch (exact up to ACCURACY rows of a group).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..settings import written
from . import words as W

#: Transformed statistics and the least spread each is given: a statistic that is constant over the clean
#: documents of a group must not make every small deviation an outlier.
FEATURES = {
    "word_length": 0.06,  # log of mean word length
    "symbols": 0.04,  # root of symbols per word character
    "marks": 0.05,  # root of other ASCII punctuation per word character
    "capitals": 0.06,  # root of the share of A-Z among word characters
    "dup_lines": 0.15,  # root of the share of repeated lines
    "repeats": 0.12,  # root of the share of words in repeated windows
}
P = len(FEATURES)
#: Share of a group's rows that the covariance is taken of.
SHARE = 0.75
STEPS = 4
ACCURACY = 10_000
#: Groups smaller than this are estimated as their language, languages smaller as the whole table.
LEAST_ROWS = 40
#: Chance of a clean normal vector to be rejected.
ALPHA = 1e-6
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_MARK[list(SYMBOLS)] = False
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def chi_square_quantile(p: int, alpha: float) -> float:
    """x with P(chi-square of p degrees > x) = alpha, by bisection on the regularised gamma function."""

    def beyond(x: float) -> float:
        a, h = p / 2, x / 2
        if p % 2 == 0:
            return math.exp(-h) * sum(h**k / math.factorial(k) for k in range(p // 2))
        tail = math.erfc(math.sqrt(h))
        return tail + math.exp(-h) * sum(h ** (k - 0.5) / math.gamma(k + 0.5) for k in range(1, int(a + 0.5)))

    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if beyond(mid) > alpha else (low, mid)
    return low


def consistency(p: int, share: float) -> float:
    """Factor that makes the covariance of the closest ``share`` of normal rows unbiased."""
    return share / (1 - _above(p + 2, chi_square_quantile(p, 1 - share)))


def _above(p: int, x: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_quantile(p, mid) > x else (low, mid)
    return low


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a value occurs twice or more."""
    _, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[at] > 1


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals"]


def _statistics(texts: pa.Array) -> np.ndarray:
    """COUNTS of every text; NULL counts as empty."""
    data, at = W.buffers(texts)
    out = np.zeros((len(at) - 1, len(COUNTS)), np.int64)
    for low, high in W.blocks(at):
        base = at[low]
        part, edges = data[base : at[high]], at[low : high + 1] - base
        starts, ends, h = W.spans(part, edges, lower=False)
        first = np.searchsorted(starts, edges)
        out[low:high, 0] = np.diff(first)
        for k, flag in ((1, ~W.SPACE[part] & ((part & 0xC0) != 0x80)), (2, _SYMBOL[part]), (6, _MARK[part]), (7, _CAPITAL[part])):
            upto = np.concatenate(([0], np.cumsum(flag)))
            out[low:high, k] = np.diff(upto[edges])
        row = np.repeat(np.arange(high - low), np.diff(first))
        # words of 8-word windows that the same text has more than once
        if len(h) >= WINDOW:
            whole = row[: len(h) - WINDOW + 1] == row[WINDOW - 1 :]
            at_window = np.flatnonzero(whole)
            keys = W.mix(W.windows(h, WINDOW)[at_window] + row[at_window].astype(np.uint64) * np.uint64(W.BASE))
            again = at_window[_repeated(keys)] if len(at_window) else at_window
            cover = np.zeros(len(h) + 1, np.int64)
            np.add.at(cover, again, 1)
            np.add.at(cover, again + WINDOW, -1)
            np.add.at(out[low:high, 4], row, (np.cumsum(cover[:-1]) > 0).astype(np.int64))
        # lines with a word, and those equal to an earlier one
        for k in range(high - low):
            if first[k] == first[k + 1]:
                continue
            seen = set()
            for line in part[edges[k] : edges[k + 1]].tobytes().split(b"\n"):
                if line.strip(b" \t\n\x0b\x0c\r"):
                    out[low + k, 5] += 1
                    if line in seen:
                        out[low + k, 3] += 1
                    else:
                        seen.add(line)
    return out


def _vectors(c: np.ndarray) -> np.ndarray:
    chars = np.maximum(c[:, 1], 1)
    words = np.maximum(c[:, 0], 1)
    return np.stack(
        [
            np.log(chars / words),
            np.sqrt(c[:, 2] / chars),
            np.sqrt(c[:, 6] / chars),
            np.sqrt(c[:, 7] / chars),
            np.sqrt(c[:, 3] / np.maximum(c[:, 5], 1)),
            np.sqrt(c[:, 4] / words),
        ],
        axis=1,
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the COUNTS, base_failed and the vector ``x`` of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batches):
        for batch in batches:
            counts = _statistics(batch.column(3))
            vectors = pa.array(_vectors(counts).tolist(), pa.list_(pa.float64()))
            yield pa.record_batch(
                [*batch.columns[:3], *[pa.array(counts[:, k]) for k in range(len(COUNTS))], vectors],
                names=["doc_id", "lang", "source", *COUNTS, "x"],
            )

    columns = ", ".join(f"{c} long" for c in COUNTS)
    shown = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    rows = shown.mapInArrow(look, f"doc_id {kind}, lang string, source string, {columns}, x array<double>")
    return rows.withColumn(
        "base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    )


def _solve(center: list[float], cov: np.ndarray) -> np.ndarray:
    """Inverse covariance with the floor of every feature added to its variance."""
    floor = np.diag(np.array(list(FEATURES.values())) ** 2)
    return np.linalg.inv(cov + floor)


def _distance(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d`` of every row from its group's center."""

    def far(batches):
        for batch in batches:
            t = batch.to_pandas()
            x = np.array(t["x"].tolist()).reshape(-1, P)
            diff = x - np.array(t["center"].tolist()).reshape(-1, P)
            inverse = np.array(t["inverse"].tolist()).reshape(-1, P, P)
            d = np.einsum("ni,nij,nj->n", diff, inverse, diff)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(d)], names=["row", "g", "d"])

    joined = lookup_join(rows, model, ["g"], ["row"], how="inner")
    return joined.select("row", "g", "x", "center", "inverse").mapInArrow(far, "row long, g string, d double")


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance of every group's rows, from sums with map-side combine."""
    x = [F.element_at("x", i + 1) for i in range(P)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    sums += [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(P) for j in range(i, P)]
    return rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *sums)


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    """``center`` and ``inverse`` of every group from its sums."""

    def solve(batches):
        for t in batches:
            centers, inverses = [], []
            for r in t.to_dict("records"):
                n = r["n"]
                mean = np.array([r[f"s{i}"] for i in range(P)]) / n
                cov = np.zeros((P, P))
                for i in range(P):
                    for j in range(i, P):
                        cov[i, j] = cov[j, i] = r[f"s{i}_{j}"] / n - mean[i] * mean[j]
                centers.append(mean.tolist())
                inverses.append(_solve(centers[-1], cov * factor).reshape(-1).tolist())
            yield pd.DataFrame({"g": t["g"], "center": centers, "inverse": inverses})

    return sums.mapInPandas(solve, "g string, center array<double>, inverse array<double>")


def _start(rows: DataFrame) -> DataFrame:
    """Medians, and a diagonal covariance from the median absolute deviations around them."""
    columns = [F.element_at("x", i + 1) for i in range(P)]
    medians = rows.groupBy("g").agg(F.array(*[F.percentile_approx(c, 0.5, ACCURACY) for c in columns]).alias("center"))
    around = lookup_join(rows, written(medians), ["g"], ["row"], how="inner")
    away = [F.abs(c - F.element_at("center", i + 1)) for i, c in enumerate(columns)]
    spread = around.groupBy("g").agg(
        F.first("center").alias("center"), F.array(*[F.percentile_approx(a, 0.5, ACCURACY) for a in away]).alias("mad")
    )

    def solve(batches):
        for t in batches:
            inverses = [
                _solve(c, np.diag((1.4826 * np.array(m, float)) ** 2)).reshape(-1).tolist()
                for c, m in zip(t["center"], t["mad"], strict=True)
            ]
            yield pd.DataFrame({"g": t["g"], "center": t["center"], "inverse": inverses})

    return written(spread.mapInPandas(solve, "g string, center array<double>, inverse array<double>"))


def _grouped(rows: DataFrame) -> DataFrame:
    """``g``: language and source, or the language or the whole table where those have too few rows."""
    keyed = rows.withColumn("l", F.coalesce("lang", F.lit("\x00"))).withColumn("s", F.coalesce("source", F.lit("\x00")))
    fair = keyed.where(~F.col("base_failed"))
    counts = written(fair.groupBy("l", "s").agg(F.count(F.lit(1)).alias("n")))
    langs = counts.groupBy("l").agg(F.sum(F.when(F.col("n") < LEAST_ROWS, F.col("n"))).alias("m"))
    named = counts.join(langs, "l").select(
        "l",
        "s",
        F.when(F.col("n") >= LEAST_ROWS, F.to_json(F.array("l", "s")))
        .when(F.col("m") >= LEAST_ROWS, F.to_json(F.array("l")))
        .otherwise(F.lit("[]"))
        .alias("g"),
    )
    out = lookup_join(keyed, written(named), ["l", "s"], ["doc_id"])
    return out.withColumn("g", F.coalesce("g", F.lit("[]"))).drop("l", "s")


def outliers(rows: DataFrame) -> DataFrame:
    """``rows`` of ``measured`` with ``distance`` (squared; NULL for rows that fail the base rules) and
    ``kept``.

    The estimates are over all rows that pass the base rules. A group too small for its own estimate
    takes its language's group of all such small sources, or that of the whole table. An empty table
    gives an empty result.
    """
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    rows = written(_grouped(rows))
    fair = rows.where(~F.col("base_failed")).select("row", "g", "x")
    factor = consistency(P, SHARE)
    model = _start(fair)
    for _ in range(STEPS):
        near = written(_distance(fair, model))
        limits = near.groupBy("g").agg(F.percentile_approx("d", SHARE, ACCURACY).alias("limit"))
        inside = lookup_join(near, written(limits), ["g"], ["row"], how="inner").where("d <= limit").select("row")
        model = written(_estimate(_moments(fair.join(inside, "row", "left_semi")), factor))
    last = _distance(fair, model).select("row", F.col("d").alias("distance"))
    cut = chi_square_quantile(P, ALPHA)
    out = rows.join(last, "row", "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(False))).drop("row", "g", "x")
