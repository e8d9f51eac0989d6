"""Document quality by a convolutional network over raw bytes, in NumPy.

Bytes get learned vectors; filters of WIDTH bytes slide over the whole text; the strongest answer of each
filter is kept per chunk (chunks overlap and cover the text), a document is the mean and the maximum of
its chunks, and a logistic unit gives the probability. Training runs in one task on a bounded sample of
labelled rows, scoring in Arrow batches on all rows, whole texts, in slabs of fixed size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import blocks, buffers

#: bytes that a filter sees, numbers in a byte's vector, filters
WIDTH, DEEP, FILTERS = 6, 4, 16
#: A unit is UNIT positions; a chunk is CHUNK units and begins STEP units after the one before.
UNIT, CHUNK, STEP = 128, 4, 3
PAD = 256
#: units worked on at a time
SLAB = 1 << 11
#: Training reads at most so many labelled rows (those with the smallest hash of their id), texts of up to
#: LONGEST bytes, and of these as many, in hash order, as BYTES hold.
ROWS, LONGEST, BYTES = 3000, 1 << 16, 12_000_000
EPOCHS, BATCH, RATE = 10, 32, 0.01


@dataclass
class Net:
    """``byte`` (257 x DEEP, the padding's row is zero), ``filter`` (WIDTH * DEEP x FILTERS), ``bias``,
    ``out`` (2 * FILTERS: weights of mean and maximum) and ``base``."""

    byte: np.ndarray
    filter: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.byte, self.filter, self.bias, self.out, self.base]


def fresh(seed: int) -> Net:
    rng = np.random.default_rng(seed)
    byte = rng.normal(0, 0.5, (257, DEEP)).astype(np.float32)
    byte[PAD] = 0
    return Net(
        byte,
        rng.normal(0, (WIDTH * DEEP) ** -0.5, (WIDTH * DEEP, FILTERS)).astype(np.float32),
        np.full(FILTERS, -0.5, np.float32),
        rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )


def laid_out(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes of all rows, each behind the padding of one window and filled up to whole units, and the
    first unit of each row (one more at the end). So no window sees two rows; an empty row is a unit of
    padding."""
    lengths = np.diff(at)
    units = -(-(lengths + WIDTH - 1) // UNIT)
    first = np.concatenate(([0], np.cumsum(units)))
    codes = np.full(int(first[-1]) * UNIT + WIDTH, PAD, np.int16)
    codes[np.arange(len(data)) + np.repeat(first[:-1] * UNIT + WIDTH - 1 - at[:-1], lengths)] = data
    return codes, first


def windows(codes: np.ndarray, low: int, high: int, net: Net) -> np.ndarray:
    """Filter answers (filters x positions) at positions low..high."""
    flat = net.byte[codes[low : high + WIDTH - 1]].reshape(-1)
    shape, step = (high - low, WIDTH * DEEP), flat.strides[0]
    seen = np.ascontiguousarray(np.lib.stride_tricks.as_strided(flat, shape, (step * DEEP, step)))
    return net.filter.T @ seen.T


def strongest(codes: np.ndarray, units: int, net: Net, places: bool = False):
    """Greatest answer of each filter in each unit, no less than 0 (what padding answers); with ``places``
    its position, too."""
    top = np.empty((units, FILTERS), np.float32)
    where = np.empty((units, FILTERS), np.int64) if places else None
    for low in range(0, units, SLAB):
        high = min(units, low + SLAB)
        answers = windows(codes, low * UNIT, high * UNIT, net).reshape(FILTERS, high - low, UNIT)
        if places:
            spot = answers.argmax(2)
            top[low:high] = np.take_along_axis(answers, spot[:, :, None], 2)[:, :, 0].T
            where[low:high] = spot.T + np.arange(low, high)[:, None] * UNIT
        else:
            top[low:high] = answers.max(2).T
    np.maximum(top, 0, out=top)
    return (top, where) if places else top


def chunked(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units of every chunk (chunks x CHUNK, the last unit of a row repeats where it ends) and the
    first chunk of each row."""
    units = np.diff(first)
    count = np.maximum(1, -(-(units - (CHUNK - STEP)) // STEP))
    begin = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(units)), count)
    start = first[row] + (np.arange(begin[-1]) - begin[row]) * STEP
    return np.minimum(start[:, None] + np.arange(CHUNK), first[row + 1][:, None] - 1), begin


def probabilities(data: np.ndarray, at: np.ndarray, net: Net) -> np.ndarray:
    """Probability of every row of ``data`` cut at ``at``."""
    out = np.empty(len(at) - 1)
    for low, high in blocks(at):
        codes, first = laid_out(data[at[low] : at[high]], at[low : high + 1] - at[low])
        top = strongest(codes, int(first[-1]), net)
        units, begin = chunked(first)
        answer = np.tanh(top[units].max(1) + net.bias)
        mean = np.add.reduceat(answer, begin[:-1]) / np.diff(begin)[:, None]
        most = np.maximum.reduceat(answer, begin[:-1])
        logit = np.concatenate([mean, most], 1) @ net.out + net.base
        out[low:high] = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))
    return out


def slopes(data: np.ndarray, at: np.ndarray, truth: np.ndarray, net: Net) -> tuple[list[np.ndarray], float]:
    """Gradient of the mean log loss over the rows by every part of the net, and the loss."""
    rows = len(at) - 1
    codes, first = laid_out(data, at)
    top, where = strongest(codes, int(first[-1]), net, places=True)
    units, begin = chunked(first)
    pick = top[units].argmax(1)
    unit = np.take_along_axis(units, pick, 1)
    raw = np.take_along_axis(top, unit, 0)
    answer = np.tanh(raw + net.bias)
    count = np.diff(begin)
    own = np.repeat(np.arange(rows), count)
    mean = np.add.reduceat(answer, begin[:-1]) / count[:, None]
    most = np.maximum.reduceat(answer, begin[:-1])
    features = np.concatenate([mean, most], 1)
    logit = np.clip(features @ net.out + net.base, -30, 30)
    p = 1 / (1 + np.exp(-logit))
    loss = -np.mean(np.where(truth > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9)))
    up = ((p - truth) / rows).astype(np.float32)

    # the maximum belongs to the first chunk that reaches it
    reached = answer == most[own]
    order = np.cumsum(reached, 0)
    before = np.concatenate([np.zeros((1, FILTERS), order.dtype), order])[begin[:-1]][own]
    holder = reached & (order - before == 1)
    down = up[own][:, None] * (net.out[:FILTERS] / count[own][:, None] + net.out[FILTERS:] * holder)
    down *= 1 - answer * answer
    d_bias = down.sum(0)
    # padding answers 0 and learns nothing
    hit, which = np.nonzero((raw > 0) & (down != 0))
    spots = where[unit[hit, which], which][:, None] + np.arange(WIDTH)
    seen = codes[spots]
    weight = down[hit, which]
    vector = net.byte[seen].reshape(len(hit), -1)
    d_filter = np.zeros_like(net.filter)
    for f in range(FILTERS):
        mine = which == f
        d_filter[:, f] = weight[mine] @ vector[mine]
    pushed = (net.filter.T[which] * weight[:, None]).reshape(-1, DEEP)
    d_byte = np.stack([np.bincount(seen.reshape(-1), pushed[:, k], 257) for k in range(DEEP)], 1).astype(np.float32)
    d_byte[PAD] = 0
    return [d_byte, d_filter, d_bias, features.T @ up, up.sum(keepdims=True)], float(loss)


def train(texts: list[bytes], truth: np.ndarray, seed: int, epochs: int = EPOCHS) -> Net:
    """Adam over shuffled batches of whole texts; the rate falls to nothing over the epochs."""
    net = fresh(seed)
    share = float(np.clip(truth.mean(), 0.01, 0.99))
    net.base[:] = np.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    steps = epochs * -(-len(texts) // BATCH)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            at = np.concatenate(([0], np.cumsum([len(texts[i]) for i in chosen])))
            data = np.frombuffer(b"".join(texts[i] for i in chosen), np.uint8)
            grads, _ = slopes(data, at, truth[chosen], net)
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for part, g, m, s in zip(net.parts(), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                part -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def constant(share: float) -> Net:
    """A net that gives ``share`` for every text: for samples without both classes."""
    net = fresh(0)
    net.out[:] = 0
    share = min(max(share, 1e-6), 1 - 1e-6)
    net.base[:] = np.log(share / (1 - share))
    return net


def fit(
    docs: DataFrame, labels: DataFrame, target: str, learnable: Column, rows: int = ROWS, size: int = BYTES, seed: int = 7
) -> Net:
    """A net that tells label 1 of ``target`` from label 0, learnt from ``labels`` rows that satisfy
    ``learnable`` (an expression over doc_id).

    The sample is at most ``rows`` rows and ``size`` bytes (see ROWS): it has the smallest hashes of the id, so it is the
    same for the same tables. An id with several labels takes each of them once; NULL ids and labels do not
    count, NULL texts are empty. Without rows of both classes the net gives their share (0.5 without rows).
    """
    known = labels.where(learnable & F.col(target).isin(0, 1)).select("doc_id", F.col(target).cast("int").alias("_y")).distinct()
    known = known.where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t")).where(F.octet_length("_t") <= LONGEST)
    # the broadcast side has at most ``rows`` rows
    found = texts.join(F.broadcast(known), "doc_id")
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "_y", F.xxhash64("_t")).limit(rows).select("_t", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[bytes] = []
        truth: list[int] = []
        left = size
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode("utf-8", "replace")
                left -= len(raw)
                if left < 0:
                    break
                got.append(raw)
                truth.append(y)
        y = np.array(truth, np.float32)
        if len(set(truth)) < 2:
            net = constant(float(y.mean()) if len(y) else 0.5)
        else:
            net = train(got, y, seed)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net.parts())], pa.binary())], ["net"])

    # a limit leaves one partition: one training, one row of a few kilobytes
    learnt = found.coalesce(1).mapInArrow(run, "net binary").collect()
    return Net(*pickle.loads(learnt[0][0])) if learnt else constant(0.5)


def scored(docs: DataFrame, net: Net, keep: list[str], score: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` and the probability of label 1 from the whole text; NULL texts count
    as empty. No shuffle: rows are scored where they are read."""
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    names = [*keep, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffers(batch.column(len(keep)))
            p = probabilities(data, at, net)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(p)], names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{fields}, `{score}` double")
