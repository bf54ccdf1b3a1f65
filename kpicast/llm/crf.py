"""Document quality from a linear-chain conditional random field over lines.

Every line that is not blank is good or bad. Its evidence is a weighted sum of its
own features and those of the lines before and after it; a 2 x 2 table scores the
step from one label to the next. Forward-backward gives each line's probability of
being good, and the mean of these, weighted by line length, is the document's score.

The model is fitted on a sample of at most ``MAX_DOCS`` labelled documents (all
their lines carry the document's label), cut to chains of ``CHAIN`` lines for the
fit only. Scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kpicast.llm.common import SMALL_SLICE, mix, slices, span_hashes, text_buffer, word_spans

MAX_DOCS = 4000
MAX_CHAINS = 1 << 14  # of CHAIN lines: at most 270 MB of features reach the driver
CHAIN = 32
ROUNDS = 250
THRESHOLD = 0.3

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_UPPER, _LOWER, _DIGIT, _SPACE, _OTHER, _FIRST_MARK = 0, 1, 2, 3, 4, 5
_CLASSES = _FIRST_MARK + len(PUNCTUATION)
_CLASS = np.full(256, _OTHER, np.int64)
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
for _k, _mark in enumerate(PUNCTUATION):
    _CLASS[ord(_mark)] = _FIRST_MARK + _k
WIDTH = 10 + len(PUNCTUATION)


def line_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte of every line with a word in it, and lines per row."""
    newline = np.flatnonzero(buf == 0x0A)
    starts = np.unique(np.concatenate([newline + 1, offsets[:-1]]))
    starts = starts[starts < len(buf)]
    # A line ends at the next newline or where its row ends.
    ends = np.append(newline, len(buf))[np.searchsorted(newline, starts)]
    ends = np.minimum(ends, offsets[np.searchsorted(offsets, starts, "right")])
    ink = np.concatenate([[0], np.cumsum(_CLASS[buf] != _SPACE)])
    full = ink[ends] > ink[starts]
    starts, ends = starts[full], ends[full]
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def own_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of ``WIDTH`` features per line, the line's length in bytes, lines per row."""
    starts, ends, counts = line_spans(buf, offsets)
    n = len(starts)
    if not n:
        return np.zeros((0, WIDTH)), np.zeros(0), counts
    line_of = np.searchsorted(starts, np.arange(len(buf)), "right") - 1
    inside = (line_of >= 0) & (np.arange(len(buf)) < ends[line_of])
    kinds = np.bincount(line_of[inside] * _CLASSES + _CLASS[buf[inside]], minlength=n * _CLASSES)
    kinds = kinds.reshape(n, _CLASSES).astype(float)
    length = (ends - starts).astype(float)
    w_starts, w_ends, _ = word_spans(buf, offsets)
    hashes = span_hashes(buf, w_starts, w_ends)
    w_line = np.searchsorted(starts, w_starts, "right") - 1
    words = np.bincount(w_line, minlength=n).astype(float)
    word_bytes = np.bincount(w_line, weights=w_ends - w_starts, minlength=n)
    _, first = np.unique(mix(hashes ^ mix(w_line.astype(np.uint64))), return_index=True)
    distinct = np.bincount(w_line[first], minlength=n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (w_line[1:] == w_line[:-1])
    repeated = np.bincount(w_line[again], minlength=n)
    letters = kinds[:, _UPPER] + kinds[:, _LOWER] + kinds[:, _OTHER] + 1.0
    last = buf[ends - 1]
    columns = [
        np.log1p(words),
        np.minimum(word_bytes / words / 10.0, 5.0),
        distinct / words,
        repeated / words,
        kinds[:, _UPPER] / letters,
        kinds[:, _DIGIT] / length,
        kinds[:, _OTHER] / length,
        kinds[:, _SPACE] / length,
        np.isin(last, np.frombuffer(b".!?", np.uint8)).astype(float),
        (_CLASS[buf[starts]] == _UPPER).astype(float),
    ]
    marks = np.minimum(kinds[:, _FIRST_MARK:] / words[:, None], 2.0)
    return np.column_stack([*columns, marks]), length, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of a line, the line before, the line after, and whether they exist."""
    n = len(own)
    row = np.repeat(np.arange(len(counts)), counts)
    before, after = np.zeros((n, 1)), np.zeros((n, 1))
    before[1:, 0] = row[1:] == row[:-1]
    after[:-1, 0] = row[1:] == row[:-1]
    up, down = np.zeros_like(own), np.zeros_like(own)
    up[1:] = own[:-1]
    down[:-1] = own[1:]
    return np.hstack([own, up * before, down * after, before, after])


@dataclass
class Model:
    weights: np.ndarray  # evidence for good, by standardised feature
    bias: float
    steps: np.ndarray  # 2 x 2: from, to; 1 is good
    mean: np.ndarray
    scale: np.ndarray
    prior: float  # score of a text without lines

    def evidence(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights + self.bias


def _passes(evidence: np.ndarray, counts: np.ndarray, steps: np.ndarray):
    """Forward and backward log scores (bad, good) of every line, chains side by side:
    step t works on all chains that have a t-th line."""
    n = len(evidence)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    own = np.stack([np.zeros(n), evidence], 1)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")  # chains longer than t
    for t in range(longest):
        at = starts[: active[t]] + t
        if t == 0:
            forward[at] = own[at]
        else:
            old = forward[at - 1]
            forward[at, 0] = np.logaddexp(old[:, 0] + steps[0, 0], old[:, 1] + steps[1, 0])
            forward[at, 1] = np.logaddexp(old[:, 0] + steps[0, 1], old[:, 1] + steps[1, 1])
            forward[at] += own[at]
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        new = backward[at + 1] + own[at + 1]
        backward[at, 0] = np.logaddexp(new[:, 0] + steps[0, 0], new[:, 1] + steps[0, 1])
        backward[at, 1] = np.logaddexp(new[:, 0] + steps[1, 0], new[:, 1] + steps[1, 1])
    return forward, backward, own


def marginals(evidence: np.ndarray, counts: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Probability of good for every line."""
    forward, backward, _ = _passes(evidence, counts, steps)
    odds = forward + backward
    return 1.0 / (1.0 + np.exp(np.clip(odds[:, 0] - odds[:, 1], -700, 700)))


def fit_chains(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Maximise the penalised conditional likelihood of the labels by gradient steps
    with adaptive moments. ``labels``: 0 or 1 per chain."""
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(features) or labels.min() == labels.max():
        width = 3 * WIDTH + 2
        flat = float(np.clip(np.log((prior + 1e-3) / (1 - prior + 1e-3)), -7, 7))
        return Model(np.zeros(width), flat, np.zeros((2, 2)), np.zeros(width), np.ones(width), prior)
    mean, scale = features.mean(0), features.std(0)
    scale[scale < 1e-9] = 1.0
    x = (features - mean) / scale
    x = np.clip(x, -8, 8)
    chain = np.repeat(np.arange(len(counts)), counts)
    y = labels[chain]
    linked = np.flatnonzero(chain[1:] == chain[:-1])
    theta, m, v = np.zeros(x.shape[1] + 5), np.zeros(x.shape[1] + 5), np.zeros(x.shape[1] + 5)
    gold = np.zeros((2, 2))
    np.add.at(gold, (y[linked].astype(int), y[linked + 1].astype(int)), 1)
    for k in range(1, rounds + 1):
        weights, bias, steps = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        evidence = x @ weights + bias
        forward, backward, own = _passes(evidence, counts, steps)
        both = forward + backward
        total = np.logaddexp(both[:, 0], both[:, 1])
        good = np.exp(both[:, 1] - total)
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                part = forward[linked, a] + steps[a, b] + own[linked + 1, b] + backward[linked + 1, b]
                expected[a, b] = np.exp(part - total[linked]).sum()
        gap = y - good
        gradient = np.concatenate([x.T @ gap, [gap.sum()], (gold - expected).ravel()]) / len(counts)
        penalty = 0.01 * theta
        penalty[-5] = 0.0
        gradient -= penalty
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Model(theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2), mean, scale, prior)


def fit(
    docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chains: int = MAX_CHAINS
) -> Model:
    """Fit on the ``max_docs`` documents of ``labels`` (doc_id, quality) that come
    first in hash order, and of their lines on the ``max_chains`` runs of ``CHAIN`` lines
    that do, so the driver's share is bounded at any length of text. Rows without a label
    are left out; a document labelled twice counts as bad if one label says so; of rows
    that repeat an id one is taken; ids may be of any type; without labels the model is
    flat."""
    named = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
    chosen = (
        named.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    )
    # At most max_docs rows of two numbers, whatever the size of the tables.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_quality").alias("_quality"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SMALL_SLICE):
            own, _, counts = own_features(*text_buffer(batch.column("text")))
            if not counts.sum():
                continue
            features = with_neighbours(own, counts).astype(np.float32)
            cut = np.cumsum(counts) - counts
            chains = [(k, s, min(s + CHAIN, counts[k])) for k in range(len(counts)) for s in range(0, counts[k], CHAIN)]
            row = pa.array([k for k, _, _ in chains], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(row),
                "start": pa.array([s for _, s, _ in chains], pa.int64()),
                "label": batch.column("_quality").take(row),
                "features": pa.array([features[cut[k] + s : cut[k] + e].tobytes() for k, s, e in chains], pa.binary()),
            })

    key = sample.schema["doc_id"].dataType.simpleString()
    chains = sample.mapInArrow(lines, f"doc_id {key}, start long, label int, features binary")
    chains = chains.orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start").limit(max_chains).toPandas()
    chains = chains.sort_values(["doc_id", "features"], kind="stable")
    width = 3 * WIDTH + 2
    blocks = [np.frombuffer(b, np.float32).reshape(-1, width) for b in chains["features"]]
    if not blocks:
        return fit_chains(np.zeros((0, width)), np.zeros(0, int), np.zeros(0))
    counts = np.array([len(b) for b in blocks])
    return fit_chains(np.vstack(blocks).astype(float), counts, chains["label"].to_numpy(float))


def score_batch(text: pa.Array, model: Model) -> np.ndarray:
    own, length, counts = own_features(*text_buffer(text))
    scores = np.full(len(counts), model.prior)
    if counts.sum():
        good = marginals(model.evidence(with_neighbours(own, counts)), counts, model.steps)
        row = np.repeat(np.arange(len(counts)), counts)
        total = np.bincount(row, weights=length, minlength=len(counts))
        full = counts > 0
        scores[full] = (np.bincount(row, weights=length * good, minlength=len(counts))[full] / total[full])
    return np.clip(scores, 0.0, 1.0)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with _score (0 to 1, high is good) and _predicted (0 or 1).

    Texts that are null, empty or blank get the share of good labels the model was
    fitted on. Every row is scored by itself, so repeated rows agree. Columns that have
    the names of the results are replaced. The model is a
    few hundred numbers in the task's closure.
    """
    docs = docs.drop("_score", "_predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SMALL_SLICE):
            values = pa.array(score_batch(batch.column("text"), model), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, "_score"])

    rows = docs.mapInArrow(scored, schema)
    return rows.withColumn("_predicted", (F.col("_score") >= threshold).cast("int"))
