"""A quality classifier: histogram gradient-boosted trees on text statistics.

Statistics of whole texts (sizes, character classes, word and line
repetition) are computed with numpy over Arrow buffers.  Training bins every
statistic at its quantiles and grows fixed-depth trees from gradient
histograms with a logistic loss; a tree is flat arrays of a complete binary
tree, so scoring is ``depth`` gathers per tree over a whole batch.

The classifier is fitted on at most ``TRAIN_ROWS`` labelled rows, the least
by a hash of the id: a documented bound on what the driver holds.

Defined results: a null text has the statistics of an empty one; rows
without a label teach nothing, conflicting labels of one id count one row
each; without labelled rows, or with one class only, every score is the
share of label 1 (0.5 without rows); repeated rows are repeated results; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwx.llm.text import SPACE, edges, mix, pieces, shingles, word_hashes

TRAIN_ROWS = 20_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.2
LEAF = 5
RIDGE = 1.0
CUTOFF = 0.3


def _class(*ranges) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return table


UPPER, LOWER_, DIGIT = _class((65, 90)), _class((97, 122)), _class((48, 57))
STOP, BANG, HIGH = _class((46, 46), (63, 63)), _class((33, 33)), _class((128, 255))
COMMA = _class((44, 44), (58, 59))
SIGN = _class((35, 38), (42, 43), (60, 64), (91, 96), (123, 126))
LINE = _class((10, 10))


def _of(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[off]).astype(float)


def _most(values: np.ndarray, first: np.ndarray):
    """Per text: distinct values, and how often the commonest stands."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])])) if len(v) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([new, [len(v)]])) if len(v) else np.zeros(0, np.int64)
    distinct = np.bincount(o[new], minlength=len(first) - 1).astype(float)
    most = np.zeros(len(first) - 1)
    np.maximum.at(most, o[new], times)
    return distinct, most


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of statistics per text."""
    size = np.diff(off).astype(float)
    chars = np.maximum(size, 1)
    start, end, first = edges(data, off, SPACE[data])
    hashes = word_hashes(data, start, end)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    long = np.concatenate([[0], np.cumsum(end - start)])[first]
    square = np.concatenate([[0], np.cumsum((end - start) ** 2)])[first]
    mean = np.diff(long) / some
    distinct, most = _most(hashes, first)
    again = np.zeros(len(hashes) + 1, bool)
    again[1:-1] = hashes[1:] == hashes[:-1]
    again[first] = False
    runs, at = shingles(hashes, first, 3)
    run_kinds, run_most = _most(runs, at)
    lines_at, lines_end, line_first = edges(data, off, data == 10)
    lines = np.diff(line_first).astype(float)
    line_kinds, line_most = _most(word_hashes(data, lines_at, lines_end), line_first)
    closed = STOP[data[lines_end - 1]] if len(lines_end) else np.zeros(0, bool)
    signed_end = SIGN[data[end - 1]] if len(end) else np.zeros(0, bool)
    banged = BANG[data[end - 1]] if len(end) else np.zeros(0, bool)
    capital = UPPER[data[start]] if len(start) else np.zeros(0, bool)
    pipe = (data[start] == 124) & (end - start == 1) if len(start) else np.zeros(0, bool)
    letters = np.maximum(_of(UPPER[data] | LOWER_[data] | HIGH[data], off), 1)

    def share(mask):
        return _of(mask, first) / some
    out = np.stack([
        np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(np.diff(square) / some - mean * mean, 0)),
        _of(UPPER[data], off) / letters, _of(DIGIT[data], off) / chars, _of(SIGN[data], off) / chars,
        _of(BANG[data], off) / chars, _of(STOP[data], off) / some, _of(COMMA[data], off) / some,
        _of(HIGH[data], off) / letters, _of(LINE[data], off) / some, letters / chars,
        distinct / some, distinct / np.sqrt(some), most / some, share(again[:-1]), share(signed_end), share(banged),
        share(capital), share(pipe), run_kinds / np.maximum(np.diff(at), 1), run_most / some,
        np.log1p(lines), line_kinds / np.maximum(lines, 1), line_most / np.maximum(lines, 1),
        _of(closed, line_first) / np.maximum(lines, 1), words / np.maximum(lines, 1)], axis=1)
    return out.astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE):
    """(start, feature, threshold, leaf): arrays of trees x nodes; node i has
    children 2i+1 and 2i+2; a row goes right if its value is above."""
    share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not len(y) or y.min() == y.max():
        return start, np.zeros((0, inner), np.int32), np.zeros((0, inner)), np.zeros((0, leaves))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1)    # bin b: above b cuts
    n, width = binned.shape
    margin = np.full(n, start)
    feature, threshold, leaf = (np.zeros((trees, k)) for k in (inner, inner, leaves))
    spots = binned + np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)                                  # place within the level
        for level in range(depth):
            many = 2 ** level
            key = (node[:, None] * (width * bins) + spots).ravel()
            g = np.bincount(key, np.repeat(grad, width), many * width * bins).reshape(many, width, bins).cumsum(2)
            h = np.bincount(key, np.repeat(hess, width), many * width * bins).reshape(many, width, bins).cumsum(2)
            c = np.bincount(key, minlength=many * width * bins).reshape(many, width, bins).cumsum(2)
            G, H, C = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g * g / (h + RIDGE) + (G - g) ** 2 / (H - h + RIDGE) - G * G / (H + RIDGE)
            gain[(c < LEAF) | (C - c < LEAF)] = -1
            best = gain.reshape(many, -1).argmax(1)
            ok = gain.reshape(many, -1)[np.arange(many), best] > 1e-6
            f, b = best // bins, best % bins
            cut = np.array([cuts[i][j] if k and j < len(cuts[i]) else np.inf for i, j, k in zip(f, b, ok)])
            feature[t, many - 1:2 * many - 1], threshold[t, many - 1:2 * many - 1] = f, cut
            node = 2 * node + (x[np.arange(n), f[node]] > cut[node])
        value = -rate * np.bincount(node, grad, leaves) / (np.bincount(node, hess, leaves) + RIDGE)
        leaf[t] = value
        margin += value[node]
    return start, feature.astype(np.int32), threshold, leaf


def predict(model, x: np.ndarray) -> np.ndarray:
    """Scores by level-wise traversal of the flat trees, all rows at once."""
    start, feature, threshold, leaf = model
    margin = np.full(len(x), start)
    rows = np.arange(len(x))
    inner = feature.shape[1]
    for f, cut, value in zip(feature, threshold, leaf):
        node = np.zeros(len(x), np.int64)
        while len(node) and node[0] < inner:
            node = 2 * node + 1 + (x[rows, f[node]] > cut[node])
        margin += value[node - inner]
    return 1 / (1 + np.exp(-margin))


def _measure(batches):
    for rows, data, off in pieces(batches):
        x = statistics(data, off)
        yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), pa.array(list(x), pa.list_(pa.float32()))], ["quality", "h", "x"])


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def fit(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, train_rows: int = TRAIN_ROWS):
    """The model, from labelled rows outside the held-out part."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), parts, part))
    chosen = known.select("doc_id", F.col("quality").cast("int").alias("quality")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "quality").limit(train_rows)          # at most train_rows narrow rows
    body = F.coalesce("text", F.lit("")).cast("binary").alias("t")
    sample = docs.select("doc_id", body).join(F.broadcast(chosen), "doc_id").select("t", "quality", F.xxhash64("doc_id", "t").alias("h"))
    rows = sample.mapInArrow(_measure, "quality int, h bigint, x array<float>")
    got = rows.orderBy("h", "quality").limit(train_rows).toArrow()          # rows that share a labelled id count too
    x = np.array(got["x"].to_pylist(), np.float32).reshape(got.num_rows, -1 if got.num_rows else 1)
    y = got["quality"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y)) if len(y) else np.zeros(0, np.int64)   # the same model whatever order rows come in
    return train(x[order], y[order])


def _scores(model, cutoff):
    def run(batches):
        for rows, data, off in pieces(batches):
            score = predict(model.value, statistics(data, off))
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), pa.array(score), pa.array((score >= cutoff).astype(np.int32))], ["doc_id", "score", "predicted"])
    return run


def classify(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, parts, part))
    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("t"), "doc_id")
    found = texts.mapInArrow(_scores(model, cutoff), f"doc_id {kind}, score double, predicted int")
    return found.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score", "predicted")


def _keep(model, cutoff):
    def run(batches):
        for rows, data, off in pieces(batches):
            good = predict(model.value, statistics(data, off)) >= cutoff
            kept = rows.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(kept.columns[1:], kept.schema.names[1:])
    return run


def accept(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that are not rejected, in one pass and as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, parts, part))
    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary"), *[docs[c] for c in docs.columns])
    return texts.mapInArrow(_keep(model, cutoff), docs.schema)
