"""Toxicity severity by cumulative-link ordinal regression.

Features of a text are its distinct words ([0-9a-z] and bytes from 0x80, lower
case) and their first 4, 5 and 6 bytes, hashed to ``DIMENSIONS``. One sparse weight
vector w is shared by all thresholds: P(grade > j) = sigmoid(w.x - theta_j) with
theta_0 < theta_1 < ... ; the expected severity is the sum of these
probabilities. Only features that go with toxic rows beyond chance are used,
and fitted by proximal gradient steps with an L1 penalty: neutral words get no
weight and long texts aren't flagged for their length.

Grades: 0 for rows labelled not toxic; toxic rows are split at the median of
the number of their features that mark toxic rows: up to it 1, above 2.

The model is fitted on at most about ``sample_rows`` labelled rows, chosen by
hash; all documents are scored by their whole text.

Defined results: null and empty texts have no features and get severity and
p_toxic 0 and grade 0; labels that are null, or without a document, teach nothing; if the labels
lack a toxic or a clean row every score is 0; repeated rows are scored each;
other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import ship_by_value, stored
from vigil.llm.textops import NOT_ALNUM, blocks, byte_values, column_bytes, span_hasher, word_spans

DIMENSIONS = 1 << 20
PREFIXES = (4, 5, 6)


def features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs of a block, each once, by row; only those ``wanted``, if given."""
    starts, ends, first = word_spans(data, offsets, NOT_ALNUM)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    of = span_hasher(byte_values(data, lower=True), "byte")
    rows, found = [], []
    for n in (0, *PREFIXES):
        long = np.flatnonzero(ends - starts > n) if n else slice(None)
        s, e = starts[long], ends[long]
        f = (of(s, s + n if n else e) ^ np.uint64(n * 0x9E3779B9)) >> np.uint64(44)
        r = row[long]
        if wanted is not None:
            ok = wanted[f]
            r, f = r[ok], f[ok]
        rows.append(r)
        found.append(f)
    code = np.unique(np.concatenate(rows).astype(np.uint64) * np.uint64(DIMENSIONS) + np.concatenate(found))
    return (code // np.uint64(DIMENSIONS)).astype(np.int64), (code % np.uint64(DIMENSIONS)).astype(np.int64)


def sampled_features(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(toxic, features) of about ``sample_rows`` labelled documents, each text of a doc_id once.

    Labelled ids are chosen by a hash. Where these have more texts than ids, a hash of (doc_id, text) keeps about
    ``sample_rows`` of the texts, so the sample is bounded however often an id stands in ``docs``.
    """
    known = labels.filter("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    n = known.count()
    u = F.xxhash64(F.lit(11), "doc_id").bitwiseAND((1 << 52) - 1) / F.lit(float(1 << 52))
    chosen = stored(known.filter(u < sample_rows / max(n, 1)).distinct(), "labelled_sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for start, raw, at in blocks(data, offsets):
                m = len(at) - 1
                r, f = features(raw, at)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(m + 1)).astype(np.int32)), pa.array(f.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, m), batch.column("toxic").slice(start, m), lists], names=["doc_id", "toxic", "features"])

    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h"))
    pairs = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "h").distinct()  # broadcast: bounded by sample_rows
    n = pairs.count()
    if n > 2 * sample_rows:
        v = F.xxhash64(F.lit(12), "doc_id", "h").bitwiseAND((1 << 52) - 1) / F.lit(float(1 << 52))
        pairs = pairs.filter(v < sample_rows / n)
    wanted = stored(pairs, "labelled_texts")
    rows = texts.join(F.broadcast(wanted), ["doc_id", "h"]).groupBy("doc_id", "toxic", "h").agg(F.first("text").alias("text"))
    return rows.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id long, toxic int, features array<int>")


def grades(toxic: np.ndarray, row: np.ndarray, feature: np.ndarray, n_features: int) -> np.ndarray:
    """0 for clean rows; 1 and 2 for toxic ones with a number of marking features up to, or over, the median."""
    on = toxic[row] > 0
    a = np.bincount(feature[on], minlength=n_features) + 0.5
    b = np.bincount(feature[~on], minlength=n_features) + 0.5
    odds = np.log(a / max(1, (toxic > 0).sum())) - np.log(b / max(1, (toxic == 0).sum()))
    marks = np.bincount(row, weights=(odds[feature] > 3) * 1.0, minlength=len(toxic))
    middle = np.median(marks[toxic > 0])
    return np.where(toxic > 0, 1 + (marks > middle), 0)


def marking(toxic: np.ndarray, row: np.ndarray, feature: np.ndarray, n_features: int, min_z: float) -> np.ndarray:
    """Features whose presence goes with the toxic rows: at least ``min_z`` standard deviations from chance."""
    n, y = len(toxic), (toxic > 0) * 1.0
    share = np.bincount(feature, minlength=n_features) / n
    with_toxic = np.bincount(feature, weights=y[row] - y.mean(), minlength=n_features) / n
    return np.abs(with_toxic) > min_z * np.sqrt(np.maximum(share, 1e-12) * y.var() / n)


def fit(grade: np.ndarray, row: np.ndarray, feature: np.ndarray, n_features: int, *, penalty: float = 1e-4,
        rounds: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model of the grades 0 .. max(grade), by
    accelerated proximal gradient steps on columns scaled to equal norm."""
    k, n = int(grade.max()), len(grade)
    share = np.array([(grade > j).mean() for j in range(k)]).clip(1e-3, 1 - 1e-3)
    theta = -np.log(share / (1 - share))
    scale = 1 / np.sqrt(np.maximum(np.bincount(feature, minlength=n_features) / n, 1e-12))  # of a column
    w = look = np.zeros(n_features)
    # largest eigenvalue of the scaled design, by power steps; the link's curvature is at most 1/4 for each of two terms
    v = np.ones(n_features)
    norm = 1.0
    for _ in range(20):
        u = np.bincount(row, weights=(v * scale)[feature], minlength=n)
        v = np.bincount(feature, weights=u[row], minlength=n_features) * scale / n
        norm = max(float(np.linalg.norm(v)), 1e-12)
        v /= norm
    rate, momentum = 1 / (0.5 * norm + 0.5), 1.0

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for _ in range(rounds):
        s = np.bincount(row, weights=(look * scale)[feature], minlength=n)
        upper = sigmoid(np.concatenate([theta, [np.inf]])[grade] - s)
        lower = sigmoid(np.concatenate([[-np.inf], theta])[grade] - s)
        p = np.maximum(upper - lower, 1e-9)
        g = np.bincount(feature, weights=((1 - upper - lower) / n)[row], minlength=n_features) * scale
        new = look - rate * g
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty * scale, 0)
        ahead = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        look = new + (momentum - 1) / ahead * (new - w)
        w, momentum = new, ahead
        gt = np.zeros(k)
        np.add.at(gt, grade[grade < k], -((upper * (1 - upper) / p) / n)[grade < k])
        np.add.at(gt, grade[grade > 0] - 1, ((lower * (1 - lower) / p) / n)[grade > 0])
        theta = np.maximum.accumulate(theta - gt + 1e-6 * np.arange(k))
    return w * scale, theta


def train(sample: pa.Table, min_rows: int = 6, min_z: float = 5.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights over DIMENSIONS and thresholds; no thresholds where the sample has only one kind of row."""
    weights = np.zeros(DIMENSIONS, np.float32)
    toxic = sample.column("toxic").to_numpy()
    if len(toxic) == 0 or (toxic > 0).all() or (toxic <= 0).all():
        return weights, np.zeros(0)
    order = np.argsort(sample.column("doc_id").to_numpy(), kind="stable")  # the same fit whatever the order of the rows
    sample, toxic = sample.take(pa.array(order)), toxic[order]
    lists = sample.column("features").combine_chunks()
    row = np.repeat(np.arange(len(toxic)), np.diff(lists.offsets.to_numpy()))
    feature = lists.flatten().to_numpy()
    used = (np.bincount(feature, minlength=DIMENSIONS) >= min_rows) & marking(toxic, row, feature, DIMENSIONS, min_z)
    row, feature = row[used[feature]], feature[used[feature]]
    ids, feature = np.unique(feature, return_inverse=True)
    w, theta = fit(grades(toxic, row, feature, len(ids)), row, feature, len(ids))
    weights[ids] = w
    return weights, theta


def severity(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 10_000) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of every row of ``docs`` (doc_id, text); ``labels`` has doc_id and toxic."""
    ship_by_value()
    weights, theta = train(sampled_features(docs, labels, sample_rows).toArrow())
    used = np.flatnonzero(weights)
    model = docs.sparkSession.sparkContext.broadcast((used, weights[used], theta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_, value, thresholds = model.value
        w = np.zeros(DIMENSIONS, np.float64)
        w[at_] = value
        wanted = w != 0
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            s = np.zeros(batch.num_rows)
            some = np.zeros(batch.num_rows, bool)
            for start, raw, at in blocks(data, offsets):
                r, f = features(raw, at, wanted)
                m = len(at) - 1
                s[start: start + m] = np.bincount(r, weights=w[f], minlength=m)
                some[start: start + m] = np.diff(at) > 0
            over = some[:, None] / (1 + np.exp(-np.clip(s[:, None] - thresholds[None, :], -40, 40)))  # P(grade > j)
            p = over[:, 0] if len(thresholds) else np.zeros(len(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(over.sum(1)), pa.array(p), pa.array((over >= 0.5).sum(1).astype(np.int32)), pa.array(p >= 0.5)],
                names=["doc_id", "severity", "p_toxic", "grade", "toxic"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")
