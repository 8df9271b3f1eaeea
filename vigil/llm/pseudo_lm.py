"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token of a text is predicted from the token on its left and the one on its
right. Tokens are classes of white-space words: the ``FREQUENT`` most frequent
words of the corpus (lower case, hashed to 2**16 buckets), and for the others a class
of their shape; class 0 stands before and after a text. The network has
a hidden layer tanh(L[left] + R[right] + b) and a softmax over classes. A score is the
sum of log P(token | both sides), natural logarithm.

What it learns from is counted over all documents by Spark: bucket counts, then
counts of all (left, token, right) triples. Triples have at most VOCABULARY**3 = 2**21
cells, however large the corpus; with them full-batch training in numpy is
exactly training on every token of the corpus, and the trained network is a table
over contexts for scoring.

Defined results: null and empty texts have n_tokens 0, log_prob 0 and a null
mean; repeated rows count and are scored each; an empty table gives no rows;
other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import ship_by_value
from vigil.llm.textops import WHITE_SPACE, blocks, byte_values, column_bytes, span_hasher, word_spans

BUCKETS = 1 << 16
VOCABULARY, SHAPES = 128, 32
FREQUENT = VOCABULARY - SHAPES - 1

_codes = np.arange(256)
_UPPER = (_codes >= 65) & (_codes <= 90)
_DIGIT = (_codes >= 48) & (_codes <= 57)
_SIGN = (_codes < 128) & ~_UPPER & ~_DIGIT & ~((_codes >= 97) & (_codes <= 122))


def word_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(data, offsets, WHITE_SPACE)
    h = span_hasher(byte_values(data, lower=True), "byte")(starts, ends)
    return (h >> np.uint64(48)).astype(np.int64), starts, ends, first


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """0..31: length (4 steps), has a capital, a digit, a sign."""
    out = np.searchsorted(np.array([3, 6, 10]), ends - starts)
    for kind in (_UPPER, _DIGIT, _SIGN):
        total = np.concatenate([[0], np.cumsum(kind[data])])
        out = out * 2 + (total[ends] > total[starts])
    return out


def token_classes(data: np.ndarray, offsets: np.ndarray, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left, token, right, first): classes of each word and of its neighbours."""
    bucket, starts, ends, first = word_buckets(data, offsets)
    token = class_of[bucket]
    rare = np.flatnonzero(token == 0)
    token[rare] = 1 + FREQUENT + shapes(data, starts[rare], ends[rare])
    left, right = np.zeros_like(token), np.zeros_like(token)
    left[1:], right[:-1] = token[:-1], token[1:]
    some = np.flatnonzero(np.diff(first) > 0)
    left[first[some]] = 0
    right[first[some + 1] - 1] = 0
    return left, token, right, first


def counted(docs: DataFrame, size: int, cells) -> DataFrame:
    """(cell, n) summed over all documents; ``cells``: (bytes, offsets) -> cell of each word, below ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, raw, at in blocks(*column_bytes(batch.column("text"))):
                found, n = np.unique(cells(raw, at), return_counts=True)
                total[found] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    return docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def train(counts: np.ndarray, *, hidden: int = 32, rounds: int = 120, rate: float = 0.05, seed: int = 5) -> np.ndarray:
    """log P(token | left, right) as a table, from the counts [left, token, right]."""
    v = counts.shape[0]
    by_context = counts.transpose(0, 2, 1).reshape(v * v, v)
    some = np.flatnonzero(by_context.sum(1) > 0)
    c = by_context[some].astype(np.float32)
    total = max(1.0, float(c.sum()))
    c /= total
    left, right = some // v, some % v
    rng = np.random.default_rng(seed)
    p = {"l": rng.normal(0, 0.3, (v, hidden)), "r": rng.normal(0, 0.3, (v, hidden)), "b": np.zeros(hidden),
         "w": rng.normal(0, 0.1, (hidden, v)), "c": np.log(counts.sum((0, 2)) / total + 1e-6)}
    p = {k: x.astype(np.float32) for k, x in p.items()}
    m, s = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def forward(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(p["l"][left] + p["r"][right] + p["b"])
        z = h @ p["w"] + p["c"]
        z -= z.max(1, keepdims=True)
        return h, z - np.log(np.exp(z).sum(1, keepdims=True))

    weight = c.sum(1, keepdims=True)
    for t in range(1, rounds + 1):
        h, log_p = forward(left, right)
        dz = np.exp(log_p) * weight - c
        dh = (dz @ p["w"].T) * (1 - h * h)
        g = {"w": h.T @ dz, "c": dz.sum(0), "b": dh.sum(0), "l": np.zeros_like(p["l"]), "r": np.zeros_like(p["r"])}
        np.add.at(g["l"], left, dh)
        np.add.at(g["r"], right, dh)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
            p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)
    every = np.arange(v * v)
    return forward(every // v, every % v)[1].astype(np.float32)


def vocabulary(docs: DataFrame) -> np.ndarray:
    """Class of each bucket: 1.. for the most frequent ones, 0 for the others."""
    top = counted(docs, BUCKETS, lambda raw, at: word_buckets(raw, at)[0]).orderBy(F.desc("n"), "cell").limit(FREQUENT).collect()
    class_of = np.zeros(BUCKETS, np.int64)
    for i, r in enumerate(top):
        class_of[r.cell] = i + 1
    return class_of


def triples(docs: DataFrame, class_of: np.ndarray) -> np.ndarray:
    """Counts [left, token, right] over all documents."""

    def cells(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        left, token, right, _ = token_classes(raw, at, class_of)
        return (left * VOCABULARY + token) * VOCABULARY + right

    rows = counted(docs, VOCABULARY ** 3, cells).toArrow()
    out = np.zeros(VOCABULARY ** 3, np.int64)
    out[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(VOCABULARY, VOCABULARY, VOCABULARY)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) of every row of ``docs`` (doc_id, text)."""
    ship_by_value()
    class_of = vocabulary(docs)
    model = docs.sparkSession.sparkContext.broadcast((class_of, train(triples(docs, class_of))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, log_p = model.value
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for start, raw, at in blocks(data, offsets):
                left, token, right, first = token_classes(raw, at, classes)
                some = np.flatnonzero(np.diff(first) > 0)
                if len(some):
                    total[start + some] = np.add.reduceat(log_p[left * VOCABULARY + right, token], first[some], dtype=np.float64)
                n[start: start + len(at) - 1] = np.diff(first)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(total), mean],
                                             names=["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, log_prob double, mean_log_prob double")
