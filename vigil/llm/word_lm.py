"""Masked pseudo-likelihood of documents, word by word.

Every white-space word of a text (lower case) is predicted from the word on its left
and the one on its right by a network: a hidden layer tanh(L[left] + R[right]) and a
binary tree of logistic nodes over the vocabulary, so that probabilities sum to one.
It is a Huffman tree over the corpus' counts: a word costs as many nodes as its code
has bits, and frequent words cost few. The vocabulary is all words that stand
``MIN_COUNT`` times or more in the corpus, and grows with it. A rarer word stands in
the tree by its shape (length, digits, signs; ``SHAPES`` leaves); its probability is that of its shape
times its share of the shape's rare words. A score is the sum of log P(word | both
sides), natural logarithm; id 0 stands before and after a text.

Word counts are a distributed table. Texts are read twice, to count and to be stored as leaves,
which training and scoring read. The network begins as the corpus' word
frequencies and is trained on every word of every document: in each round each partition takes
minibatch steps over its documents, and the changes of a parameter row are averaged by
the words that touched it. The rare words of the documents meet their
counts in a join, whose keys have fewer than ``MIN_COUNT`` rows each. What must fit in a worker's memory is
the network: 12 * (``HIDDEN`` + 1) bytes for each leaf, twice in training, and up to 48 beside them for codes and the vocabulary.

Defined results: null and empty texts have n_tokens 0, log_prob 0 and a null
mean; repeated rows count and are scored each; an empty table gives no rows;
other columns play no part.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import ship_by_value, stored
from vigil.llm.textops import NOT_ALNUM, WHITE_SPACE, blocks, byte_values, column_bytes, span_hasher, word_spans

MIN_COUNT, SHAPES, HIDDEN = 64, 32, 16
BATCH = 8192
_ONES = np.ones(HIDDEN + 1, np.float32)
TOP = 5  # levels whose nodes meet all words of a batch in one matrix product

_codes = np.arange(256)
_DIGIT = (_codes >= 48) & (_codes <= 57)
_SIGN = NOT_ALNUM & ~_DIGIT
_KINDS = _DIGIT * (1 << 40) + _SIGN  # sums of digits and of signs in one number
_LENGTH = np.searchsorted(np.array([2, 3, 4, 6, 8, 10, 13]), np.arange(15))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, shape, first): of each word in lower case, and for each row the index of its first word."""
    starts, ends, first = word_spans(data, offsets, WHITE_SPACE)
    h = span_hasher(byte_values(data, lower=True), "byte")(starts, ends).view(np.int64)
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_KINDS.take(data), out=total[1:])
    kinds = total.take(ends) - total.take(starts)
    shape = _LENGTH.take(ends - starts, mode="clip") * 4 + ((kinds >> 40 > 0) * 2 + (kinds & ((1 << 40) - 1) > 0))
    return h, shape, first


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, shape, n) of all words of ``docs``; a word is its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, raw, at in blocks(*column_bytes(batch.column("text")), 8 << 20):
                h, shape = (np.concatenate(x) for x in zip(*(words(*block)[:2] for _, *block in blocks(raw, at)), strict=True))
                order = np.argsort(h)
                starts, n = runs(h[order])
                where = order[starts]
                yield pa.RecordBatch.from_arrays([pa.array(h[where]), pa.array(shape[where]), pa.array(n)], names=["word", "shape", "n"])

    found = docs.select("text").mapInArrow(run, "word long, shape long, n long")
    return found.groupBy("word").agg(F.min("shape").alias("shape"), F.sum("n").alias("n"))


def code_lengths(mass: np.ndarray) -> np.ndarray:
    """Depth of each leaf in a Huffman tree over ``mass`` (descending): the two lightest of leaves and nodes go together."""
    n, mass = len(mass), np.maximum(mass, mass.sum() * 2.0 ** -32)  # so no code is long
    weight, up = array("d", mass[::-1].tobytes()), array("q", bytes(8 * (2 * n - 1)))
    leaf, node = 0, n
    for new in range(n, 2 * n - 1):
        total = 0.0
        for _ in range(2):
            if leaf < n and (node >= new or weight[leaf] <= weight[node]):
                total, up[leaf], leaf = total + weight[leaf], new, leaf + 1
            else:
                total, up[node], node = total + weight[node], new, node + 1
        weight.append(total)
    depth = array("q", bytes(8 * (2 * n - 1)))
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[up[i]] + 1
    return np.array(depth[:n])[::-1]


class Network:
    """Vocabulary and parameters. Row i of ``rows`` is L of leaf i, size + i is R, 2 * size + i is node i of the tree (its bias last).

    Codes are canonical: they rise with the leaves' order by mass and with their lengths, and a level's nodes are its last ones.
    So among tokens in order of their codes those of a level's node stand together, and those that end above it stand before the others.
    """

    def __init__(self, word: np.ndarray, n: np.ndarray, n_shape: np.ndarray, seed: int = 5) -> None:
        """``word``, ``n``: the vocabulary by descending count; ``n_shape``: rare words of each shape."""
        self.word = word
        self.size = 1 + SHAPES + len(word)
        self.slots = np.zeros(1 << max(10, (4 * len(word)).bit_length()), np.int32)  # leaves by hash, with open addressing; 0: none
        at, todo = word & (len(self.slots) - 1), np.arange(len(word))
        while len(todo):
            free = todo[self.slots[at[todo]] == 0]
            self.slots[at[free]] = free + 1 + SHAPES
            todo = todo[self.slots[at[todo]] != todo + 1 + SHAPES]
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
        mass = np.concatenate([[0.0], n_shape, n])
        order = np.argsort(-mass, kind="stable")
        length = np.sort(code_lengths(mass[order]))
        self.depth = int(length[-1])
        step = 1 << (self.depth - length)
        code = np.cumsum(step) - step  # the first bit is the highest of ``depth`` bits
        self.code = np.empty(self.size, np.int64)
        self.code[order] = code
        self.inner = [int(code[np.searchsorted(length, d, side="right")]) for d in range(self.depth)]  # a level's first code that goes on
        first = [x >> (self.depth - d) for d, x in enumerate(self.inner)]
        total = np.cumsum([0] + [(1 << d) - x for d, x in enumerate(first)])  # nodes above each level
        self.node = [int(n) - x for n, x in zip(total, first)]  # plus a code's first d bits: index of its node
        self.rows = np.zeros((3 * self.size - 1, HIDDEN + 1), np.float32)
        self.rows[: 2 * self.size, :HIDDEN] = np.random.default_rng(seed).normal(0, 0.3, (2 * self.size, HIDDEN))
        self.rows[2 * self.size:, HIDDEN] = np.concatenate([np.log((end - middle + 1e-3) / (middle - least + 1e-3)) for least, middle, end in self.below(mass)])
        self.top = min(TOP, self.depth)
        self.n_top = int(total[self.top])

    def below(self, mass: np.ndarray) -> Iterator[list[np.ndarray]]:
        """For each level: the mass of the leaves before each of its nodes, before the middle of the node, and up to its end."""
        order = np.argsort(self.code)
        code, total = self.code[order], np.append(0, np.cumsum(mass[order]))
        for d in range(self.depth):
            node = np.arange(self.inner[d] >> (self.depth - d), 1 << d)
            yield [total[np.searchsorted(code, (2 * node + i) << (self.depth - d - 1))] for i in range(3)]

    def leaves(self, h: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """Leaf of each word: its own, or its shape's."""
        out, at = shape + 1, h & (len(self.slots) - 1)
        if not len(self.word):
            return out
        leaf = self.slots.take(at)
        own = self.word.take(leaf - (1 + SHAPES), mode="clip") == h
        np.copyto(out, leaf, where=own & (leaf > 0))
        rest = np.flatnonzero(~own & (leaf > 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(self.slots) - 1)
            leaf = self.slots.take(at[rest])
            own = (self.word.take(leaf - (1 + SHAPES), mode="clip") == h[rest]) & (leaf > 0)
            out[rest[own]] = leaf[own]
            rest = rest[~own & (leaf > 0)]
        return out

    def hidden(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """With a last column of ones, for the bias."""
        h = self.rows.take(left, axis=0)
        h += self.rows.take(self.size + right, axis=0)
        np.tanh(h, out=h)
        h[:, HIDDEN] = 1
        return h

    def level(self, code: np.ndarray, d: int) -> tuple[int, np.ndarray, np.ndarray]:
        """(k, node, bit): of ``code`` in order, those from the k-th on have a node on level ``d``: which one, and where they go on from it."""
        k = int(np.searchsorted(code, self.inner[d]))
        bits = code[k:] >> (self.depth - d - 1)
        return k, (bits >> 1) + self.node[d], (bits & 1).astype(np.float32)

    def log_p(self, left: np.ndarray, token: np.ndarray, right: np.ndarray) -> np.ndarray:
        """log P(token | left, right)."""
        out = np.empty(len(token), np.float32)
        nodes = self.rows[2 * self.size:]
        for i in range(0, len(token), BATCH):
            code = self.code[token[i: i + BATCH]]
            order = np.argsort(code)
            code, h = code[order], self.hidden(left[i: i + BATCH][order], right[i: i + BATCH][order])
            top = h @ nodes[: self.n_top].T
            total, product = np.zeros(len(code), np.float32), np.ones(len(code), np.float32)  # of max(z, 0), and of 1 + exp(-|z|)
            for d in range(self.depth):
                k, node, bit = self.level(code, d)
                if k == len(code):
                    break
                if d < self.top:
                    z = top.take(np.arange(k, len(code)) * self.n_top + node)
                else:
                    w = nodes.take(node, axis=0)
                    w *= h[k:]
                    z = w @ _ONES
                z -= 2 * bit * z
                total[k:] += np.maximum(z, 0)
                np.abs(z, out=z)
                np.negative(z, out=z)
                np.exp(z, out=z)
                z += 1
                product[k:] *= z
            out[i + order] = -(total + np.log(product))
        return out

    def touched(self, n_left: np.ndarray, n_token: np.ndarray, n_right: np.ndarray) -> np.ndarray:
        """Words that touch each row; given are the words with each leaf as left, token, right."""
        return np.concatenate([n_left, n_right, *(least[2] - least[0] for least in self.below(n_token))])

    def step(self, left: np.ndarray, token: np.ndarray, right: np.ndarray, squares: np.ndarray, rate: float) -> None:
        """One minibatch step in place; ``squares``: AdaGrad's sums by row."""

        def follow(some: np.ndarray, g: np.ndarray, width: int) -> None:
            now = squares.take(some) + (g * g) @ _ONES / np.float32(width)
            squares[some] = now
            g *= (np.float32(-rate) / np.sqrt(now))[:, None]
            g += self.rows.take(some, axis=0)
            self.rows[some] = g

        def change(rows: np.ndarray, gradient: np.ndarray, width: int = HIDDEN + 1) -> None:
            """Add up the gradients of equal neighbours in ``rows`` and follow them."""
            starts, times = runs(rows)
            sums, order = run_sums(gradient, starts, times)
            follow(rows[starts[order]], sums, width)

        code = self.code.take(token)
        order = np.argsort(code)
        code, left, right = code[order], left[order], right[order]
        h = self.hidden(left, right)
        w = self.rows[2 * self.size: 2 * self.size + self.n_top].copy()
        z = h @ w.T
        e = np.zeros_like(z)
        for d in range(self.top):
            k, node, bit = self.level(code, d)
            at = np.arange(k, len(code)) * self.n_top + node
            e.put(at, error(z.take(at), bit))
        back = e @ w
        follow(2 * self.size + np.arange(self.n_top), e.T @ h, HIDDEN + 1)  # those without a word have gradient 0
        nodes, gradient, m = np.empty(2 * len(code), np.int64), np.empty((2 * len(code), HIDDEN + 1), np.float32), 0
        for d in range(self.top, self.depth):
            k, node, bit = self.level(code, d)
            if k == len(code):
                break
            if m + len(node) > len(nodes):
                change(nodes[:m], gradient[:m])
                m = 0
            node += 2 * self.size
            w, g = self.rows.take(node, axis=0), gradient[m: m + len(node)]
            e = np.repeat(error(np.multiply(h[k:], w, out=g) @ _ONES, bit), HIDDEN + 1).reshape(w.shape)
            np.multiply(h[k:], e, out=g)
            w *= e
            back[k:] += w
            nodes[m: m + len(node)] = node
            m += len(node)
        if m:
            change(nodes[:m], gradient[:m])
        h *= h
        np.subtract(1, h, out=h)  # 0 in the last column, as L and R have no bias
        back *= h
        for rows in (left, self.size + right):
            order = np.argsort(rows)
            change(rows[order], back.take(order, axis=0), HIDDEN)


def error(z: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Probability of going right, less ``bit``; in place of ``z``."""
    z *= np.float32(0.5)
    np.tanh(z, out=z)
    z *= np.float32(0.5)
    z += np.float32(0.5)
    z -= bit
    return z


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return starts, np.diff(starts, append=len(x))


def run_sums(x: np.ndarray, starts: np.ndarray, times: np.ndarray, short: int = 8) -> tuple[np.ndarray, np.ndarray | slice]:
    """Sums of runs of rows of ``x``, and the order of the runs in it. ``reduceat`` costs most for each run and column, so many short runs are added by place."""
    if len(starts) * 16 < len(x):
        return np.add.reduceat(x, starts, axis=0), slice(None)
    kind = short + 1 - np.minimum(times, short + 1)
    order = np.argsort(kind.astype(np.int8), kind="stable")  # long runs first, then short ones by falling length
    more = np.cumsum(np.bincount(kind, minlength=short + 1))[short::-1]  # by j: runs of over j rows
    starts, long = starts[order], more[short]
    out = x.take(starts, axis=0)
    for j in range(1, short):
        out[long: more[j]] += x.take(starts[long: more[j]] + j, axis=0)
    if long:
        whole, each = x.take(np.flatnonzero(np.repeat(kind == 0, times)), axis=0), times[order[:long]]
        out[:long] = np.add.reduceat(whole, np.cumsum(each) - each, axis=0)
    return out, order


def encoded(docs: DataFrame, network: Network) -> DataFrame:
    """A stored table (row, doc_id, leaves, rare) of ``docs``: the words' leaves as 32-bit numbers, and the hashes of the rare ones."""
    shipped = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at_row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, raw, at in blocks(*column_bytes(batch.column("text"))):
                h, shape, first = words(raw, at)
                token, m = shipped.value.leaves(h, shape), len(at) - 1
                rare = token <= SHAPES
                ends = np.concatenate([[0], np.cumsum(rare)])[first].astype(np.int32)
                leaves = pa.LargeBinaryArray.from_buffers(pa.large_binary(), m, [None, pa.py_buffer(first * 4), pa.py_buffer(token.astype(np.int32))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(at_row, at_row + m)), batch.column("doc_id").slice(start, m), leaves.cast(pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(h[rare]))],
                    names=["row", "doc_id", "leaves", "rare"])
                at_row += m

    schema = "row long, doc_id long, leaves binary, rare array<long>"
    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema), "leaves")


def contexts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, left, token, right, first) of blocks of rows of leaves: each word and its neighbours, and for each row the index of its first word."""
    for start, raw, at in blocks(*column_bytes(column)):
        token, first = raw.view(np.int32).astype(np.int64), at >> 2
        left, right = np.zeros_like(token), np.zeros_like(token)
        left[1:], right[:-1] = token[:-1], token[1:]
        some = np.flatnonzero(np.diff(first) > 0)
        left[first[some]] = 0
        right[first[some + 1] - 1] = 0
        yield start, left, token, right, first


def trained(docs: DataFrame, network: Network, *, rounds: int = 2, rate: float = 0.15) -> Network:
    """``network`` after ``rounds`` passes over all words of ``docs``, a table with texts or one of ``encoded``."""
    sc = docs.sparkSession.sparkContext
    some = (encoded(docs, network) if "text" in docs.columns else docs).select("leaves").coalesce(sc.defaultParallelism)

    for i in range(rounds):
        shipped, slower = sc.broadcast(network), rate / (i + 1)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now = shipped.value
            before = now.rows
            now.rows = before.copy()
            squares, seen = np.full(len(before), 1e-2, np.float32), np.zeros((3, now.size), np.int64)
            try:
                for batch in batches:
                    for _, left, token, right, _ in contexts(batch.column("leaves")):
                        for count, x in zip(seen, (left, token, right)):
                            count += np.bincount(x, minlength=now.size)
                        for k in range(0, len(token), BATCH):
                            now.step(left[k: k + BATCH], token[k: k + BATCH], right[k: k + BATCH], squares, slower)
                n = now.touched(*seen)
                for touched in np.array_split(np.flatnonzero(n), max(1, int((n > 0).sum()) >> 16)):
                    by = (now.rows[touched] - before[touched]).astype(np.float32)
                    yield pa.RecordBatch.from_arrays([pa.array(touched), pa.array(n[touched]), packed(by)], names=["row", "n", "change"])
            finally:
                now.rows = before  # a worker keeps the broadcast for its next task

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Over rows sorted by row; one parameter row may go on into the next batch."""
            row, n, total = -1, 0, np.zeros(HIDDEN + 1)
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                rows, m = batch.column("row").to_numpy(), batch.column("n").to_numpy()
                starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                sums, counts = np.add.reduceat(unpacked(batch.column("change")) * m[:, None], starts, axis=0), np.add.reduceat(m, starts)
                rows = rows[starts]
                if row == rows[0]:
                    sums[0], counts[0] = sums[0] + total, counts[0] + n
                elif row >= 0:
                    rows, sums, counts = np.append(row, rows), np.vstack([total[None], sums]), np.append(n, counts)
                row, n, total = rows[-1], counts[-1], sums[-1]
                if len(rows) > 1:
                    yield pa.RecordBatch.from_arrays([pa.array(rows[:-1]), packed((sums[:-1] / counts[:-1, None]).astype(np.float32))], names=["row", "change"])
            if row >= 0:
                yield pa.RecordBatch.from_arrays([pa.array([row]), packed((total / n)[None].astype(np.float32))], names=["row", "change"])

        changes = some.mapInArrow(learn, "row long, n long, change binary").repartition("row").sortWithinPartitions("row", "n", "change")
        got = changes.mapInArrow(average, "row long, change binary").toArrow()
        if got.num_rows:
            network.rows[got.column("row").to_numpy()] += unpacked(got.column("change").combine_chunks())
        shipped.unpersist()
    return network


def packed(rows: np.ndarray) -> pa.Array:
    """Rows of floats as a binary column."""
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1] * 4
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(rows))])


def unpacked(column: pa.Array) -> np.ndarray:
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    data, _ = column_bytes(column)
    return data.view(np.float32).reshape(-1, HIDDEN + 1)


def network_of(counts: DataFrame) -> Network:
    """The network before training, from a table of ``word_counts``."""
    frequent = counts.filter(F.col("n") >= MIN_COUNT).select("word", "n").toArrow()
    word, n = (frequent.column(x).to_numpy() for x in ("word", "n"))
    order = np.lexsort((word, -n))
    n_shape = np.zeros(SHAPES)
    for r in counts.filter(F.col("n") < MIN_COUNT).groupBy("shape").agg(F.sum("n").alias("n")).collect():
        n_shape[r.shape] = r.n
    return Network(word[order], n[order], n_shape)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) of every row of ``docs`` (doc_id, text)."""
    ship_by_value()
    counts = stored(word_counts(docs), "words")
    network = network_of(counts)
    leaves = encoded(docs, network)
    model = docs.sparkSession.sparkContext.broadcast(trained(leaves, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, left, token, right, first in contexts(batch.column("leaves")):
                m = len(first) - 1
                total = np.zeros(m)
                some = np.flatnonzero(np.diff(first) > 0)
                if len(some):
                    total[some] = np.add.reduceat(model.value.log_p(left, token, right), first[some], dtype=np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, m), batch.column("doc_id").slice(start, m), pa.array(np.diff(first)), pa.array(total)],
                    names=["row", "doc_id", "n_tokens", "log_prob"])

    found = leaves.select("row", "doc_id", "leaves").mapInArrow(run, "row long, doc_id long, n_tokens long, log_prob double")
    few = counts.filter(F.col("n") < MIN_COUNT)
    of_shape = few.groupBy("shape").agg(F.sum("n").alias("n_shape"))
    share = few.join(F.broadcast(of_shape), "shape").select("word", F.log(F.col("n") / F.col("n_shape")).alias("share"))
    shares = leaves.select("row", F.explode("rare").alias("word")).join(share, "word").groupBy("row").agg(F.sum("share").alias("share"))
    total = F.col("log_prob") + F.coalesce(F.col("share"), F.lit(0.0))
    return found.join(shares, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_prob"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob"))
