"""Word-level pseudo-likelihood against a plain version: real words are predicted, also rare ones."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from llm import brute
from llm.test_operators import EDGE, frame
from vigil.llm import scratch, textops, word_lm
from vigil.llm.queries import QUERIES

r = random.Random(11)
CHAIN = [f"w{i:03d}" for i in range(300)]


def corpus():
    """Runs of a chain of 300 words, one text of words of the same shape that stand nowhere else, and edges."""
    runs = [(1000 + i, " ".join(CHAIN[a: a + 40])) for i, a in enumerate(r.randint(0, 260) for _ in range(900))]
    return runs + [(1, "x" + " x".join(f"{i}" for i in range(500, 540))), (2, " ".join(CHAIN[100:140])), (3, " ".join(r.sample(CHAIN, 40)))]


def test_words_are_told_apart(spark, workdir):
    """Words of equal shape: a text of unknown ones, or in no order, is less likely than one as in the corpus."""
    frame(spark, corpus()).write.parquet(f"{workdir}/documents.parquet")
    got = {x.doc_id: x.mean_log_prob for x in QUERIES["op8_lm_scoring"](spark, str(workdir)).collect()}
    assert got[2] > got[3] + 0.5 and got[2] > got[1] + 3


def test_scores(spark):
    docs = [*EDGE, (80, "Mixed 12 w1, THE"), *corpus()]
    df = frame(spark, docs)
    scratch.ship_by_value()
    counts = word_lm.word_counts(df)
    texts = [[w.translate(brute.LOWER) for w in brute.WORDS.findall(t or "")] for _, t in docs]
    n = Counter(w for t in texts for w in t)
    assert sorted(x.n for x in counts.collect()) == sorted(n.values())
    network = word_lm.trained(df, word_lm.network_of(counts))
    assert len(network.word) == sum(x >= word_lm.MIN_COUNT for x in n.values()) > 128
    every = np.arange(network.size)
    p = np.exp(network.log_p(np.full_like(every, 40), every, np.full_like(every, 77)).astype(np.float64))
    assert abs(p.sum() - 1) < 1e-4

    known = list(n)
    h, shape, _ = word_lm.words(*textops.column_bytes(pa.array(known)))
    leaf = dict(zip(known, network.leaves(h, shape).tolist(), strict=True))
    of_leaf = Counter()
    for w in known:
        of_leaf[leaf[w]] += n[w]
    want = []
    for (doc, _), t in zip(docs, texts, strict=True):
        x = [0, *(leaf[w] for w in t), 0]
        at = [np.array(v, np.int64) for v in (x[:-2], x[1:-1], x[2:])]
        total = float(network.log_p(*at).sum(dtype=np.float64)) + sum(math.log(n[w] / of_leaf[leaf[w]]) for w in t)
        want.append((doc, len(t), total, None if not t else total / len(t)))
    got = sorted(map(tuple, word_lm.score(df).collect()), key=repr)
    assert len(got) == len(want)
    for g, e in zip(sorted(got, key=lambda x: (repr(x[:2]), x[2])), sorted(want, key=lambda x: (repr(x[:2]), x[2])), strict=True):
        assert g[:2] == e[:2] and abs(g[2] - e[2]) <= 0.02 + 1e-3 * abs(e[2]) and (g[3] is None) == (e[3] is None)
    assert word_lm.score(df.limit(0)).count() == 0


def small_network(words=700):
    g = np.random.default_rng(3)
    word = g.choice(1 << 40, words, replace=False).astype(np.int64)
    word[1:60] = word[0] + (np.arange(1, 60) << 45)  # these want one slot
    n = np.sort(g.zipf(1.3, words).clip(1, 10**6) * 64)[::-1].astype(np.int64)
    shapes = np.where(np.arange(word_lm.SHAPES) % 3 == 0, 0, g.integers(0, 5000, word_lm.SHAPES))
    return word_lm.Network(word, n, shapes), word, n, shapes


def paths(network):
    """For each leaf, (node, bit) on the way to it."""
    order = np.argsort(network.code)
    out = [[] for _ in range(network.size)]
    for d in range(network.depth):
        k, node, bit = network.level(network.code[order], d)
        for leaf, x, b in zip(order[k:].tolist(), node.tolist(), bit.tolist(), strict=True):
            out[leaf].append((x, int(b)))
    return out


def test_frequent_words_cost_fewer_nodes():
    network, word, n, shapes = small_network()
    way = paths(network)
    assert sum(2.0 ** -len(x) for x in way) == 1 and len({tuple(x) for x in way}) == network.size
    assert {x for w in way for x, _ in w} == set(range(network.size - 1))
    p = np.concatenate([[0], shapes, n]) / (shapes.sum() + n.sum())
    mean, bits = sum(p * [len(x) for x in way]), -sum(x * math.log2(x) for x in p if x)
    assert bits <= mean <= bits + 1 < math.log2(network.size) - 1
    shape = np.full(len(word) + 2, 7)
    assert network.leaves(np.append(word, [5, word[0] + (99 << 45)]), shape).tolist() == [*range(1 + word_lm.SHAPES, network.size), 8, 8]


def test_step_by_definition():
    network, _, n, _ = small_network()
    g = np.random.default_rng(4)
    network.rows += g.normal(0, 0.1, network.rows.shape).astype(np.float32)
    network.rows[: 2 * network.size, word_lm.HIDDEN] = 0
    left, token, right = g.choice(np.arange(1 + word_lm.SHAPES, network.size), (3, 3000), p=n / n.sum())
    left[:20], right[::9], token[:40] = 0, 0, np.arange(40)
    way, rows = paths(network), network.rows.astype(np.float64)
    gradient, seen, log_p = np.zeros_like(rows), np.zeros(len(rows), int), []
    for a, t, b in zip(left.tolist(), token.tolist(), right.tolist(), strict=True):
        h = np.append(np.tanh(rows[a] + rows[network.size + b])[:-1], 1)
        back, total = np.zeros(len(h)), 0.0
        for node, bit in way[t]:
            i = 2 * network.size + node
            p = 1 / (1 + math.exp(-(h @ rows[i])))
            back += (p - bit) * rows[i]
            gradient[i] += (p - bit) * h
            seen[i] += 1
            total += math.log(p if bit else 1 - p)
        for i in (a, network.size + b):
            gradient[i, :-1] += (back * (1 - h * h))[:-1]
            seen[i] += 1
        log_p.append(total)
    assert np.allclose(network.log_p(left, token, right), log_p, rtol=1e-4, atol=1e-4)
    assert np.array_equal(network.touched(*(np.bincount(x, minlength=network.size) for x in (left, token, right))), seen)
    squares = np.full(len(rows), 1e-2, np.float32)
    width = np.where(np.arange(len(rows)) < 2 * network.size, word_lm.HIDDEN, word_lm.HIDDEN + 1)
    want = 1e-2 + (gradient ** 2).sum(1) / width
    network.step(left, token, right, squares, 0.15)
    assert np.allclose(squares, want, rtol=1e-3)
    assert np.allclose(network.rows, rows - 0.15 * gradient / np.sqrt(want)[:, None], atol=2e-4)
