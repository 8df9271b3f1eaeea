"""Exact de-duplication, hard negatives and source divergence against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from llm.test_operators import EDGE, LONG, prose, rows
from vigil.llm import divergence, exact_dedup, hard_negatives

rng = random.Random(11)


# 11
def alike(data, normal=lambda t: t):
    texts = [normal(t or "") for _, t in data]
    out = []
    for i, (doc, _) in enumerate(data):
        group = [data[j][0] for j in range(len(data)) if texts[j] == texts[i]]
        keep = max((g for g in group if g is not None), default=None)
        out.append((doc, keep, len(group), hashlib.sha256(texts[i].encode()).hexdigest()))
    return sorted(out, key=repr)


def checked(out, data, normal=lambda t: t):
    got = out.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == alike(data, normal)
    stays = defaultdict(list)
    for r in got:
        if r.kept:
            assert r.doc_id == r.keep_id
            stays[r.text_sha256].append(r)
    assert all(len(x) == 1 for x in stays.values()) and set(stays) == {r.text_sha256 for r in got}


CLASH = ["id", "digest", "file", "word", "bit", "sender", "at", "owner", "place", "again", "n", "k", "bits", "stays", "_word", "_text", "_metadata", "keep_id"]


@pytest.mark.parametrize("spare", [10, 0])
def test_exact_duplicates(spark, spare):
    data = [*EDGE, *[(100 + i, "same") for i in range(400)], *[(600 + i, f"text {i % 90}") for i in range(300)], (None, "lone"), (None, "nulls"), (None, "nulls")]
    df = spark.createDataFrame(data, "doc_id long, text string").select("*", *(F.lit("own").alias(c) for c in CLASH)).repartition(5)
    checked(exact_dedup.exact_duplicates(df, spare_bits=spare), data)


def test_exact_duplicates_reads_files_in_passes_and_many_senders(spark, workdir, monkeypatch):
    data = [(i, f"text {i % 700}") for i in range(2000)] + [(5000 + i, "hot") for i in range(1000)]
    spark.createDataFrame(data, "doc_id long, text string").repartition(6).write.parquet(f"{workdir}/docs")
    monkeypatch.setattr(exact_dedup, "SENDER_ROWS", 50)
    monkeypatch.setattr(exact_dedup, "PASS_WORDS", 3)
    checked(exact_dedup.exact_duplicates(spark.read.parquet(f"{workdir}/docs")), data)


def test_exact_duplicates_normalised_and_empty(spark):
    data = [(1, "A b"), (2, "a  b "), (3, None), (4, " "), (5, "a c")]
    df = spark.createDataFrame(data, "doc_id int, text string")
    out = exact_dedup.exact_duplicates(df, normalise=lambda c: F.lower(F.trim(F.regexp_replace(c, " +", " "))))
    checked(out, data, lambda t: re.sub(" +", " ", t).strip().lower())
    assert exact_dedup.exact_duplicates(df.limit(0)).collect() == []


def test_two_texts_of_one_digest_stop_the_job(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("00" * 32))
    with pytest.raises(PySparkException, match="one SHA-256"):
        exact_dedup.exact_duplicates(df).collect()


def test_golomb_codes():
    for n, span in ((0, 16), (1, 1), (1, 1 << 40), (5, 5), (300, 1 << 20), (1000, 1 << 50)):
        values = np.sort(np.array(rng.sample(range(span), n), np.int64))
        k, unary, low = exact_dedup.golomb_encode(values, span)
        assert (exact_dedup.golomb_decode(n, k, unary, low) == values).all()
        if n >= 300:  # within two bits of the entropy for each number
            assert 8 * (len(unary) + len(low)) < n * (math.log2(span / n) + 2 + 1.45)


# 12
def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def hard(data, scale, every, positives=5, negatives=3, low=50, high=95):
    whole = [(i, label, [math.floor(float(x) * scale) for x in v]) for i, v, label in data if i is not None and label is not None and usable(v)]
    anchors = {}
    for i, label, v in whole:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, len(v), v)), (label, len(v), v))

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a, b, strict=True)), -(1 << 63)), (1 << 63) - 1)

    out = []
    for a, (label, n, v) in anchors.items():
        met = [(-score(v, w), i, lab == label) for i, lab, w in whole if i != a and len(w) == n]
        for p, i, _ in sorted(x for x in met if x[2])[:positives]:
            inside = sorted((s, j) for s, j, same in met if not same and low * -p <= 100 * -s <= high * -p)
            out += [(a, i, r, j, -p, -s) for r, (s, j) in enumerate(inside[:negatives], 1)]
    return sorted(out, key=repr)


def vectors_frame(spark, data):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    extra = ["row", "v", "dims", "shard", "block", "asks", "scores", "nth", "anchor_id", "ids", "n", "shards"]
    return df.select("*", *(F.lit("own").alias(c) for c in extra)).repartition(4)


def mined(spark, data, scale=16.0, every=5):
    return rows(hard_negatives.mine(vectors_frame(spark, data), F.col("vec_id") % every == 0, F.col("label"), scale=scale))


def test_hard_negatives(spark):
    centres = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(4)]
    data = [(i, [c + rng.gauss(0, 0.7) for c in centres[i % 4 if i % 3 else 0]], i % 4 if i % 3 else 0) for i in range(400)]
    data += [(400, None, 1), (405, [1.0] * 20, None), (None, [1.0] * 20, 1), (410, [float("nan")] * 20, 1), (415, [float("inf")] * 20, 2), (420, [None] * 20, 1)]
    data += [(425, [1.0, 2.0], 1), (430, [2.0, 1.5], 1), (431, [1.0, 1.0], 2), (435, [], 1), (436, [], 1), (437, [], 2), (440, [0.0] * 20, 1)]
    data += [(10, data[10][1], 3), (11, data[10][1], 2), (11, data[10][1], 2), (12, data[10][1], 0)]
    want = hard(data, 16.0, 5)
    assert len(want) > 300 and mined(spark, data) == want


def test_hard_negatives_of_great_numbers_ties_and_none(spark):
    data = [(i, [(1e9 if i % 3 else -1e9) * (1 + i % 7), 1.0 + i], i % 2) for i in range(60)] + [(100 + i, [1e300 * (i % 3), -1e12], i % 2) for i in range(15)]
    assert mined(spark, data) == hard(data, 16.0, 5)
    flat = [(i, [1.0, 1.0 if i % 2 else 0.75], i % 2) for i in range(50)]
    assert mined(spark, flat) == hard(flat, 16.0, 5)
    assert mined(spark, []) == [] and mined(spark, [(5, [1.0], 1)]) == []


def test_scan_prunes_and_stays_exact():
    r = np.random.default_rng(2)
    x = np.floor(r.normal(0, 1, (500, 32)) * np.linspace(30, 1, 32))
    shard = hard_negatives.Columns(np.arange(500), np.zeros(500, np.int64), x)
    held = []

    def keeps(lower, upper):
        held.append(len(lower))
        return upper >= np.partition(lower, -5)[-5]

    found, scores = hard_negatives.scan(shard, x[0], np.arange(500), keeps)
    assert (scores == x[found] @ x[0]).all() and set(np.argsort(-(x @ x[0]))[:5]) <= set(found)
    assert held[0] == 500 and held[-1] < 100


# 13
def diverging(data, min_docs, ranks=50):
    data = [tuple(x or "" for x in r) for r in data]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower)) for _, _, t in data]
    out = []
    for lang in {r[0] for r in data}:
        docs, counts = Counter(), defaultdict(Counter)
        for (la, source, _), w in zip(data, words, strict=True):
            if la == lang:
                docs.update(set(w))
                counts[source].update(w)
        kept = sorted(t for t, n in docs.items() if n >= min_docs)

        def shares(c):
            total = sum(c[t] for t in kept)
            return [1 + 10 ** 9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept]

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in p:
            pair = [(-sum(abs(a - b) for a, b in zip(p[s], p[h], strict=True)), h) for h in p if h != s]
            term = [(b - a, t) for t, a, b in zip(kept, p[s], q, strict=True) if counts[s][t] and a > b]
            for part, some in (("pair", pair), ("term", term)):
                some.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, r) for r, (v, item) in enumerate(some, 1) if part == "pair" or r <= ranks]
    return sorted(out, key=repr)


def divergence_rows():
    data = [(rng.choice(["en", "en", "de", "x\x00y", None]), rng.choice(["a", "a", "b", "c", "d", "é", None]), prose(rng.randrange(0, 40)) + f" only{i % 3}x Ünï") for i in range(250)]
    return data + [("en", "zz", "12 !!"), ("en", "empty", None), ("fr", "a", "rare words"), ("fr", "b", "other"), ("it", "alone", "uno " * 3), ("en", "a", LONG), ("en", "a", LONG)]


def divergence_frame(spark, data):
    extra = ["term", "n", "shard", "run", "key", "item", "value", "number", "z", "p", "kept"]
    return spark.createDataFrame(data, "lang string, source string, text string").select("*", *(F.lit("own").alias(c) for c in extra)).repartition(4)


@pytest.mark.parametrize("small", [False, True])
def test_divergence(spark, monkeypatch, small):
    if small:  # many runs of few postings, merges on several levels, tiles of two sources, slices of few rows
        for name, value in (("BLOCK_POSTINGS", 20), ("FAN_IN", 3), ("SHARD_BYTES", 1 << 14), ("CHUNK", 3), ("TILE", 2), ("SLICE_ROWS", 10)):
            monkeypatch.setattr(divergence, name, value)
    data = divergence_rows()
    got = rows(divergence.divergence(divergence_frame(spark, data), min_docs=3, term_ranks=4))
    assert got == diverging(data, 3, 4)


def test_divergence_empty_and_without_words(spark):
    assert rows(divergence.divergence(divergence_frame(spark, []), min_docs=1)) == []
    data = [("en", "a", "1 2"), ("en", "b", None), (None, None, "")]
    assert rows(divergence.divergence(divergence_frame(spark, data), min_docs=1)) == diverging(data, 1)
