"""Near-duplicate documents by a multi-index Hamming join over MinHash signatures.

A document's set holds its distinct word shingles. Its signature has ``CHUNKS`` *
4 MinHash symbols of 32 bits. Two signatures that differ in at most 2 * CHUNKS - 1
symbols have, by the pigeonhole principle, a chunk that differs in at most one
symbol. So each chunk is indexed under its four keys with one symbol left out
(the allowed error, enumerated), and every pair within the threshold shares a
key. At a similarity of 0.8 a pair lies beyond the threshold with probability
3e-6, above that less. Candidates are confirmed on the full sets.

Documents of equal sets form a class, of which one representative is indexed.
Within a key, first all are compared with the smallest one (a star). Then each
is compared with the members of other components whose signatures are nearest
to its own. Last, all pairs within the threshold
whose components still differ are compared, so no link between different
classes can be missed, and a large group of near copies costs about its size.
For that step the remaining members get a finer signature, ``FINE`` symbols of 4
bits, and a pair must agree in as many as the similarity asks for, less five
standard deviations, before its sets are fetched. Members of a key meet in
blocks of about ``BLOCK`` rows, never all in one task.

Defined results: null or empty texts and texts without words have an empty set
and link with nothing; texts of fewer words than a shingle are one shingle;
rows with the same doc_id are one node; a null doc_id links with nothing and is
kept; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.components import components
from vigil.llm.scratch import broadcast_if_small, giving_back, ship_by_value, stored
from vigil.llm.textops import WHITE_SPACE, blocks, column_bytes, mix, ngram_hashes, sequence_hash, word_hashes

CHUNKS, CHUNK = 12, 4
SYMBOLS = CHUNKS * CHUNK
MOST_DIFFERENT = 2 * CHUNKS - 1
BLOCK = 1024
SETS_BYTES = 8 << 20
FINE = 1024
_rng = np.random.default_rng(99)
_A = _rng.integers(0, 1 << 63, SYMBOLS + FINE, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, SYMBOLS + FINE, dtype=np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the rows of a block, repeats included, and where each row's begin."""
    words, first = word_hashes(data, offsets, WHITE_SPACE, lower=True)
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    grams = ngram_hashes(words, width)
    whole = row[: len(grams)] == row[width - 1:] if len(grams) else np.zeros(0, bool)
    per_row = np.maximum(counts - width + 1, 0)
    few = (counts > 0) & (counts < width)
    at = np.concatenate([[0], np.cumsum(per_row + few)])
    out = np.zeros(at[-1], np.uint64)
    out[np.repeat(~few, per_row + few)] = grams[whole]
    out[at[:-1][few]] = sequence_hash(words, first)[few]
    return out, at


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def minima(s: np.ndarray, starts: np.ndarray, hashes: range) -> np.ndarray:
    """MinHash symbols [row, hash] of the shingles that begin at ``starts``."""
    out = np.empty((len(starts), len(hashes)), np.uint32)
    for j, k in enumerate(hashes):
        out[:, j] = np.minimum.reduceat(((s * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, sig): set size, 128-bit hash of the set, MinHash symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            rows = batch.num_rows
            n, h1, h2 = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            sig = np.zeros((rows, SYMBOLS), np.uint32)
            for start, raw, off in blocks(data, offsets):
                s, at = shingles(raw, off, width)
                for i in range(len(at) - 1):
                    if at[i + 1] > at[i]:
                        u = np.unique(s[at[i]: at[i + 1]])
                        n[start + i] = len(u)
                        h1[start + i] = mix(u).sum(dtype=np.uint64)
                        h2[start + i] = mix(u ^ np.uint64(0x5555555555555555)).sum(dtype=np.uint64)
                full = np.flatnonzero(np.diff(at) > 0)
                if len(full):
                    sig[start + full] = minima(s, at[full], range(SYMBOLS))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * SYMBOLS), pa.array(sig.ravel().view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(_signed(h1)), pa.array(_signed(h2)), lists],
                                             names=["doc_id", "n_shingles", "h1", "h2", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        giving_back(run), "doc_id long, n_shingles long, h1 long, h2 long, sig array<int>")


def fine_signatures(docs: DataFrame, width: int) -> DataFrame:
    """(rep, fine): the low four bits of FINE further MinHash symbols, two in a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for start, raw, off in blocks(data, offsets):
                s, at = shingles(raw, off, width)
                full = np.flatnonzero(np.diff(at) > 0)
                if len(full):
                    fine = (minima(s, at[full], range(SYMBOLS, SYMBOLS + FINE)) & np.uint32(15)).astype(np.uint8)
                    fine = fine[:, ::2] * np.uint8(16) + fine[:, 1::2]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(start + full)), pa.array([x.tobytes() for x in fine], pa.binary())], names=["rep", "fine"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(run), "rep long, fine binary")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles): the full sets as arrays of 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for start, raw, off in blocks(data, offsets):
                s, at = shingles(raw, off, width)
                sets = [np.unique(s[at[i]: at[i + 1]]) for i in range(len(at) - 1)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                flat = _signed(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(sets)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                                 names=["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(run), "doc_id long, shingles array<long>")


def index_keys(classes: DataFrame) -> DataFrame:
    """(rep, code, key): each chunk with each one of its symbols left out; code tells which."""
    keys = []
    for c in range(CHUNKS):
        symbols = [F.col("sig")[c * CHUNK + i] for i in range(CHUNK)]
        for left_out in range(CHUNK):
            keys.append(F.xxhash64(F.lit(c * CHUNK + left_out), *(s for i, s in enumerate(symbols) if i != left_out)))
    return classes.select("rep", F.posexplode(F.array(*keys)).alias("code", "key"))


def first_code(differ: np.ndarray) -> np.ndarray:
    """The smallest code whose key two signatures share, from rows of differing symbols."""
    by_chunk = differ.reshape(-1, CHUNKS, CHUNK)
    chunk = (by_chunk.sum(2) <= 1).argmax(1)
    return chunk * CHUNK + by_chunk[np.arange(len(chunk)), chunk].argmax(1)


def close_pairs(members: DataFrame, least_equal: int = 0, nearest: int | None = None) -> DataFrame:
    """Pairs (a, b) within the signature threshold whose labels differ, from rows
    (key, i, j, code, rep, label, least, block, sig) sorted by (key, i, j).

    Each pair comes once, from the first key it shares, if ``least_equal`` symbols of
    its fine signatures (column fine) are equal; with ``nearest``, each member's so many
    nearest ones of each of its keys instead. A group (key, i,
    j) has 2 * BLOCK rows or so.
    """

    def pairs(code: int, rep: np.ndarray, label: np.ndarray, least: int, block: np.ndarray, sig: np.ndarray, fine: np.ndarray, i: int, j: int) -> Iterator[np.ndarray]:
        for x in range(len(rep)):
            if rep[x] == least or i != j and not nearest and block[x] != i:
                continue
            ok = (label != label[x]) & (rep != least)  # the star has compared these
            if i != j:
                ok &= block != block[x]
            if not nearest and i == j:
                ok[:x] = False
            rest = np.flatnonzero(ok)
            differ = sig[rest] != sig[x]
            distance = differ.sum(1)
            if nearest:
                rest = rest[np.argsort(distance, kind="stable")[:nearest]]
                rest = rest[(sig[rest] != sig[x]).sum(1) <= MOST_DIFFERENT]
            else:
                within = distance <= MOST_DIFFERENT
                rest, differ = rest[within], differ[within]
                if len(rest):
                    rest = rest[first_code(differ) == code]
                    differ = fine[rest] ^ fine[x]
                    rest = rest[((differ < 16).sum(1) + (differ & 15 == 0).sum(1)) >= least_equal]
            if len(rest):
                other = rep[rest]
                yield np.stack([np.minimum(other, rep[x]), np.maximum(other, rep[x])], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "code", "rep", "label", "least", "block")]
            now.append(batch.column("sig").flatten().to_numpy().reshape(-1, SYMBOLS))
            now.append(np.zeros((batch.num_rows, 0), np.uint8) if nearest else column_bytes(batch.column("fine"))[0].reshape(-1, FINE // 2))
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            key, i, j = held[:3]
            ends = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            yield from emit(held, np.concatenate([[0], ends]))
            held = [x[ends[-1]:] for x in held] if len(ends) else held
        if held is not None:
            yield from emit(held, np.array([0, len(held[0])]))

    def emit(rows: list[np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        for p, q in zip(edges[:-1], edges[1:], strict=True):
            _, i, j, code, rep, label, least, block, sig, fine = (x[p:q] for x in rows)
            found = [*pairs(code[0], rep, label, least[0], block, sig, fine, i[0], j[0])] if (label != label[0]).any() else []
            if found:
                ab = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

    return members.mapInArrow(giving_back(run), "a long, b long")


def mixed_members(buckets: DataFrame, label: DataFrame) -> DataFrame:
    """The members of keys in which the labels (node, component) still differ, with their number of blocks."""
    labelled = buckets.join(label, F.col("rep") == F.col("node"), "left").select(
        "key", "code", "rep", "least", F.coalesce("component", "rep").alias("label"))
    mixed = stored(labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"))
                   .filter("x < y and n > 2").select("key", F.expr(f"int((n + {BLOCK - 1}) div {BLOCK})").alias("parts")), "mixed_keys")
    return stored(labelled.join(broadcast_if_small(mixed), "key"), "members")


def in_blocks(members: DataFrame, signed: DataFrame) -> DataFrame:
    """Rows for close_pairs(), each in every pair of blocks that it belongs to."""
    blocked = (members.withColumn("block", F.expr("int(pmod(xxhash64(rep), parts))"))
               .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
               .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "parts"))
    return blocked.join(signed, "rep").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The stored ``pairs`` (a, b) with 100 * intersection >= percent * union on the full sets.

    The sets are broadcast if they have at most SETS_BYTES together; else pairs
    and sets are shuffled, in joins that nothing but a write follows, so that
    Spark may split a centre of very many pairs.
    """
    needed = stored(pairs.select(F.col("a").alias("doc_id")).distinct().union(pairs.select("b").distinct()).distinct(), "needed")
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(broadcast_if_small(needed), "doc_id", "left_semi")
    sets = stored(shingle_sets(texts, width), "sets")
    size = sets.agg(F.sum(F.size("shingles") * 8 + 32)).first()[0] or 0
    if size <= SETS_BYTES:
        sets = F.broadcast(sets)
    both = (pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
            .join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", (F.size("sa") + F.size("sb")).alias("n"), common.alias("common")).filter(
        F.col("common") * 100 >= (F.col("n") - F.col("common")) * percent).select("a", "b")


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Links are pairs of documents whose sets of ``width``-word shingles have
    100 * intersection >= percent * union; component_id is the smallest doc_id
    reachable by links, kept whether the document has that id.
    """
    ship_by_value()
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = stored(signatures(docs, width), "signatures")
    solid = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(solid.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "classes")
    keys = index_keys(classes)
    shared = stored(keys.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most"), F.count("*").alias("n"))
                    .filter("least < most").drop("most"), "shared_keys")
    buckets = stored(keys.join(broadcast_if_small(shared), "key"), "buckets")

    sig_a = classes.select(F.col("rep").alias("a"), F.col("sig").alias("sa"))
    sig_b = classes.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    star = buckets.filter("rep != least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    differ = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x != y), lambda x: x))
    star = stored(star.join(sig_b, "b").join(sig_a, "a").filter(differ <= MOST_DIFFERENT).select("a", "b").distinct(), "star")
    links = stored(confirmed(star, docs, width, percent), "star_links")

    signed = classes.select("rep", "sig")
    # nodes that a star links have one component at least; enough to leave out pairs of one star
    label = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    label = label.groupBy("node").agg(F.min("component").alias("component"))
    some_keys = buckets.filter(f"code % {2 * CHUNK} = 0")  # enough for the nearest ones; the last step takes all
    near = stored(close_pairs(in_blocks(mixed_members(some_keys, label), signed), nearest=2).distinct(), "near_pairs")
    links = stored(links.union(confirmed(near, docs, width, percent)), "links")
    members = mixed_members(buckets, components(links))
    ids = stored(members.select("rep").distinct(), "mixed_reps")
    few = docs.join(broadcast_if_small(ids), F.col("doc_id") == F.col("rep"), "left_semi")
    fine = fine_signatures(few, width)
    share = percent / 100 + (1 - percent / 100) / 16  # four bits agree by chance once in 16
    least_equal = int(FINE * share - 5 * (FINE * share * (1 - share)) ** 0.5)
    rest = stored(close_pairs(in_blocks(members, signed.join(fine, "rep")), least_equal), "cross_pairs")
    links = links.union(confirmed(rest.distinct(), docs, width, percent))
    # rows of one doc_id with several texts join their classes
    of = solid.join(classes.drop("sig"), ["h1", "h2"]).select("doc_id", "rep")
    least = stored(of.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("doc_id", "a"), "several_texts")
    several = of.join(broadcast_if_small(least), "doc_id").filter("rep != a").select("a", F.col("rep").alias("b")).distinct()
    final = components(links.union(several))

    return (rows.join(classes.drop("sig"), ["h1", "h2"], "left").join(final, F.col("rep") == F.col("node"), "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id"))
                    .otherwise(F.coalesce("component", "rep")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
