"""Exact substring deduplication by level-wise doubling of repeated word windows.

A word goes if it stands in a window of ``window`` words whose word sequence also
starts in a document with a smaller doc_id. Levels of lengths window/4, window/2 and
window decide which windows can repeat: at each level a window of full length
is stood for by its anchor, the least hash of its runs of that level's
length (equal windows have equal anchors, and a neighbouring window mostly the same
one). Only windows whose anchor occurs in two documents go on to the level of
twice the length; the work ends where no candidate survives. The last level
compares whole windows.

What passes from level to level is a Bloom filter of the repeated anchors, of
at most ``FILTER_BITS`` bits whatever the corpus. A false hit, or a filled
filter, lets a window through that the last level then tells apart; no window
is lost. Counts are groupBy-min sums, so a passage in a third of all documents
is summed up map-side; the join back is one that Spark can split by skew.

Defined results: null or empty text has no words, nothing removed and the hash
of empty text; a null doc_id removes nothing from others and loses nothing; rows of
one doc_id count as one document; texts under ``window`` words lose nothing;
other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import broadcast_if_small, ship_by_value, stored
from vigil.llm.textops import WHITE_SPACE, blocks, byte_values, column_bytes, ngram_hashes, sliding_min, span_hasher, word_hashes, word_spans

FILTER_BITS = 1 << 28
BITS_PER_HASH = 16


def level_lengths(window: int) -> list[int]:
    return [-(-window // 4), -(-window // 2), window] if window >= 8 else [window]


def hash_filter(hashes: DataFrame, n: int):
    """Broadcast Bloom filter (two probes) of a table of n distinct hashes ``h``."""
    spark = hashes.sparkSession
    bits = 1 << 16
    while bits < min(n * BITS_PER_HASH, FILTER_BITS):
        bits *= 2
    probes = F.explode(F.array(F.col("h").bitwiseAND(bits - 1), F.shiftrightunsigned("h", 32).bitwiseAND(bits - 1)))
    words = hashes.select(probes.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("x"))
    rows = words.toArrow()  # at most bits / 64 rows
    table = np.zeros(bits // 64, np.uint64)
    table[rows.column("w").to_numpy()] = rows.column("x").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(table)


def in_filter(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for p in (h, h >> np.uint64(32)):
        p = p & np.uint64(len(table) * 64 - 1)
        out &= (table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) > 0
    return out


def candidates(words: np.ndarray, first: np.ndarray, window: int, levels: list, filters: list) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of what the next level has to count: the anchors of the windows that passed all filters."""
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    if len(words) < window:
        return np.zeros(0, np.uint64), row[:0]
    alive = np.flatnonzero(row[: len(row) - window + 1] == row[window - 1:])
    for length, table in zip(levels, filters):
        anchor = sliding_min(ngram_hashes(words, length), window - length + 1)
        alive = alive[in_filter(table.value, anchor[alive])]
    length = levels[len(filters)]
    h, r = sliding_min(ngram_hashes(words, length), window - length + 1)[alive], row[alive]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
        h, r = h[new], r[new]
        order = np.lexsort((h, r))
        h, r = h[order], r[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
        h, r = h[new], r[new]
    return h, r


def level_rows(docs: DataFrame, window: int, levels: list, filters: list) -> DataFrame:
    """(h, doc_id) of the candidates of the level after ``filters``, once for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            for start, raw, at in blocks(data, offsets):
                h, r = candidates(*word_hashes(raw, at), window, levels, filters)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[start + r])], names=["h", "doc_id"])

    return docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "h long, doc_id long")


def keep_words(data: np.ndarray, offsets: np.ndarray, window: int, flagged: list) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words, removed words and SHA-256 of the kept text of each row; ``flagged``: a row's window hashes that go, or None."""
    starts, ends, first = word_spans(data, offsets, WHITE_SPACE)
    kept = np.ones(len(starts), bool)
    todo = [i for i, x in enumerate(flagged) if x is not None and first[i + 1] - first[i] >= window]
    if todo:
        words = span_hasher(byte_values(data), "byte")(starts, ends)
        for i in todo:
            bad = np.flatnonzero(np.isin(ngram_hashes(words[first[i]: first[i + 1]], window), flagged[i]))
            cover = np.zeros(first[i + 1] - first[i] + 1, np.int64)
            np.add.at(cover, bad, 1)
            np.add.at(cover, bad + window, -1)
            kept[first[i]: first[i + 1]] = np.cumsum(cover[:-1]) == 0
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    k = np.flatnonzero(kept)
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[k]] += 1
    step[ends[k]] -= 1
    stay = np.cumsum(step[:-1]).astype(bool)
    gap = ends[k[:-1]][row[k[1:]] == row[k[:-1]]]  # the byte after a kept word with another one behind it
    stay[gap] = True
    text = data.copy()
    text[gap] = 0x20
    at = np.concatenate([[0], np.cumsum(stay)])[offsets]
    out = text[stay].tobytes()
    n = np.diff(first)
    return n, n - np.bincount(row[k], minlength=len(n)), [hashlib.sha256(out[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]


def apply_removal(rows: DataFrame, window: int) -> DataFrame:
    """Digest of rows (doc_id, text, flagged)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            lists = batch.column("flagged")
            for start, raw, at in blocks(data, offsets):
                m = len(at) - 1
                flagged = [None] * m
                for i in np.flatnonzero(lists.slice(start, m).is_valid().to_numpy(zero_copy_only=False)):
                    flagged[i] = lists[start + i].values.to_numpy().view(np.uint64)
                n, gone, digest = keep_words(raw, at, window, flagged)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, m), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                                                 names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, flagged): the hashes of each document's windows that also start in a smaller doc_id."""
    levels, filters = level_lengths(window), []
    for _ in levels[:-1]:
        seen = level_rows(docs, window, levels, filters).groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
        repeated = stored(seen.filter("x < y").select("h"), "repeated")
        n = repeated.count()
        if n == 0:
            break
        filters.append(hash_filter(repeated, n))
    if len(filters) < len(levels) - 1:  # nothing survives
        none = docs.limit(0).select("doc_id", F.array(F.lit(0).cast("long")).alias("flagged"))
        return stored(none, "flagged")
    rows = level_rows(docs, window, levels, filters)
    least = rows.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    later = rows.join(least.select("h", "least"), "h").filter("doc_id > least")
    return stored(later.groupBy("doc_id").agg(F.collect_list("h").alias("flagged")), "flagged")


def remove_repeats(docs: DataFrame, *, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs`` (doc_id, text)."""
    ship_by_value()
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    flagged = repeated_windows(docs, window)
    ids = flagged.select("doc_id")
    small = broadcast_if_small(ids)
    if small is ids:
        return apply_removal(docs.join(flagged, "doc_id", "left"), window)
    # few documents lose anything: only their texts are shuffled
    clean = docs.join(small, "doc_id", "left_anti").withColumn("flagged", F.lit(None).cast("array<long>"))
    return apply_removal(clean, window).union(apply_removal(docs.join(small, "doc_id", "left_semi").join(flagged, "doc_id"), window))
