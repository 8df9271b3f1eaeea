"""Benchmark decontamination by winnowed fingerprints, in DataFrame functions only.

A window is ``width`` consecutive words of a benchmark item (an item of fewer words is one
window). Of each run of n words (n: the window's length) winnowing keeps the
least hash of its k-grams, k = (n + 1) div 2; n - k + 1 k-grams lie in a run, so every occurrence
of a window in a document leaves there the fingerprint that it left in the item. The
join of both sides' fingerprints therefore misses no shared window. Hits are then
extended: around each matching k-gram all runs of n words are looked up among the
windows themselves, word by word, so what is reported is exact.

Scale: document fingerprints are distinct within a document and hashes of 64 bit; the
benchmark side is counted and broadcast only up to ``MOST_BROADCAST`` rows, and
shuffled beyond. Windows carry the list of their items once, so a window that many
items and many documents share isn't expanded into their pairs. Only the texts of
documents with a matching fingerprint are looked at again.

Defined results: null or empty texts, and texts without words, have no words and no hits; items
without words match nothing; a null item_id counts as an item, shown as empty text;
repeated items count once; rows of documents are told apart by doc_id and
text, and equal rows each get the same result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import broadcast_if_small, stored

MOST_BROADCAST = 200_000
#: what separates words: all ASCII but 0-9 and (after lower-casing A-Z) a-z
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, SEPARATORS), "")


def _starts(size: Column, n: int) -> Column:
    """1-based starts of the runs of n in an array of this size; empty if there are none."""
    return F.when(size >= n, F.sequence(F.lit(1), size - (n - 1))).otherwise(F.array().cast("array<int>"))


def kgram_hashes(word_hashes: str, k: int) -> Column:
    """Hash of each run of k words, from a column of word hashes."""
    return F.transform(_starts(F.size(word_hashes), k), lambda i: F.xxhash64(F.slice(word_hashes, i, k)))


def fingerprints(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """``rows`` with n and h instead of their column of words w: for each length n the distinct least k-gram hashes of its runs.

    The arrays are columns of their own, step by step: an array built within a
    lambda function would be built again for each element.
    """
    rows = rows.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x))).drop("w")
    rows = rows.withColumns({f"g{n}": kgram_hashes("wh", (n + 1) // 2) for n in lengths}).drop("wh")

    def of(n: int) -> Column:
        size = n - (n + 1) // 2 + 1
        least = F.transform(_starts(F.size(f"g{n}"), size), lambda i: F.array_min(F.slice(f"g{n}", i, size)))
        return F.transform(F.array_distinct(least), lambda x: F.struct(F.lit(n).alias("n"), x.alias("h")))

    rows = rows.withColumn("f", F.explode(F.concat(*(of(n) for n in lengths)))).drop(*(f"g{n}" for n in lengths))
    return rows.withColumns({"n": F.col("f.n"), "h": F.col("f.h")}).drop("f")


def windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(n, window, items): distinct windows as text with the items that hold them."""
    item = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(width))
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))
    return item.select("item", n.alias("n"), F.explode(F.array_distinct(runs)).alias("window")).groupBy("n", "window").agg(F.collect_set("item").alias("items"))


def row_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hashes_of(n: int) -> Column:
    """The matching fingerprints of length n, from the column found."""
    return F.transform(F.filter("found", lambda x: x["n"] == n), lambda x: x["h"])


def runs_around(n: int) -> Column:
    """(n, at, window): the runs of n words that hold a matching k-gram, each once."""
    k = (n + 1) // 2
    at = F.filter(F.transform(f"g{n}", lambda h, i: F.when(F.array_contains(f"found{n}", h), i + 1)), lambda i: i.isNotNull())
    around = F.transform(at, lambda i: F.sequence(F.greatest(i - (n - k), F.lit(1)), F.least(i, F.col("size") - (n - 1))))
    some = (F.col("size") >= n) & (F.size(f"found{n}") > 0)
    starts = F.when(some, F.array_distinct(F.flatten(around))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.lit(n).alias("n"), i.alias("at"), F.array_join(F.slice("w", i, n), " ").alias("window")))


def contamination(docs: DataFrame, benchmark: DataFrame, *, width: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs`` (doc_id, text)."""
    known = stored(windows(benchmark, width), "windows")
    lengths = sorted(r.n for r in known.select("n").distinct().collect())  # at most ``width`` numbers
    docs = docs.select("doc_id", "text", row_key(F.col("text")).alias("key"))
    base = docs.select("doc_id", "key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    nothing = base.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                          F.sha2(F.lit(""), 256).alias("items_sha256"), F.lit(False).alias("contaminated"))
    if not lengths:
        return nothing

    # a window of n words has one fingerprint at its own length
    marks = fingerprints(known.select(F.col("n").alias("own"), F.split("window", " ").alias("w")), lengths)
    marks = stored(marks.filter("n = own").select("n", "h").distinct(), "marks")
    hits = fingerprints(docs.select("doc_id", "key", words(F.col("text")).alias("w")), lengths).join(
        broadcast_if_small(marks, MOST_BROADCAST), ["n", "h"])
    suspects = stored(hits.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("t")).agg(F.collect_set(F.struct("n", "h")).alias("found")), "suspects")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("t"))

    # extend: runs of n words around a matching k-gram
    ids = suspects.select("d", "t")
    small = broadcast_if_small(ids, MOST_BROADCAST)
    texts = docs if small is ids else docs.join(small, same, "left_semi")
    texts = texts.join(suspects, same).select("doc_id", "key", words(F.col("text")).alias("w"), "found").withColumns(
        {"wh": F.transform("w", lambda x: F.xxhash64(x))} | {f"found{n}": _hashes_of(n) for n in lengths})
    texts = texts.withColumns({f"g{n}": kgram_hashes("wh", (n + 1) // 2) for n in lengths}).withColumn("size", F.size("w"))
    runs = F.explode(F.concat(*(runs_around(n) for n in lengths))).alias("r")
    found = (texts.select("doc_id", "key", runs).select("doc_id", "key", "r.*")
             .join(broadcast_if_small(known, MOST_BROADCAST), ["n", "window"])
             .groupBy(F.col("doc_id").alias("d"), F.col("key").alias("t")).agg(F.collect_set(F.struct("n", "at")).alias("runs"), F.collect_set("items").alias("items")))
    covered = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["at"], r["at"] + r["n"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten("items")))
    found = stored(found.select("d", "t", F.size(covered).cast("long").alias("hit"), F.size(items).cast("long").alias("n"),
                                F.sha2(F.array_join(items, ","), 256).alias("sha")), "found")
    out = base.join(broadcast_if_small(found, MOST_BROADCAST), same, "left")
    return out.select("doc_id", "n_words", F.coalesce("hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("hit").isNotNull().alias("contaminated"))
