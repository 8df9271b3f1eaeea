"""Exact de-duplication by an exchange of Golomb-coded fingerprints.

1. Senders: each task reads its rows' SHA-256 digests (hashed by Spark, the texts stay where they are) and cuts
   them to fingerprints of log2(rows) + ``SPARE_BITS`` bits. Every ``SENDER_ROWS`` rows are one sender: its distinct
   fingerprints, sorted, go to owners by their leading bits, each list as Golomb-coded gaps (divisor a power of two).
2. Owners: one for each range of fingerprints, their number growing with the square root of the table. An
   owner decodes its lists, finds the fingerprints that stand in two lists or more and answers each list with a bitmap.
   A fingerprint that a sender holds many times is sent once, so a text that is a third of all rows costs an
   owner one number from each sender.
3. Suspects: rows whose bit is set, or whose fingerprint the sender itself holds twice. The table is read again, and
   only the suspects' texts leave their tasks: they are found by (file, row number) in bitmaps of 64 rows, sent out in
   passes over disjoint sets of files so that no pass's bitmaps pass ``PASS_WORDS``. Texts of one digest are compared byte by
   byte, least against greatest (map-side first); two texts of one digest would stop the job with an error.

Rows that are no suspects never leave their task except for a digest and numbers.

Defined results: a null text counts as empty, and all empty texts are equal; rows repeated with the same doc_id
are separate members and count in group_size. Of the rows with the largest doc_id one stays (a null doc_id is
the smallest, so a group of nulls keeps one row with keep_id null). Very long texts are hashed and compared whole.
An empty table gives no rows. Other columns play no part and may have any name. A frame that isn't read straight from
Parquet files is written to the shared folder first, as its rows need a stable address.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import broadcast_if_small, scratch_path, ship_by_value, stored

SPARE_BITS, SENDER_ROWS, PASS_WORDS = 10, 1 << 19, 1_000_000


def golomb_encode(values: np.ndarray, span: float) -> tuple[int, bytes, bytes]:
    """(k, unary part, low bits) of the gaps of sorted distinct ``values`` from a range of ``span`` numbers.

    The divisor 2**k is the one nearest below ln 2 times the mean gap.
    """
    gaps = np.diff(values, prepend=np.int64(-1)) - 1
    k = max(0, int(np.floor(np.log2(max(1.0, 0.69 * span / max(1, len(values)))))))
    high = gaps >> k
    unary = np.zeros(int(high.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(high + 1) - 1] = 1
    low = (gaps[:, None] >> np.arange(k)) & 1
    return k, np.packbits(unary).tobytes(), np.packbits(low.astype(np.uint8).ravel()).tobytes()


def golomb_decode(n: int, k: int, unary: bytes, low: bytes) -> np.ndarray:
    """The ``n`` values that ``golomb_encode`` was given."""
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = (np.diff(ones, prepend=-1) - 1).astype(np.int64) << k
    if k:
        bits = np.unpackbits(np.frombuffer(low, np.uint8))[: n * k].reshape(n, k).astype(np.int64)
        gaps += bits @ (np.int64(1) << np.arange(k, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1


def _bitmap(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, the first bit lowest."""
    raw = np.packbits(bits, bitorder="little")
    return np.concatenate([raw, np.zeros(-len(raw) % 8, np.uint8)]).view("<i8")


_ROW = "id long, digest binary, file long, word long, bit int, sender long, at int, owner int, place int, again boolean"
_LIST = "n int, k int, unary binary, low binary"


def _senders(bits: int, owner_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("file", pa.int64()), ("word", pa.int64()), ("bit", pa.int32()),
                        ("sender", pa.int64()), ("at", pa.int32()), ("owner", pa.int32()), ("place", pa.int32()), ("again", pa.bool_()),
                        ("n", pa.int32()), ("k", pa.int32()), ("unary", pa.binary()), ("low", pa.binary())])

    def part(columns: dict, length: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type) for f in schema], schema=schema)

    def one(held: list[pa.RecordBatch], sender: int) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        raw = b"".join(d[:8] for d in table.column("digest").to_pylist())
        prints = (np.frombuffer(raw, ">u8") >> np.uint64(64 - bits)).astype(np.int64)
        distinct, which, times = np.unique(prints, return_inverse=True, return_counts=True)
        owners = distinct >> (bits - owner_bits)
        heads = np.flatnonzero(np.diff(owners, prepend=-1))
        place = np.arange(len(distinct)) - np.repeat(heads, np.diff(heads, append=len(distinct)))
        n = table.num_rows
        yield part({c: table.column(c).combine_chunks() for c in ("id", "digest", "file", "word", "bit")} | {
            "sender": np.full(n, sender), "at": np.arange(n), "owner": owners[which], "place": place[which], "again": times[which] > 1}, n)
        span, lists = 1 << (bits - owner_bits), {c: [] for c in ("sender", "owner", "n", "k", "unary", "low")}
        for a, b in zip(heads, [*heads[1:], len(distinct)], strict=True):
            k, unary, low = golomb_encode(distinct[a:b] & (span - 1), span)
            for c, v in zip(lists, (sender, owners[a], b - a, k, unary, low), strict=True):
                lists[c].append(v)
        yield part(lists, len(heads))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = TaskContext.get().partitionId() << 24
        held, rows = [], 0
        for batch in batches:
            held, rows = [*held, batch], rows + batch.num_rows
            if rows >= SENDER_ROWS:
                yield from one(held, sender)
                held, rows, sender = [], 0, sender + 1
        if rows:
            yield from one(held, sender)

    return send


def _answer(table: pa.Table) -> pa.Table:
    """For one owner: a bitmap for each sender's list, set where another list has the fingerprint too."""
    lists = [golomb_decode(*x) for x in zip(*(table.column(c).to_pylist() for c in ("n", "k", "unary", "low")), strict=True)]
    _, which, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared, ends = times[which] > 1, np.cumsum([len(x) for x in lists])
    return pa.table({"sender": table.column("sender"), "owner": table.column("owner"),
                     "bitmap": pa.array([_bitmap(shared[b - len(x): b]) for b, x in zip(ends, lists, strict=True)], pa.list_(pa.int64()))})


def exact_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
                     normalise: Callable[[Column], Column] | None = None, spare_bits: int = SPARE_BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of ``docs``.

    Texts are equal when they are after ``normalise`` (nothing by default). ``spare_bits`` sets how rarely a
    unique text is a false suspect, about 2**-spare_bits; results don't depend on it.
    """
    ship_by_value()
    spark = docs.sparkSession
    try:
        address = docs.metadataColumn("_metadata")
        docs.select(address["file_path"], address["row_index"])
    except AnalysisException:
        docs = stored(docs.select(F.col(f"`{id_column}`").cast("long").alias(id_column), F.col(f"`{text_column}`").alias(text_column)), "texts")
        address = docs.metadataColumn("_metadata")
    text = F.coalesce(docs[f"`{text_column}`"].cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    file, row = F.xxhash64(address["file_path"]), address["row_index"]
    digest = F.unhex(F.sha2(text, 256))
    word = F.xxhash64(address["file_path"], F.floor(row / 64))
    bit = (row % 64).cast("int")

    bits = min(60, max(16, int(docs.count()).bit_length() + spare_bits))
    owner_bits = max(0, (bits - spare_bits) // 2 - 4)  # owners: the square root of the rows, by 16
    sent = stored(docs.select(docs[f"`{id_column}`"].cast("long").alias("id"), digest.alias("digest"), file.alias("file"), word.alias("word"), bit.alias("bit"))
                  .mapInArrow(_senders(bits, owner_bits), f"{_ROW}, {_LIST}"), "fingerprints")
    rows = sent.filter("n is null").select(*(c.split()[0] for c in _ROW.split(", ")))
    answers = sent.filter("n is not null").select("sender", "owner", "n", "k", "unary", "low").groupBy("owner").applyInArrow(
        _answer, "sender long, owner int, bitmap array<long>")
    suspects = stored(rows.join(answers, ["sender", "owner"]).filter("again or bit_get(bitmap[place div 64], place % 64) = 1")
                      .select("id", "digest", "file", "word", "bit", "sender", "at"), "suspects")

    # the suspects' texts, found by their addresses; in passes over sets of files
    words = stored(suspects.groupBy("file", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")), "addresses")
    passes = max(1, -(-words.count() // PASS_WORDS))
    path = scratch_path(spark, "verified")
    for i in range(passes):
        some = words.filter(F.pmod(F.col("file"), F.lit(passes)) == i).select(F.col("word").alias("_word"), "bits")
        near = docs.filter(F.pmod(file, F.lit(passes)) == i).select(word.alias("_word"), bit.alias("_bit"), text.alias("_text"))
        found = near.join(broadcast_if_small(some, PASS_WORDS), "_word").filter("bit_get(bits, _bit) = 1")
        same = found.groupBy(F.unhex(F.sha2("_text", 256)).alias("digest")).agg(F.min("_text").alias("least"), F.max("_text").alias("most"))
        same.select("digest", F.expr("if(least = most, true, raise_error('two texts have one SHA-256'))").alias("same")).write.mode("append").parquet(path)
    verified = spark.read.schema("digest binary, same boolean").parquet(path).distinct()  # a text may have turned up in several passes

    groups = suspects.groupBy("digest").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "sender", "at")).alias("stays"))
    # stored, so that the last join can split the rows of a text that very many have
    groups = stored(groups.join(verified.filter("same"), "digest").select("digest", "group_size", "stays"), "groups")
    own = F.struct("id", "sender", "at")
    out = rows.join(groups, "digest", "left").withColumn("stays", F.coalesce("stays", own))
    return out.select(F.col("id").alias("doc_id"), F.col("stays.id").alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      (F.col("stays") == own).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
