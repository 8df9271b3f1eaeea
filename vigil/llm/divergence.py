"""How far sources of a language differ in their words: single-pass in-memory indexing and streamed pair corrections.

1. Index: each task counts words of its texts in memory, a posting (word frequency, documents) for each (lang, word,
   source). When ``BLOCK_POSTINGS`` are held, and at the task's end, the block is sorted by (lang, word), split into hash shards and spilled
   as a run to the shared folder.
2. Merge: each shard's runs are merged by a heap, at most ``FAN_IN`` at a time; while there are more, merged runs are
   written as longer runs first, so a word that every run holds costs each merge ``FAN_IN`` postings a source. The last merge sees a
   word's documents summed up and lets words in fewer than ``min_docs`` documents of the language go.
3. Pairs: the sum over all kept words of abs(p - q) for two sources is written as the value if neither had any word, plus a
   correction for each word of the one (from counts of equal frequencies, no join by word), plus a correction for words
   that both have. The latter are streamed word by word against tiles of ``TILE`` x ``TILE`` sources, so that only one number a
   tile's pair leaves a task; neither pairs by word nor a source's whole vocabulary are put in one row.

There is a shard for every ``SHARD_BYTES`` of text. All arithmetic is in whole numbers.

Defined results: null text, lang and source count as ''. A group whose texts have no words still has its pairs; a language
where no word reaches ``min_docs`` gives pairs of value 0 and no terms; a language with one source has no pairs. Rows
repeated count as often as they stand, doc_id plays no part; ties go by item in UTF-8 order. Very long texts are counted
whole (one text's words are held at once). An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm import textops
from vigil.llm.scratch import broadcast_if_small, ship_by_value, stored

BLOCK_POSTINGS, FAN_IN, SHARD_BYTES, CHUNK = 400_000, 64, 1 << 24, 16_384
TILE, SLICE_ROWS, TERM_RANKS = 256, 200_000, 50
ONE = 1_000_000_000

#: Bytes of words stay (A-Z as a-z), all others become spaces; every byte of a character outside ASCII is one of a word.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: A run's row for one shard: sorted keys (lang, term, source) and, for each, word frequency and documents, as a compressed Arrow stream.
_RUN = pa.schema([("shard", pa.int32()), ("run", pa.int64()), ("postings", pa.binary())])
_RUN_SQL = "shard int, run long, postings binary"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def _escaped(name: bytes) -> bytes:
    """Without zero bytes, so that they can stand between the parts of a key."""
    return name.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")


def _plain(names: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(names, "\x01\x01", "\x00"), "\x01\x02", "\x01")


def _packed(postings: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, postings.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(postings)
    return out.getvalue().to_pybytes()


def _run_rows(postings: pa.Table, run: int) -> pa.RecordBatch:
    """A run's row for each shard, from columns shard, keys, tf, df."""
    postings = postings.sort_by([("shard", "ascending"), ("keys", "ascending")]).combine_chunks()
    shard = postings.column("shard").to_numpy()
    heads = np.flatnonzero(np.diff(shard, prepend=-1))
    rows = [_packed(postings.slice(a, b - a).select(["keys", "tf", "df"])) for a, b in zip(heads, [*heads[1:], len(shard)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(shard[heads], pa.int32()), pa.array([run] * len(heads), pa.int64()), pa.array(rows, pa.binary())], schema=_RUN)


def _block(tf: dict, df: dict, shards: int) -> pa.Table:
    """The postings that a block holds; a shard is given by the hash of (lang, term)."""
    parts = []
    for (lang, source), words in tf.items():
        if words:
            terms = pc.binary_join_element_wise(pa.scalar(_escaped(lang)), pa.array(words, pa.binary()), pa.scalar(b"\x00"))
            data, at = textops.column_bytes(terms)
            hashed = [textops.span_hasher(textops.byte_values(d), "byte")(o[:-1], o[1:]) for _, d, o in textops.blocks(data, at)]
            parts.append(pa.table({
                "shard": pa.array((np.concatenate(hashed) % np.uint64(shards)).astype(np.int32)),
                "keys": pc.binary_join_element_wise(terms, pa.scalar(_escaped(source)), pa.scalar(b"\x00")).cast(pa.string()),
                "tf": np.fromiter(words.values(), np.int64, len(words)),
                "df": np.fromiter(map(df[lang, source].__getitem__, words), np.int64, len(words))}))
    return pa.concat_tables(parts)


def _indexer(shards: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 24
        tf: dict = defaultdict(Counter)
        df: dict = defaultdict(Counter)
        held = 0
        for batch in batches:
            for group, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), batch.column(2), strict=True):
                words = words_of(text.as_py())
                count = tf[group]
                held -= len(count)
                count.update(words)
                df[group].update(set(words))
                held += len(count)
                if held >= BLOCK_POSTINGS:
                    yield _run_rows(_block(tf, df, shards), run)
                    tf.clear()
                    df.clear()
                    held, run = 0, run + 1
        if held:
            yield _run_rows(_block(tf, df, shards), run)

    return index


class _Stream:
    """What is left of a run: its postings from ``at``."""

    def __init__(self, postings: pa.Buffer) -> None:
        rows = pa.ipc.open_stream(postings).read_all()
        self.keys, self.tf, self.df = (rows.column(c).combine_chunks() for c in ("keys", "tf", "df"))
        self.at = 0

    def bound(self) -> str | None:
        """The first key of the word that stands about ``CHUNK`` postings further, and not here; None at the end."""
        step = CHUNK
        while self.at + step < len(self.keys):
            word = self.keys[self.at + step].as_py().rpartition("\x00")[0] + "\x00"
            if not self.keys[self.at].as_py().startswith(word):
                return word
            step *= 2
        return None

    def below(self, bound: str | None) -> pa.Table:
        """The postings of words before ``bound``; they are left behind."""
        a = self.at
        self.at = len(self.keys) if bound is None else bisect_left(range(len(self.keys)), bound.encode(), a, key=lambda i: self.keys[i].as_py().encode())
        return pa.table({"keys": self.keys.slice(a, self.at - a), "tf": self.tf.slice(a, self.at - a), "df": self.df.slice(a, self.at - a)})


def merge(runs: pa.Table) -> Iterator[pa.Table]:
    """(keys, tf, df), equal keys of the runs (a row each) summed up, by a heap over the runs.

    The heap has each run's next bound; the least one is taken, with all runs' postings below it. So
    tables follow each other in the order of keys, hold whole words, and about ``CHUNK`` postings of a run.
    """
    streams = [_Stream(x.as_buffer()) for x in runs.column("postings")]
    heap = [(b.encode(), i) for i, s in enumerate(streams) if (b := s.bound()) is not None]
    heapq.heapify(heap)
    while True:
        bound = heap[0][0].decode() if heap else None
        some = pa.concat_tables([s.below(bound) for s in streams])
        if some.num_rows:
            yield some.group_by("keys").aggregate([("tf", "sum"), ("df", "sum")]).rename_columns(["keys", "tf", "df"])
        if bound is None:
            return
        _, i = heapq.heappop(heap)
        if (more := streams[i].bound()) is not None:
            heapq.heappush(heap, (more.encode(), i))


def _kept(postings: pa.Table, min_docs: int) -> pa.Table:
    """(lang, source, term, n, total) of the words in ``min_docs`` documents of their language or more."""
    parts = pc.split_pattern(postings.column("keys").combine_chunks(), "\x00").flatten()
    at = np.arange(0, len(parts), 3)
    rows = pa.table({"lang": parts.take(pa.array(at)), "term": parts.take(pa.array(at + 1)), "source": parts.take(pa.array(at + 2)), "n": postings.column("tf"), "df": postings.column("df")})
    whole = rows.group_by(["lang", "term"]).aggregate([("n", "sum"), ("df", "sum")])
    whole = whole.filter(pc.greater_equal(whole.column("df_sum"), min_docs)).select(["lang", "term", "n_sum"])
    rows = rows.join(whole, ["lang", "term"], join_type="inner").combine_chunks()
    return pa.table({"lang": _plain(rows.column("lang")), "source": _plain(rows.column("source")), "term": rows.column("term"), "n": rows.column("n"), "total": rows.column("n_sum")})


def frequencies(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, total): counts of the kept words in each group, and in the whole language; a stored table.

    ``docs`` has lang, source and text without nulls.
    """
    ship_by_value()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, size // SHARD_BYTES)
    row_groups = {"parquet.block.size": 1 << 23, "parquet.block.size.row.check.min": 8}  # few of these long rows are read at once
    binary = docs.select(*(F.col(c).cast("binary") for c in ("lang", "source", "text")))
    runs = stored(binary.mapInArrow(_indexer(shards), _RUN_SQL), "runs", **row_groups)
    while True:
        many = runs.select(F.countDistinct("run")).first()[0]
        if many <= FAN_IN:
            break
        parts = -(-many // FAN_IN)

        def longer(key, table):
            merged = pa.concat_tables(merge(table))
            return pa.Table.from_batches([_run_rows(merged.add_column(0, "shard", pa.array([key[0].as_py()] * merged.num_rows, pa.int32())), key[1].as_py())])

        runs = stored(runs.withColumn("part", F.expr(f"pmod(xxhash64(run), {parts})")).groupBy("shard", "part").applyInArrow(longer, _RUN_SQL), "runs", **row_groups)

    def last(table):
        empty = pa.schema([(c, pa.string()) for c in ("lang", "source", "term")] + [("n", pa.int64()), ("total", pa.int64())]).empty_table()
        return pa.concat_tables([empty, *(_kept(some, min_docs).cast(empty.schema) for some in merge(table))])

    return stored(runs.groupBy("shard").applyInArrow(last, "lang string, source string, term string, n long, total long"), "frequencies")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10**9 * (count + 5) / (total + 5 * kept)), in decimals of 38 digits."""
    top = F.lit(ONE).cast("decimal(10,0)") * (count + 5).cast("decimal(20,0)")
    return F.call_function("div", top, (total + kept * 5).cast("decimal(20,0)")) + 1


def _tile_sums(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Corrections for the pairs of a tile: over words that both sources have, |p-q| - |p-zq| - |q-zp| + |zp-zq|.

    p, q are shares of the word, zp, zq those of a word that the source hasn't.
    """
    lang, first, second = key[0], key[2].as_py(), key[3].as_py()
    number = table.column("number").to_numpy()
    zeros = np.zeros(2 * TILE, np.int64)
    place = np.where(number // TILE == first, number % TILE, TILE + number % TILE)
    zeros[place] = table.column("z").to_numpy()
    words = np.unique(table.column("term").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    p = table.column("p").to_numpy()
    sums = np.zeros((TILE, 2 * TILE), np.int64)
    order = np.argsort(words, kind="stable")
    words, place, p = words[order], place[order], p[order]
    at = 0
    while at < len(words):  # a block of words at a time
        end = int(np.searchsorted(words, words[at] + 1024))
        block = np.zeros((1024, 2 * TILE), np.int64)
        block[words[at:end] - words[at], place[at:end]] = p[at:end]
        used = np.flatnonzero(block.any(0))
        others = used[used >= TILE] if first != second else used
        for g in used[used < TILE]:
            mine = np.flatnonzero(block[:, g])
            pg, zg = block[mine, g][:, None], zeros[g]
            q, z = block[np.ix_(mine, others)], zeros[others]
            gain = np.abs(pg - q) - np.abs(pg - z) - np.abs(q - zg) + np.abs(zg - z)
            sums[g, others] += np.where(q > 0, gain, 0).sum(0)
        at = end
    if first == second:
        sums = np.triu(sums, 1)
    g, h = np.nonzero(sums)
    other = h if first == second else h - TILE
    return pa.table({"lang": pa.array([lang.as_py()] * len(g), pa.string()), "g": first * TILE + g, "h": second * TILE + other, "value": sums[g, h]})


def divergence(docs: DataFrame, *, min_docs: int = 30, term_ranks: int = TERM_RANKS,
               lang_column: str = "lang", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank); see the module."""
    text = {"lang": lang_column, "source": source_column, "text": text_column}
    docs = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in text.items()))
    counts = frequencies(docs, min_docs)
    kept = counts.groupBy("lang").agg(F.countDistinct("term").alias("kept"), F.sum("n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(kept, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["kept", "lang_total", "total"])
    groups = groups.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    z = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.when(F.col("kept") > 0, F.col("kept")))).otherwise(F.lit(0))
    groups = stored(groups.withColumn("z", z.cast("long")), "groups")
    near = broadcast_if_small(groups, 100_000)

    p = _share(F.col("n"), F.col("total"), F.col("kept"))
    shares = stored(counts.withColumnRenamed("total", "whole").join(near, ["lang", "source"]).select(
        "lang", "source", "number", "z", "term", p.alias("p"), _share(F.col("whole"), F.col("lang_total"), F.col("kept")).alias("q")), "shares")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= term_ranks)

    # pairs, each value as a sum of contributions; if neither source had a word:
    other = near.select("lang", F.col("number").alias("h"), F.col("z").alias("zh"))
    pairs = groups.withColumnRenamed("number", "g").join(other, "lang").filter("g != h")
    neither = pairs.select("lang", "g", "h", F.expr("kept * abs(z - zh)").alias("value"))
    # words of the one source: equal shares are counted, then held against every other source of the language
    equal = shares.groupBy("lang", F.col("number").alias("g"), "z", "p").agg(F.count("*").alias("times"))
    one = equal.join(other, "lang").filter("g != h").groupBy("lang", "g", "h").agg(F.expr("sum(times * (abs(p - zh) - abs(z - zh)))").alias("value"))
    # words of both, tile by tile
    plan = shares.groupBy("lang").agg(F.expr(f"int(ceil(count(*) / {SLICE_ROWS}))").alias("slices")).join(
        groups.groupBy("lang").agg(F.expr(f"max(number) div {TILE}").alias("last_tile")), "lang")
    tiled = shares.join(broadcast_if_small(stored(plan, "tiles")), "lang").withColumn("own", F.expr(f"number div {TILE}")).withColumn(
        "tile", F.explode(F.expr("sequence(0L, last_tile)"))).select(
        "lang", F.expr("pmod(xxhash64(term), slices)").alias("slice"), F.least("own", "tile").alias("first"), F.greatest("own", "tile").alias("second"),
        "number", "z", "term", "p")
    both = tiled.groupBy("lang", "slice", "first", "second").applyInArrow(_tile_sums, "lang string, g long, h long, value long")
    both = both.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))

    def either_way(df: DataFrame) -> DataFrame:
        return df.select("lang", F.explode(F.array(F.struct("g", "h"), F.struct(F.col("h").alias("g"), F.col("g").alias("h")))).alias("pair"), "value").select("lang", "pair.*", "value")

    sums = neither.unionByName(either_way(one)).unionByName(either_way(both)).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    named = near.select("lang", "number", "source")
    sums = sums.join(named.withColumnRenamed("number", "g"), ["lang", "g"]).join(
        named.select("lang", F.col("number").alias("h"), F.col("source").alias("item")), ["lang", "h"])
    sums = sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    return sums.unionByName(terms.select(sums.columns))
