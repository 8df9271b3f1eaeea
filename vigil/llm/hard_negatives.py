"""Hard negatives by vertical scans with branch and bound on dimensions (BOND).

Vectors become integers, floor(scale * x), and are dealt into shards whose dimensions are stored as columns, each
with its least and greatest value. An anchor reads a shard's columns in the order of its own components' magnitude, the largest
first, half of them and then ``STEP`` at a time. What the columns still unread can add lies between sums of their least and greatest contributions, so each
candidate's score lies in an interval, and the candidates' bitmap shrinks to those whose interval can still count:

* positives (same label): those that can reach the kth largest lower bound;
* negatives (other labels): those that can lie in the window of a positive, low * p <= 100 * score <= high * p, and, once
  enough candidates are sure to lie inside, can reach the last of these.

What is left when all columns are read has its exact score. Anchors travel in blocks, each block meets each shard (an exact
search over all rows); shards return at most k rows for each anchor or (anchor, positive), a window ranks these.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part; vectors of
different length don't meet; a row never meets a row of its own vec_id; rows repeated under one vec_id are separate
candidates, and such a vec_id is one anchor, with its smallest (label, vector); ties go to the smaller vec_id; no positive,
or no negative within the window, gives no row; sums that may pass 2**53 are whole-number sums, clipped to 64 bits. An
empty table gives no rows. Labels are whole numbers. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.scratch import broadcast_if_small, ship_by_value, stored

STEP, BLOCKS_A_TASK = 8, 4
_SHORT, _EXACT, _MOST = float(1 << 24), float(1 << 53), (1 << 63) - 1


class Columns:
    """A shard: one array for each dimension, with its least and greatest value."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(vectors.T)
        self.least, self.most = self.columns.min(1, initial=np.inf), self.columns.max(1, initial=-np.inf)
        self.greatest = max(np.abs(self.least).max(initial=0), np.abs(self.most).max(initial=0))
        if self.greatest < _SHORT:
            self.columns = self.columns.astype(np.float32)


def _reads(dims: int) -> Iterator[tuple[int, int]]:
    """Which columns are read together: half of them, as no interval is narrow before, then a few at a time."""
    at = 0
    while at < dims:
        end = min(dims, max(at + STEP, dims // 2))
        yield at, end
        at = end


def scan(shard: Columns, anchor: np.ndarray, alive: np.ndarray, keeps: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the rows in ``alive`` that ``keeps``(lower bounds, upper bounds) never let go.

    Whole numbers are exact in floats of 32 or 64 bits where no sum can pass 2**24 or 2**53, else they are Python's.
    """
    dims = len(anchor)
    columns, least, most = shard.columns, shard.least, shard.most
    reach = 2 * float(np.abs(anchor).max(initial=0)) * max(1, dims) * shard.greatest
    if reach >= _EXACT:
        anchor, least, most = (np.array([int(x) for x in a], object) for a in (anchor, least, most))
    order = np.argsort(-np.abs(anchor).astype(np.float64), kind="stable")
    ends = np.stack([anchor * least, anchor * most])[:, order]
    low, high = ends.min(0)[::-1].cumsum()[::-1], ends.max(0)[::-1].cumsum()[::-1]
    kind = object if reach >= _EXACT else np.float32 if reach < _SHORT else np.float64
    weights = anchor.astype(kind)
    score = np.zeros(len(alive), kind)
    for a, b in _reads(dims):
        if not len(alive):
            break
        some = order[a:b]
        whole = 2 * len(alive) > columns.shape[1]  # few are gone: whole columns are read, and cut afterwards
        block = columns[some] if whole else columns[some][:, alive]
        part = weights[some] @ (block.astype(kind, copy=False) if kind is not object else np.array([[int(x) for x in row] for row in block], object).reshape(block.shape))
        score = score + (part[alive] if whole else part)
        lower, upper = (score + low[b], score + high[b]) if b < dims else (score, score)
        keep = keeps(lower, upper) if kind is not object else keeps(_clipped(lower), _clipped(upper))
        if not keep.all():
            alive, score = alive[keep], score[keep]
    return alive, score.astype(np.float64) if kind is not object else _clipped(score)


def _clipped(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.maximum(x, -_MOST - 1), _MOST)


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def best_alike(shard: Columns, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of the anchor's label."""
    def keeps(lower, upper):
        return upper >= _kth(lower, k) if len(lower) > k else np.ones(len(lower), bool)

    rows, scores = scan(shard, anchor, np.flatnonzero((shard.labels == label) & (shard.ids != anchor_id)), keeps)
    top = _best(shard.ids[rows], scores, k)
    return shard.ids[rows][top], scores[top]


def best_inside(shard: Columns, anchor_id: int, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window's number, ids, scores) of the k best rows of other labels with a score in each window."""
    least, most, widest = min(w[0] for w in windows), max(w[1] for w in windows), max(w[1] - w[0] for w in windows)

    def keeps(lower, upper):
        keep = (upper >= least) & (lower <= most)
        if len(lower) == 0 or upper[0] - lower[0] > widest:  # all intervals are equally wide: none is inside a window yet
            return keep
        some = np.flatnonzero(keep)
        low, high, use = lower[some], upper[some], np.zeros(len(some), bool)
        for lo, hi in windows:
            inside = low[(low >= lo) & (high <= hi)]
            use |= (high >= (max(lo, _kth(inside, k)) if len(inside) >= k else lo)) & (low <= hi)
        keep[some] = use
        return keep

    rows, scores = scan(shard, anchor, np.flatnonzero((shard.labels != label) & (shard.ids != anchor_id)), keeps)
    for i, (lo, hi) in enumerate(windows):
        w = np.flatnonzero((scores >= lo) & (scores <= hi))
        top = w[_best(shard.ids[rows[w]], scores[w], k)]
        yield i, shard.ids[rows[top]], scores[top]


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole x with low * score <= 100 * x <= high * score."""
    return -(-low * score // 100), high * score // 100


def _pack(table: pa.Table) -> dict:
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    short = np.abs(flat).max(initial=0) < 1 << 15
    return {"ids": [table.column("vec_id").to_numpy().tobytes()], "labels": [table.column("label").to_numpy().tobytes()],
            "vectors": [b"h" + flat.astype(np.int16).tobytes() if short else b"d" + flat.astype(np.float64).tobytes()]}


def _unpack(get: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(get[c].as_buffer(), np.int64) for c in ("ids", "labels"))
    raw = memoryview(get["vectors"].as_buffer())
    flat = np.frombuffer(raw[1:], np.int16 if raw[:1] == b"h" else np.float64)
    return ids, labels, flat.astype(np.float64).reshape(len(ids), get["dims"].as_py())


def mine(vectors: DataFrame, is_anchor: Column, label: Column, *, scale: float, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); see the module."""
    ship_by_value()
    x = F.col(f"`{vector_column}`")
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))

    def whole(v):
        y = v.cast("double") * scale  # from 2**53 on a double is whole
        return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)

    key = F.col(f"`{id_column}`").cast("long")
    rows = stored(vectors.filter(F.coalesce(usable, F.lit(False)) & key.isNotNull() & label.isNotNull()).select(
        key.alias("vec_id"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.size(x).alias("dims"),
        F.transform(x, whole).alias("v"), F.monotonically_increasing_id().alias("row")), "vectors")
    once = rows.filter("asks").groupBy("vec_id").agg(F.min(F.struct("label", "dims", "v", "row")).alias("asked")).select("asked.row", F.lit(True).alias("asks"))
    rows = rows.drop("asks").join(once, "row", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    # rows of a shard and anchors of a block grow with the table, between bounds that fit a task
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).select("dims", F.expr(
        "int(ceil(n / greatest(8192, least(65536, n div 64))))").alias("shards"), F.expr("int(ceil(greatest(m, 1) / greatest(128, least(4096, m div 8))))").alias("blocks"))
    sizes = broadcast_if_small(stored(sizes, "sizes"))  # a row for each length of vector
    dealt = stored(rows.join(sizes, "dims").select("dims", "vec_id", "label", "asks", "v", F.expr("int(pmod(xxhash64(row, 1), shards))").alias("shard"),
                                                   F.expr("int(pmod(xxhash64(row, 2), blocks))").alias("block")), "dealt")

    def shard_of(key, table):
        return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()), "shard": [key[1].as_py()], **_pack(table)})

    shards = stored(dealt.select("dims", "shard", "vec_id", "label", "v").groupBy("dims", "shard").applyInArrow(
        shard_of, "dims int, shard long, ids binary, labels binary, vectors binary"), "shards")
    anchors = dealt.filter("asks").select("dims", "block", "vec_id", "label", "v")

    def met(asking: DataFrame, find: Callable, schema: str) -> DataFrame:
        """``find`` for every block of anchors (with their windows) and every shard."""
        def block_of(key, table):
            return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()), "block": [key[1].as_py()], **_pack(table), "scores": pa.array([table.column("scores").to_pylist()], pa.list_(pa.list_(pa.int64())))})

        blocks = asking.groupBy("dims", "block").applyInArrow(block_of, "dims int, block long, ids binary, labels binary, vectors binary, scores array<array<long>>")
        lists = shards.join(sizes, "dims").select("dims", "shard", F.explode(F.expr(f"sequence(0L, (blocks - 1) div {BLOCKS_A_TASK})")).alias("part"),
                                                  F.lit(-1).cast("long").alias("block"), "ids", "labels", "vectors", F.lit(None).cast("array<array<long>>").alias("scores"))
        asked = blocks.join(sizes, "dims").select("dims", F.explode(F.expr("sequence(0L, bigint(shards - 1))")).alias("shard"), F.expr(f"bigint(block div {BLOCKS_A_TASK})").alias("part"),
                                                  "block", "ids", "labels", "vectors", "scores")
        tasks = lists.union(asked).repartition("dims", "shard", "part").sortWithinPartitions("dims", "shard", "part", "block")
        names = [c.split()[0] for c in schema.split(", ")]

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = None
            for batch in batches:
                for i in range(batch.num_rows):
                    get = {c: batch.column(c)[i] for c in batch.schema.names}
                    ids, labels, flat = _unpack(get)
                    if get["block"].as_py() < 0:  # the shard comes before its blocks
                        shard = Columns(ids, labels, flat)
                        continue
                    out = [r for j, scores in enumerate(get["scores"].as_py()) for r in find(shard, int(ids[j]), int(labels[j]), flat[j], scores)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * len(names))], names=names)

        return tasks.mapInArrow(meet, schema)

    def alike(shard, anchor_id, label, anchor, _):
        return [(anchor_id, int(i), int(s)) for i, s in zip(*best_alike(shard, anchor_id, label, anchor, positives), strict=True)]

    def inside(shard, anchor_id, label, anchor, scores):
        found = best_inside(shard, anchor_id, label, anchor, [window_of(s, low, high) for s in scores], negatives)
        return [(anchor_id, w + 1, int(i), int(s)) for w, ids, ss in found for i, s in zip(ids, ss, strict=True)]

    none = F.array().cast("array<long>")
    near = met(anchors.withColumn("scores", none), alike, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = stored(near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives), "positives")
    # an anchor's positives in their order: at most ``positives`` numbers
    windows = near.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "positive_score"))), lambda s: s["positive_score"]).alias("scores"))
    asking = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    far = met(asking, inside, "anchor_id long, nth long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return far.join(near, ["anchor_id", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
