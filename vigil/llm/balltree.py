"""Exact top-k inner-product search by ball-tree branch and bound.

Vectors become integers, floor(scale * x). Candidates are dealt into shards of about
``SHARD_ROWS`` rows, each a ball tree: nodes halved along the direction in which
they spread most, with centre c and radius r, so that no vector of a node has an
inner product with q above q.c + |q| r. Queries come in blocks of
``QUERY_ROWS``; a block visits a tree's children in the order of that bound and leaves out,
query by query, what cannot reach its current kth score. Each query first
searches the shard that holds it; the kth score found there is shared
with the search of all other shards, which is over pairs (query block, shard)
read from stored blocks. A last window ranks what the shards return, at most k
rows of each query and shard.

Defined results: vectors that are null, hold null or non-finite components, or have
no vec_id take no part; vectors of different length don't meet; ties go to the
smaller vec_id; repeated rows of one vec_id are separate candidates, but a query
never meets a row of its own vec_id, and a vec_id with several rows asks once, with its smallest vector; with fewer than k candidates all are returned; sums
beyond 2**53 are computed in whole numbers and those beyond 64 bits are clipped; other columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.scratch import broadcast_if_small, ship_by_value, stored

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS, BLOCKS_A_TASK = 8192, 512, 256, 8
_EXACT = float(1 << 53)


class Tree:
    """Ball tree over rows; rows are reordered so that each node is a run of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.arange(len(ids))
        x = vectors.astype(np.float64)
        self.nodes: list[tuple[int, int, int, int]] = []  # first, end, left child, right child
        self.centres, self.radii = [], []

        def build(lo: int, hi: int) -> int:
            at = len(self.nodes)
            rows = x[order[lo:hi]]
            centre = rows.mean(0)
            self.nodes.append((lo, hi, -1, -1))
            self.centres.append(centre)
            self.radii.append(float(np.sqrt(((rows - centre) ** 2).sum(1).max())))
            if hi - lo > LEAF_ROWS and self.radii[-1] > 0:
                far = rows[((rows - centre) ** 2).sum(1).argmax()]
                other = rows[((rows - far) ** 2).sum(1).argmax()]
                order[lo:hi] = order[lo:hi][np.argsort(rows @ (other - far), kind="stable")]
                mid = (lo + hi) // 2
                left = build(lo, mid)
                self.nodes[at] = (lo, hi, left, build(mid, hi))
            return at

        build(0, len(ids))
        self.ids, self.vectors = ids[order], vectors[order]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)


def _merge(scores: np.ndarray, ids: np.ndarray, more: np.ndarray, their_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, by score and then the smaller id."""
    s = np.concatenate([scores, more], 1)
    i = np.concatenate([ids, np.broadcast_to(their_ids, more.shape)], 1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the best k rows of each query at or above its ``floor``; missing ones have the score -inf."""
    n = len(ids)
    best = np.full((n, k), -np.inf)
    best_id = np.full((n, k), np.iinfo(np.int64).max)
    q = queries.astype(np.float64)
    size = np.sqrt((q * q).sum(1))
    slack = 1e-9 * (1 + size * (np.abs(tree.centres).max(initial=0) * np.sqrt(max(1, q.shape[1])) + tree.radii.max(initial=0)))
    bounds = q @ tree.centres.T + size[:, None] * tree.radii[None, :] + slack[:, None]  # [query, node]

    def visit(node: int, who: np.ndarray) -> None:
        who = who[bounds[who, node] >= np.maximum(best[who, k - 1], floor[who])]
        if not len(who):
            return
        lo, hi, left, right = tree.nodes[node]
        if left < 0:
            for a in range(lo, hi, LEAF_ROWS):
                b = min(hi, a + LEAF_ROWS)
                s = q[who] @ tree.vectors[a:b].astype(np.float64).T
                s[ids[who][:, None] == tree.ids[a:b][None, :]] = -np.inf
                s[s < floor[who][:, None]] = -np.inf
                if b - a > k:  # the kth score of these rows or of those held; ties stay
                    cut = np.maximum(np.partition(s, b - a - k, axis=1)[:, b - a - k], best[who, k - 1])
                    some = (s >= cut[:, None]) & (s > -np.inf)
                    use = np.flatnonzero(some.any(0))
                    best[who], best_id[who] = _merge(best[who], best_id[who], np.where(some, s, -np.inf)[:, use], tree.ids[a:b][use], k)
                else:
                    best[who], best_id[who] = _merge(best[who], best_id[who], s, tree.ids[a:b], k)
            return
        first = bounds[who, left] >= bounds[who, right]  # the nearer child first
        visit(left, who[first])
        visit(right, who[~first])
        visit(right, who[first])
        visit(left, who[~first])

    visit(0, np.arange(n))
    return best, best_id


def whole_scores(ids: np.ndarray, queries: np.ndarray, their_ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) by whole-number sums, for blocks whose sums may pass 2**53."""
    a = np.array([[int(x) for x in row] for row in queries], object)
    b = np.array([[int(x) for x in row] for row in vectors], object)
    out = []
    for i in range(len(ids)):
        s = (b * a[i]).sum(1) if b.shape[1] else np.zeros(len(b), object)
        s = [min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in s]
        rows = sorted((-x, int(v)) for x, v in zip(s, their_ids, strict=True) if v != ids[i])[:k]
        out += [(int(ids[i]), v, -x) for x, v in rows]
    return tuple(np.array(x, np.int64) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def found(ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, tree: Tree, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) rows of one query block against one shard."""
    biggest = float(np.abs(queries).max(initial=0)) * float(np.abs(tree.vectors).max(initial=0)) * max(1, queries.shape[1])
    if biggest >= _EXACT:
        return whole_scores(ids, queries, tree.ids, tree.vectors, k)
    scores, who = search(tree, ids, queries, floor, k)
    ok = scores > -np.inf
    return np.repeat(ids, k).reshape(-1, k)[ok], who[ok], scores[ok].astype(np.int64)


def _pack(ids: np.ndarray, vectors: np.ndarray) -> tuple[bytes, bytes]:
    """Bytes of ids and of vectors; short whole numbers take two bytes each."""
    short = np.abs(vectors).max(initial=0) < 1 << 15
    return ids.astype(np.int64).tobytes(), (b"h" + vectors.astype(np.int16).tobytes()) if short else (b"d" + vectors.astype(np.float64).tobytes())


def _unpack(ids, vectors, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids, raw = np.frombuffer(ids.as_buffer(), np.int64), memoryview(vectors.as_buffer())
    return ids, np.frombuffer(raw[1:], np.int16 if raw[:1] == b"h" else np.float64).reshape(len(ids), dims)


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    return ids, table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)


def nearest(vectors: DataFrame, is_query, *, k: int, scale: float, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row where ``is_query`` holds."""
    ship_by_value()
    x = F.col(vector_column)
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))

    def whole(v):
        y = v.cast("double") * scale  # from 2**53 on a double is whole
        return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)

    rows = stored(vectors.filter(F.coalesce(usable, F.lit(False)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.size(x).alias("dims"),
        F.transform(x, whole).alias("v"), F.monotonically_increasing_id().alias("row")), "vectors")
    # a vec_id with several rows asks once, with its smallest vector
    once = rows.filter("asks").groupBy("vec_id").agg(F.min(F.struct("dims", "v", "row")).alias("asked")).select(F.col("asked.row").alias("row"), F.lit(True).alias("asks"))
    rows = rows.drop("asks").join(once, "row", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).select(
        "dims", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"), F.greatest(F.ceil(F.col("m") / QUERY_ROWS), F.lit(1)).cast("int").alias("blocks"))
    sizes = broadcast_if_small(stored(sizes, "sizes"))  # a row for each length of vector
    dealt = rows.join(sizes, "dims").select(
        "dims", "vec_id", "asks", "v", F.expr("int(pmod(xxhash64(row, 1), shards))").alias("shard"), F.expr("int(pmod(xxhash64(row, 2), blocks))").alias("block"))
    dealt = stored(dealt, "dealt")

    def build(key, table):
        ids, flat = _rows(table)
        a, b = _pack(ids, flat)
        return pa.table({"dims": [int(key[0].as_py())], "shard": [key[1].as_py()], "ids": [a], "vectors": [b]})

    shards = dealt.groupBy("dims", "shard").applyInArrow(build, "dims long, shard long, ids binary, vectors binary")

    def own(key, table):
        """Each query against the shard that holds it."""
        ids, flat = _rows(table)
        asks = np.flatnonzero(table.column("asks").to_numpy())
        parts = [(np.zeros(0, np.int64),) * 3]
        if len(asks):
            tree = Tree(ids, flat)
            parts += [found(ids[w], flat[w], np.full(len(w), -np.inf), tree, k) for w in (asks[i: i + QUERY_ROWS] for i in range(0, len(asks), QUERY_ROWS))]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(c) for c in zip(*parts, strict=True)), strict=True)))

    seeds = stored(dealt.groupBy("dims", "shard").applyInArrow(own, "query_id long, vec_id long, score long"), "seeds")
    floors = seeds.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).select(
        "query_id", F.when(F.col("n") >= k, F.col("kth")).cast("double").alias("kth"))
    asking = dealt.filter("asks").join(floors, F.col("vec_id") == F.col("query_id"), "left").select(
        "dims", "block", "vec_id", "shard", "v", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))

    def pack(key, table):
        a, b = _pack(*_rows(table))
        return pa.table({"dims": [int(key[0].as_py())], "block": [key[1].as_py()], "ids": [a], "vectors": [b],
                         "floor": [table.column("kth").to_numpy().tobytes()], "home": [table.column("shard").to_numpy().astype(np.int32).tobytes()]})

    blocks = asking.groupBy("dims", "block").applyInArrow(pack, "dims long, block long, ids binary, vectors binary, floor binary, home binary")
    # every block of queries goes to every shard; a shard goes once to every BLOCKS_A_TASK of them
    none = F.lit(None).cast("binary")
    lists = shards.join(sizes, "dims").select(
        "dims", "shard", F.explode(F.expr(f"sequence(0L, (blocks - 1) div {BLOCKS_A_TASK})")).alias("part"), F.lit(-1).cast("long").alias("block"), "ids", "vectors", none.alias("floor"), none.alias("home"))
    asked = blocks.join(sizes, "dims").select(
        "dims", F.explode(F.expr("sequence(0L, bigint(shards - 1))")).alias("shard"), F.expr(f"bigint(block div {BLOCKS_A_TASK})").alias("part"), "block", "ids", "vectors", "floor", "home")
    tasks = lists.union(asked).repartition("dims", "shard", "part").sortWithinPartitions("dims", "shard", "part", "block")

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch.column(c)[row] for c in batch.schema.names}
                ids, flat = _unpack(get["ids"], get["vectors"], get["dims"].as_py())
                if get["block"].as_py() < 0:  # the shard comes before its queries
                    tree = Tree(ids, flat)
                    continue
                away = np.frombuffer(get["home"].as_buffer(), np.int32) != get["shard"].as_py()  # the own shard has been searched
                a, b, s = found(ids[away], flat[away], np.frombuffer(get["floor"].as_buffer(), np.float64)[away], tree, k)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], names=["query_id", "vec_id", "score"])

    rest = tasks.mapInArrow(cross, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return seeds.union(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
