"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: for every context of up to
``order`` bytes the counts of the bytes that followed it in its sample. A text's
code length under a language is the sum over its bytes of -log2 P(byte |
context), where a byte unseen in a context is reached by escapes to the next
shorter one (method C: the escape has the weight of the number of distinct bytes
seen), with bytes of the longer context excluded. The statistics stay as
they are while a text is scored, so the code length of every (context, byte) is
a table entry. The shortest code length wins.

Defined results: null text or text without a letter gives ``und`` with score 0;
ties go to the language that sorts first; without labelled rows every text is
``und``; repeated rows are scored each; other columns are passed on. Rows
without doc_id count as held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import giving_back, ship_by_value
from vigil.llm.textops import blocks, column_bytes

UNDETERMINED = "und"
BLOCK_BYTES = 1 << 18  # a byte takes 60 bytes or so while its block is scored


def labelled_pieces(docs: DataFrame, piece_chars: int, sample_chars: int, seed: int = 7) -> DataFrame:
    """(lang, piece): about ``sample_chars`` characters of every language.

    Texts are cut into pieces and pieces are kept by hash, each with the
    probability sample_chars / characters of its language, so every part of
    every labelled text has the same chance.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    # counted for all labelled rows; a row for each language
    size = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("_chars"))
    cut = rows.select("lang", "doc_id", "text", F.explode(F.sequence(F.lit(0), F.expr(f"(length(text) - 1) div {piece_chars}"))).alias("_i"))
    u = (F.xxhash64(F.lit(seed), "doc_id", "_i").bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))
    return (cut.select("lang", "_i", "text", u.alias("_u")).join(F.broadcast(size), "lang")
            .filter(F.col("_u") < F.lit(float(sample_chars)) / F.col("_chars"))
            .select("lang", F.expr(f"substring(text, int(_i) * {piece_chars} + 1, {piece_chars})").alias("piece")))


def train(samples: dict[str, list[bytes]], order: int = 3, min_count: int = 2) -> dict:
    """Context trees of all languages as tables over their joint contexts.

    ``symbol``: byte -> symbol (0: in no sample); ``steps[k]``: (state after k
    bytes back, symbol) -> state; ``cost``: (state, symbol, language) -> bits.
    """
    langs = sorted(samples)
    text = {x: np.frombuffer(b"\n".join(samples[x]), np.uint8) for x in langs}
    seen = np.unique(np.concatenate([text[x] for x in langs])) if langs else np.zeros(0, np.uint8)
    symbol = np.zeros(256, np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    a = len(seen) + 1
    # (context, symbol) counts of each order, contexts as numbers in base a, nearest byte most significant
    steps, levels, state_of = [], [], {(): 0}
    level = {0: 0}  # context number -> state, at this depth
    n_states = 1
    parents = [0]
    counts = {x: [np.bincount(symbol[text[x]], minlength=a)[None, :]] for x in langs}
    for depth in range(1, order + 1):
        found: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for x in langs:
            s = symbol[text[x]].astype(np.int64)
            context = np.zeros(max(0, len(s) - depth), np.int64)
            for back in range(depth):  # nearest byte first
                context = context * a + s[depth - 1 - back: len(s) - 1 - back]
            pair, n = np.unique(context * a + s[depth:], return_counts=True)
            found[x] = (pair // a, pair % a, n)
        totals: dict[int, int] = {}
        for c, _, n in found.values():
            u, inv = np.unique(c, return_inverse=True)
            for key, value in zip(u.tolist(), np.bincount(inv, weights=n).tolist()):
                totals[key] = totals.get(key, 0) + int(value)
        kept = sorted(k for k, v in totals.items() if v >= min_count and k // a in level)
        step = np.repeat(np.arange(n_states, dtype=np.int32)[:, None], a, axis=1)
        new = {k: n_states + i for i, k in enumerate(kept)}
        for k, state in new.items():
            step[level[k // a], k % a] = state
            parents.append(level[k // a])
        steps.append(step)
        keys = np.array(kept, np.int64)
        for x in langs:
            c, s, n = found[x]
            table = np.zeros((len(kept), a), np.int64)
            if len(kept):
                at = np.searchsorted(keys, c)
                ok = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == c)
                table[at[ok], s[ok]] = n[ok]
            counts[x].append(table)
        levels.append(len(kept))
        level, n_states = new, n_states + len(kept)
    cost = np.stack([_code_lengths(np.concatenate(counts[x]), np.array(parents)) for x in langs], axis=2) if langs else np.zeros((1, a, 0))
    return {"langs": langs, "symbol": symbol, "steps": steps, "cost": cost.astype(np.float32), "a": a}


def _code_lengths(count: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Bits of every symbol in every context of one language; parents come before children."""
    n, a = count.shape
    bits = np.zeros((n, a))
    after = np.zeros((n, a))  # bits of a symbol once this context has been escaped from
    unseen = 256 - int((count[0] > 0).sum())  # bytes that the order 0 context lacks, equally likely
    depth = np.zeros(n, int)
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    for d in range(depth.max() + 1):
        rows = np.flatnonzero(depth == d)
        c = count[rows]
        seen = c > 0
        if d == 0:
            after[rows] = np.log2(max(unseen, 1))
        else:
            p = parent[rows]
            masked = np.where(seen, 0, count[p])  # the parent's bytes without those of this context
            total, kinds = masked.sum(1, keepdims=True), (masked > 0).sum(1, keepdims=True)
            weight = np.maximum(total + kinds, 1)
            escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / weight), 0.0)
            after[rows] = np.where(masked > 0, -np.log2(np.maximum(masked, 1) / weight), escape + after[p])
        total, kinds = c.sum(1, keepdims=True), seen.sum(1, keepdims=True)
        weight = np.maximum(total + kinds, 1)
        escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / weight), 0.0)
        bits[rows] = np.where(seen, -np.log2(np.maximum(c, 1) / weight), escape + after[rows])
        if d > 0:  # a context that this language has never met passes on to its parent at no cost
            empty = rows[total[:, 0] == 0]
            bits[empty], after[empty] = bits[parent[empty]], after[parent[empty]]
    return bits


def code_lengths(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every row under every language."""
    rows, langs = len(offsets) - 1, len(model["langs"])
    out = np.zeros((rows, langs))
    a, cost = model["a"], model["cost"].reshape(-1, langs)
    for first, raw, at in blocks(data, offsets, BLOCK_BYTES):
        if not len(raw):
            continue
        s = model["symbol"][raw]
        state = np.zeros(len(s), np.int32)
        position = np.arange(len(s)) - np.repeat(at[:-1], np.diff(at))
        for k, step in enumerate(model["steps"]):
            back = np.zeros(len(s), np.int32)
            back[k + 1:] = s[: len(s) - k - 1]
            state = np.where(position > k, step.ravel()[state * a + back], state)
        each = cost[state * a + s]
        filled = np.flatnonzero(np.diff(at) > 0)
        out[first + filled] = np.add.reduceat(each, at[filled], axis=0, dtype=np.float64)
    return out


def identify(docs: DataFrame, labelled: DataFrame, *, order: int = 3, min_count: int = 2, piece_chars: int = 512,
             sample_chars: int = 400_000, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with lang_pred and score.

    ``labelled`` has the rows to learn from (lang, doc_id, text). The sample is
    bounded by ``sample_chars`` a language; it is the only thing that reaches
    the driver. ``score`` is the winner's share of the probability when each
    language has its probability per byte: sum of 2**-(bits a byte) over
    languages, sharpened by the number of bytes up to 64.
    """
    ship_by_value()
    spark = docs.sparkSession
    samples: dict[str, list[bytes]] = {}
    for lang, piece in labelled_pieces(labelled, piece_chars, sample_chars).collect():
        samples.setdefault(lang, []).append(piece.encode())
    for pieces in samples.values():
        pieces.sort()
    model = spark.sparkContext.broadcast(train(samples, order, min_count))
    names = docs.columns if carry is None else carry
    text = f"c{names.index('text')}" if "text" in names else "_text"  # a text goes to the worker once

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        langs = np.array([*m["langs"], UNDETERMINED], dtype=object)
        for batch in batches:
            data, offsets = column_bytes(batch.column(text))
            none = np.full(batch.num_rows, len(m["langs"]))
            if m["langs"]:
                bits = code_lengths(m, data, offsets)
                best = bits.argmin(1)
                size = np.maximum(np.diff(offsets), 1)
                gap = (bits - bits[np.arange(len(best)), best][:, None]) * (np.minimum(size, 64) / size)[:, None]
                share = 1 / np.exp2(-gap).sum(1)
                ok = batch.column("_letter").to_numpy(zero_copy_only=False).astype(bool)
                pred, sure = np.where(ok, best, none), np.where(ok, share, 0.0)
            else:
                pred, sure = none, np.zeros(batch.num_rows)
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs[pred], pa.string()), pa.array(sure, pa.float64())],
                names=[*(f"c{i}" for i in range(len(names))), "lang_pred", "score"])

    given = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), *([F.col("text").alias(text)] if text == "_text" else []),
                        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    schema = given.drop("_text", "_letter").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    out = given.mapInArrow(giving_back(score), schema)
    keep = [i for i, c in enumerate(names) if c not in ("lang_pred", "score")]  # clashing columns give way
    return out.select(*(F.col(f"c{i}").alias(names[i]) for i in keep), "lang_pred", "score")


def held_out(doc_id) -> F.Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))
