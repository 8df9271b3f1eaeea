"""Token ids in wavelet-matrix shards.

Documents are dealt out by ranges of doc_id and sorted, encoded with a public
tokenizer, and cut into shards of about ``SHARD_TOKENS`` ids (whole documents).
A shard is one binary file image: header, document ids and lengths, and the
wavelet matrix of its ids: a bit-plane for each bit, most significant first,
each followed by its rank directory (ones before every 512 bits). It supports access to any
position, rank and counting in a range, and the position of the k-th occurrence,
without decoding the rest. Shards are the rows of a Parquet table (part, seq,
offset, n_docs, n_tokens, blob) in the cluster's shared folder; part and seq
ascend with doc_id.

Defined results: null and empty texts have the end id only; rows with the same
doc_id are separate documents, ordered by text; a null doc_id comes first; an
empty table gives no shards; other columns play no part.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.scratch import giving_back, ship_by_value
from vigil.llm.textops import blocks, column_bytes

MAGIC = b"VWM1"
RANK_BITS = 512
SHARD_TOKENS = 1 << 20
SLICE_BYTES = 16 << 20
#: ASCII letters; ASCII other than white space; of those, not letters; bytes that may begin white space
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_SOLID = np.arange(256) < 128
_SOLID[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = False
_SIGN = _SOLID & ~_LETTER
_MAYBE_WHITE = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3])


class WaveletMatrix:
    """Succinct sequence of unsigned integers below 2**bits."""

    def __init__(self, n: int, planes: list[np.ndarray]) -> None:
        self.n, self.planes, self.bits = n, planes, len(planes)
        self.ranks = [self._directory(p) for p in planes]
        self.zeros = [n - int(r[-1]) for r in self.ranks]

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(plane.view(np.uint64)).reshape(-1, RANK_BITS // 64).sum(1, dtype=np.uint32)
        return np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        n, planes = len(values), []
        size = -(-n // RANK_BITS) * (RANK_BITS // 8)
        for b in range(bits - 1, -1, -1):
            plane = np.zeros(size, np.uint8)
            one = (values >> b) & 1 > 0
            packed = np.packbits(one, bitorder="little")
            plane[: len(packed)] = packed
            planes.append(plane)
            values = np.concatenate([values[np.flatnonzero(~one)], values[np.flatnonzero(one)]])
        return cls(n, planes)

    def decode(self) -> np.ndarray:
        """All values, by undoing the planes from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            z = self.zeros[level]
            now[z:] |= kind(1 << (self.bits - 1 - level))
            out = np.empty_like(now)
            out[np.flatnonzero(~one)] = now[:z]  # twice as fast as by mask, as the bits are near random
            out[np.flatnonzero(one)] = now[z:]
            now = out
        return now

    def _ones(self, level: int, i: int) -> int:
        """Ones before position i of a plane."""
        block, rest = divmod(i, RANK_BITS)
        bits = np.unpackbits(self.planes[level][block * RANK_BITS // 8: (i + 7) // 8], bitorder="little")
        return int(self.ranks[level][block]) + int(bits[:rest].sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            value = value * 2 + bit
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of value within [lo, hi) stand below the last plane."""
        if value >> self.bits or value < 0:
            return 0, 0
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            one = (value >> (self.bits - 1 - level)) & 1
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if one else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of value in positions [lo, hi)."""
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def select(self, value: int, k: int) -> int:
        """Position of the occurrence number k (from 0); -1 if there are no so many."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= k < b - a:
            return -1
        i = a + k
        for level in range(self.bits - 1, -1, -1):
            one = (value >> (self.bits - 1 - level)) & 1
            i = self._position(level, one, i - self.zeros[level] if one else i)
        return i

    def _position(self, level: int, one: int, k: int) -> int:
        """Position of the k-th (from 0) one, or zero, of a plane."""
        before = self.ranks[level].astype(np.int64)
        if not one:
            before = np.arange(len(before)) * RANK_BITS - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * RANK_BITS // 8: (block + 1) * RANK_BITS // 8], bitorder="little")
        return block * RANK_BITS + int(np.flatnonzero(bits == one)[k - before[block]])

    def to_bytes(self) -> bytes:
        out = [struct.pack("<QB", self.n, self.bits)]
        for plane, rank in zip(self.planes, self.ranks, strict=True):
            out += [plane.tobytes(), rank.tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: memoryview) -> WaveletMatrix:
        n, bits = struct.unpack_from("<QB", data)
        blocks_ = -(-n // RANK_BITS)
        self, at = cls.__new__(cls), 9
        self.n, self.bits, self.planes, self.ranks = n, bits, [], []
        for _ in range(bits):
            self.planes.append(np.frombuffer(data, np.uint8, blocks_ * RANK_BITS // 8, at))
            at += blocks_ * RANK_BITS // 8
            self.ranks.append(np.frombuffer(data, np.uint32, blocks_ + 1, at))
            at += 4 * (blocks_ + 1)
        self.zeros = [n - int(r[-1]) for r in self.ranks]
        return self


def shard_bytes(doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """One shard's file image; known: whether a document has an id."""
    return b"".join([MAGIC, struct.pack("<Q", len(doc_ids)), doc_ids.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(),
                     lengths.astype("<u8").tobytes(), WaveletMatrix.build(ids, bits).to_bytes()])


def read_shard(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, WaveletMatrix]:
    """(doc_ids, known, lengths, matrix) of a shard's file image."""
    data = memoryview(blob)
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    (n,) = struct.unpack_from("<Q", data, 4)
    doc_ids = np.frombuffer(data, "<i8", n, 12)
    known = np.frombuffer(data, np.uint8, n, 12 + 8 * n).astype(bool)
    lengths = np.frombuffer(data, "<u8", n, 12 + 9 * n).astype(np.int64)
    return doc_ids, known, lengths, WaveletMatrix.from_bytes(data[12 + 17 * n:])


class Encoder:
    """Whole texts to ids. Texts are cut where byte-level pre-tokenization always
    cuts: before a space that stands before something other than white space, between an ASCII
    letter and an ASCII sign or digit, and behind a single line end. Each distinct
    piece of a slice is encoded once; a space and ASCII letters go to the model as they are, being one word for it. With ``added_tokens``, as by the library's default, the strings
    of the tokenizer's added tokens get those tokens' ids; without, they are ordinary text."""

    def __init__(self, path: str, end_id: int, added_tokens: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        known = self.tokenizer.get_added_tokens_decoder().values()
        if added_tokens and any(x.lstrip or x.rstrip or x.single_word for x in known):
            raise ValueError("added tokens that take in or ask for neighbouring characters")
        contents = sorted((x.content.encode() for x in known), key=len, reverse=True) if added_tokens else []
        self.added = re.compile(b"|".join(map(re.escape, contents))) if contents else None
        self.end_id = end_id
        size = self.tokenizer.get_vocab_size()
        self.bits = max(1, (max(size, end_id + 1) - 1).bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        # the same model on words of which only the ends are to be found; where texts are split in another way, it isn't used
        split = self.tokenizer.pre_tokenizer
        usual = self.tokenizer.normalizer is None and isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space
        self.of_words = None
        if usual and not any(re.fullmatch("[ A-Za-z]*", x.content) for x in known):
            self.of_words = Tokenizer(self.tokenizer.model)
            self.of_words.pre_tokenizer = CharDelimiterSplit(" ")
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])

    def _ids(self, texts: list[str], tokenizer=None) -> list[list[int]]:
        return [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _distinct(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, first id of each piece and the end) of distinct pieces."""
        lengths = np.zeros(len(pieces), np.int64)
        data, offsets = column_bytes(pieces)
        space = np.concatenate([[0], np.cumsum(data == 0x20)])
        filled = np.diff(offsets) > 0
        plain = filled & (np.diff(space[offsets]) == 1)
        plain &= np.diff(offsets) > 1
        plain[plain] = (data[offsets[:-1][plain]] == 0x20) & ~_MAYBE_WHITE[data[offsets[:-1][plain] + 1]]  # a space in front and nowhere else
        found: list[tuple[np.ndarray, np.ndarray]] = []
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        word = plain & (np.diff(letters[offsets]) == np.diff(offsets) - 1) & (self.of_words is not None)
        for at, words in ((np.flatnonzero(word), True), (np.flatnonzero(plain & ~word), False)):
            if not len(at):
                continue
            joined, cut = column_bytes(pieces.take(pa.array(at)))
            raw = joined.tobytes()
            texts = [raw[cut[i]: cut[i + len(o) - 1]].decode() for i, _, o in blocks(joined, cut, 1 << 16)]
            each = self._ids(["Ġ" + x[1:].replace(" ", " Ġ") for x in texts], self.of_words) if words else self._ids(texts)
            ids = np.concatenate([np.array(x, self.kind) for x in each])
            start = np.flatnonzero(self.opens[ids])
            if len(start) != len(at):
                raise ValueError("the tokenizer doesn't start a token at each space")
            lengths[at] = np.diff(np.append(start, len(ids)))
            found.append((at, ids))
        rest = np.flatnonzero(filled & ~plain)
        if len(rest):
            each = self._ids(pieces.take(pa.array(rest)).to_pylist())
            lengths[rest] = [len(x) for x in each]
            found.append((rest, np.array([i for x in each for i in x], self.kind)))
        first = np.concatenate([[0], np.cumsum(lengths)])
        out = np.zeros(first[-1], self.kind)
        for which, ids in found:
            n = lengths[which]
            out[np.repeat(first[which] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, first

    def _around_added(self, raw: np.ndarray, at: np.ndarray, edge: np.ndarray) -> None:
        """Cut before and behind added tokens, but neither inside nor before a space in front of one, which ends its run of text."""
        if self.added is None:
            return
        text, pos = memoryview(raw), 0
        while (found := self.added.search(text, pos)) is not None:
            a, b = found.span()
            row_end = int(at[np.searchsorted(at, a, side="right")])
            if b > row_end:  # over the end of a text
                pos = a + 1
                continue
            edge[a + 1: b] = False
            if a and raw[a - 1] == 0x20 and a - 1 != pos:
                edge[a - 1] = False
            edge[a] = edge[b] = True
            pos = b

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of a run of texts, their lengths), end ids included, in the column's order."""
        data, offsets = column_bytes(column)
        for _, raw, at in blocks(data, offsets, SLICE_BYTES):
            edge = np.zeros(len(raw) + 1, bool)
            if len(raw):
                edge[: len(raw) - 1] = (raw[:-1] == 0x20) & ~_MAYBE_WHITE[raw[1:]]
                edge[1:-1] |= _LETTER[raw[:-1]] & _SIGN[raw[1:]]
                edge[2:-1] |= (raw[1:-1] == 0x0A) & _SOLID[raw[:-2]] & _SOLID[raw[2:]]
            self._around_added(raw, at, edge)
            edge[at] = True  # an empty text adds no piece
            cuts = np.flatnonzero(edge)
            pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw)))
            coded = pieces.dictionary_encode()
            ids, first = self._distinct(coded.dictionary)
            # the end id as one more piece behind each text
            which = np.insert(coded.indices.to_numpy().astype(np.int64), np.searchsorted(cuts, at[1:]), len(first) - 1)
            ids, first = np.append(ids, self.kind(self.end_id)), np.append(first, len(ids) + 1)
            ends = np.searchsorted(cuts, at[1:]) + np.arange(1, len(at))  # of each text, in pieces
            begin = 0
            for stop in [*range(512, len(ends), 512), len(ends)]:  # texts at a time, to bound the index arrays
                lo, hi = (ends[begin - 1] if begin else 0), ends[stop - 1]
                w = which[lo:hi]
                n = first[w + 1] - first[w]
                total = np.concatenate([[0], np.cumsum(n)])
                out = ids[np.repeat(first[w] - total[:-1], n) + np.arange(total[-1])]
                yield out, np.diff(np.concatenate([[0], total[ends[begin:stop] - lo]]))
                begin = stop


def write_shards(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS, added_tokens: bool = False) -> None:
    """Encode ``docs`` (doc_id, text) and write the shard table to ``path``; ``added_tokens`` as in ``Encoder``."""
    ship_by_value()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, offset = TaskContext.get().partitionId(), 0, 0
        encoder = Encoder(tokenizer, end_id, added_tokens)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal seq, offset, held, size
            doc_ids, known, lengths, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            blob = shard_bytes(doc_ids, known, lengths, ids, encoder.bits)
            row = [part, seq, offset, len(doc_ids), len(ids), blob]
            seq, offset, held, size = seq + 1, offset + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row[:-1]] + [pa.array([blob], pa.binary())],
                                              names=["part", "seq", "offset", "n_docs", "n_tokens", "blob"])

        for batch in batches:
            column = batch.column("doc_id")
            doc_ids = column.fill_null(0).to_numpy()
            known = column.is_valid().to_numpy(zero_copy_only=False)
            at = 0
            for ids, lengths in encoder.encode(batch.column("text")):
                begin = np.concatenate([[0], np.cumsum(lengths)])
                i = 0
                while i < len(lengths):  # whole texts until the shard is full
                    j = min(len(lengths), max(i + 1, int(np.searchsorted(begin, begin[i] + shard_tokens - size, side="left"))))
                    held.append((doc_ids[at + i: at + j], known[at + i: at + j], lengths[i:j], ids[begin[i]: begin[j]]))
                    size += int(begin[j] - begin[i])
                    if size >= shard_tokens:
                        yield shard()
                    i = j
                at += len(lengths)
        if held:
            yield shard()

    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(giving_back(run), "part long, seq long, offset long, n_docs long, n_tokens long, blob binary").write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards at ``path``."""
    ship_by_value()
    shards = spark.read.parquet(path)
    # a row for each part, so at most the number of partitions that wrote the table
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, known, lengths, matrix = read_shard(batch.column("blob")[i].as_buffer())
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (e - n): 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=~known), pa.array(ends - lengths + batch.column("start")[i].as_py()), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = shards.join(F.broadcast(before), "part").select((F.col("before") + F.col("offset")).alias("start"), "blob")
    return placed.mapInArrow(giving_back(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
