"""Operator 10: token ids in binary files, coded by a static range ANS.

One frequency table, counted over the whole corpus, is shared by all blocks.  A
block holds whole documents; its ids are dealt to interleaved lanes that are
coded together (a numpy step codes one id of every lane).  Checkpoints keep the
lanes' states and the place in the word stream, so decoding can also begin
inside a block; a checksum covers the block.

Layout of a block (little endian): magic, lanes, ids, words, documents,
checkpoints (uint32 each), start of the first id in the corpus (uint64), then
document ids (int64), ids per document (uint32), per checkpoint the word
position (uint32) and the lane states (uint64), the words (uint32), crc32.
Files: Parquet rows ``(start, block)`` in ``blocks``, ``(id, freq)`` in ``table``.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.llm.common import checkpoint_dir, id_ranges, id_text, prepare, real_id, stored
from pricelens.llm.tokens import default_vocabulary, encoded

MAGIC = 0x534E4152
LANES = 512
#: Ids of a block at least (a document is never split), and between checkpoints.
BLOCK_IDS = 1 << 18
CHECKPOINT_IDS = 1 << 16
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<6IQ")


class Table:
    """Frequencies of the ids, scaled to ``2**bits``; every id that occurs has one at least."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.bits = max(1, int(self.freq.sum()).bit_length() - 1)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self._symbol = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        """Scale counts by largest remainders to a power of two, 16 times the ids that occur or more."""
        counts = counts.astype(np.float64)
        seen = counts > 0
        k = int(seen.sum())
        total = 1 << max(12, (16 * max(k, 1)).bit_length() if k < 1 << 14 else (4 * k).bit_length())
        if not k:
            return cls(np.array([total]))
        share = counts / counts.sum() * (total - k)
        freq = np.floor(share).astype(np.int64) + seen
        left = total - int(freq.sum())
        freq[np.argsort(-(share - np.floor(share)), kind="stable")[:left]] += 1
        return cls(freq)


def encode_block(ids: np.ndarray, table: Table, doc_ids, lengths, start: int, lanes: int = LANES, every: int = CHECKPOINT_IDS) -> bytes:
    """The ids of some documents as one block."""
    n = len(ids)
    steps = -(-n // lanes)
    each = max(1, every // lanes)
    bits, up = np.uint64(table.bits), np.uint64(63 - table.bits)
    x = np.full(lanes, _LOW, np.uint64)
    freq, cum = table.freq[ids], table.cum[ids]
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    out, half = 0, np.uint64(32)
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes : (t + 1) * lanes], cum[t * lanes : (t + 1) * lanes]
        y = x[: len(f)]
        full = (y >> up) >= f
        w = y[full].astype(np.uint32)
        words.append(w)
        out += len(w)
        y = np.where(full, y >> half, y)
        q = y // f
        x[: len(f)] = (q << bits) + (y - q * f) + c
        if t % each == 0:
            marks.append((out, x.copy()))
    stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    body = [_HEAD.pack(MAGIC, lanes, n, len(stream), len(lengths), len(marks), start), np.asarray(doc_ids, "<i8").tobytes(), np.asarray(lengths, "<u4").tobytes()]
    for done, state in reversed(marks):
        body += [struct.pack("<I", len(stream) - done), state.astype("<u8").tobytes()]
    body.append(stream.astype("<u4").tobytes())
    raw = b"".join(body)
    return raw + struct.pack("<I", zlib.crc32(raw))


class Block:
    """Reads a block; raises ValueError if its checksum or magic is wrong."""

    def __init__(self, raw: bytes, every: int = CHECKPOINT_IDS):
        if len(raw) < _HEAD.size + 4 or zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("block checksum does not match")
        magic, self.lanes, self.n, words, docs, marks, self.start = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a block")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        at += 8 * docs
        self.lengths = np.frombuffer(raw, "<u4", docs, at).astype(np.int64)
        at += 4 * docs
        self.marks = []
        for _ in range(marks):
            self.marks.append((struct.unpack_from("<I", raw, at)[0], np.frombuffer(raw, "<u8", self.lanes, at + 4)))
            at += 4 + 8 * self.lanes
        self.words = np.frombuffer(raw, "<u4", words, at).astype(np.uint64)
        self.each = max(1, every // self.lanes)

    def ids(self, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids [first, last) of the block, decoded from the checkpoint before ``first``."""
        last = self.n if last is None else min(last, self.n)
        if first >= last:
            return np.empty(0, np.uint32)
        mark = first // self.lanes // self.each
        at, state = self.marks[mark]
        x = state.astype(np.uint64)
        begin = mark * self.each
        end = -(-last // self.lanes)
        out = np.empty((end - begin) * self.lanes, np.uint32)
        mask, bits, half = np.uint64((1 << table.bits) - 1), np.uint64(table.bits), np.uint64(32)
        symbol, freq, cum = table.symbol, table.freq, table.cum
        for t in range(begin, end):
            m = min(self.lanes, self.n - t * self.lanes)
            y = x[:m]
            slot = y & mask
            s = symbol[slot]
            out[(t - begin) * self.lanes : (t - begin) * self.lanes + m] = s
            y = freq[s] * (y >> bits) + slot - cum[s]
            low = np.flatnonzero(y < _LOW)
            y[low] = (y[low] << half) | self.words[at : at + len(low)]
            at += len(low)
            x[:m] = y
        return out[first - begin * self.lanes : last - begin * self.lanes]


def _segments(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(part, begin, docs, lengths, ids): runs of whole documents in id order, and
    per task rows with counts of ids (begin -1)."""
    schema = pa.schema([("part", pa.int32()), ("begin", pa.int64()), ("n", pa.int64()), ("docs", pa.binary()), ("lengths", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        part, begin, held, size = None, 0, [], 0

        def flush():
            nonlocal begin, held, size
            ids = np.concatenate([x for _, x in held])
            row = {"part": part, "begin": begin, "n": len(ids), "docs": np.array([i for i, _ in held], "<i8").tobytes(), "lengths": np.array([len(x) for _, x in held], "<u4").tobytes(),
                   "low": ids.astype("<u2").tobytes(), "high": (ids >> 16).astype(np.uint8).tobytes() if ids.max() >> 16 else b""}
            begin, held, size = begin + len(ids), [], 0
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in batches:
            ids_of, parts = b.column("doc_id").to_pylist(), b.column("part").to_pylist()
            for a, _, ids, bounds in encoded(b.column("text"), path, end_id):
                got = np.bincount(ids)
                if len(got) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(got) - len(counts), np.int64)])
                counts[: len(got)] += got
                for k in range(len(bounds) - 1):
                    if held and (parts[a + k] != part or size >= BLOCK_IDS):
                        yield flush()
                    if parts[a + k] != part:
                        part, begin = parts[a + k], 0
                    held.append((ids_of[a + k], ids[bounds[k] : bounds[k + 1]]))
                    size += len(held[-1][1])
        if held:
            yield flush()
        if len(counts):
            yield pa.RecordBatch.from_pylist([{"part": -1, "begin": -1, "n": len(counts), "docs": counts.astype("<i8").tobytes(), "lengths": b"", "low": b"", "high": b""}], schema=schema)

    return docs.mapInArrow(run, "part int, begin long, n long, docs binary, lengths binary, low binary, high binary")


def _counts(segments: DataFrame) -> np.ndarray:
    """Occurrences of every id; as many rows as the vocabulary reach the driver."""
    def run(batches):
        for b in batches:
            for raw in b.column("docs").to_pylist():
                c = np.frombuffer(raw, "<i8")
                k = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(c[k], pa.int64())], names=["id", "n"])

    rows = segments.filter("part = -1").select("docs").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(max(rows.column("id").to_pylist(), default=-1) + 1, np.int64)
    out[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return out


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2) -> None:
    """Encode all texts and write them as blocks in ascending doc_id order under ``path``.

    A null text is empty and a null id sorts first; repeated rows are documents
    of their own; an empty table writes empty files.
    """
    spark = docs.sparkSession
    prepare(spark)
    vocabulary = vocabulary or default_vocabulary()
    rows, n = id_ranges(id_text(docs))
    rows = rows.repartition(n, "part").sortWithinPartitions("part", "doc_id", "text")
    segments = stored(_segments(rows.select("part", "doc_id", "text"), vocabulary, end_id), "token-segments", compression="zstd")
    table = Table.of_counts(_counts(segments))
    spark.createDataFrame([(k, int(f)) for k, f in enumerate(table.freq) if f], "id long, freq long").coalesce(1).write.parquet(f"{path}/table")
    # a row per part, whose number id_ranges bounds
    totals = segments.filter("part >= 0").groupBy("part").agg(F.sum("n").alias("n"))
    base = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    freq = table.freq.astype(np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Table(np.frombuffer(freq, np.uint32))
        for b in batches:
            for start, doc_ids, lengths, low, high in zip(*(b.column(c).to_pylist() for c in ("start", "docs", "lengths", "low", "high")), strict=True):
                ids = np.frombuffer(low, "<u2").astype(np.int64)
                if high:
                    ids = ids | np.frombuffer(high, np.uint8).astype(np.int64) << 16
                raw = encode_block(ids, t, np.frombuffer(doc_ids, "<i8"), np.frombuffer(lengths, "<u4"), start)
                yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([raw], pa.binary())], names=["start", "block"])

    placed = segments.filter("part >= 0").join(F.broadcast(base), "part").select((F.col("base") + F.col("begin")).alias("start"), "docs", "lengths", "low", "high")
    placed.mapInArrow(run, "start long, block binary").write.option("compression", "none").parquet(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/table").toArrow()  # at most the vocabulary
    ids = rows.column("id").to_numpy()
    freq = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
    freq[ids] = rows.column("freq").to_numpy()
    return Table(freq)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, decoded block by block."""
    freq = read_table(spark, path).freq.astype(np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Table(np.frombuffer(freq, np.uint32))
        for b in batches:
            for raw in b.column("block"):
                block = Block(raw.as_py())
                ids = block.ids(t).astype("<u4")
                at = np.concatenate([[0], np.cumsum(block.lengths)])
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                cols = [pa.array(block.doc_ids), pa.array(block.start + at[:-1]), pa.array(block.lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array([ids[a:z].tolist() for a, z in zip(at[:-1], at[1:], strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    out = spark.read.schema("start long, block binary").parquet(f"{path}/blocks").select("block").mapInArrow(run, schema)
    return out.withColumn("doc_id", real_id(F.col("doc_id")))


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``docs`` to token files (under spark.checkpoint.dir if no path is given) and read them back."""
    path = path or f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/llm/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, path)
    return read_token_files(docs.sparkSession, path)
