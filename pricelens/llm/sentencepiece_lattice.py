"""Operator 2: SentencePiece encoding and decoding by a relational lattice.

Texts are cut into units that no piece can cross (two characters that stand side
by side in no piece).  The lattice is built for the distinct units of the corpus:
their substrings of bounded length are exploded and joined with the piece table,
the edges are grouped by unit, and a Spark higher-order aggregate folds them to
ids: Viterbi for unigram models; for BPE models, whose ids Viterbi does not give,
the merges in order of score over the same edges.  The units' ids then come back
to the batches of documents that asked for them.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.batches import ANSWERS, ANSWERS_DDL, ASKS, ASKS_DDL, again, asks, bucket_runs, once, with_batch
from pricelens.llm.common import drop_stored, id_text, pieces, prepare, real_id, stored
from pricelens.llm.words import mixed, run_hashes, running, slices

#: The mark that stands for a space.
SPACE = "▁"
#: Longer units (junk without spaces) are folded in Python, since the fold's state is a 64-bit mask.
LONGEST = 60
BATCH_BYTES, BUCKET_BYTES = 12_000_000, 16_000_000
#: Text whose distinct units one task folds, about.
FOLD_BYTES = 2_000_000
#: Text whose units are found at once.
SLICE = 500_000
#: Units whose edges a task gathers in memory before Spark sorts them instead.
GATHERED = 50_000
UNIGRAM, BPE = 1, 2
#: What the library takes off the smallest score for a character without a piece.
UNKNOWN_PENALTY = 10.0


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message."""
    i = 0

    def varint():
        nonlocal i
        v = k = 0
        while True:
            b = raw[i]
            i += 1
            v |= (b & 127) << k
            k += 7
            if b < 128:
                return v

    while i < len(raw):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if wire == 2 else 4 if wire == 5 else 8
            yield tag >> 3, raw[i : i + n]
            i += n


class Model:
    """Pieces and settings of a model file with the identity normalizer."""

    def __init__(self, raw: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
        top = list(_fields(raw))
        trainer = dict(_fields(next((v for k, v in top if k == 2), b"")))
        normal = dict(_fields(next((v for k, v in top if k == 3), b"")))
        self.type = trainer.get(3, UNIGRAM)
        if self.type not in (UNIGRAM, BPE):
            raise ValueError("the model is neither unigram nor BPE")
        if normal.get(1, b"") not in (b"identity", b"") or normal.get(2) or normal.get(4, 1):
            raise ValueError("the model changes texts before it encodes them")
        self.prefix = bool(normal.get(3, 1))
        ids = range(sp.get_piece_size())
        self.unk = sp.unk_id()
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(sp.is_byte(i) for i in ids) else []
        kept = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in kept]
        self.longest = max(len(p) for p, _, _ in self.pieces)
        self.least = min(s for _, _, s in self.pieces)
        self.size = len(ids)
        self.decoded = [b"" if sp.is_control(i) else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                        " ⁇ ".encode() if sp.is_unknown(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in self.pieces):
            raise ValueError("a piece has a space inside")

    @functools.cached_property
    def joints(self) -> tuple[np.ndarray, np.ndarray]:
        """A small number per character of longer pieces (0 for others), and which two stand side by side in a piece."""
        pairs = {p[k : k + 2] for p, _, _ in self.pieces for k in range(len(p) - 1)}
        chars = sorted({c for p in pairs for c in p})
        number = np.zeros(0x110000, np.uint16)
        number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            beside[number[ord(a)], number[ord(b)]] = True
        return number, beside

    def long_unit(self, unit: str) -> list[int]:
        """Ids of one unit without Spark, in time near its length."""
        table = self.table
        n = len(unit)
        if self.type == UNIGRAM:
            best: list[tuple[float, int, int]] = [(0.0, 0, -1)] + [(-np.inf, 0, -1)] * n
            for a in range(n):
                for b in range(a + 1, min(n, a + self.longest) + 1):
                    i, s = table.get(unit[a:b], (None, self.least - UNKNOWN_PENALTY))
                    if (i is not None or b == a + 1) and best[a][0] + s > best[b][0]:
                        best[b] = (best[a][0] + s, a, -1 if i is None else i)
            ends, b = [], n
            while b:
                ends.append((best[b][1], b, best[b][2]))
                b = best[b][1]
            parts = [(unit[a:b], i) for a, b, i in reversed(ends)]
        else:
            left, right, end = list(range(-1, n)), list(range(1, n + 2)), list(range(1, n + 1))
            heap: list[tuple[float, int, int, int]] = []

            def offer(a):
                b = right[a]
                if a >= 0 and b < n and (hit := table.get(unit[a : end[b]])):
                    heapq.heappush(heap, (-hit[1], a, end[a], end[b]))

            for a in range(n - 1):
                offer(a)
            gone = [False] * n
            while heap:
                _, a, m, e = heapq.heappop(heap)
                if gone[a] or end[a] != m or right[a] >= n or end[right[a]] != e:
                    continue
                b = right[a]
                gone[b], end[a], right[a] = True, e, right[b]
                if right[a] < n:
                    left[right[a]] = a
                offer(a)
                if left[a] >= 0:
                    offer(left[a])
            parts = [(unit[a : end[a]], table.get(unit[a : end[a]], (-1,))[0]) for a in range(n) if not gone[a]]
        out = []
        for s, i in parts:
            out += [i] if i >= 0 else [self.byte_ids[b] for b in s.encode()] if self.byte_ids else [self.unk]
        return out

    @functools.cached_property
    def bytes_of(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The decoded bytes of all ids, and where each one's begin and how many they are."""
        num = np.array([len(x) for x in self.decoded], np.int64)
        return np.frombuffer(b"".join(self.decoded), np.uint8), np.concatenate([[0], np.cumsum(num)[:-1]]), num

    @functools.cached_property
    def table(self) -> dict[str, tuple[int, float]]:
        return {p: (i, s) for p, i, s in self.pieces}


@functools.cache
def model(raw: bytes) -> Model:
    return Model(raw)


@functools.cache
def _char_hash() -> np.ndarray:
    return mixed(np.arange(1, 0x110001, dtype=np.uint64), 0xE7037ED1A0B428DB)


class Units:
    """The units of a slice of documents: code points, bounds, hashes, documents."""

    def __init__(self, m: Model, buf: np.ndarray, offs: np.ndarray):
        raw = buf.tobytes()
        parts = [raw[a:b].decode() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        self.texts = parts
        lead = " " if m.prefix else ""
        self.text = "".join(lead + p if p else "" for p in parts).replace(" ", SPACE)
        self.bounds = np.concatenate([[0], np.cumsum([len(p) + (len(lead) if p else 0) for p in parts])])
        cp = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        number, beside = m.joints
        k = number[cp]
        new = np.ones(len(cp), bool)
        new[1:] = ~beside[k[:-1], k[1:]]
        # a space after another character opens a unit
        new[self.bounds[:-1][self.bounds[:-1] < len(cp)]] = True
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], len(cp)) if len(cp) else self.start
        self.hash = run_hashes(running(_char_hash()[cp]), self.start, self.end) if len(cp) else np.empty(0, np.uint64)
        self.first = np.searchsorted(self.start, self.bounds)

    def fresh(self, seen: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Hashes and texts of the distinct units that are not in the sorted ``seen``, and where there the hashes belong."""
        h, i = np.unique(self.hash, return_index=True)
        at = np.searchsorted(seen, h)
        new = np.ones(len(h), bool)
        inside = at < len(seen)
        new[inside] = seen[at[inside]] != h[inside]
        i = i[new]
        return h[new], [self.text[a:b] for a, b in zip(self.start[i].tolist(), self.end[i].tolist(), strict=True)], at[new]


def distinct_units(docs: DataFrame, raw: bytes, parts: int) -> DataFrame:
    """(key, unit): the distinct units of all texts, dealt to ``parts`` tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = model(raw), np.empty(0, np.uint64)
        for b in batches:
            for _, _, buf, offs in slices(b.column("text"), SLICE):
                h, units, at = Units(m, buf, offs).fresh(seen)
                # a task's own units are told once; the memory of them is bounded
                seen = np.insert(seen, at, h) if len(seen) < 1_000_000 else h
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(units, pa.string())], names=["key", "unit"])

    return docs.select("text").mapInArrow(run, "key long, unit string").repartition(parts, "key", "unit").distinct()


#: The bounds of segments are the bits of b; an edge has its two ends and the bounds inside as masks.
#: Merge the best edge that joins two segments, while there is one; edges that can no longer join any are let go.
_MERGE = """
aggregate(sequence(1, greatest(least(n - 1, size(edges) - n), 1)),
  struct(shiftleft(2L, n) - 1 AS b, filter(edges, x -> x.inner <> 0) AS live),
  (a, i) -> if(size(a.live) = 0, a, transform(
    array(get(filter(a.live, x -> bit_count(a.b & x.all) = 3 AND (a.b & x.ends) = x.ends), 0)), best -> if(best IS NULL,
      struct(a.b AS b, slice(a.live, 1, 0) AS live),
      struct(a.b & ~best.inner AS b, filter(a.live, x -> (a.b & ~best.inner & x.ends) = x.ends AND (a.b & ~best.inner & x.inner) <> 0) AS live)))[0]),
  a -> a.b)
"""
#: Best score up to each place with where its last piece began; the bounds are then read back from the end.
_VITERBI = """
transform(array(aggregate(sequence(1, n), array(struct(0.0D AS score, 0 AS s)), (best, p) -> concat(best, array(
    array_max(transform(filter(edges, x -> x.e = p), x -> struct(best[x.s].score - x.cost AS score, -x.s AS s))))))),
  best -> aggregate(sequence(n, 1), struct(shiftleft(1L, n) AS b, n AS p), (a, i) ->
    if(i = a.p, struct(a.b | shiftleft(1L, -best[i].s) AS b, -best[i].s AS p), a)).b)[0]
"""
#: The edges between neighbouring bounds, from left to right; an id of -1 is a character without a piece.
_IDS = """
flatten(transform(array_sort(transform(filter(edges, x -> (bounds & x.ends) = x.ends AND (bounds & x.inner) = 0), x -> struct(x.s AS s, x.id AS id))),
  x -> if(x.id >= 0, array(x.id), UNKNOWN)))
"""
_BYTES = """
transform(sequence(1, octet_length(substring(unit, x.s + 1, 1))),
  k -> byte_ids[int(conv(substring(hex(encode(substring(unit, x.s + 1, 1), 'UTF-8')), 2 * k - 1, 2), 16, 10))])
"""


def unit_ids(units: DataFrame, raw: bytes) -> DataFrame:
    """(key, ids): the lattice of each unit, folded; read from a stored table."""
    spark, m = units.sparkSession, model(raw)
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(GATHERED))
    # the vocabulary: its size is that of the model file
    table = spark.createDataFrame(m.pieces, "piece string, id int, score double").withColumn("hash", F.xxhash64("piece"))
    units = units.withColumn("n", F.char_length("unit"))
    # longer units come along with one empty edge, so that the texts are cut into units once
    fits = f"n <= {LONGEST}"
    edges = units.withColumn("s", F.explode(F.expr(f"if({fits}, sequence(0, n - 1), array(0))")))
    edges = edges.withColumn("e", F.explode(F.expr(f"if({fits}, sequence(s + 1, least(n, s + {m.longest})), array(0))")))
    # a join by number is the cheaper look-up; the strings decide
    edges = edges.withColumn("part", F.expr("substring(unit, s + 1, e - s)"))
    same = (F.xxhash64("part") == F.col("hash")) & (F.col("part") == F.col("piece"))
    edges = edges.join(F.broadcast(table), same, "left").filter("id IS NOT NULL OR e <= s + 1")
    # in order of cost, then place; only Viterbi asks for the end itself
    edge = F.struct(F.coalesce(-F.col("score"), F.lit(UNKNOWN_PENALTY - m.least)).alias("cost"), "s", F.expr("shiftleft(1L, s) | shiftleft(1L, e)").alias("ends"),
                    F.expr("shiftleft(shiftleft(1L, e - s - 1) - 1, s + 1)").alias("inner"), F.expr("shiftleft(shiftleft(2L, e - s) - 1, s)").alias("all"),
                    F.coalesce("id", F.lit(-1)).alias("id"), *(["e"] if m.type == UNIGRAM else []))
    # no shuffle here: the rows still lie by (key, unit) from the distinct step
    lattice = edges.groupBy("key", "unit").agg(F.array_sort(F.collect_list(edge)).alias("edges")).withColumn("n", F.char_length("unit"))
    fold = lattice.withColumn("bounds", F.expr(_VITERBI if m.type == UNIGRAM else _MERGE)).withColumn("byte_ids", F.array(*map(F.lit, m.byte_ids or [m.unk])))
    ids = F.expr(_IDS.replace("UNKNOWN", _BYTES if m.byte_ids else f"array({m.unk})"))
    folded = stored(fold.select("key", F.when(F.expr(fits), ids).alias("ids"), F.when(~F.expr(fits), F.col("unit")).alias("unit")), "unit-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([model(raw).long_unit(u.as_py()) for u in b.column("unit")], pa.list_(pa.int32()))], names=["key", "ids"])

    long = folded.filter("unit IS NOT NULL").select("key", "unit").mapInArrow(run, "key long, ids array<int>")
    return folded.filter("unit IS NULL").select("key", "ids").unionByName(long)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a list column."""
    a = column.combine_chunks()
    a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
    return a.flatten().to_numpy(zero_copy_only=False), np.diff(a.offsets.to_numpy())


def _gather(values: np.ndarray, start: np.ndarray, num: np.ndarray) -> np.ndarray:
    """The runs [start, start + num) of values, one after another."""
    done = np.concatenate([[0], np.cumsum(num)])
    return values[np.repeat(start - done[:-1], num) + np.arange(done[-1])]


def _answers(spark: SparkSession, questions: DataFrame, ids: DataFrame, buckets: int) -> DataFrame:
    """For each batch and bucket, the packed lengths and ids of its keys."""
    ids = ids.withColumn("bucket", F.expr(f"int(shiftrightunsigned(shiftrightunsigned(key, 32) * {buckets}L, 32))"))

    def run(q: pa.Table, d: pa.Table) -> pa.Table:
        if not q.num_rows:
            return pa.Table.from_pylist([], ANSWERS)
        keys = d.column("key").to_numpy().view(np.uint64)
        values, num = _lists(d.column("ids"))
        order = np.argsort(keys)
        begin = np.concatenate([[0], np.cumsum(num)])[:-1][order]
        keys, num, values = keys[order], num[order], values.astype("<u4")
        out = []
        for x in q.column("keys"):
            at = np.searchsorted(keys, np.frombuffer(x.as_py(), np.uint64))
            out.append(_packed(_gather(values, begin[at], num[at]), num[at]))
        return pa.table([q.column("batch"), q.column("bucket"), pa.array(out, pa.binary())], schema=ANSWERS)

    return questions.groupBy("bucket").cogroup(ids.groupBy("bucket")).applyInArrow(run, ANSWERS_DDL)


def _packed(ids: np.ndarray, num: np.ndarray) -> bytes:
    """Lengths and ids by byte planes, compressed: the shuffle and the table of answers stay small."""
    raw = num.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() + ids.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths) of an answer about n keys."""
    raw = np.frombuffer(pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    num, ids = (np.ascontiguousarray(x.reshape(4, -1).T).view("<u4")[:, 0] if len(x) else np.empty(0, np.uint32) for x in (raw[: 4 * n], raw[4 * n :]))
    return ids, num.astype(np.int64)


def decode(ids: np.ndarray, m: Model) -> str:
    """The text of ids: pieces and byte pieces joined, without the space put before the text."""
    flat, begin, num = m.bytes_of
    out = _gather(flat, begin[ids], num[ids]).tobytes()
    return (out[1:] if m.prefix and out[:1] == b" " else out).decode("utf-8", "replace")


def _ordered(t: pa.Table) -> pa.Table:
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _found(t: pa.Table, m: Model) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
    """(texts, unit hashes, document bounds in units) over slices of a batch."""
    units = (Units(m, buf, offs) for _, _, buf, offs in slices(t.column("text"), SLICE))
    return [(u.texts, u.hash, u.first) for u in units]


def _keys(found: list[tuple[list[str], np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(h) for _, h, _ in found] or [np.empty(0, np.uint64)]))


def encode_documents(docs: DataFrame, path: str | None = None, raw: bytes | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (unless not wanted), ids_crc32, decoded_sha256, exact per row.

    ids_crc32 is over the ids as little-endian unsigned 32-bit integers; the
    decoded text is made from the ids alone and ``exact`` tells whether it equals
    the text.  A null or empty text has no ids; null and repeated ids are kept as
    they are; an empty table gives an empty result.
    """
    if raw is None:
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("piece_bpe_32k.model")
        with open(path, "rb") as f:
            raw = f.read()
    spark = docs.sparkSession
    prepare(spark)
    docs, size, several = once(id_text(docs), BATCH_BYTES)
    n, buckets = pieces(size, BATCH_BYTES), pieces(0.15 * size, BUCKET_BYTES)
    ids = unit_ids(distinct_units(docs, raw, pieces(size, FOLD_BYTES)), raw)
    docs = with_batch(docs, n).groupBy("batch")

    def ask(t: pa.Table) -> pa.Table:
        keys = _keys(_found(t, model(raw)))
        return pa.Table.from_pylist(list(asks(t.column("batch")[0].as_py(), keys, np.zeros(len(keys), "S0"), buckets)), ASKS)

    questions = stored(docs.applyInArrow(ask, ASKS_DDL), "unit-asks")
    answers = stored(_answers(spark, questions, ids, buckets), "unit-answers")
    drop_stored(questions)
    drop_stored(ids)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64())), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()), ("exact", pa.bool_()), ("times", pa.int64())])

    def run(t: pa.Table, a: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], [], []]
        if t.num_rows:
            m = model(raw)
            t = _ordered(t)
            out[-1] = t.column("times").to_pylist()
            found = _found(t, m)
            keys = _keys(found)
            told = dict(zip(a.column("bucket").to_pylist(), a.column("answer").to_pylist(), strict=True))
            parts = [_unpacked(told[k], z - x) for k, x, z in bucket_runs(keys, buckets)]
            values, num = (np.concatenate([p[k] for p in parts] or [np.empty(0, np.int64)]) for k in (0, 1))
            begin = np.concatenate([[0], np.cumsum(num)])[:-1]
            done = 0
            for texts, h, first in found:
                at = np.searchsorted(keys, h)
                got = _gather(values, begin[at], num[at]) if len(at) else np.empty(0, np.uint32)
                bound = np.concatenate([[0], np.cumsum(num[at])])[first] if len(at) else np.zeros(len(first), np.int64)
                names = t.column("doc_id").slice(done, len(texts)).to_pylist()
                done += len(texts)
                for i, text, f, z in zip(names, texts, bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                    own = got[f:z].astype("<u4")
                    back = decode(own, m)
                    for c, v in zip(out[:-1], (i, z - f, own.tolist() if keep_ids else None, zlib.crc32(own.tobytes()), hashlib.sha256(back.encode()).hexdigest(), back == text), strict=True):
                        c.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    rows = docs.cogroup(answers.groupBy("batch")).applyInArrow(run, "doc_id long, n_tokens long, ids array<long>, ids_crc32 long, decoded_sha256 string, exact boolean, times long")
    rows = again(rows, several)
    return (rows if keep_ids else rows.drop("ids")).withColumn("doc_id", real_id(F.col("doc_id")))
