"""Operator 9: quartile bucket digests of documents.

Hashed byte triplets are counted in 128 buckets; each bucket keeps only which
quartile of the bucket counts it lies in (2 bits), and a header keeps the
length on a log scale.  Two digests differ by a bounded score over the header
and the buckets; likeness is one minus its share of the largest score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import id_ranges, id_text, prepare, real_id
from pricelens.llm.words import mixed

BUCKETS = 128
#: Steps of the length code: one per 1.1-fold length.
LENGTH_STEP = 1.1
#: A length gap counts at most this many points; a bucket's quartile gap at most 6.
MAX_LENGTH_POINTS = 32
_GAP = np.array([0, 1, 2, 6], np.int64)
MAX_SCORE = MAX_LENGTH_POINTS + 6 * BUCKETS
_T = [(mixed(np.arange(256, dtype=np.uint64), 1 + k) & np.uint64(BUCKETS - 1)).astype(np.uint8) for k in range(3)]


def digest(data: bytes) -> np.ndarray:
    """Length code, then the quartile (0 to 3) of every bucket; int16."""
    b = np.frombuffer(data, np.uint8)
    if len(b) < 3:
        # too short for triplets: the bytes themselves take the buckets' place
        counts = np.bincount(b & (BUCKETS - 1), minlength=BUCKETS)
    else:
        counts = np.bincount(_T[0][b[:-2]] ^ _T[1][b[1:-1]] ^ _T[2][b[2:]], minlength=BUCKETS)
    ranked = np.sort(counts)
    q1, q2, q3 = ranked[BUCKETS // 4 - 1], ranked[BUCKETS // 2 - 1], ranked[3 * BUCKETS // 4 - 1]
    out = np.empty(BUCKETS + 1, np.int16)
    out[0] = min(255, int(np.log1p(len(b)) / np.log(LENGTH_STEP)))
    out[1:] = (counts > q1).astype(np.int16) + (counts > q2) + (counts > q3)
    return out


def to_hex(d: np.ndarray) -> str:
    q = d[1:].reshape(-1, 4)
    packed = (q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6).astype(np.uint8)
    return bytes([int(d[0])]).hex() + packed.tobytes().hex()


def from_hex(s: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(s), np.uint8)
    q = np.stack([raw[1:] >> k & 3 for k in (0, 2, 4, 6)], axis=1).reshape(-1)
    return np.concatenate([raw[:1], q]).astype(np.int16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, 0 for the largest difference score."""
    score = min(MAX_LENGTH_POINTS, abs(int(a[0]) - int(b[0]))) + int(_GAP[np.abs(a[1:] - b[1:])].sum())
    return 1.0 - score / MAX_SCORE


def _ordered(docs: DataFrame) -> DataFrame:
    """(part, doc_id, text, own) sorted by part and descending id within it.

    A part is a range of ids, larger ids first.  The first document of a part is
    also given, not as its own, at the end of the part before it, and the very
    first at the end of the last: so every document's successor is in its part.
    """
    spark = docs.sparkSession
    docs, n = id_ranges(docs)
    docs = docs.withColumn("part", F.lit(n) - F.col("part"))
    # a row per part, whose number id_ranges bounds
    heads = docs.groupBy("part").agg(F.max(F.struct("doc_id", F.lit(1).alias("one"))).alias("h")).select("part", F.col("h.doc_id").alias("doc_id")).orderBy("part").collect()
    if not heads:
        return docs.select("part", "doc_id", "text", F.lit(True).alias("own"))
    before = {h.doc_id: heads[i - 1].part for i, h in enumerate(heads)}
    marks = spark.createDataFrame([(k, v) for k, v in before.items()], "doc_id long, before int")
    extra = docs.join(F.broadcast(marks), "doc_id").select(F.col("before").alias("part"), "doc_id", "text", F.lit(False).alias("own"))
    extra = extra.groupBy("part", "doc_id", "own").agg(F.min("text").alias("text")).select("part", "doc_id", "text", "own")
    both = docs.select("part", "doc_id", "text", F.lit(True).alias("own")).unionByName(extra)
    return both.repartition(max(len(heads), 1), "part").sortWithinPartitions("part", F.desc("own"), F.desc("doc_id"), "text")


def _edited(text: str, following: str) -> str:
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint every document, its edited text and compare with the next.

    The next document is the one before it by id, after the smallest the largest.
    A null text is empty; a null id sorts last; rows with equal ids go by their
    text; equal texts have equal fingerprints.  A document alone follows itself.
    """
    prepare(docs.sparkSession)
    rows = _ordered(id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row waits for its successor

        def result(row, following, d_next):
            _, i, text, d = row
            edited = _edited(text, following).encode("utf-8", "surrogatepass")
            e = digest(edited)
            return i, len(text), hashlib.sha256(edited).hexdigest(), to_hex(d), to_hex(e), likeness(d, e), likeness(d, d_next)

        for b in batches:
            out = []
            for part, i, text, own in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "text", "own")), strict=True):
                d = digest(text.encode("utf-8", "surrogatepass"))
                if held is not None and held[0] == part:
                    out.append(result(held, text, d))
                held = (part, i, text, d) if own else None
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, x, strict=True)) for x in out], schema=_SCHEMA)

    out = rows.select("part", "doc_id", "text", "own").mapInArrow(run, RESULT)
    return out.withColumn("doc_id", real_id(F.col("doc_id")))


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
