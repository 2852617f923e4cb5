"""Operator 3: removal of repeated passages, found by difference-cover anchors.

A passage is 50 words.  Of every 31 word positions, the 6 of a perfect
difference cover are anchors: any two positions modulo 31 have a common shift of
less than 31 that makes both anchors.  So two equal passages, wherever they
stand, share an aligned anchor whose 20 words lie inside both.  Only anchors that
occur in two documents are extended to the passages around them, which are then
compared by their hash and smallest document id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.batches import ASKS, ASKS_DDL, again, answer, answered, asks, once, with_batch
from pricelens.llm.common import id_text, pieces, prepare, real_id, stored
from pricelens.llm.words import SLICE, Words, slices

WINDOW = 50
PERIOD = 31
#: A perfect difference cover of 31: the differences of two members are all residues.
COVER = (1, 5, 11, 24, 25, 27)
#: Words of an anchor: what is sure to be left of a window after a shift below the period.
ANCHOR = WINDOW - PERIOD + 1

_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[list(COVER)] = True
#: Text of a batch, and of the keys of a bucket.
BATCH_BYTES, BUCKET_BYTES = 6_000_000, 16_000_000


def _words(t: pa.Table) -> Iterator[tuple[np.ndarray, Words]]:
    """(document ids, words) over slices of a batch, in id and text order."""
    ids = t.column("doc_id").to_numpy()
    for a, b, buf, offs in slices(t.column("text"), SLICE):
        yield ids[a:b], Words(buf, offs)


def _anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, hash, document) of the anchors: cover positions with 20 words in the document."""
    h, whole = w.windows(ANCHOR)
    doc = np.repeat(np.arange(len(w)), w.counts)
    place = np.arange(len(h)) - w.first[doc] if len(h) else np.empty(0, np.int64)
    at = np.flatnonzero(whole & _IN_COVER[place % PERIOD])
    return at, h[at], doc[at]


def _distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest document id of each, and whether it has several."""
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(k)) - 1
    return k[at], d[at], d[last] != d[at] if len(k) else np.empty(0, bool)


def _anchor_keys(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [(h, ids[d]) for ids, w in _words(t) for _, h, d in [_anchors(w)]]
    return _distinct(np.concatenate([x for x, _ in parts] or [np.empty(0, np.uint64)]), np.concatenate([x for _, x in parts] or [np.empty(0, np.int64)]))


def _passages(t: pa.Table, shared: np.ndarray) -> Iterator[tuple[np.ndarray, Words, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, words, index, hash, document) of the windows that hold a shared anchor."""
    for ids, w in _words(t):
        at, h, _ = _anchors(w)
        found = np.searchsorted(shared, h)
        hit = at[(found < len(shared)) & (shared[np.minimum(found, len(shared) - 1)] == h)] if len(shared) else at[:0]
        g, whole = w.windows(WINDOW)
        near = np.zeros(len(g) + 1, np.int64)
        np.add.at(near, np.maximum(hit - (WINDOW - ANCHOR), 0), 1)
        np.add.at(near, hit + 1, -1)
        doc = np.repeat(np.arange(len(w)), w.counts)
        i = np.flatnonzero((np.cumsum(near[:-1]) > 0) & whole)
        yield ids, w, i, g[i], doc[i]


def _shared(group: np.ndarray, starts: np.ndarray, vals: np.ndarray) -> np.ndarray:
    """An anchor is shared if a batch has it in several documents, or several batches have it."""
    size = np.diff(np.append(starts, len(group)))
    return ((np.maximum.reduceat(vals, starts) > 0) | (size > 1))[group]


def _earlier(group: np.ndarray, starts: np.ndarray, vals: np.ndarray) -> np.ndarray:
    """Whether another batch has the passage in a document with a smaller id."""
    return np.minimum.reduceat(vals, starts)[group] < vals


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _ordered(t: pa.Table) -> pa.Table:
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")])


class _Plan:
    """The batches of a corpus and the answers so far."""

    def __init__(self, docs: DataFrame):
        docs, size, self.several = once(docs, BATCH_BYTES)
        self.batches = pieces(size, BATCH_BYTES)
        self.buckets = pieces(0.35 * size, BUCKET_BYTES)
        self.docs = with_batch(docs, self.batches)

    def passages_answered(self) -> DataFrame:
        """Answers of both rounds, told apart by ``round``."""
        buckets = self.buckets

        def ask_anchors(t: pa.Table) -> pa.Table:
            t = _ordered(t)
            keys, _, several = _anchor_keys(t)
            return _table(list(asks(t.column("batch")[0].as_py(), keys, several.astype(np.uint8), buckets)), ASKS)

        first = stored(answer(self.docs.groupBy("batch").applyInArrow(ask_anchors, ASKS_DDL), _shared, "u1"), "anchors")

        def ask_passages(t: pa.Table, a: pa.Table) -> pa.Table:
            t = _ordered(t)
            if not t.num_rows:
                return _table([], ASKS)
            found = list(_passages(t, _shared_keys(t, a, buckets)))
            keys, least, _ = _distinct(np.concatenate([h for _, _, _, h, _ in found]), np.concatenate([ids[d] for ids, _, _, _, d in found]))
            return _table(list(asks(t.column("batch")[0].as_py(), keys, least, buckets)), ASKS)

        questions = self.docs.groupBy("batch").cogroup(first.groupBy("batch")).applyInArrow(ask_passages, ASKS_DDL)
        second = stored(answer(questions, _earlier, "i8"), "passages")
        return first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))


def _shared_keys(t: pa.Table, answers: pa.Table, buckets: int) -> np.ndarray:
    keys, _, _ = _anchor_keys(t)
    return keys[answered(keys, answers.to_pylist(), buckets) > 0]


def _cover(t: pa.Table, answers: pa.Table, buckets: int) -> Iterator[tuple[np.ndarray, Words, np.ndarray]]:
    """(ids, words, removed) over the slices of a batch."""
    import pyarrow.compute as pc
    first, second = (answers.filter(pc.equal(answers.column("round"), k)) for k in (1, 2))
    found = list(_passages(t, _shared_keys(t, first, buckets)))
    keys, least, _ = _distinct(np.concatenate([h for _, _, _, h, _ in found]), np.concatenate([ids[d] for ids, _, _, _, d in found]))
    earlier = answered(keys, second.to_pylist(), buckets) > 0
    for ids, w, i, h, d in found:
        k = np.searchsorted(keys, h)
        hit = i[earlier[k] | (least[k] < ids[d])] if len(keys) else i
        cover = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, np.minimum(hit + WINDOW, len(w.start)), -1)
        yield ids, w, np.cumsum(cover[:-1]) > 0


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string()), ("source_digest", pa.binary()), ("times", pa.int64())])


def dedup_passages(docs: DataFrame, keep_text: bool = True, keep_source: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept (unless not wanted), kept_sha256 per row, and the
    input text's md5 as source_digest if wanted.

    Removes every word inside a window of 50 words whose words also start a
    window in a document with a smaller id, judged on the input.  A null text
    has no words; a null id is smaller than all others; repeated rows with one
    id are one document and do not remove each other's words; an empty table
    gives an empty result.  Kept words are joined by one space.
    """
    prepare(docs.sparkSession)
    plan = _Plan(id_text(docs))
    answers = plan.passages_answered()
    buckets = plan.buckets

    def run(t: pa.Table, a: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], [], []]
        if t.num_rows:
            t = _ordered(t)
            out[-1] = t.column("times").to_pylist()
            for ids, w, gone in _cover(t, a, buckets):
                raw = w.buf.tobytes()
                n_gone = np.concatenate([[0], np.cumsum(gone)])
                for k, (i, f, z) in enumerate(zip(ids.tolist(), w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
                    removed = int(n_gone[z] - n_gone[f])
                    words = raw[w.offs[k] : w.offs[k + 1]].split()
                    if removed:
                        words = [x for x, g in zip(words, gone[f:z].tolist(), strict=True) if not g]
                    kept = b" ".join(words)
                    for c, v in zip(out[:-1], (i, z - f, removed, kept.decode() if keep_text else None, hashlib.sha256(kept).hexdigest(),
                                         hashlib.md5(raw[w.offs[k] : w.offs[k + 1]]).digest() if keep_source else None), strict=True):
                        c.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, RESULT, strict=True)], schema=RESULT)

    out = plan.docs.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string, source_digest binary, times long")
    out = again(out, plan.several)
    out = out if keep_text else out.drop("kept")
    out = out if keep_source else out.drop("source_digest")
    return out.withColumn("doc_id", real_id(F.col("doc_id")))
