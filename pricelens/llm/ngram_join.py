"""Operator 1: exact n-gram Jaccard join by set relations.

Sets are the distinct 5-word shingles of a document; two link at a Jaccard
similarity of 0.8.  Equal sets are one class with one representative.  Over the
representatives:

1. A set is a candidate only if enough of its smallest shingles (by hash) occur
   in another set; the bound is that of the prefix filter, so none is lost.
2. The candidates' shingles are ordered by frequency, rare first, and the prefix
   of each set goes to inverted lists.
3. Each list has a leader, the set with the fewest shingles of its own.  Members
   are compared with their leaders alone, which links most of a group of copies.
4. Index-level skipping: what is left of a list is held in blocks by size and
   position.  Two blocks meet only if their sizes and positions allow a link and
   they are not of one component; other blocks are skipped whole.
5. Answer-level skipping: with x and y compared with a common leader p, the
   overlap of x and y lies between |x^p| + |y^p| - |p| and the smaller of
   |x^p| + |y| - |y^p| - own(y) and |y^p| + |x| - |x^p| - own(x), where own()
   counts the shingles that no other set has.  Pairs the bounds decide are
   answered from the leader's answers; only the others are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.batches import ASKS, ASKS_DDL, answer, answered, asks, once, row_key, with_batch
from pricelens.llm.common import id_text, pieces, prepare, real_id, stored
from pricelens.llm.components import components
from pricelens.llm.words import SLICE, Words, slices

WORDS = 5
BATCH_BYTES, BUCKET_BYTES = 6_000_000, 16_000_000
#: Members of a block of an inverted list, about.
BLOCK = 64
#: Positions of a block.
STEP = 8


def _least(n):
    """Overlap that a set of n needs with any partner: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def _prefix(n):
    return n - _least(n) + 1


def _sample(n):
    """How many of its smallest shingles a set asks about: two prefixes."""
    return np.minimum(n, 2 * _prefix(n))


def _needed(n):
    """How many of the asked shingles must be shared for a partner to be possible.

    If x's sample ends first, all but |x| - ceil(0.8 |x|) of it are in y's; if
    y's does, the same holds for y, whose size is at least ceil(0.8 |x|).
    """
    m = _least(n)
    return _sample(m) - _prefix(m) + 1


def shingle_sets(t, words: int = WORDS) -> Iterator[np.ndarray]:
    for _, _, buf, offs in slices(t, SLICE):
        yield from Words(buf, offs, lower=True).shingles(words)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def set_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_shingles, digest): ``row`` names id and text; the digest names the set, null for an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, d = [], []
            for s in shingle_sets(b.column("text")):
                n.append(len(s))
                d.append(_digest(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(n, pa.int64()), pa.array(d, pa.binary())], names=["doc_id", "row", "n_shingles", "digest"])

    return docs.select("doc_id", "text", row_key().alias("row")).mapInArrow(run, "doc_id long, row long, n_shingles long, digest binary")


def _own(t: pa.Table, side: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(id, set) of a batch's representatives."""
    wanted = {(i, d) for i, d in zip(side.column("rep").to_pylist(), side.column("digest").to_pylist(), strict=True) if d is not None}
    ids = {i for i, _ in wanted}
    t = t.filter(pa.array([i in ids for i in t.column("doc_id").to_pylist()], pa.bool_()))
    for i, s in zip(t.column("doc_id").to_pylist(), shingle_sets(t.column("text")), strict=True):
        if len(s) and (i, d := _digest(s)) in wanted:
            wanted.discard((i, d))
            yield i, s


def _sampled(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct asked shingles of a batch, and whether several sets have them."""
    keys, n = np.unique(np.concatenate([s[: _sample(len(s))] for s in sets] or [np.empty(0, np.uint64)]), return_counts=True)
    return keys, (n > 1).astype(np.uint8)


def _shared(group, starts, vals):
    size = np.diff(np.append(starts, len(group)))
    return ((np.maximum.reduceat(vals, starts) > 0) | (size > 1))[group]


def _frequency(group, starts, vals):
    """Number of sets, exact to 100, then in steps of a quarter of a doubling."""
    n = np.add.reduceat(vals.astype(np.int64), starts)
    code = np.where(n <= 100, n, np.minimum(255, 100 + 4 * np.log2(np.maximum(n, 1) / 100)))
    return code.astype(np.uint8)[group]


def candidate_sets(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(sid, n, shingles): representatives that can have a partner, with their sets."""
    docs, size, _ = once(docs, BATCH_BYTES)
    n_batches, buckets = pieces(size, BATCH_BYTES), pieces(0.7 * size, BUCKET_BYTES)
    docs = with_batch(docs, n_batches).groupBy("batch")
    side = reps.withColumn("batch", F.pmod("row", F.lit(n_batches))).select("batch", "rep", "digest")

    def ask(t: pa.Table, own: pa.Table) -> pa.Table:
        if not t.num_rows or not own.num_rows:
            return pa.Table.from_pylist([], ASKS)
        keys, several = _sampled([s for _, s in _own(t, own)])
        return pa.Table.from_pylist(list(asks(t.column("batch")[0].as_py(), keys, several, buckets)), ASKS)

    answers = stored(answer(docs.cogroup(side.groupBy("batch")).applyInArrow(ask, ASKS_DDL), _shared, "u1"), "shared-shingles")
    both = side.withColumns({"bucket": F.lit(None).cast("int"), "answer": F.lit(None).cast("binary")}).unionByName(
        answers.withColumns({"rep": F.lit(None).cast("long"), "digest": F.lit(None).cast("binary")}))
    schema = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])

    def choose(t: pa.Table, own: pa.Table) -> pa.Table:
        out = []
        if t.num_rows and own.num_rows:
            sets = list(_own(t, own))
            keys, _ = _sampled([s for _, s in sets])
            got = answered(keys, [r for r in own.select(["bucket", "answer"]).to_pylist() if r["bucket"] is not None], buckets)
            for i, s in sets:
                n = len(s)
                if got[np.searchsorted(keys, s[: _sample(n)])].sum() >= _needed(n):
                    out.append({"sid": i, "n": n, "shingles": s.tobytes()})
        return pa.Table.from_pylist(out, schema)

    return docs.cogroup(both.groupBy("batch")).applyInArrow(choose, "sid long, n long, shingles binary")


def inverted_lists(sets: DataFrame) -> DataFrame:
    """(token, sid, n, pos, own): the prefixes by frequency, without shingles of one set."""
    size = sets.agg(F.sum(F.length("shingles"))).first()[0] or 0
    n_batches, buckets = pieces(size, 2 * BATCH_BYTES), pieces(size, BUCKET_BYTES)
    sets = sets.withColumn("batch", F.pmod(F.xxhash64("sid"), F.lit(n_batches)))

    def tokens(t: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x.as_py(), np.uint64) for x in t.column("shingles")]

    def ask(t: pa.Table) -> pa.Table:
        keys, n = np.unique(np.concatenate(tokens(t)), return_counts=True)
        return pa.Table.from_pylist(list(asks(t.column("batch")[0].as_py(), keys, n.astype(np.uint32), buckets)), ASKS)

    answers = stored(answer(sets.groupBy("batch").applyInArrow(ask, ASKS_DDL), _frequency, "u4"), "shingle-frequency")
    schema = pa.schema([("token", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("pos", pa.int64()), ("own", pa.int64())])

    def prefixes(t: pa.Table, a: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.Table.from_pylist([], schema)
        found = tokens(t)
        keys = np.unique(np.concatenate(found))
        code = answered(keys, a.to_pylist(), buckets)
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        for sid, s in zip(t.column("sid").to_pylist(), found, strict=True):
            c = code[np.searchsorted(keys, s)]
            order = np.lexsort((s, c))[: _prefix(len(s))]
            pos = np.flatnonzero(c[order] > 1)
            k = len(pos)
            for col, v in zip(cols, (s[order[pos]].view(np.int64), np.full(k, sid), np.full(k, len(s)), pos, np.full(k, int((c == 1).sum()))), strict=True):
                col.append(v)
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in cols], schema=schema)

    return sets.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(prefixes, "token long, sid long, n long, pos long, own long")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the overlap and the sizes of their sets."""
    left = pairs.join(sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            o = [len(np.intersect1d(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), assume_unique=True)) for x, y in zip(t.column("sa"), t.column("sb"), strict=True)]
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(o, pa.int64()), t.column("na"), t.column("nb")], names=["a", "b", "o", "na", "nb"])

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long, o long, na long, nb long")


LINKED = "100 * o >= 80 * (na + nb - o)"


def _leaders(lists: DataFrame) -> DataFrame:
    least = lists.groupBy("token").agg(F.min(F.struct("own", "sid", "n", "pos")).alias("p"), F.count(F.lit(1)).alias("members"))
    return least.select("token", F.col("p.sid").alias("leader"), F.col("p.n").alias("leader_n"), F.col("p.pos").alias("leader_pos"), "members").filter("members > 1")


def _open_blocks(lists: DataFrame, leaders: DataFrame, compared: DataFrame, parts: DataFrame) -> DataFrame:
    """Blocks of the lists that hold more than one component: by token, size and position."""
    rows = lists.join(parts.select(F.col("node").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    rows = stored(rows, "list-components")
    open_ = rows.groupBy("token").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1").select("token")
    rows = rows.join(stored(open_.join(leaders.select("token", "leader", "leader_n", "members"), "token"), "open-lists"), "token")
    known = compared.select(F.col("a").alias("sid"), F.col("b").alias("leader"), "o")
    rows = rows.join(known, ["sid", "leader"], "left").withColumn("o", F.when(F.col("sid") == F.col("leader"), F.col("n")).otherwise(F.coalesce("o", F.lit(-1))))
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")
    place = F.floor(F.col("pos") / STEP).cast("int")
    salt = F.pmod(F.xxhash64("component"), F.greatest(F.lit(1), F.floor(F.col("members") / BLOCK)))
    part = F.pmod(F.xxhash64("sid"), F.greatest(F.lit(1), F.floor(F.col("members") / BLOCK)))
    return (rows.groupBy("token", size.alias("size"), place.alias("place"), salt.alias("salt"), part.alias("part"), "leader", "leader_n")
            .agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("pos0"), F.min("component").alias("c0"), F.max("component").alias("c1"),
                 F.collect_list(F.struct("sid", "n", "pos", "component", "o", "own")).alias("members")))


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sure", pa.bool_())])


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """(a, b, sure): pairs of different components that the blocks and the leaders' answers leave open.

    ``sure`` pairs are linked by the bounds alone.
    """
    blocks = blocks.withColumn("id", F.struct("size", "place", "salt", "part"))
    left = blocks.select(*(F.col(c).alias(f"x_{c}") for c in ("n0", "n1", "pos0", "c0", "c1", "members", "id")), "token", "leader_n")
    right = blocks.select(*(F.col(c).alias(f"y_{c}") for c in ("n0", "n1", "pos0", "c0", "c1", "members", "id")), "token")
    meets = ((F.col("x_id") <= F.col("y_id")) & (5 * F.col("x_n1") >= 4 * F.col("y_n0")) & (5 * F.col("y_n1") >= 4 * F.col("x_n0"))
             & (9 * (F.col("x_pos0") + F.col("y_pos0")) <= F.col("x_n1") + F.col("y_n1"))
             & ~((F.col("x_c0") == F.col("y_c1")) & (F.col("x_c1") == F.col("y_c0"))))
    both = left.join(right, "token").filter(meets).select("leader_n", "x_members", "y_members")

    def columns(members) -> list[np.ndarray]:
        return [np.array([m[k] for m in members], np.int64) for k in ("sid", "n", "pos", "component", "o", "own")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for p, xs, ys in zip(t.column("leader_n").to_pylist(), t.column("x_members").to_pylist(), t.column("y_members").to_pylist(), strict=True):
                x, y = ([c[:, None] for c in columns(xs)], [c[None, :] for c in columns(ys)])
                total = x[1] + y[1]
                ok = (x[3] != y[3]) & (9 * (x[2] + y[2]) <= total) & (5 * x[1] >= 4 * y[1]) & (5 * y[1] >= 4 * x[1])
                known = (x[4] >= 0) & (y[4] >= 0)
                most = np.minimum(x[4] + y[1] - y[4] - y[5], y[4] + x[1] - x[4] - x[5])
                ok &= ~known | (9 * most >= 4 * total)
                i, j = np.nonzero(ok)
                if len(i):
                    least = np.where(known, x[4] + y[4] - p, 0)[i, j]
                    a, b = x[0][i, 0], y[0][0, j]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(9 * least >= 4 * total[i, j])], schema=PAIRS)

    pairs = both.mapInArrow(run, "a long, b long, sure boolean")
    return pairs.groupBy("a", "b").agg(F.max("sure").alias("sure"))


def ngram_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``.

    A null or wordless text is empty, has no shingles and links with nothing; a
    null id is smaller than all others (and a null component); repeated rows are
    copies of one another; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    docs = id_text(docs)
    digests = stored(set_digests(docs), "set-digests")
    reps = stored(digests.filter("n_shingles > 0").groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("least")).select("digest", F.col("least.doc_id").alias("rep"), "least.row"), "set-classes")
    sets = stored(candidate_sets(docs, reps), "candidate-sets")
    lists = stored(inverted_lists(sets), "inverted-lists")
    leaders = stored(_leaders(lists), "leaders")
    near = (lists.join(leaders, "token").filter("sid <> leader and 9 * (pos + leader_pos) <= n + leader_n and 5 * n >= 4 * leader_n and 5 * leader_n >= 4 * n")
            .select(F.col("sid").alias("a"), F.col("leader").alias("b")).distinct())
    compared = stored(overlaps(near, sets), "leader-overlaps")
    stars = compared.filter(LINKED).select("a", "b")
    pairs = stored(_block_pairs(_open_blocks(lists, leaders, compared, components(stars))), "open-pairs")
    more = overlaps(pairs.filter(~F.col("sure")).select("a", "b"), sets).filter(LINKED).select("a", "b")
    parts = components(stars.unionByName(more).unionByName(pairs.filter("sure").select("a", "b")))
    classes = reps.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    # empty sets have no class: joining them would bring their null keys together
    full = digests.filter("n_shingles > 0").join(stored(classes, "class-components"), "digest").select("doc_id", "n_shingles", "component_id")
    out = full.unionByName(digests.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.select(real_id(F.col("doc_id")).alias("doc_id"), "n_shingles", real_id(F.col("component_id")).alias("component_id"))
