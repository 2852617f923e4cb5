"""Operator 12: Merkle manifest of a dataset as a SHA midstate tree.

Every row is a leaf; per group (language) the leaves, in key order, are joined
by eights into parents until one node is left, the group's subroot; the
subroots, in group order, make the root the same way.  A parent keeps, before
each child slot, a copy of its hash state: to fold a changed child, the state
of its slot is resumed with the replacement and the siblings to its right, and
the siblings to its left are not hashed again.

A task takes 8**4 consecutive nodes of a group, that is four levels, so a
pass over n nodes leaves n / 4096 and a group of any size is split; passes go
up until every group has its subroot.  Coming down, a chunk gets the siblings
above it as one short row, rebuilds the states on that path once, and all its
leaves resume them.  Only digests and ranks are shuffled, no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import prepare, stored

FAN = 8
#: Levels that a task joins at once: it holds FAN**LEVELS nodes.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(values: dict[str, Column]) -> Column:
    """Hex SHA-256 of the fields: ``-`` for a null, else UTF-8 byte count, ``:``, value."""
    def coded(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(coded, values.values())), 256)


def leaves(docs: DataFrame, changed: Column | None = None, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """grp, key, leaf and changed (binary digests): one row per document.

    ``changed`` tells which documents have, in the changed copy that is to be
    verified, the letters A-Z of their text lower-cased; the others' digest is null.
    ``grp`` is never null and sorts as the group does, null first.
    """
    values = {f: F.col(f).cast("long") if f in ("doc_id", "n_chars") else F.col(f).cast("string") for f in fields}
    other = F.unhex(leaf_hash(values | {"text": F.translate(values["text"], _UPPER, _LOWER)})) if changed is not None and "text" in fields else F.lit(None).cast("binary")
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"), F.col(key).cast("long").alias("key"),
                       F.unhex(leaf_hash(values)).alias("leaf"), (F.when(changed, other) if changed is not None else other).alias("changed"))


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition with their position in their group there."""
    last, n = None, 0
    for b in batches:
        at = []
        for g in b.column("grp").to_pylist():
            n = n + 1 if g == last else 0
            last = g
            at.append(n)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], names=[*b.schema.names, "at"])


def ranked(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with ``rank`` (from 0 by ``order`` in each grp) and ``n``, the group's size; stored."""
    part = nodes.withColumn("copy", F.monotonically_increasing_id())  # equal rows are interchangeable and may be parted
    part = part.repartitionByRange("grp", *order, "copy").drop("copy").sortWithinPartitions("grp", *order).withColumn("part", F.spark_partition_id())
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.schema.fields) + ", at long"
    placed = stored(part.mapInArrow(_positions, ddl), name)
    counts = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("m"))
    group = Window.partitionBy("grp")
    before = counts.select("grp", "part", (F.sum("m").over(group.orderBy("part")) - F.col("m")).alias("before"), F.sum("m").over(group).alias("n"))
    return placed.join(before, ["grp", "part"]).withColumn("rank", F.col("before") + F.col("at")).drop("part", "at", "before")


class Parent:
    """A parent's digest, and before each child slot its copied state and the hex siblings right of it."""

    def __init__(self, children: list[bytes]):
        h = hashlib.sha256()
        self.states, self.children = [], children
        for c in children:
            self.states.append(h.copy())
            h.update(c)
        self.digest = h.hexdigest().encode()

    def fold(self, slot: int, replacement: bytes) -> bytes:
        h = self.states[slot].copy()
        h.update(replacement)
        h.update(b"".join(self.children[slot + 1 :]))
        return h.hexdigest().encode()

    def siblings(self, slot: int) -> list[bytes]:
        return self.children[:slot] + self.children[slot + 1 :]


def tree(nodes: list[bytes], total: int, levels: int) -> list[list[Parent]]:
    """Levels of parents over a chunk's hex nodes: all ``levels`` of a group larger than a chunk, else up to one node."""
    out = []
    while len(out) < levels and (total > FAN**levels or len(nodes) > 1):
        out.append([Parent(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in out[-1]]
    return out


def _hex(column: pa.ChunkedArray) -> list[bytes | None]:
    return [x if x is None else x.hex().encode() for x in column.to_pylist()]


def _by_rank(t: pa.Table) -> pa.Table:
    return t.sort_by("rank")


_UP = pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])
_UP_DDL = "grp string, rank long, n long, node binary"


def _up(t: pa.Table, levels: int) -> pa.Table:
    """The node that a chunk's nodes join into."""
    t, chunk = _by_rank(t), FAN**levels
    n, nodes = t.column("n")[0].as_py(), _hex(t.column("node"))
    parents = tree(nodes, n, levels)
    top = parents[-1][0].digest if parents else nodes[0]
    return pa.table([[t.column("grp")[0].as_py()], [t.column("rank")[0].as_py() // chunk], [-(-n // chunk)], [bytes.fromhex(top.decode())]], schema=_UP)


def _chunk(levels: int) -> Column:
    return F.expr(f"rank div {FAN**levels}").alias("chunk")


def passes(nodes: DataFrame, name: str, levels: int) -> list[DataFrame]:
    """grp, rank, n, node of each pass, from the given nodes to one node a group."""
    out = [nodes.select("grp", "rank", "n", "node")]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        joined = out[-1].groupBy("grp", _chunk(levels)).applyInArrow(lambda t: _up(t, levels), _UP_DDL)
        out.append(stored(joined, f"{name}-{len(out)}"))
    return out


def _packed(path: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """Levels of (siblings left, siblings right) as bytes."""
    return b"".join(bytes([len(a), len(b)]) + bytes.fromhex(b"".join(a + b).decode()) for a, b in path)


def _unpacked(path: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    out, at = [], 0
    while at < len(path):
        a, b = path[at], path[at + 1]
        s = [path[at + 2 + 32 * i : at + 34 + 32 * i].hex().encode() for i in range(a + b)]
        out.append((s[:a], s[a:]))
        at += 2 + 32 * (a + b)
    return out


_DOWN = pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])
_DOWN_DDL = "grp string, rank long, path binary, subroot binary, root binary"


def _down(t: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """Paths of a chunk's nodes: the siblings inside the chunk, then those above it."""
    t = _by_rank(t)
    grp, upper, subroot, root = (above.column(c)[0].as_py() for c in ("grp", "path", "subroot", "root"))
    rows, out = tree(_hex(t.column("node")), t.column("n")[0].as_py(), levels), []
    for i, rank in enumerate(t.column("rank").to_pylist()):
        path = []
        for parents in rows:
            p, slot = parents[i // FAN], i % FAN
            path.append((p.children[:slot], p.children[slot + 1 :]))
            i //= FAN
        out.append({"grp": grp, "rank": rank, "path": _packed(path) + upper, "subroot": subroot, "root": root})
    return pa.Table.from_pylist(out, schema=_DOWN)


_FOLDED = pa.schema([("grp", pa.string()), ("key", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])
_FOLDED_DDL = "grp string, key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _fold(t: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """Proof hash and folded root of each leaf of a chunk."""
    t = _by_rank(t)
    upper = [(Parent([*a, b"", *b]), len(a)) for a, b in _unpacked(above.column("path")[0].as_py())]  # an empty child leaves the states as they are
    tail = b"".join(s for p, slot in upper for s in p.siblings(slot))
    grp, subroot, root = above.column("grp")[0].as_py(), above.column("subroot")[0].as_py().hex(), above.column("root")[0].as_py().hex()
    nodes, changed = _hex(t.column("node")), _hex(t.column("changed"))
    rows, out = tree(nodes, t.column("n")[0].as_py(), levels), []
    for i, (key, leaf, other) in enumerate(zip(t.column("key").to_pylist(), nodes, changed, strict=True)):
        now, proof, at = other or leaf, hashlib.sha256(), i
        for parents in rows:
            p, slot = parents[at // FAN], at % FAN
            now = p.fold(slot, now)
            proof.update(b"".join(p.siblings(slot)))
            at //= FAN
        proof.update(tail)
        for p, slot in upper:
            now = p.fold(slot, now)
        out.append({"grp": grp, "key": key, "leaf": leaf.decode(), "subroot": subroot, "root": root, "proof_sha256": proof.hexdigest(), "folded_root": now.decode(), "verified": now.decode() == root})
    return pa.Table.from_pylist(out, schema=_FOLDED)


def _with_above(nodes: DataFrame, above: DataFrame, levels: int):
    """Each chunk of ``nodes`` beside the path of the node it joins into."""
    return nodes.groupBy("grp", _chunk(levels)).cogroup(above.withColumn("chunk", F.col("rank")).groupBy("grp", "chunk"))


def paths(up: list[DataFrame], top: DataFrame, name: str, levels: int, last: int = 0) -> DataFrame:
    """Paths of the nodes of pass ``last`` (those of the top, if it is the top), from the top's."""
    above = top
    for k in range(len(up) - 2, last - 1, -1):
        above = stored(_with_above(up[k], above, levels).applyInArrow(lambda t, a: _down(t, a, levels), _DOWN_DDL), f"{name}-{k}")
    return above


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per leaf: grp, key, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``rows`` come from :func:`leaves`.  Leaves go by key, a null key first, ties
    by digest; rows that are equal count each.  A folded root is made of the
    changed digest where there is one, else of the leaf.  No rows, no result.
    """
    prepare(rows.sparkSession)
    # the ranges are cut from a sample of the stored digests, so the texts are read and hashed once
    own = stored(rows.withColumnRenamed("leaf", "node"), "merkle-digests")
    own = stored(ranked(own, ["key", "node"], "merkle-leaves"), "merkle-ranked")
    up = passes(own, "merkle-up", levels)
    subroots = up[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "node")
    tops = stored(ranked(subroots, ["of"], "merkle-subroots"), "merkle-tops")
    high = passes(tops, "merkle-high", levels)
    root = high[-1].select("grp", "rank", F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("node").alias("root"))
    each = paths(high, root, "merkle-high-paths", levels).select("rank", "path", "root").join(tops.select("rank", "of", F.col("node").alias("subroot")), "rank")
    starts = stored(each.select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("rank"), "path", "subroot", "root"), "merkle-starts")
    above = paths(up, starts, "merkle-paths", levels, last=1)
    return _with_above(own, above, levels).applyInArrow(lambda t, a: _fold(t, a, levels), _FOLDED_DDL)


def verify_documents(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs``, held against a copy in which every document whose
    decimal doc_id has a CRC-32 divisible by 3 has its text's A-Z lower-cased.

    A null doc_id or text is left as it is.
    """
    told = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0, F.lit(False)) & F.col("text").isNotNull()
    return manifest(leaves(docs, told), levels).select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
