"""Forests and boosted trees of many keys, grown together.

All trees of all keys grow level by level in one job a level: each block of
rows sends, for every open node of its key's trees, the non-empty cells of the
node's (feature, bin) histogram; the cells of a (key, tree, node) meet in a
group, are summed, and the group decides the node's split.  The number of jobs
follows the depth, not the number of keys or trees.  A node with at most
``local_rows`` rows is sent to one task that grows what is left below it, so
most nodes take no job of their own (Panda et al., "PLANET", VLDB 2009).

Sums are kept in whole numbers (targets in fixed point, bootstrap weights and
sampled features from hashes of row, tree and node), so a tree does not depend
on partitioning, on the other keys, or on where it was grown.

A node's id is 1 for the root, 2i and 2i+1 for the children of i; rows with
``feature <= threshold`` go left.
"""

from __future__ import annotations

import itertools
import json
import math
import threading
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators.stats import attach, broadcast_if_small
from pricelens.session import checkpoint_dir, ship_package
from pricelens.sources.store import remove

#: Rows in a block of binned rows, and in a chunk that is scored at once.
BLOCK = 50_000
#: Trees that a task grows or counts at once.
TREES = 5
#: Cells of the dense histograms of a level that a task holds; a wider level goes by its non-empty cells.
DENSE = 1_000_000


@dataclass(frozen=True)
class TreeSpec:
    kind: str = "forest"  # or "boost"
    trees: int = 100
    depth: int = 8
    min_leaf: int = 1
    min_split: int = 2
    features: float | str = 1.0  # share (or "sqrt") of the features tried: per node of a forest, per boosted tree
    step: float = 0.1  # boost: share of each tree's prediction that is added
    subsample: float = 1.0  # boost: share of the rows a tree sees; a forest draws with replacement
    bootstrap: bool = True
    l1: float = 0.0  # penalties of a node's value, in the target's unit
    l2: float = 0.0
    min_gain: float = 0.0  # squared error (or weighted Gini impurity) that a split must explain
    bins: int = 64
    seed: int = 42
    local_rows: int = 32_768  # a node with at most so many rows is grown by one task
    boost_rows: int = 200_000  # a key with at most so many rows is boosted by one task

    def tried(self, n: int) -> int:
        return max(1, int(math.sqrt(n)) if self.features == "sqrt" else int(round(n * float(self.features))))


    def scaled(self, scale: float) -> TreeSpec:
        """The settings in the fixed-point unit of a target."""
        return replace(self, l1=self.l1 * scale, min_gain=self.min_gain * scale**2)


# -- numbers that depend on content alone ------------------------------------------------
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _seed(spec: TreeSpec, key: str, tree: int) -> np.ndarray:
    return _mix(np.array([(spec.seed << 40) ^ (tree << 32) ^ zlib.crc32(key.encode())], _U))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def row_weights(hashes: np.ndarray, spec: TreeSpec, key: str, tree: int) -> np.ndarray:
    """How often a tree sees each row."""
    if spec.kind == "forest" and not spec.bootstrap or spec.kind == "boost" and spec.subsample >= 1:
        return np.ones(len(hashes), np.int64)
    u = (_mix(hashes ^ _seed(spec, key, tree)) >> _U(11)).astype(np.float64) / 2.0**53
    if spec.kind == "boost":
        return (u < spec.subsample).astype(np.int64)
    return np.searchsorted(_POISSON, u, side="right").astype(np.int64)


def allowed(spec: TreeSpec, key: str, tree: int, nodes: np.ndarray, n: int) -> np.ndarray | None:
    """[node, feature]: the features that a node may split on; None for all."""
    k = spec.tried(n)
    if k >= n:
        return None
    at = nodes.astype(_U) if spec.kind == "forest" else np.zeros(len(nodes), _U)
    draw = _mix(_mix(at ^ _seed(spec, key, tree))[:, None] ^ np.arange(1, n + 1, dtype=_U)[None, :])
    out = np.zeros((len(nodes), n), bool)
    np.put_along_axis(out, np.argsort(draw, axis=1)[:, :k], True, axis=1)
    return out


# -- histograms and splits ---------------------------------------------------------------
def dense_sums(rank: np.ndarray, columns: np.ndarray, stats: np.ndarray, m: int, bins: int) -> np.ndarray:
    """[statistic, node, feature, bin]: sums of the rows' statistics; ``columns`` holds a row of bins per feature."""
    out, ones = np.empty((stats.shape[1], m, len(columns), bins)), stats.shape[1] == 2 and bool((stats[:, 0] == 1).all())
    weights = [None if ones and k == 0 else np.ascontiguousarray(s, float) for k, s in enumerate(stats.T)]
    base = rank * bins
    for f, column in enumerate(columns):
        at = base + column
        for k, w in enumerate(weights):
            out[k, :, f, :] = np.bincount(at, w, m * bins).reshape(m, bins)
    return out


def cells_of(rank: np.ndarray, columns: np.ndarray, stats: np.ndarray, m: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-empty (node, feature, bin) cells, ascending, and the sums of the rows' statistics in each."""
    n, width = columns.shape[1], len(columns) * bins
    if m * width <= min(4 * n * len(columns), DENSE):
        sums = dense_sums(rank, columns, stats, m, bins).reshape(stats.shape[1], -1)
        cells = np.flatnonzero(sums[0] if stats.shape[1] == 2 else sums.any(0))
        return cells, sums[:, cells].T.astype(np.int64)
    flat = (columns + (np.arange(len(columns)) * bins)[:, None] + rank * width).ravel()
    order = np.argsort(flat)
    flat = flat[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    return flat[start], np.add.reduceat(stats[order % n], start, axis=0)


def tried_cells(rank: np.ndarray, columns: np.ndarray, stats: np.ndarray, bins: int, tried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same cells, of the features alone that each node tries ([node, feature] true)."""
    n = len(columns)
    f = np.argsort(~tried, axis=1, kind="stable")[:, : int(tried[0].sum())][rank]
    flat = ((rank[:, None] * n + f) * bins + columns[f, np.arange(len(rank))[:, None]]).ravel()
    order = np.argsort(flat)
    flat = flat[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    return flat[start], np.add.reduceat(stats[order // f.shape[1]], start, axis=0)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of several blocks together."""
    cells = np.concatenate([c for c, _ in parts])
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    start = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    return cells[start], np.add.reduceat(np.concatenate([s for _, s in parts])[order], start, axis=0)


def score(stats: np.ndarray, spec: TreeSpec, weights: np.ndarray | None) -> np.ndarray:
    """What nodes explain, by [statistic, ...]: of squared error (weight, sum), or of Gini impurity (class counts)."""
    if weights is None:
        s = np.maximum(np.abs(stats[1].astype(float)) - spec.l1, 0.0) if spec.l1 else stats[1].astype(float)
        return s**2 / np.maximum(stats[0] + spec.l2, 1e-300)
    w = stats * weights.reshape(-1, *[1] * (stats.ndim - 1))
    return (w * w).sum(0) / np.maximum(w.sum(0), 1e-300)


def count(stats: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    return stats[0] if weights is None else stats.sum(0)


def _gains(left: np.ndarray, total: np.ndarray, spec: TreeSpec, weights: np.ndarray | None) -> np.ndarray:
    """Gain of each cut that leaves ``left`` of ``total`` on the left; -inf where it is not one."""
    right, whole = total - left, score(total, spec, weights)
    gain = score(left, spec, weights) + score(right, spec, weights) - whole
    least = max(spec.min_leaf, 1)
    ok = (count(left, weights) >= least) & (count(right, weights) >= least) & (gain > np.maximum(spec.min_gain, 1e-9 * whole))
    return np.where(ok, gain, -np.inf)


Splits = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def dense_splits(sums: np.ndarray, spec: TreeSpec, weights: np.ndarray | None, may: np.ndarray | None) -> Splits:
    """(node, feature, bin, gain) of the nodes that split; ties take the first feature, then the first bin."""
    _, m, n, bins = sums.shape
    left = np.cumsum(sums, axis=3)
    gain = _gains(left, left[..., -1:], spec, weights)
    if may is not None:
        gain[~may] = -np.inf
    gain = gain.reshape(m, n * bins)
    at = gain.argmax(1)
    best = gain[np.arange(m), at]
    node = np.flatnonzero(best > -np.inf)
    return node, at[node] // bins, at[node] % bins, best[node]


def best_splits(cells: np.ndarray, stats: np.ndarray, n: int, spec: TreeSpec, weights: np.ndarray | None, may: np.ndarray | None) -> Splits:
    """The same from non-empty cells alone."""
    group = cells // spec.bins
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(cells)])
    upto = np.cumsum(stats, axis=0)
    before = np.repeat(upto[start] - stats[start], size, axis=0)
    total = np.repeat(upto[start + size - 1], size, axis=0) - before
    gain = _gains((upto - before).T, total.T, spec, weights)
    node = group // n
    if may is not None:
        gain[~may[node, group % n]] = -np.inf
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    best = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero((gain == np.repeat(best, np.diff(np.r_[first, len(cells)]))) & (gain > -np.inf))
    _, at = np.unique(node[hit], return_index=True)
    at = hit[at]
    return node[at], group[at] % n, cells[at] % spec.bins, gain[at]


def _depth(node: int) -> int:
    return int(node).bit_length() - 1


def columns_of(bins: np.ndarray) -> np.ndarray:
    """A row of bins per feature."""
    return np.ascontiguousarray(bins.T, np.int64)


def _sums_of_level(rank: np.ndarray, rows: np.ndarray, columns: np.ndarray, stats: np.ndarray, m: int, bins: int, parents: np.ndarray | None) -> np.ndarray:
    """Dense sums of all nodes of a level; of two siblings the smaller is counted, the other is its parent less it."""
    if parents is None:
        return dense_sums(rank, columns if len(rows) == columns.shape[1] else columns[:, rows], stats[rows], m, bins)
    size = np.bincount(rank, minlength=m)
    second = size[1::2] < size[0::2]
    few = (rank & 1) == second[rank >> 1]
    small = dense_sums(rank[few] >> 1, columns[:, rows[few]], stats[rows[few]], m // 2, bins)
    large = parents - small
    out = np.empty((parents.shape[0], m, *parents.shape[2:]))
    turned = second[None, :, None, None]
    out[:, 0::2], out[:, 1::2] = np.where(turned, large, small), np.where(turned, small, large)
    return out


def grow(columns: np.ndarray, stats: np.ndarray, root: int, key: str, tree: int, spec: TreeSpec, weights: np.ndarray | None) -> tuple[dict, np.ndarray]:
    """The subtree below ``root`` of rows that are all in this task, level by level: nodes, and each row's leaf."""
    n, size = columns.shape
    rank, ids = np.zeros(size, np.int64), np.array([root], np.int64)
    rows, leaf = np.arange(size), np.full(size, root, np.int64)
    out = {"node": [], "feature": [], "bin": [], "gain": [], "stats": []}
    depth, parents = _depth(root), None  # dense sums of the split nodes one level up
    while len(ids):
        m = len(ids)
        total = np.stack([np.bincount(rank, s[rows], m) for s in stats.T]).astype(np.int64)
        feature, cut, gain = np.full(m, -1), np.full(m, -1), np.zeros(m)
        open_ = count(total, weights) >= max(spec.min_split, 2 * spec.min_leaf)
        if weights is not None:
            open_ &= (total > 0).sum(0) > 1
        if depth < spec.depth and open_.any():
            m_open = int(open_.sum())
            may = allowed(spec, key, tree, ids[open_], n)
            few = may is not None and spec.kind == "forest"
            if not few and m * spec.bins <= 4 * len(rows) and m * n * spec.bins <= DENSE:
                sums = _sums_of_level(rank, rows, columns, stats, m, spec.bins, parents)
                at, f, b, g = dense_splits(sums if m_open == m else sums[:, open_], spec, weights, may)
                at = np.flatnonzero(open_)[at]
                parents = sums[:, at]
            else:
                live = rows[open_[rank]]
                to = (np.cumsum(open_) - 1)[rank[open_[rank]]]
                own = columns[:, live]
                cells = tried_cells(to, own, stats[live], spec.bins, may) if few else cells_of(to, own, stats[live], m_open, spec.bins)
                at, f, b, g = best_splits(*cells, n, spec, weights, may)
                at, parents = np.flatnonzero(open_)[at], None
            feature[at], cut[at], gain[at] = f, b, g
        for k, v in (("node", ids), ("feature", feature), ("bin", cut), ("gain", gain), ("stats", total.T)):
            out[k].append(v)
        split = feature >= 0
        go = split[rank]
        rows, rank = rows[go], rank[go]
        right = columns[feature[rank], rows] > cut[rank]
        leaf[rows] = 2 * ids[rank] + right
        place = 2 * (np.cumsum(split) - 1)
        ids = np.stack([2 * ids[split], 2 * ids[split] + 1], 1).ravel()
        rank = place[rank] + right
        depth += 1
    return {k: np.concatenate(v) for k, v in out.items()}, leaf


# -- binned rows ---------------------------------------------------------------------------
def _u64(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint64)


BLOCKS = pa.schema([("key", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary()), ("bins", pa.binary()), ("target", pa.binary())])
BLOCKS_DDL = "key string, block long, n long, hashes binary, bins binary, target binary"


@dataclass
class Binned:
    blocks: DataFrame  # BLOCKS_DDL
    keys: DataFrame  # key, n, scale, classes (counts), cuts: array of arrays
    n_features: int
    labels: list[str] | None


_FIT = threading.local()  # folder of the fit that this thread runs


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the fit's folder: cuts the lineage where every executor can read it again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_trees/{getattr(_FIT, 'folder', 'other')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binned(df: DataFrame, key: Column, features: list[str], target: str, ids: list[str], spec: TreeSpec, labels: list[str] | None = None, keyed: bool = True) -> Binned:
    """Rows as blocks of feature bins; a key's cuts are quantiles of its own rows.

    ``labels`` are the classes of a string target; a target outside them is left
    out, as are rows without a target.  A missing feature counts as the lowest value.
    """
    value = F.col(target).cast("double") if labels is None else (F.array_position(F.array(*map(F.lit, labels)), F.col(target)) - 1).cast("double")
    rows = df.select(key.cast("string").alias("key"), F.xxhash64(*ids).alias("hash"), *(F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))).alias(f"f{i}") for i, c in enumerate(features)), value.alias("target"))
    rows = rows.filter(F.col("target").isNotNull() & F.col("key").isNotNull() & (F.col("target") >= (0 if labels else -float("inf"))))
    steps = F.array(*[F.lit(k / spec.bins) for k in range(1, spec.bins)])
    aggs = [F.array_distinct(F.percentile_approx(f"f{i}", steps, 10_000)).alias(f"c{i}") for i in range(len(features))]
    classes = F.array(*[F.count_if(F.col("target") == k) for k in range(len(labels or []))]).cast("array<long>")
    # fixed point: the largest target takes 32 bits, so sums stay whole numbers for a billion rows
    scale = F.pow(F.lit(2.0), 32 - F.ceil(F.log2(F.greatest(F.max(F.abs("target")), F.lit(1e-9)))))
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), (F.lit(1.0) if labels else scale).alias("scale"), classes.alias("classes"), *aggs)
    keys = _stored(keys.select("key", "n", "scale", "classes", F.array(*[f"c{i}" for i in range(len(features))]).alias("cuts")), "keys")
    sized = keys.select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    rows = (rows.join(broadcast_if_small(sized), "key") if keyed else attach(rows, sized.select("blocks"))).withColumn("block", F.pmod("hash", F.col("blocks"))).drop("blocks")
    each = keys.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    n, classified = len(features), labels is not None

    def pack(t: pa.Table, k: pa.Table) -> pa.Table:
        cuts, fixed = k.column("cuts")[0].as_py(), k.column("scale")[0].as_py()
        bins = np.stack([np.searchsorted(cuts[i], t.column(f"f{i}").to_numpy(), side="left") for i in range(n)], 1).astype(np.uint8)
        y = t.column("target").to_numpy()
        y = y.astype(np.int64) if classified else np.rint(y * fixed).astype(np.int64)
        return pa.table([[t.column("key")[0].as_py()], [t.column("block")[0].as_py()], [len(y)], [t.column("hash").to_numpy().astype(np.int64).tobytes()], [bins.tobytes()], [y.tobytes()]], schema=BLOCKS)

    blocks = rows.groupBy("key", "block").cogroup(each.select("key", "block", "cuts", "scale").groupBy("key", "block")).applyInArrow(lambda t, k: pack(t, k) if len(t) else BLOCKS.empty_table(), BLOCKS_DDL)
    return Binned(_stored(blocks, "blocks"), keys, n, labels)


def _unpacked(t: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row hashes, bins, targets) of several blocks."""
    hashes = np.concatenate([_u64(x.as_py()) for x in t.column("hashes")])
    bins = np.concatenate([np.frombuffer(x.as_py(), np.uint8).reshape(-1, n) for x in t.column("bins")])
    return hashes, bins, np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in t.column("target")])


def _stats(w: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    """Per row: (weight, weight * target), or the weight in the column of its class."""
    if not classes:
        return np.stack([w, w * y], 1)
    out = np.zeros((len(y), classes), np.int64)
    out[np.arange(len(y)), y] = w
    return out


def class_weights(counts: list[int]) -> np.ndarray | None:
    """Balanced: rows / (classes there * rows of the class)."""
    if not counts:
        return None
    c = np.array(counts, float)
    return np.where(c > 0, c.sum() / np.maximum(c, 1) / max((c > 0).sum(), 1), 0.0)


# -- nodes -----------------------------------------------------------------------------------
NODES = pa.schema([("key", pa.string()), ("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()), ("n", pa.int64()), ("stats", pa.list_(pa.int64()))])
NODES_DDL = "key string, tree int, node long, feature int, bin int, gain double, n long, stats array<long>"


def _node_table(key: str, tree: int, nodes: dict, weights: np.ndarray | None) -> pa.Table:
    m = len(nodes["node"])
    stats = nodes["stats"]
    return pa.table([pa.array([key] * m, pa.string()), np.full(m, tree, np.int32), nodes["node"], nodes["feature"].astype(np.int32), nodes["bin"].astype(np.int32), nodes["gain"].astype(float), count(stats.T, weights).astype(np.int64),
                     pa.ListArray.from_arrays(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32), pa.array(stats.ravel()))], schema=NODES)


def _routed(bins: np.ndarray, splits: dict[int, tuple[int, int]], depth: int) -> np.ndarray:
    """Node of each row in a tree of decided nodes {node: (feature, bin)}; a feature below 0 ends there."""
    node = np.ones(len(bins), np.int64)
    splits = {i: s for i, s in splits.items() if s[0] >= 0}
    if not splits:
        return node
    ids = np.array(sorted(splits))
    feature, cut = (np.array([splits[i][k] for i in ids.tolist()]) for k in (0, 1))
    for _ in range(depth):
        at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
        go = np.flatnonzero(ids[at] == node)
        if not len(go):
            break
        node[go] = 2 * node[go] + (bins[go, feature[at[go]]] > cut[at[go]])
    return node


PARTS = pa.schema([("key", pa.string()), ("tree", pa.int32()), ("node", pa.int64()), ("cells", pa.binary()), ("sums", pa.binary())])
PARTS_DDL = "key string, tree int, node long, cells binary, sums binary"
PACKETS = pa.schema([("key", pa.string()), ("tree", pa.int32()), ("last", pa.int32()), ("node", pa.int64()), ("hashes", pa.binary()), ("bins", pa.binary()), ("target", pa.binary())])
PACKETS_DDL = "key string, tree int, last int, node long, hashes binary, bins binary, target binary"


def grow_forest(data: Binned, spec: TreeSpec, first: int = 0) -> DataFrame:
    """Nodes of ``spec.trees`` trees (numbered from ``first``) for each key: one job a level while any node is large."""
    spark = data.blocks.sparkSession
    ship_package(spark)
    trees = F.explode(F.sequence(F.lit(first), F.lit(first + spec.trees - 1), F.lit(TREES))).alias("tree")
    many = data.keys.filter(F.col("n") > spec.local_rows).select("key")
    few = data.blocks.join(broadcast_if_small(many), "key", "left_anti").select("*", trees)
    packets = few.select("key", "tree", F.least(F.col("tree") + TREES, F.lit(first + spec.trees)).alias("last"), F.lit(1).cast("long").alias("node"), "hashes", "bins", "target")
    known = spark.createDataFrame([], NODES_DDL)
    if not many.isEmpty():
        large = data.blocks.join(broadcast_if_small(many), "key").select("*", trees)
        for depth in range(spec.depth):
            level = _stored(_level(data, large, known, spec, first, depth), f"level-{depth}")
            known = known.unionByName(level)
            if level.filter("feature >= 0").isEmpty():
                break
        packets = packets.unionByName(_sent(data, large, known, spec, first))
    n, classes = data.n_features, len(data.labels or [])

    def finish(t: pa.Table) -> pa.Table:
        key, tree, last, node = (t.column(c)[0].as_py() for c in ("key", "tree", "last", "node"))
        hashes, bins, y = _unpacked(t, n)
        weights, out, columns = class_weights(t.column("classes")[0].as_py()), [], columns_of(bins)
        own = spec.scaled(t.column("scale")[0].as_py())
        for k in range(tree, last):
            w = row_weights(hashes, spec, key, k)
            if not w.any():  # of a handful of rows a draw may take none: the tree sees them all
                w = np.ones_like(w)
            seen = w > 0
            out.append(_node_table(key, k, grow(columns[:, seen], _stats(w[seen], y[seen], classes), node, key, k, own, weights)[0], weights))
        return pa.concat_tables(out)

    packets = packets.join(broadcast_if_small(data.keys.select("key", "classes", "scale")), "key")
    grown = packets.groupBy("key", "tree", "node").applyInArrow(finish, NODES_DDL)
    return grown.unionByName(known.filter("feature >= -1"))


def _splits_of(t: pa.Table) -> dict[int, dict[int, int]]:
    """By tree: the decided nodes as {node: (feature, bin)}."""
    out: dict = {}
    for tree, node, f, b in zip(*(t.column(c).to_pylist() for c in ("at", "node", "feature", "bin")), strict=True):
        out.setdefault(tree, {})[node] = (f, b)
    return out


def _own_columns(df: DataFrame) -> DataFrame:
    """The same columns under identities of their own, so ``df`` may meet the frame it was made from."""
    return df.select(*(F.col(c).alias(c) for c in df.columns))


def _with_known(large: DataFrame, known: DataFrame, first: int):
    """Each block and group of trees beside what is decided of those trees."""
    group = (F.floor((F.col("tree") - first) / TREES) * TREES + first).cast("int")
    state = known.select("key", group.alias("tree"), F.col("tree").alias("at"), "node", "feature", "bin")
    state = _own_columns(state.join(large.select("key", "block").distinct(), "key"))
    return large.groupBy("key", "block", "tree").cogroup(state.groupBy("key", "block", "tree"))


def _level(data: Binned, large: DataFrame, known: DataFrame, spec: TreeSpec, first: int, depth: int) -> DataFrame:
    """Decides all nodes of one depth: feature >= 0 splits, -1 is a leaf, -2 is small and left to one task."""
    n, classes, width = data.n_features, len(data.labels or []), data.n_features * spec.bins

    def count_cells(t: pa.Table, k: pa.Table) -> pa.Table:
        if not len(t):
            return PARTS.empty_table()
        key, group = t.column("key")[0].as_py(), t.column("tree")[0].as_py()
        hashes, bins, y = _unpacked(t, n)
        splits, out = _splits_of(k), []
        columns = columns_of(bins)
        for tree in range(group, min(group + TREES, first + spec.trees)):
            w = row_weights(hashes, spec, key, tree)
            node = _routed(bins, splits.get(tree, {}), depth)
            live = np.flatnonzero((w > 0) & (node >= 1 << depth))
            if not len(live):
                continue
            ids, rank = np.unique(node[live], return_inverse=True)
            cells, sums = cells_of(rank, columns[:, live], _stats(w[live], y[live], classes), len(ids), spec.bins)
            cut = np.searchsorted(cells, np.arange(len(ids) + 1) * width)
            for i, (a, z) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                out.append({"key": key, "tree": tree, "node": int(ids[i]), "cells": (cells[a:z] - i * width).tobytes(), "sums": sums[a:z].tobytes()})
        return pa.Table.from_pylist(out, schema=PARTS)

    def decide(t: pa.Table) -> pa.Table:
        key, tree, node = (t.column(c)[0].as_py() for c in ("key", "tree", "node"))
        cells, sums = added([(np.frombuffer(c.as_py(), np.int64), np.frombuffer(s.as_py(), np.int64).reshape(-1, classes or 2)) for c, s in zip(t.column("cells"), t.column("sums"), strict=True)])
        weights, ids = class_weights(t.column("classes")[0].as_py()), np.array([node], np.int64)
        total = sums[cells < spec.bins].sum(0)[None, :]  # the first feature's cells hold every row once
        f, b, g = -2, -1, 0.0
        if count(total.T, weights)[0] > spec.local_rows:
            _, fs, bs, gs = best_splits(cells, sums, n, spec.scaled(t.column("scale")[0].as_py()), weights, allowed(spec, key, tree, ids, n))
            f, b, g = (int(fs[0]), int(bs[0]), float(gs[0])) if len(fs) else (-1, -1, 0.0)
        return _node_table(key, tree, {"node": ids, "feature": np.array([f]), "bin": np.array([b]), "gain": np.array([g]), "stats": total}, weights)

    parts = _with_known(large, known, first).applyInArrow(count_cells, PARTS_DDL)
    parts = parts.join(broadcast_if_small(data.keys.select("key", "classes", "scale")), "key")
    return parts.groupBy("key", "tree", "node").applyInArrow(decide, NODES_DDL)


def _sent(data: Binned, large: DataFrame, known: DataFrame, spec: TreeSpec, first: int) -> DataFrame:
    """The rows of the nodes that the levels left open, as packets of one tree and node."""
    n = data.n_features

    def send(t: pa.Table, k: pa.Table) -> pa.Table:
        if not len(t):
            return PACKETS.empty_table()
        key, group = t.column("key")[0].as_py(), t.column("tree")[0].as_py()
        hashes, bins, y = _unpacked(t, n)
        splits, out = _splits_of(k), []
        for tree in range(group, min(group + TREES, first + spec.trees)):
            mine = splits.get(tree, {})
            node = _routed(bins, mine, spec.depth)
            leaves = np.array([i for i, s in mine.items() if s[0] == -1], np.int64)
            live = np.flatnonzero(~np.isin(node, leaves) & (row_weights(hashes, spec, key, tree) > 0))
            live = live[np.argsort(node[live], kind="stable")]
            ids, start = np.unique(node[live], return_index=True)
            for i, rows in zip(ids.tolist(), np.split(live, start[1:]) if len(ids) else [], strict=True):
                out.append({"key": key, "tree": tree, "last": tree + 1, "node": i, "hashes": hashes[rows].tobytes(), "bins": bins[rows].tobytes(), "target": y[rows].tobytes()})
        return pa.Table.from_pylist(out, schema=PACKETS)

    return _with_known(large, known, first).applyInArrow(send, PACKETS_DDL)


# -- boosting --------------------------------------------------------------------------------
def _added_value(stats: np.ndarray, spec: TreeSpec) -> np.ndarray:
    """What a node adds to a prediction, in fixed point."""
    s = stats[:, 1].astype(float)
    if spec.l1:
        s = np.sign(s) * np.maximum(np.abs(s) - spec.l1, 0.0)
    return spec.step * s / np.maximum(stats[:, 0] + spec.l2, 1e-300)


def _leaf_values(leaf: np.ndarray, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
    order = np.argsort(ids)
    return values[order][np.searchsorted(ids[order], leaf)]


def _start(rows: int, total: int) -> dict:
    """The root of tree -1: the mean target, where boosting starts."""
    return {"node": np.array([1]), "feature": np.array([-1]), "bin": np.array([-1]), "gain": np.zeros(1), "stats": np.array([[rows, total]], np.int64)}


def boost(data: Binned, spec: TreeSpec) -> DataFrame:
    """Nodes of boosted trees for each key; tree -1 is the mean.

    A key with at most ``spec.boost_rows`` rows is boosted by one task; beyond
    that every round's tree is grown by :func:`grow_forest` over all blocks, and
    the predictions so far are stored with the blocks, so a lost executor costs a round.
    """
    ship_package(data.blocks.sparkSession)
    n = data.n_features

    def alone(t: pa.Table) -> pa.Table:
        key = t.column("key")[0].as_py()
        hashes, bins, y = _unpacked(t, n)
        out, columns = [_node_table(key, -1, _start(len(y), int(y.sum())), None)], columns_of(bins)
        own = spec.scaled(t.column("scale")[0].as_py())
        now = np.full(len(y), int(y.sum()) / len(y))
        for k in range(spec.trees):
            w = row_weights(hashes, spec, key, k)
            nodes, leaf = grow(columns, _stats(w, np.rint(y - now).astype(np.int64), 0), 1, key, k, own, None)
            now = now + _leaf_values(leaf, nodes["node"], _added_value(nodes["stats"], own))
            out.append(_node_table(key, k, nodes, None))
        return pa.concat_tables(out)

    few = data.keys.filter(F.col("n") <= spec.boost_rows).select("key", "scale")
    out = data.blocks.join(broadcast_if_small(few), "key").groupBy("key").applyInArrow(alone, NODES_DDL)
    many = data.keys.filter(F.col("n") > spec.boost_rows)
    return out if many.isEmpty() else out.unionByName(_boost_rounds(data, many, spec))


def _boost_rounds(data: Binned, many: DataFrame, spec: TreeSpec) -> DataFrame:
    n = data.n_features
    blocks = data.blocks.join(broadcast_if_small(many.select("key")), "key")

    def total(t: pa.Table) -> pa.Table:
        y = [np.frombuffer(x.as_py(), np.int64) for x in t.column("target")]
        return pa.table([t.column("key").slice(0, 1).combine_chunks().cast(pa.string()), [int(sum(map(len, y)))], [int(sum(x.sum() for x in y))]], names=["key", "rows", "total"])

    # partial sums block by block, then one row a key
    sums = blocks.groupBy("key", "block").applyInArrow(total, "key string, rows long, total long").groupBy("key").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    sums = _stored(sums, "means")
    roots = sums.select("key", F.lit(-1).alias("tree"), F.lit(1).cast("long").alias("node"), F.lit(-1).alias("feature"), F.lit(-1).alias("bin"), F.lit(0.0).alias("gain"), F.col("rows").alias("n"), F.array("rows", "total").alias("stats"))

    def begin(t: pa.Table) -> pa.Table:
        size, mean = t.column("n")[0].as_py(), t.column("total")[0].as_py() / t.column("rows")[0].as_py()
        return t.select(BLOCKS.names).append_column("now", pa.array([np.full(size, mean).tobytes()], pa.binary()))

    def residuals(t: pa.Table) -> pa.Table:
        y, now = (np.frombuffer(t.column(c)[0].as_py(), d) for c, d in (("target", np.int64), ("now", np.float64)))
        return t.select(BLOCKS.names).set_column(5, "target", pa.array([np.rint(y - now).astype(np.int64).tobytes()], pa.binary()))

    def update(t: pa.Table, k: pa.Table) -> pa.Table:
        if not len(t):
            return pa.schema([*BLOCKS, ("now", pa.binary())]).empty_table()
        bins, now = np.frombuffer(t.column("bins")[0].as_py(), np.uint8).reshape(-1, n), np.frombuffer(t.column("now")[0].as_py(), np.float64)
        nodes = k.to_pylist()
        leaf = _routed(bins, {r["node"]: (r["feature"], r["bin"]) for r in nodes}, spec.depth)
        added_ = _leaf_values(leaf, np.array([r["node"] for r in nodes]), _added_value(np.array([r["stats"] for r in nodes], np.int64), spec.scaled(nodes[0]["scale"])))
        return t.set_column(t.schema.get_field_index("now"), "now", pa.array([(now + added_).tobytes()], pa.binary()))

    state_ddl = f"{BLOCKS_DDL}, now binary"
    state = _stored(blocks.join(broadcast_if_small(sums), "key").groupBy("key", "block").applyInArrow(begin, state_ddl), "round")
    out = roots
    for k in range(spec.trees):
        left = Binned(state.groupBy("key", "block").applyInArrow(residuals, BLOCKS_DDL), data.keys.join(broadcast_if_small(many.select("key")), "key"), n, None)
        nodes = _stored(grow_forest(left, replace(spec, trees=1), first=k), "tree")
        every = _own_columns(nodes.join(state.select("key", "block"), "key").join(broadcast_if_small(many.select("key", "scale")), "key"))
        state = _stored(state.groupBy("key", "block").cogroup(every.groupBy("key", "block")).applyInArrow(update, state_ddl), "round")
        out = out.unionByName(nodes)
    return out


# -- models ----------------------------------------------------------------------------------
def _scored(x: np.ndarray, trees: Iterable[tuple], width: int) -> tuple[np.ndarray, int]:
    """Sum of the trees' leaf values, [row, class], and how many trees there were."""
    out, n = np.zeros((len(x), width)), 0
    for ids, feature, threshold, values in trees:
        n += 1
        left, right = np.searchsorted(ids, 2 * ids), np.searchsorted(ids, 2 * ids + 1)
        at = np.zeros(len(x), np.int64)
        go = np.flatnonzero(feature[at] >= 0)
        while len(go):
            i = at[go]
            at[go] = np.where(x[go, feature[i]] <= threshold[i], left[i], right[i])
            go = go[feature[at[go]] >= 0]
        out += values[at]
    return out, n


PACKED_DDL = "key string, tree int, ids binary, feature binary, threshold binary, value binary"
PACKED = pa.schema([("key", pa.string()), ("tree", pa.int32()), *((c, pa.binary()) for c in ("ids", "feature", "threshold", "value"))])


def unpacked_trees(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """Rows of a packed model as arrays (ids, feature, threshold, values) over the batches' own bytes."""
    for b in batches:
        for i in range(len(b)):
            ids, feature, threshold, value = (np.frombuffer(b.column(f"_{c}")[i].as_buffer(), d) for c, d in (("ids", np.int64), ("feature", np.int32), ("threshold", np.float64), ("value", np.float64)))
            yield ids, feature, threshold, value.reshape(-1, width)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """(key and chunk, whether trees, rows) of neighbours that have these in common."""
    for b in batches:
        key = b.column("_key").dictionary_encode()
        chunk, tree = b.column("_chunk").to_numpy(), b.column("_tree").is_valid().to_numpy(zero_copy_only=False)
        same = np.stack([key.indices.to_numpy(), chunk, tree])
        start = np.flatnonzero(np.r_[len(b) > 0, (same[:, 1:] != same[:, :-1]).any(0)])
        for a, z in zip(start, np.r_[start[1:], len(b)], strict=True):
            yield (key[a].as_py(), int(chunk[a])), bool(tree[a]), b.slice(a, z - a)


def features_matrix(t: pa.Table, features: list[str]) -> np.ndarray:
    """The features as doubles; a missing one counts as the lowest value."""
    x = np.stack([t.column(c).cast(pa.float64()).to_numpy() for c in features], 1) if len(t) else np.empty((0, len(features)))
    return np.where(np.isnan(x), -np.inf, x)


@dataclass
class TreeModel:
    spec: TreeSpec
    features: list[str]
    labels: list[str] | None
    key: str | None  # column that names a row's model; None: one model for all
    nodes: DataFrame  # key, tree, node, feature, threshold, gain, n, value (array: one number, or a share per class)
    packed: DataFrame  # PACKED_DDL: a row per tree
    encoder: PipelineModel | None = None

    @property
    def width(self) -> int:
        return len(self.labels or [0])

    def key_column(self) -> Column:
        return F.col(self.key).cast("string") if self.key else F.lit("")

    def chunked(self, rows: DataFrame, most: int, *by: str) -> tuple[DataFrame, DataFrame]:
        """``rows`` and the packed trees with ``_key`` and ``_chunk``: about ``most`` rows of a key
        (dealt by a hash of the columns ``by``) meet one copy of the key's trees.  A null key has chunks of its own."""
        many = F.greatest(F.ceil(F.count(F.lit(1)) / most), F.lit(1)).cast("long").alias("_chunks")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1))
        if self.key is None:
            counts = rows.agg(many)
            rows, trees = attach(rows, counts).withColumn("_key", F.lit("")), attach(self.packed, counts)
        else:
            # a marked copy, so that the null key joins as any other
            rows = rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), self.key_column()), F.lit("")))
            counts = rows.groupBy("_key").agg(many)
            rows = rows.join(broadcast_if_small(counts), "_key")
            trees = self.packed.withColumn("key", F.concat(F.lit("="), F.col("key"))).join(broadcast_if_small(counts.withColumnRenamed("_key", "key")), "key")
        return rows.withColumn("_chunk", F.pmod(F.xxhash64(*by), F.col("_chunks"))).drop("_chunks"), trees.withColumn("_chunk", every).drop("_chunks").withColumnRenamed("key", "_key")

    def meet(self, rows: DataFrame, most: int, by: list[str], each: Callable[[pa.Table, Iterator[tuple]], pa.Table], out) -> DataFrame:
        """``each(rows of a chunk, its trees one by one)`` for every chunk of :meth:`chunked`.

        A chunk's rows come first and its trees after them, in order, batch by batch
        (``spark.sql.execution.arrow.maxBytesPerBatch``), so a task holds a chunk and
        one batch of trees, whatever the model's size.
        """
        names, width = rows.columns, self.width
        rows, trees = self.chunked(rows, most, *by)
        trees = trees.select("_key", "_chunk", *(F.col(c).alias(f"_{c}") for c in ("tree", "ids", "feature", "threshold", "value")))
        both = rows.select(*names, "_key", "_chunk").unionByName(trees, allowMissingColumns=True)
        both = both.repartition("_key", "_chunk").sortWithinPartitions("_key", "_chunk", F.col("_tree").asc_nulls_first())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, parts in itertools.groupby(_runs(batches), key=lambda x: x[0]):
                own, first = [], []
                for _, tree, b in parts:
                    if tree:
                        first.append(b)
                        break
                    own.append(b.select(names).take(np.arange(len(b))))  # a copy, so that the batch and the trees in it can go
                if own:
                    trees = itertools.chain(first, (b for _, _, b in parts))
                    yield from each(pa.Table.from_batches(own), unpacked_trees(trees, width)).to_batches()

        return both.mapInArrow(run, out)

    def encoded(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(df) if self.encoder else df

    def combine(self, sums: np.ndarray, trees: int) -> np.ndarray:
        return sums if self.spec.kind == "boost" else sums / max(trees, 1)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``: a number (null where the key has no model), or with classes
        ``predicted_category`` and ``probabilities`` (in the order of ``labels``)."""
        spark = df.sparkSession
        ship_package(spark)
        rows = self.encoded(df)
        kept = rows.schema
        features, width, labels, model = self.features, self.width, self.labels, replace_frames(self)
        added_ = [T.StructField("predicted_category", T.StringType()), T.StructField("probabilities", T.ArrayType(T.DoubleType()))] if labels else [T.StructField("prediction", T.DoubleType())]

        def score_rows(t: pa.Table, trees: Iterator[tuple]) -> pa.Table:
            sums, n = _scored(features_matrix(t, features), trees, width)
            p, known = model.combine(sums, n), n > 0
            if labels:
                best = p.argmax(1)
                t = t.append_column("predicted_category", pa.array([labels[i] if known else None for i in best], pa.string()))
                return t.append_column("probabilities", pa.array([x.tolist() if known else None for x in p], pa.list_(pa.float64())))
            return t.append_column("prediction", pa.array(p[:, 0], pa.float64()) if known else pa.nulls(len(t), pa.float64()))

        return self.meet(rows, BLOCK, self.features, score_rows, T.StructType([*kept.fields, *added_]))

    def importance(self) -> DataFrame:
        """feature, importance: share of all gains, per input column (of all keys' trees)."""
        name = F.array(*map(F.lit, self.features))
        all_ = self.features
        g = self.nodes.filter("feature >= 0").groupBy("feature").agg(F.sum("gain").alias("g"))
        total = g.agg(F.sum("g").alias("t")).select("t").scalar()
        base = self.nodes.sparkSession.range(len(all_)).select(F.col("id").cast("int").alias("feature"))
        return base.join(g, "feature", "left").select(F.get(name, F.col("feature")).alias("feature"), F.coalesce(F.col("g") / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")

    def save(self, path: str, meta: dict | None = None) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.packed.write.mode("overwrite").parquet(f"{path}/packed")
        if self.encoder:
            self.encoder.write().overwrite().save(f"{path}/encoder")
        own = {"spec": asdict(self.spec), "features": self.features, "labels": self.labels, "key": self.key, "encoder": bool(self.encoder), "meta": meta or {}}
        spark.createDataFrame([(json.dumps(own),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def meta(spark: SparkSession, path: str) -> dict:
        return json.loads(spark.read.text(f"{path}/meta").first()[0])["meta"]

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        own = json.loads(spark.read.text(f"{path}/meta").first()[0])
        encoder = PipelineModel.load(f"{path}/encoder") if own["encoder"] else None
        return TreeModel(TreeSpec(**own["spec"]), own["features"], own["labels"], own["key"], spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/packed"), encoder)


def replace_frames(m: TreeModel) -> TreeModel:
    """The model's settings without its tables, for tasks."""
    return replace(m, nodes=None, packed=None, encoder=None)


def fit_trees(df: DataFrame, features: list[str], target: str, ids: list[str], spec: TreeSpec, key: str | None = None, labels: list[str] | None = None, encoder: PipelineModel | None = None) -> TreeModel:
    """Fit a model for every value of ``key`` (one model without) on encoded rows.

    ``ids`` name a row; bootstrap draws hash them.  ``labels`` are the classes of
    a string target, weighted so that a key's classes count alike.
    """
    spark = df.sparkSession
    ship_package(spark)
    _FIT.folder = f"fit-{uuid.uuid4().hex}"
    work = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_trees/{_FIT.folder}"
    data = binned(df, F.col(key) if key else F.lit(""), features, target, ids, spec, labels, keyed=key is not None)
    grown = _stored(boost(data, spec) if spec.kind == "boost" else grow_forest(data, spec), "grown")
    cuts = data.keys.select("key", F.posexplode("cuts").alias("feature", "c")).select("key", "feature", F.posexplode("c").alias("bin", "threshold"))
    keys = data.keys.select("key", "scale", "classes")
    nodes = grown.join(broadcast_if_small(cuts), ["key", "feature", "bin"], "left").join(broadcast_if_small(keys), "key")
    if labels:
        rows = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
        there = F.size(F.filter("classes", lambda x: x > 0))
        w = F.zip_with("stats", "classes", lambda s, c: F.when(c > 0, s * rows / (there * c)).otherwise(0.0))
        total = F.aggregate(w, F.lit(0.0), lambda a, x: a + x)
        value = F.transform(w, lambda x: F.coalesce(F.try_divide(x, total), F.lit(0.0)))
    else:
        step = F.when(F.col("tree") >= 0, F.lit(spec.step if spec.kind == "boost" else 1.0)).otherwise(1.0)
        weight = F.get("stats", F.lit(0)) + F.when(F.col("tree") >= 0, F.lit(spec.l2)).otherwise(0.0)
        s, l1 = F.get("stats", F.lit(1)).cast("double"), F.when(F.col("tree") >= 0, F.lit(spec.l1) * F.col("scale")).otherwise(0.0)
        value = F.array(F.coalesce(F.try_divide(step * F.signum(s) * F.greatest(F.abs(s) - l1, F.lit(0.0)), weight), F.lit(0.0)) / F.col("scale"))
    _FIT.folder += "-model"  # what stays
    nodes = _stored(nodes.select("key", "tree", "node", "feature", F.coalesce("threshold", F.lit(0.0)).alias("threshold"), "gain", "n", value.alias("value")), "nodes")

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        cols = [t.column("node").to_numpy().astype(np.int64), t.column("feature").to_numpy().astype(np.int32), t.column("threshold").to_numpy().astype(np.float64), t.column("value").combine_chunks().flatten().to_numpy()]
        return pa.table([[t.column("key")[0].as_py()], [t.column("tree")[0].as_py()], *([c.tobytes()] for c in cols)], schema=PACKED)

    packed = _stored(nodes.groupBy("key", "tree").applyInArrow(pack, PACKED_DDL), "packed")
    remove(spark, work)
    return TreeModel(spec, features, labels, key, nodes, packed, encoder)
