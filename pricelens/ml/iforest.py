"""Isolation forest per group (M18) as a Spark job.

Algorithm: Liu, Ting & Zhou, "Isolation Forest" (ICDM 2008).  Each tree is
grown on a subsample of psi = min(256, n) rows of its group, to depth
ceil(log2 psi), splitting on a random feature at a uniform random value
between the node's min and max.  A row's score is 2^(-E[h(x)] / c(psi)), with
c(n) = 2 H(n-1) - 2 (n-1) / n the mean path length of an unsuccessful BST
search.  Rows whose score lies in the top ``contamination`` share of their
group are flagged (-1), as the reference's outlier detector does.

Spark plan:
1. sampling: each row is sent to the trees whose hash of (row key, tree)
   falls under p = min(1, 3 psi / n_group); expected copies per row =
   trees * p, i.e. a constant ~3 * psi * trees rows per group in total,
   independent of the group size (a hot group does not explode);
2. ``groupBy(group, tree).applyInPandas``: keep the psi lowest-hash rows and
   grow one tree (numpy) -> flat node arrays;
3. a tree is packed into one row; the trees of a group (at most 2 psi nodes
   each, a size fixed by the parameters) meet the group's rows chunk by chunk.
   A chunk holds at least ``SHARE`` times the forest's bytes of rows, so the
   copies of a forest stay a small share of the data they score;
4. threshold: the exact quantile of a group's scores by rank selection, joined back.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators.stats import broadcast_if_small, quantile_columns
from pricelens.session import checkpoint_dir

EULER = 0.5772156649
NODE_SCHEMA = ("grp string, tree int, node int, feature int, threshold double, left int, right int, size int")


def c_factor(n):
    n = np.asarray(n, dtype="float64")
    out = np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER) - 2.0 * (n - 1) / np.maximum(n, 1), 0.0)
    return np.where(n == 2, 1.0, out)


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Flat arrays of one isolation tree (feature -1 = leaf)."""
    feat, thr, left, right, size = [], [], [], [], []
    nodes = []  # breadth-first build; node ids in creation order

    def new(idx, depth):
        nid = len(feat)
        feat.append(-1); thr.append(0.0); left.append(-1); right.append(-1); size.append(len(idx))
        nodes.append((nid, idx, depth))
        return nid

    new(np.arange(len(x)), 0)
    i = 0
    while i < len(nodes):
        nid, idx, depth = nodes[i]
        i += 1
        if depth >= max_depth or len(idx) <= 1:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            continue
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        mask = sub[:, f] < t
        feat[nid], thr[nid] = f, t
        left[nid] = new(idx[mask], depth + 1)
        right[nid] = new(idx[~mask], depth + 1)
    return feat, thr, left, right, size


def _build_fn(features, psi, seed):
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_h").head(psi)
        grp, tree = str(pdf["grp"].iloc[0]), int(pdf["tree"].iloc[0])
        x = pdf[features].to_numpy(dtype="float64")
        rng = np.random.default_rng([seed, tree, zlib.crc32(grp.encode())])
        f, t, l, r, s = _grow(x, rng, max_depth)
        n = len(f)
        return pd.DataFrame({"grp": [grp] * n, "tree": [tree] * n, "node": np.arange(n, dtype="int32"),
                             "feature": np.array(f, dtype="int32"), "threshold": np.array(t, dtype="float64"),
                             "left": np.array(l, dtype="int32"), "right": np.array(r, dtype="int32"),
                             "size": np.array(s, dtype="int32")})
    return build


PACKED_DDL = "grp string, tree int, nodes int, feature binary, threshold binary, left binary, right binary, size binary"
_PARTS = (("feature", "int32"), ("threshold", "float64"), ("left", "int32"), ("right", "int32"), ("size", "int32"))
#: Bytes of a packed node, and of a feature value.
NODE_BYTES, VALUE_BYTES = sum(np.dtype(d).itemsize for _, d in _PARTS), 8
#: A chunk's feature bytes are at least so many times the bytes of its copy of the forest.
SHARE = 4
#: Rows that numpy walks through a tree at once.
BATCH = 50_000


def _pack(nodes: pd.DataFrame) -> pd.DataFrame:
    """One row per tree."""
    nodes = nodes.sort_values("node")
    return pd.DataFrame({"grp": [nodes["grp"].iloc[0]], "tree": [int(nodes["tree"].iloc[0])], "nodes": [len(nodes)],
                         **{c: [nodes[c].to_numpy().astype(d).tobytes()] for c, d in _PARTS}})


def chunk_rows(trees: int, psi: int, features: int) -> int:
    """Rows of a group that meet one copy of its forest."""
    return SHARE * trees * 2 * psi * NODE_BYTES // (features * VALUE_BYTES)


def _path_lengths(x: np.ndarray, trees: list[tuple]) -> np.ndarray:
    total = np.zeros(len(x))
    for feat, thr, left, right, size in trees:
        node, depth = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
        go = np.flatnonzero(feat[node] >= 0)
        while len(go):
            at = node[go]
            node[go] = np.where(x[go, feat[at]] < thr[at], left[at], right[at])
            depth[go] += 1
            go = go[feat[node[go]] >= 0]
        total += depth + c_factor(size[node])
    return total


def _score_fn(features, psi, columns):
    def score(rows: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame([], columns=[*columns, "anomaly_score"])
        trees = [tuple(np.frombuffer(r[c], d) for c, d in _PARTS) for r in packed.sort_values("tree").to_dict("records")]
        x = rows[features].to_numpy(dtype="float64")
        total = np.concatenate([_path_lengths(x[i : i + BATCH], trees) for i in range(0, len(x), BATCH)])
        n = min(psi, int(rows["_n"].iloc[0]))
        return rows[columns].assign(anomaly_score=2.0 ** (-total / len(trees) / c_factor(n)) if trees else np.nan)
    return score


def _rows(df: DataFrame, group: str, features, id_cols) -> tuple[DataFrame, DataFrame, Column]:
    """Rows with all features, their number by group, and the text that names a row."""
    base = df.withColumn("grp", F.col(group).cast("string")).na.drop(subset=list(features))
    return base, base.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")), F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols])


def forest(df: DataFrame, group: str, features, id_cols, trees: int = 200, psi: int = 256, seed: int = 42) -> DataFrame:
    """The packed trees of every group."""
    from pricelens.session import ship_package
    ship_package(df.sparkSession)
    base, n, key = _rows(df, group, features, id_cols)
    j = base.join(broadcast_if_small(n), "grp").withColumn("_p", F.least(F.lit(1.0), F.lit(3.0 * psi) / F.col("_n")))
    tree_ids = F.sequence(F.lit(0), F.lit(trees - 1))
    # a coarse number refined by a second hash, so that the share of a group of any size can be as small as it must
    coarse = lambda t: F.abs(F.xxhash64(key, t, F.lit(seed))) % F.lit(1000003)
    fine = lambda t: F.xxhash64(key, t, F.lit(seed + 2)).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    hsh = lambda t: (coarse(t) + fine(t)) / F.lit(1000003.0)
    picked = j.select("grp", *features, key.alias("_key"), F.explode(F.filter(tree_ids, lambda t: hsh(t) < F.col("_p"))).alias("tree"))
    picked = picked.withColumn("_h", F.xxhash64("_key", "tree", F.lit(seed + 1)))
    nodes = (picked.select("grp", "tree", "_h", *features)
                   .groupBy("grp", "tree").applyInPandas(_build_fn(list(features), psi, seed), NODE_SCHEMA))
    return nodes.groupBy("grp", "tree").applyInPandas(_pack, PACKED_DDL)


def isolation_forest(df: DataFrame, group: str, features, id_cols, trees: int = 200, psi: int = 256,
                     contamination: float = 0.02, seed: int = 42) -> DataFrame:
    """Adds ``anomaly_score`` (higher = more isolated), ``decision`` (threshold
    minus score; < 0 flagged) and ``outlier_flag`` (-1 / 1) per row."""
    packed = forest(df, group, features, id_cols, trees, psi, seed)
    base, n, key = _rows(df, group, features, id_cols)
    columns = base.columns
    schema = T.StructType([*base.schema.fields, T.StructField("anomaly_score", T.DoubleType())])
    chunks = F.ceil(F.col("_n") / F.lit(chunk_rows(trees, psi, len(list(features)))))
    rows = base.join(broadcast_if_small(n), "grp").withColumn("_chunk", F.pmod(F.xxhash64(key), chunks))
    copies = packed.join(broadcast_if_small(n), "grp").withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))).drop("_n")
    scored = (rows.groupBy("grp", "_chunk").cogroup(copies.groupBy("grp", "_chunk"))
              .applyInPandas(_score_fn(list(features), psi, columns), schema))
    return flagged(scored, contamination).drop("grp")


def flagged(scored: DataFrame, contamination: float) -> DataFrame:
    """``decision`` and ``outlier_flag``: the top share of each group's scores is flagged."""
    # the scores are read three times: for the sketch, the counts and the decision
    scored = _written(scored)
    thr = quantile_columns(scored, "anomaly_score", {"_thr": 1.0 - contamination}, ["grp"])
    out = scored.join(broadcast_if_small(thr), "grp")
    out = out.withColumn("decision", F.col("_thr") - F.col("anomaly_score"))
    return out.withColumn("outlier_flag", F.when(F.col("decision") < 0, F.lit(-1)).otherwise(F.lit(1))).drop("_thr")


def _written(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_scores/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
