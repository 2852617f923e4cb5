"""Grouped trees: against plain recursion, separate fits, and themselves by another route."""

from dataclasses import replace

import numpy as np
import pytest

FEATURES = ["a", "b", "c"]


def table(seed, sizes):
    rng = np.random.default_rng(seed)
    rows = []
    for key, n in sizes.items():
        for i in range(n):
            a, b, c = float(rng.integers(0, 40)), float(rng.normal()), float(rng.integers(0, 3))
            y = 3 * a + (50 if b > 0.3 else 0) + 10 * c + float(rng.normal()) + len(key)
            rows.append((key, len(rows), a, b if i % 50 else None, c, round(y, 3), ["low", "mid", "high"][min(2, int(y // 60))]))
    return rows


DDL = "k string, id long, a double, b double, c double, y double, cls string"


@pytest.fixture(scope="module")
def rows():
    return table(1, {"x": 700, "yy": 300, "z": 40, "one": 1})


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(5)


def nodes(model):
    return sorted((r.key, r.tree, r.node, r.feature, r.threshold, r.n, tuple(r.value)) for r in model.nodes.collect())


def plain(x, y, depth, min_leaf, cuts, node=1):
    """One unsampled regression tree by recursion over all (feature, cut) pairs."""
    out = [(node, -1, 0.0, len(y), y.mean())]
    best = (1e-9 * y.sum() ** 2 / len(y), None)
    if depth and len(y) >= 2 * min_leaf:
        for f in range(x.shape[1]):
            for t in sorted(cuts[f]):
                left = x[:, f] <= t
                if min(left.sum(), (~left).sum()) < min_leaf:
                    continue
                gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y)
                if gain > best[0] + 1e-7:
                    best = (gain, (f, t, left))
    if best[1] is None:
        return out
    f, t, left = best[1]
    out = [(node, f, t, len(y), y.mean())]
    return out + plain(x[left], y[left], depth - 1, min_leaf, cuts, 2 * node) + plain(x[~left], y[~left], depth - 1, min_leaf, cuts, 2 * node + 1)


def test_one_tree_equals_plain_recursion(spark, rows):
    from pricelens.ml.grouped_trees import TreeSpec, binned, fit_trees
    from pyspark.sql import functions as F
    own = [r for r in rows if r[0] == "x"]
    frame = spark.createDataFrame(own, DDL)
    spec = TreeSpec(trees=1, depth=4, min_leaf=3, bootstrap=False, bins=32)
    got = sorted((r.node, r.feature, r.threshold, r.n, r.value[0]) for r in fit_trees(frame, FEATURES, "y", ["id"], spec).nodes.collect())
    cuts = [set(c) for c in binned(frame, F.lit(""), FEATURES, "y", ["id"], spec).keys.first().cuts]
    x = np.array([[v if v is not None else -np.inf for v in r[2:5]] for r in own])
    want = sorted(plain(x, np.array([r[5] for r in own]), 4, 3, cuts))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], atol=1e-6)


@pytest.mark.parametrize("kind", ["forest", "classes", "boost"])
def test_together_equals_separate_fits_and_other_routes(spark, frame, rows, kind):
    """All keys in one fit, each key alone, and levels as jobs in place of one task: the same nodes."""
    from pricelens.ml.grouped_trees import TreeSpec, fit_trees
    spec = TreeSpec(kind="boost", trees=3, depth=4, step=0.3, subsample=0.8, features=0.7, l1=2.0, l2=1.0, min_gain=5.0, min_leaf=2) if kind == "boost" else TreeSpec(trees=5, depth=6, min_leaf=2, features="sqrt")
    target, labels = ("cls", ["high", "low", "mid"]) if kind == "classes" else ("y", None)
    fit = lambda df, s: fit_trees(df, FEATURES, target, ["id"], s, key="k", labels=labels)
    together = nodes(fit(frame, spec))
    apart = sorted(sum((nodes(fit(spark.createDataFrame([r for r in rows if r[0] == k], DDL), spec)) for k in ("x", "yy", "z", "one")), []))
    assert together == apart
    assert together == nodes(fit(frame.repartition(2), replace(spec, local_rows=60, boost_rows=100)))
    assert {n[0] for n in together} == {"x", "yy", "z", "one"}


def test_jobs_do_not_follow_keys(spark):
    from pricelens.ml.grouped_trees import TreeSpec, fit_trees
    spec = TreeSpec(trees=4, depth=5, local_rows=16)
    jobs = []
    for keys in (2, 40):
        frame = spark.createDataFrame(table(2, {f"k{i}": 60 for i in range(keys)}), DDL)
        tracker, group = spark.sparkContext.statusTracker(), f"fit-{keys}"
        spark.sparkContext.setJobGroup(group, group)
        model = fit_trees(frame, FEATURES, "y", ["id"], spec, key="k")
        assert model.nodes.select("key").distinct().count() == keys
        jobs.append(len(tracker.getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 8


def test_predictions_and_reload(spark, frame, tmp_path):
    from pyspark.sql import functions as F

    from pricelens.ml.grouped_trees import TreeModel, TreeSpec, fit_trees
    model = fit_trees(frame, FEATURES, "y", ["id"], TreeSpec(kind="boost", trees=60, depth=4, l2=1.0), key="k")
    more = frame.unionByName(spark.createDataFrame([("new", -1, 1.0, 1.0, 1.0, 0.0, "low"), (None, -2, 1.0, 1.0, 1.0, 0.0, "low")], DDL))
    got = model.transform(more)
    assert got.filter("id >= 0").count() == 1041 and got.filter("id < 0 AND prediction IS NULL").count() == 2
    err = got.filter("k = 'x'").agg(F.avg(F.abs(F.col("y") - F.col("prediction"))), F.stddev("y")).first()
    assert err[0] < 0.1 * err[1]
    # the same by walking the node table row by row
    table_ = {}
    for r in model.nodes.collect():
        table_.setdefault((r.key, r.tree), {})[r.node] = r
    for r in got.filter("k = 'yy'").limit(40).collect():
        total = 0.0
        for tree in range(-1, 60):
            own, at = table_[r.k, tree], 1
            while own[at].feature >= 0:
                v = (r.a, r.b, r.c)[own[at].feature]
                at = 2 * at + (v is not None and v > own[at].threshold)
            total += own[at].value[0]
        assert abs(total - r.prediction) < 1e-9
    model.save(str(tmp_path / "m"))
    again = TreeModel.load(spark, str(tmp_path / "m")).transform(more)
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    classes = fit_trees(frame, FEATURES, "cls", ["id"], TreeSpec(trees=20, depth=8, features="sqrt"), key="k", labels=["high", "low", "mid"])
    out = classes.transform(frame)
    assert out.filter("cls = predicted_category").count() > 0.9 * out.count()
    assert out.filter("abs(aggregate(probabilities, 0D, (a, x) -> a + x) - 1) > 1e-9").count() == 0
    assert abs(sum(r.importance for r in model.importance().collect()) - 1) < 1e-9


def largest_worker(spark, action):
    """MB of its own that the largest Python worker of the session holds at most during ``action``."""
    import re
    import threading
    from pathlib import Path
    most, done = [0.0], threading.Event()

    def watch():
        while not done.wait(0.05):
            parent = {}
            for stat in Path("/proc").glob("[0-9]*/stat"):
                try:
                    parent[int(stat.parent.name)] = int(stat.read_text().rsplit(")", 1)[1].split()[1])
                except OSError:
                    pass
            own = {spark.sparkContext._gateway.proc.pid}
            for _ in range(4):
                own |= {p for p, q in parent.items() if q in own}
            for p in own:
                try:
                    if "pyspark" in Path(f"/proc/{p}/cmdline").read_text() and "java" not in Path(f"/proc/{p}/comm").read_text():
                        most[0] = max(most[0], int(re.search(r"Pss_Anon:\s+(\d+)", Path(f"/proc/{p}/smaps_rollup").read_text())[1]) / 1024)
                except (OSError, TypeError):
                    pass
    thread = threading.Thread(target=watch)
    thread.start()
    try:
        action()
    finally:
        done.set()
        thread.join()
    return most[0]


def test_a_task_does_not_hold_a_whole_model(spark):
    """A model of 450 MB: rows meet its trees batch by batch."""
    import pyarrow as pa

    from pricelens.ml.grouped_trees import PACKED_DDL, TreeModel, TreeSpec
    trees, levels = 400, 15
    m = 2 ** (levels + 1) - 1  # a full tree that splits on a at 0.5 everywhere

    def packed(batches):
        ids = np.arange(1, m + 1)
        feature, threshold = np.where(ids < 2**levels, 0, -1).astype(np.int32), np.full(m, 0.5)
        for b in batches:
            for tree in b.column("id").to_pylist():
                cols = [ids.astype(np.int64), feature, threshold, np.where(ids == 2**levels, tree, 2.0 * tree)]
                yield pa.RecordBatch.from_pydict({"key": [""], "tree": pa.array([tree], pa.int32())} | {c: [v.tobytes()] for c, v in zip(("ids", "feature", "threshold", "value"), cols, strict=True)})

    frame = spark.range(0, trees, 1, 8).mapInArrow(packed, PACKED_DDL)
    model = TreeModel(TreeSpec(trees=trees, depth=levels), ["a"], None, None, frame, frame)
    out = []
    held = largest_worker(spark, lambda: out.extend(model.transform(spark.range(2).selectExpr("id", "CAST(id AS double) AS a")).collect()))
    assert sorted((r.id, r.prediction) for r in out) == [(0, 199.5), (1, 399.0)]
    assert held < 450


def test_wide_levels_take_little_memory(monkeypatch):
    """A tree of 60,000 rows and 20 features: the same nodes with and without dense sums, in under 120 MB."""
    import tracemalloc

    from pricelens.ml import grouped_trees as G
    rng = np.random.default_rng(3)
    columns = rng.integers(0, 64, (20, 60_000))
    stats = np.stack([np.ones(60_000, np.int64), rng.integers(1, 2**30, 60_000)], 1)

    def grown():
        nodes, leaf = G.grow(columns, stats, 1, "", 0, G.TreeSpec(depth=30, min_leaf=2), None)
        return [nodes[k].tolist() for k in nodes] + [leaf.tolist()]
    tracemalloc.start()
    got = grown()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 120
    for dense in (0, 10**12):
        monkeypatch.setattr(G, "DENSE", dense)
        assert grown() == got
