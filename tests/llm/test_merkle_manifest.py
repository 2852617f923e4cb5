"""The Merkle manifest against plain hashing of whole trees."""

import hashlib
import random
import zlib


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*map(coded, (r[0], r[3], r[2], r[4], text)))


def up(nodes):
    """All levels up to one node."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) by hashing every tree anew for every changed leaf."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: up([leaf(r, r[1]) for r in sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))]) for g, v in groups.items()}
    top = up([trees[g][-1][0] for g in order])
    for k, g in enumerate(order):
        v = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        for i, r in enumerate(v):
            siblings, at = [], i
            for nodes in trees[g][:-1]:
                siblings += [x for j, x in enumerate(nodes) if j // 8 == at // 8 and j != at]
                at //= 8
            at = k
            for nodes in top[:-1]:
                siblings += [x for j, x in enumerate(nodes) if j // 8 == at // 8 and j != at]
                at //= 8
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            first = list(trees[g][0])
            first[i] = leaf(r, text)
            subs = [x[-1][0] for x in (trees[o] for o in order)]
            subs[k] = up(first)[-1][0]
            folded = up(subs)[-1][0]
            yield r[0], trees[g][0][i], trees[g][-1][0], top[-1][0], h(*siblings), folded, folded == top[-1][0]


DDL = "doc_id long, text string, lang string, source string, n_chars long, rank string, grp int, n string"


def corpus(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            k = len(rows) if rng.random() < 0.8 else rng.choice([None, 5, 7])
            text = rng.choice([None, "", "plain", f"Upper É {len(rows)}", "same Text"])
            rows.append((k, text, lang, rng.choice(["s", None, "a:b"]), rng.choice([None, 3]), "x", 1, "y"))
    return rows + rows[:3]


def key(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def test_manifest_equals_plain_trees(spark):
    from pricelens.llm.merkle_manifest import verify_documents
    rows = corpus(1, {None: 9, "en": 131, "de": 1, "fr": 8, "es": 64, **{f"l{k}": 2 for k in range(9)}})
    frame = spark.createDataFrame(rows, DDL).repartition(4)
    got = sorted((tuple(r) for r in verify_documents(frame).collect()), key=key)
    assert got == sorted(expected(rows), key=key)
    assert {r[-1] for r in got} == {True, False}
    assert verify_documents(spark.createDataFrame([], DDL)).collect() == []
    lone = verify_documents(spark.createDataFrame(rows[:1], DDL)).collect()[0]
    assert lone.leaf == lone.subroot == lone.root and lone.proof_sha256 == h()


def test_many_passes(spark):
    """With chunks of one level every group takes several passes up and down."""
    from pricelens.llm import merkle_manifest as M
    rows = corpus(2, {None: 3, "en": 600, **{f"l{k}": 1 for k in range(12)}})
    got = sorted((tuple(r) for r in M.verify_documents(spark.createDataFrame(rows, DDL).repartition(4), levels=1).collect()), key=key)
    assert got == sorted(expected(rows), key=key)


def test_fold_resumes_the_state():
    from pricelens.llm.merkle_manifest import Parent
    children = [h(str(k)).encode() for k in range(8)]
    p = Parent(children)
    for slot in range(8):
        assert p.fold(slot, children[slot]) == p.digest
        other = h("x").encode()
        assert p.fold(slot, other).decode() == hashlib.sha256(b"".join([*children[:slot], other, *children[slot + 1 :]])).hexdigest()
