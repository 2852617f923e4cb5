"""The pipeline's stages against brute force, each on its own input."""

import collections

import corpus_pipeline as C
from pyspark.sql import functions as F

from test_text_operators import brute_components, brute_passages, brute_quality, brute_spans, shingles

KEY = -(2**63)


def as_rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages(docs, rows, spark):
    first = C.keep_quality(spark, docs, "")
    assert first.columns == docs.columns and first.schema == docs.schema
    fails = {r[1] for r in rows if (n := brute_quality(r[1]))[0] < 20 or 100 * n[4] > 30 * n[0]}
    kept = as_rows(first)
    assert collections.Counter(kept) == collections.Counter(tuple(r) for r in rows if r[1] not in fails)

    second = C.drop_near_copies(spark, first, "")
    assert second.columns == docs.columns
    pairs = [(KEY if r[0] is None else r[0], shingles(r[1])) for r in kept]
    stay = {i for (i, s), c in zip(pairs, brute_components(pairs), strict=True) if not s or i == c}
    near = as_rows(second)
    assert sorted((KEY if r[0] is None else r[0]) for r in near) == sorted(stay)

    third = C.drop_passages(spark, second, "")
    assert third.columns == docs.columns
    want = {i: (kept_text if gone else None) for i, _, gone, kept_text, _ in brute_passages(near)}
    text = {(KEY if r[0] is None else r[0]): r[1] for r in near}
    expected = {i: text[i] if k is None else k for i, k in want.items() if k != ""}
    cut = as_rows(third)
    assert {(KEY if r[0] is None else r[0]): r[1] for r in cut} == expected
    assert any(v is not None for v in want.values())

    fourth = C.hide_personal_data(spark, third, "")
    assert fourth.columns == docs.columns
    clean = {r[0]: r for r in as_rows(fourth)}
    assert len(clean) == len(cut)
    for r in cut:
        if not brute_spans(r[1]):
            assert clean[r[0]][1] == r[1]
        else:
            assert not brute_spans(clean[r[0]][1])
    i = docs.columns.index("n_chars")
    assert all(r[i] == len(r[1]) for r in clean.values())

    packed = C.pack(spark, fourth, "")
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert len(whole) == len(clean) and all(r.n == r.t for r in whole)


def test_null_and_repeated_ids_are_told_apart_by_text(spark):
    """Distinct texts without an id, or with one id, all stay; their near copies go."""
    def text(name, n=80):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (7, text("d")),
            (8, text("a", 79)), (9, text("b", 79)), (10, text("c", 79)), (11, text("e")), (12, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = C.drop_near_copies(spark, docs, "")
    want = collections.Counter([(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (11, text("e")), (12, ""), (None, "")])
    assert collections.Counter(as_rows(near)) == want

    rows = [(1, text("p")), (7, text("q") + " " + text("p")), (7, text("r")), (7, text("r"))]
    got = as_rows(C.drop_passages(spark, spark.createDataFrame(rows, "doc_id long, text string"), ""))
    assert collections.Counter(got) == collections.Counter([(1, text("p")), (7, text("q")), (7, text("r")), (7, text("r"))])


def test_empty_table(nothing, spark):
    docs = nothing
    for _, stage in C.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run_and_registration(spark, tmp_path, docs):
    import __spark_entry__ as E
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert E.queries()["pipeline"](spark, str(tmp_path)).count() > 20
    assert "pipeline" not in E.oracle_sql()
