"""A third of the rows share an id: with texts of their own, and with one text."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from test_text_operators import brute_passages, check_join

SCHEMA = "doc_id long, text string"


def prose(rng, n):
    return " ".join(rng.choice("th in er on re an st or".split()) + rng.choice("abcdefgh") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    passage = prose(rng, 60)
    own = [prose(rng, rng.randint(1, 120)) for _ in range(200)]
    own = [f"{t} {passage} {prose(rng, 10)}" if k % 9 == 0 else t for k, t in enumerate(own)]
    one = prose(rng, 40) + " " + passage
    return [(k, t) for k, t in enumerate(own)] + [(None, prose(rng, rng.randint(1, 120))) for _ in range(50)] + [(None, one)] * 60


@pytest.fixture(scope="module")
def hot(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(params=["ngram_join", "substring_dedup", "sentencepiece_lattice"])
def small(request, monkeypatch):
    import importlib
    m = importlib.import_module(f"pricelens.llm.{request.param}")
    monkeypatch.setattr(m, "BATCH_BYTES", 5_000)
    return request.param


def test_results(small, hot, rows):
    if small == "ngram_join":
        check_join(hot, rows)
    elif small == "substring_dedup":
        from pricelens.llm.substring_dedup import dedup_passages
        assert collections.Counter(tuple(-(2**63) if x is None else x for x in r) for r in dedup_passages(hot).collect()) == brute_passages(rows)
    else:
        import zlib

        import public_tokenizers
        import sentencepiece
        from pricelens.llm.sentencepiece_lattice import encode_documents
        library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

        def crc(ids):
            return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        want = collections.Counter((i, crc(library.encode(t))) for i, t in rows)
        assert collections.Counter((r.doc_id, r.ids_crc32) for r in encode_documents(hot).collect()) == want


def test_no_batch_is_hot(hot, rows):
    from pricelens.llm.batches import once, with_batch
    from pricelens.llm.common import id_text
    docs, size, several = once(id_text(hot), 5_000)
    assert several and size == sum(len(t) for _, t in rows)
    assert docs.agg(F.sum("times")).first()[0] == len(rows) and docs.filter("times > 1").count() == 1
    batches = with_batch(docs, 8).groupBy("batch").agg(F.sum(F.length("text")).alias("bytes")).collect()
    assert len(batches) == 8 and max(b.bytes for b in batches) <= 2 * sum(b.bytes for b in batches) / 8


def test_rows_that_fill_no_batch_stay_as_they_are(hot, rows):
    from pricelens.llm.batches import once
    from pricelens.llm.common import id_text
    docs, _, several = once(id_text(hot), 10**9)
    assert not several and docs.count() == len(rows) and docs.filter("times <> 1").isEmpty()


def test_a_result_stands_as_often_as_its_row(spark, monkeypatch):
    from pricelens.llm import batches
    monkeypatch.setattr(batches, "REPEATS", 7)
    got = batches.again(spark.createDataFrame([(1, 1), (2, 7), (3, 20)], "doc_id long, times long"), True)
    assert collections.Counter(r.doc_id for r in got.collect()) == {1: 1, 2: 7, 3: 20} and got.columns == ["doc_id"]
