"""Tokens, packing, token files, SentencePiece, chat formatting and shards."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F


def library():
    from tokenizers import Tokenizer

    from pricelens.llm.tokens import default_vocabulary
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return t


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("alphabet", ["abs tredlvm'' \n\t  019,.!<|é日ñ\xa0　 Ⅷ\x85\x1c\x1d​﻿😀\U0001F9FFำ᠎", "st redvlm'  \n"])
def test_pieces_equal_the_library(alphabet):
    from pricelens.llm.tokens import default_vocabulary, encoded
    rng, t = random.Random(1), library()
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(8000)] + [None, "", "<|endoftext|> x"]
    got = [ids[a:b].tolist() for _, _, ids, bounds in encoded(pa.array(texts), default_vocabulary()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_packing(docs, rows, nothing):
    from pricelens.llm.packing import pack_documents
    t = library()
    got = pack_documents(docs).collect()
    tokens = collections.defaultdict(list)
    for r in rows:
        tokens[(r[0], len(ids := [*t.encode(r[1] or "", add_special_tokens=False).ids, 1]))].append(ids)
    covered = collections.Counter()
    for p in got:
        own = tokens[(p.doc_id, p.doc_tokens)]
        assert any(p.ids_crc32 == crc(x[p.start : p.start + p.length]) for x in own)
        covered[(p.doc_id, p.doc_tokens)] += p.length
    assert covered == {k: sum(map(len, v)) for k, v in tokens.items()}
    bins = collections.defaultdict(list)
    for p in got:
        bins[p.sequence_id].append((p.offset, p.length))
    for b in bins.values():
        end = 0
        for at, n in sorted(b):
            assert at == end
            end += n
        assert end <= 2048
    total = sum(p.length for p in got)
    assert len(bins) <= -(-total // 2048) + 1
    assert pack_documents(nothing).count() == 0


def test_best_filling_is_the_best():
    import itertools

    from pricelens.llm.packing import best_filling, minimum_bin_slack
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(0, 60)
        used = best_filling(room, counts)
        assert all(c <= counts[k] for k, c in used.items())
        sums = {sum(k * c for k, c in zip(counts, cs, strict=True)) for cs in itertools.product(*(range(c + 1) for c in counts.values()))}
        assert sum(k * c for k, c in used.items()) == max(s for s in sums if s <= room)
    counts = {k: rng.randint(0, 50) for k in range(1, 300)}
    plan = minimum_bin_slack(counts, 300)
    used = collections.Counter()
    for times, pattern in plan:
        assert sum(k * c for k, c in pattern.items()) <= 300
        used.update({k: c * times for k, c in pattern.items()})
    assert used == {k: n for k, n in counts.items() if n}


def test_token_files(docs, rows, nothing, spark, tmp_path):
    from pricelens.llm.rans import read_token_files, token_files, write_token_files
    t = library()
    want, start = [], 0
    for i, text in sorted((r[0] if r[0] is not None else -(2**63), r[1] or "") for r in rows):
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        want.append((None if i == -(2**63) else i, start, len(ids), crc(ids), ids))
        start += len(ids)
    write_token_files(docs, str(tmp_path / "a"))
    got = sorted((tuple(r) for r in read_token_files(spark, str(tmp_path / "a"), with_ids=True).collect()), key=lambda r: r[1])
    plain = [(i, a, n, c) for i, a, n, c, _ in want]
    # null texts and empty ones tie under the null id's order only
    assert [(r[1], r[2], r[3], r[4]) for r in got] == [(a, n, c, ids) for _, a, n, c, ids in want]
    assert collections.Counter(r[:4] for r in got) == collections.Counter(plain)
    assert token_files(nothing).count() == 0


def test_rans_blocks_checkpoints_and_checksum():
    from pricelens.llm.rans import Block, Table, encode_block
    rng = np.random.default_rng(3)
    for n, top in ((1, 1), (5, 3), (5000, 50000), (70000, 300), (40000, 1)):
        ids = np.minimum((rng.exponential(top / 8, n)).astype(np.int64), top - 1)
        table = Table.of_counts(np.bincount(ids))
        assert int(table.freq.sum()) == 1 << table.bits
        raw = encode_block(ids, table, [7], [n], 11, lanes=64, every=4096)
        block = Block(raw, every=4096)
        assert (block.ids(table) == ids).all() and block.start == 11
        for a in (0, n // 3, n - 1):
            assert (block.ids(table, a, a + 100) == ids[a : a + 100]).all()
        for at in (0, len(raw) // 2, len(raw) - 1):
            with pytest.raises(ValueError):
                Block(raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1 :])
    assert len(raw) < 2 * 40000  # one id only: nearly nothing but states


def models():
    import public_tokenizers
    raw = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    uni = raw.replace(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01")  # the same pieces, read as a unigram model
    return raw, uni


def test_sentencepiece_equals_the_library(docs, rows, nothing):
    import sentencepiece

    from pricelens.llm.sentencepiece_lattice import encode_documents
    raw, _ = models()
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    got = encode_documents(docs, raw=raw).collect()
    want = collections.Counter((r[0], tuple(sp.encode(r[1] or ""))) for r in rows)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert all(r.exact and r.ids_crc32 == crc(r.ids) for r in got)
    assert encode_documents(nothing).count() == 0


def test_unigram_lattice_takes_the_best_path(spark):
    import sentencepiece

    from pricelens.llm.sentencepiece_lattice import encode_documents
    _, uni = models()
    sp = sentencepiece.SentencePieceProcessor(model_proto=uni)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcde  \n\t'.,é日thieron") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    score = [sp.get_score(i) for i in range(sp.get_piece_size())]
    for r in encode_documents(docs, raw=uni).collect():
        best = sp.nbest_encode(texts[r.doc_id], nbest_size=1)[0]
        assert r.exact
        # equal sums are as good
        assert len(best) == len(r.ids) and sum(score[i] for i in best) == sum(score[i] for i in r.ids) or tuple(best) == tuple(r.ids)


def test_long_units_equal_short_ones():
    import sentencepiece

    from pricelens.llm.sentencepiece_lattice import Model
    raw, _ = models()
    m, sp = Model(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    rng = random.Random(9)
    for n in (5, 60, 500, 3000):
        w = "".join(rng.choice(["an", "na", "ther", "e", "ing"]) for _ in range(n))
        assert m.long_unit("▁" + w) == sp.encode(w)


def conversations(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", "hi <|x"), (1, 1, "assistant", said), (1, 2, "user", None), (1, 3, "assistant", "<\\|im_end|> \\ <"), (2, 0, "system", ""), (None, None, None, None),
            (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 1, "us\ner\\n", "q<")]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")


def test_chat_format_round_trip(spark):
    from pricelens.llm.chat_format import digests, escape, format_conversations, parse, unescape
    rows, table = conversations(spark)
    by = collections.defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] or -1, r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        by[c].append((r or "", x or ""))
    formatted = format_conversations(table)
    for r in formatted.collect():
        assert parse(r.formatted) == by[r.conv_id] and not r.rewrites
        assert [unescape(r.formatted[a:b]) for a, b in r.loss_spans] == [t for role, t in by[r.conv_id] if role == "assistant"]
        assert r.turn_spans[-1][1] == len(r.formatted)
    for r in digests(formatted).collect():
        turns = by[r.conv_id]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256("".join(b for a, b in turns if a == "assistant").encode()).hexdigest()
    assert format_conversations(table.filter("false")).count() == 0
    rng = random.Random(6)
    for _ in range(3000):
        s = "".join(rng.choice("<|\\a") for _ in range(rng.randint(0, 9)))
        assert unescape(escape(s)) == s and "<|" not in escape(s)


def test_templates_that_rewrite_history_are_told(spark):
    from pricelens.llm.chat_format import render
    last_only = lambda turns: "".join(f"[{r}]{t if k == len(turns) - 1 else t[:1]}" for k, (r, t) in enumerate(turns))
    s, spans, texts = render([("a", "one"), ("b", "two")], last_only)
    assert spans is None and s == "[a]o[b]two"
    plain = lambda turns: "".join(f"{r}: {t}\n\n" for r, t in turns)
    s, spans, texts = render([("a", "one"), ("b", "\n")], plain)
    assert [s[a:b] for a, b in spans] == ["a: one\n\n", "b: \n\n\n"] and [s[a:b] for a, b in texts] == ["one", "\n"]


def test_hilbert_curve(spark):
    from pricelens.llm.hilbert_shards import curve_table
    r = sorted(curve_table(spark).collect(), key=lambda x: x.curve)
    assert [x.curve for x in r] == list(range(4096))
    cells = [(x.cell >> 8, x.cell >> 4 & 15, x.cell & 15) for x in r]
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(cells, cells[1:], strict=False))


def test_shards(docs, rows, nothing, spark, tmp_path):
    from pricelens.llm.hilbert_shards import hilbert_shards, write_shards
    got = hilbert_shards(docs).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, r.curve))
    assert set(slots) == set(range(8)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    curve = []
    for s in sorted(slots):
        assert [x for x, _ in sorted(slots[s])] == list(range(len(slots[s])))
        curve += [c for _, c in sorted(slots[s])]
    assert curve == sorted(curve)
    assert hilbert_shards(nothing).count() == 0
    few = docs.dropDuplicates(["doc_id"]).limit(5)
    write_shards(few, str(tmp_path / "s"), 2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 5


def test_sources_with_one_prefix_lie_apart(spark):
    from pricelens.llm.hilbert_shards import hilbert_shards
    rows = [(100 * i + k, "same size", "en", f"https://host{i:02d}") for i in range(16) for k in range(10)]
    got = hilbert_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 4).collect()
    curve = collections.defaultdict(set)
    for r in got:
        curve[r.doc_id // 100].add(r.curve)
    assert len(got) == 160 and all(len(c) == 1 for c in curve.values()) and len(set.union(*curve.values())) == 16


def test_steps_of_strings(spark):
    from pricelens.llm.hilbert_shards import value_steps
    rng = random.Random(4)
    values = [f"src1{rng.choice('abcdefgh') * rng.randint(1, 9)}" for _ in range(700)] + ["", "é"]
    got = {r.value: r.step for r in value_steps(spark.createDataFrame([(v,) for v in values], "value string")).collect()}
    assert got == {v: 16 * sum(x.encode() < v.encode() for x in values) // len(values) for v in values}


def test_components_of_chains_and_stars(spark):
    from pricelens.llm.components import components
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges for x in (a, b) if root(x) != x or any(a != b and x in (a, b) for a, b in edges)}


def test_registered_names_and_null_columns(docs):
    from pricelens.llm.queries import QUERIES, SQL
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)
    blank = docs.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema)).limit(3)
    from pricelens.llm.ngram_join import ngram_components
    from pricelens.llm.quality import quality_rules
    assert [r.component_id for r in ngram_components(blank).collect()] == [None] * 3
    assert [r.kept for r in quality_rules(blank).collect()] == [False] * 3
