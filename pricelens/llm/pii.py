"""Operator 6: personal data by patterns, and terms that give it away.

The patterns find the protected entities (email, ip, card, phone).  Over the
distinct texts of the corpus, pointwise mutual information between an entity and
every other word of the texts that hold it estimates how much of the entity's
information the term discloses, weighed by how likely chance is to bring them
together as often.  Terms above the threshold are reported as spans
of kind ``term`` wherever a text that holds the entity has them, and generalised
or removed with it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import prepare, stored
from pricelens.llm.words import _BYTE, Words, run_hashes, running, slices

KINDS = ("email", "ip", "card", "phone", "term")

#: A term is disclosing when its weighed PMI is at least this share of the entity's information.
DISCLOSURE = 0.8
#: Texts of the entity's kind, as they are on average, that are added to the entity's own.
PRIOR = 1.0
#: Distinct terms whose counts a task holds before it writes them.
HELD_TERMS = 500_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is taken whole, so a match can only start where one begins.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_PUNCTUATION = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern: every @ with a run of local characters
    before it (not before the last match's end) and a dotted domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ip_ok(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in s.split("."))


def _card_ok(s: str) -> bool:
    d = [int(c) for c in s if c.isdigit()]
    if not 12 <= len(d) <= 19:
        return False
    twice = [2 * x - 9 * (x > 4) for x in d[-2::-2]]
    return (sum(d[-1::-2]) + sum(twice)) % 10 == 0


def _phone_ok(s: str) -> bool:
    return 9 <= sum(c.isdigit() for c in s) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the pattern matches, sorted; code points."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for k, (pattern, ok) in enumerate(((_IP, _ip_ok), (_CARD, _card_ok), (_PHONE, _phone_ok)), 1):
            if k == 3 and "+" not in text:
                continue
            out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if ok(m.group())]
    return sorted(out)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _key(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _punctuation(buf: np.ndarray) -> np.ndarray:
    """Whether each byte is punctuation: ASCII, Latin-1 signs, general (U+2000-206F) or CJK (U+3000-303F)."""
    out = _PUNCTUATION[buf]
    if buf.max(initial=0) < 0x80:
        return out
    x, y = buf[:-1], buf[1:]
    # not the letters that stand among the Latin-1 signs
    two = np.flatnonzero((x == 0xC2) & ~np.isin(y, (0xAA, 0xB5, 0xBA)))
    out[two] = out[two + 1] = True
    x, y, z = buf[:-2], buf[1:-1], buf[2:]
    three = np.flatnonzero(((x == 0xE2) & ((y == 0x80) | ((y == 0x81) & (z < 0xB0)))) | ((x == 0xE3) & (y == 0x80)))
    out[three] = out[three + 1] = out[three + 2] = True
    return out


def terms_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, start, end) of the words, lower-cased, without the punctuation around them; bytes."""
    w = Words(buf, offs, lower=True)
    n = len(buf)
    solid, at = ~(w.sep | _punctuation(buf)), np.arange(n)
    start = np.minimum.accumulate(np.where(solid, at, n)[::-1])[::-1][w.start]
    end = np.maximum.accumulate(np.where(solid, at, -1))[w.end - 1] + 1
    word = start < w.end
    start, end = start[word], end[word]
    return run_hashes(running(_BYTE[w.buf]), start, end), np.repeat(np.arange(len(w)), w.counts)[word], start, end


def _blank(buf: np.ndarray, spans: list[tuple[int, int, int]]) -> None:
    """Cuts the entities out of a text's bytes: a space for each byte."""
    place = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))
    for a, _, b in spans:
        buf[place[a] : place[b]] = 0x20


def term_spans(text: str, spans: list[tuple[int, int, int]], hashes: list[int]) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every place of the given terms; code points."""
    buf = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).copy()
    first = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    _blank(buf, spans)
    h, _, start, end = terms_of(buf, np.array([0, len(buf)]))
    hit = np.isin(h.view(np.int64), np.array(hashes, np.int64))
    return [(a, 4, b) for a, b in zip(first[start[hit]].tolist(), first[end[hit]].tolist(), strict=True)]


_ENTITY = pa.struct([("kind", pa.int32()), ("entity", pa.int64())])
_SCHEMA = pa.schema([("digest", pa.binary()), ("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()), ("n_phone", pa.int64()), ("base", pa.string()), ("filled", pa.bool_()),
                     ("entities", pa.list_(_ENTITY)), ("terms", pa.list_(pa.int64())), ("text", pa.string()), ("counted", pa.binary()), ("counts", pa.binary())])
_FOUND = ("digest binary, n_email long, n_ip long, n_card long, n_phone long, base string, filled boolean, "
          "entities array<struct<kind: int, entity: bigint>>, terms array<bigint>, text string, counted binary, counts binary")


def _find(digests: pa.Array, column: pa.Array) -> tuple[list[dict], list[tuple[np.ndarray, np.ndarray]]]:
    """Rows of the texts, and per slice its terms and the number of texts that hold each."""
    out, counts = [], []
    texts = [t or "" for t in column.to_pylist()]
    spans = [base_spans(t) for t in texts]
    for a, z, buf, offs in slices(column):
        buf = buf.copy()
        for k in range(a, z):
            if spans[k]:
                _blank(buf[offs[k - a] : offs[k - a + 1]], spans[k])
        h, doc, _, _ = terms_of(buf, offs)
        order = np.lexsort((doc, h))
        hs, ds = h[order], doc[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
        counts.append(np.unique(hs[new], return_counts=True))
        bounds = np.searchsorted(doc, np.arange(z - a + 1))
        for k in range(a, z):
            own = spans[k]
            n = [sum(x[1] == i for x in own) for i in range(4)]
            row = dict(zip(_SCHEMA.names, (digests[k].as_py(), *n, joined(own), bool(texts[k].strip(" \t\n\v\f\r"))), strict=False))
            if own:
                row["entities"] = [{"kind": i, "entity": e} for i, e in sorted({(i, _key(f"{i}:{texts[k][x:y].lower()}")) for x, i, y in own})]
                row["terms"] = np.unique(h[bounds[k - a] : bounds[k - a + 1]]).view(np.int64).tolist()
                row["text"] = texts[k]
            out.append(row)
    return out, counts


def _summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    terms, at = np.unique(np.concatenate([h for h, _ in counts]), return_inverse=True)
    n = np.zeros(len(terms), np.int64)
    np.add.at(n, at, np.concatenate([c for _, c in counts]))
    return terms, n


def find_base(texts: DataFrame) -> DataFrame:
    """A row per distinct text (digest, text) with its pattern matches; for a text that
    holds entities also these, its other terms and itself.  Rows without a digest hold
    packed counts: terms, and how many of a task's texts hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"counted": held[0][0].tobytes(), "counts": held[0][1].tobytes()}], _SCHEMA)

        for b in batches:
            for at in range(0, b.num_rows, 500):
                c = b.slice(at, 500)
                rows, counts = _find(c.column("digest"), c.column("text"))
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                held += counts
                if sum(len(h) for h, _ in held) > HELD_TERMS:
                    held = [_summed(held)]
                    if len(held[0][0]) > HELD_TERMS // 2:
                        yield packed()
                        held = []
        if held:
            held = [_summed(held)]
            yield packed()

    return texts.select("digest", "text").mapInArrow(run, _FOUND)


def _term_counts(found: DataFrame) -> DataFrame:
    """(term, n_term): distinct texts that hold the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, n in zip(b.column("counted").to_pylist(), b.column("counts").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, np.int64)), pa.array(np.frombuffer(n, np.int64))], names=["term", "n"])

    counts = found.filter(F.col("counted").isNotNull()).select("counted", "counts").mapInArrow(run, "term long, n long")
    return counts.groupBy("term").agg(F.sum("n").alias("n_term"))


def _chance(n_term: F.Column, n_both: F.Column, share: F.Column, rivals: F.Column) -> F.Column:
    """How many of ``rivals`` terms, each in ``n_term`` texts, chance brings into an entity's
    texts ``n_both`` times or more, when these hold ``share`` of all places a term can have:
    Chernoff's bound of the binomial tail, exact where every text of the term is the entity's."""
    a = n_both / n_term
    apart = a * F.ln(a / share) + F.when(a < 1, (1 - a) * F.ln((1 - a) / (1 - share))).otherwise(0.0)
    return F.when(share >= a, rivals.cast("double")).otherwise(rivals * F.exp(-n_term * apart))


def disclosing_terms(found: DataFrame) -> DataFrame:
    """(digest, hashes): the terms of each text that disclose an entity of it.

    Every count is one of distinct texts, so that copies prove nothing.  With
    p(x) = n(x) / distinct texts, PMI = log2(p(t|e) / p(t)) and an entity's
    information is -log2 p(e); a term found only beside the entity reaches it, a
    common one stays near zero.  Every pair that meets in a text is judged: p(t|e)
    backs off to the entity's kind, (n(e,t) + PRIOR p(t|kind)) / (n(e) + PRIOR),
    which weighs with an entity of one text and hardly with one of many.

    Most words that stand in a single text stand in one without an entity, so
    such a meeting says little.  The PMI is therefore weighed by 1 / (1 + E), where E is how
    many terms as frequent as this one (the same power of two) chance would bring
    into the entity's texts as often: the odds that this one is among them.  A
    text's chance follows its distinct terms, so long texts prove less.
    Entities of one kind that the same texts hold have the same figures and are
    judged as one group.
    """
    e = found.filter(F.size("entities") > 0)
    occurs = e.select("digest", F.size("terms").alias("m"), F.explode("entities").alias("e")).select("digest", "m", "e.kind", "e.entity")
    seen = occurs.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n_entity"), F.sum("m").alias("places"), F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("y"))
    seen = seen.select("kind", "entity", "n_entity", "places", F.xxhash64("kind", "n_entity", "x", "y").alias("group"))
    groups = occurs.join(seen, ["kind", "entity"]).select("digest", "group", "kind", "n_entity", "places").distinct()
    groups = stored(groups.groupBy("digest").agg(F.collect_list(F.struct("group", "kind", "n_entity", "places")).alias("groups")), "pii-groups")
    held = (e.select("digest", "terms").join(groups, "digest").select("digest", "terms", F.explode("groups").alias("g"))
            .select("digest", "g.*", F.explode("terms").alias("term")))
    pairs = held.groupBy("group", "kind", "n_entity", "places", "term").agg(F.count(F.lit(1)).alias("n_both"))
    kinds = e.select(F.array_distinct(F.transform("entities", lambda x: x["kind"])).alias("kinds"), "terms").select(F.explode("kinds").alias("kind"), "terms")
    of_kind = kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n_kind"))
    counts = stored(_term_counts(found), "pii-term-counts").withColumn("class", F.floor(F.log2("n_term")))
    # a row per power of two
    classes = counts.groupBy("class").agg(F.count(F.lit(1)).alias("rivals"), F.sum("n_term").alias("held"))
    n, m = found.agg(F.count_if("filled")).first()[0], classes.agg(F.sum("held")).first()[0] or 0
    known = (kinds.select("kind", F.explode("terms").alias("term")).groupBy("kind", "term").agg(F.count(F.lit(1)).alias("n_kind_both"))
             .join(counts, "term").join(F.broadcast(of_kind), "kind").join(F.broadcast(classes.select("class", "rivals")), "class")
             .select("kind", "term", "n_term", "rivals", (F.col("n_kind_both") / F.col("n_kind")).alias("p_kind")))
    scored = pairs.join(known, ["kind", "term"])
    beside = (F.col("n_both") + PRIOR * F.col("p_kind")) / (F.col("n_entity") + PRIOR)
    pmi = F.log2(beside * float(n) / F.col("n_term"))
    info = F.log2(F.lit(float(n)) / F.col("n_entity"))
    weighed = pmi / (1 + _chance(F.col("n_term"), F.col("n_both"), F.col("places") / F.lit(float(max(m, 1))), F.col("rivals")))
    # an entity of every text has no information to disclose
    bad = scored.select("group", "term", weighed.alias("pmi"), info.alias("info")).filter((F.col("pmi") > 0) & (F.col("pmi") >= DISCLOSURE * F.col("info")))
    # one row per (group, term) on the other side, so a hot entity can be split
    hits = held.select("digest", "group", "term").join(stored(bad.select("group", "term"), "pii-terms"), ["group", "term"], "left_semi")
    return hits.groupBy("digest").agg(F.collect_set("term").alias("hashes"))


def _digest() -> F.Column:
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def text_spans(docs: DataFrame) -> DataFrame:
    """digest, n_email, n_ip, n_card, n_phone, base, spans, n_term per distinct text."""
    prepare(docs.sparkSession)
    texts = docs.select(_digest().alias("digest"), F.col("text").cast("string").alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    found = stored(find_base(texts), "pii", compression="zstd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, n = [], []
            for text, hashes in zip(b.column("text").to_pylist(), b.column("hashes").to_pylist(), strict=True):
                base = base_spans(text)
                terms = term_spans(text, base, hashes)
                spans.append(joined(sorted(base + terms)))
                n.append(len(terms))
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(spans, pa.string()), pa.array(n, pa.int64())], names=["digest", "more", "n_term"])

    more = found.filter(F.size("entities") > 0).select("digest", "text").join(disclosing_terms(found), "digest")
    more = stored(more.mapInArrow(run, "digest binary, more string, n_term long"), "pii-spans")
    out = (found.filter(F.col("digest").isNotNull()).select("digest", "n_email", "n_ip", "n_card", "n_phone", "base").join(more, "digest", "left")
           .select("digest", "n_email", "n_ip", "n_card", "n_phone", "base", F.coalesce("more", "base").alias("spans"), F.coalesce("n_term", F.lit(0)).cast("long").alias("n_term")))
    # a table of its own, so that a join with it can split the rows of a text that is often copied
    return stored(out, "pii-found")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    One row per input row, in which ``spans`` holds the pattern matches and the
    disclosing terms by start, then kind.  A null text is empty; null or
    repeated ids are kept as they are; an empty table gives an empty result.
    """
    found = text_spans(docs).withColumn("base_sha256", F.sha2(F.col("base"), 256))
    return (docs.select("doc_id", _digest().alias("digest")).join(found, "digest")
            .select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term"))


def parse(spans: str) -> list[tuple[int, int, str]]:
    return [(int(a), int(b), k) for k, a, b in (x.split(":") for x in spans.split(",") if x)]


def sanitised(text: str | None, spans: str | None) -> str | None:
    """``text`` with each span generalised to its kind; overlapping spans become one."""
    if not text or not spans:
        return text
    out, done = [], 0
    merged: list[list] = []
    for a, b, k in sorted(parse(spans)):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    for a, b, k in merged:
        out += [text[done:a], f"[{k.upper()}]"]
        done = b
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with personal data and disclosing terms generalised in the text."""
    spans = text_spans(docs).filter(F.col("spans") != "").select(F.col("digest").alias("_llm_digest"), F.col("spans").alias("_llm_spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [sanitised(t, s) for t, s in zip(b.column("text").to_pylist(), b.column("_llm_spans").to_pylist(), strict=True)]
            at = b.schema.get_field_index("text")
            cols = [pa.array(texts, b.schema.field(at).type) if k == at else b.column(k) for k in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays(cols[:-1], names=b.schema.names[:-1])

    both = docs.join(spans, _digest() == F.col("_llm_digest"), "left").drop("_llm_digest")
    return both.mapInArrow(run, docs.schema)
