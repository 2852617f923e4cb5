"""Quality rules, fingerprints, personal data, n-gram join and passages against brute force."""

import collections
import hashlib
import re

import numpy as np
import pytest

SEP = r"[\x20\x09-\x0D]+"


def split(text):
    return [w for w in re.split(SEP, text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_quality(text):
    w = split(text)
    grams = collections.defaultdict(list)
    for i in range(len(w) - 7):
        grams[tuple(w[i : i + 8])].append(i)
    inside = {p for at in grams.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_quality_counts_and_hosts(docs, rows, nothing):
    from pricelens.llm.quality import quality_rules
    got = quality_rules(docs, keep_text=True).collect()
    assert len(got) == len(rows)
    hosts = collections.defaultdict(list)
    for r in got:
        n = brute_quality(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        hosts[r.host].append(r)
    d, f = len(got), sum(r.base_failed for r in got)
    m = f / d
    s2 = sum(len(v) * (sum(r.base_failed for r in v) / len(v)) ** 2 for v in hosts.values()) / d
    spread = max(s2 - m * m - m * (1 - m) * len(hosts) / d, 1e-6)
    strength = max(m * (1 - m) / spread - 1, 1.0)
    for v in hosts.values():
        rate = (sum(r.base_failed for r in v) + m * strength) / (len(v) + strength)
        assert all(abs(r.host_rate - rate) < 1e-9 and r.kept == (not r.base_failed and rate <= 0.6) for r in v)
    assert quality_rules(nothing).count() == 0


def test_bad_host_is_rejected_and_whole_rows_stay(spark):
    from pricelens.llm.quality import quality_documents, quality_rules
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(k, "short", "bad", 1) for k in range(90)] + [(100 + k, good, "bad", 1) for k in range(5)] + [(200 + k, good, "fine", 1) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert not got[100].base_failed and not got[100].kept and got[200].kept
    kept = quality_documents(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {200 + k for k in range(100)}


def test_fingerprints(docs, rows, nothing, spark):
    from pricelens.llm.fingerprints import digest, fingerprint_documents, from_hex, likeness, to_hex
    got = fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    order = sorted(((r[0] if r[0] is not None else -(2**63), r[1] or "") for r in rows), key=lambda x: (-x[0], x[1]))
    want = collections.Counter()
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        n = len(t) // 3
        e = t[: len(t) - n] + nxt[:n]
        a, b, c = (digest(x.encode()) for x in (t, e, nxt))
        want[(None if i == -(2**63) else i, len(t), hashlib.sha256(e.encode()).hexdigest(), to_hex(a), to_hex(b), likeness(a, b), likeness(a, c))] += 1
    assert collections.Counter(tuple(r) for r in got) == want
    d = digest(("hello world " * 50).encode())
    assert (from_hex(to_hex(d)) == d).all() and likeness(d, d) == 1
    assert fingerprint_documents(nothing).count() == 0
    one = fingerprint_documents(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).collect()[0]
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_fingerprints_over_many_ranges(spark, monkeypatch):
    from pricelens.llm import fingerprints
    rows = [(k * 7, f"text {k} " * (k % 5)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(tuple, fingerprints.fingerprint_documents(docs).collect()))
    plain = fingerprints.id_ranges
    monkeypatch.setattr(fingerprints, "id_ranges", lambda d: plain(d, each_bytes=100))
    assert sorted(map(tuple, fingerprints.fingerprint_documents(docs).collect())) == one


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute_spans(text):
    out = []
    for k, (p, ok) in enumerate([(EMAIL, lambda s: True), (IP, lambda s: all(int(x) <= 255 for x in s.split("."))),
                                 (CARD, lambda s: 12 <= len(x := re.sub("[^0-9]", "", s)) <= 19 and luhn(x)), (PHONE, lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15)]):
        out += [(m.start(), k, m.end()) for m in p.finditer(text or "") if ok(m.group())]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    import random

    from pricelens.llm.pii import base_spans
    rng = random.Random(1)
    for alphabet in ("a@.b-+ 1", "0123456789. -+()", "a1@.é-%+_ \n", "41 -1+"):
        for _ in range(4000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert base_spans(t) == brute_spans(t), t


def test_personal_data(docs, rows, nothing):
    from pricelens.llm.pii import find_personal_data
    got = find_personal_data(docs).collect()
    kinds = ["email", "ip", "card", "phone"]
    want = collections.Counter()
    for r in rows:
        s = brute_spans(r[1])
        want[(r[0], *(sum(x[1] == k for x in s) for k in range(4)), hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in s).encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    assert find_personal_data(nothing).count() == 0


def test_disclosing_terms_are_found_and_generalised(spark):
    from pricelens.llm.pii import find_personal_data, parse, sanitise
    import random
    rng = random.Random(2)
    filler = [f"f{i}" for i in range(300)]
    rows = [(k, " ".join(rng.choices(filler, k=40)) + f" zorblax writes jo@x.example.com {rng.choice(filler)} writes", "s") for k in range(12)]
    rows += [(100 + k, " ".join(rng.choices([*filler, *["writes"] * 30], k=80)), "s") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in find_personal_data(docs).collect():
        text = dict((x[0], x[1]) for x in rows)[r.doc_id]
        terms = {text[a:b] for a, b, k in parse(r.spans) if k == "term"}
        assert terms == ({"zorblax"} if r.doc_id < 100 else set())
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "[TERM] writes [EMAIL]" in clean[0] and clean[100] == rows[12][1]
    assert sanitise(docs).columns == docs.columns


def shingles(text):
    w = split(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(pairs):
    """Smallest id reachable by links of (id, shingles); ids may repeat."""
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(pairs):
        for j in range(i):
            b = pairs[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(pairs):
        least[root(i)] = min(least.get(root(i), k), k)
    return [least[root(i)] for i in range(len(pairs))]


def check_join(docs, rows):
    from pricelens.llm.ngram_join import ngram_components
    low = -(2**63)
    pairs = [(r[0] if r[0] is not None else low, shingles(r[1])) for r in rows]
    want = collections.Counter((i, len(s), c) for (i, s), c in zip(pairs, brute_components(pairs), strict=True))
    got = collections.Counter(tuple(low if x is None else x for x in r) for r in ngram_components(docs).collect())
    assert got == want


def test_ngram_join(docs, rows, nothing):
    from pricelens.llm.ngram_join import ngram_components
    check_join(docs, rows)
    assert ngram_components(nothing).count() == 0


@pytest.mark.parametrize("changes", [3, 8])
def test_ngram_join_in_a_group_of_near_copies(spark, changes):
    import random
    rng = random.Random(changes)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for k in range(150):
        t = list(base)
        for i in rng.sample(range(150), rng.randint(0, changes)):
            t[i] = rng.choice(["p", "q", f"u{k}_{i}"])
        rows.append((1000 - k, " ".join(t[: rng.choice([150, 150, 140])])))
    check_join(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def brute_passages(rows):
    first = {}
    ids = [(-(2**63) if r[0] is None else r[0], split(r[1])) for r in rows]
    for i, w in ids:
        for p in range(len(w) - 49):
            h = tuple(w[p : p + 50])
            first[h] = min(first.get(h, i), i)
    out = collections.Counter()
    for i, w in ids:
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p : p + 50])] < i for q in range(p, p + 50)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out[(i, len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def test_difference_cover():
    from pricelens.llm.substring_dedup import ANCHOR, COVER, PERIOD, WINDOW
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
    assert ANCHOR + PERIOD - 1 == WINDOW


def test_passages(docs, rows, nothing):
    from pricelens.llm.substring_dedup import dedup_passages
    got = collections.Counter(tuple(-(2**63) if x is None else x for x in r) for r in dedup_passages(docs).collect())
    want = brute_passages(rows)
    assert got == want and sum(k[2] * n for k, n in want.items()) > 500
    assert dedup_passages(nothing).count() == 0


def test_windows_hash_by_content():
    from pricelens.llm.words import Words
    a = b"one two  three four\n five one two three four five"
    w = Words(np.frombuffer(a, np.uint8), np.array([0, len(a)]))
    h, whole = w.windows(5)
    assert h[0] == h[5] and list(whole) == [True] * 6 + [False] * 4 and len(set(h[:6].tolist())) == 5


def terms_by_text(docs):
    """Reported terms (lower-cased) per id."""
    from pricelens.llm.pii import find_personal_data, parse
    text = {r.doc_id: r.text for r in docs.collect()}
    return {r.doc_id: {text[r.doc_id][a:b].lower() for a, b, k in parse(r.spans) if k == "term"} for r in find_personal_data(docs).collect()}


def test_copies_do_not_hide_a_disclosing_term(spark):
    filler = [f"f{i}" for i in range(20)]
    rows = [(100 * g + k, f"{' '.join(filler)} g{g} zorblax writes jo@x.example.com now") for g in range(3) for k in range(30)]
    rows += [(1000 + k, f"{' '.join(filler)} writes now {k}") for k in range(60)]
    got = terms_by_text(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all("zorblax" in got[i] and not got[i] & {"writes", "now", "f3"} for i, _ in rows[:90])


def test_one_text_is_no_proof_and_small_shares_are_judged(spark):
    filler = " ".join(f"f{i}" for i in range(20))
    rows = [(0, f"{filler} zorblax writes jo@x.example.com now")]
    rows += [(1 + k, f"{filler} {'quimby' if k < 4 else ''} writes al@x.example.com now and{k}") for k in range(10)]
    rows += [(100 + k, f"{filler} writes now {k}") for k in range(300)]
    got = terms_by_text(spark.createDataFrame(rows, "doc_id long, text string"))
    # every text has a word of its own, so that of text 0 tells nothing; four meetings in four do
    assert {i: t for i, t in got.items() if t} == {1 + k: {"quimby"} for k in range(4)}


def test_terms_far_from_the_entity_and_glued_to_it(spark):
    filler = " ".join(f"f{i}" for i in range(30))
    rows = [(k, f"“Zorblax” starts. {filler} é {filler} zorblax, again; quimby<jo@x.example.com> {k}") for k in range(3)]
    rows += [(100 + k, f"starts. {filler} é again; {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = terms_by_text(docs)
    assert {i: t for i, t in got.items() if t} == {k: {"zorblax", "quimby"} for k in range(3)}
    from pricelens.llm.pii import sanitise
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert clean[0] == f"“[TERM]” starts. {filler} é {filler} [TERM], again; [TERM]<[EMAIL]> 0" and clean[100] == rows[3][1]


def planted_corpus(seed):
    """Texts of Zipf-like words and words of their own; people with an address, who have a word
    that stands beside it alone, or one that stands in other texts as well."""
    import random
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]

    def prose(k):
        n = rng.choice([15, 30, 60, 300])
        return [*rng.choices(common, weights, k=n), *(f"own{k}x{i}" for i in range(n // 5)), *(f"rare{rng.randrange(900)}" for _ in range(n // 8))]

    rows, planted = [], {}
    for p in range(40):
        for _ in range(rng.choice([2, 3, 5])):
            k = len(rows)
            w = [*prose(k), f"jo{p}@x.example.com", f"name{p}", f"loose{p % 7}"]
            rng.shuffle(w)
            rows.append((k, " ".join(w)))
            planted[k] = {f"name{p}"}
    for _ in range(700):
        k = len(rows)
        w = [*prose(k), *([f"loose{k % 7}"] if k % 3 == 0 else []), *([f"+49 30 {k:07d}"] if k % 20 == 0 else [])]
        rng.shuffle(w)
        rows.append((k, " ".join(w)))
    return rows, planted


def brute_terms(rows):
    """The weighed PMI of every entity and term of one text, counted plainly."""
    import math

    from pricelens.llm.pii import DISCLOSURE, PRIOR
    held, words = {}, {}
    for i, t in rows:
        spans = brute_spans(t)
        held[i] = {(k, t[a:b].lower()) for a, k, b in spans}
        for a, _, b in spans:
            t = t[:a] + " " * (b - a) + t[b:]
        words[i] = {w.strip(".,+") for w in t.lower().split()} - {""}
    df = collections.Counter(w for ws in words.values() for w in ws)
    rivals = collections.Counter(n.bit_length() for n in df.values())
    n, places = len(rows), sum(df.values())
    texts, of_kind = collections.defaultdict(set), collections.defaultdict(set)
    for i, es in held.items():
        for e in es:
            texts[e].add(i)
            of_kind[e[0]].add(i)
    out = collections.defaultdict(set)
    for (kind, _), own in texts.items():
        near = of_kind[kind]
        share = sum(len(words[i]) for i in own) / places
        for w in set().union(*(words[i] for i in own)):
            both = sum(w in words[i] for i in own)
            a = both / df[w]
            apart = a * math.log(a / share) + ((1 - a) * math.log((1 - a) / (1 - share)) if a < 1 else 0)
            e = rivals[df[w].bit_length()] * (1 if share >= a else math.exp(-df[w] * apart))
            pmi = math.log2((both + PRIOR * sum(w in words[i] for i in near) / len(near)) / (len(own) + PRIOR) * n / df[w]) / (1 + e)
            if pmi > 0 and pmi >= DISCLOSURE * math.log2(n / len(own)):
                for i in own:
                    out[i] |= {w} & words[i]
    return {i: t for i, t in out.items() if t}


@pytest.mark.parametrize("seed", [1, 2])
def test_terms_equal_plain_counts_and_planted_ones_are_found(spark, seed):
    rows, planted = planted_corpus(seed)
    got = {i: t for i, t in terms_by_text(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).items() if t}
    assert got == brute_terms(rows)
    hits = sum(len(t & planted.get(i, set())) for i, t in got.items())
    found, wanted = sum(map(len, got.values())), sum(map(len, planted.values()))
    print(f"precision {hits / found:.3f} recall {hits / wanted:.3f}")
    assert hits >= 0.9 * found and hits >= 0.9 * wanted
