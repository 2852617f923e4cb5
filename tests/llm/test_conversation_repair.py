"""Conversation repair against exhaustive search."""

import hashlib
import itertools
import random
import re
import zlib

import pytest


def outcome(rows):
    """Cheapest (cost, audit, repaired) of [(role, text, fault)] over all edit strings with at most one insert more than rows."""
    best = None
    n = len(rows)

    def go(i, cost, audit, out, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == n:
            word = "".join(r[:1] or "?" for r, _ in out)
            if re.fullmatch("(s?(ua)+)?", word) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        else:
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", out, inserted)
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                go(i + 1, cost + extra, audit + "K", [*out, (role, text)], inserted)
                for to in ("user", "assistant"):
                    go(i + 1, cost + extra + 3, audit + "R", [*out, (to, text)], inserted)
        if inserted <= n:
            for to in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*out, (to, "")], inserted + 1)
    go(0, 0, "", [], 0)
    return best


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


CODE = {None: 0, "blank": 1, "duplicate": 2, "truncated": 3}


def code(role, fault):
    return CODE[fault] << 2 | ("sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3)


def test_search_equals_all_edits():
    from pricelens.llm.conversation_repair import search
    rng = random.Random(3)
    cases = [[]] + [[(r, "t", f)] for r in ("system", "user", "assistant", "tool", "") for f in CODE]
    cases += [[(r, "t", f) for r, f in c] for c in itertools.product([("system", None), ("user", None), ("assistant", None), ("tool", "truncated")], repeat=3)]
    cases += [[(rng.choice(["system", "user", "assistant", "x"]), "t", rng.choice([None, None, "blank", "truncated"])) for _ in range(rng.randint(2, 5))] for _ in range(60)]
    for rows in cases:
        cost, audit = search(bytes(code(r, f) for r, _, f in rows))
        assert (cost, audit.decode()) == outcome(rows)[:2], rows


def forward(codes):
    """The same optimum, prefix by prefix over all last roles."""
    from pricelens.llm.conversation_repair import GIVES, STEPS
    best = {0: (0, "")}

    def inserts(best):
        for _ in range(2):
            for q, (c, a) in list(best.items()):
                to = (c + 3, a + "I")
                best[GIVES[q]] = min(best.get(GIVES[q], to), to)
    for x in codes:
        inserts(best)
        after = {}
        for q, (c, a) in best.items():
            for k, e, to in STEPS[q][x]:
                new = (c + k, a + chr(e))
                after[to] = min(after.get(to, new), new)
        best = after
    inserts(best)
    return min(best[q] for q in (0, 3) if q in best)


def forward_cost(codes):
    from pricelens.llm.conversation_repair import GIVES, STEPS
    best = [0, 10**9, 3, 6]  # by last role, after up to two inserts
    for x in codes:
        after = [10**9] * 4
        for q in range(4):
            for k, _, to in STEPS[q][x]:
                after[to] = min(after[to], best[q] + k)
        for _ in range(2):
            for q in range(4):
                after[GIVES[q]] = min(after[GIVES[q]], after[q] + 3)
        best = after
    return min(best[0], best[3])


def test_search_of_longer_rows_and_its_size():
    from pricelens.llm.conversation_repair import search
    rng = random.Random(4)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 1, 2, 3, 4, 9, 13, 14, 12]) for _ in range(rng.randint(1, 60)))
        cost, audit = search(codes)
        assert (cost, audit.decode()) == forward(codes)
    for codes in (bytes([0]) * 50_000, bytes([1]) * 50_000, bytes([5]) * 50_000, bytes([1, 14, 3, 0]) * 12_500):  # strays, one role, blanks, a mix
        cost, audit = search(codes)
        assert len(audit) - audit.count(b"I") == len(codes) and cost == forward_cost(codes)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(6)
    said = ["Yes.", "No!", "cut off", "", " \n", "Why? ", "é.", "a:b\nc."]
    rows = [(k, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None]), rng.choice([*said, None])) for k in range(60) for t in range(rng.randint(1, 5))]
    rows += [(None, t, "user", f"{t}.") for t in (3, None, 9)] + [(70, None, "assistant", "x.")] * 3 + [(71, 5, "user", "tie."), (71, 5, "assistant", "tie."), (71, 5, "user", "a.")]
    rows += [(72, t, ["user", "assistant"][t % 2], f"long talk {t}.") for t in range(1500)]
    return rows


def damaged(rows):
    out = {}
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        role, text, kind = role if role is not None else " ", text if text is not None else " ", zlib.crc32(key.encode()) % 20
        out.setdefault(c, [])
        if kind:
            role = "user" if kind == 4 else role
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out[c] += [(t is not None, t or 0, role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(v) for c, v in out.items()}


def expected(rows):
    for c, v in damaged(rows).items():
        said = [(r, t) for _, _, r, t in v]
        f = faults(said)
        turns = [t for known, t, _, _ in v if known]
        word = [r[:1] for r, _ in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(word, word[1:]))
        codes = bytes(code(r, x) for (r, _), x in zip(said, f, strict=True))
        cost, audit = outcome([(r, t, x) for (r, t), x in zip(said, f, strict=True)])[:2] if len(v) < 5 else forward(codes)
        out, i, last = [], 0, ""
        for e in audit:
            role, text = ("", "") if e == "I" else said[i]
            i += e != "I"
            if e in "IR":
                role = "assistant" if last == "u" else "user"
            if e != "D":
                out.append(f"{role}:{text}")
                last = role[:1]
        yield c, (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_repaired_conversations(spark, talks):
    from pricelens.llm import conversation_repair as C
    frame = spark.createDataFrame([(*r, "k", 1) for r in talks], "conv_id long, turn long, role string, text string, run string, code int").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in C.repair_digests(C.damage(frame), frame).collect()}
    assert got == dict(expected(talks))
    repairs = C.repair_conversations(C.damage(frame))
    parts = [[(r.conv_id, r.run, r.roles, r.texts) for r in repairs.turns(whole).collect()] for whole in (True, False)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(parts[0], key=key) == sorted(parts[1], key=key)
    assert max(len(x[2]) for x in parts[0]) <= C.RUN_ROWS + 600 and sum(x[0] == 72 for x in parts[0]) >= 3  # a long talk is many runs


def test_no_conversations(spark):
    from pricelens.llm import conversation_repair as C
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair_digests(C.damage(frame), frame).collect() == []
    gone = spark.createDataFrame([(c, t, "user", "x.") for c in range(40) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0], frame.schema)
    got = C.repair_digests(C.damage(gone), gone).collect()
    assert got and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in got)
