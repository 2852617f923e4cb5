"""Secret spans and links against plain Python on every text."""

import hashlib
import random
import re

KINDS = ["assign", "access", "hex", "login", "phrase", "bare", "endpoint"]
IS = r"""["']?\x20*[:=]\x20*["']?"""
REACH = 120


def base(text):
    out = []
    for m in re.finditer(rf"(?i:password|passwd|secret|token|api_?key){IS}([A-Za-z0-9+/_.=-]+)", text):
        out.append((m.start(), 0, m.end(), len(m[1])))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        out += [(m.start(), 1, m.end(), 0)] * (len(m[0]) >= 20)
    for m in re.finditer("[0-9a-f]+", text):
        out += [(m.start(), 2, m.end(), 0)] * (len(m[0]) >= 24)
    return out


def brute(text):
    every = base(text)
    strong = sorted((a, k, z) for a, k, z, n in every if k or n >= 6)
    weak = [(a, 4, z) for a, k, z, n in every if k == 0 and 3 <= n < 6]
    logins = [(m.start(), 3, m.end()) for m in re.finditer(rf"(?i:user(?:name)?|login|account|client_?id){IS}[A-Za-z0-9._@+-]{{3,}}", text)]
    weak += [(m.start(), 4, m.end()) for m in re.finditer(rf"(?i:passphrase|pass|pwd|pin|credentials?|auth|key){IS}[A-Za-z0-9+/_.=@!#$%-]{{4,}}", text)]
    weak += [(m.start(), 5, m.end()) for m in re.finditer("[A-Za-z0-9+/]{32,}", text) if all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]"))]
    ends = [(m.start(), 6, m.end()) for m in re.finditer(rf"[A-Za-z][A-Za-z0-9+.-]{{1,15}}://[A-Za-z0-9._:@%-]+|(?i:host|server|endpoint|database){IS}[A-Za-z0-9._:-]{{3,}}", text)]
    near = lambda i, p: p[0] <= i[2] + REACH and p[2] >= i[0] - REACH
    out = set()
    for i in logins + [s for s in strong if s[1] == 1]:
        if mine := [s for s in weak + [s for s in strong if s[1] != 1] if near(i, s)]:
            out |= ({i} if i[1] == 3 else set()) | {s for s in mine if s in weak} | {e for e in ends if near(i, e)}
    join = lambda spans: ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)
    return (*(sum(k == j for _, k, _ in strong) for j in range(3)), hashlib.sha256(join(strong).encode()).hexdigest(), join(sorted(strong + list(out))), len(out))


def texts():
    rng = random.Random(8)
    pieces = ["user: bob", "Username=al.ice", "password = \"abc\"", "PASSWD: hunter22", "token=abcdef", "token=ab", "api-key: zzzzzzz", "apikey='0123456789'", "password=token:abcdefgh", "AKIA" + "Z9" * 8, "AKIAAKIA" + "A" * 30,
              "AKIAxAKIA12", "0123456789abcdef01234567", "deadbeef" * 4, "0123456789abcdef0123456", "key: s3cret!", "pin=12", "https://db.example.com:5432", "host = db1", "é ñ 日本", "pass: abcd",
              "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY1", "word " * 30, "\n\n", "x" * 200, "secret", "client_id: a-b-c", "Ünder score", "server:  é"]
    out = [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(250)]
    out += ["".join(rng.choice(pieces) for _ in range(6)) for _ in range(60)]
    out += ["", None, "user: bob" + " " * 120 + "pass: abcd", "user: bob" + " " * 121 + "pass: abcd", "user: bob " + "pass: abcd " * 40, "login=abc " * 400 + "key=abcd", "AKIA" + "Z9" * 8 + " " + "aB3" * 14, "plain text only"]
    return out


DDL = "doc_id long, text string, digest string, kind int, start long, bin string"


def test_spans_equal_plain_python(spark):
    from pricelens.llm.secret_scan import find_secrets
    rows = [(k, t, "d", 1, 2, "b") for k, t in enumerate(texts())]
    rows += [(None, rows[3][1], "d", 1, 2, "b"), (None, rows[4][1], "d", 1, 2, "b"), rows[5], rows[5]]
    got = sorted((tuple(r) for r in find_secrets(spark.createDataFrame(rows, DDL).repartition(4)).collect()), key=str)
    want = sorted(((r[0], *brute(r[1] or "")) for r in rows), key=str)
    assert got == want
    assert sum(r[-1] > 0 for r in got) > 50 and any(r[-1] == 0 and r[5] for r in got)
    assert find_secrets(spark.createDataFrame([], DDL)).collect() == []


def test_weak_candidates_alone_are_left_out():
    for alone in ("user: bob", "pass: abcd", "https://a.example.com", "password=abc", "user: bob at https://a.example.com"):
        assert brute(alone)[4] == ""
    assert brute("user: bob pass: abcd")[4] == "login:0:9,phrase:10:20"


def test_native_plan(spark):
    """No Python worker takes part."""
    from pricelens.llm import secret_scan as S
    docs = spark.createDataFrame([(1, "user: bob pass: abcd")], "doc_id long, text string")
    plan = S.find_secrets(docs)._jdf.queryExecution().toString() + S.linked(S.parts(S.matches(docs)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
