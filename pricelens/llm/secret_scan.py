"""Operator 13 [native]: secret scan with multipart credential linking.

Strong patterns (assign, access, hex) are reported wherever they match.  Weak
candidates, which alone are everyday text, are parts of a credential: an access
identifier (login, or a strong access key), a secret (phrase, bare, or a strong
assign or hex) and an endpoint.  The stretch around each identifier is its
scope; an interval join of scopes and parts within a text, on bins of the
scope's width, reports a login and the weak secrets of its scope when both are
there, and an endpoint when the scope holds identifier and secret.

DataFrame functions only.  A row's matches come from its text in place; offsets
are running sums over the rows' matches, once for each distinct text that has
any, so copies of a text cost nothing more and a text's matches may be many.
A bin holds a bounded number of parts, since parts of a kind do not overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import prepare, stored

#: Code points around an identifier that are its scope.
REACH = 120
#: Fewest characters of an assigned value, an access key, a hexadecimal run and a weak assigned value.
ASSIGNED, ACCESS, HEX, WEAK_ASSIGNED = 6, 20, 24, 3

_IS = r"""["']?\x20*[:=]\x20*["']?"""
#: Kinds in the order of reports.  Runs that are too short can start no longer match later on in them, so their length is part of the pattern.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": f"AKIA[A-Z0-9]{{{ACCESS - 4},}}",
    "hex": f"[0-9a-f]{{{HEX},}}",
    "login": f"(?i:user(?:name)?|login|account|client_?id){_IS}[A-Za-z0-9._@+-]{{3,}}",
    "phrase": f"(?i:passphrase|pass|pwd|pin|credentials?|auth|key){_IS}[A-Za-z0-9+/_.=@!#$%-]{{4,}}",
    "bare": "[A-Za-z0-9+/]{32,}",
    "endpoint": f"[A-Za-z][A-Za-z0-9+.-]{{1,15}}://[A-Za-z0-9._:@%-]+|(?i:host|server|endpoint|database){_IS}[A-Za-z0-9._:-]{{3,}}",
}
KINDS = list(PATTERNS)
STRONG = KINDS[:3]
_MATCHES = "array<struct<gap:int,len:int,good:boolean>>"


def _matches(kind: str, wanted: Column) -> Column:
    """gap before, length and verdict of each match of the text, where it is wanted."""
    pattern, text = PATTERNS[kind], F.col("text")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    if kind == "assign":
        values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), F.char_length)
        good = F.transform(values, lambda n: n >= ASSIGNED)
        # a value of fewer characters than a weak one needs is no part: its verdict is null
        good = F.zip_with(good, values, lambda g, n: F.when(n >= WEAK_ASSIGNED, g))
    elif kind == "bare":
        good = F.transform(hits, lambda x: x.rlike("[0-9]") & x.rlike("[A-Z]") & x.rlike("[a-z]"))
    else:
        good = F.transform(hits, lambda x: F.lit(True))
    lengths = F.transform(hits, F.char_length)
    rows = F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), lengths.alias("len"), good.alias("good")), lambda x: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), x["good"].alias("good")))
    return F.when(wanted & text.rlike(pattern), rows).otherwise(F.array().cast(_MATCHES)).cast(_MATCHES).alias(kind)


def matches(docs: DataFrame) -> DataFrame:
    """doc_id, the matches of each kind, and ``digest`` of a text that has any (else null).

    Weak kinds are looked for only in texts with an identifier, since without one nothing is linked.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sign = F.col("text").contains(":") | F.col("text").contains("=")
    rows = rows.select("*", _matches("assign", sign), _matches("access", F.col("text").contains("AKIA")), _matches("hex", F.lit(True)), _matches("login", sign))
    named = (F.size("login") > 0) | (F.size("access") > 0)
    rows = rows.select("*", *(_matches(k, named) for k in ("phrase", "bare", "endpoint")))
    some = F.lit(False)
    for k in KINDS:
        some = some | (F.size(k) > 0)
    return rows.select("doc_id", *KINDS, F.when(some, F.sha2("text", 256)).alias("digest"))


def _listed(kind: str) -> Column:
    """The matches of a kind with the kind and their number."""
    number = F.lit(KINDS.index(kind)).alias("kind")
    return F.transform(kind, lambda x, i: F.struct(number, i.alias("at"), x["gap"].alias("gap"), x["len"].alias("len"), x["good"].alias("good")))


def parts(found: DataFrame) -> DataFrame:
    """digest, kind, start, end, good: every match once for each distinct text; code points, end exclusive."""
    texts = found.filter("digest IS NOT NULL").groupBy("digest").agg(*(F.first(k).alias(k) for k in KINDS))
    listed = F.flatten(F.array(*map(_listed, KINDS)))
    rows = texts.select("digest", F.explode(listed).alias("m")).select("digest", "m.*")
    end = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("digest", "kind").orderBy("at"))
    return rows.withColumn("end", end).select("digest", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "good")


def _bins(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(first / (2 * REACH)), F.floor(last / (2 * REACH)))).alias("bin")


def linked(all_parts: DataFrame) -> DataFrame:
    """digest, kind, start, end of the weak candidates whose complementary parts are in one scope."""
    k = F.col("kind")
    assign, access, hexes, login, phrase, bare, endpoint = (k == i for i in range(len(KINDS)))
    # an assigned value too short for the strong pattern is a weak secret
    role = F.when(login | (access & F.col("good")), "identifier").when((assign & F.col("good").isNotNull()) | (hexes & F.col("good")) | phrase | (bare & F.col("good")), "secret").when(endpoint, "endpoint")
    weak = login | phrase | bare | endpoint | (assign & ~F.col("good"))
    shown = F.when(assign, KINDS.index("phrase")).otherwise(k)
    rows = all_parts.select("digest", shown.alias("kind"), "start", "end", role.alias("role"), F.coalesce(weak, F.lit(False)).alias("weak")).filter("role IS NOT NULL")
    scopes = rows.filter("role = 'identifier'").select("digest", F.col("kind").alias("id_kind"), F.col("start").alias("id_start"), F.col("end").alias("id_end"), F.col("weak").alias("id_weak"),
                                                         (F.col("start") - REACH).alias("low"), (F.col("end") + REACH).alias("high"))
    scopes = scopes.select("*", _bins(F.col("low"), F.col("high")))
    others = rows.filter("role <> 'identifier'").select("*", _bins(F.col("start"), F.col("end") - 1))
    meet = scopes.join(others, ["digest", "bin"]).filter("start <= high AND end >= low")
    secrets = meet.filter("role = 'secret'")
    full = secrets.select("digest", "id_start", "id_end").distinct()
    ends = meet.filter("role = 'endpoint'").join(full, ["digest", "id_start", "id_end"], "left_semi")
    out = secrets.filter("id_weak").select("digest", F.col("id_kind").alias("kind"), F.col("id_start").alias("start"), F.col("id_end").alias("end"))
    return out.unionByName(secrets.filter("weak").select("digest", "kind", "start", "end")).unionByName(ends.select("digest", "kind", "start", "end")).distinct()


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat(F.get(names, x["kind"]), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked: one row per document.

    A null text is empty; an empty text has no spans; rows with equal or null
    ids are documents of their own; an empty table gives no rows; other columns
    are left aside.  A linked span may lie inside or across a strong one.
    """
    prepare(docs.sparkSession)
    found = stored(matches(docs), "secret-matches")
    every = stored(parts(found), "secret-parts")
    strong = every.filter((F.col("kind") < len(STRONG)) & F.col("good")).select("digest", "kind", "start", "end", F.lit(True).alias("base"))
    spans = strong.unionByName(linked(every).withColumn("base", F.lit(False)))
    each = spans.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("s"))
    base = F.filter("s", lambda x: x["base"])
    counts = [_count(base, k) for k in STRONG]
    each = each.select("digest", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"), (F.size("s") - F.size(base)).cast("long").alias("n_linked"))
    none = [F.lit(0).cast("long").alias(f"n_{k}") for k in STRONG] + [F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"), F.lit(0).cast("long").alias("n_linked")]
    filled = [F.coalesce(c, n).alias(c) for c, n in zip(each.columns[1:], none, strict=True)]
    clean = found.filter("digest IS NULL").select("doc_id", *none)
    return clean.unionByName(found.filter("digest IS NOT NULL").select("doc_id", "digest").join(each, "digest", "left").select("doc_id", *filled))
