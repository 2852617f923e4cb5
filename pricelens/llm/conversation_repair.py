"""Operator 11: conversation structure repair by depth-first branch-and-bound.

Rows of a conversation are kept, re-roled, deleted or joined by inserted turns
until the initials of their roles read ``(s?(ua)+)?``, at the least cost and,
among the cheapest, with the ASCII-least audit (one letter per edit: D, I, K, R).

The search holds an explicit stack of open prefixes and visits children in the
order D, I, K, R, so prefixes come in the audit's own order.  A prefix goes
when its cost plus the suffix's lower bound (the cheapest edits of the rows
left, whatever role they end on) cannot beat the incumbent, or when the
dominance table of its node (rows read, last role) has a prefix that is as
cheap: that one came first, so its audit is less.  The bound misses the true
cost by at most one pair of inserted turns, so a node is opened a constant
number of times and the search is linear in the rows; it ends when no open
prefix is left, which proves the incumbent.

Rows are sorted over the cluster by ranges of (conversation, turn, role, text)
and packed into runs of bounded size, so a conversation that holds a third of
all rows is read, judged and repaired by many tasks.  One task searches a
conversation, over one byte per row; its audit is one string of that length.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import prepare, stored

#: A run holds at most so many rows, and no further row once it has so many bytes.
RUN_ROWS, RUN_BYTES = 512, 1_000_000
#: Costs of the edits and of leaving a truncated row in.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 3, 4, 3, 3
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_WORD, _ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"

# Last role given: none, system, user, assistant; by it, the one that an insert or a new role gives.
NONE, SYSTEM, USER, ASSISTANT = range(4)
GIVES = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Row initials 0 s, 1 u, 2 a, 3 other: the last role after keeping one, or -1.
KEEPS = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
_ENDS = (True, False, False, True)
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults that crc32 of ``conv_id:turn`` decides; a null is one space."""
    def filled(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def steps(last: int, fault: int, initial: int) -> Iterator[tuple[int, str, int]]:
    """(cost, edit, last role after it) of the edits of one row, in the order of their letters."""
    yield DELETE, "D", last
    if fault not in (BLANK, DUPLICATE):
        extra = LEFT_TRUNCATED if fault == TRUNCATED else 0
        if KEEPS[last][initial] >= 0:
            yield extra, "K", KEEPS[last][initial]
        yield REROLE + extra, "R", GIVES[last]


#: (cost, letter, last role) by last role and code (fault * 4 + initial).
STEPS = [[tuple((c, ord(e), q) for c, e, q in steps(last, code >> 2, code & 3)) for code in range(16)] for last in range(4)]


def suffix_bounds(codes: bytes) -> array:
    """At 4 * i + last role: the least cost of the rows from i on, whatever role they end on."""
    n = len(codes)
    out = array("q", bytes(32 * (n + 1)))
    after = [0, 0, 0, 0]
    for i in range(n - 1, -1, -1):
        code = codes[i]
        own = [min([c + after[q] for c, _, q in STEPS[last][code]]) for last in range(4)]
        one = [min(own[last], INSERT + own[GIVES[last]]) for last in range(4)]
        after = [min(own[last], INSERT + one[GIVES[last]]) for last in range(4)]
        out[4 * i : 4 * i + 4] = array("q", after)
    return out


def greedy_cost(codes: bytes, bounds: array) -> int:
    """Cost of the repair that follows the bounds and mends its end: the first cost to beat."""
    i, last, cost = 0, NONE, 0
    while i < len(codes):
        options = [(c + bounds[4 * (i + 1) + q], c, 1, q) for c, _, q in STEPS[last][codes[i]]]
        options.append((INSERT + bounds[4 * i + GIVES[last]], INSERT, 0, GIVES[last]))
        _, c, rows, last = min(options, key=lambda o: (o[0], -o[2]))
        cost, i = cost + c, i + rows
    while not _ENDS[last]:
        cost, last = cost + INSERT, GIVES[last]
    return cost


def search(codes: bytes) -> tuple[int, bytes]:
    """(cost, audit) of the cheapest repair of rows with these codes (fault * 4 + initial)."""
    n = len(codes)
    bounds = suffix_bounds(codes)
    limit = greedy_cost(codes, bounds) + 1  # a prefix must be able to end below it
    table = array("q", [limit]) * (4 * (n + 1))  # cheapest prefix so far by node
    audit, path = b"", bytearray()
    # open prefixes: node, letter | cost, length of the path before the letter
    nodes, costs = array("q", [NONE << 8]), array("q", [0])
    while nodes:
        node, held = nodes.pop(), costs.pop()
        cost, length, at, letter = held >> 32, held & 0xFFFFFFFF, node >> 8, node & 255
        if cost >= table[at] or cost + bounds[at] >= limit:
            continue
        table[at] = cost
        del path[length:]
        if letter:
            path.append(letter)
        i, last = at >> 2, at & 3
        if i == n and _ENDS[last]:
            limit, audit = cost, bytes(path)
            continue
        length = len(path)
        children = []
        if i < n:
            children += [(4 * (i + 1) + q, c, e) for c, e, q in STEPS[last][codes[i]]]
        children.append((4 * i + GIVES[last], INSERT, 73))
        children.sort(key=lambda x: -x[2])  # the least letter is opened first
        for to, c, e in children:
            if cost + c < table[to] and cost + c + bounds[to] < limit:
                nodes.append(to << 8 | e)
                costs.append((cost + c) << 32 | length)
    return limit, audit


RUNS = pa.schema([("conv_id", pa.int64()), ("run", pa.int64()), ("codes", pa.binary()), ("digests", pa.list_(pa.binary())), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
RUNS_DDL = "conv_id long, run long, codes binary, digests array<binary>, low long, high long, turns long, roles array<string>, texts array<string>"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition as runs of one conversation each."""
    run = serial = size = 0
    conv, held = None, []

    def out() -> pa.RecordBatch:
        known = [r[0] for r in held if r[0] is not None]
        row = {"conv_id": conv, "run": run << 32 | serial, "codes": bytes(r[3] for r in held), "digests": [r[4] for r in held], "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)), "roles": [r[1] for r in held], "texts": [r[2] for r in held]}
        return pa.RecordBatch.from_pylist([row], schema=RUNS)

    for b in batches:
        for c, turn, role, text, code, digest, part in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text", "code", "digest", "part")), strict=True):
            if held and (c != conv or len(held) >= RUN_ROWS or size >= RUN_BYTES):
                yield out()
                held, size, serial = [], 0, serial + 1
            conv, run = c, part
            held.append((turn, role, text, code, digest))
            size += len(text)
    if held:
        yield out()


def runs_of(conversations: DataFrame) -> DataFrame:
    """The rows by conversation and turn (a null turn first; ties by role and text), packed into runs."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    fault = F.when(~F.col("text").rlike(_WORD), BLANK).when(~F.col("text").rlike(_ENDED), TRUNCATED).otherwise(0)
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 32))
    rows = rows.withColumns({"code": (fault * 4 + initial).cast("int"), "digest": digest, "copy": F.monotonically_increasing_id()})
    # copies of a row are interchangeable, so the last range key may part them
    rows = rows.repartitionByRange(F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.col("copy")) \
        .sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id())
    return rows.select("conv_id", "turn", "role", "text", "code", "digest", "part").mapInArrow(_pack, RUNS_DDL)


FOUND = pa.schema([("conv_id", pa.int64()), ("run", pa.int64()), ("edits", pa.string()), ("last", pa.int32()), ("n_rows", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64())])
FOUND_DDL = "conv_id long, run long, edits string, last int, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def judged(codes: bytes, firsts: list[int]) -> bytes:
    """Codes in which a row said before is a duplicate, unless it is blank."""
    out, new = bytearray(codes), set(firsts)
    for i, code in enumerate(codes):
        if i not in new and code >> 2 != BLANK:
            out[i] = DUPLICATE << 2 | code & 3
    return bytes(out)


def _search_runs(conv: int | None, runs: list[dict]) -> list[dict]:
    """Edits of each run of a conversation, and a row (run null) of the conversation's figures."""
    codes = b"".join(r["codes"] for r in runs)
    cost, audit = search(codes)
    faults, initials = np.frombuffer(codes, np.uint8) >> 2, np.frombuffer(codes, np.uint8) & 3
    turns = sum(r["turns"] for r in runs)
    known = [r for r in runs if r["low"] is not None]
    turns -= sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    gaps = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
    out, at, last, row = [], 0, NONE, 0
    for k, r in enumerate(runs):
        began, state, stop = at, last, row + len(r["codes"])
        while row < stop or (k == len(runs) - 1 and at < len(audit)):
            e = audit[at]
            if e == 75:
                last = KEEPS[last][initials[row]]
            elif e != 68:
                last = GIVES[last]
            row += e != 73
            at += 1
        out.append({"conv_id": conv, "run": r["run"], "edits": audit[began:at].decode(), "last": state})
    out.append({"conv_id": conv, "run": None, "edits": audit.decode(), "n_rows": len(codes), "gaps": gaps, "blank": int((faults == BLANK).sum()), "duplicate": int((faults == DUPLICATE).sum()),
                "truncated": int((faults == TRUNCATED).sum()), "illegal": int((~_LEGAL[initials[:-1], initials[1:]]).sum()), "cost": cost})
    return out


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by conversation: each conversation is searched once its last run is read."""
    conv, held = None, []
    for b in batches:
        out = []
        for r in b.to_pylist():
            if held and r["conv_id"] != conv:
                out += _search_runs(conv, held)
                held = []
            conv = r["conv_id"]
            held.append({"run": r["run"], "codes": judged(r["codes"], r["firsts"] or []), "low": r["low"], "high": r["high"], "turns": r["turns"]})
        yield pa.RecordBatch.from_pylist(out, schema=FOUND)
    if held:
        yield pa.RecordBatch.from_pylist(_search_runs(conv, held), schema=FOUND)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run's edits come right before its rows."""
    edits, last = "", NONE
    for b in batches:
        out = []
        for r in b.to_pylist():
            if r["edits"] is not None:
                edits, last = r["edits"], r["last"]
                continue
            rows, roles, texts = iter(zip(r["roles"], r["texts"], strict=True)), [], []
            for e in edits:
                role, text = ("", "") if e == "I" else next(rows)
                if e == "K":
                    last = KEEPS[last]["sua".find(role[:1])]
                elif e in "IR":
                    last = GIVES[last]
                    role = NAMES[last]
                if e != "D":
                    roles.append(role)
                    texts.append(text)
            out.append({"conv_id": r["conv_id"], "run": r["run"], "roles": roles, "texts": texts})
        yield pa.RecordBatch.from_pylist(out, schema=TURNS)


TURNS = pa.schema([("conv_id", pa.int64()), ("run", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
TURNS_DDL = "conv_id long, run long, roles array<string>, texts array<string>"


@dataclass
class Repairs:
    #: conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit: one row per conversation
    summary: DataFrame
    _found: DataFrame
    _runs: DataFrame

    def turns(self, whole: bool = False) -> DataFrame:
        """conv_id, run, roles, texts: the repaired turns, run by run.

        With ``whole``, a partition holds all runs of its conversations in
        order; else runs are spread evenly.
        """
        edits = self._found.filter("run IS NOT NULL").select("conv_id", "run", "edits", "last", F.lit(None).cast("array<string>").alias("roles"), F.lit(None).cast("array<string>").alias("texts"))
        rows = self._runs.select("conv_id", "run", F.lit(None).cast("string").alias("edits"), F.lit(None).cast("int").alias("last"), "roles", "texts")
        both = edits.unionByName(rows).repartition("conv_id" if whole else "run")
        return both.sortWithinPartitions("conv_id", "run", F.col("edits").isNull()).mapInArrow(_repair, TURNS_DDL)


def repair_conversations(conversations: DataFrame) -> Repairs:
    """Repair the rows (conv_id, turn, role, text) of conversations.

    Rows go by turn, a null turn first, equal turns by role and text; a null
    role or text is one space; rows of a null conversation are one
    conversation.  A role without an initial cannot be kept.  A row's first fault counts: blank (nothing but separators),
    duplicate (role and text said before in the conversation), truncated (not
    ended by ``.``, ``!`` or ``?``).  Repeated rows are duplicates, an empty
    table gives empty results, other columns are left aside.
    """
    prepare(conversations.sparkSession)
    runs = stored(runs_of(conversations), "repair-runs")
    said = runs.select("conv_id", "run", F.posexplode("digests").alias("at", "digest"))
    firsts = said.groupBy("conv_id", "digest").agg(F.min(F.struct("run", "at")).alias("first")).groupBy("first.run").agg(F.collect_list("first.at").alias("firsts"))
    asked = runs.select("conv_id", "run", "codes", "low", "high", "turns").join(firsts, "run", "left").select("conv_id", "run", "codes", "low", "high", "turns", "firsts")
    found = stored(asked.repartition("conv_id").sortWithinPartitions("conv_id", "run").mapInArrow(_search, FOUND_DDL), "repair-found")
    summary = found.filter("run IS NULL").select("conv_id", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.col("edits").alias("audit"))
    return Repairs(summary, found, runs)


HASHES = pa.schema([("hash_id", pa.int64()), ("repaired_sha256", pa.string())])


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, begun, said = None, hashlib.sha256(), False, False
    for b in batches:
        out = []
        for r in b.to_pylist():
            if begun and r["conv_id"] != conv:
                out.append({"hash_id": conv, "repaired_sha256": state.hexdigest()})
                state, said = hashlib.sha256(), False
            conv, begun = r["conv_id"], True
            for role, text in zip(r["roles"], r["texts"], strict=True):
                state.update(f"{chr(10) if said else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                said = True
        yield pa.RecordBatch.from_pylist(out, schema=HASHES)
    if begun:
        yield pa.RecordBatch.from_pylist([{"hash_id": conv, "repaired_sha256": state.hexdigest()}], schema=HASHES)


def repair_digests(conversations: DataFrame, originals: DataFrame) -> DataFrame:
    """The summary of every conversation of ``originals``, with the hash of its
    repaired turns (``role:text``, newline-joined); one without rows has zeros.

    SHA-256 reads its input in order, so one task streams a conversation's turns.
    """
    repairs = repair_conversations(conversations)
    hashes = repairs.turns(whole=True).mapInArrow(_hash, "hash_id long, repaired_sha256 string")
    ids = originals.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    own = repairs.summary.withColumnRenamed("conv_id", "own_id")
    out = ids.join(own, F.col("conv_id").eqNullSafe(F.col("own_id")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("hash_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
