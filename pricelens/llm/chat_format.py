"""Operator 4: chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.  The
successive prefixes of a conversation are rendered; where each output begins
with the one before, the difference is the new turn's span, and where it does
not, the template rewrites history and the conversation is reported so.  A
probe rendered in the text's place shows where the text begins inside its span.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import prepare

Turns = list[tuple[str, str]]

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash more stands between ``<`` and ``|``."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(s), flags=re.S)


@functools.lru_cache(4096)
def _turn(role: str, text: str) -> str:
    return f"{START}{_role_out(role)}\n{escape(text)}{END}\n"


def chat_template(turns: Turns) -> str:
    """Turns between control strings; control strings inside roles and texts are escaped."""
    return "".join(_turn(r, t) for r, t in turns)


def parse(formatted: str) -> Turns:
    """The turns back from :func:`chat_template`'s output."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, text = part.partition("\n")
        out.append((_role_in(role), unescape(text[: text.rindex(END)])))
    return out


def _probe(turns: Turns) -> str:
    k = 0
    while any(f"{k}" in t for _, t in turns):
        k += 1
    return f"{k}"


def render(turns: Turns, template: Callable[[Turns], str] = chat_template) -> tuple[str, list[tuple[int, int]] | None, list[tuple[int, int]] | None]:
    """(output, span of each turn, span of each text); no spans if the template rewrites history."""
    probe, before, spans, texts = _probe(turns), template([]), [], []
    for k, (role, text) in enumerate(turns):
        now = template(turns[: k + 1])
        if not now.startswith(before):
            return template(turns), None, None
        tried = template([*turns[:k], (role, probe)])
        at = tried.find(probe, len(before))
        if at < 0 or not tried.startswith(before):
            return template(turns), None, None
        spans.append((len(before), len(now)))
        texts.append((at, len(now) - (len(tried) - at - len(probe))))
        before = now
    return before, spans, texts


SCHEMA = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("turn_spans", pa.list_(pa.list_(pa.int64()))), ("loss_spans", pa.list_(pa.list_(pa.int64()))), ("rewrites", pa.bool_())])


def format_conversations(conversations: DataFrame, template: Callable[[Turns], str] = chat_template, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, formatted, turn_spans, loss_spans (code points, end exclusive), rewrites.

    Turns go by ``turn``, equal ones by role and text; a null turn is first, a
    null role or text is empty; rows of the null conversation are one
    conversation.  Spans are null if the template rewrites history.  The result
    is one string per conversation, so a conversation is held by one task.
    """
    prepare(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv_id", F.expr("transform(t, x -> x.role)").alias("roles"), F.expr("transform(t, x -> x.text)").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, roles, texts in zip(*(b.column(c).to_pylist() for c in ("conv_id", "roles", "texts")), strict=True):
                s, spans, inner = render(list(zip(roles, texts, strict=True)), template)
                loss = None if inner is None else [list(x) for x, r in zip(inner, roles, strict=True) if r == loss_role]
                out.append({"conv_id": conv, "formatted": s, "turn_spans": spans and [list(x) for x in spans], "loss_spans": loss, "rewrites": spans is None})
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return grouped.mapInArrow(run, "conv_id long, formatted string, turn_spans array<array<long>>, loss_spans array<array<long>>, rewrites boolean")


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and hashes read back from the formatted conversations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, s, loss in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans")), strict=True):
                turns = parse(s)
                said = "".join(unescape(s[a:z]) for a, z in loss or [])
                out.append({"conv_id": conv, "n_turns": len(turns), "turns_sha256": _sha("".join(f"{r}\n{t}\n" for r, t in turns)), "loss_chars": len(said), "loss_sha256": _sha(said), "formatted_chars": len(s)})
            yield pa.RecordBatch.from_pylist(out, schema=DIGESTS)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
