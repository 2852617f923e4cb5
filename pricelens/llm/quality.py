"""Operator 8: quality rules with host-level verdicts.

Documents are judged by their own text; failures are then summed by host, each
host's failure rate is shrunk towards the corpus by an empirical beta prior
(method of moments over the hosts), and the verdict of the host is joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import prepare, stored
from pricelens.llm.words import Words, slices

#: A document fails by itself below this many words,
MIN_WORDS = 20
#: or if more than this share (percent) of its words lies in repeated windows
MAX_REPEAT_PERCENT = 30
#: of this many words.
WINDOW = 8
#: A host is rejected when its shrunk failure rate passes this.
MAX_HOST_RATE = 0.6

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Bytes that begin a code point.
_LEADS = (np.arange(256) & 0xC0) != 0x80

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _repeated_words(w: Words) -> np.ndarray:
    """Per document the words that lie in a window found twice or more in it."""
    h, whole = w.windows(WINDOW)
    doc = np.repeat(np.arange(len(w)), w.counts)
    at = np.flatnonzero(whole)
    order = at[np.lexsort((h[at], doc[at]))]
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(h) + 1, np.int64)
    hit = order[twice]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return inside[w.first[1:]] - inside[w.first[:-1]]


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _per_doc(flag: np.ndarray, offs: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flag)])
    return c[offs[1:]] - c[offs[:-1]]


def _stats(column: pa.Array) -> list[pa.Array]:
    out: list[list] = [[], [], [], [], []]
    for _, _, buf, offs in slices(column):
        w = Words(buf, offs)
        raw = buf.tobytes()
        out[0] += w.counts.tolist()
        out[1] += _per_doc(~w.sep & _LEADS[buf], offs).tolist()
        out[2] += _per_doc(SYMBOLS[buf], offs).tolist()
        out[3] += [_dup_lines(raw[a:b]) for a, b in zip(offs[:-1], offs[1:], strict=True)]
        out[4] += _repeated_words(w).tolist()
    return [pa.array(x, pa.int64()) for x in out]


def document_stats(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with the five counts of its text in place of the text (or beside it)."""
    rest = [c for c in docs.columns if keep_text or c != text]
    names = [x.split()[0] for x in STATS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(c) for c in rest] + _stats(b.column(text)), names=[*rest, *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest), STATS])
    return docs.mapInArrow(run, schema)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(stats: DataFrame, host: str = "host", failed: str = "base_failed", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, host_docs, host_failed, host_rate, host_kept): failure rates shrunk by a beta prior.

    The prior's mean and strength are the moments of the host rates, weighted by
    documents; hosts alike beyond chance leave a strong prior.  A null host is a host.
    """
    hosts = stats.groupBy(host).agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col(failed).cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    prior = hosts.agg(F.sum("host_failed").alias("f"), F.sum("host_docs").alias("d"), F.count(F.lit(1)).alias("k"),
                      F.sum(F.col("host_docs") * rate * rate).alias("s2"))
    m = F.try_divide(F.col("f"), F.col("d"))
    var = F.try_divide(F.col("s2"), F.col("d")) - m * m
    # Beta moments: strength = m(1-m)/var - 1; var of the rates also holds the sampling noise m(1-m)/(d/k).
    noise = m * (1 - m) * F.try_divide(F.col("k").cast("double"), F.col("d"))
    spread = F.greatest(var - noise, F.lit(1e-6))
    strength = F.greatest(m * (1 - m) / spread - 1, F.lit(1.0))
    prior = prior.select(m.alias("prior_mean"), strength.alias("prior_strength"))
    shrunk = (F.col("host_failed") + F.col("prior_mean") * F.col("prior_strength")) / (F.col("host_docs") + F.col("prior_strength"))
    return (hosts.join(F.broadcast(prior), F.lit(True))
            .select(host, "host_docs", "host_failed", shrunk.alias("host_rate"), (shrunk <= max_rate).alias("host_kept")))


def quality_rules(docs: DataFrame, host: str = "source", keep_text: bool = False, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Judge every document of ``docs`` (doc_id, text, host column).

    Adds the five counts, base_failed, host_rate and kept (false if base_failed,
    else its host's verdict).  A null text has no words and fails; a null id or
    host is a value like others; repeated rows are judged each; an empty table
    gives an empty result.
    """
    prepare(docs.sparkSession)
    cols = ["doc_id", "text", host]
    stats = document_stats(docs.select(*cols), keep_text=keep_text).withColumnRenamed(host, "host").withColumn("base_failed", base_failed())
    stats = stored(stats, "quality")
    verdicts = host_verdicts(stats)
    # one row per host: the join is skew-safe, since Spark can split the documents' side
    return (stats.join(stored(verdicts, "hosts").withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept")))


def quality_documents(docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` (all columns) that the rules and their host's verdict keep."""
    prepare(docs.sparkSession)
    verdicts = stored(host_verdicts(stored(_failures(docs, host), "failures"), max_rate=max_host_rate), "hosts").filter("host_kept").select(F.col("host").alias("_llm_host"))
    kept = _flagged(docs).filter(~F.col("_llm_failed")).drop("_llm_failed")
    return kept.join(verdicts, kept[host].eqNullSafe(F.col("_llm_host")), "left_semi").select(*docs.columns)


def _failures(docs: DataFrame, host: str) -> DataFrame:
    """(host, base_failed) of every document."""
    return _flagged(docs.select(F.col(host).alias("host"), "text")).select("host", F.col("_llm_failed").alias("base_failed"))


def _flagged(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_llm_failed``, beside whatever columns there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, _, _, _, repeated = (np.array(x) for x in _stats(b.column("text")))
            failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(failed, pa.bool_())], names=[*b.schema.names, "_llm_failed"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "_llm_failed boolean"])
    return docs.mapInArrow(run, schema)
