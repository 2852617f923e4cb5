"""Corpus pipeline: quality rules, near duplicates, passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; ``run`` writes each result as Parquet under spark.checkpoint.dir and reads
it back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.common import NULL_ID, prepare, stored
from pricelens.llm.ngram_join import ngram_components
from pricelens.llm.packing import pack_documents
from pricelens.llm.pii import sanitise
from pricelens.llm.quality import quality_documents
from pricelens.llm.substring_dedup import dedup_passages

Frame = DataFrame


def keep_quality(spark: SparkSession, docs: Frame, sf_dir: str) -> Frame:
    """Documents that pass the quality rules and whose host does; a null text fails."""
    return quality_documents(docs)


def _key() -> Column:
    """Names a document: its id and its text, so null and repeated ids are told apart."""
    return F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")))


def drop_near_copies(spark: SparkSession, docs: Frame, sf_dir: str) -> Frame:
    """One document of each group of near copies: that with the smallest id.

    Documents without words are in no group and stay.  Rows that agree in id and
    text are one document, of which one row stays; rows that share an id, or have
    none, but differ in text are documents of their own.
    """
    prepare(spark)
    parts = ngram_components(docs.select(_key().alias("doc_id"), "text"))
    parts = stored(parts.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_llm_key"), "n_shingles", F.coalesce("component_id", F.lit(NULL_ID)).alias("_llm_component")).distinct(), "near-copies")
    ids = docs.select(_key().alias("_llm_key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_llm_id")).distinct()
    grouped = parts.filter("n_shingles > 0").join(ids, "_llm_key").groupBy("_llm_component").agg(F.min(F.struct("_llm_id", "_llm_key")).alias("least"))
    chosen = grouped.select("least._llm_key").unionByName(parts.filter("n_shingles = 0").select("_llm_key"))
    kept = docs.withColumn("_llm_own", _key())
    kept = kept.join(stored(chosen, "chosen"), F.col("_llm_own") == F.col("_llm_key"), "left_semi")
    # only documents that repeat need their rows compared
    repeated = docs.groupBy(_key().alias("_llm_key")).agg(F.count(F.lit(1)).alias("_llm_n")).filter("_llm_n > 1").select("_llm_key")
    if not repeated.isEmpty():
        again = stored(repeated, "repeated")
        same = F.col("_llm_own") == F.col("_llm_key")
        kept = kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["_llm_own"]))
    return kept.drop("_llm_own")


def drop_passages(spark: SparkSession, docs: Frame, sf_dir: str) -> Frame:
    """Texts without passages that an earlier document has; a text left empty goes.

    A text that loses nothing keeps its own bytes; n_chars follows the text.
    """
    cut = dedup_passages(docs, keep_source=True).filter("n_removed > 0").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_llm_id"), F.col("source_digest").alias("_llm_digest"), F.col("kept").alias("_llm_kept"))
    # rows that share an id lose what their own text lost
    cut = stored(cut.dropDuplicates(["_llm_id", "_llm_digest"]), "cut-passages")
    own = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) == F.col("_llm_id")) & (F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))) == F.col("_llm_digest"))
    both = docs.join(cut, own, "left")
    both = both.filter(F.col("_llm_kept").isNull() | (F.col("_llm_kept") != "")).withColumn("text", F.coalesce("_llm_kept", "text"))
    return _like(both, docs)


def hide_personal_data(spark: SparkSession, docs: Frame, sf_dir: str) -> Frame:
    """Personal data and the terms that disclose it, generalised to their kind."""
    return _like(sanitise(docs), docs)


def pack(spark: SparkSession, docs: Frame, sf_dir: str) -> Frame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack_documents(docs)


def _like(rows: Frame, docs: Frame) -> Frame:
    """The columns of ``docs``, with n_chars of the new text."""
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return rows.select(*(length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_copies),
    ("passages", drop_passages),
    ("personal data", hide_personal_data),
    ("packing", pack),
]

#: The lattice of stages holds tokenisation and similarity classes; it is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> Frame:
    """The pieces that the stages make of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs
