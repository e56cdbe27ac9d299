"""The corpus pipeline: five stages over ``documents``, each written as Parquet for the next.

language: documents without an id, without a letter or without a prevailing language go.
near_duplicates: of each class of near duplicates the document with the smallest id stays.
decontaminate: documents that hold a passage of a benchmark item go.
personal_data: spans with personal data, and terms that disclose it, are replaced by their kind.
pack: the remaining texts are tokenised and packed into training sequences.

Every stage reads whole texts and all of its input. Rows that share a doc_id are one document:
they stay or go together. Null texts are without a letter, so they go in the first stage. The
language stage learns from the rows with a ``lang``; if there are none, or no such column, every
document with an id and a letter stays. No stage needs any of the other columns, which may be
null, missing or have any name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.llm import language, pii
from tripdeck.llm.decontam import find_overlaps
from tripdeck.llm.jaccard import near_duplicate_classes
from tripdeck.llm.packing import pack_documents
from tripdeck.llm.stages import written

LEAST_SCORE = 0.5          # share of a document's words in its language
BROADCAST_IDS = 1_000_000  # doc_ids (8 bytes each) sent to every executor at most

#: Tokenisation and the learnt language model have no SQL form.
ORACLE_SQL = None


def _wrapped(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, safe from columns that an operator adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias("rest"))


def _unwrapped(df: DataFrame, docs: DataFrame, text=None) -> DataFrame:
    """The columns of ``docs`` again, with ``text`` replaced if it is given."""
    return df.select(*[
        F.col(c) if c == "doc_id" else (F.col(c) if text is None else text).alias(c)
        if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs) if "lang" in docs.columns else None
    if model is None or not model.names:  # nothing to learn from: every text with a letter stays
        return docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found = language.languages(_wrapped(docs), model)
    kept = found.where(F.col("doc_id").isNotNull() & (F.col("lang_pred") != language.UNKNOWN)
                       & (F.col("score") >= LEAST_SCORE))
    return _unwrapped(kept, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = written(near_duplicate_classes(docs, n=5, percent=80)
                   .where("doc_id <> component_id").select("doc_id").distinct(), "duplicates")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_overlaps(_wrapped(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _unwrapped(found.where("size(leaks) = 0"), docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars, where documents have it, follows the text."""
    found = pii.personal_data(_wrapped(docs))
    out = _unwrapped(found, docs, pii.sanitised(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"),
                          max_tokens=4096, end_id=1)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", remove_personal_data),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; returns the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
