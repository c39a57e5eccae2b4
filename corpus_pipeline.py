"""Cleans and packs a corpus in stages; each works on what the one before it kept.

Toxic documents go, then documents whose language cannot be told, then all but one of
each class of near duplicates; what stays is packed along a space-filling curve.  Every
stage's result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerframe.llm import language, near_duplicates, packing, text, toxicity
from layerframe.plans.scratch import cut_lineage

#: SQL cannot express the learned scores; tests hold each stage against a plain restatement.
ORACLE_SQL = None


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the network learns from the labelled ones among them.

    Null and empty texts score 0 and stay, as does everything where no label is known.  Long
    texts are scored whole; repeated rows fare alike; rows without an id are scored like others.
    Other columns stay as they are, also one named score or predicted.
    """
    model = toxicity.learn(docs, text.table(spark, sf_dir, "labels"))
    score, toxic = text.fresh(docs, "score"), text.fresh(docs, "predicted")
    return toxicity.score_toxicity(docs, model, names=(score, toxic)).where(f"{toxic} = 0").drop(score, toxic)


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null and empty texts and those without a letter go.

    The languages are learned from the documents that state theirs; where none does, the
    same documents go and all others stay.
    """
    codes = language.learn(docs, text.remainder("doc_id", 3) != 1)
    if codes is None:
        return language.with_letter(docs)
    lang, score = text.fresh(docs, "lang_pred"), text.fresh(docs, "score")
    return language.identify(docs, codes, names=(lang, score)).where(f"{lang} <> 'und'").drop(lang, score)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, rows with null or repeated ids included."""
    return near_duplicates.keep_one(docs, unkeyed=False)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 1024 tokens.

    A null or empty text is its end id alone; long texts are cut into pieces and repeated rows
    packed each, with or without an id.  Only id and text are read, whatever else is there; an
    empty table gives no pieces.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("language ID", in_a_language),
    ("near duplicates", without_near_duplicates),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
