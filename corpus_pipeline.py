"""The corpus pipeline: language ID, near-dedup, exact substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents.  run() applies them in order and cuts the lineage between them.

Defined results of every stage: an empty table gives an empty one; columns beside those of documents are dropped, whatever their names; null
ids, languages, sources and counts are kept as they are; very long texts are read whole; each stage says what becomes of null and empty texts,
of ties and of repeated rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrogrid.llm import langid, mixing, neardup, packing, simhash, suffixdedup
from pyrogrid.llm.common import held_out, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No source is repeated more often than this; the largest one is taken once and whole, so no document goes.
MOST_REPEATS = 2.0


def as_text(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best language model still fits badly, or that have no letters, go: null and empty texts among them.

    A tie between languages does not matter here; repeated rows stay or go together; without any row to learn a language from nothing can be rejected, and all stay.
    """
    model = langid.train(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    if not model.langs:
        return docs.select(*COLUMNS)
    return langid.identify(docs, model, keep=tuple(COLUMNS)).filter(~F.col("rejected")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays (of repeated ids in it, the one with the least text hash).

    Near copies have a Jaccard similarity of 0.8 or more in their runs of five words.  op9's fingerprints and their links propose them; MinHash bands
    propose what these do not reach, and whole sets decide on both.
    Null and empty texts are copies of each other.  Rows alike in id and text are one, with the least language, source and count of theirs.
    """
    groups = neardup.near_groups(docs.select("doc_id", "text"))
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("row_key").alias("row_key"))
    rows = docs.withColumn("row_key", simhash.row_key(F.col("doc_id"), F.col("text")))
    one = F.min(F.struct("doc_id", "lang", "source", "n_chars", "text"))
    return rows.join(kept.select("row_key"), "row_key", "left_semi").groupBy("row_key").agg(one.alias("row")).select(*[F.col(f"row.{c}").alias(c) for c in COLUMNS])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of over 50 words that stand more than once, white space aside; op2's 400 bytes do not count here.

    Null and empty texts stay as they are; no row goes, a text may become empty; repeated rows, if any came, would lose all they have in
    long passages; ties do not arise.  Counts are those of the new texts.
    """
    done = suffixdedup.dedup(docs, view=suffixdedup.PASSAGES)
    text = F.when(F.col("__cut.n_removed") == 0, F.col("text")).otherwise(F.pandas_udf(as_text, "string")(F.col("__cut.kept")))
    return done.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to MOST_REPEATS times, so that all weigh more alike.

    A null source is one of its own; null and empty texts weigh nothing and stay once at least; rows alike are repeated alike.
    """
    mixed = mixing.mix(docs, max_repeats=MOST_REPEATS, budget_ratio=None, places=False)
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), "__repeats")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per training sequence: its piece of the text, its length bucket and its place in a batch; pieces put together are the texts.

    (doc_id, text_key, copy, piece) names a sequence; null and empty texts are sequences of no tokens; repeated rows count up in copy.
    """
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", substring_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The stages hold trained models, numbered components and hashed orders, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
