"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read back as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

Defined results, of every stage: rows are never told apart by columns beyond
those of ``documents``, which are passed on whatever their names; null and
empty texts and very long ones are documents like others, as the docstring of
each stage says; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.llm import mixing, ngram_join, packing, pii, quality_model, queries
from harvestline.llm.common import prepare, stored
from harvestline.sources.tables import read_table


BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def on_documents(stage):
    """Hold further columns in one, so that their names meet none that a stage uses."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        more = [c for c in docs.columns if c not in BASE]
        if not more:
            return stage(spark, docs, sf_dir)
        held = stage(spark, docs.select(*BASE, F.struct(*more).alias("_more")), sf_dir)
        return held.select(*[F.col(c) if c in BASE else F.col("_more")[c].alias(c) for c in docs.columns])
    return run


@on_documents
def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality classifier scores THRESHOLD or more.  Null and empty
    texts have the score of the intercept; equal texts have equal scores, so
    repeated rows stay or go together; a score at the threshold stays."""
    cols = docs.columns
    model = queries.fitted_model(prepare(spark), sf_dir, docs)
    scored = docs.select(F.struct("*").alias("_row"), quality_model.score_column(spark, model, docs["text"]).alias("_score"))
    return scored.where(F.col("_score") >= quality_model.THRESHOLD).select(*[F.col("_row")[c].alias(c) for c in cols])


@on_documents
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of the 5-word shingle Jaccard join: the
    smallest doc_id, and one of the rows that repeat it.  Null and wordless texts
    and null ids are linked with nothing and stay."""
    return ngram_join.keep_representatives(docs)


@on_documents
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the new text.  A null text
    stays null and an empty one empty; of overlapping spans the operator's choice
    holds; repeated rows are redacted alike."""
    clean = pii.redact(pii.with_spans(docs, name="_pii_spans"), spans="_pii_spans")
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@on_documents
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights.  A
    null source is a source of its own; a document without a word weighs nothing
    and comes as often as the whole part of its source's share; rows that repeat a doc_id are drawn each on their own; ties
    between fractions are drawn by hash, so reruns agree."""
    return mixing.take(docs, mixing.mix(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack into sequences of 2048; one row a piece, with its ids.  A null
    or empty text is the end id alone; repeated rows are packed each on their own;
    columns beyond doc_id and text end here."""
    return packing.pack(docs, queries.word_vocabulary(), with_ids=True)


STAGES = [
    ("quality_classifier", classify_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned scores, random draws and a tokenizer take part: SQL cannot express the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
